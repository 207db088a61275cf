"""Transcript parsing: a hidden Markov model recovers who speaks each line, and turns are rendered canonically.

Rows are pieces of transcripts, in the order of a position; each piece has lines. A state is a role and
whether the line begins a turn; a line shows a speaker marker (or none) and a few features of its text. The
model's probabilities are counted on transcripts whose roles are known. Viterbi's best path is exact however
long a transcript is and wherever it is cut: pieces are dealt by ranges of (transcript, position), each range
sums its ends up as max-plus matrices of 6 x 6, the driver joins these - two a range, whatever the data - and
fixes the states at the cuts, and then every range is decoded by itself. So a transcript that holds a third
of all rows is spread over a third of the tasks.

A piece is a turn only where the caller says so (``turns``); else the model leaves out the feature that a line is
its piece's first, so pieces may be whole texts or lines, and where they are cut changes nothing.

Rendering gives each piece its text with a header where a turn begins and an end mark where one ends; the
pieces of a transcript, in order, make up its canonical form.

Defined cases
    null or empty text: one empty line. A transcript of any length is decoded whole, over as many ranges as it
    takes; a single piece is one task's. Null ids form one transcript; null positions come first. Equal
    positions: in the order of the texts. Repeated rows are pieces each. An empty table gives an empty result;
    without a known role the model is that of its priors. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches

ROLES = ("system", "user", "assistant")
#: Names that speakers go by.
NAMES = {
    "system": ("system", "context", "instruction", "instructions"),
    "user": ("user", "human", "question", "q", "prompt", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
}
_ROLE_OF = {name: k for k, role in enumerate(ROLES) for name in NAMES[role]}
MARKER = re.compile(r"^\s*(?:#+\s*|\*\*|<\|)?(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True)) + r")(?:\|>|\s*(?:\*\*)?\s*[:>]\s*(?:\*\*)?)\s*", re.IGNORECASE)
STATES = 2 * len(ROLES)  # role, 2 * role + 1 where the turn goes on
HEADER, END = "<|{}|>\n", "\n<|end|>\n"
#: Features: how many values each takes. Marker (role or none), length, question, list or code, first of piece.
SIZES = (len(ROLES) + 1, 4, 2, 2, 2)


def features(line: str, first: bool) -> tuple[int, ...]:
    found = MARKER.match(line)
    body = line[found.end() :] if found else line
    n = len(body)
    return (
        _ROLE_OF[found[1].lower()] if found else len(ROLES), 0 if n < 20 else 1 if n < 80 else 2 if n < 240 else 3,
        int("?" in body), int(bool(re.match(r"\s*([-*•]|\d+[.)]|```|    )", body))), int(first),
    )


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    shown: list[np.ndarray]

    def lines(self, text: str | None) -> tuple[list[str], np.ndarray]:
        lines = (text or "").split("\n")
        seen = np.array([features(line, k == 0) for k, line in enumerate(lines)])
        return lines, sum(table[:, seen[:, k]].T for k, table in enumerate(self.shown))


def _known(rows: DataFrame) -> DataFrame:
    return rows.where(F.lower("role").isin(*ROLES)).select("conv_id", "position", "text", F.lower("role").alias("role"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(SIZES), STATES, max(SIZES)), dtype=np.int64)
    inside = np.zeros((STATES, STATES), dtype=np.int64)
    for batch in batches:
        for text, role in zip(batch.column("text").to_pylist(), batch.column("role").to_pylist(), strict=True):
            k = ROLES.index(role)
            for at, line in enumerate((text or "").split("\n")):
                state = 2 * k + (at > 0)
                for f, value in enumerate(features(line, at == 0)):
                    total[f, state, value] += 1
                if at:
                    inside[2 * k + (at > 1), state] += 1
    flat = np.concatenate([total.ravel(), inside.ravel()])
    at = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["slot", "n"])


def train(rows: DataFrame, turns: bool = True) -> Model:
    """Counts, with a prior, over rows (conv_id, position, text, role), a turn each, of transcripts whose roles are
    known; ``turns``: the pieces to parse are turns too, and a piece's first line shows it."""
    known = _known(rows)
    counts = known.select("text", "role").mapInArrow(_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # a fixed number of slots
    flat = np.zeros(len(SIZES) * STATES * max(SIZES) + STATES * STATES)
    for r in counts:
        flat[r["slot"]] = r["n"]
    total, inside = flat[: -STATES * STATES].reshape(len(SIZES), STATES, max(SIZES)), flat[-STATES * STATES :].reshape(STATES, STATES)
    ends = known.select("conv_id", "position", "role").distinct()
    later = ends.select("conv_id", (F.col("position") - 1).alias("position"), F.col("role").alias("next"))
    follow = np.ones((len(ROLES), len(ROLES))) * 0.5
    for r in ends.join(later, ["conv_id", "position"]).groupBy("role", "next").count().collect():
        follow[ROLES.index(r["role"]), ROLES.index(r["next"])] += r["count"]
    # a first piece is one that no piece stands directly before
    before = ends.select("conv_id", (F.col("position") + 1).alias("position")).distinct()
    first = np.ones(len(ROLES)) * 0.5
    for r in ends.join(before, ["conv_id", "position"], "left_anti").groupBy("role").count().collect():
        first[ROLES.index(r["role"])] += r["count"]
    shown = []
    for f, size in enumerate(SIZES if turns else SIZES[:-1]):
        table = total[f][:, :size] + 0.5
        if f == 0:  # a marker names its role, and none but a turn's first line has one
            table[0::2, : len(ROLES)] += 2 * np.eye(len(ROLES))
            table[1::2, len(ROLES)] += 20
        shown.append(np.log(table / table.sum(axis=1, keepdims=True)))
    step = np.full((STATES, STATES), 1e-4) + inside
    ended = 1.0 + total[0].sum(axis=1)  # lines by state
    for a in range(len(ROLES)):
        turns = max(1.0, float(total[0, 2 * a].sum()))
        for go in (0, 1):
            step[2 * a + go, 0::2] += (follow[a] / follow[a].sum()) * turns * ended[2 * a + go] / (ended[2 * a] + ended[2 * a + 1])
            step[2 * a + go, 2 * a + 1] += 0.5
    start = np.full(STATES, 1e-6)
    start[0::2] = first / first.sum()
    return Model(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), shown)


def _best(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


class _Ends:
    """What a range keeps of one transcript's lines: the best scores from any state before its first line to
    each state of its last one, and the same for a transcript that begins here."""

    def __init__(self, model: Model):
        self.model, self.matrix, self.scores = model, None, None

    def add(self, shown: np.ndarray) -> None:
        for line in shown:
            one = self.model.step + line[None, :]
            self.matrix = one if self.matrix is None else _best(self.matrix, one)
            self.scores = self.model.start + line if self.scores is None else (self.scores[:, None] + one).max(axis=0)

    def packed(self) -> bytes:
        return np.concatenate([self.matrix.ravel(), self.scores]).tobytes()


_SORTED = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("seq", pa.int64()), ("conv_id", pa.int64()), ("position", pa.int64()), ("tag", pa.string()), ("text", pa.string()), ("ends", pa.binary())])
_SORTED_SQL = "kind int, part int, seq long, conv_id long, position long, tag string, text string, ends binary"


def _summarise(shared):
    """Passes ordered pieces on with their range and number, and the ends of the range's first and last transcript."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, seq = shared.value, TaskContext.get().partitionId(), 0
        kept: list[tuple[int | None, _Ends]] = []
        for batch in batches:
            n = batch.num_rows
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not kept or kept[-1][0] != conv:
                    kept = [*kept[:1], (conv, _Ends(model))]
                kept[-1][1].add(model.lines(text)[1])
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(np.arange(seq, seq + n)), batch.column("conv_id"), batch.column("position"), batch.column("tag"), batch.column("text"), pa.nulls(n, pa.binary())], schema=_SORTED)
            seq += n
        if kept:
            n = len(kept)
            yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([c for c, _ in kept], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.array([e.packed() for _, e in kept], pa.binary())], schema=_SORTED)

    return run


def _cuts(ends: list) -> dict[int, tuple[int | None, int | None]]:
    """By range: the state before its first line (None: a transcript begins there) and the state its last line
    has (None: the transcript ends there and the state is free)."""
    chains: list[list] = []
    for r in sorted(ends, key=lambda r: (r["part"], r["seq"])):
        if chains and chains[-1][-1]["conv_id"] == r["conv_id"] and chains[-1][-1]["part"] != r["part"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    before: dict[int, int] = {}
    after: dict[int, int] = {}
    for chain in chains:
        packed = [np.frombuffer(r["ends"]) for r in chain]
        scores = [packed[0][STATES * STATES :]]
        for one in packed[1:]:
            scores.append((scores[-1][:, None] + one[: STATES * STATES].reshape(STATES, STATES)).max(axis=0))
        state = int(np.argmax(scores[-1]))
        for k in range(len(chain) - 1, 0, -1):
            state = int(np.argmax(scores[k - 1] + packed[k][: STATES * STATES].reshape(STATES, STATES)[:, state]))
            before[chain[k]["part"]] = after[chain[k - 1]["part"]] = state
    return {r["part"]: (before.get(r["part"]), after.get(r["part"])) for r in ends}


def viterbi(shown: np.ndarray, model: Model, before: int | None = None, after: int | None = None) -> list[int]:
    """The best states of lines; ties go to the lower state."""
    scores = shown[0] + (model.start if before is None else model.step[before])
    back = np.zeros((len(shown), STATES), dtype=np.int8)
    for k in range(1, len(shown)):
        from_all = scores[:, None] + model.step
        back[k] = from_all.argmax(axis=0)
        scores = from_all.max(axis=0) + shown[k]
    state = int(np.argmax(scores)) if after is None else after
    path = [state]
    for k in range(len(shown) - 1, 0, -1):
        state = int(back[k, state])
        path.append(state)
    return path[::-1]


def render(lines: list[str], states: list[int], role: int | None, last: bool) -> tuple[str, list[str], int | None]:
    """A piece's canonical text, the roles of the turns it begins, and the role of its open turn.
    ``role`` is that of the turn open before it, None at a transcript's begin."""
    out, begun = [], []
    for line, state in zip(lines, states, strict=True):
        if role is None or state % 2 == 0 or state // 2 != role:
            out.append(END if role is not None else "")
            role = state // 2
            found = MARKER.match(line)
            body = line[found.end() :] if found and _ROLE_OF[found[1].lower()] == role else line
            out.append(HEADER.format(ROLES[role]) + body)
            begun.append(ROLES[role])
        else:
            out.append("\n" + line)
    return "".join(out) + (END if last else ""), begun, role


def _decode(model_shared, cuts_shared):
    def out(pieces: list[tuple], model: Model, before: int | None, after: int | None) -> Iterator[tuple]:
        shown = np.concatenate([x[3] for x in pieces])
        states, at, role = viterbi(shown, model, before, after), 0, None if before is None else before // 2
        for k, (conv, position, lines, _, tag) in enumerate(pieces):
            mine = states[at : at + len(lines)]
            at += len(lines)
            text, begun, role = render(lines, mine, role, after is None and k == len(pieces) - 1)
            yield conv, position, len(lines), [ROLES[s // 2] for s in mine], begun, text, tag

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cuts = model_shared.value, cuts_shared.value
        held: list[tuple] = []
        now, first, done = None, True, []

        def closed(after: int | None) -> None:
            done.extend(out(held, model, cuts[now[0]][0] if first else None, after))

        for batch in batches:
            for part, conv, position, text, tag in zip(*(batch.column(c).to_pylist() for c in ("part", "conv_id", "position", "text", "tag")), strict=True):
                if now is not None and now != (part, conv):
                    closed(cuts[now[0]][1] if part != now[0] else None)
                    held, first = [], part != now[0]
                now = (part, conv)
                lines, shown = model.lines(text)
                held.append((conv, position, lines, shown, tag))
            if done:
                yield _pieces(done)
                done = []
        if held:
            closed(cuts[now[0]][1])
        if done:
            yield _pieces(done)

    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    conv, position, n, roles, begun, text, tag = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(position, pa.int64()), pa.array(n, pa.int32()), pa.array(roles, pa.list_(pa.string())), pa.array(begun, pa.list_(pa.string())), pa.array(text, pa.string()), pa.array(tag, pa.string())], names=["conv_id", "position", "n_lines", "line_roles", "turns", "rendered", "tag"])


def parse(pieces: DataFrame, known: DataFrame, *, ranges: int | None = None, turns: bool = True) -> DataFrame:
    """Per piece of ``pieces`` (conv_id, position, text): n_lines, line_roles, turns (roles of the turns that
    begin in it) and rendered. ``known`` (conv_id, position, text, role) teaches the model, a turn a row;
    without ``turns`` the pieces' borders say nothing of the turns. A text column ``tag``, where the pieces have one, is
    handed through unseen."""
    spark = pieces.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(train(known, turns))
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces.rdd.getNumPartitions())
    tag = F.col("tag") if (tagged := dict(pieces.dtypes).get("tag") == "string") else F.lit(None).cast("string").alias("tag")
    rows = pieces.select(F.col("conv_id").cast("long"), F.col("position").cast("long"), tag, F.col("text").cast("string"))
    order = ["conv_id", "position", "text"]
    scratch = Scratch(spark)
    ordered = scratch.table(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_summarise(model), _SORTED_SQL), "ordered")
    cuts = spark.sparkContext.broadcast(_cuts(ordered.where("kind = 1").select("part", "seq", "conv_id", "ends").collect()))  # two rows a range
    again = ordered.where("kind = 0").repartition(ranges, "part").sortWithinPartitions("part", "seq")
    found = again.select("part", "conv_id", "position", "tag", "text").mapInArrow(_decode(model, cuts), "conv_id long, position long, n_lines int, line_roles array<string>, turns array<string>, rendered string, tag string")
    return found if tagged else found.drop("tag")


#: How speakers are marked in the transcripts that ``transcripts`` writes, one style a conversation.
STYLES = (("System: ", "User: ", "Assistant: "), ("### System: ", "### Human: ", "### AI: "), ("Context> ", "Q> ", "A> "), ("**system:** ", "**customer:** ", "**agent:** "))


def transcripts(conversations: DataFrame, unmarked_percent: int = 25) -> DataFrame:
    """Raw transcripts (conv_id, position, text) of conversations whose roles are known: a style of markers per
    conversation, and one turn in four, by hash, without its marker."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    marks = F.array(*(F.array(*(F.lit(x) for x in names)) for names in STYLES))
    role = F.array_position(F.array(*(F.lit(r) for r in ROLES)), F.lower("role"))
    marked = F.pmod(F.xxhash64("conv_id", "turn", F.lit("mark")), F.lit(100)) >= unmarked_percent
    text = F.coalesce("text", F.lit(""))
    mark = F.when(marked & (role > 0), F.get(F.get(marks, style.cast("int")), (role - 1).cast("int"))).otherwise(F.lit(""))
    return conversations.select("conv_id", F.col("turn").alias("position"), F.concat(F.coalesce(mark, F.lit("")), text).alias("text"), "role")


#: Turns are numbered in blocks of so many, so that no task has all turns of a long conversation.
BLOCK = 1024


def placed(raw: DataFrame) -> DataFrame:
    """``raw`` (conv_id, position, text, ...) with ``line``, the number in its transcript of a row's first line."""
    same = lambda *c: Window.partitionBy(*c)
    rows = raw.withColumn("_n", F.size(F.split("text", "\n"))).withColumn("_block", F.floor(F.col("position") / BLOCK))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = rows.groupBy("conv_id", "_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select(F.col("conv_id").alias("_id"), F.col("_block").alias("_at"), before(same("conv_id").orderBy(F.asc_nulls_first("_block"))).alias("_first"))
    inside = rows.withColumn("_line", before(same("conv_id", "_block").orderBy(F.asc_nulls_first("position"), "text")))
    met = inside.join(blocks, F.col("conv_id").eqNullSafe(F.col("_id")) & F.col("_block").eqNullSafe(F.col("_at")))
    return met.select(*raw.columns, (F.col("_first") + F.col("_line")).alias("line"))


def half(conv_id: str) -> Column:
    """0 or 1 by a hash of the conversation, so that what is learnt from one half can be tried on the other."""
    return F.coalesce(F.pmod(F.xxhash64(conv_id, F.lit("half")), F.lit(2)), F.lit(0))


def lines(rows: DataFrame) -> DataFrame:
    """The transcripts of ``placed`` rows as lines (conv_id, position, text), without the turns' borders; the tag says
    which row a line is from, for ``by_turn``."""
    tag = F.concat_ws(":", F.col("line").cast("string"), F.col("position").cast("string"))
    cut = rows.select("conv_id", "line", tag.alias("tag"), F.posexplode(F.split("text", "\n")).alias("_k", "text"))
    return cut.select("conv_id", (F.col("line") + F.col("_k")).alias("position"), "tag", "text")


def by_turn(parsed: DataFrame) -> DataFrame:
    """What was found in the lines of each of the ``placed`` rows: n_lines, line_roles, turns, rendered."""
    all_ = parsed.groupBy("conv_id", "tag").agg(F.sort_array(F.collect_list(F.struct("position", "line_roles", "turns", "rendered"))).alias("_l"))
    turn = F.get(F.split("tag", ":"), F.lit(1)).cast("long")
    return all_.select("conv_id", turn.alias("position"), F.size("_l").alias("n_lines"), F.flatten("_l.line_roles").alias("line_roles"), F.flatten("_l.turns").alias("turns"), F.array_join("_l.rendered", "").alias("rendered"))
