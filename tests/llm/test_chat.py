import itertools

import numpy as np
import pytest

from gridloom.llm import chat as c
from gridloom.llm import queries as q
from gridloom.llm import weak_quality as w

MID = "/root/testdata/sf0.01"


def known(spark):
    return c.transcripts(spark.read.parquet(f"{MID}/conversations.parquet"))


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(3)
    for _ in range(20):
        model = c.Model(np.log(rnd.dirichlet(np.ones(6))), np.log(rnd.dirichlet(np.ones(6), size=6)), [])
        shown = np.log(rnd.random((4, 6)))
        score = lambda path: model.start[path[0]] + sum(shown[k, x] for k, x in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False))  # noqa: E731, B023
        best = max(itertools.product(range(6), repeat=4), key=score)
        assert np.isclose(score(tuple(c.viterbi(shown, model))), score(best))


def test_markers():
    assert [c.features(x, True)[0] for x in ("User: hi", "### AI: yes", "Q> what", "**agent:** so", "<|system|> be kind", "plain: text", "Answering: no")] == [1, 2, 1, 2, 0, 3, 3]


@pytest.mark.parametrize("ranges", [1, 5, 17])
def test_cuts_change_nothing(spark, ranges):
    long = [(7, k, f"{'User' if k % 2 == 0 else 'AI'}: line {k}\nmore of it\nand more?" if k % 5 else f"no marker {k}\nsecond") for k in range(60)]
    small = [(1, 0, "System: be kind"), (1, 1, "User: hi there?"), (1, 2, None), (2, 0, ""), (None, 3, "x"), (None, 4, "Assistant: y"), (9, 1, "same"), (9, 1, "same"), (9, None, "User: first")]
    frame = spark.createDataFrame([(*r, "z") for r in long + small], "conv_id long, position long, text string, turns string")
    model = c.train(known(spark))
    got = sorted(((r.conv_id, r.position, r.n_lines, r.line_roles, r.turns, r.rendered) for r in c.parse(frame, known(spark), ranges=ranges).collect()), key=str)
    expected = []
    for conv in (7, 1, 2, None, 9):
        pieces = sorted(((p, t) for i, p, t in long + small if i == conv), key=lambda x: (x[0] is not None, x[0], x[1] or ""))
        parts = [model.lines(t) for _, t in pieces]
        states, at, role = c.viterbi(np.concatenate([s for _, s in parts]), model), 0, None
        for k, ((p, _), (lines, _)) in enumerate(zip(pieces, parts, strict=True)):
            mine = states[at : at + len(lines)]
            at += len(lines)
            text, begun, role = c.render(lines, mine, role, k == len(pieces) - 1)
            expected.append((conv, p, len(lines), [c.ROLES[s // 2] for s in mine], begun, text))
    assert got == sorted(expected, key=str)


def test_roles_are_recovered(spark):
    """By a model of other conversations."""
    raw = known(spark)
    truth = {(r.conv_id, r.position): r.role for r in raw.collect()}
    found = [r for k in (0, 1) for r in c.parse(raw.where(c.half("conv_id") == k).drop("role"), raw.where(c.half("conv_id") != k)).collect()]
    lines = [(x, truth[r.conv_id, r.position]) for r in found for x in r.line_roles]
    assert len(found) == len(truth) and np.mean([a == b for a, b in lines]) > 0.95
    assert q.op2_chat_format(spark, MID).count() == len(truth)


@pytest.mark.parametrize("unmarked, least_lines, least_starts", [(0, 0.99, 0.99), (25, 0.93, 0.85)])
def test_turns_are_found_in_whole_texts(spark, unmarked, least_lines, least_starts):
    raw = c.transcripts(spark.read.parquet(f"{MID}/conversations.parquet"), unmarked)
    said = {}
    for r in sorted(raw.collect(), key=lambda r: (r.conv_id, r.position)):
        said.setdefault(r.conv_id, []).append((r.role, r.text.split("\n")))
    texts = spark.createDataFrame([(i, 0, "\n".join("\n".join(x) for _, x in turns)) for i, turns in said.items()], "conv_id long, position long, text string")
    hits, starts, false_starts = [], [], []
    mine = lambda f, k: f.where(c.half("conv_id") == k)
    for r in (r for k in (0, 1) for r in c.parse(mine(texts, k), mine(raw, 1 - k), turns=False).collect()):
        truth = [(role, k == 0) for role, x in said[r.conv_id] for k in range(len(x))]
        hits += [a == b for a, (b, _) in zip(r.line_roles, truth, strict=True)]
    rows = c.placed(raw)
    found = [r for k in (0, 1) for r in c.by_turn(c.parse(c.lines(mine(rows, k)), mine(raw, 1 - k), turns=False)).collect()]
    lines = {(r.conv_id, r.position): r for r in found}
    for i, turns in said.items():
        for k, (_, x) in enumerate(turns):
            r = lines[i, k]
            begins = r.rendered.startswith("<|system|>") or r.rendered.startswith(("<|user|>", "<|assistant|>", c.END + "<|"))
            starts.append(begins)
            false_starts.append(len(r.turns) - begins)
            assert r.n_lines == len(x)
    assert np.mean(hits) > least_lines and np.mean(starts) > least_starts and sum(false_starts) < 0.1 * len(starts)


def test_lines_are_numbered_through(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 3)
    rows = [(i, k, "\n".join("x" * (1 + (k or 0) % 3))) for i in (1, None) for k in (None, *range(10))] + [(1, 4, "y")]
    placed = c.placed(spark.createDataFrame([(*r, "user") for r in rows], "conv_id long, position long, text string, role string"))
    for i in (1, None):
        mine = sorted((r for r in placed.collect() if r.conv_id == i), key=lambda r: (r.position is not None, r.position or 0, r.text))
        sizes = [len(r.text.split("\n")) for r in mine]
        assert [r.line for r in mine] == [sum(sizes[:k]) for k in range(len(sizes))]
        got = sorted(r.position for r in c.lines(placed).collect() if r.conv_id == i)
        assert got == list(range(sum(sizes)))


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, position long, text string, role string")
    assert c.parse(none.drop("role"), none).count() == 0


def test_weak_quality(spark):
    found = {r.doc_id: r for r in q.op7_weak_quality(spark, MID).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{MID}/documents.parquet").count()
    good, bad = ([found[i] for i in truth if truth[i] == k] for k in (1, 0))
    assert np.mean([r.kept for r in good]) > 0.97 and np.mean([not r.kept for r in bad]) > 0.6
    assert np.mean([a.score > b.score for a in good for b in bad]) > 0.85


def test_weak_quality_cases(spark):
    docs = [(1, None), (2, ""), (None, "Plain words here. " * 20), (3, "### $$$ %%% " * 50), (4, "One two. " * 9), (4, "One two. " * 9)]
    frame = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    found = w.score(frame).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert w.score(frame.limit(0)).count() == 0


def test_accuracies_are_estimated():
    rnd = np.random.default_rng(0)
    m, n = len(w.LABELLERS), 20_000
    good = rnd.random(n) < 0.85
    fault = np.array([0.5, 0.8, 0.3, 0.6, 0.7])
    votes = np.where(rnd.random((n, m)) < np.where(good[:, None], 0.01, fault), -1, 1)
    patterns = {}
    for v in votes:
        k = w.pattern_of(v.tolist())
        patterns[k] = patterns.get(k, 0) + 1
    chance, posterior = w.estimate(patterns)
    assert np.abs(chance[:, 0, 0] - fault).max() < 0.05
    called = np.array([posterior[w.pattern_of(v.tolist())] > 0.5 for v in votes])
    assert (called == good).mean() > 0.95
