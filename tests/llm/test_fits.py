"""The trained operators against fits in plain Python: dictionaries and loops, one row at a time."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import charfeatures, language, toxicity
from gridloom.llm import weak_quality as w


def spelled(text):
    """Lower-case letters, all else one space, a space at both ends."""
    out = " "
    for c in text or "":
        c = c.lower()[0] if c.isalpha() else " "
        out += "" if c == out[-1] == " " else c
    return out if out[-1] == " " else out + " "


def slots_of(text, orders, bits):
    found, plain = {}, spelled(text)
    for n in orders:
        for k in range(len(plain) - n + 1):
            gram = plain[k : k + n]
            if gram == " ":
                continue
            (slot,) = charfeatures.grams(np.array([ord(c) for c in gram], dtype=np.uint32), (n,), bits).tolist()
            found[slot] = found.get(slot, 0) + 1
    return found


class Plain:
    """Follow the regularised leader with dictionaries."""

    def __init__(self, classes, alpha, l1, l2, beta=1.0):
        self.classes, self.alpha, self.l1, self.l2, self.beta, self.z, self.n = classes, alpha, l1, l2, beta, {}, {}

    def weight(self, slot, k):
        z, n = self.z.get((slot, k), 0.0), self.n.get((slot, k), 0.0)
        if abs(z) <= self.l1:
            return 0.0
        return -(z - math.copysign(self.l1, z)) / ((self.beta + math.sqrt(n)) / self.alpha + self.l2)

    def margins(self, x):
        return [sum(v * self.weight(s, k) for s, v in x.items()) for k in range(self.classes)]

    def step(self, x, target):
        x = {**x, "constant": 1.0}
        p = shares(self.margins(x))
        before = {(s, k): self.weight(s, k) for s in x for k in range(self.classes)}
        for (s, k), weight in before.items():
            g, n = x[s] * (p[k] - target[k]), self.n.get((s, k), 0.0)
            sigma = (math.sqrt(n + g * g) - math.sqrt(n)) / self.alpha
            self.z[s, k] = self.z.get((s, k), 0.0) + g - sigma * weight
            self.n[s, k] = n + g * g


def shares(margins):
    if len(margins) == 1:
        return [1 / (1 + math.exp(-margins[0]))]
    top = [math.exp(m - max(margins)) for m in margins]
    return [t / sum(top) for t in top]


def prose(rnd, words, n):
    return " ".join(rnd.choice(words) for _ in range(n))


def order_of(spark, ids, seed):
    return {r.i: r.h for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.xxhash64("i", F.lit(seed)).alias("h")).collect()}


@pytest.fixture(scope="module")
def languages():
    rnd = random.Random(4)
    words = {"aa": "the cat is in house and well sleeps".split(), "bb": "le chat est dans la maison dort bien".split(), "cc": "die katze ist im haus und gut schläft".split()}
    return [(i, prose(rnd, words["aabbcc"[2 * (i % 3) :][:2]], rnd.randrange(3, 30)), "aabbcc"[2 * (i % 3) :][:2]) for i in range(90)] + [(200, "12 !", "aa"), (201, None, "bb"), (202, "dans maison", None)]


def test_language_model(spark, languages):
    """Frequencies, weights, temperature and scores of every row."""
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(languages, "doc_id long, text string, lang string")).collect()}
    learnt = [r for r in languages if zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] is not None and r[2]]
    place = order_of(spark, [r[0] for r in learnt], 12)
    slots = {i: slots_of(t, language.ORDERS, language.BITS) for i, t, _ in languages}
    df = {}
    for i, _, _ in learnt:
        for s in slots[i]:
            df[s] = df.get(s, 0) + 1

    def tfidf(i):
        x = {s: (1 + math.log(c)) * (math.log((1 + len(learnt)) / (1 + df.get(s, 0))) + 1) for s, c in slots[i].items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {s: v / norm for s, v in x.items()}

    examples = [(tfidf(i), "abc".index(lang[0])) for i, _, lang in sorted(learnt, key=lambda r: place[r[0]]) if slots[i]]
    model = Plain(3, 0.3, 0.02, 0.5)
    for _ in range(3):
        for k, (x, y) in enumerate(examples):
            if k % 5:
                model.step(x, [float(c == y) for c in range(3)])
    margin = lambda x: model.margins({**x, "constant": 1.0})
    held = [(margin(x), y) for x, y in examples[::5]]
    loss = lambda t: -sum(math.log(max(1e-12, shares([m / t for m in ms])[y])) for ms, y in held)
    temperature = min((math.exp(math.log(0.05) + k * math.log(400) / 4000) for k in range(4001)), key=loss)
    for i, _, _ in languages:
        if not slots[i]:
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        p = shares([m / temperature for m in margin(tfidf(i))])
        assert found[i].lang_pred == ("aa", "bb", "cc")[p.index(max(p))]
        assert abs(found[i].score - max(p)) < 2e-3


def test_toxicity_model(spark):
    rnd = random.Random(6)
    fine, bad = "what a lovely day it is here".split(), "you worthless idiot go away now".split()
    docs = [(i, prose(rnd, fine + (bad if i % 3 == 0 else []), rnd.randrange(2, 12))) for i in range(60)] + [(90, None), (91, "?")]
    labels = [(i, int(i % 3 == 0)) for i in range(60)]
    found = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    slots = {i: set(slots_of(t, toxicity.ORDERS, toxicity.BITS)) for i, t in docs}
    learnt = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 != 0]
    number = [sum(y == k for _, y in learnt) for k in (0, 1)]
    have = [{}, {}]
    for i, y in learnt:
        for s in slots[i]:
            have[y][s] = have[y].get(s, 0) + 1

    def ratio(s):
        n, t = (have[k].get(s, 0) for k in (0, 1))
        r = math.log((1 + t) / (2 + number[1])) - math.log((1 + n) / (2 + number[0]))
        return math.copysign(max(0.0, abs(r) - 1.5 * math.sqrt(1 / (1 + t) + 1 / (1 + n))), r)

    place = order_of(spark, [i for i, _ in learnt], 24)
    x = {i: {s: ratio(s) for s in slots[i]} for i in slots}
    model = Plain(1, 0.1, 0.0, 1.0)
    for _ in range(4):
        for i, y in sorted(learnt, key=lambda r: place[r[0]]):
            model.step(x[i], [float(y)])
    for i, _ in docs:
        assert abs(found[i] - shares(model.margins({**x[i], "constant": 1.0}))[0]) < 1e-3
    assert sum((found[i] >= 0.5) == bool(y) for i, y in labels) > 50


def measures(text):
    """A labeller's measures, letter by letter."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return [0.0] + [math.nan] * 4
    raw = text.encode()
    solid = max(1, sum(b > 0x20 for b in raw))
    lines = [x for x in (line.strip() for line in raw.split(b"\n")) if x]
    again = []
    if len(words) > 2:
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        again.append(1 - len(set(grams)) / len(grams))
    if len(lines) > 1:
        again.append(1 - len(set(lines)) / len(lines))
    return [len(words), sum(chr(b) in "#*$%&|<>{}[]\\^~=_@" for b in raw) / solid, sum(b >= 0x80 or chr(b).isalpha() for b in raw) / solid, sum(chr(x[-1]) in ".!?\"')" for x in lines) / len(lines), max(again, default=math.nan)]


def test_weak_labels(spark):
    """Votes and posteriors by expectation-maximisation over single rows, and the scorer's fit."""
    rnd = random.Random(9)
    words = "plain words make a text that reads well enough for all of us here and there now".split()
    docs = []
    for i in range(150):
        n = rnd.choice([1, 5, 40, 90])
        text = prose(rnd, words, n).capitalize() + "."
        if i % 6 == 0:
            text = (text[:20] + " ") * 12
        if i % 7 == 0:
            text = text.replace(" ", " #$ ")
        if i % 11 == 0:
            text = text.replace(" ", "\n")
        docs.append((i, text))
    docs += [(300, None), (301, "")]
    found = {r.doc_id: r for r in w.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    votes = {}
    for i, t in docs:
        mine = []
        for value, (_, bad, good, more) in zip(measures(t), w.LABELLERS, strict=True):
            sign = 1 if more else -1
            mine.append(1 if math.isnan(value) else 2 if sign * value >= sign * good else 0 if sign * value <= sign * bad else 1)
        votes[i] = mine
        assert found[i].n_votes == sum(v != 1 for v in mine)
    chance = [[[0.30, 0.20, 0.50], [0.02, 0.10, 0.88]] for _ in w.LABELLERS]
    share, good = 0.8, {}
    for _ in range(200):
        for i, mine in votes.items():
            p = [(share if y else 1 - share) * math.prod(chance[k][y][v] for k, v in enumerate(mine)) for y in (0, 1)]
            good[i] = p[1] / sum(p)
        for k in range(len(w.LABELLERS)):
            for y in (0, 1):
                counts = [1 + sum(good[i] if y else 1 - good[i] for i in votes if votes[i][k] == v) for v in range(3)]
                chance[k][y] = [c / sum(counts) for c in counts]
        share = (sum(good.values()) + 1) / (len(good) + 2)
    assert all(abs(found[i].posterior - good[i]) < 1e-6 for i in votes)
    place = order_of(spark, list(votes), 32)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in docs], pa.string())], names=["text"])
    x = {docs[k][0]: dict(zip(*(a.tolist() for a in w._features(words_, row, text)), strict=True)) for k, words_, row, text in w._each(batch)}
    model = Plain(1, 0.5, 0.001, 0.1)
    for _ in range(4):
        for i in sorted(votes, key=lambda i: place[i]):
            model.step(x[i], [good[i]])
    for i in votes:
        assert abs(found[i].score - shares(model.margins({**x[i], "constant": 1.0}))[0]) < 1e-3
