import random

import numpy as np
import pytest

from gridloom.llm import jaccard as j
from gridloom.llm import queries as q
from gridloom.llm.components import connect

from . import brute


def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def made(seed=5):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ab cd ef gh é ij klm nop QR st uv".split())
    docs = [(1, None), (2, ""), (3, "few words"), (8, "FEW  words"), (None, "few words"), (5, "few"), (6, "some other few words"), (6, "some other few words")]
    for base in range(6):
        text = [word() for _ in range(rnd.choice([8, 40, 150]))]
        for copy in range(12):
            mine = list(text)
            for _ in range(rnd.randrange(4)):
                mine[rnd.randrange(len(mine))] = word()
            docs.append((100 + 20 * base + copy, " ".join(mine) + (" tail" if copy % 3 == 0 else "")))
    boiler = " ".join(word() for _ in range(30))
    docs += [(300 + i, f"{boiler} {' '.join(word() for _ in range(i))}") for i in range(25)]
    return docs


@pytest.mark.parametrize("spread", [20_000, 3])
def test_small_cases(spark, monkeypatch, spread):
    monkeypatch.setattr(j, "SPREAD", spread)
    docs = made()
    frame = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, key long")
    expected = brute.jaccard(docs)
    assert rows(j.link(frame)) == sorted(expected, key=str)
    kept = j.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id != 6) == sorted(str(i) for i, n, c in expected if (i == c or not n or i is None) and i != 6)


def test_one_row_of_each_group_is_kept(spark):
    long = " ".join(f"w{k}" for k in range(60))
    docs = [*made(), (None, "few words"), (None, "other few words here"), (6, "some other FEW words"), (400, long), (400, long + " more"), (401, long + " than"), (400, "not at all alike"), (402, "not at all alike"), (2, "")]
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in j.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=str)
    assert [t for i, t in kept if i == 6] == ["some other few words"]
    assert [t for i, t in kept if i is None] == ["few words", "other few words here"]
    assert sum(i in (400, 401, 402) and t.startswith("w0 ") for i, t in kept) == 1
    assert [i for i, t in kept if t == "not at all alike"] == [400]
    assert sum(not t for _, t in kept) == 3 and len({x for x in kept if x[1]}) == len([x for x in kept if x[1]])


def test_every_link_is_found(spark):
    docs = made()
    sets = sorted({(i, t, brute.shingle_set(t)) for i, t in docs if i is not None and brute.shingle_set(t)}, key=lambda d: d[:2])
    linked = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    counts = {(r.doc_id, r.n_shingles): (r.n_copies, r.n_links) for r in j.link_counts(frame).where("n_shingles > 0 and doc_id is not null").collect()}
    assert counts == {(i, len(x)): (sum(x == y for k, t2, y in sets if (k, t2) != (i, t)), sum(linked(x, y) for k, t2, y in sets if (k, t2) != (i, t))) for i, t, x in sets}
    classes = {}
    for i, _, x in sets:
        classes.setdefault(x, []).append(i)
    pairs = {tuple(sorted((min(a), min(b)))) for x, a in classes.items() for y, b in classes.items() if x != y and linked(x, y)}
    found = j.link_pairs(frame).collect()
    assert {tuple(sorted((r.doc_a, r.doc_b))) for r in found} == pairs and len(found) == len(pairs) > 25


def test_prefix_lemma():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        universe = rnd.integers(0, 2**63, 60).astype(np.uint64)
        df = dict(zip(universe.tolist(), rnd.choice([1, 1, 1, 2, 50, 4000], 60).tolist(), strict=True))
        base = rnd.choice(universe, rnd.integers(4, 50), replace=False)
        a = np.unique(np.concatenate([base, rnd.choice(universe, 4)]))
        b = np.unique(base[rnd.random(len(base)) < 0.95])
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        (pa, _, ma), (pb, _, mb) = (j.prefix(x, np.array([df[v] for v in x.tolist()]), (75, 100)) for x in (a, b))
        assert len(np.intersect1d(pa, pb)) >= min(ma, mb)


def test_bitmaps_bound_the_overlap():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        universe = rnd.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(rnd.choice(universe, rnd.integers(1, 300))) for _ in range(2))
        assert j.most_shared(len(a), j.bitmap(a), len(b), j.bitmap(b)) >= len(np.intersect1d(a, b))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (60, 55), (70, 70)], "a long, b long")
    found = {r.node: r.root for r in connect(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 50: 50, 55: 50, 60: 50}


def test_empty(spark):
    assert j.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    found = rows(q.op8_jaccard_join(spark, data))
    assert found == sorted(brute.jaccard(docs), key=str)
    assert any(r[0] != r[2] for r in found)


def test_long_words_that_polynomials_confuse(spark):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    docs = [(1, f"{word} q r s t"), (2, f"{word.translate(str.maketrans('ab', 'ba'))} q r s t"), (3, f"q {word * 3} r s t")]
    assert rows(j.link(spark.createDataFrame(docs, "doc_id long, text string"))) == sorted(brute.jaccard(docs), key=str)


def test_sets_that_get_one_key(spark, monkeypatch):
    """Keys of small sets are made to collide: sets are told apart by their words all the same."""
    key = j._key
    monkeypatch.setattr(j, "_key", lambda values: len(values) if len(values) < 5 else key(values))
    docs = [*made(), *((500 + i, f"{'abcd'[i % 4]} e") for i in range(12)), *((520 + i, f"a b c d e {'fgh'[i % 3]}") for i in range(6)), (530, "f a b c d e f a b c d e"), (531, "a b c d e f a b c d e f")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(j.link(frame)) == sorted(brute.jaccard(docs), key=str)


def test_links_compare_words(spark):
    """A link counts shingles by their words, whatever their hashes."""
    held = j._Held({1: b"a b c d e f", 2: b"a b c d e g"}, 5)
    assert not held.links(1, 2, (75, 100))
    assert held.links(1, 1, (75, 100))
    found, start, end, text = held.sets[2]
    held.sets[2] = held.sets[1][0], start, end, text  # as if every hash were equal
    assert not held.links(1, 2, (75, 100))


def test_groups_over_many_parts(spark, monkeypatch):
    from gridloom.llm import hot

    monkeypatch.setattr(hot, "LEAST_ROWS", 3)
    docs = [*made(7), *((600 + i, "one text that many documents hold") for i in range(60))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    expected = brute.jaccard(docs)
    assert rows(j.link(frame)) == sorted(expected, key=str)
    kept = sorted(str(r.doc_id) for r in j.keep_one(frame).collect() if r.doc_id != 6)
    assert kept == sorted(str(i) for i, n, c in expected if (i == c or not n or i is None) and i != 6)
