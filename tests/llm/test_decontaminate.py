import pytest

from gridloom.llm import decontaminate as d
from gridloom.llm import queries as q

from . import brute


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short item"), (3, None), (4, "..."), (10, "short ITEM"), (None, "without an id")]
DOCS = [
    (1, "x ALPHA, beta gamma-delta epsilon zeta eta theta iota kappa lambda y", "a"),
    (2, None, None), (3, "", "b"), (4, "a short item here; short item", "c"), (4, "a short item here; short item", "c"),
    (None, "nothing of note", "d"), (6, "beta gamma delta epsilon zeta eta theta iota kappa é " * 300, "e"), (7, "alpha beta gamma", "f"),
    (8, "words WITHOUT an id, of no item", "g"),
]


def frames(spark, docs=DOCS, bench=BENCH):
    return (spark.createDataFrame(docs, "doc_id long, text string, n_words string"), spark.createDataFrame(bench, "item_id long, text string"))


def digest(found):
    return found.selectExpr("doc_id", "n_words", "n_hit", "cast(size(items) as bigint)", "sha2(array_join(items, ','), 256)", "n_hit > 0")


def test_small_cases(spark):
    docs, bench = frames(spark)
    expected = sorted(brute.decontaminate([r[:2] for r in DOCS], BENCH), key=str)
    assert rows(digest(d.scan(docs, bench))) == expected
    assert rows(digest(d.scan(docs, bench, max_broadcast_windows=1))) == expected  # a pass per item


def test_empty_tables(spark):
    docs, bench = frames(spark)
    assert d.scan(docs.limit(0), bench).count() == 0
    assert d.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert d.decontaminate(docs, bench.limit(0)).count() == len(DOCS)


def test_actions(spark):
    docs, bench = frames(spark)
    kept = d.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "6", "7", "None"]
    cut = {r.doc_id: r.text for r in d.decontaminate(docs, bench, action="cut").collect()}
    assert cut[1] == "x  y" and cut[4] == "a  here; " and cut[2] is None


@pytest.mark.parametrize("bound", [1, 40, 4_000_000])
def test_the_bound_changes_nothing(spark, bound):
    """Windows that overlap in a text are cut at once, however the benchmark is split."""
    word = [f"k{i}" for i in range(30)]
    bench = [(1, " ".join(word[5:15])), (2, " ".join(word[10:20])), (3, "Short item"), (4, " ".join(f"m{i}" for i in range(18)))]
    docs = [(1, " ".join(word), "x"), (2, "a short item, a k1", None), (3, None, "y"), (4, " ".join(f"m{i}" for i in range(3, 17)) + " end", "z")]
    frames = spark.createDataFrame(docs, "doc_id long, text string, items string"), spark.createDataFrame(bench, "item_id long, text string")
    cut = d.decontaminate(*frames, action="cut", max_broadcast_windows=bound)
    assert cut.columns == ["doc_id", "text", "items"]
    assert {r.doc_id: (r.text, r["items"]) for r in cut.collect()} == {1: ("k0 k1 k2 k3 k4  " + " ".join(word[20:]), "x"), 2: ("a , a k1", None), 3: (None, "y"), 4: (" end", "z")}
    assert rows(digest(d.scan(*frames, max_broadcast_windows=bound))) == sorted(brute.decontaminate([r[:2] for r in docs], bench), key=str)
    assert [r.doc_id for r in d.decontaminate(*frames, max_broadcast_windows=bound).collect()] == [3]


def test_windows_with_one_hash():
    """Different windows with equal hashes are told apart by their words."""
    import numpy as np

    text = b"ab cd ab cd ef"
    start = np.array([0, 3, 6, 9, 12])
    found = d._Windows(1, text, np.full(5, 7, dtype=np.uint64), start, start + 2, np.array([0, 0, 1, 2, 2]))
    assert [text[a:b] for a, b in zip(found.start, found.end)] == [b"ab", b"cd", b"ef"]
    assert [found.items[a:b].tolist() for a, b in zip(found.border, found.border[1:])] == [[0, 1], [0, 2], [2]]


def test_query_against_brute_force(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    found = rows(q.op9_decontamination(spark, data))
    assert found == sorted(brute.decontaminate(docs, bench), key=str)
    assert any(r[5] for r in found)
