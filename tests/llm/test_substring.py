import random

from gridloom.llm import queries as q
from gridloom.llm import substring as s

from . import brute


def rows(frame):
    return sorted((tuple(r)[:4] for r in frame.collect()), key=str)


def made(seed=3):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ab cd ef gh é ij klm nop QR".split())
    passage = [word() for _ in range(130)]
    docs = [(1, None), (2, ""), (3, "few words"), (None, " ".join(passage)), (9, " ".join(passage)), (9, " ".join(passage)), (4, "\n".join(passage)), (4, "other text")]
    for i in range(10, 30):
        at, n = rnd.randrange(80), rnd.choice([49, 50, 51, 60, 120])
        docs.append((i, " ".join([*(word() for _ in range(rnd.randrange(30))), *passage[at : at + n], *(word() for _ in range(rnd.randrange(60)))])))
    docs.append((40, "la " * 300))
    docs.append((41, "x " + "la " * 60))
    return docs


def test_small_cases(spark):
    docs = made()
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_words string")
    found = s.summary(frame)
    assert rows(found) == sorted(brute.substring(docs), key=str)
    longest = {r.doc_id: r.longest for r in found.collect()}
    assert longest[9] is None and longest[4] in (100, None) and longest[41] == 50
    cleaned = s.clean(frame)
    assert cleaned.columns == frame.columns and cleaned.count() == len(docs)
    assert sorted(brute.sha(" ".join(brute.SPACED.findall(r.text or ""))) for r in cleaned.collect()) == sorted(r[3] for r in brute.substring(docs))


def test_empty(spark):
    assert s.summary(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    found = rows(q.op5_substring_dedup(spark, data))
    assert found == sorted(brute.substring(docs), key=str)
    assert any(r[2] for r in found)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_long_words_that_polynomials_confuse(spark):
    """Windows of 49 equal words and one long word whose letters are swapped aren't equal."""
    common, word = [f"w{i}" for i in range(49)], thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    docs = [(1, " ".join([*common, word])), (2, " ".join([*common, other])), (3, " ".join([*common, word, "end"])), (4, " ".join([word * 40, *common, other]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r[2] for r in sorted(rows(s.summary(frame)))] == [0, 0, 50, 50]
    assert rows(s.summary(frame)) == sorted(brute.substring(docs), key=str)


def test_equal_hashes_with_other_guards_stay_apart():
    import numpy as np

    from gridloom.llm import meeting

    docs, owner, hashes, guards = np.array([4, 7, 9]), np.array([0, 1, 2, 1, 2]), np.array([5, 5, 5, 8, 5], dtype=np.uint64), np.array([1, 2, 1, 3, 2], dtype=np.uint64)
    values, kept, least, many, place = meeting.distinct(docs, owner, hashes, guards)
    assert values.tolist() == [5, 5, 8] and kept.tolist() == [1, 2, 3] and least.tolist() == [4, 7, 7]
    assert many.tolist() == [1, 1, 0] and place.tolist() == [0, 1, 0, 2, 1]
    assert meeting.distinct(docs, owner, hashes, None)[0].tolist() == [5, 8]


def test_group_of_copies_and_a_very_long_text(spark, monkeypatch):
    from gridloom.llm import hot

    monkeypatch.setattr(hot, "LEAST_ROWS", 5)
    rnd = random.Random(8)
    copy = " ".join(rnd.choice("abcdefgh") for _ in range(70))
    docs = [(i, copy) for i in range(10, 90)] + [(5, " ".join(rnd.choice("abcdefgh") for _ in range(60_000)) + " " + copy), (3, "z " + copy)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(s.summary(frame)) == sorted(brute.substring(docs), key=str)
