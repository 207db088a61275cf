import itertools
import random

import numpy as np

from gridloom.llm import packing as p
from gridloom.llm import queries as q

from . import brute


def padding(lengths, counts, tops):
    return sum(c * (min(t for t in tops if t >= x) - x) for x, c in zip(lengths, counts, strict=True))


def test_borders_are_optimal():
    rnd = random.Random(4)
    for _ in range(60):
        lengths = sorted(rnd.sample(range(1, 60), rnd.randrange(1, 9)))
        counts = [rnd.randrange(1, 9) for _ in lengths]
        for k in (1, 2, 3, 4):
            best = min(padding(lengths, counts, [*some, lengths[-1]]) for some in itertools.combinations(lengths[:-1], min(k - 1, len(lengths) - 1)))
            tops = p.borders(np.array(lengths), np.array(counts), k)
            assert len(tops) <= k and tops[-1] == lengths[-1]
            assert padding(lengths, counts, tops) == best
    assert p.borders(np.zeros(0, dtype=int), np.zeros(0, dtype=int), 3) == []


def check(rows, docs, max_length, budget, buckets):
    whole = {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
        assert 0 < r.n_tokens <= r.bucket_len <= max_length
    for i, t in docs:
        n = len(brute.SPACED.findall(t or ""))
        held = sorted(whole.get(i, []))
        assert sum(x for _, x in held) == n * sum(1 for j, _ in docs if j == i)
    assert len({r.bucket_len for r in rows}) <= buckets
    batches = {}
    for r in rows:
        batches.setdefault(r.batch, []).append(r)
    for held in batches.values():
        assert len({r.bucket_len for r in held}) == 1 and len(held) * held[0].bucket_len <= budget
        assert sorted(r.slot for r in held) == list(range(len(held)))


def test_small_cases(spark, monkeypatch):
    monkeypatch.setattr(p, "GROUP", 7)
    rnd = random.Random(1)
    docs = [(k, "w " * rnd.randrange(0, 60)) for k in range(80)] + [(100, None), (101, ""), (None, "a b"), (102, "x y z"), (102, "x y z"), (103, "w " * 1000)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, piece int")
    rows = p.pack(frame, buckets=4, max_length=32, budget=100).collect()
    check(rows, docs, 32, 100, 4)
    assert p.pack(frame.limit(0)).count() == 0
    kept = p.pack(frame, buckets=4, max_length=32, budget=100, keep_empty=True)
    assert kept.where("n_tokens = 0").count() == sum(not brute.SPACED.findall(t or "") for _, t in docs)


def test_vocabulary(spark):
    import public_tokenizers

    frame = spark.createDataFrame([(1, "hello <|endoftext|> world"), (2, None)], "doc_id long, text string")
    rows = p.pack(frame, vocabulary=public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert [r.doc_id for r in rows] == [1] and rows[0].n_tokens > 3


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    rows = q.op1_packing(spark, data).collect()
    check(rows, docs, 2048, 32_768, 16)
    lengths, counts = np.unique([r.n_tokens for r in rows], return_counts=True)
    assert sorted({r.bucket_len for r in rows}) == p.borders(lengths, counts, 16)


def test_pieces_carry_their_texts(spark):
    rnd = random.Random(2)
    docs = [(k, " ".join(rnd.choice(["a", "é", "word\n", "\tx"]) for _ in range(n))) for k, n in enumerate((0, 1, 31, 32, 33, 200))] + [(9, None), (10, "\n lead and trail \t" * 40)]
    frame = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, slot string")
    for vocabulary in (None, __import__("public_tokenizers").path("byte_bpe_50k.json")):
        rows = p.pack(frame, buckets=4, max_length=32, budget=100, texts=True, vocabulary=vocabulary).collect()
        assert p.pack(frame, buckets=4, max_length=32, budget=100, vocabulary=vocabulary).count() == len(rows)
        for i, t in docs:
            mine = sorted((r.piece, r.n_tokens, r.text) for r in rows if r.doc_id == i)
            if vocabulary is None:
                assert [w for _, _, x in mine for w in brute.SPACED.findall(x)] == brute.SPACED.findall(t or "")
                assert all(len(brute.SPACED.findall(x)) == n for _, n, x in mine)
            else:
                assert "".join(x for _, _, x in mine) == (t or "")
