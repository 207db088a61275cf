import re

import corpus_pipeline
from gridloom.llm import language, secrets

from . import brute


def redacted(text):
    spans = [(a, b) for a, _, b, _ in brute.base_secrets(text)] + [(a, b) for a, _, b in brute.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED)]
    out, at = "", 0
    runs = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    for a, b in runs:
        out, at = out + text[at:a] + secrets.MARK, b
    return out + text[at:]


def test_stages_against_brute_force(spark, data):
    """The model of the first stage is the operator's own (its accuracy is tested elsewhere); the rest is plain Python."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    languages = {r.doc_id: r for r in language.identify(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if languages[r.doc_id].lang_pred != "und" and languages[r.doc_id].score >= 0.5]
    rows = [x for x, (i, n, c) in zip(rows, brute.jaccard(rows), strict=True) if not n or i == c]
    bench = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [x for x, hit in zip(rows, brute.decontaminate(rows, bench), strict=True) if not hit[5]]
    expected = {i: brute.SPACED.findall(redacted(t)) for i, t in rows}
    found = {}
    for r in sorted(corpus_pipeline.run(spark, data).collect(), key=lambda r: r.piece):
        assert r.n_tokens == len(brute.SPACED.findall(r.text))
        found.setdefault(r.doc_id, []).extend(brute.SPACED.findall(r.text))
    assert found == {i: ws for i, ws in expected.items() if ws}
    assert len(found) < docs.count()


def test_all_but_the_last_keep_the_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.dtypes == docs.dtypes
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_secrets_leave_the_texts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = [r.text for r in corpus_pipeline.secret_scan(spark, docs, data).collect()]
    assert not any(re.search("AKIA[A-Z0-9]{16}", t or "") for t in texts)
