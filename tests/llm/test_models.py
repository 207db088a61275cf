import zlib

import numpy as np

from gridloom.llm import language, linear, toxicity
from gridloom.llm import queries as q

MID = "/root/testdata/sf0.01"


def test_ftrl_learns_and_prunes():
    rnd = np.random.default_rng(0)
    learner = linear.Ftrl(50, 1, l1=0.5)
    for _ in range(3000):
        x = rnd.integers(0, 2, 50)
        learner.step(np.flatnonzero(x), np.ones(int(x.sum())), np.array([float(x[3])]))
    w = learner.weights()[:-1, 0]
    assert w[3] > 1.5 and np.abs(np.delete(w, 3)).max() < 0.5 and (w == 0).any()


def test_language_held_out_accuracy(spark):
    found = {r.doc_id: r for r in q.op6_language_id(spark, MID).collect()}
    docs = spark.read.parquet(f"{MID}/documents.parquet").collect()
    assert len(found) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(found[r.doc_id].held_out == (r in held) for r in docs)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held if r.lang]) > 0.98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_cases(spark):
    docs = [(k, "le chat est dans la maison et il dort bien " * 3, "fr", 1) for k in range(20)] + [(k, "the cat is in the house and it sleeps well " * 3, "en", 1) for k in range(20, 40)]
    docs += [(90, None, "fr", 1), (91, "", "fr", 1), (92, "12 !? 34", "fr", 1), (93, "the house is well", None, 1), (None, "dans la maison", "xx", 1), (94, "la maison", "fr", 1), (94, "la maison", "fr", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score int")
    found = {r.doc_id: r.lang_pred for r in language.identify(frame).collect()}
    assert (found[90], found[91], found[92], found[93], found[None]) == ("und", "und", "und", "en", "fr")
    assert language.identify(frame.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify(frame.withColumn("lang", frame.lang.substr(9, 1))).limit(99).collect()} - {"und", ""} == set()
    kept = language.keep_known(frame)
    assert kept.columns == frame.columns and kept.count() == 44


def test_toxicity_held_out(spark):
    large = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in q.op3_toxicity(spark, large).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out for i in held)
    toxic = [found[i].score for i in held if truth[i]]
    clean = [found[i].score for i in held if not truth[i]]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.98
    assert np.mean([s >= 0.5 for s in toxic]) > 0.8 and np.mean([s < 0.5 for s in clean]) > 0.99
    assert all(r.predicted == int(r.score >= 0.5) for r in found.values())


def test_toxicity_cases(spark):
    docs = [(k, f"what a lovely day number {k} it is", 1) for k in range(30)] + [(k, f"you worthless idiot number {k} go away", 1) for k in range(30, 60)] + [(70, None, 1), (71, "", 1), (None, "worthless idiot", 1), (72, "an idiot, worthless", 1), (72, "an idiot, worthless", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, held_out int")
    labels = spark.createDataFrame([(k, int(k >= 30), "x") for k in range(60)] + [(None, 1, "x"), (70, None, "x"), (5, 0, "x"), (999, 1, "x")], "doc_id long, toxic int, text string")
    found = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    assert found[72].predicted == 1 and found[None].predicted == 1 and found[3].predicted == 0 and found[70].score == found[71].score
    assert toxicity.score(frame.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score(frame, labels.limit(0)).collect()} == {0.0}
