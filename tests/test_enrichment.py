"""Enrichment and paired effects held against hand-computed tables."""

import math

from gridloom.operators import enrichment, kernels, ranktests, tasks

STATS = [("c", "a", 3.0), ("c", "b", 2.0), ("c", "d", 1.0), ("c", "e", -1.0), ("z", "a", 0.0), ("z", "b", 0.0), ("z", "d", 0.0), ("z", "e", 0.0)]


def frames(spark):
    stats = spark.createDataFrame(STATS, "cluster string, gene_id string, stat double")
    net = spark.createDataFrame([*(("whole", g) for g in "abde"), ("top", "a"), ("top", "d"), ("low", "e"), ("low", "x")], "source string, target string")
    return stats, net


def test_a_set_that_covers_the_whole_list(spark):
    """Such a set, and one without any weight, has no running sum; the others have theirs."""
    stats, net = frames(spark)
    found = {(r.cluster, r.source): (r.size, round(r.es, 9)) for r in enrichment.running_sum(stats, net, "cluster", 1, 500).collect()}
    assert found == {("c", "top"): (2, 0.75), ("c", "low"): (1, -1.0)}
    sampled = {(r.cluster, r.source) for r in kernels.gsea(stats.where("cluster = 'c'"), net, "cluster", 20, 1).collect()}
    assert sampled == {("c", "top"), ("c", "low")}


def test_sets_that_do_not_vary_have_no_slope(spark):
    matrix = spark.createDataFrame([(g, c, v) for g, values in {"x": (1.0, 2.0, 4.0, 3.0), "flat": (5.0,) * 4}.items() for c, v in zip("abde", values)], "cell string, gene_id string, value double")
    net = spark.createDataFrame([*(("all", g, 1.0) for g in "abde"), ("two", "a", 1.0), ("two", "b", -1.0)], "source string, target string, weight double")
    found = {(r.cell, r.source): r.score for r in enrichment.univariate(matrix, net, "cell").collect()}
    r = -1 / math.sqrt(2 * 5)  # weights 1, -1, 0, 0 against 1, 2, 4, 3
    assert list(found) == [("x", "two")] and math.isclose(found["x", "two"], r * math.sqrt(2 / (1 - r * r)))


def test_groups_without_spread(spark):
    """No cell's value varies: no t, and nothing fails."""
    layer = spark.createDataFrame([(k, "g", 1.0) for k in range(4)], "cell_id long, gene_id string, value double")
    obs = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(4)], "cell_id long, side string")
    assert [r.t for r in ranktests.t_test(layer, obs, "side").collect()] == [None, None]


def test_paired_effects(spark):
    """Two groups of four against three samples, all of one above all of the other, and two too small ones."""
    rows = [("e1", "A", x) for x in (5.0, 6.0, 7.0, 8.0)] + [("e1", "B", x) for x in (1.0, 2.0, 3.0)]
    rows += [("e2", "A", x) for x in (1.0, 4.0, 2.0)] + [("e2", "B", x) for x in (3.0, 0.5, 5.0)] + [("e3", "A", 1.0), ("e3", "B", 2.0), ("e1", "C", 9.0), ("e4", "A", None), ("e4", "B", 1.0)]
    found = {r.event: r for r in tasks.paired_effects(spark.createDataFrame(rows, "event string, side string, score double"), ["event"], "side", "score", "A", "B").collect()}
    assert set(found) == {"e1", "e2"}
    first = found["e1"]
    assert (first.n_a, first.n_b, first.mean_a, first.mean_b, first.median_a, first.median_b, first.delta, first.u) == (4, 3, 6.5, 2.0, 6.5, 2.0, 4.5, 12.0)
    assert math.isclose(first.pval, 2 / 35) and math.isclose(first.padj, 4 / 35)  # one order of 35 on either side
    assert found["e2"].u == 4.0 and math.isclose(found["e2"].pval, 1.0) and found["e2"].padj == 1.0


def test_ranks_over_many_parts(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from gridloom.functions.columns import ranked

    rows = spark.range(500).select("id", F.when(F.col("id") % 50 == 7, None).otherwise((F.col("id") * 37 % 91).cast("double")).alias("x"))
    every = Window.partitionBy(F.lit(0)).orderBy(F.col("x").asc_nulls_last())
    want = {r.id: (r.a, r.b) for r in rows.select("id", F.rank().over(every).alias("a"), F.dense_rank().over(every).alias("b")).collect()}
    got = {r.id: (r.a, r.b) for r in ranked(rows, (F.col("x"), "a", False), (F.col("x"), "b", True), parts=8).collect()}
    assert got == want
    assert ranked(rows.limit(0), (F.col("x"), "a", False)).count() == 0
    one = rows.select("id", F.lit(1.0).alias("x"))
    assert {r.a for r in ranked(one, (F.col("x"), "a", False)).collect()} == {1}
