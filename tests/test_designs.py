"""Gene filters, linear activities, composition tests, compaction and samples held against plain computations."""

import itertools
import math

import numpy as np
import pytest

from gridloom.operators import composition, enrichment, genes, kernels, merge, ranking, rounds, selection


def test_filter_entries():
    assert genes.expressions(["expr=gene_type == 'x';condition_key=sex", "chrom != 'MT'", "", "cond=sex", "a == 1;expr=b == 2"]) == ["gene_type == 'x'", "chrom != 'MT'", "b == 2"]
    assert genes.columns_of("gene_type in ['a', 'b'] and not (chrom == 'MT' or n >= 3)") == {"gene_type", "chrom", "n"}


@pytest.fixture(scope="module")
def var(spark):
    return spark.createDataFrame([("MT-A", "protein-coding", 1.0, "MT"), ("LINC1", "lincRNA", 2.0, "1"), ("B", "Protein_Coding", 3.0, None), ("C", None, 4.0, "X")], "gene_id string, biotype string, n double, chrom string")


@pytest.mark.parametrize("text, kept", [
    ("biotype == 'protein-coding'", ["B", "MT-A"]), ("biotype == 'protein_coding' and n > 1", ["B"]), ("biotype not in ['lincrna']", ["B", "C", "MT-A"]),
    ("chrom not_in ('MT', 'X')", ["B", "LINC1"]), ("chrom != 'MT'", ["B", "C", "LINC1"]), ("not (n >= 2 and n <= 3) or gene_id == \"B\"", ["B", "C", "MT-A"]), ("~(n < 2) & (chrom == 'X' | chrom == '1')", ["C", "LINC1"]), ("n == -1.5", []),
])
def test_filter_predicates(var, text, kept):
    assert sorted(r.gene_id for r in var.where(genes.predicate(text)).collect()) == kept


@pytest.mark.parametrize("text", ["n ==", "n = 1", "(n > 1", "n > 1)", "n in 3", "__import__('os').system('x')", "n > 1; drop"])
def test_filters_that_cannot_be_read(var, text):
    with pytest.raises(ValueError):
        genes.predicate(text)


def test_gene_metadata_is_resolved(spark, var):
    plain = var.select("gene_id")
    assert {r.gene_id: r.gene_type for r in genes.resolve_metadata(plain, {"gene_type"}).collect()} == {"MT-A": "Mt", "LINC1": "lincRNA", "B": "protein_coding", "C": "protein_coding"}
    assert {r.gene_id: r.gene_type for r in genes.resolve_metadata(plain, {"gene_type"}, var).collect()}["LINC1"] == "lincRNA"
    assert "chromosome" in genes.resolve_metadata(var, {"chromosome", "gene"}).columns
    with pytest.raises(ValueError):
        genes.resolve_metadata(plain, {"chromosome"})
    kept = genes.filter_genes(var, ["expr=gene_type == 'protein-coding'", "n > 1"])
    assert [r.gene_id for r in kept.collect()] == ["B"]
    assert tuple(genes.filter_report(var, kept).first()) == (4, 1)


def test_multivariate_is_least_squares(spark):
    rng = np.random.default_rng(2)
    names, groups = [f"g{k}" for k in range(30)], {"a": rng.normal(size=30), "b": rng.normal(size=30)}
    weights = {s: {k: float(rng.normal()) for k in rng.choice(30, 8, replace=False).tolist()} for s in ("x", "y", "z")}
    matrix = spark.createDataFrame([(c, names[k], float(v[k])) for c, v in groups.items() for k in range(30)], "cell string, gene_id string, value double")
    net = spark.createDataFrame([(s, names[k], w) for s, of in weights.items() for k, w in of.items()] + [("x", "unknown", 1.0)], "source string, target string, weight double")
    found = {(r.cell, r.source): r.score for r in enrichment.multivariate(matrix, net, "cell").collect()}
    x = np.column_stack([np.ones(30), *([weights[s].get(k, 0.0) for k in range(30)] for s in ("x", "y", "z"))])
    for c, y in groups.items():
        beta, rest, *_ = np.linalg.lstsq(x, y, rcond=None)
        se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * rest[0] / 26)
        for k, s in enumerate(("x", "y", "z"), start=1):
            assert math.isclose(found[c, s], beta[k] / se[k], rel_tol=1e-6)


def test_nets_are_oriented(spark):
    genes_ = spark.createDataFrame([("a",), ("b",)], "gene_id string")
    net = spark.createDataFrame([("a", "t", 1.0), ("b", "t", 2.0)], "source string, target string, weight double")
    turned = enrichment.oriented(net, genes_)
    assert {tuple(r) for r in turned.collect()} == {("t", "a", 1.0), ("t", "b", 2.0)}
    assert enrichment.oriented(turned, genes_) is turned


def test_log_ratios_of_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(f"{level}{k}", cluster, level, int(rng.integers(0, 30))) for level in "uvw" for k in range(4) for cluster in "ABC"]
    table = spark.createDataFrame(rows, "sample string, cluster string, level string, n long")
    found = {(r.cluster, r.level_ref, r.level_test): r for r in composition.clr_mann_whitney(table, "sample", "cluster", "level").collect()}
    total = {s: sum(n for t, _, _, n in rows if t == s) for s, *_ in rows}
    share = {(s, c): n / total[s] for s, c, _, n in rows}
    clr = {(s, c): math.log(v + 1e-6) - np.mean([math.log(share[s, d] + 1e-6) for d in "ABC"]) for (s, c), v in share.items()}
    assert set(found) == {(c, a, b) for c in "ABC" for a, b in itertools.combinations("uvw", 2)}
    for (c, a, b), r in found.items():
        x, y = ([clr[f"{level}{k}", c] for k in range(4)] for level in (a, b))
        assert math.isclose(r.clr_mean_ref, np.mean(x)) and math.isclose(r.clr_mean_test, np.mean(y))
        assert math.isclose(r.pval, kernels.mann_whitney(np.array(x), np.array(y))[1])
        assert math.isclose(r.log2fc, math.log2((np.mean([share[f"{b}{k}", c] for k in range(4)]) + 1e-6) / (np.mean([share[f"{a}{k}", c] for k in range(4)]) + 1e-6)))
        others = sorted((q.pval for k, q in found.items() if k[1:] == (a, b)), reverse=True)
        assert any(math.isclose(r.fdr, min(1.0, p * 3 / (3 - i)), rel_tol=1e-9) for i, p in enumerate(others))


def test_neighbourhoods_fall_back(spark):
    """Two samples are too few for the models, not for rank tests."""
    table = spark.createDataFrame([(s, f"s{k}", str(k % 2), n, 20) for s, ns in ((1, (3, 5)), (2, (6, 1))) for k, n in enumerate(ns)], "seed long, sample string, condition string, n long, total long")
    radius = spark.createDataFrame([(1, 0.5), (2, 2.0)], "seed long, radius double")
    found = composition.neighbourhood_test(table, radius, "sample", "0").collect()
    assert {(r.cluster, r.model, r.term) for r in found} == {("1", "clr", "0_vs_1"), ("2", "clr", "0_vs_1")}
    assert all(math.isclose(r.effect_shrunk, r.effect * r.n_nonzero_total / (r.n_nonzero_total + 10)) for r in found)


def test_compaction_needs_all_views(spark):
    labels = spark.createDataFrame([("A", "T", 5), ("B", "T", 9), ("C", "T ", 4), ("D", "unknown", 8), ("E", None, 2)], "cluster string, label string, n_cells long")
    alike = {("A", "B"): 0.95, ("A", "C"): 0.2, ("B", "C"): 0.95, ("A", "D"): 1.0, ("D", "E"): 1.0}
    rows = [(v, c, a, b, x if not (v == "regulator" and (a, b) == ("B", "C")) else 0.1) for v, c in (("pathway", ""), ("regulator", ""), ("sets", "HALLMARK"), ("sets", "other")) for (a, b), x in alike.items()]
    judged = selection.compaction_views(spark.createDataFrame(rows, "view string, collection string, a string, b string, cosine double"), labels)
    assert {(r.a, r.b): r.passes for r in judged.collect()} == {("A", "B"): True, ("A", "C"): False, ("B", "C"): False}
    assert {r.cluster: r.code for r in selection.compacted_round(judged, labels).collect()} == {"A": "C00", "B": "C00", "D": "C01", "C": "C02", "E": "C03"}


def test_communities_of_two_cliques(spark):
    edges = [(a, b, 1.0) for block in ((0, 1, 2, 3), (4, 5, 6, 7)) for a, b in itertools.combinations(block, 2)] + [(3, 4, 0.1)]
    found = {r.node: r.community for r in selection.label_propagation(spark.createDataFrame(edges, "a long, b long, weight double")).collect()}
    assert len({found[k] for k in range(4)}) == 1 and len({found[k] for k in range(4, 8)}) == 1 and found[0] != found[7]


def test_missing_clusters_are_an_error(spark):
    cells = spark.createDataFrame([(1, "C00: a"), (2, "C01: b")], "cell_id long, label string")
    with pytest.raises(ValueError, match="C07"):
        merge.subset_by_clusters(cells, spark.createDataFrame([("C00", "x"), ("C07", "x")], "code string, subset string"), "label")


def test_samples(spark):
    rows = spark.createDataFrame([(k, "ab"[k % 3 > 0], f"s{k % 5 // 2}") for k in range(60)], "cell_id long, level string, batch string")
    used, numbers = ranking.two_levels(rows, "level", "a", "b", 25)
    assert tuple(numbers.first()) == (20, 40, 20, 25, True) and used.count() == 45
    assert tuple(ranking.two_levels(rows, "level", "a", "b", 0)[1].first()) == (20, 40, 20, 40, False)
    for target in (2, 7, 31, 60, 90):
        found = ranking.proportional(rows, "batch", target)
        sizes = {r.batch: r["count"] for r in found.groupBy("batch").count().collect()}
        assert sum(sizes.values()) == min(target, 60) and all(abs(sizes.get(b, 0) - min(n, n * target / 60)) <= 1 for b, n in (("s0", 24), ("s1", 24), ("s2", 12)))
        assert target < 3 or len(sizes) == 3


def test_projection(spark):
    table = rounds.register(spark.createDataFrame([], "round_id string, parent_round_id string, round_type string, best_resolution double, active boolean"), "r3_x", None, "base", 0.5)
    labels = spark.createDataFrame([("r3_x", 1, "a")], "round_id string, cell_id long, cluster_id string")
    more, held, inputs = rounds.project(table, labels, "r3_x", "X_two")
    assert inputs.first().value == "X_two" and held.count() == 2
    assert [(r.round_id, r.active) for r in more.orderBy("round_id").collect()] == [("r3_x", False), ("r4_secondary_integration_projection", True)]
    with pytest.raises(KeyError):
        rounds.project(table, labels, "r9", "X_two")
    assert spark.range(1).select(rounds.stamp().alias("t")).first().t.endswith("Z")


def test_modules_at_once_are_those_one_by_one(spark):
    rng = np.random.default_rng(8)
    layer = spark.createDataFrame([(c, f"g{g}", float(rng.integers(1, 9))) for c in range(12) for g in range(30) if rng.random() < 0.6], "cell_id long, gene_id string, value double")
    obs = spark.range(13).withColumnRenamed("id", "cell_id")
    sets = {"a": ["g1", "g2", "g7"], "b": ["g2", "g20"], "none": ["x"]}
    found = {(r.cell_id, r.source): r.score for r in enrichment.module_scores(layer, obs, spark.createDataFrame([(s, g) for s, of in sets.items() for g in of], "source string, target string")).collect()}
    assert len(found) == 39 and all(found[c, "none"] == 0 for c in range(13))
    for name in ("a", "b"):
        for r in enrichment.module_score(layer, obs, sets[name]).collect():
            assert math.isclose(found[r.cell_id, name], r.score, abs_tol=1e-9)


def test_keys_and_refreshed_rounds(spark):
    assert merge.resolve_key(["cell_id", "sex"], "obs_names") == "cell_id" and merge.resolve_key(["index", "cell_id"], "index") == "index"
    with pytest.raises(KeyError):
        merge.resolve_key(["cell_id"], "sex")
    labels = spark.createDataFrame([("r0", k, "ab"[k > 2]) for k in range(9)], "round_id string, cell_id long, cluster_id string")
    kept, shown = rounds.refreshed(spark.createDataFrame([("r0",)], "round_id string"), labels, spark.createDataFrame([(0,), (1,), (8,)], "cell_id long"))
    assert kept.count() == 3 and [(r.display, r.n_cells) for r in shown.orderBy("cluster_rank").collect()] == [("C00: a", 2), ("C01: b", 1)]
