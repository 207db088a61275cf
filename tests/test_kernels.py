import itertools
import math

import numpy as np
import pytest

from gridloom.operators import conditions, kernels, rounds, selection


def test_exact_mann_whitney():
    rng = np.random.default_rng(0)
    for n, m in ((2, 3), (3, 3), (4, 5)):
        x, y = rng.normal(size=n), rng.normal(size=m)
        u, p = kernels.mann_whitney(x, y)
        both = np.concatenate([x, y])
        us = []
        for pick in itertools.combinations(range(n + m), n):
            a, b = both[list(pick)], np.delete(both, pick)
            us.append(sum((i > j) for i in a for j in b))
        far = max(u, n * m - u)
        assert math.isclose(u, sum((i > j) for i in x for j in y))
        assert math.isclose(p, min(1.0, 2 * np.mean([v >= far for v in us])))


def test_tied_mann_whitney():
    u, p = kernels.mann_whitney(np.array([1.0, 2, 2, 3]), np.array([2.0, 3, 4, 5]))
    assert u == 2.5 and 0.1 < p < 0.2
    assert kernels.mann_whitney(np.ones(3), np.ones(4))[1] == 1.0


def test_binomial_fit_has_the_closed_form_of_two_groups():
    y, n = np.array([3.0, 5, 2, 10, 12, 9]), np.array([20.0, 25, 18, 30, 32, 28])
    x = np.column_stack([np.ones(6), [0, 0, 0, 1, 1, 1]])
    beta, se, done = kernels.irls(x, y, "binomial", trials=n)
    a, b = y[:3].sum() / n[:3].sum(), y[3:].sum() / n[3:].sum()
    assert done and np.allclose(beta, [math.log(a / (1 - a)), math.log(b / (1 - b)) - math.log(a / (1 - a))])
    assert math.isclose(se[1], math.sqrt(sum(1 / v for v in (y[:3].sum(), n[:3].sum() - y[:3].sum(), y[3:].sum(), n[3:].sum() - y[3:].sum()))), rel_tol=1e-6)


def test_negative_binomial_recovers_the_ratio():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(4000), np.repeat([0, 1], 2000)])
    mu = np.exp(1.5 + 0.7 * x[:, 1])
    y = rng.negative_binomial(2, 2 / (2 + mu)).astype(float)
    beta, _, done = kernels.irls(x, y, "negbin", alpha=0.5)
    assert done and np.allclose(beta, [1.5, 0.7], atol=0.12)


def test_compaction_groups():
    edges, sizes = [("a", "b"), ("b", "c"), ("d", "e")], {"a": 5, "b": 5, "c": 5, "d": 30, "e": 1, "f": 2}
    assert selection.compact(edges, sizes) == {"d": "C00", "e": "C00", "a": "C01", "b": "C01", "c": "C01", "f": "C02"}
    assert selection.compact(edges, sizes, "cliques")["c"] != selection.compact(edges, sizes, "cliques")["b"]


def test_conditions():
    assert conditions.parse("A:B@C") == conditions.Condition(("A", "B"), "C")
    assert conditions.parse("A^B").interaction == "B"
    assert conditions.parse_contrast("x_vs_y") == ("x", "y") == conditions.parse_contrast("x vs y")
    for bad in ("A@", ":B", "^B"):
        with pytest.raises(ValueError):
            conditions.parse(bad)
    for bad in ("x", "x_vs_", "x_vs_x"):
        with pytest.raises(ValueError):
            conditions.parse_contrast(bad)


def test_round_names():
    assert rounds.run_namespace("de", "r0", ["de_r0_round1"]) == "de_r0_round2"
    assert rounds.resolve_group_key(["x", "batch"]) == "batch"
    with pytest.raises(KeyError):
        rounds.resolve_group_key(["x"])


def test_silhouette_and_neighbours(spark):
    rng = np.random.default_rng(2)
    points = [(k, k % 2, [float(v) for v in rng.normal(size=3) + 4 * (k % 2)]) for k in range(40)]
    frame = spark.createDataFrame(points, "cell_id long, label long, vec array<double>")
    found = {r.cell_id: r.silhouette for r in kernels.silhouette(frame, frame, "label").collect()}
    x, lab = np.array([p[2] for p in points]), np.array([p[1] for p in points])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for k in range(40):
        a = d[k][lab == lab[k]].sum() / ((lab == lab[k]).sum() - 1)
        b = d[k][lab != lab[k]].mean()
        assert math.isclose(found[k], (b - a) / max(a, b), rel_tol=1e-9)
    near = kernels.nearest(frame, frame.limit(5), 4).collect()
    for q in {r.query for r in near}:
        assert [r.neighbour for r in sorted((r for r in near if r.query == q), key=lambda r: r.place)] == sorted(range(40), key=lambda j: (d[q, j], j))[:4]


def test_every_cell_has_a_silhouette(spark, data):
    from gridloom.plans.queries import QUERIES

    rng = np.random.default_rng(4)
    points, labels = np.round(rng.normal(size=(70, 3)), 1), np.append(rng.integers(0, 3, 69), 9)  # the last alone
    d = np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    expected = []
    for i in range(70):
        a = d[i, labels == labels[i]].sum() / max(1, (labels == labels[i]).sum() - 1)
        b = min(d[i, labels == k].mean() for k in set(labels) - {labels[i]})
        expected.append(0.0 if i == 69 else (b - a) / max(a, b))
    frame = spark.createDataFrame([(i, int(labels[i]), points[i].tolist()) for i in range(70)], "cell_id long, label long, vec array<double>")
    scored = kernels.silhouette(frame, frame, "label", rows=16)
    found = {r.cell_id: r.silhouette for r in scored.collect()}
    assert sorted(found) == list(range(70)) and np.allclose([found[i] for i in range(70)], expected)
    row = kernels.silhouette_summary(scored).first()
    assert row.n == 70 and np.allclose([row["mean"], row["median"], row.p10, row.p90], [np.mean(expected), np.median(expected), *np.percentile(expected, [10, 90])])
    assert QUERIES["cell_silhouette"](spark, data).count() == spark.read.parquet(f"{data}/embeddings.parquet").count()


def test_ligand_receptor_specificity_and_robust_ranks(spark, data):
    from gridloom.operators import communication as c
    from gridloom.plans.queries import QUERIES

    rng = np.random.default_rng(6)
    x, groups = rng.poisson(1.5, size=(40, 4)).astype(float), np.array(list("abc"))[rng.integers(0, 3, 40)]
    layer = spark.createDataFrame([(i, f"g{g}", float(x[i, g])) for i in range(40) for g in range(4) if x[i, g]], "cell_id long, gene_id string, value double")
    obs = spark.createDataFrame([(i, str(groups[i])) for i in range(40)], "cell_id long, grp string")
    pairs = spark.createDataFrame([("g0", "g1"), ("g2", "g3")], "ligand string, receptor string")
    scores = c.specificities(c.pair_scores(layer, obs, "grp", pairs), layer, obs, "grp", pairs)
    scores = c.permuted_pvals(scores, layer, obs, "grp", pairs, n_perms=200).cache()
    rows = scores.collect()
    names, codes = np.unique(groups, return_inverse=True)
    perms = [np.random.default_rng([42, p]).permutation(codes) for p in range(200)]
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    for r in rows:
        a, b, l, m = list(names).index(r.source), list(names).index(r.target), int(r.ligand[1]), int(r.receptor[1])
        fc = lambda k, g: np.log2(x[codes == k, g].mean() + 1) - np.log2(x[codes != k, g].mean() + 1)
        drawn = [(x[p == a, l].mean() + x[p == b, m].mean()) / 2 for p in perms]
        assert np.isclose(r.cellphone_pvals, np.mean(np.array(drawn) >= r.lr_means - 1e-9))
        assert np.isclose(r.scaled_weight, (z[codes == a, l].mean() + z[codes == b, m].mean()) / 2)
        assert np.isclose(r.lr_logfc, (fc(a, l) + fc(b, m)) / 2)
    assert len(rows) == 18

    def rho(columns):
        ranks = []
        for name, up in columns:
            v = np.array([round(r[name], 9) * (1 if up else -1) for r in rows])
            ranks.append([((v < e).sum() + (v <= e).sum() + 1) / 2 / len(v) for e in v])
        out = []
        for u in np.sort(np.array(ranks).T, axis=1):
            k = len(u)
            out.append(min(1.0, k * min(sum(math.comb(k, j) * u[i] ** j * (1 - u[i]) ** (k - j) for j in range(i + 1, k + 1)) for i in range(k))))
        return out

    found = {tuple(r[e] for e in c.EVENT): (r.magnitude_rank, r.specificity_rank) for r in c.robust_ranks(scores).collect()}
    expected = zip(rho([("lr_means", False), ("expr_prod", False), ("lrscore", False)]), rho([("cellphone_pvals", True), ("spec_weight", False), ("lr_logfc", False)]), strict=True)
    for r, e in zip(rows, expected, strict=True):
        assert np.allclose(found[tuple(r[k] for k in c.EVENT)], e)
    assert QUERIES["robust_rank_aggregate"](spark, data).count() == QUERIES["ligand_receptor"](spark, data).count()
