"""Negative binomial tests against closed forms and independent fits."""

import math

import numpy as np
import pytest

from gridloom.operators import kernels, nbtests

RNG = np.random.default_rng(5)


def test_log_gamma():
    x = np.array([1e-3, 0.1, 0.5, 1, 2.5, 10, 1e3, 1e7])
    assert np.allclose(nbtests.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def test_batched_fit_is_the_single_fit():
    x = np.column_stack([np.ones(12), np.arange(12) % 2, (np.arange(12) // 4 == 1)]).astype(float)
    offset = RNG.normal(0, 0.2, 12)
    y = RNG.poisson(np.exp(1 + x[:, 1] + offset), (6, 12)).astype(float)
    alpha = np.linspace(0.05, 1.0, 6)
    beta, cov, _, done = nbtests.fit(x, y, offset, alpha)
    assert done.all()
    for k in range(6):
        single, se, _ = kernels.irls(x, y[k], "negbin", offset=offset, alpha=float(alpha[k]))
        assert np.allclose(beta[k], single, atol=1e-6) and np.allclose(np.sqrt(np.diag(cov[k])), se, atol=1e-5)


def test_dispersions_maximise_the_likelihood():
    n, size = 60, 1 / 0.3
    x = np.column_stack([np.ones(n), np.arange(n) % 2]).astype(float)
    mean = np.exp(3 + 0.5 * x[:, 1])
    y = RNG.negative_binomial(size, size / (size + mean), (40, n)).astype(float)
    mu = nbtests.fit(x, y, np.zeros(n), np.full(40, 0.3))[2]
    found = nbtests.dispersions(x, y, mu)
    assert abs(np.median(found) - 0.3) < 0.06
    for k in (0, 7):
        grid = np.linspace(-6, 2, 4001)
        best = grid[int(np.argmax([nbtests.adjusted_likelihood(x, y[k : k + 1], mu[k : k + 1], np.array([g]))[0] for g in grid]))]
        assert abs(best - math.log(found[k])) < 3e-3
    drawn = nbtests.dispersions(x, y, mu, np.full(40, 0.05), 0.01)
    assert (np.abs(np.log(drawn / 0.05)) < np.abs(np.log(found / 0.05)) + 1e-6).all()


def test_trend():
    mean = np.exp(np.linspace(0, 8, 400))
    a0, a1, spread = nbtests.trend(mean, (0.1 + 2 / mean) * np.exp(RNG.normal(0, 0.3, 400)), 10)
    assert abs(a0 - 0.1) < 0.03 and abs(a1 - 2) < 0.5 and spread == 0.25


def test_matrices():
    y = np.array([0, 0, 1, 1.0])
    x, contrast = nbtests.model_matrix([np.array([0, 1, 0, 1.0]), np.array([1, 0, 1, 0.0])], [y])
    assert x.shape == (4, 3) and contrast.tolist() == [0, 0, 1]
    assert nbtests.model_matrix([y], [y]) is None and nbtests.model_matrix([], [np.array([0.0, 1.0])]) is None


@pytest.fixture(scope="module")
def world(spark):
    """Samples of four kinds (p or q, u or v), two clusters; library sizes are equal for genes but one."""
    cells, counts = [], []
    mean = {("p", "u"): 40, ("p", "v"): 80, ("q", "u"): 60, ("q", "v"): 30}
    cell = 0
    for k in range(16):
        one, two = "pq"[k % 2], "uv"[k // 2 % 2]
        for cluster in ("A", "B"):
            for half in (0, 1):
                cells.append((cell, f"s{k:02d}", cluster, one, two))
                counts += [(cell, f"g{g}", 50.0) for g in range(9)]
                counts.append((cell, "x", mean[one, two] + (k // 4) - 1.5 + (30 if cluster == "B" else 0)))
                cell += 1
    return spark.createDataFrame(cells, "cell_id long, sample string, cluster string, one string, two string"), spark.createDataFrame(counts, "cell_id long, gene_id string, value double")


def rows(frame, gene="x"):
    return {r.cluster: r for r in frame.where(f"gene_id = '{gene}'").collect()}


def test_interaction(world):
    """A saturated design of equal libraries fits the means of the four kinds."""
    obs, counts = world
    found = rows(nbtests.interaction(counts, obs, "sample", "cluster", ("one", "p", "q"), ("two", "u", "v"), buckets=2))
    assert math.isclose(found["A"].log2fc, math.log2(40 * 30 / (80 * 60)), abs_tol=1e-4)
    assert math.isclose(found["B"].log2fc, math.log2(70 * 60 / (110 * 90)), abs_tol=1e-4)
    assert found["A"].pval < 1e-4 and found["A"].padj >= found["A"].pval


def test_condition_within_cluster(world, spark):
    obs, counts = world
    pairs = spark.createDataFrame([("u", "v"), ("v", "u")], "a string, b string")
    found = nbtests.condition_within_cluster(counts, obs, "sample", "cluster", "two", pairs, buckets=2)
    assert found.count() == 2 * 2 * 10
    one = {(r.cluster, r.a): r for r in found.where("gene_id = 'x'").collect()}
    assert math.isclose(one["A", "u"].log2fc, math.log2((40 + 60) / (80 + 30)), abs_tol=1e-4)
    assert math.isclose(one["A", "v"].log2fc, -one["A", "u"].log2fc, abs_tol=1e-6) and math.isclose(one["A", "v"].pval, one["A", "u"].pval, rel_tol=1e-4)
    with_factor = {(r.cluster, r.a): r for r in nbtests.condition_within_cluster(counts, obs, "sample", "cluster", "two", pairs, covariates=("one",), buckets=2).where("gene_id = 'x'").collect()}
    assert with_factor["A", "u"].dispersion < one["A", "u"].dispersion + 1e-9


def test_cluster_versus_rest(world):
    """The same coefficient and error as a single fit on the written-out design with the same dispersion."""
    obs, counts = world
    found = rows(nbtests.cluster_versus_rest(counts, obs, "sample", "cluster", covariates=("one",), buckets=2))
    target, rest = [], []
    for k in range(16):
        base = {("p", "u"): 40, ("p", "v"): 80, ("q", "u"): 60, ("q", "v"): 30}["pq"[k % 2], "uv"[k // 2 % 2]] + k // 4 - 1.5
        target.append(2 * (base + 30))
        rest.append(2 * base)
    y = np.array([v for pair in zip(target, rest, strict=True) for v in pair])
    sample = np.repeat(np.arange(16), 2)
    x = np.column_stack([np.ones(32), *((sample == s).astype(float) for s in range(1, 16)), np.tile([1.0, 0.0], 16)])
    beta, se, _ = kernels.irls(x, y, "negbin", alpha=found["B"].dispersion)
    assert math.isclose(found["B"].log2fc, beta[-1] / math.log(2), abs_tol=1e-4)
    assert math.isclose(found["B"].lfc_se, se[-1] / math.log(2), rel_tol=1e-3)
    assert math.isclose(found["A"].log2fc, -found["B"].log2fc, abs_tol=1e-4)
    assert rows(nbtests.cluster_versus_rest(counts, obs, "sample", "cluster", positive_only=True, buckets=2)).keys() == {"B"}


def test_designs_that_tell_nothing(world, spark):
    obs, counts = world
    assert nbtests.interaction(counts, obs.where("two = 'u'"), "sample", "cluster", ("one", "p", "q"), ("two", "u", "v"), buckets=2).count() == 0
    assert nbtests.cluster_versus_rest(counts.limit(0), obs, "sample", "cluster", buckets=2).count() == 0
