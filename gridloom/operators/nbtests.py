"""Negative binomial tests of genes over pseudobulk libraries: cluster against rest, condition within cluster, and the
interaction of two factors.

A *task* is one test of all genes (a cluster, or a cluster and a pair of levels). Counts are summed per library in
SQL before; all tasks are one plan with the task as a key. Genes are dealt to buckets; in a bucket all genes of a task
are fitted at once by batched linear algebra. Gene-wise dispersions maximise the Cox-Reid adjusted profile likelihood;
a trend a1 / mean + a0 over all genes of a task is their prior's centre, with the spread that the residuals leave, and
the posterior mode is used. Wald tests; size factors are median ratios with zeros as 1. There is no replacement of
outliers, no independent filtering and no shrinkage of effects.

Defined cases
    A task whose design leaves no residual degree of freedom, or can't tell the coefficient, has no rows. A gene without
    a count in a task has no row there. Null samples, clusters or levels take no part. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import benjamini_hochberg
from ..sources.lineage import materialise
from . import conditions
from .kernels import normal_sf2

LOW, HIGH = 1e-8, 10.0
_FIRST = "task string, gene_id string, y array<double>, base_mean double, gene_dispersion double"
_TREND = "task string, a0 double, a1 double, spread double"
_TEST = "task string, gene_id string, base_mean double, dispersion double, log2fc double, lfc_se double, stat double, pval double, converged boolean"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for positive values: Stirling's series of x + 8, taken back by the recurrence."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def fit(x: np.ndarray, y: np.ndarray, offset: np.ndarray, alpha: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, their covariances, means and convergence of many genes (rows of ``y``) with one design each with its
    dispersion, log link, by iteratively reweighted least squares."""
    beta = np.linalg.lstsq(x, (np.log(y + 0.5) - offset).T, rcond=None)[0].T
    done = np.zeros(len(y), dtype=bool)
    small = 1e-9 * np.eye(x.shape[1])
    for _ in range(rounds):
        mu = np.exp(np.clip(beta @ x.T + offset, -30, 30))
        weight = mu / (1 + alpha[:, None] * mu)
        target = np.clip(beta @ x.T, -30, 30) + (y - mu) / mu
        information = np.einsum("gn,np,nq->gpq", weight, x, x) + small
        new = np.linalg.solve(information, np.einsum("gn,np,gn->gp", weight, x, target)[:, :, None])[:, :, 0]
        new = beta + np.clip(new - beta, -5, 5)
        step = np.abs(new - beta).max(axis=1)
        beta = np.where(done[:, None], beta, new)
        done |= step < 1e-8
        if done.all():
            break
    mu = np.exp(np.clip(beta @ x.T + offset, -30, 30))
    weight = mu / (1 + alpha[:, None] * mu)
    return beta, np.linalg.inv(np.einsum("gn,np,nq->gpq", weight, x, x) + small), mu, done


def adjusted_likelihood(x: np.ndarray, y: np.ndarray, mu: np.ndarray, log_alpha: np.ndarray) -> np.ndarray:
    """Cox-Reid adjusted log likelihood of each gene's dispersion, but for a constant."""
    alpha = np.exp(log_alpha)[:, None]
    size = 1 / alpha
    value = (log_gamma(y + size) - log_gamma(np.broadcast_to(size, y.shape)) + y * np.log(alpha * mu / (1 + alpha * mu)) - size * np.log1p(alpha * mu)).sum(axis=1)
    weight = mu / (1 + alpha * mu)
    return value - 0.5 * np.linalg.slogdet(np.einsum("gn,np,nq->gpq", weight, x, x) + 1e-12 * np.eye(x.shape[1]))[1]


def dispersions(x: np.ndarray, y: np.ndarray, mu: np.ndarray, centre: np.ndarray | None = None, spread: float = 1.0) -> np.ndarray:
    """Dispersions of greatest adjusted likelihood, with a normal prior of log values around ``centre`` if there is one:
    a grid, then golden sections beside its best point."""

    def value(at: np.ndarray) -> np.ndarray:
        prior = 0.0 if centre is None else (at - np.log(centre)) ** 2 / (2 * spread)
        return adjusted_likelihood(x, y, mu, at) - prior

    grid = np.linspace(math.log(LOW), math.log(HIGH), 25)
    best = np.argmax(np.stack([value(np.full(len(y), g)) for g in grid]), axis=0)
    low, high, part = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, len(grid) - 1)], (math.sqrt(5) - 1) / 2
    for _ in range(30):
        a, b = high - part * (high - low), low + part * (high - low)
        left = value(a) >= value(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return np.exp((low + high) / 2)


def trend(mean: np.ndarray, dispersion: np.ndarray, residual: int) -> tuple[float, float, float]:
    """(a0, a1, spread): dispersion about a1 / mean + a0 by least squares of relative errors, iterated without outliers,
    and the prior's variance of logs, what the residuals have beyond the estimates' own."""
    use = (dispersion > 100 * LOW) & (dispersion < HIGH * 0.99) & (mean > 0)
    if use.sum() < 3:
        return max(LOW, float(np.median(dispersion)) if len(dispersion) else LOW), 0.0, 1.0
    m, d = mean[use], dispersion[use]
    a0, a1 = float(np.median(d)), 0.0
    for _ in range(20):
        fitted = a0 + a1 / m
        ratio = d / fitted
        good = (ratio > 1e-4) & (ratio < 15)
        if good.sum() < 3:
            break
        design = np.column_stack([np.ones(good.sum()), 1 / m[good]]) / fitted[good][:, None]
        new = np.linalg.lstsq(design, ratio[good], rcond=None)[0]
        if new[1] < 0 or new[0] <= 0:  # no trend of that form: a constant
            new = np.array([float(np.mean(d[good])), 0.0])
        if np.abs(new - [a0, a1]).max() < 1e-6 * max(1.0, abs(a0)):
            break
        a0, a1 = float(new[0]), float(new[1])
    error = np.log(d) - np.log(a0 + a1 / m)
    mad = 1.4826 * float(np.median(np.abs(error - np.median(error))))
    half = max(residual, 1) / 2
    own = sum(1 / (half + k) ** 2 for k in range(2000)) + 1 / (half + 2000)  # trigamma
    return a0, a1, max(mad * mad - own, 0.25)


@dataclass
class Design:
    """One task: its libraries in order, their size factors, the model matrix and the contrast of its columns."""

    libraries: list[str]
    size: np.ndarray
    x: np.ndarray
    contrast: np.ndarray


def dummies(values: list) -> list[np.ndarray]:
    """Columns of the levels but the first."""
    text = np.array([str(v) for v in values])
    return [(text == level).astype(float) for level in sorted(set(text.tolist()))[1:]]


def model_matrix(columns: list[np.ndarray], tested: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """Matrix and contrast of the last tested column. Columns that follow from earlier ones are left out; None if a tested
    one does, or nothing is left to estimate a dispersion from."""
    kept = [np.ones(len(tested[-1]))]
    for k, column in enumerate([*columns, *tested]):
        if np.linalg.matrix_rank(np.column_stack([*kept, column])) > len(kept):
            kept.append(column)
        elif k >= len(columns):
            return None
    if len(tested[-1]) <= len(kept):
        return None
    return np.column_stack(kept), np.eye(len(kept))[-1]


def size_factors(counts: DataFrame) -> DataFrame:
    """Per (task, library) the median ratio to the genes' geometric means over the task's libraries, zeros as 1, scaled to
    a geometric mean of 1 in the task."""
    n = counts.groupBy("task").agg(F.countDistinct("library").alias("_n"))
    logs = counts.where("value > 0").withColumn("_l", F.log("value"))
    reference = logs.groupBy("task", "gene_id").agg(F.sum("_l").alias("_s")).join(n, "task").select("task", "gene_id", (F.col("_s") / F.col("_n")).alias("_ref"))
    raw = logs.join(reference, ["task", "gene_id"]).groupBy("task", "library").agg(F.median(F.col("_l") - F.col("_ref")).alias("_f"))
    centre = raw.groupBy("task").agg(F.avg("_f").alias("_m"))
    return raw.join(centre, "task").select("task", "library", F.exp(F.col("_f") - F.col("_m")).alias("size_factor"))


def wald(counts: DataFrame, designs: dict[str, Design], buckets: int = 64) -> DataFrame:
    """Per (task, gene): base mean, dispersion, log2 fold change of the contrast, its error, z and p, and padj by task.
    ``counts`` has (task, library, gene_id, value)."""
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(designs)

    def first(part: pd.DataFrame) -> pd.DataFrame:
        task = str(part["task"].iloc[0])
        of = shared.value[task]
        place = {name: k for k, name in enumerate(of.libraries)}
        genes, code = np.unique(part["gene_id"].to_numpy(dtype=str), return_inverse=True)
        at = np.array([place.get(x, -1) for x in part["library"]])
        y = np.zeros((len(genes), len(place)))
        np.add.at(y, (code[at >= 0], at[at >= 0]), part["value"].to_numpy(dtype=float)[at >= 0])
        some = y.sum(axis=1) > 0
        genes, y = genes[some], y[some]
        if not len(genes):
            return pd.DataFrame(columns=["task", "gene_id", "y", "base_mean", "gene_dispersion"])
        scaled = y / of.size
        mean = scaled.mean(axis=1)
        rough = np.clip((scaled.var(axis=1, ddof=1) - mean * np.mean(1 / of.size)) / mean**2, 1e-3, HIGH)
        mu = fit(of.x, y, np.log(of.size), rough)[2]
        return pd.DataFrame({"task": task, "gene_id": genes, "y": list(y), "base_mean": mean, "gene_dispersion": dispersions(of.x, y, mu)})

    def curve(part: pd.DataFrame) -> pd.DataFrame:
        task = str(part["task"].iloc[0])
        x = shared.value[task].x
        return pd.DataFrame([[task, *trend(part["base_mean"].to_numpy(), part["gene_dispersion"].to_numpy(), x.shape[0] - x.shape[1])]], columns=["task", "a0", "a1", "spread"])

    def last(batches):
        for batch in batches:
            for task, part in batch.groupby("task"):
                of, y, mean = shared.value[str(task)], np.stack(part["y"].to_numpy()), part["base_mean"].to_numpy()
                offset = np.log(of.size)
                centre = part["a0"].to_numpy() + part["a1"].to_numpy() / mean
                mu = fit(of.x, y, offset, part["gene_dispersion"].to_numpy())[2]
                alpha = dispersions(of.x, y, mu, centre, float(part["spread"].iloc[0]))
                beta, cov, _, done = fit(of.x, y, offset, alpha)
                effect, error = beta @ of.contrast, np.sqrt(np.einsum("p,gpq,q->g", of.contrast, cov, of.contrast))
                z = effect / error
                yield pd.DataFrame({"task": task, "gene_id": part["gene_id"].to_numpy(), "base_mean": mean, "dispersion": alpha, "log2fc": effect / math.log(2), "lfc_se": error / math.log(2), "stat": z, "pval": [normal_sf2(v) for v in z], "converged": done})

    known = counts.where(F.col("task").isin(*designs)) if designs else counts.where("false")
    dealt = known.select("task", "library", "gene_id", F.col("value").cast("double").alias("value")).withColumn("_b", F.pmod(F.xxhash64("gene_id"), F.lit(buckets)))
    genes = materialise(dealt.groupBy("task", "_b").applyInPandas(lambda part: first(part), _FIRST))
    curves = genes.select("task", "base_mean", "gene_dispersion").groupBy("task").applyInPandas(curve, _TREND)
    tested = genes.join(F.broadcast(curves), "task").mapInPandas(last, _TEST)
    return benjamini_hochberg(tested, "pval", ("task",), tie=("gene_id",))


def _designs(libraries: DataFrame, counts: DataFrame, columns) -> dict[str, Design]:
    """``columns(rows of a task)`` gives (other columns, tested columns). Libraries, a dimension, come to the driver."""
    met = libraries.join(size_factors(counts), ["task", "library"]).toPandas()
    out: dict[str, Design] = {}
    for task, part in met.groupby("task"):
        part = part.sort_values("library").reset_index(drop=True)
        if (found := model_matrix(*columns(part))) is not None:
            out[str(task)] = Design(part["library"].tolist(), part["size_factor"].to_numpy(dtype=float), *found)
    return out


def _libraries(obs: DataFrame, sample: str, cluster: str, names: list[str]) -> DataFrame:
    """Pseudobulk libraries: task (the cluster), library, sample, cells, and a sample's first value of each name."""
    held = obs.where(F.col(sample).isNotNull() & F.col(cluster).isNotNull())
    firsts = [F.min(F.col(c).cast("string")).alias(c) for c in names]
    return held.groupBy(F.col(cluster).cast("string").alias("task"), F.col(sample).cast("string").alias("sample")).agg(F.count("*").alias("n_cells"), *firsts).withColumn("library", F.col("sample"))


def _summed(counts: DataFrame, obs: DataFrame, sample: str, cluster: str) -> DataFrame:
    cells = obs.select("cell_id", F.col(cluster).cast("string").alias("task"), F.col(sample).cast("string").alias("library")).where("task is not null and library is not null")
    return counts.join(cells, "cell_id").groupBy("task", "library", "gene_id").agg(F.sum("value").alias("value"))


def condition_within_cluster(counts: DataFrame, obs: DataFrame, sample: str, cluster: str, condition: str, pairs: DataFrame | None = None, *, covariates: tuple[str, ...] = (), least_cells: int = 1, buckets: int = 64) -> DataFrame:
    """Level a against b of a condition within every cluster, for all ``pairs`` (a, b); without any, every level against
    the most frequent one. Columns cluster, a, b and those of ``wald``."""
    pairs = conditions.versus_reference(obs, condition) if pairs is None else pairs
    pairs = pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    libs = _libraries(obs, sample, cluster, [condition, *covariates]).where(F.col("n_cells") >= least_cells)
    name = F.concat_ws("|", "task", "a", "b")
    tasks = libs.crossJoin(F.broadcast(pairs)).where((F.col(condition) == F.col("a")) | (F.col(condition) == F.col("b"))).withColumn("cluster", F.col("task")).withColumn("task", name)  # pairs are a few
    tasks = materialise(tasks)
    summed = _summed(counts, obs, sample, cluster).withColumnRenamed("task", "cluster")
    placed = materialise(summed.join(F.broadcast(tasks.select("cluster", "library", "task")), ["cluster", "library"]).select("task", "library", "gene_id", "value"))
    designs = _designs(tasks, placed, lambda part: ([c for k in covariates for c in dummies(part[k].tolist())], [(part[condition] == part["a"]).to_numpy(dtype=float)]))
    found = wald(placed, designs, buckets)
    names = F.broadcast(tasks.select("task", "cluster", "a", "b").distinct())
    return found.join(names, "task").drop("task")


def cluster_versus_rest(counts: DataFrame, obs: DataFrame, sample: str, cluster: str, *, covariates: tuple[str, ...] = (), least_cells: int = 1, positive_only: bool = False, buckets: int = 64) -> DataFrame:
    """Every cluster against all other cells of the same samples, each sample its own level of the design."""
    libs = materialise(_libraries(obs, sample, cluster, list(covariates)))
    every = libs.groupBy("sample").agg(F.sum("n_cells").alias("_all"))
    both = libs.join(every, "sample").where((F.col("n_cells") >= least_cells) & (F.col("_all") - F.col("n_cells") >= least_cells))
    sides = both.withColumn("side", F.explode(F.array(F.lit("target"), F.lit("rest")))).withColumn("library", F.concat_ws("|", "sample", "side"))
    sides = materialise(sides.drop("_all", "n_cells"))
    summed = materialise(_summed(counts, obs, sample, cluster).withColumnRenamed("library", "sample"))
    total = summed.groupBy("sample", "gene_id").agg(F.sum("value").alias("_t"))
    tasks = F.broadcast(sides.select("task", "sample").distinct())  # clusters by samples
    met = total.join(tasks, "sample").join(summed, ["task", "sample", "gene_id"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    long = met.select("task", "sample", "gene_id", F.explode(F.array(F.struct(F.lit("target").alias("side"), F.col("value").alias("value")), F.struct(F.lit("rest").alias("side"), F.greatest(F.col("_t") - F.col("value"), F.lit(0.0)).alias("value")))).alias("x"))
    placed = materialise(long.select("task", F.concat_ws("|", "sample", "x.side").alias("library"), "gene_id", "x.value"))
    designs = _designs(sides, placed, lambda part: (dummies(part["sample"].tolist()) + [c for k in covariates for c in dummies(part[k].tolist())], [(part["side"] == "target").to_numpy(dtype=float)]))
    found = wald(placed, designs, buckets).withColumnRenamed("task", "cluster")
    return found.where("log2fc > 0") if positive_only else found


def interaction(counts: DataFrame, obs: DataFrame, sample: str, cluster: str, first: tuple[str, str, str], second: tuple[str, str, str], *, covariates: tuple[str, ...] = (), least_cells: int = 1, buckets: int = 64) -> DataFrame:
    """The interaction A^B within every cluster: how much the effect of a against b of one factor (name, a, b) differs
    between a and b of another."""
    (one, a1, b1), (two, a2, b2) = first, second
    libs = _libraries(obs, sample, cluster, [one, two, *covariates]).where((F.col("n_cells") >= least_cells) & F.col(one).isin(a1, b1) & F.col(two).isin(a2, b2))
    libs = materialise(libs)
    placed = materialise(_summed(counts, obs, sample, cluster).join(F.broadcast(libs.select("task", "library")), ["task", "library"], "left_semi"))

    def columns(part: pd.DataFrame):
        x, y = (part[one] == a1).to_numpy(dtype=float), (part[two] == a2).to_numpy(dtype=float)
        return [c for k in covariates for c in dummies(part[k].tolist())], [x, y, x * y]

    return wald(placed, _designs(libs, placed, columns), buckets).withColumnRenamed("task", "cluster")
