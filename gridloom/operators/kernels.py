"""Small dense numeric kernels, run per group through typed grouped maps.

A group here is a cluster, gene or neighbourhood with one row per *sample* or library (tens to thousands), or
one block of cells against a bounded set; what grows with the cells is aggregated before, in SQL.
"""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normal_sf2(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def mann_whitney(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """U of x and its two-sided p: exact where the smaller side has at most 8 values and none are tied, else
    normal with tie and continuity correction."""
    n, m = len(x), len(y)
    both = np.concatenate([x, y])
    order = np.argsort(both, kind="stable")
    ranks = np.empty(n + m)
    values, start, counts = np.unique(both[order], return_index=True, return_counts=True)
    for s, c in zip(start, counts, strict=True):
        ranks[order[s : s + c]] = s + (c + 1) / 2
    u = float(ranks[:n].sum() - n * (n + 1) / 2)
    if min(n, m) <= 8 and len(values) == n + m:
        ways = np.zeros((n + 1, n * m + 1))  # subsets of ranks by size and U
        ways[0, 0] = 1
        for rank in range(1, n + m + 1):
            for k in range(min(n, rank), 0, -1):
                move = rank - k
                if move <= n * m:
                    ways[k, move:] += ways[k - 1, : n * m + 1 - move]
        dist = ways[n] / ways[n].sum()
        far = max(u, n * m - u)
        return u, float(min(1.0, 2 * dist[int(round(far)) :].sum()))
    total = n + m
    sd = math.sqrt(n * m / 12 * (total + 1 - (counts**3 - counts).sum() / (total * (total - 1)))) if total > 1 else 0.0
    if sd == 0:
        return u, 1.0
    return u, min(1.0, normal_sf2(max(0.0, abs(u - n * m / 2) - 0.5) / sd))


def mann_whitney_by(rows: DataFrame, by: list[str], side: str, value: str, a: str, b: str, least: int = 2) -> DataFrame:
    """Mann-Whitney of a against b per group; groups with fewer than ``least`` values on a side go."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema if f.name in by}

    def test(part: pd.DataFrame) -> pd.DataFrame:
        x, y = (part.loc[part[side] == s, value].dropna().to_numpy(dtype=float) for s in (a, b))
        if min(len(x), len(y)) < least:
            return pd.DataFrame(columns=[*by, "n_a", "n_b", "u", "pval"])
        u, p = mann_whitney(x, y)
        return pd.DataFrame([[*(part[c].iloc[0] for c in by), len(x), len(y), u, p]], columns=[*by, "n_a", "n_b", "u", "pval"])

    return rows.select(*by, side, value).where(F.col(side).isin(a, b)).groupBy(*by).applyInPandas(test, ", ".join(f"{c} {kinds[c]}" for c in by) + ", n_a long, n_b long, u double, pval double")


def irls(design: np.ndarray, y: np.ndarray, family: str, offset: np.ndarray | None = None, trials: np.ndarray | None = None, alpha: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, bool]:
    """Coefficients, standard errors and convergence of a generalised linear model: ``binomial`` (y successes of
    ``trials``, logit) or ``negbin`` (log link, dispersion ``alpha``), by iteratively reweighted least squares."""
    offset = np.zeros(len(y)) if offset is None else offset
    if family == "binomial":
        mu = (y + 0.5) / (trials + 1)
        eta = np.log(mu / (1 - mu))
    else:
        mu = y + 0.5
        eta = np.log(mu)
    beta, done = np.zeros(design.shape[1]), False
    for _ in range(rounds):
        if family == "binomial":
            weight = np.maximum(trials * mu * (1 - mu), 1e-10)
            target = eta - offset + (y - trials * mu) / weight
        else:
            weight = np.maximum(mu / (1 + alpha * mu), 1e-10)
            target = eta - offset + (y - mu) / np.maximum(mu, 1e-10)
        new = np.linalg.lstsq(design * np.sqrt(weight)[:, None], target * np.sqrt(weight), rcond=None)[0]
        eta = np.clip(design @ new + offset, -30, 30)
        mu = 1 / (1 + np.exp(-eta)) if family == "binomial" else np.exp(eta)
        done = bool(np.max(np.abs(new - beta)) < 1e-9)
        beta = new
        if done:
            break
    weight = trials * mu * (1 - mu) if family == "binomial" else mu / (1 + alpha * mu)
    cov = np.linalg.pinv(design.T @ (design * np.maximum(weight, 1e-12)[:, None]))
    return beta, np.sqrt(np.maximum(np.diag(cov), 0)), done


def _dummies(levels: pd.Series, reference: str) -> tuple[list[str], np.ndarray]:
    names = sorted(set(levels) - {reference})
    return names, np.column_stack([np.ones(len(levels)), *((levels == n).to_numpy(dtype=float) for n in names)])


_GLM = "cluster string, term string, effect double, se double, z double, pval double, ci_low double, ci_high double, converged boolean"


def _wald(cluster: str, terms: list[str], beta: np.ndarray, se: np.ndarray, done: bool) -> pd.DataFrame:
    rows = []
    for k, term in enumerate(terms, start=1):
        z = beta[k] / se[k] if se[k] > 0 else 0.0
        rows.append([cluster, term, beta[k] / math.log(2), se[k], z, normal_sf2(z), (beta[k] - 1.96 * se[k]) / math.log(2), (beta[k] + 1.96 * se[k]) / math.log(2), done])
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _GLM.split(", ")])


def composition_glm(table: DataFrame, reference: str, family: str = "binomial", alpha: float = 1.0) -> DataFrame:
    """Per cluster a model of its cells among each sample's on condition levels against a reference.

    ``table`` has (cluster, condition, n, total) with a row per sample. ``binomial`` models n of total;
    ``negbin`` the counts with offset log(max(total, 1)). Effects are in log2 units with Wald intervals.
    """

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        terms, design = _dummies(part["condition"].astype(str), reference)
        y, total = part["n"].to_numpy(dtype=float), part["total"].to_numpy(dtype=float)
        if not terms or len(part) <= design.shape[1]:
            return _wald("", [], np.zeros(1), np.zeros(1), False)
        beta, se, done = irls(design, y, family, trials=total) if family == "binomial" else irls(design, y, family, offset=np.log(np.maximum(total, 1)), alpha=alpha)
        return _wald(str(part["cluster"].iloc[0]), terms, beta, se, done)

    return table.select("cluster", "condition", "n", "total").groupBy("cluster").applyInPandas(fit, _GLM)


def size_factors(counts: DataFrame) -> DataFrame:
    """Per library the median ratio to genes' pseudo-reference: the geometric mean with zeros as 1 over all libraries
    (sum of logs of positive counts over the number of libraries), scaled to a geometric mean of 1.

    ``counts`` (library, gene_id, value) has stored, positive values. All in SQL.
    """
    n = counts.agg(F.countDistinct("library").alias("_n"))
    reference = counts.where("value > 0").groupBy("gene_id").agg(F.sum(F.log("value")).alias("_l")).crossJoin(F.broadcast(n)).select("gene_id", (F.col("_l") / F.col("_n")).alias("_ref"))
    raw = counts.where("value > 0").join(F.broadcast(reference), "gene_id").groupBy("library").agg(F.median(F.log("value") - F.col("_ref")).alias("_f"))
    return raw.crossJoin(F.broadcast(raw.agg(F.avg("_f").alias("_m")))).select("library", F.exp(F.col("_f") - F.col("_m")).alias("size_factor"))


_NB = "gene_id string, base_mean double, dispersion double, log2fc double, lfc_se double, stat double, pval double"


def pseudobulk_nb(libraries: DataFrame, counts: DataFrame, factor: str, a: str, b: str, covariates: tuple[str, ...] = (), buckets: int = 64) -> DataFrame:
    """Negative binomial Wald test of level a against b per gene over libraries.

    ``libraries`` (library, factor, covariates...) is a dimension and is broadcast; genes are dealt to hash
    buckets, each a task's worth of genes. Gene-wise dispersion by moments, drawn half way (in logs) to the
    trend over means; no outlier replacement, no independent filtering, no effect shrinkage.
    """
    libs = libraries.where(F.col(factor).isin(a, b)).join(size_factors(counts), "library").toPandas().sort_values("library").reset_index(drop=True)
    design = [np.ones(len(libs)), (libs[factor] == a).to_numpy(dtype=float)]
    for c in covariates:
        for level in sorted(libs[c].astype(str).unique())[1:]:
            design.append((libs[c].astype(str) == level).to_numpy(dtype=float))
    x, names, sf = np.column_stack(design), libs["library"].tolist(), libs["size_factor"].to_numpy(dtype=float)
    place = {n: k for k, n in enumerate(names)}

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        genes = sorted(part["gene_id"].unique())
        y = np.zeros((len(genes), len(names)))
        where = {g: k for k, g in enumerate(genes)}
        for g, lib, value in zip(part["gene_id"], part["library"], part["value"], strict=True):
            if lib in place:
                y[where[g], place[lib]] += value
        scaled = y / sf
        mean, var = scaled.mean(axis=1), scaled.var(axis=1, ddof=1)
        raw = np.clip((var - mean * np.mean(1 / sf)) / np.maximum(mean, 1e-8) ** 2, 1e-8, 10.0)
        trend = np.exp(np.median(np.log(raw)))
        disp = np.exp((np.log(raw) + np.log(trend)) / 2)
        rows = []
        for k, g in enumerate(genes):
            if mean[k] <= 0:
                continue
            beta, se, _ = irls(x, y[k], "negbin", offset=np.log(sf), alpha=float(disp[k]))
            z = beta[1] / se[1] if se[1] > 0 else 0.0
            rows.append([g, mean[k], disp[k], beta[1] / math.log(2), se[1] / math.log(2), z, normal_sf2(z)])
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _NB.split(", ")])

    dealt = counts.select("library", "gene_id", "value").withColumn("_b", F.pmod(F.xxhash64("gene_id"), F.lit(buckets)))
    return dealt.groupBy("_b").applyInPandas(lambda part: fit(part.drop(columns="_b")), _NB)


def gsea(stats: DataFrame, net: DataFrame, group: str, permutations: int = 200, low: int = 3, high: int = 500, seed: int = 1) -> DataFrame:
    """Preranked enrichment with permuted gene positions: es, nes and a two-sided-by-sign p per (group, source).

    A group is one ranked gene list (genes number tens of thousands); the sets are broadcast.
    """
    sets = net.groupBy("source").agg(F.collect_set("target").alias("genes")).toPandas()
    members = {r.source: set(r.genes) for r in sets.itertuples()}

    def score(weights: np.ndarray, hit: np.ndarray) -> float:
        step = np.where(hit, weights / max(1e-12, weights[hit].sum()), -1.0 / max(1, (~hit).sum()))
        run = np.cumsum(step)
        return float(run.max() if run.max() >= -min(run.min(), 0) else run.min())

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["stat", "gene_id"], ascending=[False, True]).drop_duplicates("gene_id")
        weights, genes = part["stat"].abs().to_numpy(dtype=float), part["gene_id"].to_numpy()
        rows = []
        for source in sorted(members):
            hit = np.isin(genes, list(members[source]))
            if not low <= hit.sum() <= high or hit.all():
                continue
            es = score(weights, hit)
            rng = np.random.default_rng([seed, len(genes), int(hit.sum())])
            null = np.array([score(weights, rng.permutation(hit)) for _ in range(permutations)])
            same = null[null >= 0] if es >= 0 else null[null < 0]
            scale = np.abs(same).mean() if len(same) else 1.0
            rows.append([part[group].iloc[0], source, int(hit.sum()), es, es / max(scale, 1e-12), (1 + (np.abs(same) >= abs(es)).sum()) / (1 + len(same))])
        return pd.DataFrame(rows, columns=[group, "source", "size", "es", "nes", "pval"])

    return stats.select(group, "gene_id", "stat").groupBy(group).applyInPandas(run, f"{group} string, source string, size long, es double, nes double, pval double")


def _small_batches(frame: DataFrame, rows: int = 64) -> None:
    """Batches of a few rows, as a row may hold two matrices; a smaller setting of the session stays."""
    spark, name = frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def _blocks(cells: DataFrame, label: str | None, key: str, vec: str, rows: int) -> DataFrame:
    """Cells packed as matrices of about ``rows`` rows: block, ids, labels (empty without a label), vecs."""
    parts = max(1, -(-cells.count() // rows))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        held = (part[key].to_numpy(np.int64), part[label].to_numpy(np.int64) if label else np.zeros(0, dtype=np.int64), np.stack(part[vec].to_numpy()).astype(np.float64))
        return pd.DataFrame([[part["block"].iloc[0], *(x.tobytes() for x in held)]], columns=["block", "ids", "labels", "vecs"])

    dealt = cells.select(key, *([label] if label else []), vec, F.pmod(F.xxhash64(key), F.lit(parts)).alias("block"))
    return dealt.groupBy("block").applyInPandas(pack, "block long, ids binary, labels binary, vecs binary")


def nearest(points: DataFrame, queries: DataFrame, k: int, key: str = "cell_id", vec: str = "vec", *, rows: int = 512) -> DataFrame:
    """The k nearest points (Euclidean; ties by key) of each query: (query, neighbour, distance, place).

    Blocks of queries meet blocks of points; each pair gives a query's k best there, and these are merged by rank. The
    cost is queries x points; nothing is collected.
    """
    _small_batches(points)

    def best(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                ids, names = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.names, dtype=np.int64)
                wanted, mine = np.frombuffer(r.vecs).reshape(len(ids), -1), np.frombuffer(r.others).reshape(len(names), -1)
                d = np.stack([np.sqrt(((mine - w) ** 2).sum(axis=1)) for w in wanted])
                top = np.lexsort((np.broadcast_to(names, d.shape), d), axis=1)[:, :k]
                yield pd.DataFrame({"query": np.repeat(ids, top.shape[1]), "neighbour": names[top].ravel(), "distance": np.take_along_axis(d, top, axis=1).ravel()})

    asked = _blocks(queries, None, key, vec, rows).select("ids", "vecs")
    every = _blocks(points, None, key, vec, rows).select(F.col("ids").alias("names"), F.col("vecs").alias("others"))
    found = asked.crossJoin(every).mapInPandas(best, "query long, neighbour long, distance double")
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    return found.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= k)


def silhouette(points: DataFrame, sample: DataFrame, label: str, key: str = "cell_id", vec: str = "vec", *, rows: int = 512) -> DataFrame:
    """Silhouette of the sampled cells, or all, against all cells: blocks of cells meet blocks of cells, each pair
    gives its sums of distances by label, and the sums meet in one aggregation. A cell alone in its label has 0.
    The cost is cells x cells; nothing is collected."""
    _small_batches(points)

    def sums(batches):
        for part in batches:
            for r in part.itertuples(index=False):
                ids, own, names = (np.frombuffer(x, dtype=np.int64) for x in (r.ids, r.labels, r.names))
                wanted, others = np.frombuffer(r.vecs).reshape(len(ids), -1), np.frombuffer(r.others).reshape(len(names), -1)
                values, code, n = np.unique(names, return_inverse=True, return_counts=True)
                s = np.array([np.bincount(code, weights=np.sqrt(((others - w) ** 2).sum(axis=1)), minlength=len(values)) for w in wanted])
                yield pd.DataFrame({"cell_id": np.repeat(ids, len(values)), "own": np.repeat(own, len(values)), "other": np.tile(values, len(ids)), "s": s.ravel(), "n": np.tile(n, len(ids))})

    asked = _blocks(sample, label, key, vec, rows).drop("block")
    every = _blocks(points, label, key, vec, rows).select(F.col("labels").alias("names"), F.col("vecs").alias("others"))
    part = asked.crossJoin(every).mapInPandas(sums, "cell_id long, own long, other long, s double, n long").groupBy("cell_id", "own", "other").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    inner = F.max(F.when(F.col("own") == F.col("other"), F.when(F.col("n") > 1, F.col("s") / (F.col("n") - 1)).otherwise(F.lit(None))))
    outer = F.min(F.when(F.col("own") != F.col("other"), F.col("s") / F.col("n")))
    met = part.groupBy("cell_id", F.col("own").alias(label)).agg(inner.alias("a"), outer.alias("b"))
    most = F.greatest("a", "b")
    return met.select("cell_id", label, F.when(F.col("a").isNull() | (most == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / most).alias("silhouette"))


def silhouette_summary(scored: DataFrame) -> DataFrame:
    """Cells, and mean, median, p10 and p90 of their silhouettes."""
    at = lambda p: F.percentile("silhouette", F.lit(p))
    return scored.agg(F.count("silhouette").alias("n"), F.avg("silhouette").alias("mean"), at(0.5).alias("median"), at(0.1).alias("p10"), at(0.9).alias("p90"))


def call_cells(totals: DataFrame, by: str = "sample_id", factor: float = 1.2) -> DataFrame:
    """Per sample the knee of the rank curve, the crossing of a two-part Gaussian mixture of log10 totals, and the
    cutoff factor * sqrt(mixture * knee). The curve enters as a histogram of totals, not as its barcodes."""
    histogram = totals.groupBy(by, F.col("total").cast("long").alias("total")).agg(F.count("*").alias("n"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("total", ascending=False)
        x, n = np.log10(part["total"].to_numpy(dtype=float) + 1), part["n"].to_numpy(dtype=float)
        rank = np.log10(np.cumsum(n))
        if len(x) < 3:
            return pd.DataFrame([[part[by].iloc[0], None, None, None]], columns=[by, "knee", "mixture", "cutoff"])
        gap = (x - x[-1]) / max(1e-12, x[0] - x[-1]) + (rank - rank[0]) / max(1e-12, rank[-1] - rank[0])
        knee = 10 ** x[int(np.argmax(gap))]
        mu, sd, w = np.array([x.min(), x.max()]), np.full(2, max(x.std(), 1e-3)), np.array([0.5, 0.5])
        for _ in range(200):
            p = w * np.exp(-0.5 * ((x[:, None] - mu) / sd) ** 2) / sd + 1e-300
            r = p / p.sum(axis=1, keepdims=True) * n[:, None]
            w = r.sum(axis=0) / r.sum()
            mu = (r * x[:, None]).sum(axis=0) / np.maximum(r.sum(axis=0), 1e-12)
            sd = np.sqrt(np.maximum((r * (x[:, None] - mu) ** 2).sum(axis=0) / np.maximum(r.sum(axis=0), 1e-12), 1e-6))
        lo, hi = np.argsort(mu)
        a = 1 / sd[lo] ** 2 - 1 / sd[hi] ** 2
        b = -2 * (mu[lo] / sd[lo] ** 2 - mu[hi] / sd[hi] ** 2)
        c = mu[lo] ** 2 / sd[lo] ** 2 - mu[hi] ** 2 / sd[hi] ** 2 - 2 * math.log(max(1e-12, w[lo] * sd[hi]) / max(1e-12, w[hi] * sd[lo]))
        disc = b * b - 4 * a * c
        roots = [] if disc < 0 or abs(a) < 1e-12 else [(-b + s * math.sqrt(disc)) / (2 * a) for s in (1, -1)]
        between = [t for t in roots if mu[lo] <= t <= mu[hi]]
        mixture = 10 ** (between[0] if between else mu[hi])
        return pd.DataFrame([[part[by].iloc[0], knee, mixture, factor * math.sqrt(knee * mixture)]], columns=[by, "knee", "mixture", "cutoff"])

    return histogram.groupBy(by).applyInPandas(fit, f"{by} string, knee double, mixture double, cutoff double")

