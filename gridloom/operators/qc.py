"""Quality metrics, robust thresholds, cascading filters, normalisation.

Counts are long triples (cell_id, gene_id, value) without zeros; cells without a triple come from ``obs`` and
count as 0, so every statistic over cells includes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import top_k
from ..sources.lineage import materialise


def triples(rows: DataFrame) -> DataFrame:
    """Stored entries that count: no zeros, no nulls."""
    return rows.where("value is not null and value != 0")


def cell_metrics(counts: DataFrame, obs: DataFrame, subsets: dict[str, Column], keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """Per cell: total_counts, n_genes and, for each gene subset, its percentage of max(total, 1).

    One aggregation of the triples (partial on the map side) and one join with the cells.
    """
    part = triples(counts).groupBy("cell_id").agg(F.sum("value").alias("total_counts"), F.count("*").alias("n_genes"), *(F.sum(F.when(rule, F.col("value"))).alias(f"_{name}") for name, rule in subsets.items()))
    met = obs.select("cell_id", *keep).join(part, "cell_id", "left")
    total = F.coalesce("total_counts", F.lit(0.0))
    return met.select("cell_id", *keep, total.alias("total_counts"), F.coalesce("n_genes", F.lit(0)).cast("long").alias("n_genes"), *((F.lit(100.0) * F.coalesce(f"_{name}", F.lit(0.0)) / F.greatest(total, F.lit(1.0))).alias(f"pct_{name}") for name in subsets))


def gene_metrics(counts: DataFrame, obs: DataFrame) -> DataFrame:
    """Per gene: n_cells, total, mean and dropout percentage over all cells."""
    cells = obs.agg(F.count("*").alias("_n"))
    return triples(counts).groupBy("gene_id").agg(F.count("*").alias("n_cells"), F.sum("value").alias("total_counts")).crossJoin(F.broadcast(cells)).select("gene_id", "n_cells", "total_counts", (F.col("total_counts") / F.col("_n")).alias("mean_counts"), (100.0 * (1.0 - F.col("n_cells") / F.col("_n"))).alias("pct_dropout"))


def median_mad(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group: median and unscaled median absolute deviation, in two passes over one aggregate each."""
    middle = rows.groupBy(*by).agg(F.median(value).alias("median"))
    spread = rows.join(middle, by).groupBy(*by).agg(F.median(F.abs(F.col(value) - F.col("median"))).alias("mad"))
    return middle.join(spread, by)


def lower_cutoffs(cells: DataFrame, by: list[str], *, min_counts: int | None = None, mads: float | None = 5.0, quantile: float | None = None, gate_quantile: float | None = 0.01, gate_below: float | None = 1000.0) -> DataFrame:
    """Per group the lower total-count cutoff: the greater of a fixed floor and an automatic one.

    The automatic cutoff is the ceiling of the greatest of median - mads * MAD (unscaled, also where MAD is 0),
    the quantile and 0; it is active only where the gate quantile lies below ``gate_below``.
    """
    stats = median_mad(cells, "total_counts", by)
    probes = cells.groupBy(*by).agg(F.percentile("total_counts", F.lit(quantile if quantile is not None else 0.0)).alias("_q"), F.percentile("total_counts", F.lit(gate_quantile if gate_quantile is not None else 0.0)).alias("gate_value"))
    met = stats.join(probes, by)
    cuts = ([F.col("median") - mads * F.col("mad")] if mads is not None else []) + ([F.col("_q")] if quantile is not None else [])
    auto = F.ceil(F.greatest(*cuts, F.lit(0.0))).cast("long") if cuts else F.lit(None).cast("long")
    if gate_quantile is not None and gate_below is not None:
        auto = F.when(F.col("gate_value") < gate_below, auto)
    return met.select(*by, "median", "mad", "gate_value", auto.alias("auto_cutoff"), F.greatest(F.lit(min_counts).cast("long"), auto).alias("cutoff"))


def upper_cutoffs(cells: DataFrame, value: str, by: list[str], *, mads: float | None, quantile: float | None) -> DataFrame:
    """Per group the upper cutoff: the lesser of median + mads * MAD (only where MAD > 0) and the quantile."""
    probes = cells.groupBy(*by).agg(F.percentile(value, F.lit(quantile if quantile is not None else 1.0)).alias("_q"))
    met = median_mad(cells, value, by).join(probes, by)
    mad_cut = F.when(F.col("mad") > 0, F.col("median") + (mads or 0.0) * F.col("mad")) if mads is not None else F.lit(None).cast("double")
    return met.select(*by, F.least(mad_cut, F.col("_q") if quantile is not None else F.lit(None).cast("double")).alias("cutoff"))


def cascade(cells: DataFrame, by: list[str], *, min_genes: int = 0, lower: dict | None = None, max_pct: tuple[str, float] | None = None, genes_mad: float | None = None, genes_quantile: float | None = None, counts_mad: float | None = None, counts_quantile: float | None = None) -> DataFrame:
    """Cells with ``failed_at``: the number and name of the first step that removes them, null for survivors.

    Each step's threshold is computed on the survivors of the steps before it. Only the cell table moves, and
    it is written after each step with a data-dependent threshold, so that the triples below it are
    aggregated once; the threshold tables have a row per group and are broadcast by the optimiser.
    """
    cells = materialise(cells)
    left, steps = cells.withColumn("failed_at", F.lit(None).cast("string")), 0

    def drop(rows: DataFrame, name: str, bad: Column) -> DataFrame:
        nonlocal steps
        steps += 1
        label = f"{steps}:{name}"
        return rows.withColumn("failed_at", F.when(F.col("failed_at").isNull() & F.coalesce(bad, F.lit(False)), F.lit(label)).otherwise(F.col("failed_at")))

    left = drop(left, "min_genes", F.col("n_genes") < min_genes)
    if lower is not None:
        cut = lower_cutoffs(left.where("failed_at is null"), by, **lower).select(*by, "cutoff")
        left = materialise(drop(left.join(cut, by, "left"), "min_counts", F.col("total_counts") < F.col("cutoff")).drop("cutoff"))
    if max_pct is not None:
        left = drop(left, max_pct[0], F.col(max_pct[0]) > max_pct[1])
    for name, value, mads, quantile in (("max_genes", "n_genes", genes_mad, genes_quantile), ("max_counts", "total_counts", counts_mad, counts_quantile)):
        if mads is not None or quantile is not None:
            cut = upper_cutoffs(left.where("failed_at is null"), value, by, mads=mads, quantile=quantile)
            left = materialise(drop(left.join(cut, by, "left"), name, F.col(value) > F.col("cutoff")).drop("cutoff"))
    return left


def cascade_log(failed: DataFrame, by: str, steps: list[str]) -> DataFrame:
    """Per step, for ALL and each batch: n_before, n_after, n_removed, frac_removed (null where nothing was left)."""
    marks = [F.sum(F.when(F.col("failed_at") == s, 1).otherwise(0)).alias(f"_{k}") for k, s in enumerate(steps)]
    held = failed.groupingSets([(F.col(by),), ()], F.col(by)).agg(F.grouping(by).alias("_all"), F.count("*").alias("_n"), *marks)
    removed = F.array(*(F.struct(F.lit(s).alias("filter"), F.lit(k).alias("k"), F.col(f"_{k}").alias("n_removed")) for k, s in enumerate(steps)))
    earlier = [sum((F.col(f"_{j}") for j in range(k)), F.lit(0)) for k in range(len(steps))]
    before = F.array(*((F.col("_n") - e) for e in earlier))
    rows = held.select(F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(by).cast("string")).alias("batch"), F.explode(removed).alias("x"), before.alias("_before"))
    n_before = F.get(F.col("_before"), F.col("x.k"))
    return rows.select(F.col("x.filter").alias("filter"), "batch", n_before.cast("long").alias("n_before"), (n_before - F.col("x.n_removed")).cast("long").alias("n_after"), F.col("x.n_removed").cast("long").alias("n_removed"), F.try_divide(F.col("x.n_removed").cast("double"), n_before).alias("frac_removed"))


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """The guard that a step leaves something: raises at action time."""
    if rows.limit(1).count() == 0:
        raise ValueError(f"{what}: nothing is left")
    return rows


def large_groups(rows: DataFrame, by: str, least: int = 20) -> DataFrame:
    """Rows of groups that have at least so many."""
    return rows.join(rows.groupBy(by).count().where(F.col("count") >= least).select(by), by, "left_semi")


def call_doublets(cells: DataFrame, by: str, rate: float, score: str = "doublet_score") -> DataFrame:
    """Marks per group the max(1, ceil(rate * n)) cells of the highest scores; ties go to the lower cell id."""
    order = Window.partitionBy(by).orderBy(F.desc(score), F.col("cell_id"))
    n = F.count("*").over(Window.partitionBy(by))
    return cells.withColumn("predicted_doublet", F.row_number().over(order) <= F.greatest(F.lit(1), F.ceil(rate * n)))


def doublet_stats(called: DataFrame, by: str, score: str = "doublet_score") -> DataFrame:
    """Per group: cells, doublets, their rate and the lowest score that was called."""
    marked = F.col("predicted_doublet")
    return called.groupBy(by).agg(F.count("*").alias("n_cells"), F.sum(marked.cast("long")).alias("n_doublets"), F.min(F.when(marked, F.col(score))).alias("threshold")).withColumn("rate", F.col("n_doublets") / F.col("n_cells"))


def lognorm(counts: DataFrame, target: float | None = 1e4) -> DataFrame:
    """log1p of counts scaled to a total per cell; without a target, to the median total. Totals of 0 don't scale."""
    totals = counts.groupBy("cell_id").agg(F.sum("value").alias("_total"))
    goal = F.lit(target)
    if target is None:
        totals = totals.crossJoin(F.broadcast(totals.where("_total > 0").agg(F.median("_total").alias("_goal"))))
        goal = F.col("_goal")
    scale = F.when(F.col("_total") > 0, goal / F.col("_total")).otherwise(F.lit(1.0))
    return triples(counts).join(totals, "cell_id").select("cell_id", "gene_id", F.log1p(F.col("value") * scale).alias("value"))


def variable_genes(layer: DataFrame, obs: DataFrame, n_top: int, bins: int = 5) -> DataFrame:
    """Highly variable genes by normalised dispersion: variance over mean (zeros included), standardised in
    bins of equal gene numbers by mean; the first n_top, ties by gene id."""
    n = F.broadcast(obs.agg(F.count("*").cast("double").alias("_n")))
    part = layer.groupBy("gene_id").agg(F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_ss")).crossJoin(n)
    mean = F.col("_s") / F.col("_n")
    part = part.select("gene_id", mean.alias("mean"), F.try_divide(F.col("_ss") - F.col("_n") * mean * mean, F.col("_n") - 1).alias("variance")).where("mean > 0").withColumn("dispersion", F.col("variance") / F.col("mean"))
    ranked = part.withColumn("bin", F.ntile(bins).over(Window.partitionBy(F.lit(0)).orderBy("mean", "gene_id")))
    by = Window.partitionBy("bin")
    sd = F.stddev_samp("dispersion").over(by)
    scored = ranked.withColumn("score", F.when(sd > 0, (F.col("dispersion") - F.avg("dispersion").over(by)) / sd).otherwise(F.lit(0.0)))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("score", 9)), "gene_id")
    return scored.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("highly_variable", F.col("rank") <= n_top)


def dispersion_genes(layer: DataFrame, obs: DataFrame, n_top: int, batch: str | None = None, bins: int = 20) -> DataFrame:
    """Highly variable genes by binned dispersion of log-normalised values, for each batch by itself.

    Means and variances are those of expm1 of the layer, zeros included; log dispersions are standardised in ``bins``
    equal widths of log1p(mean), a gene alone in its bin scores 1. Without batches the first ``n_top`` by score; with
    them, by the number of batches in which a gene is among the first, then by its mean score over batches (0 where it
    has none). Ties by gene id. Genes without variance in any batch are left out.
    """
    name = batch or "_batch"
    cells = obs.select("cell_id", (F.col(batch) if batch else F.lit("all")).alias(name)).where(F.col(name).isNotNull())
    sizes = cells.groupBy(name).agg(F.count("*").cast("double").alias("_n"))
    value = F.expm1("value")
    part = layer.join(cells, "cell_id").groupBy(name, "gene_id").agg(F.sum(value).alias("_s"), F.sum(value * value).alias("_q")).join(sizes, name)
    mean = F.col("_s") / F.col("_n")
    part = part.select(name, "gene_id", mean.alias("_m"), F.try_divide(F.col("_q") - F.col("_n") * mean * mean, F.col("_n") - 1).alias("_v")).where("_m > 0 and _v > 0")
    part = part.select(name, "gene_id", F.log1p("_m").alias("mean"), F.log(F.col("_v") / F.col("_m")).alias("dispersion"))
    by = Window.partitionBy(name)
    width = (F.max("mean").over(by) - F.min("mean").over(by)) / bins
    place = F.coalesce(F.try_divide(F.col("mean") - F.min("mean").over(by), width), F.lit(0.0))
    binned = part.withColumn("bin", F.least(F.lit(bins), F.greatest(F.lit(1), F.ceil(F.round(place, 9)))).cast("int"))
    inside = Window.partitionBy(name, "bin")
    centre, sd, alone = F.avg("dispersion").over(inside), F.stddev_samp("dispersion").over(inside), F.count("*").over(inside) == 1
    scored = binned.withColumn("score", F.when(alone, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(F.col("dispersion") - centre, sd), F.lit(0.0))))
    first = scored.withColumn("_first", F.row_number().over(Window.partitionBy(name).orderBy(F.desc(F.round("score", 9)), "gene_id")) <= n_top)
    n = F.broadcast(sizes.agg(F.count("*").alias("_b")))
    genes = first.groupBy("gene_id").agg(F.sum(F.col("_first").cast("long")).alias("n_batches"), F.sum("score").alias("_s")).crossJoin(n).select("gene_id", "n_batches", (F.col("_s") / F.col("_b")).alias("score"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n_batches"), F.desc(F.round("score", 9)), "gene_id")  # genes, not cells
    return genes.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("highly_variable", F.col("rank") <= n_top)


def prevalence(layer: DataFrame, obs: DataFrame, group: str) -> DataFrame:
    """Per (group, gene): cells with a value over all cells of the group."""
    n = obs.groupBy(group).agg(F.count("*").alias("n_cells"))
    found = triples(layer).join(obs.select("cell_id", group), "cell_id").groupBy(group, "gene_id").agg(F.count("*").alias("n_expr"))
    return found.join(n, group).select(group, "gene_id", "n_expr", "n_cells", (F.col("n_expr") / F.col("n_cells")).alias("pct"))


def prevalence_gap(found: DataFrame, group: str, min_pct: float, min_diff: float) -> DataFrame:
    """Genes of groups with (pct or rest pct) >= min_pct and a gap of at least min_diff to the rest."""
    sums = found.groupBy("gene_id").agg(F.sum("n_expr").alias("_e"))
    all_cells = found.select(group, "n_cells").distinct().agg(F.sum("n_cells").alias("_n"))
    met = found.join(sums, "gene_id").crossJoin(F.broadcast(all_cells)).withColumn("pct_rest", F.try_divide(F.col("_e") - F.col("n_expr"), F.col("_n") - F.col("n_cells")))
    return met.where(((F.col("pct") >= min_pct) | (F.col("pct_rest") >= min_pct)) & (F.abs(F.col("pct") - F.col("pct_rest")) >= min_diff)).select(group, "gene_id", "pct", "pct_rest")


def library_gene_filter(libraries: DataFrame, counts: DataFrame, level: str, *, min_total: float, min_count: float, min_samples: int, min_pct: float, max_genes: int) -> DataFrame:
    """Genes with a total, with enough libraries above a count in every level, prevalent overall; the greatest totals first.

    ``libraries`` (library, level) has every library, ``counts`` (library, gene_id, value) the stored sums.
    """
    sizes = libraries.groupBy(level).agg(F.count("*").alias("_libs"))
    per = counts.join(libraries, "library").groupBy("gene_id", level).agg(F.sum("value").alias("_t"), F.sum((F.col("value") >= min_count).cast("long")).alias("_hits"), F.sum((F.col("value") > 0).cast("long")).alias("_on"))
    n_levels = sizes.agg(F.count("*").alias("_levels"), F.sum("_libs").alias("_all"))
    good = per.groupBy("gene_id").agg(F.sum("_t").alias("total"), F.sum((F.col("_hits") >= min_samples).cast("long")).alias("_ok"), F.sum("_on").alias("_on")).crossJoin(F.broadcast(n_levels))
    good = good.where((F.col("total") >= min_total) & (F.col("_ok") == F.col("_levels")) & (F.col("_on") / F.col("_all") >= min_pct)).withColumn("_g", F.lit(0))
    return top_k(good, max_genes, ["_g"], F.desc("total"), F.col("gene_id"), rank="rank").select("gene_id", "total", "rank")


def confidence(probabilities: DataFrame, *, entropy_abs: float, entropy_quantile: float, min_margin: float) -> DataFrame:
    """Per cell of (cell_id, label, p): best label, entropy, margin and whether it is confident."""
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1.0), F.col("p")))
    order = Window.partitionBy("cell_id").orderBy(F.desc("p"), F.col("label"))
    ranked = probabilities.withColumn("_r", F.row_number().over(order))
    cells = ranked.groupBy("cell_id").agg(F.sum(-p * F.log(p)).alias("entropy"), F.max(F.when(F.col("_r") == 1, F.col("label"))).alias("label"), (F.max(F.when(F.col("_r") == 1, F.col("p"))) - F.coalesce(F.max(F.when(F.col("_r") == 2, F.col("p"))), F.lit(0.0))).alias("margin"))
    cut = cells.agg(F.greatest(F.lit(entropy_abs), F.percentile("entropy", F.lit(entropy_quantile))).alias("_cut"))
    return cells.crossJoin(F.broadcast(cut)).withColumn("confident", (F.col("entropy") <= F.col("_cut")) & (F.col("margin") >= min_margin)).drop("_cut")


def safe_mask(cells: DataFrame, flag: str, least: int = 500, share: float = 0.05) -> DataFrame:
    """The mask is dropped (all true) where it would keep fewer than ``least`` cells or less than ``share``."""
    kept = cells.agg(F.sum(F.col(flag).cast("long")).alias("_k"), F.count("*").alias("_n"))
    ok = (F.col("_k") >= least) & (F.col("_k") >= share * F.col("_n"))
    return cells.crossJoin(F.broadcast(kept)).withColumn(flag, F.when(ok, F.col(flag)).otherwise(F.lit(True))).drop("_k", "_n")


def removed_fraction(raw: DataFrame, corrected: DataFrame) -> DataFrame:
    """Per cell: (raw - corrected) / raw totals, 0 where the raw total is 0."""
    a, b = (x.groupBy("cell_id").agg(F.sum("value").alias(n)) for x, n in ((raw, "raw"), (corrected, "corrected")))
    return a.join(b, "cell_id", "left").select("cell_id", F.coalesce(F.try_divide(F.col("raw") - F.coalesce("corrected", F.lit(0.0)), F.col("raw")), F.lit(0.0)).alias("removed"))


def filter_stack(log: DataFrame) -> DataFrame:
    """Filters in order of mean n_before, with what each removed as a share of the first count."""
    means = log.groupBy("filter").agg(F.avg("n_before").alias("mean_before"), F.sum("n_removed").alias("n_removed"))
    first = log.groupBy("batch").agg(F.max("n_before").alias("_f")).agg(F.sum("_f").alias("_first"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_before"), "filter")
    return means.crossJoin(F.broadcast(first)).select("filter", F.row_number().over(order).cast("long").alias("place"), (F.col("n_removed") / F.col("_first")).alias("frac_of_original"))


