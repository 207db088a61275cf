"""Column functions: naming rules, scalar statistics and window formulas that many operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Abramowitz and Stegun 7.1.26: erfc(x) = (a1 t + ... + a5 t^5) exp(-x^2), t = 1 / (1 + p x).
ERFC_P, ERFC_A = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def level_name(value: Column) -> Column:
    """Trimmed, inner white space as one space."""
    return F.regexp_replace(F.trim(value.cast("string")), r"\s+", " ")


def token(value: Column) -> Column:
    """A level as part of a composite name: slashes and colons become underscores."""
    return F.regexp_replace(level_name(value), "[/:]", "_")


def composite(*values: Column) -> Column:
    return F.concat_ws(".", *(token(v) for v in values))


def identifier(value: Column, longest: int = 180) -> Column:
    """A safe name: separators become one underscore, no leading or trailing marks, never empty."""
    clean = F.regexp_replace(F.regexp_replace(value.cast("string"), r"[/ \\:]+", "_"), r"_+", "_")
    clean = F.regexp_replace(clean, r"^[._-]+|[._-]+$", "")
    return F.substring(F.when(clean == "", F.lit("unnamed")).otherwise(clean), 1, longest)


def cluster_code(label: Column) -> Column:
    """The Cnn code of a display label: a whole word if there is one, else anywhere."""
    word, any_ = F.regexp_extract(label, r"\b(C\d+)\b", 1), F.regexp_extract(label, r"(C\d+)", 1)
    return F.coalesce(F.when(word != "", word), F.when(any_ != "", any_))


def code_of_rank(rank: Column) -> Column:
    """C00, C01, ... of a rank that begins at 0."""
    return F.concat(F.lit("C"), F.when(rank < 10, F.concat(F.lit("0"), rank.cast("string"))).otherwise(rank.cast("string")))


def normal_two_sided(z: Column) -> Column:
    """Two-sided p-value of a standard normal score."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + ERFC_P * x)
    poly = F.lit(0.0)
    for a in reversed(ERFC_A):
        poly = (poly + a) * t
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), poly * F.exp(-x * x)))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def benjamini_hochberg(rows: DataFrame, p: str = "pval", by: tuple[str, ...] = (), out: str = "padj", tie: tuple[str, ...] = ()) -> DataFrame:
    """Step-up adjusted p-values within families; nulls stay null and don't count."""
    known = F.col(p).isNotNull()
    family = [F.col(c) for c in by] + [known]
    up = Window.partitionBy(*family).orderBy(F.col(p), *(F.col(c) for c in tie))
    ranked = rows.withColumn("_rank", F.row_number().over(up)).withColumn("_m", F.count("*").over(Window.partitionBy(*family)))
    down = Window.partitionBy(*family).orderBy(F.desc("_rank")).rowsBetween(Window.unboundedPreceding, 0)
    raw = F.min(F.col(p) * F.col("_m") / F.col("_rank")).over(down)
    return ranked.withColumn(out, F.when(known, clip(raw, 0.0, 1.0))).drop("_rank", "_m")


def weighted_benjamini_hochberg(rows: DataFrame, p: str, weight: str, by: tuple[str, ...] = (), out: str = "padj", tie: tuple[str, ...] = ()) -> DataFrame:
    """p-values divided by weights of mean 1 within each family, then the step-up adjustment."""
    mean = F.avg(weight).over(Window.partitionBy(*by))
    return benjamini_hochberg(rows.withColumn("_p", F.least(F.lit(1.0), F.col(p) / (F.col(weight) / mean))), "_p", by, out, tie).drop("_p")


def z_sample(value: Column, by: Window, eps: float = 1e-9) -> Column:
    """(x - mean) / (sample sd + eps); 0 where the sd is 0 or unknown."""
    sd = F.stddev_samp(value).over(by)
    return F.when(sd > 0, (value - F.avg(value).over(by)) / (sd + eps)).otherwise(F.lit(0.0))


def z_population(value: Column, by: Window) -> Column:
    """(x - mean) / population sd; 0 where the sd is 0."""
    sd = F.stddev_pop(value).over(by)
    return F.when(sd > 0, (value - F.avg(value).over(by)) / sd).otherwise(F.lit(0.0))


def min_max(value: Column, by: Window) -> Column:
    """Scaled to 0..1; a constant gives 0."""
    low, high = F.min(value).over(by), F.max(value).over(by)
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))


def ranked(rows: DataFrame, *wanted: tuple[Column, str, bool], parts: int = 32) -> DataFrame:
    """Ranks over all rows, without one task that holds them all. ``wanted``: (value, less first; name; dense?).

    Values are cut at about ``parts`` quantiles; a row's rank is that within its part, after the rows (or different
    values) of the parts before. Equal values lie in one part, so the ranks are exact. Nulls come last. ``rows`` is read
    for each rank: a written table.
    """
    out = rows
    for value, name, dense in wanted:
        out = out.withColumn("_v", value.cast("double"))
        cuts = sorted(set(out.approxQuantile("_v", [k / parts for k in range(1, parts)], 1 / (4 * parts))))
        part = F.when(F.col("_v").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c < F.col("_v"))) if cuts else F.lit(0))
        out = out.withColumn("_p", part)
        n = F.countDistinct("_v") if dense else F.count("*")
        before, offsets = 0, []
        for r in out.groupBy("_p").agg(n.alias("n")).orderBy("_p").collect():  # a row a part
            offsets += [F.lit(r["_p"]), F.lit(before)]
            before += r["n"]
        order = Window.partitionBy("_p").orderBy(F.col("_v").asc_nulls_last())
        offset = F.element_at(F.create_map(*offsets), F.col("_p")) if offsets else F.lit(0)
        out = out.withColumn(name, (offset + (F.dense_rank() if dense else F.rank()).over(order)).cast("long")).drop("_v", "_p")
    return out


def top_k(rows: DataFrame, k: int, by: list[str], *order: Column, rank: str | None = None) -> DataFrame:
    """The first k rows of each group in a total order."""
    name = rank or "_row"
    out = rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col(name) <= k)
    return out if rank else out.drop(name)
