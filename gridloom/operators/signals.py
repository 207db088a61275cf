"""Signals between groups beyond single scores: runs by condition, route families, candidate events, metabolite
events rescored by sample, top links of ligands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import communication, conditions
from .merge import first_by_prior, resolve_tokens
from .ranking import prior_column

# Route families with the receptor prefixes, receptors, ligand prefixes and ligands that mean them,
# in the order in which they are asked.
FAMILIES = (
    ("Innate sensing / complement", ("TLR", "C5AR", "C3AR"), ("CD93", "LILRB2", "LILRB3"), (), ("HMGB1", "CD14", "IRAK4", "HSPA4")),
    ("ECM / adhesion", ("ITGA", "ITGB"), ("CD44", "SDC2", "PLAUR", "PTPRJ", "CADM1", "APLP2", "ACKR3"), (), ("ADAM9", "ADAM10", "CXCL12", "PDGFB", "ITGB3BP", "F13A1", "TIMP2", "TLN1")),
    ("Growth factor / receptor handling", ("EGFR", "ERBB", "FGFR"), ("MET", "NRP1", "ASGR1", "ASGR2", "LDLR", "INSR", "IGF1R", "IL6R"), (), ("HGF", "FGF13", "GRN", "S100A4", "PTPN6", "LRIG2", "HP", "TGFA", "IGF1", "ANXA1", "NAMPT", "ARF1", "GNAI2")),
    ("Notch / juxtacrine", ("NOTCH",), (), (), ("MAML2",)),
    ("Scavenger / metabolic handling", (), ("LRP1", "ABCA1", "AR", "SORT1", "SORL1", "VLDLR"), (), ("APOA1", "A2M", "PSAP", "LRPAP1", "ACTR2", "PLTP")),
    ("Immune recognition", ("FCGR", "KLR"), ("PTPRK", "B2M_FCGRT", "PILRB", "CD81", "CD99L2", "TYRO3"), (), ("LGALS9", "ALB", "B2M", "CD99", "GAS6", "PROS1", "CD200R1")),
    ("Guidance / interface", ("PLXN", "EPH"), (), ("EFN",), ("AFDN", "ANG", "FARP2", "RTN4")),
    ("Protease / cytokine interface", ("IL6R",), (), (), ("ADAM10", "ADAM17")),
)
OTHER, SECRETED, UNANNOTATED = "Other", "Secreted Signaling", "Unannotated"


def family_of_pair(ligand: Column, receptor: Column) -> Column:
    """The first family of ``FAMILIES`` that a pair's genes mean, else ``Other``."""
    ligand, receptor = F.trim(F.coalesce(ligand, F.lit(""))), F.trim(F.coalesce(receptor, F.lit("")))
    out = F.lit(OTHER)
    for name, starts, receptors, ligand_starts, ligands in reversed(FAMILIES):
        rules = [receptor.startswith(x) for x in starts] + [ligand.startswith(x) for x in ligand_starts] + [receptor.isin(*receptors)] * bool(receptors) + [ligand.isin(*ligands)] * bool(ligands)
        out = F.when(reduce(lambda a, b: a | b, rules), F.lit(name)).otherwise(out)
    return out


def routed(events: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Events with route_family and route_annotation: looked up by the normalised (ligand, receptor) in ``lookup``
    (ligand, receptor, pathway, annotation), else the family of the pair's genes and no annotation. The lookup is made
    unique first, by the least pathway."""
    norm = lambda c: F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    fallback = family_of_pair(F.col("ligand"), F.col("receptor"))
    if lookup is None:
        return events.withColumn("route_family", fallback).withColumn("route_annotation", F.lit(""))
    side = lookup.groupBy(norm(F.col("ligand")).alias("_l"), norm(F.col("receptor")).alias("_r")).agg(F.min(F.struct("pathway", "annotation")).alias("_p"))
    met = events.withColumn("_l", norm(F.col("ligand"))).withColumn("_r", norm(F.col("receptor"))).join(side, ["_l", "_r"], "left")
    return met.withColumn("route_family", F.coalesce("_p.pathway", fallback)).withColumn("route_annotation", F.coalesce("_p.annotation", F.lit(""))).drop("_l", "_r", "_p")


def cross_scope(events: DataFrame, levels: DataFrame, sources: list[str], targets: list[str], scope: str = "all", lookup: DataFrame | None = None) -> DataFrame:
    """Events whose groups' dataset levels (``levels``: cluster, level) are allowed on either side; ``secreted`` leaves
    those whose looked-up annotation says so. Groups without a level have the empty one, which is never allowed."""
    out = events
    for side, allowed in (("source", sources), ("target", targets)):
        held = levels.select(F.col("cluster").alias(side), F.col("level").alias(f"{side}_dataset_level"))
        out = out.join(held, side).where(F.col(f"{side}_dataset_level").isin(*[x for x in allowed if x]))
    if scope == "secreted":
        out = routed(out, lookup).where(F.col("route_annotation") == SECRETED)
    elif scope != "all":
        raise ValueError(f"a scope is all or secreted, not {scope!r}")
    return out


def scores_by_condition(layer: DataFrame, obs: DataFrame, group: str, pairs: DataFrame, condition: str, least_share: float = 0.1) -> DataFrame:
    """``communication.pair_scores`` for every level of a condition, or for every level within each context of ``A@B``:
    one plan with the context as a key, not a run for each. Columns context, level, then the scores."""
    parsed = conditions.parse(condition)
    if parsed.interaction:
        raise ValueError("signals have no interaction contrasts")
    context = F.concat(F.lit(f"{parsed.within}="), F.col(parsed.within).cast("string")) if parsed.within else F.lit("all")
    cells = obs.select("cell_id", F.col(group).alias("_g"), context.alias("context"), parsed.column().alias("level")).where("level is not null and context is not null")
    at = ["context", "level"]
    sizes = cells.groupBy(*at, "_g").agg(F.count("*").alias("_n"))
    met = layer.join(cells, "cell_id")
    stats = met.groupBy(*at, "_g", "gene_id").agg(F.sum("value").alias("_s"), F.count("*").alias("_k")).join(sizes, [*at, "_g"])
    stats = stats.select(*at, "_g", "gene_id", (F.col("_s") / F.col("_n")).alias("mean"), (F.col("_k") / F.col("_n")).alias("fraction"))
    weight = F.try_divide(F.col("mean"), F.sum("mean").over(Window.partitionBy(*at, "gene_id")))
    kept = stats.withColumn("weight", weight).where(F.col("fraction") >= least_share)
    overall = met.groupBy(*at).agg(F.sum("value").alias("_s"), F.countDistinct("gene_id").alias("_g")).join(cells.groupBy(*at).agg(F.count("*").alias("_c")), at)
    overall = overall.select(*at, (F.col("_s") / (F.col("_c") * F.col("_g"))).alias("mu"))
    left = pairs.join(kept.select(*at, F.col("_g").alias("source"), F.col("gene_id").alias("ligand"), F.col("mean").alias("l"), F.col("weight").alias("lw")), "ligand")
    right = kept.select(*at, F.col("_g").alias("target"), F.col("gene_id").alias("receptor"), F.col("mean").alias("r"), F.col("weight").alias("rw"))
    both = left.join(right, [*at, "receptor"]).join(overall, at)
    root = F.sqrt(F.col("l") * F.col("r"))
    return both.select(*at, *communication.EVENT, ((F.col("l") + F.col("r")) / 2).alias("lr_means"), (F.col("l") * F.col("r")).alias("expr_prod"), (F.col("lw") * F.col("rw")).alias("spec_weight"), F.try_divide(root, root + F.col("mu")).alias("lrscore"))


def normalise_events(events: DataFrame, display: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Candidate events (source, target, ligand, receptor, ...) with source_token and target_token, the clusters that
    their labels mean in ``display`` (cluster, label), both labels, route_family and branch_pair. A label that means
    no cluster, or several, is an error. Both tables are dimensions."""
    asked = events.select(F.trim("source").alias("token")).union(events.select(F.trim("target"))).distinct()
    found = resolve_tokens(asked, display)
    wrong = [r["token"] for r in found.where("n_matches != 1").orderBy("token").limit(5).collect()]
    if wrong:
        raise ValueError(f"labels that mean no cluster or several: {wrong}")
    out = events if "route_family" in events.columns else routed(events, lookup).drop("route_annotation")
    for side in ("source", "target"):
        token = found.select(F.col("token").alias("_t"), F.col("cluster").alias(f"{side}_token"))
        label = display.select(F.col("cluster").alias(f"{side}_token"), F.col("label").alias(f"{side}_label"))
        out = out.join(token, F.trim(out[side]) == F.col("_t")).drop("_t").join(label, f"{side}_token")
    return out.withColumn("branch_pair", F.concat_ws(" -> ", "source_label", "target_label"))


#: Scores by which candidate events are ranked, the first that a table has.
PRIORS = ("magnitude_rank", "specificity_rank", "lrscore", "lr_means", "expr_prod")


def candidate_events(events: DataFrame, allow: dict[str, list[str]] | None = None, *, key: list[str] | None = None, priors: tuple[str, ...] = PRIORS, limit: int = 200) -> DataFrame:
    """Events that the allow-lists of all columns let through, each key once by its best prior, the first ``limit``.
    Without a prior column the key alone orders them."""
    key = key or ["source_token", "target_token", "ligand", "receptor"]
    kept = events
    for column, values in (allow or {}).items():
        if values:
            kept = kept.where(F.col(column).isin(*values))
    prior = prior_column(events.columns, priors)
    if prior is None:
        return kept.dropDuplicates(key).orderBy(*key).limit(limit)
    return first_by_prior(kept, key, prior[0], prior[1], limit)


def annotation_summary(events: DataFrame, annotation: str, score: str | None = None, focus: str | None = None) -> DataFrame:
    """Events and mean score of each annotation (nulls: ``Unannotated``), by a focus column if one is named."""
    by = ([F.col(focus).cast("string").alias(focus)] if focus else []) + [F.coalesce(F.col(annotation).cast("string"), F.lit(UNANNOTATED)).alias(annotation)]
    return events.groupBy(*by).agg(F.count("*").alias("n_events"), (F.avg(score) if score else F.lit(None).cast("double")).alias("mean_score"))


SENSOR, PROXY = "metabolite-sensor", "associated-genes"


def metabolite_rescore(layer: DataFrame, obs: DataFrame, genes: DataFrame, events: DataFrame, sample: str, group: str, *, method: str = PROXY, estimates: DataFrame | None = None, least_senders: int = 3, least_receivers: int = 3) -> DataFrame:
    """Every metabolite event rescored in every sample: geometric mean of the sender's metabolite score and the
    receiver's sensor score, its log1p, and the first reason that stands against it.

    ``events``: event, source, target, metabolite, sensor and, for ``associated-genes``, genes split at ``;``. There the
    metabolite's score is the mean of its detected genes over the sender's cells, zeros included, and its share that
    of cells with any of them; for ``metabolite-sensor`` both come from ``estimates`` (sample, group, metabolite,
    score, share), which another program computes. Events, genes and samples are dimensions.
    """
    if method not in (SENSOR, PROXY):
        raise ValueError(f"a method is {SENSOR} or {PROXY}, not {method!r}")
    cells = obs.groupBy(sample, group).agg(F.count("*").alias("_n"))
    base = events.crossJoin(F.broadcast(obs.select(sample).distinct()))
    for side, name in (("source", "sender"), ("target", "receiver")):
        base = base.join(cells.select(sample, F.col(group).alias(side), F.col("_n").alias(f"{name}_cells")), [sample, side], "left").withColumn(f"{name}_cells", F.coalesce(f"{name}_cells", F.lit(0).cast("long")))
    known = genes.select(F.col("gene_id")).distinct()
    placed = layer.join(obs.select("cell_id", sample, group), "cell_id")
    sensors = events.select(F.col("sensor").alias("gene_id")).distinct()
    sensed = placed.join(sensors, "gene_id", "left_semi").groupBy(sample, F.col(group).alias("target"), F.col("gene_id").alias("sensor")).agg(F.sum("value").alias("_s"), F.sum((F.col("value") > 0).cast("long")).alias("_k"))
    base = base.join(known.select(F.col("gene_id").alias("sensor"), F.lit(True).alias("_sensor")), "sensor", "left").join(sensed, [sample, "target", "sensor"], "left")
    over = lambda c: F.try_divide(F.coalesce(c, F.lit(0.0)), F.col("receiver_cells"))
    base = base.withColumn("receiver_score", F.when(F.col("_sensor"), over("_s"))).withColumn("receiver_share", F.when(F.col("_sensor"), over("_k"))).drop("_s", "_k")
    if method == SENSOR:
        side = estimates.select(sample, F.col(group).alias("source"), "metabolite", F.col("score").alias("sender_score"), F.col("share").alias("sender_share"))
        base = base.join(side, [sample, "source", "metabolite"], "left")
        first = F.when(F.col("sender_score").isNull(), "metabolite_not_estimated")
    else:
        listed = events.select("event", "source", F.explode(F.split("genes", r"\s*;\s*")).alias("gene_id")).where("gene_id != ''").distinct()
        detected = listed.join(known, "gene_id", "left_semi")
        number = listed.groupBy("event").agg(F.count("*").alias("n_genes")).join(detected.groupBy("event").agg(F.count("*").alias("n_detected")), "event", "left")
        met = placed.join(detected.withColumnRenamed("source", "_g"), "gene_id").where(F.col(group) == F.col("_g"))
        sums = met.groupBy(sample, "event").agg(F.sum("value").alias("_s"), F.countDistinct(F.when(F.col("value") > 0, F.col("cell_id"))).alias("_k"))
        base = base.join(number, "event", "left").withColumn("n_genes", F.coalesce("n_genes", F.lit(0).cast("long"))).withColumn("n_detected", F.coalesce("n_detected", F.lit(0).cast("long"))).join(sums, [sample, "event"], "left")
        some = F.col("n_detected") > 0
        base = base.withColumn("sender_score", F.when(some, F.try_divide(F.coalesce("_s", F.lit(0.0)), F.col("sender_cells") * F.col("n_detected")))).withColumn("sender_share", F.when(some, F.try_divide(F.coalesce("_k", F.lit(0)), F.col("sender_cells")))).drop("_s", "_k")
        first = F.when(~some, "no_associated_genes_detected")
    few = F.when(F.col("sender_cells") < least_senders, "too_few_sender_cells").when(F.col("receiver_cells") < least_receivers, "too_few_receiver_cells")
    reason = F.coalesce(few, first, F.when(F.col("_sensor").isNull(), "sensor_gene_absent"))
    paired = F.sqrt(F.greatest("sender_score", F.lit(0.0)) * F.greatest("receiver_score", F.lit(0.0)))
    measured = [F.when(few.isNull(), F.col(c)).alias(c) for c in ("sender_score", "sender_share", "receiver_score", "receiver_share")]
    return base.select("event", sample, "source", "target", "metabolite", "sensor", "sender_cells", "receiver_cells", *(["n_genes", "n_detected"] if method == PROXY else []), *measured, reason.alias("missing_reason"), F.when(reason.isNull(), paired).alias("paired_score"), F.when(reason.isNull(), F.log1p(paired)).alias("score"))


def ligand_links(targets: DataFrame, activity: DataFrame, geneset: DataFrame, n_ligands: int = 30, n_targets: int = 200) -> DataFrame:
    """Top links: for the ligands of greatest activity, the gene set's targets of greatest score (ligand, gene_id,
    score, ligand_rank, link_rank). Ligands without an activity, as their scores don't vary, take no part."""
    order = F.desc(F.round("activity", 9))
    best = activity.where("activity is not null and not isnan(activity)").orderBy(order, "ligand").limit(n_ligands)
    ranked = best.withColumn("ligand_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, "ligand")))
    held = targets.join(F.broadcast(ranked.select("ligand", "ligand_rank")), "ligand").join(geneset.select("gene_id"), "gene_id", "left_semi").where("score > 0")
    place = F.row_number().over(Window.partitionBy("ligand").orderBy(F.desc(F.round("score", 9)), "gene_id"))
    return held.withColumn("link_rank", place).where(F.col("link_rank") <= n_targets).select("ligand", "gene_id", "score", F.col("ligand_rank").cast("long").alias("ligand_rank"), F.col("link_rank").cast("long").alias("link_rank"))


def sender_focused(layer: DataFrame, obs: DataFrame, group: str, sender: str, receiver: str, pairs: DataFrame, targets: DataFrame, geneset: DataFrame, *, least_share: float = 0.1, n_ligands: int = 30, n_targets: int = 200) -> tuple[DataFrame, DataFrame]:
    """(activities, links) of the ligands that the sender expresses and whose receptors the receiver does."""
    sizes = obs.groupBy(group).agg(F.count("*").alias("_n"))
    share = layer.where("value > 0").join(obs.select("cell_id", group), "cell_id").groupBy(group, "gene_id").agg(F.count("*").alias("_k")).join(sizes, group).where(F.col("_k") / F.col("_n") >= least_share)
    of = lambda name, c: share.where(F.col(group) == name).select(F.col("gene_id").alias(c))
    ligands = pairs.join(of(sender, "ligand"), "ligand", "left_semi").join(of(receiver, "receptor"), "receptor", "left_semi").select("ligand").distinct()
    held = targets.join(ligands, "ligand", "left_semi")
    activity = communication.ligand_activity(held, geneset)
    return activity, ligand_links(held, activity, geneset, n_ligands, n_targets)
