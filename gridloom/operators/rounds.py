"""Clustering rounds: versioned label sets with a parent, one of them active."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import code_of_rank
from .merge import relabel_by_size


def next_round_id(rounds: DataFrame, suffix: str) -> str:
    """``r{n}_{suffix}`` with n one above the greatest index."""
    top = rounds.agg(F.max(F.regexp_extract("round_id", r"^r(\d+)", 1).cast("int"))).first()[0]
    return f"r{0 if top is None else top + 1}_{suffix}"


def register(rounds: DataFrame, round_id: str, parent: str | None, round_type: str, best_resolution: float | None = None) -> DataFrame:
    """Rounds with one more row, not yet active; the id must be new."""
    if rounds.where(F.col("round_id") == round_id).limit(1).count():
        raise ValueError(f"round {round_id} exists")
    one = rounds.sparkSession.createDataFrame([(round_id, parent, round_type, best_resolution, False)], "round_id string, parent_round_id string, round_type string, best_resolution double, active boolean")
    return rounds.unionByName(one)


def described(labels: DataFrame, round_id: str) -> DataFrame:
    """What a round is registered with, a row a cluster: its cells, its identity map (cluster_id to itself) and number."""
    sizes = labels.where(F.col("round_id") == round_id).groupBy("round_id", "cluster_id").agg(F.count("*").alias("n_cells"))
    return sizes.select("round_id", "cluster_id", "n_cells", F.col("cluster_id").alias("mapped_id"), F.col("cluster_id").alias("renumbered_id"))


def stamp() -> Column:
    """The time of a registration, as an ISO text in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def project(rounds: DataFrame, labels: DataFrame, parent: str, embedding: str, suffix: str = "secondary_integration_projection") -> tuple[DataFrame, DataFrame, DataFrame]:
    """A projection: a child of a round with its labels and type ``projection``, made active, and the embedding that it
    belongs to as a table of inputs (round_id, key, value). An unknown parent is an error."""
    if not rounds.where(F.col("round_id") == parent).limit(1).count():
        raise KeyError(parent)
    name = next_round_id(rounds, suffix)
    more, held = child(rounds, labels, parent, name, "projection")
    inputs = rounds.sparkSession.createDataFrame([(name, "embedding", embedding)], "round_id string, key string, value string")
    return activate(more, name), held, inputs


def child(rounds: DataFrame, labels: DataFrame, parent: str, round_id: str, round_type: str) -> tuple[DataFrame, DataFrame]:
    """A shallow child: the parent's row with a new id and type, and a copy of its labels."""
    row = rounds.where(F.col("round_id") == parent).select(F.lit(round_id).alias("round_id"), F.lit(parent).alias("parent_round_id"), F.lit(round_type).alias("round_type"), "best_resolution", F.lit(False).alias("active"))
    return rounds.unionByName(row), labels.unionByName(labels.where(F.col("round_id") == parent).withColumn("round_id", F.lit(round_id)))


def activate(rounds: DataFrame, round_id: str) -> DataFrame:
    return rounds.withColumn("active", F.col("round_id") == round_id)


def active_labels(rounds: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.join(F.broadcast(rounds.where("active").select("round_id")), "round_id", "left_semi")


def refreshed(rounds: DataFrame, labels: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, display) of all rounds for a subset of the cells: labels of the others go, and sizes, order and display
    labels of each round are computed anew. Rounds without a label left have no rows."""
    kept = labels.join(cells.select("cell_id").distinct(), "cell_id", "left_semi").join(rounds.select("round_id"), "round_id", "left_semi")
    sizes = kept.groupBy("round_id", "cluster_id").agg(F.count("*").alias("n_cells"))
    order = Window.partitionBy("round_id").orderBy(F.desc("n_cells"), "cluster_id")
    ranked = sizes.withColumn("cluster_rank", (F.row_number().over(order) - 1).cast("long"))
    code = code_of_rank(F.col("cluster_rank"))
    return kept, ranked.withColumn("code", code).withColumn("display", F.concat(code, F.lit(": "), F.col("cluster_id").cast("string")))


def display(labels: DataFrame) -> DataFrame:
    """Sizes, order and display of one round's labels (cell_id, cluster_id): Cnn by size, then id."""
    return relabel_by_size(labels, "cluster_id")


def rebuild(obs: DataFrame, parts: DataFrame) -> DataFrame:
    """A round from label parts: cells without one are Unknown; clusters are numbered by size."""
    met = obs.select("cell_id").join(parts, "cell_id", "left").withColumn("label", F.coalesce("label", F.lit("Unknown")))
    return met.join(relabel_by_size(met, "label").select("label", "cluster_rank", "code"), "label")


def run_namespace(prefix: str, round_id: str, existing: list[str]) -> str:
    """``prefix_round_roundN`` with the next free N."""
    taken = {x for x in existing if x.startswith(f"{prefix}_{round_id}_round")}
    n = 1
    while f"{prefix}_{round_id}_round{n}" in taken:
        n += 1
    return f"{prefix}_{round_id}_round{n}"


def resolve_group_key(columns: list[str], explicit: str | None = None, preferred: tuple[str, ...] = ("sample_id", "sample", "batch")) -> str:
    """An explicit key that exists, else the first preferred one that does."""
    if explicit is not None:
        if explicit not in columns:
            raise KeyError(explicit)
        return explicit
    for name in preferred:
        if name in columns:
            return name
    raise KeyError(f"none of {preferred}")
