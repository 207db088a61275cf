"""A dataset as a handful of tables that share keys.

obs (cell_id, ...), var (gene_id, ...), counts (cell_id, gene_id, layer, value), obsm (cell_id, key, vec),
rounds and round_labels, and any number of result tables by name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYERS = ("counts_cb", "counts_raw", "X")


@dataclass
class Dataset:
    obs: DataFrame
    var: DataFrame
    counts: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def layer(self, name: str | None = None) -> DataFrame:
        """Triples of a layer; without a name, of the first preferred one there is."""
        if name is None:
            have = {r["layer"] for r in self.counts.select("layer").distinct().collect()}  # a few names
            name = next((x for x in LAYERS if x in have), None)
            if name is None:
                raise KeyError(f"none of the layers {LAYERS}")
        return self.counts.where(F.col("layer") == name).drop("layer")

    def subset(self, cells: DataFrame) -> Dataset:
        """The cells listed, with their counts."""
        keep = cells.select("cell_id").distinct()
        return Dataset(self.obs.join(keep, "cell_id", "left_semi"), self.var, self.counts.join(keep, "cell_id", "left_semi"), dict(self.tables))
