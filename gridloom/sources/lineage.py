"""Cuts a plan's lineage in the folder that all machines share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def materialise(rows: DataFrame) -> DataFrame:
    """Rows written once below ``spark.checkpoint.dir``; a local folder serves only where that is unset and all runs
    on one machine."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gridloom-"))
    return rows.checkpoint()
