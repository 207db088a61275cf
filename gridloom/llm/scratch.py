"""Shared scratch storage that cuts lineage.

Tables live below the folder the cluster names in ``spark.checkpoint.dir`` so that every executor and the
driver can read them; only where that setting is absent and all runs on one machine is a local folder chosen.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_doomed: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder; sets a local one for checkpoint() if a local session has none."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="gridloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clear() -> None:
    for spark, path in _doomed:
        try:
            _remove(spark, path)
        except Exception:  # the session has ended; its cluster clears the folder
            return


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows, as texts may be long; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


#: Rows may be hundreds of kilobytes: pages and row groups are measured at every row, not every hundred.
_LARGE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 16, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 16}


def release(spark: SparkSession) -> None:
    """Delete the written tables of all operators so far; frames that still read them can't be used any more."""
    for held in [x for x in _doomed if x[0] is spark]:
        _remove(*held)
        _doomed.remove(held)


class Scratch:
    """Written tables of one run of an operator. They are needed as long as its result is, so they stay until
    ``release`` or the end of the interpreter."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.home = f"{shared_folder(spark)}/gridloom-{uuid.uuid4().hex}"
        _doomed.append((spark, self.home))

    def table(self, frame: DataFrame, name: str) -> DataFrame:
        """Write the rows once and return a reader of the written table."""
        path = f"{self.home}/{name}"
        frame.write.options(**_LARGE_ROWS).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        _remove(self.spark, f"{self.home}/{name}")
