"""Tables that cut lineage, and bounds on what goes to Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..tables import shared_folder, stash, unstash

__all__ = ["bound_batches", "shared_folder", "stash", "unstash"]


def bound_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 16) -> None:
    """Bound what one Arrow batch to a Python worker holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
