"""Tables that cut lineage, in the folder that all executors share, and distributed ordinals."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Used only where the session names no folder and all executors are threads of the driver.
LOCAL_FOLDER = "/tmp/checkpoints/plumbline"
#: Files of a table where it has more partitions: so many for each core at least, and one for each so many scan partitions of its input.
PER_CORE, SCANS = 4, 2
#: Shuffle files go when the statement that made them has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a cluster without that setting is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (folder or LOCAL_FOLDER).rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a path of any Hadoop file system; a session that has ended leaves it to the folder's owner."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:
        pass


def _files(df: DataFrame) -> int:
    """How many files a table may have: partitions that are small against its input are written some to a file."""
    spark = df.sparkSession
    scan = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(max(PER_CORE * spark.sparkContext.defaultParallelism, size // (SCANS * scan)), 2**31 - 1)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Unlike a cached table the files outlive any executor. They go when the driver ends, or with
    ``unstash``; what was shuffled to make them goes at once, as nothing asks for it again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.coalesce(_files(df)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    atexit.register(remove_path, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed = path
    return out


def unstash(*tables: DataFrame) -> None:
    """Remove tables that ``stash`` returned and that no later step reads."""
    for table in tables:
        remove_path(table.sparkSession, table._stashed)


def with_ordinal(df: DataFrame, order: list, name: str = "ordinal") -> DataFrame:
    """``df`` with each row's place, from 0, in the order of the columns ``order``; these should be unique.

    Ranges are sorted apart; only one count for each range meets in one place.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stash(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ordinal")
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # a row for each range
    return placed.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + F.col("_at")).drop("_range", "_at", "_before")
