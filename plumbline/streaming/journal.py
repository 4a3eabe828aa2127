"""A journal as a stream: keyed upserts of what files bring, last write wins.

Each micro-batch writes what it has of each key, its last row and first place, as a table of its own;
the state is what these tables and the last base give together. Every so many batches they
become a new base. So work follows the batch, and the whole state is written once in so many of them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.hadoop import Store

#: Batches between two bases.
BASE_EVERY = 64


def _folded(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    columns = [c for c in rows.columns if c not in (key, "first_seen")]
    last = F.max_by(F.struct(*columns), F.col(ordinal))
    return rows.groupBy(key).agg(last.alias("_last"), F.min("first_seen").alias("first_seen")).select(key, "_last.*", "first_seen")


def follow(spark: SparkSession, folder: str, schema: str, state: str, checkpoint: str, key: str, ordinal: str, base_every: int = BASE_EVERY) -> StreamingQuery:
    """Read new JSON-lines files of ``folder`` and fold them into Parquet tables below ``state``.

    A batch that is repeated after a failure overwrites its own tables only, so a restart gives the
    same state. The query runs until what is there has been read.
    """
    store = Store(spark)
    store.make(state)
    store.write(f"{state}/about.json", json.dumps({"key": key, "ordinal": ordinal}) + "\n")

    def fold(batch: DataFrame, number: int) -> None:
        own = _folded(batch.withColumn("first_seen", F.col(ordinal)), key, ordinal)
        own.write.mode("overwrite").parquet(f"{state}/batch={number}")
        if (number + 1) % base_every == 0:
            current(batch.sparkSession, state, number).write.mode("overwrite").parquet(f"{state}/base={number}")

    lines = spark.readStream.schema(schema).json(folder)
    return lines.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, state: str, number: int) -> DataFrame:
    """The state after a batch."""
    store = Store(spark)
    about = json.loads(store.read(f"{state}/about.json"))
    # a base of this very batch may be half written
    bases = [int(n.removeprefix("base=")) for n in store.names(state) if n.startswith("base=")]
    base = max((n for n in bases if n < number and store.exists(f"{state}/base={n}/_SUCCESS")), default=-1)
    paths = [f"{state}/base={base}"] * (base >= 0) + [f"{state}/batch={n}" for n in range(base + 1, number + 1)]
    return _folded(spark.read.parquet(*paths), about["key"], about["ordinal"])
