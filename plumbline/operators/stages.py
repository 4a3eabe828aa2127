"""Finished stages of a run that is begun again: tables named by what they were made from.

A stage's name has a digest of the configuration, the inputs and the stages before it, so a table is
used again only where all of these agree. Its mark, written last, holds its row count, and one
without it, or with another number of rows, is made anew.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.hadoop import Store
from .chained import chained_sha256
from .lineage import config_digest


def input_revision(spark: SparkSession, path: str) -> str:
    """A digest of the names, lengths and times of the files of a folder, or of one file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    line = F.concat_ws(" ", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    return chained_sha256(files, line, [F.col("path")], between=b"\n")[1]


class Stages:
    """Tables below ``folder`` of a run with this configuration and these inputs.

    The first run writes down both. Another with other ones is refused by the keys that differ, as its
    stages would be made from something else.
    """

    def __init__(self, spark: SparkSession, folder: str, config: dict, inputs: dict[str, str | None]):
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), Store(spark)
        self.made: list[str] = []
        self.reused: list[str] = []
        revisions = {k: input_revision(spark, p) if p else None for k, p in inputs.items()}
        self.about = json.loads(json.dumps({"config": config, "inputs": inputs, "revisions": revisions}))
        self.digest = config_digest(self.about)
        record = f"{self.folder}/run.json"
        if self.store.exists(record):
            before = json.loads(self.store.read(record))
            differing = sorted(f"{part}.{k}" for part in self.about for k in {*self.about[part], *before[part]} if self.about[part].get(k) != before[part].get(k))
            if differing:
                raise ValueError(f"{folder} was begun with other values of {', '.join(differing)}")
        else:
            self.store.make(self.folder)
            self.store.write(record, json.dumps(self.about, ensure_ascii=False, indent=1, sort_keys=True) + "\n")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """The finished stage ``name``, or ``df`` written as it; stages are asked for in one order."""
        self.digest = hashlib.sha256(f"{self.digest}/{name}/{df.schema.simpleString()}".encode()).hexdigest()
        path = f"{self.folder}/{name}-{self.digest[:16]}"
        mark = f"{path}.done.json"
        if self.store.exists(mark) and self.store.exists(path):
            kept = self.spark.read.schema(df.schema).parquet(path)
            if kept.count() == json.loads(self.store.read(mark))["rows"]:
                self.reused.append(name)
                return kept
        self.store.delete(mark)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.store.write(mark, json.dumps({"rows": out.count()}) + "\n")
        self.made.append(name)
        return out
