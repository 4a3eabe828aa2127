"""Lines of text files with their numbers, read in blocks by many tasks.

Spark cuts a file into blocks and gives each line to the block in which it begins. A line's number
is the number of lines in the blocks before, from one count for each block, and its place in its own
block, which the task that reads it counts. So a file of any size is read twice and shuffled never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.chained import chained_sha256

#: Bytes of a file up to which its digest is taken of one row; that of a larger one goes from range to range.
WHOLE = 256 << 20


def _blocks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    lines = spark.read.options(**options).text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))


def _placed(lines: DataFrame) -> DataFrame:
    """``path, block, line, at``: lines with their place in their block, from 1; a block's lines come together, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for x in batches:
            new = np.ones(x.num_rows, bool)
            for k in (0, 1):
                encoded = x.column(k).dictionary_encode().indices.to_numpy()
                new[1:] &= encoded[1:] == encoded[:-1]
            new[1:] = ~new[1:]
            new[:1] = x.num_rows > 0 and last != (x.column(0)[0].as_py(), x.column(1)[0].as_py())
            begin = np.flatnonzero(new)
            at = np.arange(x.num_rows) + 1 + (0 if len(begin) and begin[0] == 0 else n)
            for b in begin[begin > 0] if len(begin) and begin[0] == 0 else begin:
                at[b:] = np.arange(x.num_rows - b) + 1
            if x.num_rows:
                last, n = (x.column(0)[-1].as_py(), x.column(1)[-1].as_py()), int(at[-1])
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), x.column(2), pa.array(at)], ["path", "block", "line", "at"])

    return lines.select("path", "block", "line").mapInArrow(run, "path string, block bigint, line binary, at bigint")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_sha256``: SHA-256 of the bytes of each file."""
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= WHOLE).select("path", F.sha2("content", 256).alias("file_sha256"))
    large = [r.path for r in files.where(F.col("length") > WHOLE).select("path").toLocalIterator()]
    if not large:
        return small
    return small.unionByName(spark.createDataFrame([(p, _large_digest(spark, p)) for p in large], "path string, file_sha256 string"))


def _large_digest(spark: SparkSession, path: str) -> str:
    lines = _blocks(spark, path, lineSep="\n")
    n, size, known = lines.agg(F.count("*"), F.sum(F.length("line")), F.max("size")).first()
    missing = known - size - n  # of a byte order mark, which the reader drops, and the end that the last line may lack
    return chained_sha256(_placed(lines), F.col("line"), [F.col("block"), F.col("at")], b"\xef\xbb\xbf" if missing > 0 else b"", b"\n", b"\n" if missing in (0, 3) else b"")[1]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_sha256, ordinal, line`` of text files: lines end at \\n, \\r\\n or \\r, blank ones are numbered but skipped, a leading BOM is dropped."""
    lines = _blocks(spark, path)
    counts = lines.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("path").alias("_path"), F.col("block").alias("_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    # a row for each block on the right; so small that it is broadcast as a rule, and else merged
    placed = _placed(lines).join(offsets, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    plain = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/*", "file:/")
    digests = file_digests(spark, path).select(F.regexp_replace("path", "^file:/*", "file:/").alias("_file"), "file_sha256")
    ordinal = F.col("_before") + F.col("at")
    text = F.decode("line", "UTF-8")
    text = F.when(ordinal == 1, F.regexp_replace(text, r"^\x{FEFF}", "")).otherwise(text)
    rows = placed.select(plain("path").alias("path"), ordinal.alias("ordinal"), text.alias("line"))
    return rows.where(F.trim("line") != "").join(digests, F.col("path") == F.col("_file")).select("path", "file_sha256", "ordinal", "line")
