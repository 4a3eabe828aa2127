"""Append-only journals: recovery, compaction and what is outstanding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compact(lines: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The last row of each key, with ``first_seen``: the least ordinal of the key."""
    columns = [c for c in lines.columns if c != key]
    last = F.max_by(F.struct(*columns), F.col(ordinal))
    return lines.groupBy(key).agg(last.alias("_last"), F.min(ordinal).alias("first_seen")).select(key, "_last.*", "first_seen")


def parse_lines(lines: DataFrame, schema: str, ordinal: str = "ordinal", text: str = "line") -> tuple[DataFrame, bool]:
    """Parsed rows of numbered JSON lines, and whether the last line was torn and dropped.

    A broken line anywhere else is an error. One aggregate row reaches the driver.
    """
    whole = F.try_parse_json(text).isNotNull() & F.json_object_keys(text).isNotNull()
    marked = lines.where(F.trim(text) != "").withColumn("_ok", F.coalesce(whole, F.lit(False)))
    last, bad_first, bad_last = marked.agg(F.max(ordinal), F.min(F.when(~F.col("_ok"), F.col(ordinal))), F.max(F.when(~F.col("_ok"), F.col(ordinal)))).first()
    if bad_first is not None and (bad_first != bad_last or bad_last != last):
        raise ValueError(f"line {bad_first} is broken")
    good = marked.where("_ok").select(ordinal, F.from_json(text, schema).alias("_row")).select(ordinal, "_row.*")
    return good, bad_first is not None


def outstanding(wanted: DataFrame, journal: DataFrame, files: DataFrame, key: str, file: str, sha: str) -> DataFrame:
    """Rows of ``wanted`` without a journal row whose file exists with the digest it was written with."""
    done = journal.join(files.select(file, sha), [file, sha], "left_semi")
    return wanted.join(done.select(key), key, "left_anti")
