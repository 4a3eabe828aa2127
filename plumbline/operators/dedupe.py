"""Duplicates and conflicts among rows with the same content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefolded


def caption_conflicts(rows: DataFrame, content: str, caption: str) -> DataFrame:
    """``content, n_rows, n_captions`` of contents with more than one distinct caption."""
    return rows.groupBy(content).agg(F.count("*").alias("n_rows"), F.countDistinct(caption).alias("n_captions")).where("n_captions > 1")


def resolve_duplicates(rows: DataFrame, content: str, caption: str, ordinal: str) -> DataFrame:
    """``rows`` with ``reason``: null for those that stay.

    All rows of a content with several captions are out; of equal captions the smallest ordinal
    stays. Two aggregates and a join, so a content that very many rows share meets in no one task.
    """
    facts = rows.groupBy(F.col(content).alias("_content")).agg(F.min(caption).alias("_low"), F.max(caption).alias("_high"), F.min(ordinal).alias("_first"))
    joined = rows.join(facts, F.col(content) == F.col("_content"))
    reason = F.when(F.col("_low") != F.col("_high"), "same_image_conflicting_captions").when(F.col(ordinal) != F.col("_first"), "duplicate_image_same_caption")
    return joined.withColumn("reason", reason).drop("_content", "_low", "_high", "_first")


def duplicate_statistics(rows: DataFrame, content: str, caption: str) -> DataFrame:
    """One row: groups of several rows, extra rows, groups with other captions, extra rows with the same caption."""
    groups = rows.groupBy(content).agg(F.count("*").alias("n"), F.countDistinct(caption).alias("captions")).where("n > 1")
    zero = F.lit(0).cast("long")
    total = lambda c: F.coalesce(F.sum(c), zero)
    return groups.agg(
        F.count("*").alias("n_groups"),
        total(F.col("n") - 1).alias("extra_rows"),
        F.count_if(F.col("captions") > 1).alias("alternative_caption_groups"),
        total(F.col("n") - F.col("captions")).alias("same_caption_extras"),
    )


def folded_collisions(rows: DataFrame, name: str) -> DataFrame:
    """``folded, n_names`` of folded names that several names share."""
    return rows.groupBy(casefolded(F.col(name)).alias("folded")).agg(F.countDistinct(name).alias("n_names")).where("n_names > 1")
