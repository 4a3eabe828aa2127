"""Deterministic splits that honour earlier assignments, and checks for leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component with rows of several splits goes to the one furthest on (fixed values).
PRIORITY = {"train": 0, "validation": 1, "test": 2}


def draw(seed: int, group: Column) -> Column:
    """A number in [0, 1): the first 64 bits of a digest of seed and group."""
    prefix = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256), 1, 16)
    return F.conv(prefix, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def split_of(seed: int, group: Column, test: float = 0.1, validation: float = 0.1) -> Column:
    """``test`` below the first bound, ``validation`` below the second, else ``train``."""
    if test < 0 or validation < 0 or test + validation >= 1:
        raise ValueError("ratios must not be negative and must leave a share for training")
    d = draw(seed, group)
    return F.when(d < test, "test").when(d < test + validation, "validation").otherwise("train")


def priority(split: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in PRIORITY.items():
        out = F.when(split == name, F.lit(rank)).otherwise(out)
    return out


def inherited(tags: DataFrame) -> DataFrame:
    """``root, inherited, tags, mixed`` of rows ``root, split``: the split furthest on, all splits, and whether there are several."""
    return tags.groupBy("root").agg(F.max_by("split", priority(F.col("split"))).alias("inherited"), F.array_sort(F.collect_set("split")).alias("tags")).withColumn("mixed", F.size("tags") > 1)


def leaks(rows: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """``key, value, splits``: values of the key columns that lie in several splits; empty if there is no leak."""
    each = rows.select(split, F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])).alias("x")).select(split, "x.*")
    return each.where("value is not null").groupBy("key", "value").agg(F.countDistinct(split).alias("splits")).where("splits > 1")


def overlap(held: DataFrame, training: DataFrame, group: str, content: str) -> DataFrame:
    """Rows of ``held`` whose group, or non-null content, is in ``training``; two joins that hash."""
    by_group = held.join(training.select(group).distinct(), group, "left_semi")
    by_content = held.where(F.col(content).isNotNull()).join(training.select(content).distinct(), content, "left_semi")
    return by_group.unionByName(by_content).distinct()


def split_report(rows: DataFrame, split: str = "split", group: str = "group_id") -> DataFrame:
    """Rows and groups of each split, zeros where there are none."""
    names = rows.sparkSession.createDataFrame([(s,) for s in PRIORITY], "split string")
    counts = rows.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("n_rows"), F.countDistinct(group).alias("n_groups"))
    return names.join(counts, "split", "left").select("split", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.coalesce("n_groups", F.lit(0).cast("long")).alias("n_groups"))
