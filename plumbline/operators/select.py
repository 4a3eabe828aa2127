"""Reproducible selections: hash order, top-k by split, diverse groups, seeds, cross products."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import with_ordinal


def hash_order(key: Column) -> Column:
    """A pseudo-random order that input order has no part in."""
    return F.sha2(key.cast("string"), 256)


def top_per_split(rows: DataFrame, key: str, limits: dict[str, int], split: str = "split", salts: int = 64) -> DataFrame:
    """The first rows of each split in hash order, where it has a limit; other splits whole.

    Each of ``salts`` parts of a split ranks its own rows first, so no task sorts a whole split.
    """
    limit = F.lit(None).cast("long")
    for name, n in limits.items():
        limit = F.when(F.col(split) == name, F.lit(n).cast("long")).otherwise(limit)
    placed = rows.withColumn("_h", hash_order(F.col(key))).withColumn("_limit", limit)
    part = F.pmod(F.xxhash64("_h"), F.lit(salts))
    order = [F.col("_h"), F.col(key)]
    few = placed.where("_limit is not null").withColumn("_part", part)
    few = few.withColumn("_rank", F.row_number().over(Window.partitionBy(split, "_part").orderBy(*order))).where("_rank <= _limit")
    few = few.withColumn("_rank", F.row_number().over(Window.partitionBy(split).orderBy(*order))).where("_rank <= _limit")
    return few.drop("_part", "_rank", "_h", "_limit").unionByName(placed.where("_limit is null").drop("_h", "_limit"))


def diverse(rows: DataFrame, key: str, group: str, count: int) -> DataFrame:
    """``count`` rows: one of each group first, the others behind, both in hash order."""
    placed = rows.withColumn("_h", hash_order(F.col(key)))
    # the first of a group by an aggregate, not by sorting the group in one task
    firsts = placed.groupBy(group).agg(F.min(F.struct("_h", key)).alias("_first")).select(F.col("_first")[key].alias(key), F.lit(0).alias("_later"))
    ranked = placed.join(firsts, key, "left").withColumn("_later", F.coalesce("_later", F.lit(1)))
    return ranked.orderBy("_later", "_h", key).limit(count).drop("_later", "_h")


def running_seed(rows: DataFrame, order: list[str], base: int) -> DataFrame:
    """``rows`` with ``seed``: base plus the row's place."""
    return with_ordinal(rows, order).withColumn("seed", F.col("ordinal") + F.lit(base))


def noise_seed(base: int, key: Column) -> Column:
    """60 bits of a digest of base and key."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{base}:"), key.cast("string")), 256), 1, 15), 16, 10).cast("long")


def conditions(rows: DataFrame, names: list[str], seeds: list[int]) -> DataFrame:
    """Each row under each condition and seed, with their places; the lists are the caller's few parameters."""
    spread = F.explode(F.flatten(F.transform(F.array(*[F.struct(F.lit(i).alias("condition_at"), F.lit(n).alias("condition")) for i, n in enumerate(names)]), lambda c: F.transform(F.array(*[F.lit(s).cast("long") for s in seeds]), lambda s: F.struct(c["condition_at"].alias("condition_at"), c["condition"].alias("condition"), s.alias("seed"))))))
    return rows.select("*", spread.alias("_x")).select(*rows.columns, "_x.*")


def epoch_order(key: Column, seed: int, epoch: Column) -> Column:
    """A key that orders an epoch; unlike a seeded shuffle of a list it needs no list."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key.cast("string")), 256)


def epoch_place(ordinal: Column, n: int, seed: int, epoch: int) -> Column:
    """The place of row ``ordinal`` of ``n`` in an epoch: a permutation of 0 .. n-1 for each seed and epoch, without a sort.

    A Feistel network over a grid of about n cells, whose rounds add digests modulo its sides; a place
    that falls behind n walks on until it is below. At most a side's length of the grid lies behind n.
    """
    wide = math.isqrt(max(n - 1, 0)) + 1
    deep = max(1, -(-n // wide))
    key = f"{seed}:{epoch}:"

    def drawn(turn: Column, value: Column, below: int) -> Column:
        digest = F.sha2(F.concat(F.lit(key), turn.cast("string"), F.lit(":"), value.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % below

    def turned(s: Column, k: Column) -> Column:
        left, right = F.struct(((s["l"] + drawn(k, s["r"], wide)) % wide).alias("l"), s["r"].alias("r")), F.struct(s["l"].alias("l"), ((s["r"] + drawn(k, s["l"], deep)) % deep).alias("r"))
        return F.when(k % 2 == 0, left).otherwise(right)

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / deep).cast("long").alias("l"), (x % deep).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, turned, lambda s: s["l"] * deep + s["r"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(wide, 64))), once(ordinal.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
