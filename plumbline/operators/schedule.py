"""Learning rates and batch plans in closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import with_ordinal
from .select import epoch_order


def learning_rates(spark: SparkSession, steps: int, warmup: int, base: float) -> DataFrame:
    """``step, lr``: linear warm-up times a linear decay that stops at a tenth."""
    s = F.col("step")
    rise = F.least(F.lit(1.0), s / F.lit(max(1, warmup)))
    fall = F.least(F.lit(1.0), F.greatest(F.lit(0.1), (F.lit(steps) - s + 1) / F.lit(max(1, steps - warmup))))
    return spark.range(1, steps + 1).select(F.col("id").alias("step")).select("step", (base * rise * fall).alias("lr"))


def batch_plan(rows: DataFrame, key: str, accumulate: int, seed: int, epoch: int = 0) -> DataFrame:
    """``key, epoch, position, step, loss_weight`` of an epoch; its last batch may be short."""
    ordered = with_ordinal(rows.select(key, epoch_order(F.col(key), seed, F.lit(epoch)).alias("_order")), ["_order", key], "position")
    n = rows.agg(F.count("*")).first()[0]
    per_epoch = -(-n // accumulate)
    step = F.lit(epoch * per_epoch) + F.floor(F.col("position") / accumulate) + 1
    size = F.least(F.lit(accumulate), F.lit(n) - F.floor(F.col("position") / accumulate) * accumulate)
    return ordered.select(key, F.lit(epoch).alias("epoch"), "position", step.cast("long").alias("step"), (1 / size).alias("loss_weight"))
