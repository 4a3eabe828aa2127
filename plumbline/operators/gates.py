"""Reason-coded validation: first failing check, reports, gates between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A stage's issues stop what follows; ``counts`` has them by reason."""

    def __init__(self, stage: str, counts: dict[str, int]):
        super().__init__(f"{stage}: " + ", ".join(f"{k} {v}" for k, v in sorted(counts.items())))
        self.stage, self.counts = stage, counts


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """The first reason whose condition holds; null if none does. Unknown conditions count as false."""
    out = F.lit(None).cast("string")
    for reason, failed in reversed(checks):
        out = F.when(F.coalesce(failed, F.lit(False)), F.lit(reason)).otherwise(out)
    return out


def reason_counts(events: DataFrame, reason: str = "reason") -> DataFrame:
    """``reason, n`` of rows with a reason."""
    return events.where(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))


def gate(stage: str, issues: DataFrame) -> None:
    """Raise GateError if there is an issue ``reason``. What reaches the driver is a row for each reason."""
    counts = {r.reason: r.n for r in reason_counts(issues).collect()}
    if counts:
        raise GateError(stage, counts)


def assert_retained(rows: DataFrame, key: str, expected: int | None = None) -> int:
    """Number of rows; ValueError if it isn't ``expected`` or keys repeat."""
    n, distinct = rows.agg(F.count("*"), F.countDistinct(key)).first()
    if distinct != n or (expected is not None and n != expected):
        raise ValueError(f"{n} rows with {distinct} distinct {key}, expected {expected}")
    return n
