"""Book numbers and the identities in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

#: Two digits, two digits and T, two digits and S, book number, record: the form of a pair's file name (fixed values).
STEM = r"^([0-9]{2})_([0-9]{2}T)_([0-9]{2}S)_([0-9Xx-]+)_([0-9]+)\z"


def _weighted(digits: Column, weights: list[int]) -> Column:
    """Sum of digits, X counting ten, times weights."""
    value = lambda c: F.when(c == "X", 10).otherwise(F.try_cast(c, "int") if hasattr(F, "try_cast") else c.try_cast("int"))
    parts = F.filter(F.split(digits, ""), lambda c: c != "")
    return F.aggregate(F.zip_with(parts, F.array(*[F.lit(w) for w in weights]), lambda c, w: value(c) * w), F.lit(0), lambda a, x: a + x)


def canonical_isbn(value: Column) -> Column:
    """ISBN-13 of a valid ISBN-10 or ISBN-13 (978, 979), null otherwise. White space and hyphens don't count."""
    raw = F.upper(F.regexp_replace(value, f"{SPACE}|-", ""))
    body = F.concat(F.lit("978"), F.substring(raw, 1, 9))
    thirteen = [1, 3] * 6
    check = ((10 - _weighted(body, thirteen) % 10) % 10).cast("string")
    ten = raw.rlike(r"^[0-9]{9}[0-9X]\z")
    ten_ok = _weighted(F.when(ten, raw), list(range(10, 0, -1))) % 11 == 0
    long_ok = _weighted(F.when(raw.rlike(r"^97[89][0-9]{10}\z"), raw), [*thirteen, 1]) % 10 == 0
    return F.when(ten & ten_ok, F.concat(body, check)).when(long_ok, raw)


def filename_identity(stem: Column) -> Column:
    """``category, text, scene, isbn, canonical_isbn, record`` of a stem; null if its form or number is wrong."""
    part = lambda i: F.regexp_extract(stem, STEM, i)
    canonical = canonical_isbn(part(4))
    fields = F.struct(part(1).alias("category"), part(2).alias("text"), part(3).alias("scene"), F.upper(part(4)).alias("isbn"), canonical.alias("canonical_isbn"), part(5).alias("record"))
    return F.when(stem.rlike(STEM) & canonical.isNotNull(), fields)
