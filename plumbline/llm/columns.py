"""Column helpers of the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that ends a word: space and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def upto(n: Column) -> Column:
    """The array 0 .. n-1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def spare(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores behind it as make it none of ``taken``; case is ignored."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
