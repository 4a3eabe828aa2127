"""Identity keys: what makes two rows the same book, context or content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .isbn import canonical_isbn
from .text import SPACE, casefolded, digest, nfkc


def _filled(value: Column) -> Column:
    return F.when(value != "", value)


def identity_keys(isbn: Column, title: Column, context: Column, source_text: Column, group: Column, has_context: Column) -> Column:
    """``isbn:``, ``title:``, ``context:`` and ``existing-group:`` keys of a row; parts without content give none.

    A context that is present, though empty, hides the source text.
    """
    number = _filled(F.regexp_replace(F.upper(isbn), "[^0-9X]", ""))
    name = _filled(F.regexp_replace(casefolded(nfkc(title)), r"[^\p{L}\p{N}]", ""))
    text = _filled(F.regexp_replace(nfkc(F.when(has_context, context).otherwise(source_text)), SPACE, ""))
    return F.array_compact(
        F.array(
            F.concat(F.lit("isbn:"), number),
            F.concat(F.lit("title:"), name),
            F.concat(F.lit("context:"), digest(text)),
            F.concat(F.lit("existing-group:"), _filled(group)),
        )
    )


def linked_keys(keys: Column, isbn: Column) -> Column:
    """Keys with the canonical number's key beside, in order, each once; an invalid number adds none."""
    return F.array_distinct(F.array_compact(F.concat(keys, F.array(F.concat(F.lit("isbn:"), canonical_isbn(isbn))))))
