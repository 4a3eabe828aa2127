"""Galleries and ledgers of rendered rows, as lines of HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escape, prompt_text, proxy_tokens
from ..tables import with_ordinal


def cell(image: Column, caption: Column) -> Column:
    """A figure of an image and its caption, both escaped."""
    return F.concat(F.lit('<figure><img src="'), html_escape(image), F.lit('"><figcaption>'), html_escape(caption), F.lit("</figcaption></figure>"))


def paired_gallery(outputs: DataFrame, row: str, seed: str, condition: str, image: str, caption: str) -> DataFrame:
    """``row, seed, html``: one line for each row and seed, a cell for each condition in its order.

    Lines stay rows of a table, so a page of any length is written by many tasks; a line has as
    many cells as there are conditions.
    """
    cells = F.transform(F.array_sort(F.collect_list(F.struct(condition, cell(F.col(image), F.col(caption)).alias("html")))), lambda x: x["html"])
    return outputs.groupBy(row, seed).agg(F.concat(F.lit("<div>"), F.concat_ws("", cells), F.lit("</div>")).alias("html"))


def prompt_gallery(outputs: DataFrame, caption: str, image: str, order: str) -> DataFrame:
    """``order, html``: one line for each rendered prompt, its caption and its image, both escaped."""
    line = F.concat(F.lit("<p>"), html_escape(F.col(caption)), F.lit('</p><img loading="lazy" src="'), html_escape(F.col(image)), F.lit('">'))
    return outputs.select(order, line.alias("html"))


def prompt_audit(prompts: DataFrame, prefix: str, caption: str, order: str, seed: int, most_tokens: int) -> DataFrame:
    """``prompts`` with what is rendered: ``prompt, tokens, seed``, and ``issue`` where a prompt is too long.

    Seeds follow the order of the prompts. Tokens are words: the proxy of a tokenizer.
    """
    placed = with_ordinal(prompts, [order], "_place")
    text = F.concat(F.lit(prefix), F.col(caption))
    tokens = proxy_tokens(prompt_text(prefix, F.col(caption)))
    issue = F.when(tokens > most_tokens, "prompt_too_long")
    return placed.select(*prompts.columns, text.alias("prompt"), tokens.alias("tokens"), (F.lit(seed) + F.col("_place")).cast("long").alias("seed"), issue.alias("issue"))
