"""Quality rules with host-level verdicts.

Rules judge each document. Failures are then added up by host, and each host's failure rate is
shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts' rates (method of
moments). Documents of a host go, though they pass themselves, if its shrunk rate is over three
times the mean rate of hosts, where that is between a quarter and a half; below a quarter no host
is condemned, over a half each is. Small hosts stay near the prior, so a few failures condemn none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wt
from .store import bound_batches, stash

#: Rules: least words, and the most per cent of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A host's shrunk rate may be so many times the mean of all hosts, but for what these bounds allow or forbid.
HOST_RATIO, HOST_LOW, HOST_HIGH = 3.0, 0.25, 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    if len(offsets) == 2:
        return np.array([np.count_nonzero(flags[offsets[0] : offsets[1]])])
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _repeats(name: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the items that occur before in their text, and of those that occur elsewhere in it."""
    key = wt.mix64(name + wt.mix64(text.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same
    both = same.copy()
    both[:-1] |= same[1:]
    any_[order] = both
    return later, any_


def counts(column: pa.Array) -> list[np.ndarray]:
    """COUNTS of each text; nulls count as empty. Words and lines are compared by 64-bit names."""
    data, offsets = wt.texts(column)
    out = [np.zeros(len(offsets) - 1, np.int64) for _ in COUNTS]
    for lo, hi in wt.groups(offsets):
        raw, at = wt.group_bytes(data, offsets, lo, hi)
        starts, ends, first = wt.word_bounds(raw, at)
        own = slice(lo, hi)
        out[0][own] = np.diff(first)
        inside = wt.IS_WORD[raw]
        out[1][own] = _per_text(inside & ((raw & 0xC0) != 0x80), at)
        out[2][own] = _per_text(SYMBOLS[raw], at)
        # lines: from a text's start or behind a \n, to before the next
        breaks = np.flatnonzero(raw == 10)
        begin = np.union1d(at[:-1][np.diff(at) > 0], breaks + 1)
        begin = begin[begin < len(raw)]
        stop = np.append(begin[1:], len(raw))
        stop = stop - (raw[stop - 1] == 10)
        full = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
        begin, stop = begin[full], stop[full]
        text = np.searchsorted(at, begin, "right") - 1
        later, _ = _repeats(wt.slice_names(raw, begin, stop), text)
        out[3][own] = np.bincount(text[later], minlength=hi - lo)
        runs = wt.run_starts(first, 3)
        text = np.searchsorted(first, runs, "right") - 1
        _, twice = _repeats(wt.runs_names(wt.slice_names(raw, starts, ends), 3)[runs], text)
        covered = np.zeros(len(starts), bool)
        for k in range(3):
            covered[runs[twice] + k] = True
        out[4][own] = _per_text(covered, first)
    return out


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``id, host`` and COUNTS of each row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), *map(pa.array, counts(x.column(2)))], ["id", "host", *COUNTS])

    source = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    kind = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(run, f"id {kind['id']}, host {kind['host']}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def host_rates(judged: DataFrame) -> DataFrame:
    """``host, rate, mean``: the posterior mean failure rate of each host of rows ``host, base_failed``, and the prior's mean.

    The prior Beta(m k, (1 - m) k) has the mean m of the hosts' rates; k follows from how much
    more the rates vary than single documents' chance explains, kept between 1 and 10^6.
    """
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = stash(hosts, "hosts")
    rate = F.col("failed") / F.col("n")
    m, v, inv = hosts.agg(F.avg(rate), F.coalesce(F.var_samp(rate), F.lit(0.0)), F.avg(1 / F.col("n"))).first()
    m, chance = m or 0.0, (m or 0.0) * (1 - (m or 0.0))
    k = max(1.0, min(1e6, chance / max(v - chance * (inv or 0.0), 1e-9) - 1))
    return hosts.select("host", ((F.col("failed") + m * k) / (F.col("n") + k)).alias("rate"), F.lit(m).alias("mean"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, host_ratio: float = HOST_RATIO, host_low: float = HOST_LOW, host_high: float = HOST_HIGH) -> DataFrame:
    """Verdicts: ``id_col``, COUNTS, ``base_failed, host_rate, kept``, a row for each row.

    A null text has no words and fails; null hosts are one host. Repeated rows, and rows with null
    ids, count each. An empty table gives no rows. Further columns play no part.
    """
    judged = text_counts(docs, id_col, text_col, host_col)
    judged = stash(judged.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))), "rules")
    rates = host_rates(judged).withColumnRenamed("host", "_host")
    joined = judged.join(rates, F.col("host").eqNullSafe(F.col("_host")), "left")
    limit = F.round(F.least(F.greatest(F.col("mean") * host_ratio, F.lit(host_low)), F.lit(host_high)), 9)
    return joined.select(F.col("id").alias(id_col), *COUNTS, "base_failed", (~F.col("base_failed") & (F.round("rate", 9) <= limit)).alias("kept"), F.round("rate", 9).alias("host_rate"))
