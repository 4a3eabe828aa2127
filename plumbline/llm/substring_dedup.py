"""Substring deduplication with suffix automata of reference shards.

A suffix automaton of reference passages holds all their substrings, each state with the smallest
id that has its substrings. A text is streamed through it word by word; its matching statistics
say how long the longest known run of words up to each place is, and runs of a window's length or
more are cut out if a smaller id has them.

An automaton of the whole corpus has no size bound, so shards are not sent to all texts. Shards are cut
by the anchors of windows (see ``anchors``): every place of a repeated window has the same anchor,
so a shard holds the passages around some anchors, in a bounded number of words, and all texts
which may match it reach it by a shuffle. Equal passages come as one, with the smallest id of
their texts; every passage, also one alone under its anchor, is streamed through its shard, and
only windows that the automaton reports go. For a reference of a bounded size, ``remove_reference``
broadcasts its automaton.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import words as wt
from .anchors import CROWD, Words, candidates, judged, pieces
from .columns import BLANKS, WORD
from .store import bound_batches, stash

WINDOW = 50
#: Stands for a null id.
LAST = 2**63 - 1
#: About so many words are in a shard, more where one anchor has more.
SHARD = 8000
#: Words of a reference up to which its automaton may be broadcast.
BROADCAST_WORDS = 500_000


class Automaton:
    """Suffix automaton of several sequences; ``least`` has the smallest value with a state's substrings."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, value, moves: dict) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.least.append(value)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, q: int, x) -> int:
        """The state of the longest substring that p and x make; split off q if that holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, self.least[q], dict(self.next[q]))
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = twin
            p = self.link[p]
        return twin

    def add(self, sequence: list, value) -> None:
        """Add a sequence; later ones must not have smaller values."""
        last = 0
        for x in sequence:
            p = last
            if x in self.next[p]:
                last = self._split(p, self.next[p][x], x)
                continue
            last = self._state(self.length[p] + 1, value, {})
            while p >= 0 and x not in self.next[p]:
                self.next[p][x] = last
                p = self.link[p]
            self.link[last] = 0 if p < 0 else self._split(p, self.next[p][x], x)

    def finish(self) -> Automaton:
        """Hand smallest values on from longer substrings to their suffixes."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            p = self.link[s]
            if self.least[p] is None or self.least[s] < self.least[p]:
                self.least[p] = self.least[s]
        return self

    def windows(self, sequence: Iterable, size: int) -> Iterator[tuple[int, object]]:
        """Matching statistics: (start, smallest value) of each window that the automaton has."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, x in enumerate(sequence):
            while state and x not in nxt[state]:
                state = link[state]
                matched = length[state]
            if x in nxt[state]:
                state, matched = nxt[state][x], matched + 1
            # the state of the last `size` words is all that counts from here on
            while length[link[state]] >= size if state else False:
                state = link[state]
                matched = length[state]
            if matched >= size:
                yield i + 1 - size, self.least[state]


def _runs(found: Iterator[tuple[int, object]]) -> list[tuple]:
    out: list[tuple] = []
    for at, v in found:
        if out and out[-1][1] == at - 1 and out[-1][2] == v:
            out[-1] = (out[-1][0], at, v)
        else:
            out.append((at, at, v))
    return out


def _compare(window: int):
    def compare(hashes: list[int], bodies: list[bytes], values: list) -> list[list[tuple]]:
        """Stream all pieces through the automata of shards of about ``SHARD`` words, each of whole anchors."""
        out: list[list[tuple]] = [[] for _ in bodies]
        split: dict[int, list[bytes]] = {}
        size = 0

        def judge() -> None:
            shard = Automaton()
            for i in sorted(split, key=values.__getitem__):
                shard.add(split[i], values[i])
            shard.finish()
            for i, sequence in split.items():
                out[i] = _runs(shard.windows(sequence, window))
            split.clear()

        for _, own in groupby(range(len(bodies)), key=hashes.__getitem__):
            for i in own:
                split[i] = bodies[i].split(b" ")
                size += len(split[i])
            if size >= SHARD:
                judge()
                size = 0
        judge()
        return out

    return compare


def _segments(text: str | None) -> Iterator[tuple[list[bytes], int]]:
    """A text's words, about a megabyte at a time, and the place of the first."""
    for part, base in wt.word_segments(np.frombuffer((text or "").encode(), np.uint8), 0, 1 << 20):
        # bytes.split() ends words at space and 0x09 to 0x0D only
        yield part.tobytes().split(), base


def _cut(text: str | None, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, bytes]]:
    """For each segment its words, removed words, and the kept ones joined by one space; spans of words (a, b)."""
    spans = sorted(spans)
    for words, base in _segments(text):
        gone, end = bytearray(len(words)), base + len(words)
        for a, b in spans[: bisect_left(spans, (end, 0))]:
            a, b = max(a - base, 0), min(b, end) - base
            gone[a:b] = b"\1" * (b - a)
        spans = [x for x in spans if x[1] > end]
        yield len(words), sum(gone), b" ".join([w for w, g in zip(words, gone, strict=True) if not g])


def _schema(id_col: str, id_type: str, with_text: bool) -> str:
    return f"`{id_col}` {id_type}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text


def _cut_batches(rows: DataFrame, id_col: str, spans_of, with_text: bool) -> DataFrame:
    """Rows ``id, text, x``: cut what ``spans_of(text, x)`` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n, removed, sha, kept = [], [], [], []
            for text, own in zip(x.column(1).to_pylist(), x.column(2).to_pylist(), strict=True):
                total, gone, digest, parts, space = 0, 0, hashlib.sha256(), [], b""
                for words, less, left in _cut(text, spans_of(text, own)):
                    total, gone = total + words, gone + less
                    if left:
                        digest.update(space + left)
                        parts += [space + left] * with_text
                        space = b" "
                n.append(total)
                removed.append(gone)
                sha.append(digest.hexdigest())
                if with_text:
                    kept.append(b"".join(parts).decode())
            arrays = [x.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())] + [pa.array(kept, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    return rows.mapInArrow(run, _schema(id_col, rows.schema["id"].dataType.simpleString(), with_text))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, crowd: int = CROWD, with_text: bool = False) -> DataFrame:
    """Texts without words of windows that a smaller id has: ``id_col, n_words, n_removed, kept_sha256``.

    Words are compared as they are; all windows are judged on the input. A null text has no words.
    Ids are of an integer type, others are a ValueError; a null id counts as larger than any, rows that
    repeat an id have none smaller than each other and are cut each for itself. ``kept`` holds the words that stay, joined by
    one space, if asked. Empty table: no rows. Further columns play no part.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise ValueError(f"{id_col} is no integer")
    bound_batches(docs.sparkSession, rows=1000, megabytes=8)
    items = Words(window, max(1, window // 6))
    # a null id is larger than any; rows that repeat an id but not its text stay apart
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    source = docs.select(F.struct(number.alias("id"), F.xxhash64(text_col).alias("row")).alias("id"), F.col(text_col).alias("text"))
    cand = candidates(source, items, F.min("id.id") < F.max("id.id"))
    # a window's value is the smallest id that has it
    runs = judged(pieces(cand, items), items, F.min("id.id"), _compare(window), F.min("v"), crowd)
    each = runs.select("id", "start", F.explode("runs").alias("r")).where(F.col("r.v") < F.col("id.id"))
    spans = each.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + window).alias("b"))).alias("spans"))
    hit = cand.join(spans.hint("merge"), F.col("id") == F.col("_id")).select("id", "text", "spans")
    cut = stash(_cut_batches(hit, "id", lambda _, own: [(s["a"], s["b"]) for s in own], with_text), "cut")
    # other texts stay as they are: their figures need no join of texts
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "))
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    whole = source.select("id", n.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.sha2(joined, 256).alias("kept_sha256"), *[joined.alias("kept")] * with_text)
    rest = whole.join(cut.select(F.col("id").alias("_id")).distinct().hint("merge"), F.col("id") == F.col("_id"), "left_anti")
    return rest.unionByName(cut).withColumn("id", F.nullif(F.col("id.id"), F.lit(LAST))).withColumnRenamed("id", id_col)


def remove_reference(docs: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text", reference_text: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Texts without words of windows that a reference of bounded size has; columns as above.

    Raises ValueError for references over ``BROADCAST_WORDS`` words; put those into ``docs`` with
    small ids and use ``substring_dedup``.
    """
    size = reference.agg(F.sum(F.regexp_count(reference_text, F.lit(WORD)).cast("long"))).first()[0] or 0
    if size > BROADCAST_WORDS:
        raise ValueError(f"the reference has {size} words, over {BROADCAST_WORDS}")
    shard = Automaton()
    for row in reference.select(reference_text).collect():  # its size was checked
        shard.add([w for words, _ in _segments(row[0]) for w in words], 0)
    shipped = docs.sparkSession.sparkContext.broadcast(shard.finish())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).alias("x"))

    def spans_of(text: str | None, _) -> list[tuple[int, int]]:
        words = (w for own, _ in _segments(text) for w in own)
        return [(a, b + window) for a, b, _ in _runs(shipped.value.windows(words, window))]

    return _cut_batches(rows, id_col, spans_of, with_text)
