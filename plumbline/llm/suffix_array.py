"""Suffix-array deduplication with two-stage sorting.

Of a block's suffixes only those smaller than their successors are sorted directly: by eight bytes
at a time, each group of ties jumping over its common prefix. The rest is induced: buckets are
scanned in order, and a suffix's predecessor that is no smaller goes to the next free place of its
own bucket. Both work on vectors. Neighbours with a common prefix of a window's length then mark
all repeated windows of the block exactly.

Blocks hold the pieces of text around repeated anchors (see ``anchors``), equal ones as one with
their number, which counts as neighbours; so all places of a repeated string are in one block, every
piece is sorted, and text whose anchors do not repeat is not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wt
from .anchors import CROWD, Bytes, candidates, judged, pieces
from .store import bound_batches, stash

U = np.uint64
LENGTH = 400


def _eight(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each place on, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view(order), (len(data) + 1,), (1,))


class _Prefixes:
    """Common prefixes of places, by polynomial hashes and a binary search."""

    def __init__(self, data: np.ndarray):
        self.power = wt._powers(wt.BASE, len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(wt._NAMES[data] * self.power[:-1], dtype=U)])

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        x = (self.sums[a + size] - self.sums[a]) * self.power[np.maximum(b - a, 0)]
        return x == (self.sums[b + size] - self.sums[b]) * self.power[np.maximum(a - b, 0)]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        out = most.copy()
        at = np.flatnonzero(~self._same(a, b, most))  # most places agree all the way
        a, b, lo, hi = a[at], b[at], np.zeros(len(at), np.int64), most[at] - 1
        while len(at):
            done = lo >= hi
            out[at[done]] = lo[done]
            keep = ~done
            at, a, b, lo, hi = at[keep], a[keep], b[keep], lo[keep], hi[keep]
            mid = (lo + hi + 1) // 2
            same = self._same(a, b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return out


def _sort_directly(data: np.ndarray, at: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The suffixes ``at`` in order; each counts with its first ``reach`` bytes, ties in any order.

    Ties on eight bytes form groups. The suffix of a group that reaches furthest is its pivot: the
    others fall before or behind it by the byte after their common prefix with it, further away
    the shorter that is, and those alike in both and in the next eight bytes are the next groups.
    """
    word = _eight(data, ">u8")
    byte = np.append(data, np.uint8(0))
    at = at[np.lexsort((-reach[at], word[at].astype(U)))]
    first = word[at].astype(U)
    group = np.cumsum(np.concatenate([[False], first[1:] != first[:-1]])) if len(at) else np.zeros(0, np.int64)
    prefixes, todo = None, np.arange(len(at))
    while True:
        g = group[todo]
        head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(g)))
        todo = todo[np.repeat(size > 1, size)]
        if not len(todo):
            return at
        prefixes = prefixes or _Prefixes(data)
        size = size[size > 1]
        own, g = at[todo], group[todo]
        pivot = np.repeat(own[np.cumsum(size) - size], size)
        common = prefixes.common(pivot, own, reach[own])
        on = common < reach[own]  # the others begin the pivot, so they are smaller, and done
        side = np.where(on & (byte[own + common] > byte[pivot + common]), 1, -1)
        near = -side * common
        w = np.where(on, word[own + common].astype(U), U(0))
        order = np.lexsort((-reach[own], w, on, near, side, g))
        at[todo] = own[order]
        keys = [k[order] for k in (g, side, near, on, w)]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        group[todo] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        todo = todo[keys[3]]


def suffix_array(data: np.ndarray, reach: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of ``data`` in order; with ``reach``, each by so many bytes of its own (ties in any order)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    d = data.astype(np.int16)
    # smaller than the successor: the next byte that differs is larger; the last suffix is not
    change = np.append(np.flatnonzero(d[1:] != d[:-1]), n - 1)
    nxt = np.repeat(change, np.diff(np.concatenate([[-1], change])))
    small = np.where(nxt < n - 1, d[nxt] < d[np.minimum(nxt + 1, n - 1)], False)
    direct = _sort_directly(data, np.flatnonzero(small), n - np.arange(n) if reach is None else reach)
    sa = np.full(n, -1, np.int64)
    count, n_small = np.bincount(data, minlength=256), np.bincount(data[direct], minlength=256)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    n_large = count - n_small
    # small suffixes fill the ends of their buckets
    own = data[direct]
    sa[start[own] + n_large[own] + np.arange(len(direct)) - (np.cumsum(n_small) - n_small)[own]] = direct
    head = start.copy()
    sa[head[data[n - 1]]] = n - 1
    head[data[n - 1]] += 1

    def induce(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        new = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
        size = np.diff(np.append(new, len(byte)))
        sa[head[byte] + np.arange(len(byte)) - np.repeat(new, size)] = before
        head[byte[new]] += size

    for c in np.flatnonzero(count):
        done = start[c]
        while done < head[c]:  # a scan may add to its own bucket
            done, entries = head[c], sa[done : head[c]]
            induce(entries)
        induce(sa[start[c] + n_large[c] : start[c] + count[c]])
    return sa


def repeated_starts(bodies: list[bytes], length: int = LENGTH, places: list[int] | None = None) -> list[np.ndarray]:
    """For each body, flags of the places where a string of ``length`` bytes starts that starts elsewhere too.

    A body may stand for several equal ones; each of its suffixes then is as many neighbours in the array.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    left = np.repeat(ends, sizes + 1) - np.arange(len(data))
    sa = suffix_array(data, np.clip(left, 1, length))
    # common prefixes of neighbours, among suffixes that have the length within their body
    sa = sa[left[sa] >= length]
    a, b, eight = sa[:-1], sa[1:], _eight(data, "<u8")
    live = np.arange(len(a))
    for k in [*range(0, length - 7, 8), length - 8]:
        live = live[eight[a[live] + k] == eight[b[live] + k]]
        if not len(live):
            break
    hit = np.zeros(len(data), bool)
    hit[a[live]] = hit[b[live]] = True
    if places is not None:
        hit[sa[np.repeat(np.array(places) > 1, sizes + 1)[sa]]] = True
    return [hit[e - s : e - s + max(0, s - length + 1)] for s, e in zip(sizes, ends, strict=True)]


def flag_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def _compare(length: int):
    def compare(hashes: list[int], bodies: list[bytes], values: list[int]) -> list[list[tuple]]:
        return [[(x, y, 2) for x, y in flag_runs(flags)] for flags in repeated_starts(bodies, length, values)]

    return compare


def cut_texts(column: pa.Array, spans: list) -> Iterator[tuple[int, int, int, bytes]]:
    """Bytes, removed bytes, removed runs and what is left of each text; spans of bytes (a, b)."""
    data, offsets = wt.texts(column)
    for i, own in enumerate(spans):
        raw = data[offsets[i] : offsets[i + 1]]
        left, end, removed, runs = [], 0, 0, 0
        for a, b in sorted((s["a"], s["b"]) for s in own or []):
            if a > end or not runs:
                left.append(raw[end:a].tobytes())
                removed, runs = removed + b - a, runs + 1
            elif b > end:
                removed += b - end
            end = max(end, b)
        left.append(raw[end:].tobytes())
        yield len(raw), removed, runs, b"".join(left)


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD, with_bytes: bool = False) -> DataFrame:
    """Texts without the bytes under repeated strings: ``id_col, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the
    corpus, its own text included; overlaps count, strings never cross texts, and all are judged
    on the input. A null text is empty; ids, null or repeated, only name rows, and each row counts.
    What is left comes as ``kept`` (bytes: a cut may split a character) if asked. Empty table: no rows.
    """
    bound_batches(docs.sparkSession, rows=1000, megabytes=8)
    items = Bytes(length, max(8, 1 << (length // 3).bit_length() - 1))
    # rows that repeat an id but not its text stay apart
    source = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row")).alias("id"), F.col(text_col).alias("text"))
    cand = candidates(source, items, F.sum("n") > 1)
    runs = judged(pieces(cand, items), items, F.count("*"), _compare(length), F.sum("v"), crowd)
    each = runs.select("id", "start", F.explode("runs").alias("r"))
    spans = each.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + length).alias("b"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = [(n, m, k, hashlib.sha256(left).hexdigest(), left) for n, m, k, left in cut_texts(x.column(1), x.column(2).to_pylist())]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [x.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())] + [pa.array(columns[4], pa.binary())] * with_bytes
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes)

    schema = f"id {source.schema['id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_bytes
    cut = stash(cand.join(spans.hint("merge"), F.col("id") == F.col("_id")).select("id", "text", "spans").mapInArrow(run, schema), "cut")
    # other texts stay as they are: without their bytes no join of texts is needed
    rest = _whole(source, with_bytes).join(cut.select(F.col("id").alias("_id")).distinct().hint("merge"), F.col("id") == F.col("_id"), "left_anti")
    return rest.unionByName(cut).withColumn("id", F.col("id.id")).withColumnRenamed("id", id_col)


def _whole(source: DataFrame, with_bytes: bool) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    zero = F.lit(0).cast("long")
    return source.select("id", F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"), *[text.alias("kept")] * with_bytes)
