"""Finding repeated windows: anchors, candidate texts, and pieces to compare.

A window is a fixed number of neighbouring items (words or bytes). Its anchor is the gram with the
least hash in it, the first one if several are equal: a function of the window's content, so equal
windows have equal anchors at equal places. Consecutive windows mostly share an anchor; the items
under the windows of one anchor are its piece. So whatever repeats meets under its anchor's hash:

1. each text emits the hashes of its anchors, about one for each half window; where grams repeat and
   neighbours have equal ones, these are one;
2. hashes with one place only go;
3. texts that keep a hash are read again and emit the pieces of these anchors;
4. equal pieces collapse, and only distinct pieces under one hash are compared.

Nothing is sampled: each window has exactly one anchor. A long text is read in segments that
overlap, so that each window still lies in one of them. Hashes with very many distinct pieces
(a common phrase in ever other surroundings, a crowd of near copies) are cut into shorter ranges
of windows that share more than the anchor, in the end into single windows, so no group that is
compared grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as wt
from .store import stash, unstash

U = np.uint64
#: Windows that are looked at together; their number fits the low bits of a key.
BLOCK, LOW = 1 << 19, 20
#: Distinct pieces under one hash up to which they are compared together.
CROWD = 1000


def anchors(names: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of all windows: place of the anchor, first and last window that it serves.

    ``names`` has the hash of the gram that starts at each item, ``first`` each text's first item.
    """
    out = []
    starts = wt.run_starts(first, window)
    width = window - gram + 1
    for a in range(0, len(starts), BLOCK):
        own = starts[a : a + BLOCK]
        lo = int(own[0])
        v = names[lo : int(own[-1]) + width]
        # windows of a block may lie far apart where texts are shorter than a window
        for b in range(0, len(v), BLOCK):
            part = v[b : b + BLOCK + width - 1]
            mine = own[(own >= lo + b) & (own < lo + b + BLOCK)]
            if not len(mine):
                continue
            least = (part >> U(LOW) << U(LOW)) | np.arange(len(part), dtype=U)
            size = 1
            while 2 * size <= width:
                least = np.minimum(least[:-size], least[size:])
                size *= 2
            if size < width:
                least = np.minimum(least[: len(part) - width + 1], least[width - size : len(part) - size + 1])
            at = (least[mine - lo - b] & U((1 << LOW) - 1)).astype(np.int64) + lo + b
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (mine[1:] != mine[:-1] + 1)])
            head = np.flatnonzero(new)
            out.append((at[head], mine[head], mine[np.append(head[1:], len(mine)) - 1]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Items:
    """What windows are made of."""

    window: int
    gram: int

    def parts(self, column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
        """Groups of texts as in ``words.parts``; the segments of a long text share window - 1 items, so each window is in one."""
        raise NotImplementedError

    def cut(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gram hashes, each text's first item, and byte starts and ends of the items."""
        raise NotImplementedError


class Words(Items):
    def __init__(self, window: int = 50, gram: int = 8):
        self.window, self.gram = window, gram

    def parts(self, column, limit):
        return wt.parts(column, self.window - 1, limit)

    def cut(self, raw, at):
        starts, ends, first = wt.word_bounds(raw, at)
        names = wt.runs_names(wt.slice_names(raw, starts, ends), self.gram)
        return names, first, starts, ends


class Bytes(Items):
    """Grams have a power of two of bytes, eight at least."""

    def __init__(self, window: int = 400, gram: int = 128):
        self.window, self.gram = window, gram

    def parts(self, column, limit):
        data, offsets = wt.texts(column)
        for lo, hi in wt.groups(offsets, limit):
            raw, at = wt.group_bytes(data, offsets, lo, hi)
            if hi - lo > 1 or len(raw) <= limit:
                yield lo, hi, raw, at, 0
                continue
            for a in range(0, max(1, len(raw) - self.window + 1), limit):
                segment = raw[a : a + limit + self.window - 1]
                yield lo, hi, segment, np.array([0, len(segment)]), a

    def cut(self, raw, at):
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(raw) + 1,), (1,))
        h, size = eight[: max(0, len(raw) - 7)].astype(U), 8
        while size < self.gram:
            h = h[:-size] * U(wt.BASE) + h[size:] if len(h) > size else h[:0]
            h ^= h >> U(29)
            size *= 2
        place = np.arange(len(raw) + 1)
        return wt.mix64(h), at, place[:-1], place[1:]


#: Windows of a run of equal anchors that are one piece, in windows' lengths.
RUN = 2


def _grouped(column: pa.Array, items: Items, limit: int = 1 << 19) -> Iterator[tuple]:
    """For each group of texts its items and its anchors: hash, text, place, first and last window, how many anchors.

    Where grams repeat, as in one byte again and again, each window has an anchor of its own with one
    hash: neighbours with one hash are one piece, up to ``RUN`` windows' lengths of them, at the first's place.
    """
    for lo, _, raw, at, base in items.parts(column, limit):
        names, first, starts, ends = items.cut(raw, at)
        where, head, tail = anchors(names, first, items.window, items.gram)
        h, text = names[where].view(np.int64), np.searchsorted(first, head, "right") - 1
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1]) | (head[1:] != tail[:-1] + 1)
        run = np.flatnonzero(new)
        part = (head - np.repeat(head[run], np.diff(np.append(run, len(h))))) // (RUN * items.window)
        new[1:] |= part[1:] != part[:-1]
        own = np.flatnonzero(new)
        last = np.append(own[1:], len(h))[: len(own)] - 1
        place = np.where(where[own] == where[last], where[own], -1)
        yield lo, base, raw, first, starts, ends, h[own], text[own], place, head[own], tail[last], last - own + 1


def anchor_hashes(docs: DataFrame, items: Items) -> DataFrame:
    """``h, id, n``: anchor hashes of each row ``id, text`` with how often the row has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for lo, _, _, _, _, _, h, text, _, _, _, n in _grouped(x.column(1), items):
                order = np.lexsort((h, text))
                h, text, n = h[order], text[order], n[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])[: len(h)]
                head = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(h[head]), x.column(0).take(pa.array(text[head] + lo)), pa.array(np.add.reduceat(n, head) if len(head) else n)], ["h", "id", "n"])

    return docs.mapInArrow(run, f"h bigint, id {docs.schema['id'].dataType.simpleString()}, n bigint")


def candidates(docs: DataFrame, items: Items, repeated: Column) -> DataFrame:
    """Rows ``id, text`` with a repeated anchor, and these anchors' hashes ``hs``.

    ``repeated`` is an aggregate over a hash's rows ``id, n``.
    """
    found = stash(anchor_hashes(docs, items), "anchors")
    twice = found.groupBy("h").agg(repeated.alias("twice")).where("twice").select("h")
    lists = found.join(twice.hint("merge"), "h").groupBy(F.col("id").alias("_id")).agg(F.collect_list("h").alias("hs"))
    out = stash(docs.join(lists.hint("merge"), F.col("id").eqNullSafe(F.col("_id"))).select("id", "text", "hs"), "candidates")
    unstash(found)
    return out


def pieces(cand: DataFrame, items: Items) -> DataFrame:
    """``h, body, id, start, a``: each repeated anchor's piece from item ``start`` on, the anchor at its item a.

    The items of a piece are joined by spaces if they are words. ``a`` is -1 if its windows have several anchors.
    """
    space = isinstance(items, Words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            lists = x.column(2)
            for lo, base, raw, first, starts, ends, h, text, where, head, tail, _ in _grouped(x.column(1), items):
                keep = np.zeros(len(h), bool)
                bounds = np.searchsorted(text, np.arange(len(first)))
                for i in range(len(first) - 1):
                    a, b = bounds[i], bounds[i + 1]
                    if b > a:
                        keep[a:b] = np.isin(h[a:b], lists[lo + i].values.to_numpy())
                h, text, where, head, tail = h[keep], text[keep], where[keep], head[keep], tail[keep]
                whole = raw.tobytes()
                a, b = starts[head], ends[tail + items.window - 1] if len(head) else head
                if space:
                    body = [b" ".join(whole[p:q].split()) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
                else:
                    body = [whole[p:q] for p, q in zip(a.tolist(), b.tolist(), strict=True)]
                for k in range(0, len(h), 4000):
                    s = slice(k, k + 4000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[s]), pa.array(body[s], pa.binary()), x.column(0).take(pa.array(text[s] + lo)), pa.array(head[s] - first[text[s]] + base), pa.array(np.where(where[s] < 0, -1, where[s] - head[s]))],
                        ["h", "body", "id", "start", "a"],
                    )

    return cand.mapInArrow(run, f"h bigint, body binary, id {cand.schema['id'].dataType.simpleString()}, start bigint, a bigint")


Compare = Callable[[list[bytes], list], list[list[tuple]]]


def compared(distinct: DataFrame, compare: Compare, value: str, block: int = 1 << 19) -> DataFrame:
    """Compare distinct pieces ``h, body, key, v`` that share a hash: ``key, runs``.

    ``compare(hashes, bodies, values)`` gets whole groups, up to about ``block`` bytes or one group
    at a time, and returns runs of windows ``(first, last, value)`` for each body.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for x in batches:
            for row in zip(*(c.to_pylist() for c in x.columns), strict=True):
                if size >= block and row[0] != held[-1][0]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield out(held)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        got = compare([r[0] for r in rows], [r[1] for r in rows], [r[3] for r in rows])
        runs = pa.array([[{"a": a, "b": b, "v": v} for a, b, v in g] for g in got], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("v", value_type)])))
        return pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.binary()), runs], ["key", "runs"])

    value_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[value]
    rows = distinct.select("h", "body", "key", "v").repartition("h").sortWithinPartitions("h", "key")
    return rows.mapInArrow(run, f"key binary, runs array<struct<a: bigint, b: bigint, v: {value}>>")


def split_pieces(crowded: DataFrame, items: Items, size: int) -> DataFrame:
    """``parent, offs, h, body, a, v``: pieces ``key, body, a, v`` cut into ranges of ``size`` windows.

    Ranges count from the anchor, so equal windows fall into equal ranges; all windows of a range
    share the items between the last one's start and the first one's end, and ``h`` names these.
    Equal ranges of a piece are two rows, the first for all ``offs`` but one, so that they count as several.
    """
    import xxhash

    space, window = isinstance(items, Words), items.window

    def ranges(body: bytes, a: int) -> Iterator[tuple[int, int, bytes, int]]:
        parts = body.split(b" ") if space else body
        join = b" ".join if space else bytes
        own = [(a, 0, len(parts) - window)]
        if a < 0:
            raw = np.frombuffer(body, np.uint8)
            names, first, _, _ = items.cut(raw, np.array([0, len(raw)]))
            own = zip(*(x.tolist() for x in anchors(names, first, window, items.gram)), strict=True)
        for at, head, tail in own:
            for r in range((at - tail) // size, (at - head) // size + 1):
                lo, hi = max(head, at - (r + 1) * size + 1), min(tail, at - r * size)
                core = join(parts[max(0, at - r * size) : at - (r + 1) * size + 1 + window])
                yield lo, xxhash.xxh64_intdigest(core, r) - 2**63, join(parts[lo : hi + window]), at - lo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = []
            for key, body, a, v in zip(*(c.to_pylist() for c in x.columns), strict=True):
                equal: dict[tuple, list[int]] = {}
                for lo, *rest in ranges(body, a):
                    equal.setdefault(tuple(rest), []).append(lo)
                for (h, part, at), offs in equal.items():
                    rows += [(key, own, h, part, at, v) for own in (offs[:-1], offs[-1:]) if own]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int64(), x.column(3).type]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["parent", "offs", "h", "body", "a", "v"])

    kind = crowded.schema["v"].dataType.simpleString()
    return crowded.select("key", "body", "a", "v").mapInArrow(run, f"parent binary, offs array<bigint>, h bigint, body binary, a bigint, v {kind}")


def _key() -> Column:
    """A piece's name: the digest of its hash and content."""
    return F.unhex(F.sha2(F.concat(F.encode(F.col("h").cast("string"), "UTF-8"), F.col("body")), 256))


def _distinct(found: DataFrame, value: Column) -> DataFrame:
    return stash(found.groupBy("h", "key").agg(F.min("body").alias("body"), F.min("a").alias("a"), value.alias("v")), "distinct")


def _runs_of(distinct: DataFrame, items: Items, compare: Compare, over: Column, crowd: int, sizes: tuple[int, ...]) -> DataFrame:
    """``key, runs`` of distinct pieces. Crowds under one hash are cut into shorter ranges, at last into windows."""
    kind = distinct.schema["v"].dataType.simpleString()
    large = distinct.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > crowd)
    large = stash(large.select("h"), "crowds") if sizes else None
    if large is None or large.isEmpty():
        return compared(distinct, compare, kind)
    few = compared(distinct.join(large, "h", "left_anti"), compare, kind)
    cut = stash(split_pieces(distinct.join(large, "h", "left_semi"), items, sizes[0]).withColumn("key", _key()), "ranges")
    inner = _runs_of(_distinct(cut, over), items, compare, over, crowd, sizes[1:]).where(F.size("runs") > 0)
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("off")).alias("a"), (r["b"] + F.col("off")).alias("b"), r["v"].alias("v")))
    back = cut.select("parent", F.explode("offs").alias("off"), "key").join(inner.hint("merge"), "key").groupBy(F.col("parent").alias("key")).agg(F.flatten(F.collect_list(moved)).alias("runs"))
    return few.unionByName(back)


def judged(found: DataFrame, items: Items, value: Column, compare: Compare, over: Column, crowd: int = CROWD) -> DataFrame:
    """Runs of windows of each piece: ``id, start, runs`` for all rows ``h, body, a, id, start``.

    ``value`` is an aggregate over equal pieces, ``over`` the same over values ``v``.
    """
    found = stash(found.withColumn("key", _key()), "pieces")
    width = items.window - items.gram + 1
    sizes = tuple(x for x in (64, 8, 1) if x < width)
    runs = _runs_of(_distinct(found, value), items, compare, over, crowd, sizes).where(F.size("runs") > 0)
    return found.select("id", "start", "key").join(runs.hint("merge"), "key").select("id", "start", "runs")
