"""Phrase collocations from count tries.

Each shard of the texts, some megabytes of a task's rows, is written as numbers of its words, in byte order
and language by language, and becomes a count trie of limited depth: its nodes are the runs of
words that lie within a piece of text, a child is told by its parent's number and its word's, and so
the trie comes out sorted. Tries of a task's shards merge there; what it has is serialised in sorted blocks,
one for each range of paths, and the blocks of a range merge. Ranges are of the paths' 64-bit names:
in the order of words, the children of one hot word would be in one range.

A phrase is no more frequent than its parts, so the tries are made a level at a time: the next level
has only children whose two parts of the level before are frequent, as a Bloom filter of fixed size
names them, and whose cell of a count sketch of fixed size reaches the least count. Both never
miss; they only save less as they fill up, and the merged counts decide. From the frequent paths, in order, a walk down the trie
gives each node the counts of the nodes above it, the left parts; suffix links, from a path to the path
without its first word, give the right parts, one link at a time. Words and paths of one shard are told
apart by 64-bit names; paths of different shards by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as wt
from .store import bound_batches, stash, unstash

U = np.uint64
#: Words of the longest phrase, its least count, the share of a phrase's count at which a longer one stands for it, in percent.
WORDS, LEAST, COVERED, TOP = 3, 10, 50, 2000
#: Bytes of text whose trie is made at once; bytes of a text that are in it at once.
SHARD, SEGMENT = 1 << 20, 1 << 19
#: Bits of the filter of frequent paths; parts that hot words, and languages at the end, are dealt to.
BITS, SALTS = 1 << 26, 16
#: Cells of the sketch that counts runs before their paths are written, and those of a row of it; paths that a task merges.
CELLS, CHUNK, ROWS = 1 << 24, 1 << 16, 1 << 19
OLD, JOINED = 1, 2
READ_AT_ONCE = "spark.sql.parquet.columnarReaderBatchSize"
UNKNOWN = "und"

# fixed values: what ends a piece, and what parts its words
IS_BREAK = np.zeros(256, bool)
IS_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[9, 32]] = False


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; they never cross texts."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IS_WORD[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    start[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _segments(raw: np.ndarray, keep: int, limit: int) -> Iterator[tuple[np.ndarray, int]]:
    """One text in segments that end behind a word; each begins with the last ``keep`` words before it, up to the byte given with it."""
    at = fresh = 0
    while True:
        end = min(len(raw), fresh + limit)
        while end < len(raw) and IS_WORD[raw[end]]:
            end += 1 + int(np.argmin(np.append(IS_WORD[raw[end + 1 : end + 65536]], False)))
        yield raw[at:end], fresh - at
        if end >= len(raw):
            return
        back = 4096
        while True:  # the start of the last words
            lo = max(at, end - back)
            starts, _ = _bounds(raw[lo:end], np.array([0, end - lo]))
            if len(starts) > keep or lo == at:
                break
            back *= 4
        at, fresh = lo + int(starts[-keep]) if keep and len(starts) >= keep else (lo if keep else end), end


def _extend(names: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Names of paths with one more word."""
    return wt.mix64(names * U(wt.BASE) + more)


def _string_names(column: pa.Array) -> np.ndarray:
    data, offsets = wt.texts(column)
    lo = int(offsets[0])
    return wt.slice_names(data[lo : int(offsets[-1])], offsets[:-1] - lo, offsets[1:] - lo)


class _Filter:
    """Bits that a name is looked up by: two of a Bloom filter of ``BITS``, or one of a sketch's ``CELLS``."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(names: np.ndarray) -> np.ndarray:
        return np.stack([names & U(BITS - 1), (names >> U(32)) & U(BITS - 1)])

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> U(6)] >> (at & U(63)) & U(1)).astype(bool)

    def __call__(self, names: np.ndarray) -> np.ndarray:
        if len(self.words) * 64 == CELLS:
            return self._bit(names & U(CELLS - 1))
        a, b = self.places(names)
        return self._bit(a) & self._bit(b)


def _filter(frequent: DataFrame, depth: int) -> _Filter:
    """The filter of paths ``lang, w1 .. w(depth)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            names = _string_names(x.column(0))
            for k in range(depth):
                names = _extend(names, _string_names(x.column(k + 1)))
            at = np.unique(_Filter.places(names))
            word, first = np.unique(at >> U(6), return_index=True)
            bits = np.bitwise_or.reduceat(U(1) << (at & U(63)), first) if len(first) else np.zeros(0, U)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    found = frequent.select("lang", *_path(depth)).mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(BITS // 64, U)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(U)
    return _Filter(words)


def _path(depth: int) -> list[str]:
    return [f"w{k + 1}" for k in range(depth)]


def _shard(data: np.ndarray, offsets: np.ndarray, langs: list[str], fresh: np.ndarray) -> pa.RecordBatch:
    """A shard as one row: its languages' words in order with counts, and its text as numbers of these.

    Of text i only the words from byte ``fresh[i]`` on are counted; ``OLD`` marks the others, ``JOINED``
    words whose piece goes on behind them.
    """
    low = wt.LOWER[data]
    starts, ends = _bounds(low, offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    flags = ((starts < offsets[text] + fresh[text]) * OLD).astype(np.uint8)
    broken = np.searchsorted(np.flatnonzero(IS_BREAK[low]), starts)
    flags[:-1] |= ((broken[1:] == broken[:-1]) & (text[1:] == text[:-1])) * np.uint8(JOINED)
    names, first, word = np.unique(wt.slice_names(low, starts, ends), return_index=True, return_inverse=True)
    flat = low.tobytes()
    words = pa.array([flat[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.binary())
    order = pc.sort_indices(words).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    known = sorted(set(langs), key=lambda x: x.encode())
    place = {x: i for i, x in enumerate(known)}
    code, at = np.unique(np.array([place[x] for x in langs], np.int64)[text] * len(order) + rank[word], return_inverse=True)
    count = np.bincount(at[flags & OLD == 0], minlength=len(code))
    lang, own = np.divmod(code, max(len(order), 1))
    text = words.take(pa.array(order[own])).cast(pa.string())
    packed = [lang.astype("<i4"), np.frombuffer(text.buffers()[1], "<i4", len(text) + 1), np.frombuffer(text.buffers()[2] or b"", np.uint8), count, at.astype("<i4"), flags]
    return pa.RecordBatch.from_arrays([pa.array([known], pa.list_(pa.string())), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], SHARD_COLUMNS)


SHARD_COLUMNS = ["langs", "lang", "offsets", "words", "f", "at", "flags"]


def _unpacked(x: pa.RecordBatch, i: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, words and counts of a shard's numbers, its text as numbers, and flags."""
    lang, offsets, words, f, at, flags = (x.column(k)[i].as_buffer() for k in range(1, 7))
    n = len(f) // 8
    word = pa.StringArray.from_buffers(n, offsets, words)
    return x.column(0)[i].values.take(pa.array(np.frombuffer(lang, "<i4"))), word, np.frombuffer(f, "<i8"), np.frombuffer(at, "<i4"), np.frombuffer(flags, np.uint8)


def _shards(docs: DataFrame, words: int) -> DataFrame:
    """Rows of ``_shard``, for phrases of up to ``words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(h[0]) for h in held)])
            offsets = np.concatenate([h[1][:-1] + e for h, e in zip(held, ends, strict=False)] + [ends[-1:]])
            return _shard(np.concatenate([h[0] for h in held]), offsets, [x for h in held for x in h[2]], np.concatenate([h[3] for h in held]))

        for x in batches:
            data, offsets = wt.texts(x.column(1))
            langs = [UNKNOWN if v is None else v for v in x.column(0).to_pylist()]
            for lo, hi in wt.groups(offsets, SEGMENT):
                raw, at = wt.group_bytes(data, offsets, lo, hi)
                parts = [(raw, at, np.zeros(hi - lo, np.int64))] if hi - lo > 1 or len(raw) <= SEGMENT else ((s, np.array([0, len(s)]), np.array([f])) for s, f in _segments(raw, words - 1, SEGMENT))
                for part, bounds, fresh in parts:
                    held.append((part, bounds, langs[lo:hi], fresh))
                    if sum(len(h[0]) for h in held) >= SHARD:
                        yield flush()
                        held.clear()
        if held:
            yield flush()

    return stash(docs.mapInArrow(run, "langs array<string>, " + ", ".join(f"{c} binary" for c in SHARD_COLUMNS[1:])), "shards")


def _runs(batches: Iterator[pa.RecordBatch], checks: list[_Filter]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]]:
    """For each shard the runs of len(checks) + 1 words whose parts pass: names, counts, paths of words but the last, last words; and what languages and words the numbers stand for.

    ``checks[k]`` is asked for names of k + 1 words. Words come once with their count, longer runs each time.
    """
    for x in batches:
        for i in range(x.num_rows):
            lang, word, f, at, flags = _unpacked(x, i)
            one = _string_names(word)
            name, path = _extend(_string_names(lang), one), np.arange(len(one))[:, None]
            if not checks:
                yield name, f, path[:, :0], path[:, 0], lang, word
                continue
            here = np.flatnonzero(checks[0](name)[at])
            node = at[here].astype(np.int64)
            for depth in range(1, len(checks) + 1):
                follows = np.flatnonzero((here[1:] == here[:-1] + 1) & (flags[here[:-1] + depth - 1] & JOINED > 0))
                here, up = here[follows], node[follows]
                last = at[here + depth].astype(np.int64)
                names = _extend(name[up], one[last])
                if depth == len(checks):
                    new = flags[here + depth] & OLD == 0
                    yield names[new], np.ones(int(new.sum()), np.int64), path[up[new]], last[new], lang, word
                    break
                live = checks[depth](names)
                here, names = here[live], names[live]
                pair, first, node = np.unique(up[live] << 32 | last[live], return_index=True, return_inverse=True)
                name, path = names[first], np.concatenate([path[pair >> 32], (pair & 0xFFFFFFFF)[:, None]], axis=1)


def _sketched(shards: DataFrame, filters: list[_Filter], least: int) -> _Filter:
    """The cells of a count sketch of the next level's runs that count ``least`` or more: others hold no frequent run."""
    depth, shared, most = len(filters) + 1, [shards.sparkSession.sparkContext.broadcast(f.words) for f in filters], min(least, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint8)
        for names, f, *_ in _runs(batches, [_Filter(b.value) for b in shared]):
            at, each = np.unique(names & U(CELLS - 1), return_inverse=True)
            cells[at] = np.minimum(cells[at] + np.bincount(each, f, len(at)), most)  # beyond the least count nothing is told apart
        rows = cells.reshape(-1, CHUNK)
        for lo in range(0, len(rows), 64):
            own = np.flatnonzero(rows[lo : lo + 64].any(axis=1)) + lo
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([rows[k].tobytes() for k in own], pa.binary())], ["chunk", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = None, np.zeros(CHUNK, np.uint8)
        out = lambda: pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([np.packbits(total >= most, bitorder="little").tobytes()])], ["chunk", "bits"])
        for x in batches:
            for k, cells in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                if k != chunk:
                    if chunk is not None:
                        yield out()
                    chunk, total = k, np.zeros(CHUNK, np.uint8)
                total = np.minimum(total.astype(np.uint16) + np.frombuffer(cells, np.uint8), most).astype(np.uint8)
        if chunk is not None:
            yield out()

    cells = shards.mapInArrow(count, "chunk bigint, cells binary")
    found = stash(cells.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk bigint, bits binary"), f"sketch-{depth}").toArrow()
    words = np.zeros((CELLS // CHUNK, CHUNK // 64), U)
    for chunk, bits in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
        words[chunk] = np.frombuffer(bits, "<u8")
    return _Filter(words.reshape(-1))


def _tries(shards: DataFrame, filters: list[_Filter], least: int, cut: int) -> DataFrame:
    """``range, block``: the next level of each task's trie, without what can't be frequent, as sorted blocks of paths with counts.

    A range has the paths whose names agree in the first ``cut`` bits, so that a hot prefix is in many.
    """
    depth, sketch = len(filters) + 1, _sketched(shards, filters, least)
    shared = [shards.sparkSession.sparkContext.broadcast(f.words) for f in (*filters, sketch)]
    columns = ["lang", *_path(depth)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *checks, dense = [_Filter(b.value) for b in shared]
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return _summed(pa.concat_tables(held), ["name", *columns])

        def blocks(trie: pa.Table) -> Iterator[pa.RecordBatch]:
            trie = trie.sort_by([("name", "ascending")])
            at = (trie.column("name").to_numpy() >> U(63 - cut) >> U(1)).astype(np.int64)
            own = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
            ends, trie = np.append(own[1:], len(at))[: len(own)], trie.drop_columns(["name"])
            for k in range(0, len(own), 64):
                packed = [_block(trie.slice(a, b - a)) for a, b in zip(own[k : k + 64].tolist(), ends[k : k + 64].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(at[own[k : k + 64]]), pa.array(packed, pa.binary())], ["range", "block"])

        for names, f, path, last, lang, word in _runs(batches, checks):
            keep = np.flatnonzero(dense(names) & (f > 0))
            # equal names of a shard are one path
            name, first, each = np.unique(names[keep], return_index=True, return_inverse=True)
            f, path = np.bincount(each, f[keep], len(name)).astype(np.int64), np.concatenate([path[keep[first]], last[keep[first]][:, None]], axis=1)
            held.append(pa.table([pa.array(name), lang.take(pa.array(path[:, 0])), *[word.take(pa.array(path[:, k])) for k in range(depth)], pa.array(f)], ["name", *columns, "f"]))
            if sum(map(len, held)) > ROWS:  # equal paths of a task's shards merge before they leave it
                held = [merged()]
                if len(held[0]) > ROWS // 2:
                    yield from blocks(held.pop())
        if held:
            yield from blocks(merged())

    return shards.mapInArrow(run, "range bigint, block binary")


def _summed(rows: pa.Table, columns: list[str]) -> pa.Table:
    return rows.group_by(columns, use_threads=False).aggregate([("f", "sum")]).rename_columns([*columns, "f"])


def _block(rows: pa.Table) -> bytes:
    """Paths in order, so that neighbours begin alike, and compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows.sort_by([(c, "ascending") for c in rows.column_names[:-1]]).combine_chunks())
    return sink.getvalue().to_pybytes()


def _merged(tries: DataFrame, depth: int, least: int) -> DataFrame:
    """``lang, w1 .., f``: paths that all tries together count ``least`` times or more; the blocks of a range merge in one task."""
    columns = ["lang", *_path(depth)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out() -> list[pa.RecordBatch]:
            whole = _summed(pa.concat_tables(held), columns)
            return whole.filter(pc.greater_equal(whole.column("f"), least)).to_batches(1 << 16)

        for x in batches:
            for k, block in zip(x.column(0).to_pylist(), x.column(1), strict=True):
                if k != at and held:
                    yield from out()
                    held = []
                at = k
                held.append(pa.ipc.open_stream(block.as_buffer()).read_all())
        if held:
            yield from out()

    schema = "lang string, " + "".join(f"{w} string, " for w in _path(depth)) + "f bigint"
    return stash(tries.repartition("range").sortWithinPartitions("range").mapInArrow(run, schema), f"frequent-{depth}")


def _totals(shards: DataFrame) -> DataFrame:
    """``lang, n``: all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for langs, lang, f in zip(*(c.to_pylist() for c in x.columns), strict=True):
                n = np.bincount(np.frombuffer(lang, "<i4"), np.frombuffer(f, "<i8"), len(langs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(n)], ["lang", "n"])

    return stash(shards.select("langs", "lang", "f").mapInArrow(run, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "totals")


def _levels(shards: DataFrame, words: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """Totals of languages, and the frequent paths of each length."""
    total, levels, filters = _totals(shards), [], []
    # so many ranges that one has the paths of a few shards
    cut = min(max(6, (shards.count() // 4).bit_length()), 24)
    for depth in range(1, words + 1):
        levels.append(_merged(_tries(shards, filters, least, cut), depth, least))
        if depth < words:
            filters.append(_filter(levels[-1], depth))
    unstash(shards)
    return total, levels


def _suffix_links(level: DataFrame, below: DataFrame, depth: int) -> DataFrame:
    """``level`` with ``r1 .. r(depth-1)``: counts of what follows its first k words, over the link to the path without its first word."""
    names = _path(depth)
    to = below.select(F.col("lang").alias("_lang"), *[F.col(w).alias(f"_{w}") for w in names[:-1]], F.col("f").alias("r1"), *[F.col(f"r{k}").alias(f"r{k + 1}") for k in range(1, depth - 1)], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    dealt = level.withColumn("_of", F.pmod(F.xxhash64("w1"), F.lit(SALTS)).cast("int"))
    on = reduce(Column.__and__, [F.col(a) == F.col(f"_{b}") for a, b in zip(names[1:], names[:-1], strict=True)], (F.col("lang") == F.col("_lang")) & (F.col("_of") == F.col("_salt")))
    return dealt.join(to.hint("merge"), on).select(*level.columns, *[f"r{k}" for k in range(1, depth)])


def _walk(levels: list[DataFrame]) -> DataFrame:
    """All paths of two words or more with ``l1 ..``: the counts of their first k words, met on the way down to them.

    A word's subtree is walked in parts, each below a copy of the word's own node.
    """
    most = len(levels)
    names, extra = _path(most), [f"r{k}" for k in range(1, most)] + ["cover"]
    rows = []
    for depth, level in enumerate(levels, 1):
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))) if depth == 1 else F.pmod(F.xxhash64("w2"), F.lit(SALTS)).cast("int")
        filled = [F.col(c) if c in level.columns else F.lit(None).cast("string" if c[0] == "w" else "bigint").alias(c) for c in [*names, *extra]]
        rows.append(level.select("lang", "f", F.lit(depth).alias("depth"), salt.alias("salt"), *filled))
    order = Window.partitionBy("lang", "w1", "salt").orderBy(*[F.asc_nulls_first(w) for w in names[1:]]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = [F.last(F.when(F.col("depth") == k, F.col("f")), ignorenulls=True).over(order).alias(f"l{k}") for k in range(1, most)]
    return reduce(DataFrame.unionByName, rows).select("*", *above).where("depth > 1")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = WORDS, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of 2 to ``words`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and U+000A to U+000D into pieces, these at
    spaces and tabs into words. ``n`` counts a language's words, ``a`` a phrase's places (at least ``least``),
    ``l`` and ``r`` those of its two parts at the cut with the lowest floor(1000000 a a / (l r)), the first
    of equal ones. Phrases inside a longer one that has ``covered`` percent of their places or more go.
    By score, then ``a``, both falling, then phrase in byte order. A null language is ``und``, a null text
    empty; repeated rows count again; an empty table gives no rows. Counts are exact; scores are exact
    up to counts of 10^15.
    """
    spark = docs.sparkSession
    bound_batches(spark, 200, 4)
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    before = spark.conf.get(READ_AT_ONCE)
    spark.conf.set(READ_AT_ONCE, "8")  # a shard is a row of a megabyte; all that reads shards is done when this is undone
    try:
        total, levels = _levels(_shards(source, words), words, least)
    finally:
        spark.conf.set(READ_AT_ONCE, before)
    linked = levels[:1]
    for depth in range(2, words + 1):
        linked.append(stash(_suffix_links(levels[depth - 1], linked[-1], depth), f"linked-{depth}"))
    for depth in range(2, words):
        longer, names = levels[depth], _path(depth + 1)
        parts = [longer.select("lang", *[F.col(w).alias(t) for w, t in zip(own, names[:-1], strict=True)], "f") for own in (names[:-1], names[1:])]
        most = parts[0].unionByName(parts[1]).groupBy("lang", *names[:-1]).agg(F.max("f").alias("cover"))
        linked[depth - 1] = linked[depth - 1].join(most.hint("merge"), ["lang", *names[:-1]], "left")
    found = _walk(linked).where(f"cover IS NULL OR 100 * cover < {int(covered)} * f")
    whole = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    cuts = [F.when(F.col("depth") > k, F.struct(F.expr(f"(1000000 * ({whole('f')} * {whole('f')})) div ({whole(f'l{k}')} * {whole(f'r{k}')})").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, words)]
    scored = found.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select("lang", F.concat_ws(" ", *_path(words)).alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # each part of a language ranks its own first, so no task sorts a whole language
    parts = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS * 4)))
    few = parts.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total.withColumnRenamed("lang", "_lang").hint("merge"), F.col("lang") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
