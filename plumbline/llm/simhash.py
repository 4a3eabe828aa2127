"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: each shingle's XXH64 votes on 64 bits; a bit is 1 if over half of them have it.

Links: fingerprints with at most ``radius`` different bits. Cut into radius + 1 bands, two such
fingerprints agree in a band, so distinct fingerprints meet in buckets by (band, bits). A bucket
that outgrows ``bucket`` rows is dealt again by the bands of its other bits, until few bits are
free; what is still larger is compared chunk by chunk, in tasks of bounded size. In a bucket 64
bit planes hold the fingerprints vertically, one lane each; a query's bits are compared with a
plane at a time, carry-save counters add up all lanes' distances at once, and a block of lanes is
left as soon as every distance in it exceeds the radius. A bucket emits a spanning forest of its
links, so rows never grow with pairs.

Components: the smallest label spreads over the forest with pointer jumping, in rounds whose
tables lie in the shared folder. Copies share a fingerprint and take part as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import words as wt
from .store import bound_batches, stash

U = np.uint64
SHINGLE = 3
RADIUS = 3
#: Rows of a bucket over which it is dealt again, and lanes of a block.
BUCKET, LANES = 4096, 512
#: With four bands, the sixth deal leaves 11 of 64 bits free.
DEALS = 6


def _votes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the runs ``bounds[i] .. bounds[i+1]`` of hashes set each bit (runs, 64)."""
    ones = np.zeros((len(bounds) - 1, 64), np.int64)
    step = 1 << 16
    for a in range(0, len(hashes), step):
        b = min(a + step, len(hashes))
        bits = np.unpackbits(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo, hi = int(np.searchsorted(bounds, a, "right")) - 1, int(np.searchsorted(bounds, b, "left"))
        own = np.arange(lo, hi)
        own = own[bounds[own + 1] > bounds[own]]  # runs that have a hash here
        ones[own] += np.add.reduceat(bits, np.maximum(bounds[own], a) - a, axis=0, dtype=np.int32)
    return ones


def _majority(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Fingerprints whose bits are those set by over half of ``total``; 0 for none."""
    set_bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").reshape(len(total), 8).copy().view("<u8").reshape(len(total)).astype(U)


def fingerprint_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of hashes."""
    return _majority(_votes(hashes, bounds), np.diff(bounds))


def shingle_hashes(column: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """XXH64 of the shingles of texts lo .. hi-1, and bounds of each text's; a long text comes in several parts."""
    for lo, hi, raw, at, base in wt.parts(column, shingle - 1):
        starts, ends, first = wt.word_bounds(raw, at)
        packed, lengths = _spaced(raw, starts, ends), ends - starts
        s = np.cumsum(lengths + 1) - lengths - 1
        e = s + lengths
        count = np.diff(first)
        # a text of fewer words is one shingle; what follows an earlier part is not
        runs = np.where(count >= shingle, count - shingle + 1, 0 if base else np.minimum(count, 1))
        bounds = np.concatenate([[0], np.cumsum(runs)])
        doc = np.repeat(np.arange(len(count)), runs)
        a = first[doc] + np.arange(bounds[-1]) - bounds[doc]
        b = a + np.minimum(count[doc], shingle) - 1
        yield lo, hi, wt.xxh64_slices(packed, s[a], e[b]), bounds


def fingerprint_texts(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text; texts without a word, and nulls, have 0."""
    ones, total = np.zeros((len(column), 64), np.int64), np.zeros(len(column), np.int64)
    for lo, hi, hashes, bounds in shingle_hashes(column, shingle):
        ones[lo:hi] += _votes(hashes, bounds)
        total[lo:hi] += np.diff(bounds)
    return _majority(ones, total)


def _spaced(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Lower-case words, each with one space behind it, so that shingles are slices."""
    lengths = ends - starts + 1
    to = np.cumsum(lengths)
    out = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[to - 1] = False
    out[inside] = wt.LOWER[raw[wt.IS_WORD[raw]]]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` of each row; fp as a signed 64-bit number."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(fingerprint_texts(x.column(1), shingle).view(np.int64))], ["id", "fp"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp bigint")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit i of plane b is bit b of the i-th fingerprint."""
    words = -(-len(fps) // 64)
    padded = np.zeros(words * 64, U)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(U)


def within(queries: np.ndarray, planes: np.ndarray, lanes: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, lane) with at most ``radius`` different bits.

    ``digits`` are the counters' bits, each a word of 64 lanes; ``over`` sticks when a distance
    has passed what they can hold or the radius. Queries whose lanes are all over drop out.
    """
    n_digits = radius.bit_length()
    live = np.arange(len(queries))
    shape = (len(queries), planes.shape[1])
    digits, over = np.zeros((n_digits, *shape), U), np.zeros(shape, U)
    if lanes % 64:
        over[:, -1] = ~((U(1) << U(lanes % 64)) - U(1))
    for b in range(64):
        flip = (U(0) - ((queries[live] >> U(b)) & U(1)))[:, None]
        carry = planes[b][None, :] ^ flip
        for d in range(n_digits):
            digits[d], carry = digits[d] ^ carry, digits[d] & carry
        over |= carry
        if radius + 1 != 1 << n_digits:
            over |= _above(digits, radius)
        if b % 8 == 7:
            open_ = (~over).any(axis=1)
            if not open_.all():
                live, digits, over = live[open_], digits[:, open_], over[open_]
            if not len(live):
                break
    bits = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(len(live), 8 * planes.shape[1]), axis=1, bitorder="little")[:, :lanes]
    q, lane = np.nonzero(bits)
    return live[q], lane


def _above(digits: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is over ``radius``."""
    above, equal = np.zeros_like(digits[0]), np.full_like(digits[0], ~U(0))
    for d in reversed(range(len(digits))):
        if radius >> d & 1:
            equal = equal & digits[d]
        else:
            above, equal = above | (equal & digits[d]), equal & ~digits[d]
    return above


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0 .. n-1 reaches over the edges."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near(fps: np.ndarray, key: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (smaller, larger) within ``radius``, a block at a time; rows are sorted by key.

    Rows of one key are all compared; some of different keys are, too.
    """
    n = len(fps)
    planes = [planes_of(fps[i : i + LANES]) for i in range(0, n, LANES)]
    last = np.searchsorted(key, key, "right") - 1  # of each row, the last row with its key
    for i, block in enumerate(planes):
        lo = i * LANES
        # queries from this block and from those before that share a key with it
        first = int(np.searchsorted(key, key[lo], "left"))
        for q in range(first - first % LANES, lo + 1, LANES):
            own = np.arange(max(q, first), min(q + LANES, n))
            own = own[last[own] >= lo]
            got, lane = within(fps[own], block, min(LANES, n - lo), radius)
            got, lane = own[got], lane + lo
            keep = got < lane
            yield got[keep], lane[keep]


def _linked(fps: np.ndarray, key: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, smaller fp) of rows sorted by key; only rows of one key need be compared."""
    root = np.arange(len(fps))
    for a, b in near(fps, key, radius):
        a, b = root[a], root[b]
        new = a != b
        if new.any():
            a, b = np.unique(np.stack([a[new], b[new]]), axis=1)
            root = forest(len(fps), a, b)[root]
    rows = np.flatnonzero(root != np.arange(len(fps)))
    return fps[rows], fps[root[rows]]


def whole_buckets(batches: Iterator[pa.RecordBatch], keys: int, least: int = 4 * LANES) -> Iterator[pa.Table]:
    """Tables of ``least`` rows or more with whole buckets; rows come sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    size = 0
    for x in batches:
        held.append(x)
        size += x.num_rows
        if size < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(size, bool)
        for c in range(keys):
            column = table.column(c)
            same &= np.array(column.to_pylist(), object) == column[size - 1].as_py() if pa.types.is_binary(column.type) else column.to_numpy() == column[size - 1].as_py()
        cut = int(np.argmax(same))  # the last bucket goes on
        if cut:
            yield table.slice(0, cut)
        held, size = table.slice(cut).to_batches(), size - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _band_bits(free: list[int], bands: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(np.array(free), bands)]


def _deal(rows: DataFrame, radius: int) -> DataFrame:
    """Rows ``fp, free (mask of bits not in the key), key``, once more by each band of the free bits."""
    schema = "fp bigint, free bigint, key binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            fps, free = x.column(0).to_numpy().view(U), x.column(1).to_numpy().view(U)
            keys = x.column(2).to_pylist()
            for mask in np.unique(free):
                at = np.flatnonzero(free == mask)
                bits = [b for b in range(64) if int(mask) >> b & 1]
                for own in _band_bits(bits, radius + 1):
                    band = U(sum(1 << int(b) for b in own))
                    values = (fps[at] & band).tolist()
                    # the key names the bits that it fixes, and their values
                    names = [(keys[i] or b"") + int(band).to_bytes(8, "little") + v.to_bytes(8, "little") for i, v in zip(at, values, strict=True)]
                    rest = np.full(len(at), mask & ~band, U)
                    yield pa.RecordBatch.from_arrays([pa.array(fps[at].view(np.int64)), pa.array(rest.view(np.int64)), pa.array(names, pa.binary())], ["fp", "free", "key"])

    return rows.mapInArrow(run, schema)


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """A forest over the links between distinct fingerprints ``fp``: ``a, b``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in whole_buckets(batches, 1):
            keys = np.array(x.column(0).to_pylist(), object)
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            a, b = _linked(x.column(1).to_numpy().view(U), np.cumsum(new), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    rows = _deal(distinct.select("fp", F.lit(-1).cast("long").alias("free"), F.lit(None).cast("binary").alias("key")), radius)
    todo = []
    for turn in range(DEALS):
        rows = stash(rows, "bands")
        large = stash(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "large")
        if large.isEmpty():
            todo.append(rows.select("key", "fp"))
            break
        todo.append(rows.join(large, "key", "left_anti").select("key", "fp"))
        if turn == DEALS - 1:
            todo.append(_chunked(rows.join(large, "key"), bucket))
        else:
            rows = _deal(rows.join(large, "key", "left_semi").select("fp", "free", "key"), radius)
    found = [part.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(compare, "a bigint, b bigint") for part in todo]
    return stash(reduce(DataFrame.unionByName, found).distinct(), "links")


def _chunked(rows: DataFrame, bucket: int) -> DataFrame:
    """Rows ``fp, key, n`` of large buckets, once for each pair of chunks that theirs is in.

    After so many deals some ten bits are free, so a bucket holds no more distinct fingerprints
    than they can tell apart; its chunks of half a bucket meet each other in tasks of their own.
    """
    n = F.ceil(2 * F.col("n") / bucket).cast("int")
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    pairs = rows.select("fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
    return pairs.select(F.concat("key", F.encode(F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")), "UTF-8")).alias("key"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Near-duplicate components: ``id_col, fingerprint, component_id``, a row for each row.

    Words are the runs without white space, A-Z lower-cased; texts with fewer words than a shingle
    are one shingle, texts without a word and nulls have fingerprint zero and are linked like any
    other. The component id is the smallest id reachable over links, null ids last. Rows that
    repeat an id are nodes of their own. An empty table gives an empty result.
    """
    fps = stash(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("least"))
    distinct = stash(distinct, "distinct")
    tree = components(links(distinct, radius, bucket))
    # the component's smallest id is that of its fingerprints' smallest ids
    rooted = distinct.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return fps.join(named, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
