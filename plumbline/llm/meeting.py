"""What rows that meet under a key are held against before their shingles are counted; none of it loses a pair."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stash

U = np.uint64
#: Sets are similar from 4 of 5 shingles of their union.
NUMER, DENOM = 4, 5
#: Classes whose parities are held, at most so many.
PARITY, WIDEST = 1024, 1 << 17
#: Keys of a set by which pairs tell where they met before; larger than any.
LOW, NONE = 32, (1 << 63) - 1
#: Bytes that pairs carry through a shuffle at once: so many for each text, or so many in all if that is more.
CARRIED, LEAST = 128, 64 << 20


def parities(own: np.ndarray, classes: int = PARITY) -> bytes:
    """A bit for each class: whether the set holds an odd number of it. Classes are the last bits of names."""
    return np.packbits(np.bincount((own & U(classes - 1)).astype(np.int64), minlength=classes) & 1).tobytes()


def wide_parities(own: np.ndarray) -> bytes | None:
    """Parities of twice as many classes as the set has shingles, or more; None where ``PARITY`` are enough."""
    classes = min(1 << max(2 * len(own) - 1, 1).bit_length(), WIDEST)
    return parities(own, classes) if classes > PARITY else None


def differing(a: bytes, b: bytes) -> int:
    """Classes whose parities differ, in the coarser of two divisions: half as many classes are the xor of both halves."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows ``key, node`` whose key a neighbour has, too; keys come sorted."""
    key, node, same = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for x in batches:
        key, node = np.append(key, x.column(0).to_numpy()), np.append(node, x.column(1).to_numpy())
        equal = key[1:] == key[:-1]
        keep = np.append(same, equal)[: len(equal)] | equal  # the last row waits for the next
        yield pa.RecordBatch.from_arrays([pa.array(key[:-1][keep]), pa.array(node[:-1][keep])], ["key", "node"])
        same = bool(equal[-1]) if len(equal) else same
        key, node = key[-1:], node[-1:]
    if same:
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node)], ["key", "node"])


def padded(lists: pa.ChunkedArray, low: int = LOW) -> np.ndarray:
    """Lists of ``low`` numbers at most (rows, low), filled up with the largest number."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size, out = lists.value_lengths().to_numpy(), np.full((len(lists), low), NONE)
    out[np.arange(low) < size[:, None]] = lists.flatten().to_numpy()
    return out


def first_common(low: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of pairs that meet under ``key[a]``, those that don't meet under a smaller key that is among the lowest of both."""
    out = [np.zeros(0, np.int64)]
    for lo in range(0, len(a), 4096):
        x, y = low[a[lo : lo + 4096]], low[b[lo : lo + 4096]]
        least = np.where((x[:, :, None] == y[:, None, :]).any(axis=2), x, NONE).min(axis=1)
        out.append(np.flatnonzero((least == NONE) | (least == key[a[lo : lo + 4096]])) + lo)
    return np.concatenate(out)


def sliced(pairs: DataFrame, sizes: DataFrame, texts: int) -> list[DataFrame]:
    """``pairs`` in parts, each with about as many bytes of its nodes ``a``, by ``node, size``, as may be carried at once.

    Pairs grow faster than texts where many meet by chance, or almost alike in a crowd. What a part
    carries is gone before the next one starts, so that its disk grows with the texts alone.
    """
    carried = pairs.join(sizes.select(F.col("node").alias("a"), "size").hint("merge"), "a").agg(F.sum("size").alias("size"))
    n = max(1, math.ceil((stash(carried, "carried").first().size or 0) / max(CARRIED * texts, LEAST)))
    return [pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(n)) == k) for k in range(n)] if n > 1 else [pairs]


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that the parities ``odd`` of ``node, n, odd`` allow, too; sets of many shingles need many classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = zip(*(x.column(i).to_pylist() for i in range(2, 6)), strict=True)
            keep = [differing(p, q) * (DENOM + NUMER) <= (m + n) * (DENOM - NUMER) for m, n, p, q in rows]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in x.columns[:2]], ["a", "b"])

    of = lambda to, n, odd: nodes.select(F.col("node").alias(to), F.col("n").alias(n), F.col("odd").alias(odd)).hint("merge")
    parts = sliced(pairs, nodes.select("node", F.length("odd").alias("size")), nodes.count())
    held = (x.join(of("a", "m", "p"), "a").join(of("b", "n", "q"), "b").select("a", "b", "m", "n", "p", "q") for x in parts)
    return reduce(DataFrame.unionByName, [stash(x.mapInArrow(run, "a bigint, b bigint"), "plausible") for x in held])
