"""Documents linked by the Jaccard similarity of their shingles: a size-aware heavy-light join.

Under one order of all shingles, rare ones first, two sets with at least 4/5 of their union in common share
``k`` of the first n - ceil(4 n / 5) + k shingles of either. Small sets therefore meet by every subset of two
from that prefix, large ones by the inverted list of every shingle in the prefix for one; sets so
close under the boundary that a large one may be similar stand in the lists too. Subsets are more rows
and fewer chance meetings. The boundary is the size at which rows and meetings cost least together; both
are counted, either way and by size class, on one key in so many. It decides the cost only, as
does the order, which comes from a sample.

Sets that meet are compared a bucket at a time by what loses nothing: their sizes, and the parities of
1024 classes of shingles, of which no more can differ than shingles do; then once more by as many
classes as long sets need. Pairs that pass are counted in full. First a bucket gives a forest of its closest pairs, as if they were links; what is linked in truth is
one component then, and only buckets with several components go on, at last with all their pairs
across components. Equal sets take part as one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import words as wt
from .meeting import DENOM, LOW, NONE, NUMER, PARITY, differing, first_common, padded, parities, plausible, several, wide_parities  # noqa: F401
from .similar import ROUNDS, SHINGLE, Sets, across, common_names, dealt, in_order, shingle_sets, told_apart
from .simhash import forest, whole_buckets
from .store import bound_batches, stash, unstash

U = np.uint64
#: Shingles that a subset has.
SUBSET = 2
#: Lists counted for the cost: one in so many; the cost of a pair that meets, in rows; sizes of a class differ by this factor.
LISTS, MEETING, CLASS = 64, 0.1, 1.25
#: Shingles of a set that may go by its subsets: with more, these are over thirty times its lists.
LARGEST = 300
#: Pairs that are compared at once.
PAIRS = 1 << 16
#: Farther than any pair.
FAR = (PARITY + 1) << 32


def prefix_size(n: int, k: int = 1) -> int:
    """How many first shingles of a set of ``n`` hold ``k`` that any similar set has in its own."""
    return min(n, n - -(-NUMER * n // DENOM) + k)


def _facts(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, h, n, node, check, odd, wide, first`` of each row; node and check are the digest of its set, h that of its text."""
    common, rank = common_names(docs, text_col, shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sets = shingle_sets(x.column(2), shingle)
            digest = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
            first = [in_order(s, common, rank)[: prefix_size(len(s), SUBSET)].view(np.int64) for s in sets]
            arrays = [pa.array(np.array([len(s) for s in sets], np.int64)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.array([parities(s) for s in sets], pa.binary()), pa.array([wide_parities(s) for s in sets], pa.binary()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), *arrays], ["id", "h", "n", "node", "check", "odd", "wide", "first"])

    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return told_apart(stash(source.mapInArrow(run, f"id {kind}, h bigint, n bigint, node bigint, check bigint, odd binary, wide binary, first array<bigint>"), "facts"))


def size_class(n: int) -> int:
    return math.floor(math.log(n) / math.log(CLASS) + 1e-9)


def largest(size_class_: int) -> int:
    """The largest size of a class."""
    return math.ceil(CLASS ** (size_class_ + 1) - 1e-9) - 1


def cheapest(subsets: dict[int, float], lists: dict[int, float]) -> int:
    """The largest size that goes by subsets, from the costs of each size class either way; 1 where none should."""

    def cost(boundary: int) -> float:  # classes that reach up to 4/5 of it are in the lists, too
        return sum(v for c, v in subsets.items() if largest(c) <= boundary) + sum(v for c, v in lists.items() if DENOM * largest(c) >= NUMER * (boundary + 1))

    return min([1, *(largest(c) for c in subsets)], key=lambda x: (cost(x), -x))


def _boundary(nodes: DataFrame) -> int:
    """The boundary between small and large sets that costs least: rows and meetings, counted on one key in ``LISTS``."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            first, bounds = x.column(1).flatten().to_numpy().view(U), np.concatenate([[0], np.cumsum(x.column(1).value_lengths().to_numpy())])
            out: list[tuple[np.ndarray, bool, int]] = []
            for a, b, n in zip(bounds[:-1].tolist(), bounds[1:].tolist(), x.column(0).to_pylist(), strict=True):
                for small in (True, False) if n <= LARGEST else (False,):
                    keys = subset_keys(first[a:b]) if small else first[a : a + prefix_size(n)]
                    out.append((keys[keys % U(LISTS) == 0], small, size_class(n)))
            size = [len(k) for k, *_ in out]
            columns = [np.concatenate([np.zeros(0, U), *(k for k, *_ in out)]).view(np.int64), np.repeat(np.array([s for _, s, _ in out], bool), size), np.repeat(np.array([c for *_, c in out], np.int32), size)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "small", "cls"])

    keys = nodes.where("n > 1").select("n", "first").mapInArrow(sampled, "key bigint, small boolean, cls int")
    held = keys.groupBy("small", "key", "cls").agg(F.count("*").alias("m")).groupBy("small", "key").agg(F.sum("m").alias("c"), F.collect_list(F.struct("cls", "m")).alias("own"))
    met = held.select("small", "c", F.explode("own").alias("o")).groupBy("small", "o.cls").agg(F.sum("o.m").alias("rows"), F.sum(F.col("o.m") * (F.col("c") - 1)).alias("pairs")).collect()
    cost = {small: {r.cls: LISTS * (r.rows + MEETING * r.pairs) for r in met if r.small == small} for small in (True, False)}
    return cheapest(cost[True], cost[False])


def subset_keys(first: np.ndarray) -> np.ndarray:
    """Names of the subsets of two, of shingles in their order."""
    i, j = np.triu_indices(len(first), 1)
    return wt.mix64(first[i] * U(wt.BASE) + first[j]) ^ U(1)


def bucket_keys(first: np.ndarray, n: int, boundary: int) -> np.ndarray:
    """Keys of the subsets of a small set, and of the lists that it stands in if large or nearly so."""
    keys = [np.zeros(0, U)]
    if SUBSET <= n <= boundary:
        keys.append(subset_keys(first))
    if n > 1 and DENOM * n >= NUMER * (boundary + 1):
        keys.append(first[: prefix_size(n)])
    return np.concatenate(keys)


def _buckets(nodes: DataFrame, boundary: int) -> DataFrame:
    """Rows ``key, node, c, root`` of the buckets with several sets, ``c`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            first, bounds = x.column(2).flatten().to_numpy().view(U), np.concatenate([[0], np.cumsum(x.column(2).value_lengths().to_numpy())])
            keys = [bucket_keys(first[a:b], n, boundary) for a, b, n in zip(bounds[:-1].tolist(), bounds[1:].tolist(), x.column(1).to_pylist(), strict=True)]
            node = np.repeat(x.column(0).to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, U), *keys]).view(np.int64)), pa.array(node)], ["key", "node"])

    schema = "key bigint, node bigint"
    under = nodes.select("node", "n", "first").mapInArrow(run, schema).repartition("key").sortWithinPartitions("key")
    held = stash(under.mapInArrow(several, schema), "held")
    sizes = held.groupBy("key").agg(F.count("*").alias("c"))
    out = stash(held.join(sizes.hint("merge"), "key").withColumn("root", F.col("node")), "buckets")
    unstash(held)
    return out


def meetings(end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j < end[i], some at a time."""
    count = np.maximum(end - np.arange(len(end)) - 1, 0)
    total = np.concatenate([[0], np.cumsum(count)])
    lo = 0
    while lo < len(end):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(lo, hi), count[lo:hi])
        if len(i):
            yield i, i + 1 + np.arange(len(i)) - (total[i] - total[lo])
        lo = hi


def _pairs(rows: DataFrame, nodes: DataFrame, all_pairs: bool) -> DataFrame:
    """``a, b``: nodes of rows ``key, chunk, node, root``, in one chunk of a bucket, of different roots and maybe similar.

    With ``all_pairs`` every such pair, else a forest: each component's closest pair, again and again, as if
    all pairs that pass were links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in whole_buckets(batches, 2):
            key, chunk, node, root, n = (x.column(i).to_numpy() for i in range(5))
            low = padded(x.column(6)) if all_pairs else None
            odd = np.frombuffer(b"".join(x.column(5).to_pylist()), U).reshape(-1, PARITY // 64)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
            starts = np.flatnonzero(new)
            end = np.append(starts[1:], len(key))[np.cumsum(new) - 1]
            found, label = [np.zeros((2, 0), np.int64)], np.unique(root, return_inverse=True)[1]
            for a, b in meetings(end):
                keep = (label[a] != label[b]) & (np.minimum(n[a], n[b]) * DENOM >= np.maximum(n[a], n[b]) * NUMER)
                a, b = a[keep], b[keep]
                # of similar sets at most a ninth of their sizes is in one of them only
                far = np.bitwise_count(odd[a] ^ odd[b]).sum(axis=1, dtype=np.int64)
                keep = far * (DENOM + NUMER) <= (n[a] + n[b]) * (DENOM - NUMER)
                a, b, far = a[keep], b[keep], far[keep]
                if all_pairs:
                    own = first_common(low, a, b, key)
                    found.append(np.stack([node[a[own]], node[b[own]]]))
                    continue
                while len(a):
                    best, order = np.full(len(key), FAR), far << 32 | np.arange(len(a))
                    np.minimum.at(best, label[a], order)
                    np.minimum.at(best, label[b], order)
                    own = np.unique(best[best < FAR]) & 0xFFFFFFFF
                    found.append(np.stack([node[a[own]], node[b[own]]]))
                    label = forest(len(key), label[a[own]], label[b[own]])[label]
                    live = label[a] != label[b]
                    a, b, far = a[live], b[live], far[live]
            pair = np.concatenate(found, axis=1)
            pair = np.unique(np.sort(pair, axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    facts, columns = nodes.select(F.col("node").alias("_node"), "n", "odd").hint("merge"), ["key", "chunk", "node", "root", "n", "odd"]
    whole = rows.select("key", "chunk", "node", "root").join(facts, F.col("node") == F.col("_node")).select(*columns)
    if all_pairs:  # a pair that meets in many buckets is given by one
        keys = rows.select("key", "node").distinct().groupBy(F.col("node").alias("_node")).agg(F.slice(F.sort_array(F.collect_list("key")), 1, LOW).alias("low"))
        whole = whole.join(keys.hint("merge"), F.col("node") == F.col("_node")).select(*columns, "low")
    sorted_ = whole.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "node")
    return plausible(stash(sorted_.mapInArrow(run, "a bigint, b bigint").distinct(), "pairs"), nodes.select("node", "n", F.coalesce("wide", "odd").alias("odd")))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, n_shingles, component_id`` of each row: components of texts whose shingle sets are 0.8 similar.

    Words are runs without white space, A-Z lower-cased; a set has the distinct runs of ``shingle`` words,
    told apart by XXH64. A text with fewer words is one shingle; texts without a word, and nulls, have none
    and are linked with nothing. The component id is the smallest id that links reach, the row's own
    included; null ids come last. Rows that repeat an id are nodes of their own. Columns may have any
    names. Empty table: no rows.
    """
    bound_batches(docs.sparkSession)
    facts = _facts(docs, id_col, text_col, shingle)
    big, facts = facts, stash(facts.select("id", "h", "n", "node"), "slim")
    nodes = stash(big.where("n > 0").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "odd", "wide", "first")]), "nodes")
    unstash(big)
    some = facts.where("n > 0")
    alike = some.groupBy("node", "id", "h").agg(F.count("*").alias("c"))
    best = stash(alike.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "c")).alias("best")), "best")
    buckets = _buckets(nodes, _boundary(nodes))
    sets = Sets(docs, best, id_col, text_col, shingle)
    links = [sets.similar(_pairs(dealt(buckets, 0, False), nodes, False))]
    for turn in range(1, ROUNDS + 1):
        mixed, many = across(buckets, links)
        few = not many or turn == ROUNDS
        links.append(sets.similar(_pairs(dealt(mixed, turn, few), nodes, few)))
        unstash(mixed)
        if few:
            break
    tree = components(reduce(DataFrame.unionByName, links))
    rooted = stash(best.join(tree.withColumnRenamed("node", "_node").hint("merge"), F.col("node") == F.col("_node"), "left").select("node", "best", F.coalesce("root", "node").alias("root")), "roots")
    least = rooted.groupBy("root").agg(F.min("best").alias("least"))
    named = rooted.join(least.hint("merge"), "root").select(F.col("node").alias("_node"), F.col("least.id").alias("component_id"))
    linked = some.join(named.hint("merge"), F.col("node") == F.col("_node"))
    alone = facts.where("n = 0").withColumn("component_id", F.col("id"))
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))
