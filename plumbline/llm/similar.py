"""Near-duplicates by SimHash whose links are held to a Jaccard similarity of word shingles.

Similarity 0.8 of sets of shingles means about 10 different bits of 64, too many for the bands of
``simhash.links``. So texts meet in buckets of another kind: two sets of which one holds ``n``
shingles can be 0.8 similar only if they share at least 0.8 n of them, so under any one order of all
shingles they share one of the first n - ceil(0.8 n) + 1, the prefix. A bucket has the texts with one
shingle in their prefixes, so no similar pair is missed. Shingles that are common in a sample come
last in the order, so that passages which many texts hold bring few of them together; the sample
decides the cost, not the result.

Buckets are compared as in ``simhash``: bit planes of fingerprints, carry-save counters, blocks left
once all are beyond the radius. At the radius of 24 bits about one in a million pairs of exactly
0.8 is missed (64 draws at a chance of 0.15), fewer the more similar the texts are. Pairs within it
go on if two bounds that lose nothing allow: sizes, and the parities of 256 classes of shingles, of
which no more can differ than shingles do. Long texts have more shingles than so few classes tell
apart, and many chance partners within the radius; so what a pair of them has left is held to the
parities of twice as many classes as shingles, which pass next to nothing under a similarity of
three quarters. What is left then is confirmed by counting shingles in full. Parities and shingles
are carried to pairs in slices, whose disk is bounded by the number of texts.

At first each text is held against its closest partner only; what is linked then is one component,
and only buckets with several components go on. If these have many pairs across components, as in a
crowd of near copies, each text is held against its closest partner in another component, in chunks
that are dealt anew (more such rounds linked few on a crowd of thousands); at last every pair across
components is, and is given by one of the buckets that it meets in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .columns import spare
from .meeting import DENOM, NUMER, WIDEST, first_common, padded, parities, plausible, several, sliced
from .simhash import fingerprint_hashes, near, shingle_hashes, whole_buckets
from .store import bound_batches, stash, unstash

U = np.uint64
#: Words of a shingle; different bits that are looked into.
SHINGLE, RADIUS = 5, 24
#: About so many rows say which shingles are common; held by so many of them; at most so many are named.
SAMPLE, COMMON, NAMED = 5000, 3, 200_000
#: Classes whose parities are held, a multiple of 64.
PARITY = 256
PARITIES = [f"p{k}" for k in range(PARITY // 64)]
#: Keys of a set by which pairs tell where they met before.
LOWEST = 16
#: Rows of a bucket that are compared together; rounds of closest partners, while pairs are over so many times the rows.
BUCKET, ROUNDS, MANY = 2048, 2, 8


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without a word has none."""
    out: list[np.ndarray] = [np.zeros(0, U)] * len(column)
    for lo, hi, hashes, bounds in shingle_hashes(column, shingle):
        for i in range(lo, hi):
            own = np.unique(hashes[bounds[i - lo] : bounds[i - lo + 1]])
            out[i] = np.union1d(out[i], own) if len(out[i]) else own
    return out


def in_order(own: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set in the order of ``rank`` (0 for names not in ``common``), then of names."""
    if not len(common) or not len(own):
        return own
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return own[np.argsort(np.where(common[at] == own, rank[at], 0), kind="stable")]


def prefix(own: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set, one of which every similar set has among its own."""
    n = len(own)
    return in_order(own, common, rank)[: n - (NUMER * n + DENOM - 1) // DENOM + 1 if n else 0]


def common_names(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Names that a sample of rows has often, sorted, and their ranks by number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, U), *shingle_sets(x.column(0), shingle)]).view(np.int64))], ["key"])

    rows = docs.sample(min(1.0, SAMPLE / max(docs.count(), 1)), 7).select(text_col).mapInArrow(run, "key bigint")
    found = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).orderBy(F.desc("n"), "key").limit(NAMED).collect()
    names = np.array([r.key for r in found], np.int64).view(U)
    order = np.argsort(names)
    return names[order], (len(names) - np.arange(len(names)))[order]


def classes(n: int) -> int:
    """How many classes of parities a set of ``n`` shingles is held by: twice as many or more."""
    return min(max(1 << max(2 * n - 1, 1).bit_length(), PARITY), WIDEST)


def _facts(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, h, n, node, check, fp``, PARITIES, ``wide`` and ``prefix`` of each row; node and check are the digest of its set, h that of its text."""
    common, rank = common_names(docs, text_col, shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sets = shingle_sets(x.column(2), shingle)
            n = np.array([len(s) for s in sets], np.int64)
            digest = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
            fps = fingerprint_hashes(np.concatenate([np.zeros(0, U), *sets]), np.concatenate([[0], np.cumsum(n)]))
            first = [prefix(s, common, rank).view(np.int64) for s in sets]
            odd = np.zeros((len(sets), PARITY), np.uint8)
            for i, own in enumerate(sets):
                odd[i] = np.bincount((own & U(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
            odd = np.packbits(odd, axis=1).view(np.int64)
            wide = pa.array([parities(own, classes(len(own))) for own in sets], pa.binary())
            arrays = [n, digest[:, 0].copy(), digest[:, 1].copy(), fps.view(np.int64), *(c.copy() for c in odd.T)]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), *map(pa.array, arrays), wide, pa.array(first, pa.list_(pa.int64()))], ["id", "h", "n", "node", "check", "fp", *PARITIES, "wide", "prefix"])

    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    facts = stash(source.mapInArrow(run, f"id {kind}, h bigint, n bigint, node bigint, check bigint, fp bigint, " + "".join(f"{c} bigint, " for c in PARITIES) + "wide binary, prefix array<bigint>"), "facts")
    return told_apart(facts)


def told_apart(facts: DataFrame) -> DataFrame:
    """Facts whose ``node`` stands for one set: sets that share it are named by ``check``, the other half of their digests."""
    twice = stash(facts.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo != hi").select(F.col("node").alias("_clash")), "clashes")
    if twice.isEmpty():  # all but certain: one in 2^64 pairs of sets clashes
        return facts
    named = facts.join(twice.hint("merge"), F.col("node") == F.col("_clash"), "left")
    named = stash(named.withColumn("node", F.when(F.col("_clash").isNull(), F.col("node")).otherwise(F.col("check"))).drop("_clash"), "facts")
    again = named.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo != hi")
    if not again.isEmpty():
        raise ValueError("sets of shingles clash in both halves of their digests")
    return named


def met(rows: DataFrame, all_pairs: bool) -> DataFrame:
    """``a, b``: nodes of rows ``key, chunk, node, root`` and facts, in one chunk of a bucket, of different roots and maybe similar.

    With ``all_pairs`` every such pair, by the first bucket that it is known to meet in, else each node with its
    closest partner by fingerprint, in each bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in whole_buckets(batches, 2):
            key, chunk, node, root, n, fps, *odd = (x.column(i).to_numpy() for i in range(6 + len(PARITIES)))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
            bucket, fps, odd = np.cumsum(new), fps.view(U), np.stack(odd).view(U)
            low = padded(x.column(6 + len(PARITIES)), LOWEST) if all_pairs else None
            closest = np.full(len(key), 65 << 32)
            found = [(np.zeros(0, np.int64),) * 2]
            for a, b in near(fps, bucket, RADIUS):
                keep = (bucket[a] == bucket[b]) & (root[a] != root[b])
                keep &= np.minimum(n[a], n[b]) * DENOM >= np.maximum(n[a], n[b]) * NUMER
                a, b = a[keep], b[keep]
                # of sets that are 0.8 similar at most a ninth of their sizes is in one of them only
                keep = np.bitwise_count(odd[:, a] ^ odd[:, b]).sum(axis=0, dtype=np.int64) * (DENOM + NUMER) <= (n[a] + n[b]) * (DENOM - NUMER)
                a, b = a[keep], b[keep]
                if all_pairs:
                    own = first_common(low, a, b, key)
                    found.append((a[own], b[own]))
                else:
                    far = np.bitwise_count(fps[a] ^ fps[b]).astype(np.int64) << 32
                    np.minimum.at(closest, b, far | a)
                    np.minimum.at(closest, a, far | b)
            own = np.flatnonzero(closest < 65 << 32)
            a, b = (np.concatenate(z) for z in zip(*found, strict=True)) if all_pairs else (own, closest[own] & 0xFFFFFFFF)
            pair = np.unique(np.sort(np.stack([node[a], node[b]]), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    columns = ["key", "chunk", "node", "root", "n", "fp", *PARITIES]
    if all_pairs:
        keys = rows.select("key", "node").distinct().groupBy(F.col("node").alias("_node")).agg(F.slice(F.sort_array(F.collect_list("key")), 1, LOWEST).alias("low"))
        rows = rows.join(keys.hint("merge"), F.col("node") == F.col("_node"))
        columns.append("low")
    sorted_ = rows.select(*columns).repartition("key", "chunk").sortWithinPartitions("key", "chunk", "node")
    return sorted_.mapInArrow(run, "a bigint, b bigint")


def _pairs(rows: DataFrame, wide: DataFrame, all_pairs: bool) -> DataFrame:
    """The pairs that ``met``, each once, as far as the parities ``wide`` of their nodes allow."""
    pairs = stash(met(rows, all_pairs).distinct(), "pairs")
    out = plausible(pairs, wide)
    unstash(pairs)
    return out


def dealt(rows: DataFrame, turn: int, all_pairs: bool) -> DataFrame:
    """Rows with ``c`` in their bucket in chunks of about ``BUCKET``; to compare all, once for each pair of chunks that theirs is in."""
    n = F.ceil(F.col("c") / BUCKET * (2 if all_pairs else 1)).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(turn)), n).cast("int")
    if not all_pairs:
        return rows.withColumn("chunk", own.cast("long"))
    others = F.when(F.col("c") <= BUCKET, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1))
    own = F.when(F.col("c") <= BUCKET, 0).otherwise(own)
    return rows.withColumn("own", own).withColumn("other", F.explode(others)).withColumn("chunk", F.least("own", "other").cast("long") * (1 << 31) + F.greatest("own", "other"))


class Sets:
    """The shingles of nodes, fetched once for each that a pair names."""

    def __init__(self, docs: DataFrame, best: DataFrame, id_col: str, text_col: str, shingle: int):
        self.docs, self.best, self.id_col, self.text_col, self.shingle = docs, best, id_col, text_col, shingle
        self.have: DataFrame | None = None

    def _fetch(self, nodes: DataFrame) -> None:
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                sets = [s.view(np.int64) for s in shingle_sets(x.column(1), shingle)]
                yield pa.RecordBatch.from_arrays([x.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "own"])

        if self.have is not None:
            nodes = nodes.join(self.have.select("node").hint("merge"), "node", "left_anti")
        wanted = nodes.join(self.best.hint("merge"), "node").select("node", "best.*")
        texts = self.docs.select(F.col(self.id_col).alias("_id"), F.xxhash64(self.text_col).alias("_h"), F.col(self.text_col).alias("text"))
        found = texts.join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("id")) & (F.col("_h") == F.col("h")))
        if not self.best.where("best.c > 1").isEmpty():  # rows that repeat id and text
            found = found.dropDuplicates(["node"])
        new = stash(found.select("node", "text").mapInArrow(run, "node bigint, own array<bigint>"), "sets")
        self.have = new if self.have is None else self.have.unionByName(new)

    def similar(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose shingles are 0.8 similar."""
        self._fetch(stash(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "wanted"))
        left, right = self.have.select(F.col("node").alias("a"), F.col("own").alias("x")), self.have.select(F.col("node").alias("b"), F.col("own").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        parts = sliced(pairs, self.have.select("node", (8 * F.size("own")).alias("size")), self.best.count())
        held = (p.join(left.hint("merge"), "a").join(right.hint("merge"), "b") for p in parts)
        return reduce(DataFrame.unionByName, [stash(x.where(both * (DENOM + NUMER) >= (F.size("x") + F.size("y")) * NUMER).select("a", "b"), "similar") for x in held])


def across(buckets: DataFrame, links: list[DataFrame]) -> tuple[DataFrame, bool]:
    """The rows of buckets with several roots, with these and their number ``c``, and whether pairs across roots are many."""
    tree = components(reduce(DataFrame.unionByName, links))
    rooted = buckets.drop("c", "root").join(tree.withColumnRenamed("node", "_node").hint("merge"), F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node")).drop("_node")
    rooted = stash(rooted, "rooted")
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key").agg(F.sum("m").alias("c"), F.sum(F.col("m") * F.col("m")).alias("same"), F.count("*").alias("roots"))
    mixed = stash(sizes.where("roots > 1").select("key", "c", "same"), "mixed-keys")
    pairs, rows = mixed.agg(F.sum((F.col("c") * F.col("c") - F.col("same")) / 2), F.sum("c")).first()
    out = stash(rooted.join(mixed.select("key", "c").hint("merge"), "key"), "mixed")
    unstash(rooted)
    return out, (pairs or 0) > MANY * (rows or 0)


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each component of texts whose shingles are at least 0.8 similar.

    Similarity is that of the sets of ``shingle``-word runs, words being runs without white space
    with A-Z lower-cased, shingles told apart by XXH64. A text with fewer words is one shingle;
    texts without a word, and nulls, are alike. The row with the smallest id stays, null ids last,
    and of rows that repeat this id only one. Columns may have any names. Empty table: no rows.
    """
    bound_batches(docs.sparkSession)
    facts = _facts(docs, id_col, text_col, shingle)
    # of texts with one set, the smallest id; of rows that repeat it, the smallest digest; of equal rows, any
    alike = facts.groupBy("node", "id", "h").agg(F.count("*").alias("c"))
    best = stash(alike.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "c")).alias("best")), "best")
    nodes = stash(facts.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "fp", *PARITIES, "wide", "prefix")]), "nodes")
    unstash(facts)
    wide = stash(nodes.select("node", "n", F.col("wide").alias("odd")), "wide")
    under = nodes.select(F.explode("prefix").alias("key"), "node").repartition("key").sortWithinPartitions("key")
    held = stash(under.mapInArrow(several, "key bigint, node bigint"), "held")
    sizes = held.groupBy("key").agg(F.count("*").alias("c"))
    few = nodes.select(F.col("node").alias("_node"), "n", "fp", *PARITIES)
    buckets = stash(held.join(sizes.hint("merge"), "key").join(few.hint("merge"), F.col("node") == F.col("_node")).drop("_node").withColumn("root", F.col("node")), "buckets")
    unstash(held, nodes)
    sets = Sets(docs, best, id_col, text_col, shingle)
    links = [sets.similar(_pairs(dealt(buckets, 0, False), wide, False))]
    for turn in range(1, ROUNDS + 1):
        mixed, many = across(buckets, links)
        few = not many or turn == ROUNDS
        links.append(sets.similar(_pairs(dealt(mixed, turn, few), wide, few)))
        unstash(mixed)
        if few:
            break
    unstash(buckets, wide)
    tree = components(reduce(DataFrame.unionByName, links))
    rooted = best.join(tree.withColumnRenamed("node", "_node").hint("merge"), F.col("node") == F.col("_node"), "left")
    keep = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    i, h, c = (spare(x, docs.columns) for x in ("_id", "_h", "_c"))
    keep = stash(keep.select(F.col("best.id").alias(i), F.col("best.h").alias(h), F.col("best.c").alias(c)), "keep")
    # by merging at every size: what stays grows with the corpus
    on = F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(h))
    if keep.where(F.col(c) > 1).isEmpty():
        return docs.join(keep.hint("merge"), on, "left_semi")
    kept = docs.join(keep.hint("merge"), on)
    return kept.where(F.col(c) == 1).unionByName(kept.where(F.col(c) > 1).dropDuplicates([i, h])).select(*docs.columns)
