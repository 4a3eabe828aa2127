"""Hard negatives by dual-tree search: exact neighbours by inner product, pruned a pair of nodes at a time.

Every row becomes integers floor(256 x) and a place: its path in a tree of hyperplanes, fitted on a
bounded sample, then its projection there, then its id. Blocks of ``LEAF`` consecutive rows are the
leaves of the candidates' tree, groups of ``GROUP`` consecutive anchors those of the anchors', and
``FAN`` neighbours make a node of the next level. So leaves have one size however rows are
spread, also where many vectors are equal, and the sample decides the cost only.

A node is a ball: centre and radius. The inner products of two balls lie in an interval around that
of their centres. An anchor wants the first ``k`` rows in each of some windows of scores; the
leaves near its own place are scored first and tell what is too low. From the roots downwards, pairs
of nodes whose interval meets no window of any anchor below go, a level at a time, as a join
of the pairs left with their children; pairs of leaves are scored exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import with_ordinal
from .store import bound_batches, stash

#: Rows that the hyperplanes are fitted on, about; their depth, and the rows of the sample that a cell keeps at least.
SAMPLE, DEPTH, CELL = 8192, 10, 16
#: Candidates of a leaf, anchors of a leaf, children of a node.
LEAF, GROUP, FAN = 1024, 128, 64
#: Blocks after the first near one that are scored before the trees are searched.
NEAR = 8
SCALE, POSITIVES, NEGATIVES = 256, 5, 3
BIG = (1 << 62) - 1
HITS = "aord bigint, win int, score bigint, id bigint, cord bigint"


def _planes(x: np.ndarray) -> list[tuple[np.ndarray, float] | None]:
    """Hyperplanes of a binary tree in breadth-first order, each between the means of two halves that began at far rows."""
    out: list[tuple[np.ndarray, float] | None] = [None] * ((1 << (DEPTH + 1)) - 1)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, own = todo.pop()
        if len(own) < 2:
            continue
        rows = x[own]
        a = rows[np.argmax(((rows - rows.mean(axis=0)) ** 2).sum(axis=1))]
        b = rows[np.argmax(((rows - a) ** 2).sum(axis=1))]
        for _ in range(4):
            along, cut = rows @ (b - a), float((a + b) @ (b - a)) / 2
            left = along < cut
            if left.all() or not left.any():
                break
            a, b = rows[left].mean(axis=0), rows[~left].mean(axis=0)
        if (a == b).all():
            continue
        out[node] = (b - a, float((a + b) @ (b - a)) / 2)
        left = rows @ (b - a) < out[node][1]
        if 2 * node + 2 < len(out) and len(own) >= 2 * CELL and 0 < left.sum() < len(own):
            todo += [(2 * node + 1, own[left]), (2 * node + 2, own[~left])]
    return out


def _place(x: np.ndarray, planes: list[tuple[np.ndarray, float] | None]) -> tuple[np.ndarray, np.ndarray]:
    """The path of each row, filled up with zero bits, and its projection on the direction of the last node on it."""
    path, along = np.zeros(len(x), np.int64), np.zeros(len(x))
    todo = [(0, 0, 0, np.arange(len(x)))]
    while todo:
        node, depth, bits, own = todo.pop()
        path[own] = bits << (DEPTH - depth)
        if planes[node] is None or not len(own):
            continue
        direction, cut = planes[node]
        along[own] = x[own] @ direction
        if depth < DEPTH:
            left = along[own] < cut
            todo += [(2 * node + 1, depth + 1, 2 * bits, own[left]), (2 * node + 2, depth + 1, 2 * bits + 1, own[~left])]
    return path, along


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a binary column as integers (rows, dim)."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


class _Dots:
    """Exact inner products of integer rows: in doubles while 2^53 holds every sum, else in 64-bit integers."""

    def __init__(self, dim: int, largest: float):
        self.dim, self.exact = dim, dim * largest * largest < 2**53

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.exact:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
        return a @ b.T


def _ball(centres: np.ndarray, radii: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """A ball around balls; radii are rounded up."""
    if (centres == centres[0]).all():
        return centres[0], float(radii.max())
    centre = weights @ centres / weights.sum()
    return centre, float((np.sqrt(((centres - centre) ** 2).sum(axis=1)) + radii).max() * (1 + 1e-9))


def _interval(a: np.ndarray, ra: np.ndarray, c: np.ndarray, rc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest integer inner product of balls (a, ra) with balls (c, rc), each with each."""
    na, nc = np.sqrt((a**2).sum(axis=1)), np.sqrt((c**2).sum(axis=1))
    middle, spread = a @ c.T, np.outer(ra, nc) + np.outer(na, rc) + np.outer(ra, rc)
    # what rounding may add is far below this
    spread = spread + 1e-9 * (np.outer(na, nc) + spread) + 1e-6
    return np.ceil(middle - spread), np.floor(middle + spread)


def _leaf(dim: int, key: str) -> Callable[[pa.Table], pa.Table]:
    """A leaf as one row: its rows, sorted by id, as packed columns, and its ball."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("vec_id", "ascending"), ("ord", "ascending")])
        q = _matrix(rows.column("q"), dim)
        centre, radius = _ball(q.astype(np.float64), np.zeros(len(q)), np.ones(len(q)))
        packed = {k: rows.column(k).to_numpy().astype("<i8").tobytes() for k in ("vec_id", "label", "ord")}
        out = {key: rows.column(key)[0].as_py(), "n": len(q), "q": q.tobytes(), **packed, "centre": centre.tobytes(), "radius": radius, "least": rows.column("vec_id")[0].as_py()}
        if key == "grp":
            wins = [[i, w["win"], w["lo"], w["hi"], w["tie"]] for i, x in enumerate(rows.column("wins").to_pylist()) for w in x]
            wins = np.array(wins, "<i8")
            lo = int(wins[:, 2].min())
            out |= {"wins": wins.tobytes(), "lo": lo, "hi": int(wins[:, 3].max()), "tie": int(wins[wins[:, 2] == lo, 4].max())}
        return pa.table({k: [v] for k, v in out.items()}, schema=_arrow(_LEAF[key]))

    return run


_NODE = "centre binary, radius double, least bigint, n bigint"
_LEAF = {"blk": "blk bigint, n bigint, q binary, vec_id binary, label binary, ord binary, centre binary, radius double, least bigint"}
_LEAF["grp"] = _LEAF["blk"].replace("blk", "grp") + ", wins binary, lo bigint, hi bigint, tie bigint"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "int": pa.int32()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])


def _packs(nodes: DataFrame, dim: int, wanted: bool) -> DataFrame:
    """Nodes of the next level ``node`` with their children ``under`` in packed columns and their own ball."""
    extra = ["lo", "hi", "tie"] if wanted else []
    schema = f"node bigint, under binary, centres binary, radii binary, leasts binary, {_NODE}" + "".join(f", {k}s binary, {k} bigint" for k in extra)

    def run(rows: pa.Table) -> pa.Table:
        centres = np.frombuffer(b"".join(rows.column("centre").to_pylist())).reshape(-1, dim)
        radii, n, leasts = (rows.column(c).to_numpy() for c in ("radius", "n", "least"))
        centre, radius = _ball(centres, radii, n.astype(np.float64))
        out = {"node": rows.column("up")[0].as_py(), "under": rows.column("node").to_numpy().astype("<i8").tobytes(), "centres": centres.tobytes(), "radii": radii.astype("<f8").tobytes(), "leasts": leasts.astype("<i8").tobytes()}
        out |= {"centre": centre.tobytes(), "radius": radius, "least": int(leasts.min()), "n": int(n.sum())}
        if wanted:
            lo, hi, tie = (rows.column(k).to_numpy() for k in extra)
            out |= {f"{k}s": v.astype("<i8").tobytes() for k, v in (("lo", lo), ("hi", hi), ("tie", tie))}
            out |= {"lo": int(lo.min()), "hi": int(hi.max()), "tie": int(tie[lo == lo.min()].max())}
        return pa.table({k: [v] for k, v in out.items()}, schema=_arrow(schema))

    return nodes.withColumn("up", F.floor(F.col("node") / FAN)).groupBy("up").applyInArrow(run, schema)


def _descend(pairs: DataFrame, anchors: DataFrame, candidates: DataFrame, dim: int) -> DataFrame:
    """The children of pairs ``a, c`` whose interval meets a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for row in x.to_pylist():
                under, los, his, ties, to, leasts = (np.frombuffer(row[k], "<i8") for k in ("under", "los", "his", "ties", "to", "leasts"))
                a, ra, c, rc = (np.frombuffer(row[k]) for k in ("centres", "radii", "c_centres", "c_radii"))
                lo, hi = _interval(a.reshape(-1, dim), ra, c.reshape(-1, dim), rc)
                low = los[:, None]
                i, j = np.nonzero((lo <= his[:, None]) & ((hi > low) | (hi == low) & (leasts <= ties[:, None])))
                yield pa.RecordBatch.from_arrays([pa.array(under[i]), pa.array(to[j])], ["a", "c"])

    left = anchors.select(F.col("node").alias("a"), "under", "centres", "radii", "los", "his", "ties")
    right = candidates.select(F.col("node").alias("c"), F.col("under").alias("to"), F.col("centres").alias("c_centres"), F.col("radii").alias("c_radii"), "leasts")
    return stash(pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "c").mapInArrow(run, "a bigint, c bigint"), "node-pairs")


def _top(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest entries above -BIG of each row; of equal ones those further left."""
    rows, cols, live = [], [], np.arange(len(score))
    for _ in range(k):
        at = np.argmax(score[live], axis=1)
        some = score[live, at] > -BIG
        live, at = live[some], at[some]
        if not len(live):
            break
        rows.append(live)
        cols.append(at)
        score[live, at] = -BIG
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, np.int64),) * 2


def _scored(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, dots: _Dots, same: bool, k: int) -> DataFrame:
    """``HITS``: the first ``k`` rows of each block in each window of each anchor of a group, for pairs ``a, c``."""
    dim = dots.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for row in x.to_pylist():
                aq, c, a_label, label, a_ord, at_ord, ids, wins = (np.frombuffer(row[k], "<i8") for k in ("aq", "q", "a_label", "label", "a_ord", "ord", "vec_id", "wins"))
                aq, c, wins = aq.reshape(-1, dim), c.reshape(-1, dim), wins.reshape(-1, 5)
                lo, hi = _interval(aq.astype(np.float64), np.zeros(len(aq)), np.frombuffer(row["centre"])[None, :], np.array([row["radius"]]))
                wins = wins[(lo[wins[:, 0], 0] <= wins[:, 3]) & (hi[wins[:, 0], 0] >= wins[:, 2])]
                if not len(wins):
                    continue
                own, at = np.unique(wins[:, 0], return_inverse=True)
                match = ((a_label[own][:, None] == label) == same) & (a_ord[own][:, None] != at_ord)
                score, match = dots(aq[own], c)[at], match[at]
                low, high, tie = (wins[:, j][:, None] for j in (2, 3, 4))
                match &= (score <= high) & ((score > low) | (score == low) & (ids <= tie))
                w, j = _top(np.where(match, score, -BIG), k)
                yield pa.RecordBatch.from_arrays([pa.array(a_ord[wins[w, 0]]), pa.array(wins[w, 1].astype(np.int32)), pa.array(score[w, j]), pa.array(ids[j]), pa.array(at_ord[j])], ["aord", "win", "score", "id", "cord"])

    left = groups.select(F.col("grp").alias("a"), F.col("q").alias("aq"), F.col("label").alias("a_label"), F.col("ord").alias("a_ord"), "wins")
    right = blocks.select(F.col("blk").alias("c"), "q", "vec_id", "label", "ord", "centre", "radius")
    return stash(pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "c").mapInArrow(run, HITS), "hits")


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` hits of each window with their ``rank``."""
    order = Window.partitionBy("aord", "win").orderBy(F.desc("score"), "id", "cord")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _raised(wins: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Windows whose lower end is the ``k``-th hit so far, where there are so many."""
    worst = _first(hits, k).where(F.col("rank") == k).select("aord", "win", F.col("score").alias("_s"), F.col("id").alias("_i"))
    return wins.join(worst.hint("merge"), ["aord", "win"], "left").select("aord", "win", F.coalesce("_s", "lo").alias("lo"), "hi", F.coalesce("_i", "tie").alias("tie"))


class _Search:
    """Both trees: of rows ``ord, vec_id, label, q``, and of the anchors among them, which have ``grp``."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, dots: _Dots):
        self.dots, self.anchors = dots, anchors
        of = rows.withColumn("blk", F.floor(F.col("ord") / LEAF))
        self.blocks = stash(of.groupBy("blk").applyInArrow(_leaf(dots.dim, "blk"), _LEAF["blk"]), "blocks")
        last = self.blocks.agg(F.max("blk")).first()[0]
        most = max(last, anchors.agg(F.max("grp")).first()[0] or 0)
        self.depth = 1
        while most // FAN**self.depth:
            self.depth += 1
        self.nodes = self._tree(self.blocks.select(F.col("blk").alias("node"), "centre", "radius", "least", "n"), False)
        # anchors stand in the candidates' order, so the blocks near a group are neighbours
        own = anchors.groupBy("grp").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))
        first = F.greatest(F.floor(F.col("lo") / LEAF) - 1, F.lit(0))
        end = F.least(F.floor(F.col("hi") / LEAF) + 1, F.lit(last), first + NEAR)
        self.near = stash(own.select(F.col("grp").alias("a"), F.explode(F.sequence(first, end)).alias("c")), "near")

    def _tree(self, nodes: DataFrame, wanted: bool) -> list[DataFrame]:
        """The levels above the leaves ``nodes``, the root last."""
        levels = []
        for _ in range(self.depth):
            nodes = stash(_packs(nodes, self.dots.dim, wanted), "nodes")
            levels.append(nodes)
        return levels

    def _groups(self, wins: DataFrame) -> DataFrame:
        of = wins.groupBy("aord").agg(F.collect_list(F.struct("win", "lo", "hi", "tie")).alias("wins"))
        rows = self.anchors.join(of.hint("merge"), F.col("ord") == F.col("aord"))
        return stash(rows.select("grp", "ord", "vec_id", "label", "q", "wins").groupBy("grp").applyInArrow(_leaf(self.dots.dim, "grp"), _LEAF["grp"]), "groups")

    def __call__(self, wins: DataFrame, same: bool, k: int) -> DataFrame:
        """The first ``k`` rows with the anchor's label, or with another, in each window ``aord, win, lo, hi, tie``.

        Of rows that score ``lo`` only ids up to ``tie`` are wanted.
        """
        found = _scored(self.near, self._groups(wins), self.blocks, self.dots, same, k)
        groups = self._groups(_raised(wins, found, k))
        tree = self._tree(groups.select(F.col("grp").alias("node"), "centre", "radius", "least", "n", "lo", "hi", "tie"), True)
        pairs = tree[-1].select(F.col("node").alias("a"), F.col("node").alias("c"))  # both roots are node 0
        for a, c in zip(reversed(tree), reversed(self.nodes), strict=True):
            pairs = _descend(pairs, a, c, self.dots.dim)
        rest = pairs.join(self.near.hint("merge"), ["a", "c"], "left_anti")
        return stash(_first(found.unionByName(_scored(rest, groups, self.blocks, self.dots, same, k)), k), "first")


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 50, high: int = 95,
) -> DataFrame:
    """Hard negatives of the rows that ``anchor`` marks: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of vectors whose components x are floor(256 x). An anchor's positives
    are its first ``positives`` other rows of its label by score, ties by id; for each, the negatives are
    the first rows of another label that score from ``low`` to ``high`` percent of it. Labels are integers.
    Rows without an id, label or vector, or with a component that is null or not finite, take no part;
    a shorter vector counts as filled up with zeros. Rows that repeat an id are rows of their own. An empty
    table, or one without anchors, gives no rows; components whose scores pass 56 bits are an error.
    """
    spark = vectors.sparkSession
    bound_batches(spark, 64)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(F.exists("x", bad), F.lit(False)))
    n, dim, largest, some = rows.agg(F.count("*"), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs))), F.max("anchor")).first()
    if not n or not some:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    dim, largest = max(dim, 1), (largest or 0.0) * SCALE + 1
    if dim * largest * largest >= 2**56:
        raise ValueError(f"components up to {largest / SCALE:.3g} give scores beyond 56 bits")
    dots = _Dots(dim, largest)
    drawn = rows.sample(min(1.0, SAMPLE / n), 7).select("x").limit(2 * SAMPLE).toArrow().column(0).combine_chunks()
    planes = _planes(_integers(drawn, dim).astype(np.float64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            q = _integers(x.column(2), dim)
            path, along = _place(q.astype(np.float64), planes)
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), x.column(3), pa.array([v.tobytes() for v in q], pa.binary()), pa.array(path), pa.array(along)], ["vec_id", "label", "anchor", "q", "path", "along"])

    placed = rows.mapInArrow(place, "vec_id bigint, label bigint, anchor boolean, q binary, path bigint, along double")
    ordered = stash(with_ordinal(placed, ["path", "along", "vec_id"], "ord"), "placed")
    own = with_ordinal(ordered.where("anchor").select("ord", "vec_id", "label", "q"), ["ord"], "at")
    anchors = stash(own.withColumn("grp", F.floor(F.col("at") / GROUP)), "anchors")
    search = _Search(ordered, anchors, dots)
    wide = anchors.select(F.col("ord").alias("aord"), F.lit(0).alias("win"), F.lit(-BIG).alias("lo"), F.lit(BIG).alias("hi"), F.lit(BIG).alias("tie"))
    best = search(wide, True, positives).select("aord", F.col("rank").alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ends = best.where("positive_score >= 0").selectExpr("aord", "win", f"({low} * positive_score + 99) div 100 AS lo", f"{high} * positive_score div 100 AS hi", f"{BIG}L AS tie")
    worst = search(ends.where("lo <= hi"), False, negatives).select("aord", "win", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("ord").alias("aord"), F.col("vec_id").alias("anchor_id"))
    out = worst.join(best.hint("merge"), ["aord", "win"]).join(named.hint("merge"), "aord")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(256 x) of a list column (rows, dim); shorter rows end in zeros."""
    size = column.value_lengths().to_numpy()
    values = np.floor(SCALE * column.flatten().to_numpy()).astype("<i8")
    if (size == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(size), dim), "<i8")
    out[np.arange(dim) < size[:, None]] = values
    return out
