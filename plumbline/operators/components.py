"""Connected components over rows and the identity keys that they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import stash
from .chained import chained_sha256

#: Distinct keys of a component that may come together in one row, at some hundred bytes each; the digest of more goes from range to range.
MOST_KEYS = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of edges ``a, b``: the smallest node of each one's component, for nodes with an edge.

    Nodes take the least label of their neighbours, roots the least that any of their nodes saw, and
    labels jump to their labels; rounds follow the logarithm of paths. All groupings combine
    before their shuffle, and each round is cut off in a table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stash(both.where("a != b").distinct(), "edges")
    label = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("near"))
        hooked = label.join(near, F.col("node") == F.col("n")).select("node", "root", F.least("root", "near").alias("low"))
        pulled = hooked.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("pull"))
        jump = stash(hooked.join(pulled, F.col("low") == F.col("r"), "left").select("node", "root", F.least("low", F.coalesce("pull", "low")).alias("low")), "labels")
        if jump.where("low != root").isEmpty():
            return jump.select("node", "root")
        label = jump.select("node", F.col("low").alias("root"))


def link_rows(keyed: DataFrame) -> DataFrame:
    """``vertex, root`` of rows ``vertex, key``: rows that share a key, directly or not, share a root.

    A key links its rows to the smallest of them, a star, so no key's rows are paired. Null keys link nothing.
    """
    held = stash(keyed.where("key is not null").select("vertex", "key").distinct(), "keys")
    least = held.groupBy("key").agg(F.min("vertex").alias("b"))
    edges = held.join(least, "key").select(F.col("vertex").alias("a"), "b").where("a != b")
    tree = components(edges)
    vertices = keyed.select("vertex").distinct()
    return vertices.join(tree, F.col("vertex") == F.col("node"), "left").select("vertex", F.coalesce("root", "vertex").alias("root"))


def group_ids(keyed: DataFrame, linked: DataFrame, size: int = 24) -> DataFrame:
    """``root, group_id``: digest of a component's sorted distinct keys, a line each, cut to ``size`` digits."""
    keys = stash(keyed.where("key is not null").join(linked, "vertex").select("root", "key").distinct(), "group-keys")
    counts = stash(keys.groupBy("root").agg(F.count("*").alias("n")), "group-sizes")
    # components of so many keys are few: each is chained, and as many roots come to the driver
    large = [r.root for r in counts.where(F.col("n") > MOST_KEYS).select("root").toLocalIterator()]
    few = keys.join(counts.where(F.col("n") <= MOST_KEYS).select("root"), "root") if large else keys
    joined = F.concat_ws("\n", F.array_sort(F.collect_list("key")))
    ids = few.groupBy("root").agg(F.substring(F.sha2(joined, 256), 1, size).alias("group_id"))
    if not large:
        return ids
    named = [(root, chained_sha256(keys.where(F.col("root") == F.lit(root)), F.col("key"), [F.col("key")], between=b"\n")[1][:size]) for root in large]
    return ids.unionByName(keys.sparkSession.createDataFrame(named, ids.schema))
