"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. Equal blocks, and only equal
blocks, get the same integer name; then adjacent names pair up and the pairs are named in the
same way, until one name is left for each document. Two documents have the same number of
blocks and the same last name exactly if their texts are equal.

A name is ``(h, r)``: a 64-bit key of the content and the rank of the content among the sorted
distinct contents with that key. The sort that ranks them sees every block, so names are free
of collisions; ranks over 0 are as rare as 64-bit collisions, so only a list of those
exceptions is joined back to the documents. What is shuffled is each distinct block once for
each map task, and 24 bytes for each pair of names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import BLANKS, upto
from .store import stash

#: Exceptions are joined by broadcast up to this number of rows, else by a shuffle.
BROADCAST_ROWS = 10_000
#: Copies over which a group's documents are dealt by a hash of their id too, into so many parts.
LARGE, SALTS = 500, 64

Key = Callable[..., Column]


def _exceptions(rows: DataFrame, level: int) -> tuple[DataFrame, int]:
    """Contents whose rank among those with their key is over 0: (h, content, r).

    ``collect_set`` holds the distinct contents of one 64-bit key, one but for collisions, and is
    combined before the shuffle, so a block that a third of all rows share costs one row a task.
    """
    sets = rows.groupBy("h").agg(F.sort_array(F.collect_set("content")).alias("all")).where(F.size("all") > 1)
    found = stash(sets.select("h", F.posexplode("all").alias("r", "content")).where("r > 0"), f"names{level}")
    return found, found.count()


def _resolve(named: DataFrame, texts: DataFrame, contents: str, extra: DataFrame, n: int) -> DataFrame:
    """Put the ranks of ``extra`` into the array ``names`` of each document concerned.

    ``texts`` has the ``names`` and ``contents`` of each text once, told by its digest: rows with one text have one name.
    """
    each = texts.select("text_sha256", F.posexplode(contents).alias("i", "content"), "names").select("text_sha256", "i", "content", F.col("names")[F.col("i")]["h"].alias("h"))
    small = F.broadcast(extra) if n <= BROADCAST_ROWS else extra
    hits = each.join(small, ["h", "content"]).groupBy("text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("i", "r"))).alias("_ranks"))
    ranked = F.transform("names", lambda x, i: F.struct(x["h"].alias("h"), F.coalesce(F.col("_ranks")[i], x["r"]).alias("r")))
    return named.join(hits, "text_sha256", "left").withColumn("names", F.when(F.col("_ranks").isNull(), F.col("names")).otherwise(ranked)).drop("_ranks")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096, key: Key = F.xxhash64) -> DataFrame:
    """One row for each of ``docs``: ``id``, ``text_sha256``, ``n_blocks`` and the name ``h``, ``r``.

    ``key`` makes 64-bit keys of columns; tests give one that collides.
    """
    # a string's UTF-8 bytes can be cut at any place without a scan from its start
    text = F.encode(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), BLANKS, " "), "UTF-8")
    base = docs.select(F.col(id_col).alias("id"), text.alias("bin"))
    cuts = upto(F.greatest(F.ceil(F.octet_length("bin") / block_bytes), F.lit(1)))
    cut = base.select("id", F.sha2("bin", 256).alias("text_sha256"), F.transform(cuts, lambda i: F.substring(F.col("bin"), i * block_bytes + 1, F.lit(block_bytes))).alias("blocks"))
    zero = F.lit(0).alias("r")
    named = stash(
        cut.select("id", "text_sha256", F.size("blocks").alias("n_blocks"), F.transform("blocks", lambda b: F.struct(key(F.lit(0), b).alias("h"), zero)).alias("names")),
        "blocks",
    )
    extra, n = _exceptions(cut.select(F.explode("blocks").alias("content")).withColumn("h", key(F.lit(0), "content")), 0)
    if n:
        once = named.select("text_sha256", "names").dropDuplicates(["text_sha256"])
        blocks = cut.select("text_sha256", "blocks").dropDuplicates(["text_sha256"]).join(once, "text_sha256")
        named = stash(_resolve(named, blocks, "blocks", extra, n), "blocks")
    done, level, none = [], 0, F.struct(F.lit(0).cast("long").alias("h"), F.lit(-1).alias("r"))  # no name has rank -1
    while True:
        # what has its last name leaves; the rest halves with each level
        done.append(named.where(F.size("names") == 1).select("id", "text_sha256", "n_blocks", F.col("names")[0]["h"].alias("h"), F.col("names")[0]["r"].alias("r")))
        named = named.where(F.size("names") > 1)
        if named.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level += 1
        pairs = F.transform(upto(F.ceil(F.size("names") / 2)), lambda i: F.struct(F.col("names")[2 * i].alias("a"), F.coalesce(F.get(F.col("names"), 2 * i + 1), none).alias("b")))
        paired = named.withColumn("pairs", pairs).drop("names")
        key_of = lambda p, at=level: key(F.lit(at), p["a"]["h"], p["a"]["r"], p["b"]["h"], p["b"]["r"])
        extra, n = _exceptions(paired.select(F.explode("pairs").alias("content")).withColumn("h", key_of(F.col("content"))), level)
        named = paired.withColumn("names", F.transform("pairs", lambda p: F.struct(key_of(p).alias("h"), zero)))
        if n:
            named = _resolve(named, named.select("text_sha256", "names", "pairs").dropDuplicates(["text_sha256"]), "pairs", extra, n)
        named = stash(named.drop("pairs"), "names")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096, key: Key = F.xxhash64) -> DataFrame:
    """Groups of equal texts: ``id_col, keep_id, group_size, kept, text_sha256``, a row for each row.

    Texts are equal when identical after each run of white space became one space. A null text
    counts as empty. The row with the smallest id stays; rows that repeat an id share its fate, a
    null id is smaller than none, so it stays only where the whole group has null ids. An empty
    table gives an empty result. Further columns of ``docs`` are ignored.
    """
    named = stash(identities(docs, id_col, text_col, block_bytes, key).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), "named")
    last = ["n_blocks", "h", "r"]
    # one row for each group of copies, combined before the shuffle; single documents need no join
    groups = stash(named.groupBy(*last).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "groups")
    # the row of a large group meets its documents in SALTS places; what has met it there needs no key in the second join
    large = groups.where(F.col("group_size") > LARGE).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    first = named.join(large.hint("merge"), [*last, "salt"], "left")
    met = F.col("group_size").isNotNull()
    first = first.withColumn("r", F.when(met, -1 - F.col("salt")).otherwise(F.col("r"))).withColumnsRenamed({"keep_id": "_keep", "group_size": "_size"})
    small = groups.where(F.col("group_size") <= LARGE)
    return (
        first.join(small.hint("merge"), last, "left")
        .withColumns({"keep_id": F.when(F.col("_size").isNull(), F.col("keep_id")).otherwise(F.col("_keep")), "group_size": F.coalesce("_size", "group_size")})
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            F.when(F.col("group_size").isNull(), True).otherwise(F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            "text_sha256",
        )
    )
