"""Line deduplication over content-defined chunks of lines.

Each line gets a 64-bit hash; a line whose hash is smaller than those of the lines before and
after it ends a chunk. Whether it does depends on these three lines only, so an inserted line
moves no boundary but those next to it, and the chunks of a shared passage line up in all
documents that hold it. Two such lines are never neighbours, and neither the first line nor the
last but one ends a chunk, so only a text of one line is a chunk of one line.

Chunks of two lines or more that occur more than once in the corpus are removed wherever they
repeat; the first occurrence (smallest id, then place) stays. Candidates share a 64-bit key;
their bytes are compared by gathering the distinct contents of a key.

A passage's first and last lines lie in chunks that begin before or end behind it, so these
differ. Where a removed chunk has a neighbour that stays, the neighbour's lines next to it are
compared with those next to the first occurrence, and as many as agree go too. What goes so always
repeats lines of a place before, and the first of these places keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import WORD, let, spare, upto
from .store import stash


def chunks(text: Column) -> Column:
    """The chunks of a text, in order: ``array<struct<body, lines>>``; joined by \\n they give the text."""

    def cut(lines: Column) -> Column:
        return let(F.transform(lines, lambda x: F.xxhash64(x)), lambda hashes: ends(lines, hashes))

    def ends(lines: Column, hashes: Column) -> Column:
        n = F.size(lines)
        least = lambda i: (F.get(hashes, i - 1) < F.get(hashes, i - 2)) & (F.get(hashes, i - 1) < F.get(hashes, i))
        stops = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | ((i > 1) & (i < n - 1) & least(i)))
        return let(stops, lambda s: F.transform(s, lambda e, k: body(lines, F.coalesce(F.get(s, k - 1), F.lit(0)), e)))

    def body(lines: Column, start: Column, end: Column) -> Column:
        return F.struct(F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("body"), (end - start).alias("lines"))

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), cut)


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places of multi-line chunks to remove: ``id, row, at, first``, at counting a text's chunks from 0, first the place that stays.

    ``row`` is a hash of the text, so rows that repeat an id but not its text stay apart; of
    identical rows the first and the others look alike and all keep their first chunks.
    """
    placed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.posexplode(chunks(F.col(text_col))).alias("at", "chunk")).where((F.col("chunk.lines") >= 2) & F.col("chunk.body").rlike(WORD))
    keyed = placed.select("id", "row", "at", F.xxhash64("chunk.body").alias("h"), F.col("chunk.body").alias("body"))
    # combined before the shuffle: a chunk that a third of all documents share costs a row a task
    first = F.min(F.struct("id", "row", "at")).alias("first")
    groups = keyed.groupBy("h").agg(F.count("*").alias("n"), first, F.collect_set("body").alias("bodies")).where("n > 1")
    groups = stash(groups, "chunks")
    same = groups.where(F.size("bodies") == 1).select("h", "first")
    places = keyed.select("id", "row", "at", "h").join(same.hint("merge"), "h").where(~F.struct("id", "row", "at").eqNullSafe(F.col("first")))
    places = places.select("id", "row", "at", "first")
    mixed = groups.where(F.size("bodies") > 1).select("h")
    if mixed.isEmpty():
        return places
    # keys that two different contents share: compare these by their bytes
    apart = keyed.join(mixed, "h", "left_semi")
    firsts = apart.groupBy("h", "body").agg(F.count("*").alias("n"), first).where("n > 1")
    apart = apart.join(firsts, ["h", "body"]).where(~F.struct("id", "row", "at").eqNullSafe(F.col("first")))
    return places.unionByName(apart.select("id", "row", "at", "first"))


def _agreeing(a: Column, b: Column, from_end: bool) -> Column:
    """How many lines of two arrays agree, from the start or from the end; 0 for null."""
    at = lambda x, i: F.get(x, F.size(x) - 1 - i) if from_end else F.get(x, i)
    n = F.aggregate(upto(F.least(F.size(a), F.size(b))), F.lit(0), lambda n, i: F.when((n == i) & (at(a, i) == at(b, i)), n + 1).otherwise(n))
    return F.coalesce(F.when(b.isNotNull(), n), F.lit(0))


def _with_neighbours(docs: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, row, drop``: chunks to remove of each text, and for those at an edge what stands beside their first occurrence.

    ``drop`` is a map from the chunk's place to ``(before, after)``, lines or null.
    """
    places = stash(places, "places")
    own = places.groupBy("id", "row").agg(F.collect_set("at").alias("all"))
    # only a removed chunk whose neighbour stays has an edge
    edge = places.join(own.withColumnRenamed("id", "_id").withColumnRenamed("row", "_row").hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
    edge = edge.withColumn("before", (F.col("at") > 0) & ~F.array_contains("all", F.col("at") - 1)).withColumn("after", ~F.array_contains("all", F.col("at") + 1))
    edge = stash(edge.select("id", "row", "at", "first", "before", "after"), "edges")
    wanted = edge.where("before or after").groupBy("first").agg(F.max("before").alias("b"), F.max("after").alias("a"))
    wanted = wanted.groupBy(F.col("first.id").alias("_id"), F.col("first.row").alias("_row")).agg(F.collect_list(F.struct(F.col("first.at").alias("at"), "b", "a")).alias("ats"))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    held = texts.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
    lines = lambda want, cs, i: F.when(want, F.split(F.get(cs, i)["body"], "\n", -1))
    beside = lambda cs: F.transform("ats", lambda x: F.struct(x["at"].alias("at"), lines(x["b"], cs, x["at"] - 1).alias("before"), lines(x["a"], cs, x["at"] + 1).alias("after")))
    sides = held.select("id", "row", F.explode(let(chunks(F.col("text")), beside)).alias("x")).select(F.struct("id", "row", "x.at").alias("_first"), "x.before", "x.after")
    # rows that repeat id and text say the same
    sides = stash(sides.groupBy("_first").agg(F.min("before").alias("_before"), F.min("after").alias("_after")), "sides")
    joined = edge.join(sides.hint("merge"), F.col("first").eqNullSafe(F.col("_first")), "left")
    pair = F.struct(F.when(F.col("before"), F.col("_before")).alias("before"), F.when(F.col("after"), F.col("_after")).alias("after"))
    # rows that repeat id and text bring each place as often
    once = joined.groupBy("id", "row", "at").agg(F.min(pair).alias("pair"))
    return once.groupBy("id", "row").agg(F.map_from_entries(F.collect_list(F.struct("at", "pair"))).alias("drop"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated multi-line chunks, and lines that repeat beside them, taken out of ``text_col``; other columns as they are.

    Two columns are added: ``n_chunks_removed`` and ``n_lines_removed``; older ones of these names go.
    Texts without a repeated chunk are returned byte for byte; a null text stays null. Chunks
    without a word, single lines and the first occurrence of a chunk stay. Rows that repeat both id
    and text count as one document; a null id is smaller than any. A document may end up empty. Extra
    columns may have any name. Empty table: no rows.
    """
    docs = docs.drop("n_chunks_removed", "n_lines_removed")
    i, r, d, new = (spare(x, docs.columns) for x in ("_id", "_row", "_drop", "_new"))
    drops = _with_neighbours(docs, repeated_chunks(docs, id_col, text_col), id_col, text_col)
    drops = stash(drops.select(F.col("id").alias(i), F.col("row").alias(r), F.col("drop").alias(d)), "drops")
    # by merging at every size: what is dropped grows with the corpus
    joined = docs.join(drops.hint("merge"), F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(r)), "left")

    def left(c: Column, at: Column) -> Column:
        """The lines of a chunk that stay."""
        lines, before, after = F.split(c["body"], "\n", -1), F.try_element_at(F.col(d), at - 1), F.try_element_at(F.col(d), at + 1)
        edges = F.struct(_agreeing(lines, before["after"], False).alias("head"), _agreeing(lines, after["before"], True).alias("tail"))
        kept = let(edges, lambda e: F.slice(lines, e["head"] + 1, F.greatest(F.size(lines) - e["head"] - e["tail"], F.lit(0))))
        return F.when(F.map_contains_key(d, at), F.array().cast("array<string>")).when(before.isNull() & after.isNull(), lines).otherwise(kept)

    def rebuilt(cs: Column) -> Column:
        return let(F.flatten(F.transform(cs, left)), lambda x: F.struct(F.array_join(x, "\n").alias("text"), F.size(x).alias("lines")))

    result = F.when(F.col(d).isNotNull(), let(chunks(F.col(text_col)), rebuilt))
    gone = F.size(F.split(F.col(text_col), "\n", -1)) - F.col(f"{new}.lines")
    return joined.withColumn(new, result).select(
        *[(F.when(F.col(d).isNull(), F.col(c)).otherwise(F.col(f"{new}.text")).alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns],
        F.coalesce(F.size(F.map_keys(d)), F.lit(0)).cast("long").alias("n_chunks_removed"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_lines_removed"),
    )
