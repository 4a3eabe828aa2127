"""Mixing sources to target weights by pivotal dependent rounding.

A document is wanted ``target / source_size`` times. The whole part is taken at once; what is
left is a fraction for each document. In the pivotal method two fractional documents meet and
mass moves at random from one to the other, words for words, until one of them is wholly in or
out. The other goes on to meet the next. So each expectation holds exactly and, as every move
keeps the words of the pair, a source ends within one document of its target.

The meetings form a reduction tree: documents fall into cells of some tens by a hash of their
id, each cell is folded in one row from its longest document to its shortest, and the residuals of the cells are the next level's
documents. A level costs a shuffle of a fortieth of the level before; a source with a third of
all rows has just more cells. Random draws are hashes of ids, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import WORD
from .store import stash

#: Documents that meet in a cell, on average.
CELL = 40
#: The weights that sources take in turn.
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Target words of each source: ``source, source_size, target``.

    ``sizes`` has a row ``source, source_size`` for each source. Sources in code-point order, null
    last, take ``weights`` in turn and share ``share`` of all words; a target stops at ``most``
    times its source's size and the excess is shared again by weight until no target is above.
    That end is a common level: target = min(most * size, level * weight). Source-level rows only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", turn.alias("w"), (F.col("source_size") * most).alias("cap"))
    # sources reach their caps in the order of cap / weight; behind the last one that does the level is even
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, behind, whole = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(behind)
    levels = weighed.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(whole)["level"]
    return levels.select("source", "source_size", F.coalesce(F.least("cap", F.col("w") * open_level), "cap").alias("target"))


def _unit(*parts: Column) -> Column:
    """A draw in [0, 1) that depends on ``parts`` only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * 2.0**-53


def _meet(carry: Column, x: Column, level: int) -> Column:
    """The residual and the settled one of two documents ``(id, f, size)`` after their meeting.

    Words a = f * size can move up to min(a of one, room of the other) in either direction; the
    chance of each is in proportion to the other's length, which keeps both expectations.
    """
    a, b = carry, x
    up = F.least((1 - a["f"]) * a["size"], b["f"] * b["size"])  # words that a can gain from b
    down = F.least(a["f"] * a["size"], (1 - b["f"]) * b["size"])
    gain = _unit(F.lit(level), a["id"], b["id"], F.lit("meet")) * (up + down) < down
    full_a, empty_b = (1 - a["f"]) * a["size"] <= b["f"] * b["size"], a["f"] * a["size"] <= (1 - b["f"]) * b["size"]
    entry = lambda y, f: F.struct(y["id"].alias("id"), f.cast("double").alias("f"), y["size"].alias("size"))
    clip = lambda f: F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0))
    a_up, b_down = clip(a["f"] + up / a["size"]), clip(b["f"] - up / b["size"])
    a_down, b_up = clip(a["f"] - down / a["size"]), clip(b["f"] + down / b["size"])
    both = lambda rest, settled: F.struct(rest.alias("rest"), settled.alias("settled"))
    return (
        F.when(gain & full_a, both(entry(b, b_down), entry(a, F.lit(1.0))))
        .when(gain, both(entry(a, a_up), entry(b, F.lit(0.0))))
        .when(empty_b, both(entry(b, b_up), entry(a, F.lit(0.0))))
        .otherwise(both(entry(a, a_down), entry(b, F.lit(1.0))))
    )


def _fold(cell: Column, level: int, id_type: str) -> Column:
    """Fold the sorted documents of a cell: ``(rest, settled[])``."""
    kind = f"struct<id:{id_type},f:double,size:bigint>"
    start = F.struct(F.lit(None).cast(kind).alias("rest"), F.array().cast(f"array<{kind}>").alias("settled"))

    def step(acc: Column, x: Column) -> Column:
        met = F.element_at(F.transform(F.array(_meet(acc["rest"], x, level)), lambda m: F.struct(m["rest"].alias("rest"), F.array_append(acc["settled"], m["settled"]).alias("settled"))), 1)
        return F.when(acc["rest"].isNull(), F.struct(x.alias("rest"), acc["settled"].alias("settled"))).otherwise(met)

    return F.aggregate(cell, start, step)


def round_fractions(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """Round ``f`` of each row ``(part, id, f, size)`` with 0 < f < 1 to 0 or 1: ``part, id, up``.

    Sums of f * size hold within each ``part`` up to the last document. Rows that repeat an id
    within a part are rounded alike as one. The tree has log_cell(rows) levels.
    """
    left, done, level = docs.select("part", "id", "f", F.col("size").cast("long").alias("size")), [], 0
    id_type = left.schema["id"].dataType.simpleString()
    while True:
        per_part = left.groupBy("part").agg(F.count("*").alias("n"))
        n = per_part.agg(F.max("n")).first()[0] or 0
        if n <= 1:
            break
        # cells by hash: a part's number of cells follows its rows, so no cell grows with the part
        cells = left.join(per_part.select(F.col("part").alias("_part"), F.ceil(F.col("n") / cell).alias("cells")), F.col("part").eqNullSafe(F.col("_part"))).select("part", "id", "f", "size", F.pmod(F.xxhash64(F.lit(level), "id"), F.col("cells")).alias("cell"))
        folded = cells.groupBy("part", "cell").agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("k"), F.xxhash64(F.lit(level), "id").alias("j"), "id", "f", "size"))).alias("all"))
        plain = F.transform("all", lambda x: F.struct(x["id"].alias("id"), x["f"].alias("f"), x["size"].alias("size")))
        folded = stash(folded.select("part", plain.alias("all")).select("part", _fold(F.col("all"), level, id_type).alias("out")), "mix")
        done.append(folded.select("part", F.explode("out.settled").alias("x")).select("part", "x.id", (F.col("x.f") > 0.5).alias("up")))
        rest = folded.select("part", "out.rest.*")
        # a meeting may settle both at once; then the residual is whole already
        done.append(rest.where("f <= 1e-12 or f >= 1 - 1e-12").select("part", "id", (F.col("f") > 0.5).alias("up")))
        left, level = rest.where("f > 1e-12 and f < 1 - 1e-12"), level + 1
    # a part's last document goes where it is nearer: no other is left to take its words
    done.append(left.select("part", "id", (F.col("f") >= 0.5).alias("up")))
    return reduce(DataFrame.unionByName, done)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """How often the mix takes each document: ``id_col, size, source_size, target, taken``, then source and ``copies``.

    Size is the number of words; a null or blank text has 0 and is never taken. A null source is
    a source of its own. Ids may be of any type that can be sorted; rows that repeat one within a source count each but are taken alike.
    Each source's taken words end within about one document of its target. Empty table: no rows.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    sized = stash(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "sizes")
    totals = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, most, weights)
    totals = stash(totals, "targets")
    totals = totals.withColumnRenamed("source", "_source")
    rated = sized.join(totals, F.col("source").eqNullSafe(F.col("_source"))).select("id", F.col("source").alias("part"), "size", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    fraction = F.col("rate") - F.floor("rate")
    split = stash(rated.select("*", F.floor("rate").alias("whole"), fraction.alias("f")), "rates")
    open_rows = split.where("size > 0 and f > 1e-12 and f < 1 - 1e-12").groupBy("part", "id").agg(F.first("f").alias("f"), F.sum("size").alias("size"))
    up = round_fractions(open_rows)
    ups = up.where("up").select(F.col("part").alias("p"), F.col("id").alias("i")).withColumn("one", F.lit(1))
    joined = split.join(ups, F.col("id").eqNullSafe(F.col("i")) & F.col("part").eqNullSafe(F.col("p")), "left")
    extra = F.when(F.col("f") >= 1 - 1e-12, 1).otherwise(F.coalesce("one", F.lit(0)))
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("long")
    return joined.select(F.col("id").alias(id_col), "size", F.col("source_size"), F.col("target"), (copies * F.col("size")).alias("taken"), F.col("part").alias(source_col), copies.alias("copies"))
