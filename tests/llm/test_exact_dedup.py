import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from plumbline.llm.exact_dedup import exact_dedup

LONG = "word " * 5000


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return sorted((i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)


ROWS = [(5, "a  b"), (2, "a\tb"), (3, None), (4, ""), (9, " "), (1, LONG), (0, LONG + "x"), (7, LONG.replace(" ", "\n")), (8, "é" * 3000), (6, "é" * 3001), (11, LONG[:4096]), (12, LONG[:4096] * 2), (10, LONG[:4096] * 3)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_like_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("keep_id", F.lit("clash")).withColumn("h", F.lit(1))
    assert rows_of(exact_dedup(docs)) == brute(ROWS)


def test_colliding_keys_still_name_exactly(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    key = lambda *c: F.pmod(F.xxhash64(*c), F.lit(2))
    assert rows_of(exact_dedup(docs, block_bytes=4096, key=key)) == brute(ROWS)


def test_colliding_keys_of_repeated_rows(spark):
    rows = [r for r in ROWS for _ in (0, 1)] + [(None, LONG), (None, LONG), (20, LONG[:4096] * 4), (20, LONG[:4096] * 4), (20, LONG[:4096] * 5)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), key=lambda *c: F.pmod(F.xxhash64(*c), F.lit(2)))
    named = [(i, t) for i, t in rows if i is not None]
    want = {(i, k, kept, sha) for i, k, _, kept, sha in brute(named)}
    out = [(r.doc_id, r.keep_id, r.kept, r.text_sha256) for r in got.collect()]
    assert len(out) == len(rows) and {x for x in out if x[0] is not None} == want and {x[1] for x in out if x[0] is None} == {1}


def test_empty_and_null_ids(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    out = exact_dedup(spark.createDataFrame([(None, "x"), (3, "x"), (3, "x")], "doc_id long, text string"))
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in out.collect()) == [("3", 3, 3, True), ("3", 3, 3, True), ("None", 3, 3, False)]
