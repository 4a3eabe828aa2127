"""Every query outside the optional subpackage against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return con


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_like_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = duck.sql(ORACLES[name])
    assert columns == sorted(found.columns)
    got = sorted((tuple(plain(x) for x in r) for r in df.select(*columns).collect()), key=repr)
    want = sorted((tuple(plain(x) for x in r) for r in found.select(*columns).fetchall()), key=repr)
    assert got == want


def test_json_strictness(spark):
    for r in QUERIES["json_strict"](spark, FOLDER).collect():
        turn = r.event_id % 5
        assert r.strict == (turn in (0, 4)), turn
        assert r.repeats_key == (turn == 1), turn
        assert r.caption_only == (turn == 4), turn


def test_identities_and_tensor_digests(spark):
    import hashlib

    from pyspark.sql import functions as F

    from plumbline.functions.identity import identity_keys, linked_keys
    from plumbline.operators.lineage import tensor_digest

    schema = "isbn string, title string, context string, source string, grp string, has boolean"
    rows = [("0-306-40615-2", "Ａ  Cat!", None, "once  upon", "g1", False), ("x", "--", "", "hidden", None, True), (None, None, None, None, None, False)]
    df = spark.createDataFrame(rows, schema)
    keys = identity_keys(F.col("isbn"), F.col("title"), F.col("context"), F.col("source"), F.col("grp"), F.col("has"))
    got = df.select(linked_keys(keys, F.col("isbn")).alias("k")).collect()
    assert got[0].k == ["isbn:0306406152", "title:acat", "context:" + hashlib.sha256(b"onceupon").hexdigest(), "existing-group:g1", "isbn:9780306406157"]
    assert got[1].k == ["isbn:X"] and got[2].k == []
    vectors = spark.createDataFrame([("a", [1.0, -0.5]), ("a", [1.0, -0.25]), ("b", [1.0, -0.5])], "name string, v array<float>")
    digests = [r.d for r in vectors.select(tensor_digest(F.col("name"), F.col("v")).alias("d")).collect()]
    assert digests[0] == hashlib.sha256(b"a:float:2\n1.0,-0.5").hexdigest() and len(set(digests)) == 3


def test_fingerprint_ignores_order(spark):
    from plumbline.operators.lineage import content_fingerprint

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first, again = (content_fingerprint(d, "doc_id", ["doc_id", "text"]).first() for d in (docs, docs.repartition(5)))
    changed = content_fingerprint(docs.where("doc_id != 3"), "doc_id", ["doc_id", "text"]).first()
    assert first == again and first.fingerprint != changed.fingerprint


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "group_id", "split"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
