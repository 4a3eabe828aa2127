"""Flat digests of tables of any size, against Python's own."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import cache, chained, components, lineage


@pytest.mark.parametrize("library", [True, False])
def test_a_digest_goes_on_from_its_state(monkeypatch, library):
    if not library:
        monkeypatch.setattr(chained.Sha256, "library", None)
    elif chained.Sha256.library is None:
        pytest.skip("no crypto library here")
    r = random.Random(1)
    for n in (0, 1, 55, 56, 63, 64, 65, 119, 120, 500, 3000):
        data = r.randbytes(n)
        digest, at = chained.Sha256(), 0
        while at < n:
            step = r.randrange(1, 200)
            digest = chained.Sha256(digest.update(data[at : at + step]).state())
            at += step
        assert digest.hexdigest() == hashlib.sha256(data).hexdigest(), n


def test_ranges_are_chained_in_order(spark):
    rows = [(i, f"Straße {i} \"q\" \\ 日本\n") for i in random.Random(2).sample(range(9000), 3000)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that there are several ranges
    try:
        n, got = chained.chained_sha256(df, F.col("t"), [F.col("k")], b"<", b"|", b">")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert (n, got) == (3000, hashlib.sha256(("<" + "|".join(t for _, t in sorted(rows)) + ">").encode()).hexdigest())
    text = json.dumps([{"t": t, "k": k} for k, t in sorted(rows)], sort_keys=True, separators=(",", ":"))
    row = lineage.content_sha256(df, ["k"], ["t", "k"]).first()
    assert (row.n_rows, row.sha256) == (3000, hashlib.sha256(text.encode()).hexdigest())
    empty = lineage.content_sha256(df.limit(0), ["k"], ["t", "k"]).first()
    assert (empty.n_rows, empty.sha256) == (0, hashlib.sha256(b"[]").hexdigest())


def test_no_set_is_too_large(spark, monkeypatch):
    files = spark.createDataFrame([(f"p{i:03}", f"{i * 7:x}") for i in range(50)], "path string, sha256 string")
    keyed = spark.createDataFrame([(i, f"k{i % 40}") for i in range(90)] + [(i, f"k{i // 10}") for i in range(40)] + [(200, "x"), (201, None)], "vertex long, key string")
    linked = components.link_rows(keyed)
    want = lineage.file_set_digest(files).first(), sorted(map(tuple, components.group_ids(keyed, linked).collect()))
    monkeypatch.setattr(lineage, "MOST_FILES", 10)
    monkeypatch.setattr(components, "MOST_KEYS", 3)
    assert (lineage.file_set_digest(files).first(), sorted(map(tuple, components.group_ids(keyed, linked).collect()))) == want
    assert want[0].revision == hashlib.sha256("\n".join(sorted(f"p{i:03} {i * 7:x}" for i in range(50))).encode()).hexdigest()


def test_cache_fingerprint_is_that_of_one_text(spark):
    rows = spark.createDataFrame([(3, "ü"), (1, "a"), (2, 'q"')], "n long, id string")
    parts = {"config": {"b": 1}, "data_sha256": {"x": "y"}, "model_id": "m", "revision": "r", "selected_ids": ["a", 'q"', "ü"]}
    want = hashlib.sha256(json.dumps(parts, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert cache.cache_fingerprint("m", "r", {"b": 1}, {"x": "y"}, rows, "id", ["n"]) == want
    assert cache.cache_fingerprint("m", "r", {"b": 1}, {"x": "y"}, rows.limit(0), "id", [F.col("n")]) == hashlib.sha256(json.dumps(parts | {"selected_ids": []}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
