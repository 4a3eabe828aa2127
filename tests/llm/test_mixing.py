import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm.mixing import WEIGHTS, mix, source_targets


def brute_targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        total, over = sum(w[s] for s in open_), []
        given = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s, x in given.items():
            target[s] += x
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                over.append(s)
        open_ -= set(over)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, "c": 5000, None: 77}, {"a": 5}, {"x": 0, "y": 10}, {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes), rel=1e-9, abs=1e-6)


def test_mix_meets_targets(spark):
    r = random.Random(3)
    rows = [(i, "w " * r.choice([1, 5, 40, 300]), r.choice(["a", "a", "a", "b", "c", "d", "é", None])) for i in range(1500)]
    rows += [(5000, None, "a"), (5001, "", "zz"), (5002, " \n", "b"), (5003, "one two", "only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mix(docs).collect()
    again = mix(docs.repartition(7)).collect()
    key = lambda x: x.doc_id
    assert sorted(out, key=key) == sorted(again, key=key)
    assert len(out) == len(rows)
    words = {i: len((t or "").split()) for i, t, _ in rows}
    by = {}
    for x in out:
        assert x.size == words[x.doc_id] and x.taken == x.copies * x.size <= 2 * x.size
        s = by.setdefault(x.source, [0, 0, x.target, x.source_size, 0])
        s[0], s[1], s[4] = s[0] + x.size, s[1] + x.taken, max(s[4], x.size)
    assert {k: v[2] for k, v in by.items()} == pytest.approx(brute_targets({k: v[0] for k, v in by.items()}), rel=1e-9, abs=1e-6)
    for s in by.values():
        assert s[0] == s[3] and abs(s[1] - s[2]) <= s[4] + 1e-6
    assert mix(docs.limit(0)).count() == 0


def test_long_texts_and_repeated_ids(spark):
    rows = [(1, "w " * 1_000_000, "a"), (2, "x" * 5_000_000, "a"), (3, "a b", "a"), (3, "a b", "a"), (3, "c", "b"), (None, "d e f", "b"), (None, "g", None)]
    out = sorted(mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect(), key=str)
    assert len(out) == len(rows) and mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert {x.size for x in out if x.doc_id in (1, 2)} == {1_000_000, 1}
    twice = [x.taken for x in out if x.doc_id == 3 and x.source == "a"]
    assert len(twice) == 2 and twice[0] == twice[1] and all(x.taken <= 2 * x.size for x in out)


def test_ids_of_any_type(spark):
    rows = [(f"d{i}", "w " * (1 + i % 9), f"s{i % 3}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = {r.doc_id: r for r in mix(docs).collect()}
    assert len(got) == 200 and {r.copies for r in got.values()} <= {0, 1, 2}
    for s in ("s0", "s1", "s2"):
        own = [r for r in got.values() if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 9
