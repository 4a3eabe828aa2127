import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import hard_negatives as hn
from plumbline.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, ord int, q string"


def brute(rows, every=50):
    live = [(i, y, [math.floor(256 * float(np.float32(v))) for v in x]) for i, y, x in rows if i is not None and y is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for k, (a, y, q) in enumerate(live):
        if a % every:
            continue
        scored = sorted((-sum(s * t for s, t in zip(q, r, strict=False)), i, z) for j, (i, z, r) in enumerate(live) if j != k)
        for p, positive in [(-s, i) for s, i, z in scored if z == y][:5]:
            fit = [(-s, i) for s, i, z in scored if z != y and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, positive, r, i, p, s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def result(spark, rows, every=50):
    docs = spark.createDataFrame([(i, y, x, 1, "q") for i, y, x in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(docs, F.col("vec_id") % every == 0).collect())


def clustered(n, dim=8, copies=0):
    r = np.random.RandomState(n)
    centres = r.normal(size=(6, dim))
    x = centres[r.randint(6, size=n)] + 0.3 * r.normal(size=(n, dim))
    x[:copies] = x[0]
    return [(int(i), int(y), v.tolist()) for i, y, v in zip(r.permutation(n), r.randint(4, size=n), x, strict=True)]


@pytest.mark.parametrize(("leaf", "group", "fan"), [(1024, 128, 64), (16, 4, 2)])
def test_like_brute_force(spark, monkeypatch, leaf, group, fan):
    for name, value in (("LEAF", leaf), ("GROUP", group), ("FAN", fan), ("NEAR", 1)):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(400, copies=130)  # a third of all vectors are one, so ids decide
    assert result(spark, rows, 10) == brute(rows, 10)


def test_whole_groups_are_pruned(spark, monkeypatch):
    for name, value in (("LEAF", 16), ("GROUP", 4), ("FAN", 4), ("NEAR", 1)):
        monkeypatch.setattr(hn, name, value)
    scored, score = [], hn._scored
    monkeypatch.setattr(hn, "_scored", lambda pairs, groups, *a: scored.append((pairs.count(), groups.count())) or score(pairs, groups, *a))
    r = np.random.RandomState(1)
    x = np.repeat(np.eye(8) * 3, 80, axis=0) + 0.05 * r.normal(size=(640, 8))
    rows = [(i, int(i % 3), v.tolist()) for i, v in enumerate(x)]
    assert result(spark, rows, 5) == brute(rows, 5)
    near, rest = scored[0], scored[1]
    assert near[0] + rest[0] < 0.4 * near[1] * 640 / 16, scored


def test_nulls_ties_and_repeated_rows(spark):
    v = [0.5, 0.25]
    rows = [(0, 1, v), (0, 1, v), (50, 1, v), (7, 1, v), (None, 1, v), (3, None, v), (4, 2, None), (5, 2, [0.5, None]), (6, 2, [0.5, float("nan")]), (8, 2, [float("inf"), 0.0])]
    rows += [(10 + i, 2, [0.4, 0.25]) for i in range(5)] + [(20, 2, [0.4, 0.25]), (20, 2, [0.4, 0.25]), (30, 3, []), (31, 2, [0.3])]
    assert result(spark, rows) == brute(rows)
    # a label of one row, and scores below zero, have no negatives
    assert result(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-1.0]), (50, 3, [1.0])]) == []


def test_empty_table_no_anchor_and_large_components(spark):
    assert result(spark, []) == [] and result(spark, [(1, 1, [0.5]), (2, 1, [0.5])]) == []
    r = random.Random(2)
    large = [(i, i % 2, [r.uniform(1e5, 2e5) for _ in range(4)]) for i in range(0, 100, 2)]  # beyond what a double counts exactly
    assert result(spark, large, 4) == brute(large, 4)
    with pytest.raises(ValueError, match="56 bits"):
        result(spark, [(0, 1, [1e9])])


def test_places_follow_the_planes():
    x = np.random.RandomState(4).normal(size=(500, 6)) * 100
    path, along = hn._place(x, hn._planes(x))
    assert len(np.unique(path)) > 20 and (path >= 0).all() and (path < 1 << hn.DEPTH).all()
    order = np.lexsort((along, path))
    near = ((x[order][1:] - x[order][:-1]) ** 2).sum(axis=1).mean()
    assert near < 0.8 * ((x[1:] - x[:-1]) ** 2).sum(axis=1).mean()


def test_intervals_hold_every_product():
    r = np.random.RandomState(9)
    a, c = r.randint(-300, 300, (40, 5)), r.randint(-300, 300, (60, 5))
    ca, ra = hn._ball(a.astype(float), np.zeros(40), np.ones(40))
    cc, rc = hn._ball(c.astype(float), np.zeros(60), np.ones(60))
    lo, hi = hn._interval(ca[None], np.array([ra]), cc[None], np.array([rc]))
    assert lo[0, 0] <= (a @ c.T).min() and (a @ c.T).max() <= hi[0, 0]
