import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import overlap_join as oj
from plumbline.llm import similar
from plumbline.llm.overlap_join import bucket_keys, cheapest, meetings, prefix_size, similar_components
from plumbline.llm.similar import shingle_sets
from tests.llm.test_similar import planted, shingles

U = np.uint64


def brute(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def result(spark, rows):
    docs = spark.createDataFrame([(i, t, 0, "x", 1) for i, t in rows], "doc_id long, text string, node int, id string, first int")
    return sorted(map(tuple, similar_components(docs).collect()), key=repr)


def short(seed=1, n=160):
    r, rows = random.Random(seed), []
    for i in range(n):
        base = [f"w{r.randrange(40)}" for _ in range(r.randrange(3, 14))]
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(base[:-1])), (3 * i + 2, " ".join([*base, "w1"]))]
    return rows


@pytest.mark.parametrize(("boundary", "bucket"), [(None, 2048), (9, 2048), (60, 4), (10**6, 2048)])
def test_any_boundary_gives_the_links_of_brute_force(spark, monkeypatch, boundary, bucket):
    monkeypatch.setattr(similar, "BUCKET", bucket)
    if boundary:
        monkeypatch.setattr(oj, "_boundary", lambda nodes: boundary)
    rows = planted() + [(1000 + i, t) for i, t in short()]
    assert result(spark, rows) == brute(rows)


def test_nulls_repeated_rows_and_a_crowd_of_copies(spark):
    rows = [(7, "x y z"), (7, "x y z"), (None, "x y z"), (None, "u v"), (None, None), (3, ""), (4, " \n"), (9, "X  y z"), (1, "a b c d e f"), (None, "a b c d e f")]
    rows += [(100 + i, "one text of which there are many copies here") for i in range(200)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_a_crowd_below_the_threshold_links_nothing(spark):
    r = random.Random(8)
    base = [f"w{r.randrange(500)}" for _ in range(60)]
    rows = [(i, " ".join(base + [f"v{r.randrange(9999)}" for _ in range(20)])) for i in range(150)]
    assert result(spark, rows) == brute(rows) and len({c for *_, c in brute(rows)}) == 150


def test_keys_meet_wherever_sets_are_similar():
    r = np.random.RandomState(3)
    for boundary in (1, 6, 30, 1000):
        for _ in range(300):
            n = r.randint(2, 45)
            x = np.sort(r.choice(10**6, n, replace=False)).astype(U)
            y = np.union1d(x[r.rand(n) < 0.93], r.choice(10**6, r.randint(0, 4))).astype(U)
            if not len(y) or 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)) or min(len(x), len(y)) < 2:
                continue
            a, b = (bucket_keys(z[: prefix_size(len(z), 2)], len(z), boundary) for z in (x, y))
            assert np.intersect1d(a, b).size, (boundary, x, y)


def test_boundary_follows_the_cost():
    rows, subsets = {c: 10.0 for c in range(11, 16)}, {11: 6, 12: 6, 13: 90, 14: 400, 15: 900}
    assert cheapest(subsets, rows) == 1  # lists of few meetings cost less at every size
    assert oj.CLASS**11 < cheapest(subsets, rows | {11: 500, 12: 900}) < oj.CLASS**15
    assert cheapest({10: 1, 11: 1}, {10: 99.0, 11: 99.0}) >= oj.CLASS**11
    assert cheapest({3: 1, 4: 1}, {3: 1, 4: 2}) == 3  # as many rows, and fewer meetings
    assert cheapest({}, {}) == 1


def test_every_pair_of_a_bucket_meets_once(monkeypatch):
    monkeypatch.setattr(oj, "PAIRS", 5)
    end = np.array([4, 4, 4, 4, 5, 7, 7])
    got = [(int(a), int(b)) for x, y in meetings(end) for a, b in zip(x, y, strict=True)]
    assert sorted(got) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (5, 6)]


def test_parities_never_differ_more_than_sets():
    a, b = shingle_sets(pa.array(["a b c d e f g h i j k", "a b c d e f g h i x y z"]))
    far = np.bitwise_count(np.frombuffer(oj.parities(a), U) ^ np.frombuffer(oj.parities(b), U)).sum()
    assert 0 < far <= len(np.setxor1d(a, b))


def test_wide_parities_fold_to_any_width():
    r = np.random.RandomState(6)
    for n, m in ((3000, 3400), (2000, 700), (40, 5000)):
        a, b = np.unique(r.randint(0, 2**62, n)).astype(U), np.unique(r.randint(0, 2**62, m)).astype(U)
        b = np.union1d(b, a[: n // 2])
        x, y = (oj.wide_parities(z) or oj.parities(z) for z in (a, b))
        small = min(len(x), len(y)) * 8
        want = np.bitwise_count(np.frombuffer(oj.parities(a, small), np.uint8) ^ np.frombuffer(oj.parities(b, small), np.uint8)).sum()
        assert oj.differing(x, y) == oj.differing(y, x) == want <= len(np.setxor1d(a, b))


def test_a_pair_is_given_by_one_of_its_buckets():
    r = np.random.RandomState(7)
    sets = [np.sort(r.choice(90, r.randint(1, 50), replace=False)) for _ in range(30)]
    low = np.full((30, oj.LOW), oj.NONE)
    for i, s in enumerate(sets):
        low[i, : min(len(s), oj.LOW)] = s[: oj.LOW]
    for i, s in enumerate(sets):
        for j in range(i):
            common = np.intersect1d(s, sets[j])
            given = [k for k in common if len(oj.first_common(low, np.array([i]), np.array([j]), np.full(30, k)))]
            known = np.intersect1d(low[i], low[j])
            known = known[known < oj.NONE]
            assert given == ([known.min()] if len(known) else common.tolist())
