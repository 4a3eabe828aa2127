import random

import numpy as np
import pytest

from plumbline.llm import meeting, similar
from plumbline.llm.meeting import differing, parities
from plumbline.llm.similar import keep_one_similar
from plumbline.llm.simhash import simhash_components


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """The smallest id of each component of rows (id, text) that are at least 0.8 similar."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def planted():
    r = random.Random(3)
    word = lambda: f"w{r.randrange(3000)}"
    boiler, rows = [word() for _ in range(20)], []
    for i in range(0, 600, 10):
        base = [word() for _ in range(r.randrange(30, 200))] + boiler
        rows.append((i, " ".join(base)))
        for k in range(1, 6):
            w = list(base)
            for _ in range(r.randrange(1, 1 + max(1, len(w) // 40))):
                w[r.randrange(len(w))] = word()
            rows.append((i + k, " ".join(w)))
        rows.append((i + 6, " ".join(base[: int(len(base) * r.uniform(0.7, 0.97))])))
    rows += [(900, "a b"), (901, "A  b"), (902, "a c"), (903, None), (904, " \n"), (905, "")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [2048, 4])
def test_planted_copies_like_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(similar, "BUCKET", bucket)  # buckets over it go through rounds and chunks
    rows = planted()
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, node int, _id string")
    want = brute(rows)
    assert sorted(x.doc_id for x in keep_one_similar(docs).collect()) == want
    if bucket > 4:  # the rule of op2's query leaves most of these copies
        assert simhash_components(docs).select("component_id").distinct().count() > 1.5 * len(want)


def test_one_crowd_of_near_copies(spark, monkeypatch):
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(60)] = f"v{r.randrange(9999)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tried = []
    original = similar.Sets.similar
    monkeypatch.setattr(similar.Sets, "similar", lambda self, pairs: (tried.append(pairs.count()), original(self, pairs))[1])
    assert sorted(x.doc_id for x in keep_one_similar(docs).collect()) == brute(rows)
    # far fewer than 79,800 pairs are counted in full
    assert len(tried) > 2 and sum(tried) < 20 * len(rows), tried


def test_copy_at_0_97_and_empty_table(spark):
    words = [f"w{i}" for i in range(104)]
    near = " ".join([*words[:-1], "other"])
    docs = spark.createDataFrame([(56, near), (2, " ".join(words)), (3, " ".join(words[:79]))], "doc_id long, text string")
    # 99 of 101, then 75 of 100 shingles
    assert sorted(x.doc_id for x in keep_one_similar(docs).collect()) == [2, 3]
    assert keep_one_similar(docs.limit(0)).count() == 0


def test_one_row_of_repeated_and_null_ids(spark):
    rows = [(7, "x y z"), (7, "x y z"), (None, "x y z"), (None, "u v"), (None, "u v"), (None, "q")]
    got = keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id or 0, x.text) for x in got) == [(0, "q"), (0, "u v"), (7, "x y z")]


def test_long_texts_below_the_threshold_are_not_counted_and_meet_once(spark, monkeypatch):
    r = random.Random(6)
    base = [f"w{r.randrange(900)}" for _ in range(1004)]
    # 1000 common shingles of 1220 in each, some twenty of them in prefixes: a similarity of 0.7, too long for 256 classes
    rows = [(i, " ".join(base + [f"v{r.randrange(9999)}" for _ in range(220)])) for i in range(30)]
    rows += [(100, rows[0][1] + " x"), (101, rows[1][1] + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted, given = [], []
    similar_, met = similar.Sets.similar, similar.met
    monkeypatch.setattr(similar.Sets, "similar", lambda self, pairs: (counted.append(pairs.count()), similar_(self, pairs))[1])
    monkeypatch.setattr(similar, "met", lambda rows, all_pairs: (given.append((all_pairs, met(rows, all_pairs).count(), met(rows, all_pairs).distinct().count())), met(rows, all_pairs))[1])
    assert sorted(x.doc_id for x in keep_one_similar(docs).collect()) == brute(rows)
    assert sum(counted) <= 10, counted  # of 496 pairs
    assert given[-1][0] and 0 < given[-1][1] <= 1.2 * given[-1][2], given  # one row a pair, not one for each common shingle


def test_parities_of_long_sets_part_pairs_that_short_parities_pass():
    r = random.Random(2)
    a, b = ([r.randrange(2**62) for _ in range(2000)] for _ in range(2))
    b[:1500] = a[:1500]  # similarity 0.6
    c = a[:1900] + b[1900:]  # 0.9
    sets = [np.unique(np.array(x, np.uint64)) for x in (a, b, c)]
    wide, short = ([parities(s, n) for s in sets] for n in (similar.classes(2000), similar.PARITY))
    limit = (2000 + 2000) / 9
    assert differing(short[0], short[1]) <= limit < differing(wide[0], wide[1])
    assert differing(wide[0], wide[2]) <= limit


def test_what_pairs_carry_is_bounded(spark, monkeypatch):
    r = random.Random(8)
    base = [f"w{r.randrange(900)}" for _ in range(404)]
    # 400 common shingles of 500: similarities of two thirds; some are near copies
    rows = [(i, " ".join(base + [f"v{r.randrange(9999)}" for _ in range(100)])) for i in range(20)]
    rows += [(100 + i, f"{rows[i][1]} x{k}") for i in range(3) for k in range(4)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    seen = []

    def spy(pairs, sizes, texts):
        parts = original(pairs, sizes, texts)
        size = {x.node: x.size for x in sizes.collect()}
        rows = [[(x.a, x.b) for x in p.collect()] for p in parts]
        assert sorted(sum(rows, [])) == sorted((x.a, x.b) for x in pairs.collect())  # each pair in one part
        seen.append((sum(len(p) for p in rows), max(sum(size[a] for a, _ in p) for p in rows), len(parts)))
        return parts

    original, at_once = meeting.sliced, 24_000
    monkeypatch.setattr(meeting, "CARRIED", 0)
    monkeypatch.setattr(meeting, "LEAST", at_once)
    for module in (meeting, similar):
        monkeypatch.setattr(module, "sliced", spy)
    assert sorted(x.doc_id for x in keep_one_similar(docs).collect()) == brute([(i, t) for i, (_, t) in enumerate(rows)])
    assert max(n for *_, n in seen) > 1 and all(most <= 2 * at_once for _, most, _ in seen), seen
