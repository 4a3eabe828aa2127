import random
import re

import numpy as np
import xxhash

from plumbline.llm import simhash as sh

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fp = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, f"{fp[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus():
    r = random.Random(1)
    word = lambda: r.choice(["Alpha", "béta", "GAMMA", "d", "epsilon-very-long-word-of-more-than-thirty-two-bytes", "ÀÉ"]) + str(r.randrange(50))
    rows = [(i, " ".join(word() for _ in range(r.randrange(1, 60)))) for i in range(10, 120)]
    base = " ".join(word() for _ in range(400))
    for i in range(200, 240):
        w = base.split()
        w[r.randrange(400)] = word()
        rows.append((i, "\n\t ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n"), (5, "one"), (303, "ONE"), (304, "one two"), (305, base), (306, base), (307, "a b c " * 3000)]
    r.shuffle(rows)
    return rows


def test_like_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    want = brute(rows)
    assert sorted(tuple(x) for x in sh.simhash_components(docs).collect()) == want
    # buckets that are dealt again, or compared by chunks, lose no link
    assert sorted(tuple(x) for x in sh.simhash_components(docs, bucket=8).collect()) == want


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(7, "x y z"), (7, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert [x.component_id for x in sh.simhash_components(docs).collect()] == [7, 7, 7]
    assert sh.simhash_components(docs.limit(0)).count() == 0


def test_bit_sliced_distances():
    r = np.random.RandomState(0)
    base = r.randint(0, 2**63 - 1, 700, dtype=np.int64).astype(np.uint64)
    fps = np.concatenate([base, base ^ np.uint64(0b1011), base ^ (np.uint64(1) << np.uint64(63)), base ^ np.uint64(0xF0)])
    for radius in (1, 2, 3, 5):
        q, lane = sh.within(fps[:300], sh.planes_of(fps), len(fps), radius)
        exact = np.bitwise_count(fps[:300, None] ^ fps[None, :]) <= radius
        assert set(zip(q.tolist(), lane.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(exact)), strict=True))
