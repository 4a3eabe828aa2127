import random
import re
from collections import Counter

from plumbline.llm.rules import COUNTS, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)]


def test_counts_and_hosts(spark):
    r = random.Random(2)
    words = ["a", "b", "çé", "#x", "<>&", "日本"]
    texts = [None, "", "\n\n", "x", "a\n", "\na", " a \n a \n\n", "a b c a b c", "a\tb\x0bc"] + ["".join(r.choice(words) + r.choice([" ", "  ", "\n", "\n\n", "\r\n"]) for _ in range(r.randrange(1, 200))) for _ in range(150)]
    texts += ["long word " * 100000, "é" * 3_000_000]
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, t, "bad") for i, t in enumerate(texts)] + [(1000 + i, good, "good" if i % 2 else None) for i in range(40)] + [(2000, good, "bad"), (2001, "short", "small"), (2002, good, "small")]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, source string, host int")
    out = {x.doc_id: x for x in quality_rules(docs).collect()}
    assert len(out) == len(rows)
    for i, t, _ in rows:
        want = brute(t)
        assert [out[i][c] for c in COUNTS] == want
        assert out[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert all(out[1000 + i].kept for i in range(40))
    assert not out[2000].base_failed and not out[2000].kept and out[2002].host_rate <= 0.7
    assert quality_rules(docs.limit(0)).count() == 0


def test_null_ids_and_a_host_far_over_the_mean(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(None, good, "h0"), (None, None, "h0"), (None, good, None)]
    rows += [(100 * h + k, good if k % 50 else "short", f"h{h}") for h in range(8) for k in range(100)]
    rows += [(5000 + k, good if k % 5 < 3 else "short", "poor") for k in range(200)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(out) == len(rows) and sum(x.doc_id is None for x in out) == 3
    # 40 per cent fail: below half, but over three times the mean of hosts
    poor = [x for x in out if x.doc_id is not None and x.doc_id >= 5000]
    assert not any(x.kept for x in poor) and 0.3 < poor[0].host_rate < 0.5
    assert all(x.kept != x.base_failed for x in out if x.doc_id is not None and x.doc_id < 5000)
