import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import collocations as co
from plumbline.llm.collocations import collocations


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, words=3, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, words + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    found = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        cuts = [(1000000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        longer = any(len(h) > len(g) and b >= least and 100 * b >= 50 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for (x, h), b in f.items() if x == lang)
        if not longer:
            found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, own in found.items() for r, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def result(spark, rows, **more):
    docs = spark.createDataFrame([(x, t, "x", 1) for x, t in rows], "lang string, text string, f string, w1 int")
    out = collocations(docs, **more)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(x) for x in out.collect())


def prose(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["new", "york", "city", "New", "York", "the", "of", "a.b", "état", "ÉTAT", "naïve", "x y", "日本", "-", "#"]
    text = lambda k: "".join(r.choice(vocabulary) + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " ! "]) for _ in range(k))
    return [(r.choice(["en", "en", "de", None, "und", ""]), text(r.randrange(60))) for _ in range(n)]


def test_like_brute_force(spark):
    rows = prose(1, 200) + [("en", None), (None, None), ("fr", " \n.,"), ("en", "new york city " * 40)]
    rows += rows[:20]  # repeated rows count again
    want = brute(rows)
    assert result(spark, rows) == want and len({x[0] for x in want}) >= 3 and any(len(x[2].split()) == 3 for x in want)
    assert result(spark, rows, words=4, least=3, top=7) == brute(rows, 4, 3, 7)
    assert result(spark, rows, words=2, least=2) == brute(rows, 2, 2)


@pytest.mark.parametrize(("shard", "segment"), [(1, 1 << 20), (200, 40), (1 << 20, 7)])
def test_shards_and_segments_give_the_same(spark, monkeypatch, shard, segment):
    rows = prose(2, 30) + [("en", "ab cd ef " * 30 + "w" * 90 + " ab cd " * 9)]
    monkeypatch.setattr(co, "SHARD", shard)
    monkeypatch.setattr(co, "SEGMENT", segment)
    assert result(spark, rows) == brute(rows)


def test_one_pair_in_a_third_of_all_words_and_ties(spark):
    rows = [("en", "hot pair " * 500)] * 4 + [("en", f"w{i % 7} w{i % 5}. w{i % 7} w{i % 5}") for i in range(200)]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == [] and result(spark, [("en", None), ("en", "one two")]) == []


def test_a_filter_never_misses_and_segments_hold_each_run_once():
    names = np.random.RandomState(1).randint(0, 2**62, 5000).astype(np.uint64)
    at = np.unique(co._Filter.places(names))
    words = np.zeros(co.BITS // 64, np.uint64)
    np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
    check = co._Filter(words)
    assert check(names).all() and check(names + np.uint64(12345)).mean() < 0.01 and len(words) * 64 != co.CELLS
    raw = np.frombuffer(b"aa b. c  dddd e " * 50, np.uint8)
    assert sum(len(co._bounds(s[f:], np.array([0, len(s) - f]))[0]) for s, f in co._segments(raw, 2, 9)) == 250


def test_scores_beyond_64_bits(spark):
    # 10^6 a a passes 64 bits from a = 4,294,968 on; the decimal form is exact there
    a, b, c = 5_000_000_011, 5_000_000_029, 5_000_000_039
    got = spark.range(1).selectExpr(f"(1000000 * (CAST({a}L AS DECIMAL(19, 0)) * CAST({a}L AS DECIMAL(19, 0)))) div (CAST({b}L AS DECIMAL(19, 0)) * CAST({c}L AS DECIMAL(19, 0))) AS s").first().s
    assert got == 1000000 * a * a // (b * c)
