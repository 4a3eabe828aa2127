"""Repeated passages: op3 (words, automata) and op8 (bytes, suffix arrays) against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import substring_dedup as sd
from plumbline.llm import suffix_array as sa
from plumbline.llm.anchors import Bytes, Words, _grouped, anchors


def brute_words(rows, size):
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {k + j for k in range(len(w) - size + 1) if least[tuple(w[k : k + size])] < i for j in range(size)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out)


def brute_bytes(rows, size):
    count = Counter(b[k : k + size] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, rows = [text(30) for _ in range(5)], []
    near = text(60).split()
    for i in range(80):
        parts = [text(r.randrange(30))]
        for _ in range(r.randrange(3)):
            parts += [r.choice(shared), text(r.randrange(1, 9))]
        if i % 3 == 0:
            w = list(near)
            w[r.randrange(60)] = word()
            parts.append("\n".join(w))
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + " "), (102, None), (103, ""), (104, "x"), (105, "a " * 200), (106, "a " * 90), (107, "\0" * 100), (108, "\0" * 50 + "b")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd", [400, 1])
def test_words_like_brute_force(spark, crowd):
    rows = corpus(1)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    out = sd.substring_dedup(docs, window=12, crowd=crowd)
    assert sorted(tuple(x) for x in out.collect()) == brute_words(rows, 12)


@pytest.mark.parametrize("crowd", [400, 1])
def test_bytes_like_brute_force(spark, crowd):
    rows = corpus(2)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    out = sa.suffix_array_dedup(docs, length=48, crowd=crowd)
    assert sorted(tuple(x) for x in out.collect()) == brute_bytes(rows, 48)


def test_kept_texts_and_empty_tables(spark):
    rows = corpus(3)[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for x in sa.suffix_array_dedup(docs, length=48, with_bytes=True).collect():
        assert hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 and len(x.kept) == x.n_bytes - x.n_removed
    for x in sd.substring_dedup(docs, window=12, with_text=True).collect():
        assert hashlib.sha256(x.kept.encode()).hexdigest() == x.kept_sha256
    assert sa.suffix_array_dedup(docs.limit(0)).count() == 0
    assert sd.substring_dedup(docs.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    long, other = " ".join(f"w{i}" for i in range(40)), "x " * 5
    rows = [(1, long), (1, long), (1, other), (None, long), (None, None), (2, long + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x.doc_id), x.n_words, x.n_removed) for x in sd.substring_dedup(docs, window=12).collect())
    assert got == [("1", 5, 0), ("1", 40, 0), ("1", 40, 0), ("2", 41, 40), ("None", 0, 0), ("None", 40, 40)]
    got = sorted((str(x.doc_id), x.n_bytes, x.n_removed) for x in sa.suffix_array_dedup(docs, length=48).collect())
    n = len(long)
    assert got == [("1", 10, 0), ("1", n, n), ("1", n, n), ("2", n + 5, n), ("None", 0, 0), ("None", n, n)]


def test_reference_of_bounded_size(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b c"), (3, None)], "doc_id long, text string")
    reference = spark.createDataFrame([("q a b c d",), (None,)], "text string")
    assert {x.doc_id: x.kept for x in sd.remove_reference(docs, reference, window=4).collect()} == {1: "x y", 2: "a b c", 3: ""}
    monkeypatch.setattr(sd, "BROADCAST_WORDS", 3)
    with pytest.raises(ValueError):
        sd.remove_reference(docs, reference)


def test_two_stage_sorting():
    r = random.Random(0)
    for _ in range(200):
        b = bytes(r.choice(b"ab\0c"[: r.randrange(1, 5)]) for _ in range(r.randrange(1, 200)))
        assert sa.suffix_array(np.frombuffer(b, np.uint8)).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    for _ in range(60):
        bodies = [bytes(r.choice(b"ab") for _ in range(r.randrange(1, 60))) for _ in range(r.randrange(1, 6))]
        c = Counter(b[i : i + 16] for b in bodies for i in range(len(b) - 15))
        assert [f.tolist() for f in sa.repeated_starts(bodies, 16)] == [[c[b[i : i + 16]] > 1 for i in range(len(b) - 15)] for b in bodies]


def test_each_window_has_one_anchor(monkeypatch):
    from plumbline.llm import anchors as an

    r = np.random.RandomState(1)
    first = np.array([0, 5, 5, 300, 1000])
    names = r.randint(0, 50, 1000 - 3).astype(np.uint64) << np.uint64(40)
    for block in (1 << 19, 64):
        monkeypatch.setattr(an, "BLOCK", block)
        at, lo, hi = anchors(names, first, 20, 4)
        served = [(w, a) for a, p, q in zip(at, lo, hi, strict=True) for w in range(p, q + 1)]
        want = [(i, i + int(np.argmin(names[i : i + 17]))) for a, b in zip(first, first[1:], strict=False) for i in range(a, b - 19)]
        assert sorted(served) == want
    assert Words(50).window == 50 and Bytes(400).gram == 128


def test_nothing_goes_that_the_structures_do_not_report(monkeypatch):
    words = " ".join(f"w{i}" for i in range(20)).encode()
    lone, equal = sd._compare(12), sa._compare(48)
    assert lone([7], [words], [3]) == [[(0, 8, 3)]]
    assert equal([7, 8], [words, words + b"x"], [2, 1]) == [[(0, len(words) - 48, 2)], [(0, len(words) - 48, 2)]]
    assert equal([7], [words], [1]) == [[]]
    monkeypatch.setattr(sd.Automaton, "windows", lambda *_: iter(()))
    monkeypatch.setattr(sa, "repeated_starts", lambda bodies, length, places: [np.zeros(len(b) - length + 1, bool) for b in bodies])
    assert lone([7], [words], [3]) == [[]] and equal([7], [words], [5]) == [[]]


def test_shards_hold_whole_anchors(monkeypatch):
    monkeypatch.setattr(sd, "SHARD", 10)
    a, b = (" ".join(f"{c}{i}" for i in range(15)) for c in "ab")
    bodies = [x.encode() for x in (a, "x " + a, b, b + " y")]
    out = sd._compare(12)([1, 1, 2, 2], bodies, [5, 4, 1, 9])
    least = [{w: v for lo, hi, v in runs for w in range(lo, hi + 1)} for runs in out]
    assert least == [dict.fromkeys(range(4), 4), dict.fromkeys(range(5), 4), dict.fromkeys(range(4), 1), dict.fromkeys(range(4), 1) | {4: 9}]


def repeating(seed):
    """Texts in which one byte, one word or one line stands again and again, in ever other surroundings."""
    r = random.Random(seed)
    units = ["a", "ab", "word ", "one two ", "x" * 7 + " ", "- ", "line of words\n"]
    noise = lambda: " ".join(f"n{r.randrange(999)}" for _ in range(r.randrange(9)))
    rows = [(i, f"{noise()} {r.choice(units) * r.randrange(5, 90)} {noise()}{r.choice(units) * r.randrange(1, 60)} {noise()}") for i in range(80)]
    return rows + [(100, "a" * 400), (101, "word " * 300), (102, "z" * 60), (103, "only here " * 40)]


@pytest.mark.parametrize("crowd", [1000, 3])
def test_texts_that_repeat_themselves(spark, crowd):
    rows = repeating(crowd)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in sd.substring_dedup(docs, window=12, crowd=crowd).collect()) == brute_words(rows, 12)
    assert sorted(tuple(x) for x in sa.suffix_array_dedup(docs, length=48, crowd=crowd).collect()) == brute_bytes(rows, 48)


@pytest.mark.parametrize("unit", ["a", "word ", "one line of words that repeats\n"])
def test_pieces_of_repeating_texts_stay_small(unit):
    text = unit * (1_000_000 // len(unit))
    for items in (Words(), Bytes()):
        size = 0
        for _, _, _, _, starts, ends, _, _, _, head, tail, n in _grouped(pa.array([text]), items):
            size += int((ends[tail + items.window - 1] - starts[head]).sum()) if len(head) else 0
            assert n.sum() >= len(n)
        assert size < 6 * len(text), (items, size / len(text))
