"""One text of 20 MB through each operator that reads words or bytes: results, and memory beside the text."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from plumbline.llm import quality, rules, simhash, similar, toxicity
from plumbline.llm import words as wt
from plumbline.llm.anchors import Bytes, Words, _grouped
from plumbline.llm.rules import quality_rules
from plumbline.llm.simhash import simhash_components
from plumbline.llm.substring_dedup import substring_dedup
from plumbline.llm.suffix_array import suffix_array_dedup

SIZE = 20 << 20


@pytest.fixture(scope="module")
def words():
    r = np.random.RandomState(4)
    letters = str.maketrans("0123456789", "ghijklmnop")
    return " ".join(f"{a:x}" for a in r.randint(16**4, 16**6, SIZE // 7 + 1)).translate(letters).split()


class Plain:
    """Restores nothing: the search is not what is measured here."""

    def restore(self, word):
        return word


def peak(f):
    tracemalloc.start()
    out = f()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


def test_memory_beside_the_text(words):
    column = pa.array([" ".join(words)])
    size = len(column[0].as_py())
    assert size > 0.9 * SIZE
    for f, times in (
        (lambda: simhash.fingerprint_texts(column), 7),
        (lambda: sum(len(x[6]) for x in _grouped(column, Words())), 4),
        (lambda: sum(len(x[6]) for x in _grouped(column, Bytes())), 4),
        (lambda: toxicity.letter_counts(column), 4),
        (lambda: sum(len(x[3]) for x in toxicity._counted(column, Plain())), 9),
        (lambda: rules.counts(column), 20),
        (lambda: quality.features(column), 24),
        (lambda: similar.shingle_sets(column), 9),
    ):
        _, most = peak(f)
        assert most < times * size, (most / size, times)


def test_segments_cover_each_run_once(words):
    raw = np.frombuffer(("  " + " \n".join(words[:5000]) + " \t" + "x" * 3000 + " y").encode(), np.uint8)
    whole = raw.tobytes().split()
    for overlap, limit in ((0, 100), (2, 64), (49, 300), (49, 10**6)):
        seen = []
        for part, base in wt.word_segments(raw, overlap, limit):
            own = part.tobytes().split()
            assert own == whole[base : base + len(own)]
            seen += range(base, base + max(0, len(own) - overlap))
        assert seen == list(range(len(whole) - overlap))


def test_long_word_has_one_name():
    raw = np.frombuffer(b"ab" * (3 << 20) + b" " + b"ab" * (3 << 20), np.uint8)
    starts, ends, _ = wt.word_bounds(raw, np.array([0, len(raw)]))
    a, b = wt.slice_names(raw, starts, ends)
    other = raw.copy()
    other[5 << 20] += 1
    assert a == b != wt.slice_names(other, starts, ends)[0]


def test_results(spark, words):
    text, k = " ".join(words), len(words) // 2
    middle = " ".join(words[k : k + 120])
    docs = spark.createDataFrame([(1, text, "s"), (2, "own " + middle + " end", "s")], "doc_id long, text string, source string").repartition(2)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: tuple(r) for r in substring_dedup(docs).collect()}
    assert got[1] == (1, len(words), 0, sha(text.encode())) and got[2] == (2, 122, 120, sha(b"own end"))
    got = {r.doc_id: tuple(r) for r in suffix_array_dedup(docs).collect()}
    cut, at = f" {middle} ", text.index(f" {middle} ")
    assert got[2] == (2, len(middle) + 8, len(cut), 1, sha(b"ownend"))
    assert got[1] == (1, len(text), len(cut), 1, sha((text[:at] + text[at + len(cut) :]).encode()))
    got = {r.doc_id: r.fingerprint for r in simhash_components(docs).collect()}
    h = np.fromiter((xxhash.xxh64_intdigest(f"{a} {b} {c}", 42) for a, b, c in zip(words, words[1:], words[2:], strict=False)), np.uint64)
    bits = [2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h) for b in range(64)]
    assert got[1] == f"{sum(1 << i for i, b in enumerate(bits) if b):016x}"
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert (got[1].n_words, got[1].word_chars, got[1].n_dup_lines) == (len(words), len(text) - len(words) + 1, 0) and got[2].n_words == 122
