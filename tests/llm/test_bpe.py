import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plumbline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    r = random.Random(0)
    out = ["", "a", "\n\n  x ", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "é" * 300, "a" * 1000, "ab" * 700, " " * 500, "-" * 777, "\x1c\x1d a\x85b c", "'s't're I'll", "12345678 ½²", "\U0001f600" * 80, "ÃÂ" * 200]
    out += ["".join(r.choice("abcdefgh -=_.'\n éÃÂ日0") for _ in range(r.randrange(1, 2000))) for _ in range(25)]
    out += ["".join(r.choice("aeioutrnsl") for _ in range(r.randrange(50, 4000))) for _ in range(10)]
    return out + ["".join(chr(r.randrange(1, 0x3000)) for _ in range(300)) for _ in range(10)]


def test_queries_rows_like_the_library(spark, library, monkeypatch):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None])], "doc_id long, text string, n_tokens string")
    rows = {r.doc_id: r for r in bpe.encode(docs, PATH).collect()}
    for i, t in enumerate([*texts, ""]):
        ids = library.encode(t, add_special_tokens=False).ids
        assert rows[i].ids == ids and rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert back == dict(enumerate([*texts, ""]))
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_small_windows_give_the_same(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 50)
    texts = odd_texts()
    got = bpe._rows(bpe.Encoder(vocabulary), vocabulary, texts, True)
    assert [g[3].tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_transducer_is_stable(vocabulary):
    r = random.Random(7)
    for alphabet in ("ab", "-=", " ", "ÃÂ", "etaoin"):
        b = "".join(r.choice(alphabet) for _ in range(5000)).encode()
        assert list(vocabulary.stream(b[k : k + 97] for k in range(0, len(b), 97))) == vocabulary.merge_one(b)


def test_decoder_replaces_what_is_no_text(vocabulary, library):
    ids = [x for x in range(100, 400)] + [0, 5]
    d = bpe.Decoder(vocabulary)
    text = "".join(d.feed(np.array([i])) for i in ids) + d.feed(np.zeros(0, np.int64), True)
    assert text == library.decode(ids, skip_special_tokens=False)


def test_runs_longer_than_windows(vocabulary, library, monkeypatch):
    r = random.Random(3)
    run = "".join(r.choice("aeioutrnsl") for _ in range(1000))
    texts = [run, "x, " + run + "'s 12", " " + run + "9" * 700 + "<|endoftext|>" + "é" * 600 + "  ", "--" * 400 + "<|endoftext|>" + "=" * 900 + "\n\na", run + "<|endoftext|>" * 3 + run]
    monkeypatch.setattr(bpe, "WINDOW", 50)
    encoder = bpe.Encoder(vocabulary)
    assert any(isinstance(p, bpe.Run) for p in encoder.windows(run))
    got = bpe._rows(encoder, vocabulary, texts, True)
    assert [g[3].tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_twenty_megabytes_without_white_space(vocabulary):
    import tracemalloc

    text = "abcde,fghij" * 1_600_000 + "k" * 3_000_000
    tracemalloc.start()
    n = sum(len(ids) for p in bpe.Encoder(vocabulary).windows(text) if isinstance(p, bpe.Run) for ids in p.ids(vocabulary))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < n < 3_000_000 and peak < len(text)


def test_other_settings_are_refused():
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}, {"model": spec["model"] | {"ignore_merges": True}}):
        with pytest.raises(ValueError):
            bpe.Vocabulary(json.dumps(spec | change))
