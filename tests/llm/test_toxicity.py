import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import toxicity as tx

BAD = ["idiot", "moron", "worthless", "scum"]


def corpus():
    r = random.Random(4)
    syllable = ["ta", "ren", "of", "the", "an", "ing", "er", "is", "on", "ed"]
    word = lambda: "".join(r.choice(syllable) for _ in range(r.randrange(1, 4)))
    docs, labels = [], []
    for i in range(600):
        w, toxic = [word() for _ in range(r.randrange(20, 120))], int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(BAD))
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, y int")
    return tx.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def test_held_out_and_disguised(spark, model):
    docs, labels = corpus()
    extra = [(1000, "the ren 1d10t of aned"), (1001, "an er is i d i o t oned"), (1002, "tataren m.o.r.o.n the"), (1003, "ing wooorthleeess on on"), (1004, None), (1005, ""), (1006, "of ed er " * 50000), (None, "the $cum of")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string")
    got = {r.doc_id: r.score for r in tx.score(df, model).collect()}
    assert len(got) == len(docs) + len(extra)
    assert sum((got[i] >= 0.5) == y for i, y in labels) >= 0.98 * len(labels)
    assert all(got[i] >= 0.5 for i in (1000, 1001, 1002, 1003, None))
    assert all(got[i] < 0.5 for i in (1004, 1005, 1006))
    assert set(BAD) <= set(model.lexicon)
    assert tx.score(df.limit(0), model).count() == 0


def test_viterbi_like_brute_force(model):
    restorer = tx.Restorer(model.letters, model.lexicon)

    def value(word, choice):
        total, out, before = 0.0, [0, 0], ""
        text = ""
        for ch, pick in zip(word, choice, strict=True):
            s = int(tx.SYMBOL[ord(ch)])
            options = [(ch, 0.0), ("", tx.REPEAT_COST if ch == before else None)] if s else [*((x, tx.LOOK_COST) for x in tx.LOOKS.get(ch, "")), ("", tx.SEPARATOR_COST if ch not in tx.LOOKS else tx.REPEAT_COST if ch == before else tx.NOTHING_COST)]
            before = ch
            if pick >= len(options) or options[pick][1] is None:
                return None
            letter, cost = options[pick]
            total -= cost
            if letter:
                total += restorer.logp[out[-2]][out[-1]][ord(letter) - 96]
                out.append(ord(letter) - 96)
                text += letter
        return total + restorer.logp[out[-2]][out[-1]][0], text

    for word in ("1d10t", "m00r", "a.b", "$cuu", "i1i1"):
        paths = [v for c in product(range(3), repeat=len(word)) if (v := value(word, c))]
        own = max(v for v, text in paths if text == restorer.restore(word))
        assert own == pytest.approx(max(paths)[0], abs=1e-9)  # ties may go either way


def test_pieces_and_no_labels(spark):
    data = np.frombuffer("scum héllo".encode(), np.uint8)
    piece, text = tx.pieces(data, np.array([0, 0, 4, len(data)]))
    assert np.bincount(text, minlength=3).tolist() == [0, 1, 4]
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    m = tx.train(docs, none, F.lit(True))
    assert 0 <= m.scores(pa.array(["x", None]), tx.Restorer(m.letters))[0] <= 1
