import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm import quality as q


def corpus():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9)))
    docs, labels = [], []
    for i in range(800):
        w, bad = [word() for _ in range(r.randrange(10, 150))], i % 4
        if bad == 0:
            kind = r.randrange(3)
            w = [x.upper() + "!!" for x in w] if kind == 0 else [x + "***" for x in w] if kind == 1 else [x for x in w[:20] for _ in range(8)]
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad != 0)))
    return docs, labels


def test_held_out_accuracy_and_odd_texts(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*x, 1) for x in docs] + [(900, None, 1), (901, "", 1), (902, "x\n" * 300000, 1), (None, "a b", 1)], "doc_id long, text string, y int")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model = q.train(d, lab, ~held)
    got = {r.doc_id: r.score for r in q.score(d, model).collect()}
    assert len(got) == 804 and all(0 <= s <= 1 for s in got.values())
    out = {r.doc_id for r in d.where(held).select("doc_id").collect()}
    own = [(got[i] >= 0.7) == y for i, y in labels if i in out]
    assert len(own) > 100 and np.mean(own) > 0.97
    assert q.score(d.limit(0), model).count() == 0
    none = q.train(d, lab.limit(0), ~held)
    assert none.scores(q.features(pa.array(["x"]))) == [0.5]


def test_pairs_learn_an_interaction():
    r = np.random.RandomState(0)
    x = r.rand(3000, 3)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = q.Additive(x, y)
    assert np.mean((m.scores(x) > 0.5) == y) > 0.95
    assert {m.pairs[0][0], m.pairs[0][1]} == {0, 1}


def test_features_of_each_text_alone():
    texts = ["a a a b", None, "", "X!! Y!!", "l1\nl1\n| x", "é" * 10]
    alone = np.concatenate([q.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(q.features(pa.array(texts)), alone)


def test_features_by_their_definitions():
    import math
    import re

    def plain(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n, size, letters = max(len(w), 1), max(len(t.encode()), 1), max(sum(c.isascii() and c.isalpha() or not c.isascii() for c in t), 1)
        runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        lines = t.split("\n")
        full = [x + "\n" * (i < len(lines) - 1) for i, x in enumerate(lines)]  # a line ends with its break
        full = full[:-1] if not full[-1] else full
        return [
            math.log1p(len(w)), sum(map(len, w)) / n, sum("A" <= c <= "Z" for c in t) / letters, sum(c in "#*$%&|<>" for c in t) / size, sum("0" <= c <= "9" for c in t) / size,
            sum(x[-1] in ".!?,;:" for x in w) / n, sum(a == b for a, b in zip(w, w[1:], strict=False)) / n, (len(runs) - len(set(runs))) / n, (len(full) - len(set(full))) / (t.count("\n") + 1),
            1 - (len(w) - len(set(w))) / n, math.log1p(len(w) / (t.count("\n") + 1)), sum(x in "#*$%&|<>" for x in w) / n, t.count("!") / n,
        ]

    r = random.Random(1)
    texts = ["", None, "one", "A b A b A b!", "x\nx\ny\n", "# | 12 é", "a\n\n\na"] + ["".join(r.choice(["ab", "Cd", "é", "#", "9", "!", "."]) + r.choice(["", " ", "\n", "\t"]) for _ in range(r.randrange(300))) for _ in range(60)]
    assert np.allclose(q.features(pa.array(texts, pa.string())), np.array([plain(t) for t in texts]))
