"""The pipeline's stages, each against a brute-force version on its own input."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from test_line_dedup import brute as brute_lines
from test_similar import brute as brute_near
from test_toxicity import BAD
from tokenizers import Tokenizer

import corpus_pipeline as cp
from pyspark.sql import functions as F
from plumbline.llm.columns import WORD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(9)
    word = lambda: "".join(r.choice(["ta", "ren", "of", "the", "an", "ing", "er"]) for _ in range(r.randrange(1, 5)))
    line = lambda: " ".join(word() for _ in range(r.randrange(2, 9)))
    shared = [line() for _ in range(12)]
    docs, labels = [], []
    for i in range(240):
        lines = [line() for _ in range(r.randrange(1, 12))]
        if i % 5 == 0:
            lines[r.randrange(len(lines))] += " " + r.choice(BAD) + " " + r.choice(BAD)
        if i % 7 == 1:
            lines += shared
        docs.append((i, "\n".join(lines)))
        labels.append((i, 1, int(i % 5 == 0)))
    docs += [(300, docs[3][1]), (301, docs[3][1] + " x"), (302, None), (303, "")]
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", f"src{i % 4}" if i != 9 else None, len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outs = [docs]
    for _, stage in cp.STAGES:
        outs.append(cp.stash(stage(spark, outs[-1], folder), "test"))
    for x in outs[:5]:
        assert x.columns == docs.columns
    tables = [[tuple(r) for r in x.collect()] for x in outs]
    # toxic documents go, clean ones stay as they are; what the model says is tested with it
    clean = {x[0] for x in tables[0] if not any(b in (x[1] or "") for b in BAD)}
    kept = {x[0] for x in tables[1]}
    assert set(tables[1]) <= set(tables[0]) and len(kept ^ clean) <= 0.05 * len(tables[0])
    # repeated chunks of lines
    want = brute_lines([x[:2] for x in tables[1]])
    assert {x[0]: x[1] for x in tables[2]} == {i: t for i, (t, n, _) in want.items() if n == 0 or (t or "").split()}
    assert all(x[4] == len(x[1] or "") for x in tables[2])
    # one document of each component of near-duplicates
    assert sorted(x[0] for x in tables[3]) == brute_near([x[:2] for x in tables[2]])
    assert set(tables[3]) <= set(tables[2])
    # copies: none or up to twice, near each source's target
    n = Counter(x[0] for x in tables[4])
    assert set(tables[4]) <= set(tables[3]) and max(n.values()) <= 2
    total = sum(len((x[1] or "").split()) for x in tables[3])
    taken = sum(len((x[1] or "").split()) for x in tables[4])
    assert abs(taken - 1.5 * total) < 5 * max(len((x[1] or "").split()) for x in tables[3])
    # tokens
    library = Tokenizer.from_file(cp.tokenizer_path())
    own = sorted((x.doc_id, x.ids, x.ids_sha256, x.decoded_sha256) for x in outs[5].collect())
    want = []
    for i, t, *_ in tables[4]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert own == sorted(want)
    assert WORD


def test_columns_of_any_name(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("_id", "_source", "_copies", "node", "h", "score", "copies"):
        docs = docs.withColumn(c, F.lit(c))
    for _, stage in cp.STAGES[:-1]:
        docs = cp.stash(stage(spark, docs, folder), "test")
    row = docs.first()
    assert docs.count() > 100 and all(row[c] == c for c in docs.columns[5:])
    assert cp.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_rows_that_share_or_lack_an_id(spark, folder):
    whole = spark.read.parquet(f"{folder}/documents.parquet")
    bad, clean = whole.join(cp.drop_toxic(spark, whole, folder).select("doc_id"), "doc_id", "left_anti").first().text, "the ing of an er ta ren of the"
    rows = [(i, t, "en", "s", len(t)) for i in (None, 7) for t in (bad, clean)] + [(8, "", "en", "s", 0), (8, clean + " of", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(whole.where("doc_id > 20"))
    left = cp.drop_toxic(spark, docs, folder).where("doc_id is null or doc_id < 20")
    assert sorted(((r.doc_id or 0), r.text) for r in left.collect()) == [(0, clean), (7, clean), (8, ""), (8, clean + " of")]
    assert cp.mix_sources(spark, docs, folder).where("text = ''").count() == 0


def test_run_and_empty_table(spark, folder, tmp_path):
    assert cp.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
