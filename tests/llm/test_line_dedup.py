import random

import xxhash

from pyspark.sql import functions as F

from plumbline.llm.columns import WORD
from plumbline.llm.line_dedup import chunks, line_dedup


def cut(text):
    """The chunker by its definition: a line with the least of three neighbouring hashes ends a chunk, never the first or the last but one."""
    lines = text.split("\n")
    h = [(xxhash.xxh64_intdigest(x, 42) + 2**63) % 2**64 for x in lines]
    stops = [i for i in range(2, len(lines) - 1) if h[i - 1] < h[i - 2] and h[i - 1] < h[i]] + [len(lines)]
    return [lines[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def agreeing(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def brute(rows):
    """Rows (id, text) -> {id: (text, chunks removed, lines removed)}; ids are unique."""
    parts = {i: cut(t or "") for i, t in rows}
    first, drop = {}, {}
    for i, cs in sorted(parts.items()):
        for k, c in enumerate(cs):
            if len(c) >= 2 and "\n".join(c).split():
                at = first.setdefault(tuple(c), (i, k))
                if at != (i, k):
                    drop[i, k] = at
    out = {}
    for i, t in rows:
        left = []
        for k, c in enumerate(parts[i]):
            if (i, k) in drop:
                continue
            head = tail = 0
            if (i, k - 1) in drop:
                d, j = drop[i, k - 1]
                head = agreeing(c, parts[d][j + 1]) if j + 1 < len(parts[d]) else 0
            if (i, k + 1) in drop:
                d, j = drop[i, k + 1]
                tail = agreeing(c[::-1], parts[d][j - 1][::-1]) if j else 0
            left += c[head : max(head, len(c) - tail)]
        n = sum((i, k) in drop for k in range(len(parts[i])))
        out[i] = ("\n".join(left) if t is not None else None, n, len((t or "").split("\n")) - len(left) if n else 0)
    return out


def corpus():
    r = random.Random(5)
    line = lambda: " ".join(r.choice("abcdefgh") * 3 for _ in range(4))
    shared = [line() for _ in range(30)]
    rows = []
    for i in range(40):
        own = [line() for _ in range(r.randrange(8))]
        at = r.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (shared if i % 3 else []) + own[at:])))
    return rows + [(50, None), (51, ""), (52, "\n\n\n\n\n\n"), (53, "\n\n\n\n\n\n"), (54, "x"), (55, "x"), (56, rows[4][1])]


def test_like_brute_force_and_shift_resistant(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("h", "at", "_id", "_drop", "_new", "first", "n_lines_removed", "id", "row"):  # any names are allowed
        docs = docs.withColumn(c, F.lit(c))
    parts = docs.select("text", chunks(F.col("text")).alias("c")).collect()
    assert all([x["body"].split("\n") for x in p.c] == cut(p.text or "") for p in parts)
    found = line_dedup(docs).collect()
    got = {r.doc_id: (r.text, r.n_chunks_removed, r.n_lines_removed) for r in found}
    assert got == brute(rows)
    assert all(r._drop == "_drop" and r.at == "at" and r._new == "_new" for r in found)
    # of 30 shared lines at shifting places nearly all go
    assert sum(g[2] for g in got.values()) > 0.95 * 30 * 25


def test_recall_of_planted_passages(spark):
    r = random.Random(11)
    line = lambda: " ".join(r.choice("abcdefgh") * r.randrange(1, 9) for _ in range(6))
    found = {}
    for n in (4, 6, 8, 12):
        rows, passages = [], [[line() for _ in range(n)] for _ in range(40)]
        for i in range(120):
            own = [line() for _ in range(12)]
            at = r.randrange(13)
            rows.append((i, "\n".join(own[:at] + passages[i % 40] + own[at:])))
        found[n] = sum(x[2] for x in brute(rows).values()) / (80 * n)
        assert sum(x[2] for x in brute(rows).values()) <= 80 * n  # the first occurrence and own lines stay
    assert found[4] > 0.2 and found[6] > 0.6 and found[8] > 0.8 and found[12] > 0.93, found


def test_null_and_repeated_ids(spark):
    text = "\n".join(f"line {i} of it" for i in range(9))
    rows = [(1, text), (1, text), (1, "own\n" + text), (None, text), (None, None), (2, text + "\nend")]
    got = sorted(((str(x.doc_id), x.n_lines_removed, x.text) for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert len(got) == 6 and ("None", 0, None) in got and ("None", 0, text) in got
    assert [n for i, n, _ in got if i == "1"].count(9) >= 2
    assert all(t.endswith("end") and n >= 6 for i, n, t in got if i == "2")


def test_long_text_and_empty_table(spark):
    text = "\n".join(f"line {i}" for i in range(20000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + "\nend")], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert got[1].text == text and len(got[2].text) < 0.4 * len(text) and got[3].text.endswith("end")
    assert line_dedup(docs.limit(0)).count() == 0
    assert WORD


def test_exact_copies_go_whole(spark):
    r = random.Random(8)
    texts = ["\n".join(f"{r.randrange(10**6)} of {r.randrange(10**6)}" for _ in range(n)) for n in range(2, 42)]
    docs = spark.createDataFrame([(i + 100 * k, t) for k in range(2) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.text for x in line_dedup(docs).collect()}
    assert all(got[i] == t and got[i + 100] == "" for i, t in enumerate(texts))
    sizes = [c["lines"] for x in docs.select(chunks(F.col("text")).alias("c")).collect() for c in x.c]
    assert min(sizes) == 2 and sum(sizes) < 4 * len(sizes)
