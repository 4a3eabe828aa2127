"""Numbered lines of files in one block and in many."""

import hashlib
import random
import re

import pytest

from plumbline.sources import files as src
from plumbline.sources import lines


def by_definition(data):
    text = re.sub("^﻿", "", data.decode())
    return [(i, x) for i, x in enumerate(re.split("\r\n|\n|\r", text), 1) if x.strip(" ")]


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def files_of(folder):
    r = random.Random(1)
    for i, end in enumerate(["\n", "\r\n", "\n", "\r"]):
        body = ("﻿" if i % 2 else "") + "".join(r.choice(["", " ", "é" * r.randrange(40), f"line {k}", "x" * r.randrange(700)]) + end for k in range(r.randrange(20, 120)))
        (folder / f"a b+{i}%20.txt").write_bytes((body + "the last" * (i > 1)).encode())
    (folder / "empty.txt").write_bytes(b"")
    (folder / "blank.txt").write_bytes(b"\n\n \n")
    return {f"file:{f}": f.read_bytes() for f in folder.iterdir()}


@pytest.mark.parametrize("whole", [1 << 30, 100])
def test_numbers_follow_the_file_however_it_is_cut(spark, tmp_path, small_blocks, monkeypatch, whole):
    monkeypatch.setattr(lines, "WHOLE", whole)
    want = {(p, hashlib.sha256(d).hexdigest(), *x) for p, d in files_of(tmp_path).items() for x in by_definition(d)}
    rows = src.read_lines(spark, str(tmp_path))
    got = [tuple(r) for r in rows.collect()]
    assert set(got) == want and len(got) == len(want)
    one = sorted(tmp_path.iterdir())[0]
    assert spark.read.text(str(one)).rdd.getNumPartitions() > 3  # the files were cut


def test_json_lines_and_their_faults(spark, tmp_path, small_blocks):
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(f'{{"a": {i}, "s": "{"é" * (i % 50)}"}}' if i % 7 else "" for i in range(200)), encoding="utf-8")
    rows = src.read_jsonl(spark, str(path), "a int, s string").collect()
    assert {(r.a, r._ordinal, len(r.s)) for r in rows} == {(i, i + 1, i % 50) for i in range(200) if i % 7}
    path.write_text(path.read_text() + "\n[1]\n")
    assert src.checked_jsonl(spark, str(path), "a int")[1].endswith(":201 is no valid object")
    path.write_bytes(b'{"a": 1}\n{"a": "\xff"}\n')
    assert src.checked_jsonl(spark, str(path), "a string")[0] is None
    assert src.checked_jsonl(spark, f"{tmp_path}/none", "a string")[0] is None
