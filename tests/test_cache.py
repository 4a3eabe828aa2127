"""Caches, journals, event logs, exclusive outputs and staged runs."""

import hashlib
import json
import os
import sys

import pytest
from pyspark.sql import functions as F

from plumbline.functions.text import contained, resolved
from plumbline.operators import cache, gallery
from plumbline.plans.staged import run_stages
from plumbline.sources import files as src
from plumbline.sources.hadoop import Store

RECORD = "ordinal int, id string, split string, `group` string, image_sha256 string, feature_file string, feature_sha256 string"
ROWS = [(0, "a", "train", "g1", "i1", "a.bin", "A"), (1, "b", "validation", "g2", "i2", "sub/../b.bin", "B"), (2, "c", "validation", "g3", None, "c.bin", "C"), (3, "d", "test", "g4", "i4", "d.bin", "D")]
DONE = {"status": "complete", "source_counts": {"train": 1}, "selected_counts": {"train": 1}}


def records(spark, change=lambda r: r):
    return spark.createDataFrame([change(r) for r in ROWS], RECORD)


def test_fingerprint_is_that_of_the_whole_specification(spark):
    spec = {"model_id": "m/é", "revision": "r", "config": {"b": 1, "a": [True, None]}, "data_sha256": {"train": "1"}}
    df = spark.createDataFrame([(3, "c"), (1, 'a"'), (2, "é")], "n int, id string")
    want = hashlib.sha256(json.dumps(spec | {"selected_ids": ['a"', "é", "c"]}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert cache.cache_fingerprint(**spec, selected=df, key="id", order=["n"]) == want
    none = hashlib.sha256(json.dumps(spec | {"selected_ids": []}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert cache.cache_fingerprint(**spec, selected=df.limit(0), key="id", order=["n"]) == none


def test_admission(spark):
    files = spark.createDataFrame([("/c/a.bin", "A"), ("/c/b.bin", "B"), ("/c/c.bin", "C")], "path string, sha256 string")
    training, validation = cache.admit(DONE, records(spark), files, "/c", whole_epochs=True)
    assert [r.id for r in training.collect()] == ["a"] and sorted(r.id for r in validation.collect()) == ["b", "c"]
    assert [r.id for r in cache.admit(DONE, records(spark), validation_limit=1)[1].collect()] == ["b"]
    part = DONE | {"source_counts": {"train": 2}}
    cache.admit(part, records(spark))
    refused = [
        ("no completed", DONE, lambda r: None, {}),
        ("not complete", DONE | {"status": "building"}, lambda r: r, {}),
        ("not complete", DONE | {"selected_complete": False}, lambda r: r, {}),
        ("whole training", part, lambda r: r, {"whole_epochs": True}),
        ("whole training", {"status": "partial"}, lambda r: r, {"whole_epochs": True}),
        ("both needed", DONE, lambda r: (*r[:2], "train", *r[3:]), {}),
        ("share", DONE, lambda r: (*r[:3], "g1", *r[4:]), {}),
        ("share", DONE, lambda r: (*r[:4], "i1" if r[1] in "ad" else r[4], *r[5:]), {}),
        ("repeat", DONE, lambda r: (r[0], "x", *r[2:]), {}),
        ("missing_or_changed_feature: a", DONE, lambda r: (*r[:6], "Z") if r[1] == "a" else r, {"files": files, "root": "/c"}),
        ("feature_path_outside_cache: b", DONE, lambda r: (*r[:5], "../b.bin", r[6]) if r[1] == "b" else r, {"files": files, "root": "/c"}),
    ]
    for words, manifest, change, more in refused:
        rows = records(spark, change) if change(ROWS[0]) else records(spark).limit(0)
        with pytest.raises(ValueError, match=words):
            cache.admit(manifest, rows, **more)


def test_adapter_settings():
    wanted = {"model_id": "m", "cache_config": {"prefix": "p", "resolution": 512}}
    keys = ("model_id", "cache_config.prefix", "cache_config.resolution")
    assert cache.adapter_issues(wanted, wanted, keys) == []
    assert cache.adapter_issues({"model_id": "m", "cache_config": {"prefix": "q"}}, wanted, keys) == list(keys[1:])


def test_parameters():
    assert cache.parameter_issues({"rank": 8, "epochs": None, "rate": 1e-4, "warmup": 0}, ("rank", "epochs", "rate", "steps"), ("warmup",)) == []
    assert cache.parameter_issues({"rank": 0, "rate": float("nan"), "warmup": -1}, ("rank", "rate"), ("warmup",)) == ["rank must be positive", "rate must be positive", "warmup must not be negative"]
    fine = {"resolution": 512, "workers": 32, "seed": 0, "seeds": [17, 2**63 - 1], "ratios": (0.1, 0.1)}
    assert cache.parameter_issues(fine) == [] and cache.parameter_issues(dict.fromkeys(fine)) == []
    for bad in ({"resolution": 500}, {"resolution": 0}, {"workers": 33}, {"workers": 0}, {"seed": -1}, {"seed": 2**63}, {"seeds": [1, 1]}, {"seeds": []}, {"seeds": [1, 2.5]}, {"ratios": (0.5, 0.5)}, {"ratios": (-0.1, 0.2)}, {"ratios": (float("nan"),)}):
        assert len(cache.parameter_issues(fine | bad)) == 1, bad


def test_captions_of_prepared_splits(spark, tmp_path):
    for name, caption in (("train", "fine"), ("validation", "fine"), ("test", "한")):
        with open(f"{tmp_path}/{name}.jsonl", "w", encoding="utf-8") as f:
            f.write(json.dumps({"caption": caption, "split": name}) + "\n")
    assert src.read_splits(spark, str(tmp_path), "caption string, split string", check=True).count() == 3
    with pytest.raises(Exception, match="may not be cached"):
        src.read_splits(spark, str(tmp_path), "caption string, split string", screen=True).select("caption").collect()


def test_resolved_paths(spark):
    df = spark.createDataFrame([("/a/b/../c",), ("/a//./b/",), ("/../x",), ("/a/../../b",)], "p string")
    assert [r[0] for r in df.select(resolved(F.col("p"))).collect()] == ["/a/c", "/a/b", "/x", "/b"]
    inside = df.select(contained(F.col("p"), F.lit("/a")).alias("x")).collect()
    assert [r.x for r in inside] == [True, True, False, False]


def test_torn_journals(tmp_path):
    path, backup = f"{tmp_path}/journal.jsonl", f"{tmp_path}/journal.interrupted.jsonl"
    whole = '{"id": "a"}\n{"id": "é"}\n'.encode()
    for torn in (b'{"id": "b', '{"id": "é'.encode()[:-1]):
        with open(path, "wb") as f:
            f.write(whole + torn)
        assert src.recover_journal(path) is True
        with open(path, "rb") as f:
            assert f.read() == whole
    with open(backup, "rb") as f:
        assert f.read() == whole + b'{"id": "b'  # the first one stays
    assert src.recover_journal(path) is False
    middle = b'{"id": "a"}\n{"id\n{"id": "c"}\n'
    with open(path, "wb") as f:
        f.write(middle)
    with pytest.raises(ValueError, match="line 2"):
        src.recover_journal(path)
    with open(path, "rb") as f:
        assert f.read() == middle


def test_outputs(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k int, v string").repartition(7)
    src.write_exclusive(rows, f"{tmp_path}/m.jsonl", {"rows": 50}, "k")
    with open(f"{tmp_path}/m.jsonl") as f:
        assert [json.loads(x)["k"] for x in f] == list(range(50))
    assert sorted(os.listdir(tmp_path)) == ["m.jsonl", "m.jsonl.report.json"]
    with pytest.raises(FileExistsError):
        src.write_exclusive(rows, f"{tmp_path}/m.jsonl", {}, "k")
    parts = rows.withColumn("split", F.when(F.col("k") < 30, "train").otherwise("test"))
    src.write_splits(parts, f"{tmp_path}/s", {"complete": True}, "k")
    with open(f"{tmp_path}/s/train.jsonl") as f:
        assert [json.loads(x)["k"] for x in f] == list(range(30))
    assert sorted(os.listdir(f"{tmp_path}/s")) == ["report.json", "test.jsonl", "train.jsonl", "validation.jsonl"] and os.path.getsize(f"{tmp_path}/s/validation.jsonl") == 0
    src.write_with_pointer(f"{tmp_path}/c", {"records": [{"id": "a"}]}, f"{tmp_path}/latest.json")
    assert src.resolve_cache(spark, f"{tmp_path}/latest.json").count() == 1


def test_sinks_of_any_file_system(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.sinks.link./t", f"file://{tmp_path}")
    base = "viewfs://sinks/t"
    rows = spark.createDataFrame([(i, f"v{i}", ["train", "test"][i % 2]) for i in range(40)], "k int, v string, split string").repartition(5)
    keys = lambda path: [r.k for r in spark.read.json(path).orderBy("k").collect()]
    for parts in (False, True):
        out = f"{base}/out{parts}"
        src.write_splits(rows, out, {"n": 40}, "k", parts=parts)
        assert keys(f"{out}/train.jsonl") == list(range(0, 40, 2)) and json.loads(Store(spark).read(f"{out}/report.json")) == {"n": 40}
        with pytest.raises(FileExistsError):
            src.write_splits(rows, out, {}, "k", parts=parts)
        src.write_splits(rows.where("k < 10"), out, {"n": 10}, "k", overwrite=True, parts=parts)
        assert keys(f"{out}/test.jsonl") == [1, 3, 5, 7, 9]
    with open(f"{tmp_path}/outFalse/train.jsonl") as f:
        assert [json.loads(x)["k"] for x in f] == [0, 2, 4, 6, 8]
    assert src.write_issues(f"{base}/outFalse", rows, ["k"], "all.jsonl") == "all.jsonl" and keys(f"{base}/outFalse/all.jsonl") == list(range(40))
    src.write_exclusive(rows, f"{base}/m.jsonl", {"rows": 40}, "k")
    assert keys(f"{base}/m.jsonl") == list(range(40))
    with pytest.raises(FileExistsError):
        src.write_exclusive(rows, f"{base}/m.jsonl", {}, "k")
    Store(spark).make(f"{base}/c")
    src.write_with_pointer(f"{base}/c", {"records": [{"id": "a"}]}, f"{base}/latest.json")
    assert src.resolve_cache(spark, f"{base}/latest.json").count() == 1
    src.write_status(f"{base}/c", 1, 2)
    assert "running" in Store(spark).read(f"{base}/c/status.json")
    for output, inputs in ((f"{base}/c/x", [f"{base}/c"]), (base, [f"{base}/c"]), (f"{base}/c/../c", [f"{base}/c"])):
        with pytest.raises(ValueError):
            src.protect(output, inputs, spark=spark)
    with pytest.raises(FileExistsError):
        src.protect(f"{base}/m.jsonl", [f"{base}/c"], spark=spark)
    src.protect(f"{base}/new", [f"{base}/c"], spark=spark)
    assert not [x for x in os.listdir(tmp_path) if "staging" in x]


def test_a_run_that_ends_early_leaves_no_output(spark, tmp_path):
    bad = spark.createDataFrame([(1, "train"), (2, "test")], "k int, split string").withColumn("v", F.when(F.col("split") == "test", F.raise_error(F.lit("no"))).otherwise("x"))
    with pytest.raises(Exception, match="no"):
        src.write_splits(bad, f"{tmp_path}/out", {}, "k")
    assert os.listdir(tmp_path) == []
    fine = bad.withColumn("v", F.lit("x"))
    src.write_splits(fine, f"{tmp_path}/out", {"n": 2}, "k")
    with pytest.raises(Exception, match="no"):
        src.write_splits(bad, f"{tmp_path}/out", {}, "k", overwrite=True)
    assert "report.json" in os.listdir(f"{tmp_path}/out")  # what was there stays


def test_event_log_and_status(tmp_path):
    src.append_event(f"{tmp_path}/e.jsonl", event="a", loss=0.5)
    with pytest.raises(ValueError):
        src.append_event(f"{tmp_path}/e.jsonl", loss=float("nan"))
    with open(f"{tmp_path}/e.jsonl") as f:
        assert [json.loads(x)["event"] for x in f] == ["a"]
    for args, name, key in (((1, 2), "status.json", "running"), ((2, 2), "status.json", "complete"), ((1, 2, KeyError("k")), "failure.json", "KeyError")):
        src.write_status(str(tmp_path), *args)
        with open(f"{tmp_path}/{name}") as f:
            assert key in json.load(f).values()


def test_prompts(spark):
    prompts = spark.createDataFrame([("b", "Two words"), ("a", "<One>"), ("c", "a b c d e")], "id string, imageCaption string")
    got = sorted(tuple(r) for r in gallery.prompt_audit(prompts, "In: ", "imageCaption", "id", 7, 5).collect())
    assert got == [("a", "<One>", "In: <One>", 2, 7, None), ("b", "Two words", "In: Two words", 3, 8, None), ("c", "a b c d e", "In: a b c d e", 6, 9, "prompt_too_long")]
    lines = gallery.prompt_gallery(prompts.withColumn("image", F.concat("id", F.lit(".png"))), "imageCaption", "image", "id").orderBy("id").collect()
    assert lines[0].html == '<p>&lt;One&gt;</p><img loading="lazy" src="a.png">'


def test_staged_runs(tmp_path):
    ok, bad = [sys.executable, "-c", "print('fine')"], [sys.executable, "-c", "raise SystemExit(3)"]
    assert run_stages([ok], f"{tmp_path}/dry", dry_run=True)["stages"] == 1 and not os.path.exists(f"{tmp_path}/dry")
    assert run_stages([ok, ok], f"{tmp_path}/good")["passed"] is True
    verdict = run_stages([ok, bad, ok], f"{tmp_path}/bad")
    assert verdict["passed"] is False and verdict["failed_log"] == "stage_2.log" and [s["exit_code"] for s in verdict["stages"]] == [0, 3]
    assert sorted(os.listdir(f"{tmp_path}/bad")) == ["plan.json", "stage_1.log", "stage_2.log", "validation.json"]
    with pytest.raises(FileExistsError):
        run_stages([ok], f"{tmp_path}/good")
