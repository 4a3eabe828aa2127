"""Both preparation pipelines over generated files."""

import hashlib
import json
import os
import struct
import zlib

import numpy as np
import pytest

from plumbline.operators.gates import GateError
from plumbline.operators.stages import Stages
from plumbline.plans import prepare as pp
from plumbline.sources import files as src
from plumbline.sources import images as im


def png(rgb, colour=2, extra=b"", broken=False):
    a = np.asarray(rgb, np.uint8)
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    raw = b"".join(b"\0" + row.tobytes() for row in a)
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, colour, 0, 0, 0)) + extra + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    return data[:-20] if broken else data


def flat(colour, w=6, h=4):
    return np.full((h, w, 3), colour, np.uint8)


def pair(folder, stem, caption, colour, note=b""):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{stem}.jpg", "wb") as f:
        chunk = struct.pack(">I", len(note)) + b"tEXt" + note + struct.pack(">I", zlib.crc32(b"tEXt" + note)) if note else b""
        f.write(png(flat(colour), extra=chunk))
    with open(f"{folder}/{stem}.json", "w", encoding="utf-8") as f:
        f.write(caption if caption.startswith("{") else json.dumps({"imageCaption": caption}))


def jsonl(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def splits(folder):
    out = []
    for s in src.SPLITS:
        with open(f"{folder}/{s}.jsonl", encoding="utf-8") as f:
            out += [json.loads(x) | {"split": s} for x in f]
    return out


A, B, A13 = "0306406152", "080442957X", "9780306406157"


def test_pairs_keep_all_and_link(spark, tmp_path):
    d, out = f"{tmp_path}/pairs", f"{tmp_path}/out"
    pair(d, f"01_01T_01S_{A}_1", "a cat", 10)
    pair(d, f"01_01T_01S_{A}_2", "a cat", 10)  # same bytes
    pair(d, f"01_01T_01S_{B}_3", " a dog", 10, b"k\0v")  # same pixels in another book
    pair(d, f"01_01T_01S_{A13}_4", "a bird", 99)  # other colour, first book's other number
    pair(d, "01_01T_01S_9780804429573_5", "a fish", 55)
    report = pp.prepare_pairs(spark, d, out, expected=5)
    rows = splits(out)
    assert len(rows) == 5 and len({r["id"] for r in rows}) == 5
    assert len({r["group"] for r in rows}) == 1 and len({r["split"] for r in rows}) == 1
    assert {r["isbn"] for r in rows} == {A13, "9780804429573"}
    digest = hashlib.sha256(json.dumps([{k: r[k] for k in ("stem", "image_sha256", "pixel_sha256", "label_json_sha256", "caption_sha256")} for r in sorted(rows, key=lambda r: r["stem"])], sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    names = sorted(os.listdir(d), key=lambda n: (n.casefold(), n))
    own = next(r["split"] for r in rows)
    assert report == {
        "format_version": 1, "complete": True, "split_files_written": True, "pair_dir": d, "output_dir": out, "expected_pairs": 5, "source_manifest": None, "existing_split_dir": None,
        "seed": 20260915, "workers": spark.sparkContext.defaultParallelism, "max_image_pixels": im.USUAL_PIXELS, "issues": [], "issue_counts": {}, "policies": report["policies"], "warnings": report["warnings"],
        "counts": {
            "input_entries": 10, "image_files": 5, "json_files": 5, "exact_filename_pairs": 5, "valid_caption_rows": 5, "decoded_rows": 5, "kept_rows": 5, "excluded_rows": 0,
            "split_rows": {k: 5 * (k == own) for k in src.SPLITS}, "split_groups": {k: int(k == own) for k in src.SPLITS}, "canonical_book_isbns": 2, "identical_byte_groups": 1, "identical_pixel_groups": 1,
            "identical_pixel_extra_rows_retained": 2, "identical_pixel_groups_with_alternative_captions": 1, "identical_pixel_same_caption_extra_rows_retained": 1,
            "exif_transposed_images": 0, "alpha_composited_images": 0, "large_image_override_images": 0, "existing_split_conflicts": 0,
        },
        "existing_rows_indexed": {}, "inherited_split_rows": {}, "existing_split_conflicts": "existing_split_conflicts.jsonl",
        "split_leakage_checks": dict.fromkeys(("group", "isbn", "image_sha256", "pixel_sha256"), "passed"),
        "provenance": {"input_filenames_sha256": hashlib.sha256("\n".join(names).encode()).hexdigest(), "ordered_pair_content_sha256": digest},
        "semantic_translation_quality_verified": False, "caption_image_semantic_accuracy_verified": False,
    }
    assert report["policies"]["ratios"] == {"train": 0.8, "validation": 0.1, "test": 0.1} and len(report["warnings"]) == 4
    with open(f"{out}/report.json") as f:
        assert json.load(f) == report
    assert next(r for r in rows if r["stem"].endswith("_3"))["caption"] == " a dog"
    with pytest.raises(FileExistsError):
        pp.prepare_pairs(spark, d, out, expected=5)
    again = pp.prepare_pairs(spark, d, out, expected=5, overwrite=True)
    assert again == report
    with pytest.raises(ValueError):
        pp.prepare_pairs(spark, d, f"{d}/inside", expected=5)


def test_pairs_honour_earlier_splits(spark, tmp_path):
    d, out, old = f"{tmp_path}/pairs", f"{tmp_path}/out", f"{tmp_path}/old"
    pair(d, f"01_01T_01S_{A}_1", "a cat", 10)
    pair(d, f"01_01T_01S_{B}_2", "a dog", 20)
    jsonl(f"{tmp_path}/meta.jsonl", [{"image": f"C:\\x\\01_01T_01S_{A}_1.jpg", "isbn": A, "source_text": "once  upon", "caption": "ignored"}, {"image": f"/y/01_01T_01S_{B}_2.jpg", "source_text": "once upon"}])
    jsonl(f"{old}/train.jsonl", [{"isbn": A}])
    jsonl(f"{old}/validation.jsonl", [{"context": "once upon "}])
    jsonl(f"{old}/test.jsonl", [{"isbn": "978-0-8044-2957-3"}])
    report = pp.prepare_pairs(spark, d, out, earlier=old, metadata=f"{tmp_path}/meta.jsonl", expected=2)
    rows = splits(out)
    assert {r["split"] for r in rows} == {"test"} and len({r["group"] for r in rows}) == 1
    with open(f"{out}/{report['existing_split_conflicts']}") as f:
        assert [json.loads(x)["existing_splits"] for x in f] == [["test", "train", "validation"]] and report["counts"]["existing_split_conflicts"] == 1
    assert report["counts"]["kept_rows"] == 2 and report["counts"]["excluded_rows"] == 0 and report["existing_rows_indexed"] == {"train": 1, "validation": 1, "test": 1}
    assert set(report) >= {"policies", "warnings", "provenance", "split_leakage_checks"} and len(report["provenance"]["source_manifest_sha256"]) == 64
    jsonl(f"{tmp_path}/meta.jsonl", [{"image": f"01_01T_01S_{A}_1.jpg", "isbn": B}])
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/no", metadata=f"{tmp_path}/meta.jsonl", expected=2)
    assert e.value.counts == {"source_manifest_isbn_mismatch": 1, "source_manifest_missing_exact_stem": 1}


def test_a_run_goes_on_where_it_failed(spark, tmp_path, monkeypatch):
    d, work = f"{tmp_path}/pairs", f"{tmp_path}/work"
    for i in range(4):
        pair(d, f"01_01T_01S_{A}_{i}", f"a cat {'abcd'[i]}", 10 * i)
    seen, audit = [], pp.inspect_images
    monkeypatch.setattr(pp, "inspect_images", lambda *a, **k: seen.append(1) or audit(*a, **k))
    monkeypatch.setattr(pp, "_report", lambda done: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=4, work=work)
    monkeypatch.undo()
    made, table = [], Stages.table
    monkeypatch.setattr(Stages, "table", lambda self, df, name: (table(self, df, name), made.append((list(self.made), list(self.reused))))[0])
    report = pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=4, work=work)
    assert made[-1] == ([], ["rows", "audits", "prepared"]) and report["counts"]["kept_rows"] == 4
    plain = pp.prepare_pairs(spark, d, f"{tmp_path}/plain", expected=4)
    assert {k for k in report if report[k] != plain[k]} == {"output_dir"}
    with pytest.raises(ValueError, match="config.seed, config.test"):
        pp.prepare_pairs(spark, d, f"{tmp_path}/other", expected=4, work=work, seed=1, test=0.2)
    pair(d, f"01_01T_01S_{A}_9", "a cat z", 99)
    with pytest.raises(ValueError, match="revisions.pairs"):
        pp.prepare_pairs(spark, d, f"{tmp_path}/other", expected=4, work=work)


def test_a_stage_that_is_not_whole_is_made_again(spark, tmp_path):
    df = spark.range(20)
    run = lambda: Stages(spark, f"{tmp_path}/w", {"a": 1}, {"x": None})
    first = run()
    assert first.table(df, "s").count() == 20 and first.made == ["s"]
    again = run()
    assert again.table(df, "s").count() == 20 and again.reused == ["s"]
    path = next(p for p in (tmp_path / "w").iterdir() if p.is_dir())
    spark.range(3).write.mode("overwrite").parquet(str(path))  # parts of it are lost
    other = run()
    assert other.table(df, "s").count() == 20 and other.made == ["s"]
    (tmp_path / "w" / f"{path.name}.done.json").unlink()  # it was never finished
    other = run()
    assert other.table(df, "s").count() == 20 and other.made == ["s"]
    # what comes after another stage is another stage
    last = run()
    last.table(df, "t")
    last.table(df, "s")
    assert last.made == ["t", "s"]


def test_pair_gates(spark, tmp_path):
    d = f"{tmp_path}/pairs"
    for i, caption in enumerate(['{"imageCaption": "x", "more": 1}', '{"imageCaption": "x", "imageCaption": "y"}', "a 한글", "a 漢", "  ", '{"imageCaption": 5}', "Note: a", "[a"]):
        pair(d, f"01_01T_01S_{A}_{i}", caption, i)
    pair(d, "01_01T_01S_0306406153_9", "bad number", 9)
    pair(d, "nonsense", "bad name", 9)
    os.rename(f"{d}/nonsense.json", f"{d}/other.json")
    with open(f"{d}/extra.txt", "w") as f:
        f.write("x")
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=3)
    assert e.value.counts == {
        "invalid_caption_json": 3, "caption_contains_non_latin_script": 2, "caption_not_nonempty_string": 1, "caption_contains_translation_metadata": 1, "caption_contains_nested_structure": 1,
        "invalid_filename_or_isbn": 1, "missing_json": 1, "missing_image": 1, "unexpected_file": 1, "unexpected_pair_count": 1,
    }
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["issues.jsonl", "report.json"]
    with open(f"{tmp_path}/out/report.json") as f:
        report = json.load(f)
    assert report["complete"] is False and report["stage"] == "captions"
    with open(f"{tmp_path}/out/{report['issues']}") as f:
        assert sum(1 for _ in f) == sum(report["issue_counts"].values())


def test_entries_that_are_no_pairs(spark, tmp_path):
    d = f"{tmp_path}/pairs"
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/a", expected=1)
    assert e.value.counts == {"missing_pair_directory": 1}
    pair(d, f"01_01T_01S_{A}_1", "a cat", 1)
    os.makedirs(f"{d}/sub/inner")
    with open(f"{d}/.hidden.json", "w") as f:
        f.write("{}")
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/b", expected=1)
    assert e.value.counts == {"non_file_entry": 1, "missing_image": 1, "unexpected_pair_count": 1}
    os.remove(f"{d}/.hidden.json")
    os.rmdir(f"{d}/sub/inner")
    os.rmdir(f"{d}/sub")
    with open(f"{d}/01_01T_01S_{A}_1.jpg", "w"):
        pass
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/c", expected=1)
    assert e.value.counts == {"image_decode_or_integrity_error": 1}
    with open(f"{d}/01_01T_01S_{A}_1.json", "w"):
        pass
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/e", expected=1)
    assert e.value.counts == {"invalid_caption_json": 1}


def test_bad_metadata_and_earlier_splits(spark, tmp_path):
    d, old, meta = f"{tmp_path}/pairs", f"{tmp_path}/old", f"{tmp_path}/meta.jsonl"
    pair(d, f"01_01T_01S_{A}_1", "a cat", 1)
    pair(d, f"01_01T_01S_{B}_2", "a dog", 2)

    def counts(**more):
        with pytest.raises(GateError) as e:
            pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=2, overwrite=True, **more)
        return e.value.counts

    jsonl(meta, [{"image": f"01_01T_01S_{A}_1.jpg"}, {"title": "no image"}, {"image": f"01_01T_01S_{B}_2.jpg"}])
    assert counts(metadata=meta) == {"invalid_source_manifest": 1, "source_manifest_missing_exact_stem": 1}
    jsonl(meta, [{"image": f"01_01T_01S_{A}_1.jpg"}, {"image": f"01_01t_01S_{A}_1.png"}])
    assert counts(metadata=meta) == {"invalid_source_manifest": 1, "source_manifest_missing_exact_stem": 1}
    with open(meta, "a") as f:
        f.write('{"image": "x", "image": "y"}\n')
    assert counts(metadata=meta) == {"invalid_source_manifest": 1, "source_manifest_missing_exact_stem": 2}
    jsonl(meta, [{"image": f"01_01T_01S_{A}_1.jpg", "isbn": "123"}, {"image": f"01_01T_01S_{B}_2.jpg", "isbn": None}])
    assert counts(metadata=meta) == {"source_manifest_isbn_mismatch": 1}
    jsonl(f"{old}/train.jsonl", [{"isbn": A}])
    with open(f"{old}/test.jsonl", "w") as f:
        f.write("[1]\n")
    assert counts(earlier=old) == {"invalid_existing_split": 2}
    with open(f"{tmp_path}/out/issues.jsonl") as f:
        assert [json.loads(x)["subject"] for x in f] == ["test", "validation"]


def test_all_issues_are_written(spark, tmp_path):
    d = f"{tmp_path}/pairs"
    os.makedirs(d)
    for i in range(1500):
        with open(f"{d}/x{i}.txt", "w"):
            pass
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=1)
    assert e.value.counts == {"unexpected_file": 1500, "unexpected_pair_count": 1}
    with open(f"{tmp_path}/out/issues.jsonl") as f:
        assert len({json.loads(x)["subject"] for x in f}) == 1501


def test_decoder_gives_pixels_of_other_formats():
    jpeg = b"\xff\xd8\xff\xc0" + struct.pack(">HBHHB", 17, 8, 2, 3, 3) + b"\0" * 9 + b"\xff\xd9"
    pixels = np.arange(18).reshape(2, 3, 3).astype(np.uint8)
    assert im.inspect("x", jpeg, decoder=lambda data, info: pixels)["pixel_sha256"] == im.pixel_sha256(pixels)
    assert "decoded" in im.inspect("x", jpeg, decoder=lambda data, info: pixels[:1])["error"]
    assert im.inspect("x", jpeg).get("pixel_sha256") is None


def test_broken_image_stops_the_last_gate(spark, tmp_path):
    d = f"{tmp_path}/pairs"
    pair(d, f"01_01T_01S_{A}_1", "a cat", 1)
    with open(f"{d}/01_01T_01S_{A}_1.jpg", "wb") as f:
        f.write(png(flat(1), broken=True))
    with pytest.raises(GateError) as e:
        pp.prepare_pairs(spark, d, f"{tmp_path}/out", expected=1)
    assert e.value.stage == "images" and e.value.counts == {"image_decode_or_integrity_error": 1}


def test_manifest_chain(spark, tmp_path):
    images, labels, old = f"{tmp_path}/images", f"{tmp_path}/labels", f"{tmp_path}/old"
    for name, colour in (("x/one.png", 1), ("y/one.png", 2), ("z/two.png", 3), ("z/copy.png", 3), ("z/other.png", 4), ("z/Three.png", 5)):
        os.makedirs(os.path.dirname(f"{images}/{name}"), exist_ok=True)
        with open(f"{images}/{name}", "wb") as f:
            f.write(png(flat(colour)))
    with open(f"{images}/z/broken.png", "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\nxx")
    entry = lambda name, caption, path=None: {"srcImageFile": name, "srcImagePath": path, "srcText": "t " + name, "imageCaptionInfo": {"imageCaption": caption}}
    os.makedirs(labels)
    book = {"title": "B", "isbn": A, "imageInfo": [entry("two.png", "two"), entry("copy.png", " two "), entry("one.png", "one"), entry("one.png", "one x", "x"), entry("y\\one.png", "one y"), entry("three.png", "3"), entry("wo.png", "sub"), entry("two.png", " "), entry("broken.png", "b"), None]}
    with open(f"{labels}/a.json", "w", encoding="utf-8-sig") as f:
        json.dump(book, f)
    with open(f"{labels}/b.json", "w") as f:
        f.write("{broken")
    with open(f"{labels}/c.json", "w") as f:
        json.dump({"title": "C", "imageInfo": 5}, f)
    with open(f"{labels}/d.json", "w") as f:
        json.dump({"title": "D", "isbn": None, "imageInfo": [entry("other.png", "first"), entry("other.png", "second")]}, f)
    rows, lost = pp.build_manifest(spark, labels, images)
    manifest = pp.with_manifest_order(rows).cache()
    got = sorted((os.path.relpath(r.image, images), r.caption, r.resolution) for r in manifest.collect())
    assert got == sorted([("z/two.png", "two", "unique_exact_basename"), ("z/copy.png", " two ", "unique_exact_basename"), ("x/one.png", "one x", "referenced_path"), ("y/one.png", "one y", "referenced_path"), ("z/Three.png", "3", "unique_exact_basename"), ("z/broken.png", "b", "unique_exact_basename"), ("z/other.png", "first", "unique_exact_basename"), ("z/other.png", "second", "unique_exact_basename")])
    assert sorted(r.reason for r in lost.collect()) == ["ambiguous_exact_basename", "empty_or_missing_caption", "image_not_found", "invalid_imageInfo_entry", "invalid_label_json", "missing_or_invalid_imageInfo"]
    jsonl(f"{old}/train.jsonl", [{"isbn": A}])
    jsonl(f"{old}/validation.jsonl", [])
    jsonl(f"{old}/test.jsonl", [{"context": "t  two.png"}])
    from pyspark.sql import functions as F

    kept, events = pp.prepare_manifest(spark, manifest.withColumn("group", F.lit(None).cast("string")), images, earlier=old)
    kept = kept.collect()
    assert sorted(e.reason for e in events.collect()) == ["duplicate_image_same_caption", "image_decode_or_read_error", "same_image_conflicting_captions", "same_image_conflicting_captions"]
    assert len(kept) == 4 and {k.split for k in kept} == {"test"} and len({k.group for k in kept}) == 1 and all(k.mixed for k in kept)
    assert pp.build_manifest(spark, labels, images, limit=1)[0].count() == 6


def test_pixels():
    rgba = np.array([[[9, 9, 9, 0], [255, 0, 0, 255], [0, 0, 255, 128]]], np.uint8)
    info = im.header(png(rgba, 6))
    assert im.png_rgb(info)[0].tolist() == [[[255, 255, 255], [255, 0, 0], [127, 127, 255]]]
    assert im.png_rgb(info, composite=False)[0].tolist() == [[[9, 9, 9], [255, 0, 0], [0, 0, 255]]]
    import hashlib

    r = np.random.RandomState(0).randint(0, 255, (131, 17, 3)).astype(np.uint8)
    assert im.pixel_sha256(r) == hashlib.sha256(b"RGB:17:131:" + r.tobytes()).hexdigest()
    assert "pixels" in im.inspect("x", png(flat(1)), max_pixels=10)["error"]
    assert "changed" in im.inspect("x", png(flat(1)), expected_sha256="0")["error"]
    box = im.letterboxed(flat(0, 8, 4), 8)
    assert box.shape == (3, 8, 8) and (box[:, :2] == 1).all() and (box[:, 6:] == 1).all() and (box[:, 2:6] == -1).all()
    jpeg = b"\xff\xd8" + b"\xff\xe1" + struct.pack(">H", 34) + b"Exif\0\0MM\0*\0\0\0\x08\0\x01\x01\x12\0\x03\0\0\0\x01\0\x06\0\0\0\0\0\0" + b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 12, 16, 3) + b"\0" * 9 + b"\xff\xd9"
    got = im.inspect("x", jpeg)
    assert got["error"] is None and (got["original_width"], got["width"], got["height"], got["exif_transposed"]) == (16, 12, 16, True)


def test_all_png_filters():
    r = np.random.RandomState(1)
    px = r.randint(0, 256, (5, 7, 3)).astype(np.uint8)
    rows, up = [], np.zeros(21, int)
    for y, kind in enumerate(range(5)):
        line = px[y].reshape(-1).astype(int)
        left, corner = np.concatenate([[0] * 3, line[:-3]]), np.concatenate([[0] * 3, up[:-3]])
        p = left + up - corner
        paeth = [a if abs(q - a) <= abs(q - b) and abs(q - a) <= abs(q - c) else b if abs(q - b) <= abs(q - c) else c for q, a, b, c in zip(p, left, up, corner, strict=True)]
        guess = [np.zeros(21, int), left, up, (left + up) // 2, np.array(paeth)][kind]
        rows.append(bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes())
        up = line
    assert (im._unfilter(b"".join(rows), 7, 5, 3) == px).all()
