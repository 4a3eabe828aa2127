"""Files of named tensors: read in ranges, written, digested, and held to what a cache asks of them."""

import hashlib
import json
import struct

import numpy as np
import pytest

from plumbline.sources import tensors as ts


def blob(tensors, metadata=None, cut=0):
    header, data = ({"__metadata__": metadata} if metadata else {}), b""
    for name, (dtype, a) in tensors.items():
        header[name] = {"dtype": dtype, "shape": list(a.shape), "data_offsets": [len(data), len(data) + a.nbytes]}
        data += a.tobytes()
    head = json.dumps(header).encode()
    whole = struct.pack("<Q", len(head)) + head + data
    return whole[: len(whole) - cut]


def flat(tensors):
    value = hashlib.sha256()
    for name, (dtype, a) in sorted(tensors.items()):
        value.update(json.dumps([name, ts.DTYPES[dtype][1], list(a.shape)]).encode())
        value.update(a.tobytes())
    return value.hexdigest()


def some(seed):
    r = np.random.RandomState(seed)
    return {"z.weight": ("F32", r.normal(size=(7, 11)).astype("<f4")), "a é": ("I64", r.randint(0, 99, 5)), "m": ("BF16", r.randint(0, 2**16, (2, 3, 4)).astype("<u2")), "none": ("F16", np.zeros((0, 4), "<f2")), "one": ("BOOL", np.array(True))}


@pytest.mark.parametrize("options", [{}, {"rangebytes": 64, "partbytes": 40}, {"rangebytes": 50, "partbytes": 1000}])
def test_rows_and_digests_of_files(spark, tmp_path, options):
    files = {f"{tmp_path}/sub/f{i}.safetensors": some(i) for i in range(3)}
    (tmp_path / "sub").mkdir()
    for path, t in files.items():
        with open(path, "wb") as f:
            f.write(blob(t, {"id": path}))
    with open(f"{tmp_path}/empty.safetensors", "wb") as f:
        f.write(blob({}))
    rows = ts.read_tensors(spark, str(tmp_path), **options)
    got = {}
    for r in sorted(rows.where("name IS NOT NULL").collect(), key=lambda r: (r.path, r.name, r.part)):
        dtype, shape, data = got.setdefault((r.path, r.name), (r.dtype, list(r.shape), bytearray()))
        data += r.data
        assert r.metadata == {"id": r.path} and (not options or len(r.data) <= options["partbytes"])
    assert got == {(p, n): (d, list(a.shape), bytearray(a.tobytes())) for p, t in files.items() for n, (d, a) in t.items()}
    digests = {r.path: (r.n_tensors, r.digest) for r in ts.tensor_file_digests(rows).collect()}
    assert digests == {p: (5, flat(t)) for p, t in files.items()} | {f"{tmp_path}/empty.safetensors": (0, flat({}))}
    # metadata and the order in the file have no part in it
    with open(f"{tmp_path}/other.safetensors", "wb") as f:
        f.write(blob(dict(reversed(some(0).items()))))
    assert ts.tensor_file_digests(ts.read_tensors(spark, f"file://{tmp_path}/other.safetensors", **options)).first().digest == flat(some(0))


def test_damaged_files_are_rows_with_an_error(spark, tmp_path):
    good = blob(some(1))
    bad = {"cut": good[:-1], "header": good[:20], "none": b"", "short": b"1234567", "huge": struct.pack("<Q", 1 << 60) + b"{}", "list": struct.pack("<Q", 2) + b"[]", "json": struct.pack("<Q", 2) + b"{x", "size": blob(some(1)).replace(b"[7, 11]", b"[7, 12]"), "type": blob(some(1)).replace(b'"F32"', b'"F33"')}
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "fine").write_bytes(good)
    for options in ({}, {"rangebytes": 30}):
        rows = ts.tensor_file_digests(ts.read_tensors(spark, str(tmp_path), **options)).collect()
        assert {r.path.rpartition("/")[2] for r in rows if r.error} == set(bad) and len(rows) == len(bad) + 1
        assert all(r.digest is None for r in rows if r.error)
    with pytest.raises(Exception, match="no/such"):
        ts.read_tensors(spark, "/no/such").count()


def test_written_files_read_back(spark, tmp_path):
    r = np.random.RandomState(5)
    rows = [(f"f{i % 3}.safetensors", {"id": f"f{i % 3}"}, f"t{i}", "F32", [2, 4], bytearray(r.normal(size=(2, 4)).astype("<f4").tobytes())) for i in range(9)]
    df = spark.createDataFrame(rows, ts.WRITTEN)
    ts.write_tensors(df, f"{tmp_path}/out")
    ts.write_tensors(df, f"file://{tmp_path}/out")  # again, in the place of the first
    got = {(x.path.rpartition("/")[2], x.metadata["id"], x.name, x.dtype, tuple(x.shape), bytes(x.data)) for x in ts.read_tensors(spark, f"{tmp_path}/out").collect()}
    assert got == {(f, m["id"], n, d, tuple(s), bytes(b)) for f, m, n, d, s, b in rows}
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["f0.safetensors", "f1.safetensors", "f2.safetensors"]


def test_text_caches_that_may_not_be_used(spark, tmp_path):
    e, m = np.ones((3, 2), "<f4"), np.array([1, 0, 1])
    nan = e.copy()
    nan[1, 1] = np.nan
    meta = lambda name, mark="p": {"fingerprint": mark, "id": name}
    both = lambda a, b, kind="I64": {"prompt_embeds": ("F32", a), "prompt_attention_mask": (kind, b)}
    cases = {
        "fine": (None, blob(both(e, m), meta("fine"))),
        "half": (None, blob({"prompt_embeds": ("BF16", np.full((3, 2), 0x3F80, "<u2")), "prompt_attention_mask": ("F32", m.astype("<f4"))}, meta("half"))),
        "nan": ("nonfinite_embedding", blob(both(nan, m), meta("nan"))),
        "inf": ("nonfinite_embedding", blob({"prompt_embeds": ("BF16", np.full((3, 2), 0x7F80, "<u2")), "prompt_attention_mask": ("I64", m)}, meta("inf"))),
        "two": ("bad_mask", blob(both(e, m * 2), meta("two"))),
        "nanmask": ("bad_mask", blob(both(e, np.array([1, np.nan, 0], "<f4"), "F32"), meta("nanmask"))),
        "zeros": ("bad_mask", blob(both(e, m * 0), meta("zeros"))),
        "empty": ("other_shapes", blob(both(e[:0], m[:0]), meta("empty"))),
        "length": ("other_shapes", blob(both(e, m[:2]), meta("length"))),
        "rank": ("other_shapes", blob(both(e.reshape(-1), m), meta("rank"))),
        "extra": ("other_tensors", blob(both(e, m) | {"x": ("I64", m)}, meta("extra"))),
        "lacks": ("other_tensors", blob({"prompt_embeds": ("F32", e)}, meta("lacks"))),
        "id": ("other_metadata", blob(both(e, m), meta("another"))),
        "mark": ("other_metadata", blob(both(e, m), meta("mark", "q"))),
        "more": ("other_metadata", blob(both(e, m), meta("more") | {"k": "v"})),
        "bare": ("other_metadata", blob(both(e, m))),
        "cut": ("damaged_file", blob(both(e, m), meta("cut"), cut=1)),
        "gone": ("missing_file", None),
    }
    for name, (_, data) in cases.items():
        if data is not None:
            (tmp_path / name).write_bytes(data)
    wanted = spark.createDataFrame([(f"{tmp_path}/{n}", n) for n in cases], "path string, id string")
    for options in ({}, {"partbytes": 8, "rangebytes": 100}):
        got = {r.id: r.reason for r in ts.text_cache_issues(ts.read_tensors(spark, str(tmp_path), **options), wanted, "p").collect()}
        assert got == {n: why for n, (why, _) in cases.items() if why}
