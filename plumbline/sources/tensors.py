"""Files of named tensors as a Spark data source, and what is asked of them.

A file has eight bytes with the length of its header, the header, JSON that names each tensor's type,
shape and range of bytes, and these bytes. The source lists files on the driver and cuts
them into ranges of bytes; a task reads the header of its file and those tensors' parts that begin in
its range, so a large file is read by many tasks, and rows stay small. Paths may have any
scheme that Arrow's file systems know.

    register(spark)
    spark.read.format("tensors").load("/features")    # path, metadata, name, dtype, shape, part, data, error
"""

from __future__ import annotations

import hashlib
import json
import math
import posixpath
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "path string, metadata map<string,string>, name string, dtype string, shape array<bigint>, part int, data binary, error string"
WRITTEN = "file string, metadata map<string,string>, name string, dtype string, shape array<bigint>, data binary"
_ARROW = pa.schema([("path", pa.string()), ("metadata", pa.map_(pa.string(), pa.string())), ("name", pa.string()), ("dtype", pa.string()), ("shape", pa.list_(pa.int64())), ("part", pa.int32()), ("data", pa.binary()), ("error", pa.string())])
#: Bytes of a part of a tensor, of a range that a task reads, and of a header at most.
PART, RANGE, HEADER = 16 << 20, 128 << 20, 100 << 20
#: Types by their names in files: bytes of a value, and the name that digests have (fixed values).
DTYPES = {
    "BOOL": (1, "torch.bool"), "U8": (1, "torch.uint8"), "I8": (1, "torch.int8"), "I16": (2, "torch.int16"), "I32": (4, "torch.int32"), "I64": (8, "torch.int64"),
    "F16": (2, "torch.float16"), "BF16": (2, "torch.bfloat16"), "F32": (4, "torch.float32"), "F64": (8, "torch.float64"),
}


@dataclass
class _Range(InputPartition):
    path: str
    size: int
    lo: int
    hi: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def parse_header(head: bytes, size: int) -> tuple[dict, dict[str, dict], int]:
    """Metadata, tensors by name, and where data begin, of a file's first bytes and its size; ValueError says what is wrong."""
    if len(head) < 8:
        raise ValueError("the file ends early")
    (n,) = struct.unpack("<Q", head[:8])
    if n > HEADER or 8 + n > size:
        raise ValueError(f"a header of {n} bytes in a file of {size}")
    tensors = json.loads(head[8 : 8 + n].decode())
    if not isinstance(tensors, dict):
        raise ValueError("the header is no object")
    metadata = tensors.pop("__metadata__", {})
    for name, t in tensors.items():
        lo, hi = t["data_offsets"]
        if math.prod(t["shape"]) * DTYPES[t["dtype"]][0] != hi - lo:
            raise ValueError(f"{name} has {hi - lo} bytes")
        if lo < 0 or 8 + n + hi > size:
            raise ValueError(f"{name} ends behind the file")
    return metadata, tensors, 8 + n


def _rows(p: _Range, part_bytes: int) -> Iterator[dict]:
    system, path = _open(p.path)
    with system.open_input_file(path) as f:
        try:
            head = f.read(8)
            if len(head) == 8 and struct.unpack("<Q", head)[0] <= min(HEADER, p.size):
                head += f.read(struct.unpack("<Q", head)[0])
            metadata, tensors, base = parse_header(head, p.size)
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            if p.lo == 0:
                yield {"path": p.path, "error": f"{type(e).__name__}: {e}"}
            return
        if not tensors and p.lo == 0:
            yield {"path": p.path, "metadata": list(metadata.items()), "error": None}
        for name, t in sorted(tensors.items(), key=lambda x: x[1]["data_offsets"]):
            lo, hi = t["data_offsets"]
            for part in range(max(1, -(-(hi - lo) // part_bytes))):
                at = lo + part * part_bytes
                if p.lo <= base + at < p.hi or base + at == p.size == p.hi:  # an empty tensor may stand at the end
                    f.seek(base + at)
                    yield {"path": p.path, "metadata": list(metadata.items()), "name": name, "dtype": t["dtype"], "shape": t["shape"], "part": part, "data": f.read(min(part_bytes, hi - at)), "error": None}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range, self.part = options["path"], int(options.get("rangebytes", RANGE)), int(options.get("partbytes", PART))

    def partitions(self) -> list[InputPartition]:
        system, path = _open(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(path, recursive=True)) if x.type == fs.FileType.File and x.base_name[0] not in "._"]
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        cut = lambda x: range(0, max(x.size, 1), self.range)
        return [_Range(prefix + x.path, x.size, lo, min(lo + self.range, x.size)) for x in sorted(found, key=lambda x: x.path) for lo in cut(x)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        for row in _rows(partition, self.part):
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW)


@dataclass
class _Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    """Files from rows of ``WRITTEN``; those of a file come together. Files get their names only when all are whole."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        done, name, held = [], None, []

        def close() -> None:
            header, at = {"__metadata__": dict(held[0]["metadata"] or [])} if held[0]["metadata"] else {}, 0
            for t in held:
                header[t["name"]] = {"dtype": t["dtype"], "shape": t["shape"], "data_offsets": [at, at + len(t["data"])]}
                at += len(t["data"])
            head = json.dumps(header, ensure_ascii=False, separators=(",", ":")).encode()
            temporary = posixpath.join(folder, f"_{uuid.uuid4().hex}")
            with system.open_output_stream(temporary) as f:
                f.write(struct.pack("<Q", len(head)) + head)
                for t in held:
                    f.write(t["data"])
            done.append((temporary, posixpath.join(folder, name)))

        for x in batches:
            for row in x.to_pylist():
                if held and row["file"] != name:
                    close()
                    held = []
                name = row["file"]
                held.append(row)
        if held:
            close()
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _open(self.path)
        names = [y for m in messages if m for y in m.names]
        if len({to for _, to in names}) != len(names):
            self.abort(messages)
            raise ValueError("rows of one file came from several tasks")
        for temporary, to in names:
            system.move(temporary, to)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _open(self.path)
        for temporary, _to in (y for m in messages if m for y in m.names):
            system.delete_file(temporary)


class TensorSource(DataSource):
    """Format ``tensors``: option ``path``; ``rangebytes`` and ``partbytes`` bound what a task and a row hold."""

    @classmethod
    def name(cls) -> str:
        return "tensors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TensorSource)


def read_tensors(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """Rows ``SCHEMA`` of the tensor files of a folder, or of one file; a damaged file is one row with ``error``."""
    register(spark)
    return spark.read.format("tensors").options(**options).load(path)


def write_tensors(rows: DataFrame, path: str) -> None:
    """One file for each ``file`` of rows ``WRITTEN``, tensors by name; a file's tensors pass through one task, files are replaced."""
    register(rows.sparkSession)
    columns = [x.split()[0] for x in WRITTEN.split(", ")]
    rows.select(*columns).repartition("file").sortWithinPartitions("file", "name").write.format("tensors").option("path", path).mode("append").save()


def vectors_as_tensors(rows: DataFrame) -> DataFrame:
    """Rows ``file, name, values`` (arrays of float) as rows ``WRITTEN`` of type F32, without metadata."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            values = [np.array(v, "<f4") for v in x.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array([[len(v)] for v in values], pa.list_(pa.int64())), pa.array([v.tobytes() for v in values], pa.binary())], ["file", "name", "shape", "data"])

    made = rows.select("file", "name", "values").mapInArrow(run, "file string, name string, shape array<bigint>, data binary")
    return made.select("file", F.lit(None).cast("map<string,string>").alias("metadata"), "name", F.lit("F32").alias("dtype"), "shape", "data")


def _in_order(tensors: DataFrame) -> DataFrame:
    return tensors.repartition("path").sortWithinPartitions("path", "name", "part")


def tensor_file_digests(tensors: DataFrame) -> DataFrame:
    """``path, n_tensors, digest, error`` of rows ``SCHEMA``: SHA-256 over names, types, shapes and bytes in the order of names.

    Metadata and the order in a file have no part in it. Parts stream through the digest, one at a
    time; a file is digested by one task, and a damaged one has its error instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, digest, error = None, 0, hashlib.sha256(), None
        out = lambda: pa.RecordBatch.from_pylist([{"path": at, "n_tensors": n, "digest": None if error else digest.hexdigest(), "error": error}], schema=pa.schema([("path", pa.string()), ("n_tensors", pa.int64()), ("digest", pa.string()), ("error", pa.string())]))
        for x in batches:
            for row in x.to_pylist():
                if row["path"] != at:
                    if at is not None:
                        yield out()
                    at, n, digest, error = row["path"], 0, hashlib.sha256(), None
                error = error or row["error"]
                if row["name"] is None:
                    continue
                if row["part"] == 0:
                    n += 1
                    digest.update(json.dumps([row["name"], DTYPES[row["dtype"]][1], row["shape"]]).encode())
                digest.update(row["data"])
        if at is not None:
            yield out()

    return _in_order(tensors.select("path", "name", "dtype", "shape", "part", "data", "error")).mapInArrow(run, "path string, n_tensors bigint, digest string, error string")


def _values(dtype: str, data: bytes) -> np.ndarray:
    if dtype == "BF16":  # the upper half of a float
        return (np.frombuffer(data, "<u2").astype("<u4") << 16).view("<f4")
    return np.frombuffer(data, {"BOOL": "?", "U8": "u1", "I8": "i1", "F16": "<f2", "F32": "<f4", "F64": "<f8"}.get(dtype) or "<i" + dtype[1:].replace("16", "2").replace("32", "4").replace("64", "8"))


def text_cache_issues(tensors: DataFrame, wanted: DataFrame, fingerprint: str) -> DataFrame:
    """``path, id, reason`` of the text features ``wanted`` (``path, id``) that may not be used again.

    A file must be whole, name this fingerprint and id and nothing else, and hold ``prompt_embeds``, finite and
    of rank two, and ``prompt_attention_mask``, of rank one and as long, zeros and ones with a one, and no other
    tensor. ``tensors`` are rows of ``read_tensors``; a part at a time is looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for row in x.to_pylist():
                v = _values(row["dtype"], row["data"]) if row["name"] else np.zeros(0)
                f = v.astype(np.float64)
                out.append({k: row[k] for k in ("path", "metadata", "name", "shape", "error")} | {"finite": bool(np.isfinite(f).all()), "binary": bool(((f == 0) | (f == 1)).all()), "some": bool((f == 1).any())})
            yield pa.RecordBatch.from_pylist(out, schema=facts)

    facts = pa.schema([*(_ARROW.field(c) for c in ("path", "metadata", "name", "shape", "error")), ("finite", pa.bool_()), ("binary", pa.bool_()), ("some", pa.bool_())])
    seen = tensors.select("path", "metadata", "name", "dtype", "shape", "data", "error").mapInArrow(run, "path string, metadata map<string,string>, name string, shape array<bigint>, error string, finite boolean, binary boolean, some boolean")
    of = lambda name, c: F.max(F.when(F.col("name") == name, F.col(c)))
    every = lambda name, c: F.min(F.when(F.col("name") == name, F.col(c)))
    files = seen.groupBy(F.col("path").alias("_path")).agg(
        F.max("error").alias("error"), F.sort_array(F.collect_set("name")).alias("names"), F.max(F.size(F.map_keys("metadata"))).alias("keys"),
        F.max(F.try_element_at("metadata", F.lit("fingerprint"))).alias("fingerprint"), F.max(F.try_element_at("metadata", F.lit("id"))).alias("own"),
        of("prompt_embeds", "shape").alias("embeds"), every("prompt_embeds", "finite").alias("finite"),
        of("prompt_attention_mask", "shape").alias("mask"), every("prompt_attention_mask", "binary").alias("binary"), of("prompt_attention_mask", "some").alias("some"),
    )
    held = wanted.join(files, F.col("path") == F.col("_path"), "left")
    good = lambda c: F.coalesce(c, F.lit(False))
    reason = (
        F.when(F.col("_path").isNull(), "missing_file")
        .when(F.col("error").isNotNull(), "damaged_file")
        .when(~good((F.col("keys") == 2) & (F.col("fingerprint") == fingerprint) & (F.col("own") == F.col("id"))), "other_metadata")
        .when(~good(F.col("names") == F.array(F.lit("prompt_attention_mask"), F.lit("prompt_embeds"))), "other_tensors")
        .when(~good((F.size("embeds") == 2) & (F.size("mask") == 1) & (F.get("embeds", F.lit(0)) == F.get("mask", F.lit(0))) & (F.get("mask", F.lit(0)) > 0)), "other_shapes")
        .when(~good(F.col("finite")), "nonfinite_embedding")
        .when(~good(F.col("binary") & F.col("some")), "bad_mask")
    )
    return held.select("path", "id", reason.alias("reason")).where("reason IS NOT NULL")
