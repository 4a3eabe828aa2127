"""Scans of JSON lines, JSON documents and files, and guarded sinks."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename, cache_screen, casefolded, strict_object
from .hadoop import Store, local_path
from .lines import read_lines

#: Suffixes of image files (fixed values).
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff")
SPLITS = ("train", "validation", "test")


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of JSON lines with ``_path``, ``_ordinal`` and ``_sha256``.

    A line that is no object is an error that names its place; ``strict`` refuses repeated keys and
    nonfinite constants too.
    """
    lines = read_lines(spark, path)
    good = strict_object(F.col("line")) if strict else F.coalesce(F.json_object_keys("line").isNotNull(), F.lit(False))
    place = F.concat(F.col("path"), F.lit(":"), F.col("ordinal").cast("string"), F.lit(" is no valid object"))
    # blank lines are no error, though a filter of the caller be tried before the one that skips them
    checked = F.when(F.trim("line") == "", None).when(good, F.col("line")).otherwise(F.raise_error(place))
    return lines.select("path", "ordinal", "file_sha256", F.from_json(checked, schema).alias("x")).select("x.*", F.col("path").alias("_path"), F.col("ordinal").alias("_ordinal"), F.col("file_sha256").alias("_sha256"))


def checked_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> tuple[DataFrame | None, str | None]:
    """Rows as ``read_jsonl`` gives them, or None and what is wrong: a missing file, bytes that are no text, a bad line."""
    try:
        lines = read_lines(spark, path)
        good = strict_object(F.col("line")) if strict else F.coalesce(F.json_object_keys("line").isNotNull(), F.lit(False))
        bad = lines.where(~good | F.col("line").contains("\ufffd")).orderBy("ordinal").select("ordinal").first()
    except Exception as e:
        return None, f"{path}: {type(e).__name__}: {str(e).splitlines()[0][:300]}"
    if bad is not None:
        return None, f"{path}:{bad.ordinal} is no valid object"
    return read_jsonl(spark, path, schema, strict), None


def read_splits(spark: SparkSession, folder: str, schema: str, check: bool = False, screen: bool = False) -> DataFrame:
    """Three mandatory files train, validation and test of a folder, with ``split``.

    With ``check`` a row's own ``split`` must be its file's, with ``screen`` its ``caption`` one that may be
    cached; others are an error that names the place. A missing file is Spark's path error.
    """
    parts = []
    for name in SPLITS:
        rows = read_jsonl(spark, f"{folder.rstrip('/')}/{name}.jsonl", schema)
        own = F.when(F.col("split").eqNullSafe(F.lit(name)), F.lit(name)).otherwise(F.raise_error(F.lit(f"a row of {name}.jsonl names another split"))) if check else F.lit(name)
        if screen:
            place = F.concat(F.col("_path"), F.lit(":"), F.col("_ordinal").cast("string"), F.lit(" has a caption that may not be cached"))
            rows = rows.withColumn("caption", F.when(cache_screen(F.col("caption")), F.col("caption")).otherwise(F.raise_error(place)))
        parts.append(rows.withColumn("split", own))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """``path, name, suffix, length`` of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    path = F.regexp_replace("path", "^file:/*", "/")
    return files.select(path.alias("path"), basename(path).alias("name"), F.regexp_extract("path", r"(\.[^./]*)$", 1).alias("suffix"), "length")


def unlisted(spark: SparkSession, folder: str, n_files: int) -> tuple[list[str], DataFrame | None]:
    """What a listing of ``n_files`` by Spark lacks: names of folders, and rows like its own of empty and hidden files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    if len(found) == n_files:
        return [], None
    each = [(x.getPath().toUri().getPath(), x.getPath().getName(), x.isFile(), x.getLen()) for x in found]
    files = [(p, n, os.path.splitext(n)[1], size) for p, n, file, size in each if file and (n[0] in "._" or not size)]
    return sorted(n for _, n, file, _ in each if not file), spark.createDataFrame(files, "path string, name string, suffix string, length long") if files else None


def folder_exists(spark: SparkSession, folder: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def image_index(spark: SparkSession, folder: str) -> DataFrame:
    """``folded, paths``: images of a folder by their folded names."""
    images = list_files(spark, folder).where(F.lower("suffix").isin(*IMAGE_SUFFIXES))
    return images.groupBy(casefolded(F.col("name")).alias("folded")).agg(F.array_sort(F.collect_set("path")).alias("paths"))


def classify_pair_files(files: DataFrame) -> DataFrame:
    """Files with ``stem`` and ``kind``: image, json or unexpected_file. Suffixes count as they are written."""
    kind = F.when(F.col("suffix") == ".jpg", "image").when(F.col("suffix") == ".json", "json").otherwise("unexpected_file")
    return files.withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", "")).withColumn("kind", kind)


def read_prompts(spark: SparkSession, prompt: str | None = None, caption_json: str | None = None, jsonl: str | None = None) -> DataFrame:
    """``id, imageCaption`` from exactly one source: a text, one caption file (its stem is the id) or JSON lines."""
    if sum(x is not None for x in (prompt, caption_json, jsonl)) != 1:
        raise ValueError("give exactly one source of prompts")
    schema = "id string, imageCaption string"
    if prompt is not None:
        return spark.createDataFrame([("prompt", prompt)], schema)
    if caption_json is not None:
        whole = spark.read.format("binaryFile").load(caption_json)
        text = F.regexp_replace(F.decode("content", "UTF-8"), r"^\x{FEFF}", "")
        return whole.select(F.regexp_replace(basename(F.col("path")), r"\.[^.]*$", "").alias("id"), F.from_json(text, "imageCaption string")["imageCaption"].alias("imageCaption"))
    return read_jsonl(spark, jsonl, schema, strict=True).select("id", "imageCaption")


def write_atomic(path: str, text: str) -> None:
    """Replace a small file in one step, after its bytes are on disk; a path with a scheme by its file system."""
    own = local_path(path)
    if own is None:
        Store(SparkSession.active()).write(path, text)
        return
    folder = os.path.dirname(os.path.abspath(own))
    os.makedirs(folder, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, own)
    except BaseException:
        os.path.exists(temporary) and os.remove(temporary)
        raise


def protect(output: str, inputs: list[str], overwrite: bool = False, spark: SparkSession | None = None) -> None:
    """Refuse outputs that exist, unless told to overwrite, and outputs in or over inputs, on any file system."""
    store = Store(spark or SparkSession.active())
    own = store.qualified(output)
    for x in map(store.qualified, inputs):
        if own == x or own.startswith(f"{x}/") or x.startswith(f"{own}/"):
            raise ValueError(f"{output} lies in or over the input {x}")
    if not overwrite and store.exists(own):
        raise FileExistsError(output)


def write_splits(rows: DataFrame, folder: str, report: dict, order: str, overwrite: bool = False, parts: bool = False) -> None:
    """JSON lines of each split in order, then the report, which so marks a complete output.

    Spark sorts and writes each split in ranges, by many tasks, into a staging folder on the same file system.
    A split is one file that its parts were joined to, or with ``parts`` the folder of them, of
    which no byte is written twice. One rename makes the output; where one is replaced, its report goes
    first. A run that is killed leaves no output but its staging folder.
    """
    store, target = Store(rows.sparkSession), folder.rstrip("/")
    if store.exists(target) and not overwrite:
        raise FileExistsError(folder)
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        for name in SPLITS:
            written = f"{staging}/{name}.jsonl" if parts else f"{staging}/parts/{name}"
            rows.where(F.col("split") == name).orderBy(order).write.option("ignoreNullFields", "false").json(written)
            if not parts:
                store.join(written, f"{staging}/{name}.jsonl")
        store.delete(f"{staging}/parts")
        if store.exists(target):
            store.delete(f"{target}/report.json")
            for name in SPLITS:
                store.delete(f"{target}/{name}.jsonl")
                store.rename(f"{staging}/{name}.jsonl", f"{target}/{name}.jsonl")
        else:
            store.rename(staging, target)
    finally:
        store.delete(staging)
    write_report(folder, report)


def write_report(folder: str, report: dict) -> None:
    write_atomic(f"{folder.rstrip('/')}/report.json", json.dumps(report, ensure_ascii=False, indent=1, sort_keys=True) + "\n")


def write_issues(folder: str, issues: DataFrame, order: list[str], name: str = "issues.jsonl") -> str:
    """All rows of a report as JSON lines beside it, in order, whatever their number."""
    store, target = Store(issues.sparkSession), folder.rstrip("/")
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        issues.orderBy(*order).write.option("ignoreNullFields", "false").json(f"{staging}/parts")
        store.join(f"{staging}/parts", f"{staging}/{name}")
        store.make(target)
        store.rename(f"{staging}/{name}", f"{target}/{name}", overwrite=True)
    finally:
        store.delete(staging)
    return name


def write_exclusive(rows: DataFrame, path: str, report: dict, order: str) -> None:
    """A manifest as one JSON-lines file and its report beside it; neither may exist, the report comes last."""
    store, target = Store(rows.sparkSession), f"{path}.report.json"
    for x in (path, target):
        if store.exists(x):
            raise FileExistsError(x)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    try:
        rows.orderBy(order).write.option("ignoreNullFields", "false").json(f"{staging}/parts")
        store.join(f"{staging}/parts", f"{staging}/joined")
        own = local_path(path)
        if own is None:
            store.rename(f"{staging}/joined", path)
        else:
            os.link(local_path(f"{staging}/joined"), own)  # fails if another writer was first; a rename here would not
    finally:
        store.delete(staging)
    write_atomic(target, json.dumps(report, ensure_ascii=False, indent=1, sort_keys=True) + "\n")


def write_with_pointer(folder: str, manifest: dict, pointer: str) -> None:
    """A cache's manifest, then the pointer that names its folder, which so never names an incomplete one."""
    write_atomic(f"{folder.rstrip('/')}/manifest.json", json.dumps(manifest, ensure_ascii=False) + "\n")
    write_atomic(pointer, json.dumps({"cache_path": folder}, ensure_ascii=False) + "\n")


def append_event(path: str, **entry) -> None:
    """One line of an event log, with the time; numbers that JSON lacks are an error."""
    line = json.dumps({**entry, "time": time.strftime("%Y-%m-%dT%H:%M:%S")}, ensure_ascii=False, allow_nan=False)
    with open(path, "a", encoding="utf-8") as f:
        f.write(line + "\n")


def write_status(folder: str, completed: int, total: int, error: BaseException | None = None) -> None:
    """How far a run has come in ``status.json``, or what ended it in ``failure.json``."""
    if error is not None:
        body, name = {"type": type(error).__name__, "message": str(error), "completed": completed}, "failure.json"
    else:
        body, name = {"status": "complete" if completed == total else "running", "completed": completed, "total": total}, "status.json"
    write_atomic(f"{folder.rstrip('/')}/{name}", json.dumps(body, ensure_ascii=False) + "\n")


def recover_journal(path: str) -> bool:
    """Cut a torn last line off a JSON-lines journal, after its bytes were copied to ``.interrupted.jsonl`` once.

    A broken line anywhere else is an error, and the file stays as it is. True if a line was cut.
    Lines are read one at a time.
    """
    end = broken = 0
    with open(path, "rb") as f:
        for number, line in enumerate(f, 1):
            if broken:
                raise ValueError(f"{path}: line {broken} is broken")
            try:
                json.loads(line.decode())
                end += len(line)
            except ValueError:
                broken = number
    if not broken:
        return False
    backup = os.path.splitext(path)[0] + ".interrupted.jsonl"
    if not os.path.exists(backup):
        shutil.copy2(path, backup)
    with open(path, "r+b") as f:
        f.truncate(end)
        f.flush()
        os.fsync(f.fileno())
    return True


def publish_once(staged: str, target: str) -> bool:
    """Rename a staged folder to its place; if that is there already, its contents must be equal. True if it was new."""
    try:
        os.rename(staged, target)
        return True
    except OSError:
        if not os.path.isdir(target):
            raise
    if _tree(staged) != _tree(target):
        raise FileExistsError(f"{target} has other contents")
    shutil.rmtree(staged)
    return False


def _tree(folder: str) -> dict[str, bytes]:
    import hashlib

    out = {}
    for top, _, names in os.walk(folder):
        for n in names:
            with open(f"{top}/{n}", "rb") as f:
                out[os.path.relpath(f"{top}/{n}", folder)] = hashlib.file_digest(f, "sha256").digest()
    return out


def resolve_cache(spark: SparkSession, path: str) -> DataFrame:
    """Records of a cache: a folder with manifest.json, or a pointer file that names one, relative to itself or not."""
    store = Store(spark)
    if not store.is_folder(path):
        target = json.loads(store.read(path).removeprefix("\ufeff"))["cache_path"]
        path = target if target.startswith("/") or "://" in target else f"{path.rpartition('/')[0] or '.'}/{target}"
    return spark.read.option("multiLine", "true").json(f"{path}/manifest.json")


def conflicting_report(existing: dict, new: dict, keys: list[str]) -> list[str]:
    """Keys on which a completion report that exists and a new one differ."""
    return [k for k in keys if existing.get(k) != new.get(k)]


__all__ = ["append_event", "checked_jsonl", "classify_pair_files", "conflicting_report", "folder_exists", "image_index", "list_files", "protect", "publish_once", "read_jsonl", "read_lines", "read_prompts", "read_splits", "recover_journal", "resolve_cache", "unlisted", "write_atomic", "write_exclusive", "write_issues", "write_report", "write_splits", "write_status", "write_with_pointer"]
