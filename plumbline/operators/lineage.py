"""Content digests: record ids, fingerprints, configurations, file sets."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chained import chained_sha256, json_pieces

#: Files whose digest is made in one row; that of more goes from range to range.
MOST_FILES = 1_000_000


def _nul() -> Column:
    return F.char(F.lit(0))


def record_id_v1(content_sha: Column, caption: Column) -> Column:
    """24 digits over content digest and normalised caption."""
    return F.substring(F.sha2(F.concat(content_sha, _nul(), caption), 256), 1, 24)


def record_id_v2(stem: Column, caption_sha: Column, content_sha: Column) -> Column:
    """24 digits over stem, caption digest and content digest."""
    return F.substring(F.sha2(F.concat(stem, _nul(), caption_sha, _nul(), content_sha), 256), 1, 24)


def canonical_json(value: dict) -> str:
    """Sorted keys, no spaces, UTF-8 as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def config_digest(config: dict) -> str:
    return hashlib.sha256(canonical_json(config).encode()).hexdigest()


def row_digest(*columns: str) -> Column:
    """Digest of a row as canonical JSON: fields in the order of their names, nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def content_fingerprint(rows: DataFrame, key: str, columns: list[str], ranges: int = 1 << 16) -> DataFrame:
    """One row ``n_rows, fingerprint`` that depends on all rows and on nothing else.

    Rows are digested, sorted digests of each of ``ranges`` key classes are digested together, and
    the classes' digests once more in order: a two-level tree, so no place sees all rows.
    """
    marked = rows.select(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(ranges)).alias("_class"), row_digest(*columns).alias("_d"))
    classes = marked.groupBy("_class").agg(F.count("*").alias("n"), F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("_d"))), 256).alias("d"))
    return classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.sha2(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("_class", "d"))), lambda x: x["d"])), 256).alias("fingerprint"))


def content_sha256(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """One row ``n_rows, sha256``: the digest of all rows as one JSON list, sorted by ``order``, keys sorted, no spaces.

    ``order`` should tell rows apart. Any number of rows: see ``chained``.
    """
    pieces = json_pieces(rows, order, columns)
    n, digest = chained_sha256(pieces, F.col("piece"), [F.col(f"_o{i}") for i in range(len(order))], b"[", b",", b"]")
    return rows.sparkSession.createDataFrame([(n, digest)], "n_rows long, sha256 string")


def file_set_digest(files: DataFrame, path: str = "path", sha: str = "sha256") -> DataFrame:
    """One row ``n_files, revision`` of a listing of paths with digests: of one text, a line for each file, sorted."""
    pair = F.concat(F.col(path), F.lit(" "), F.col(sha))
    if files.limit(MOST_FILES + 1).count() > MOST_FILES:
        n, digest = chained_sha256(files, pair, [pair], between=b"\n")
        return files.sparkSession.createDataFrame([(n, digest)], "n_files long, revision string")
    return files.agg(F.count("*").alias("n_files"), F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(pair))), 256).alias("revision"))


def tensor_digest(name: Column, values: Column) -> Column:
    """Digest of a named vector in a canonical text: name, type, length, and each value as the double it is.

    Text stands in for raw bytes, so digests agree between our tables, not with files of tensors.
    """
    head = F.concat_ws(":", name, F.lit("float"), F.size(values).cast("string"))
    return F.sha2(F.concat_ws(chr(10), head, F.concat_ws(",", F.transform(values, lambda v: v.cast("double").cast("string")))), 256)


def differing_keys(left: Column, right: Column) -> Column:
    """Sorted keys of two maps whose values differ or are in one only."""
    keys = F.array_distinct(F.concat(F.map_keys(left), F.map_keys(right)))
    return F.array_sort(F.filter(keys, lambda k: ~F.try_element_at(left, k).eqNullSafe(F.try_element_at(right, k))))
