"""Caches of features: fingerprint, what a training run admits, and the files behind records."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contained, resolved, rooted
from .chained import chained_sha256
from .split import overlap

#: States of a cache that is not to be trained on (fixed values).
UNFINISHED = ("building", "failed", "incomplete")


def cache_fingerprint(model_id: str, revision: str, config: dict, data_sha256: dict[str, str], selected: DataFrame, key: str, order: list) -> str:
    """Digest over model, revision, configuration, digests of the data and the ordered ids of what is cached.

    The text that is digested is JSON with sorted keys, ids last as its keys sort. The digest goes from
    range to range of the ids, so their number has no bound.
    """
    parts = {"config": config, "data_sha256": data_sha256, "model_id": model_id, "revision": revision}
    head = json.dumps(parts, sort_keys=True, ensure_ascii=False)

    def quoted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            text = [json.dumps(v, ensure_ascii=False) for v in x.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), *x.columns[1:]], ["_piece", *x.schema.names[1:]])

    by = [o if isinstance(o, Column) else F.col(o) for o in order]
    rows = selected.select(F.col(key).alias("_key"), *[c.alias(f"_by{i}") for i, c in enumerate(by)])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema[1:])
    return chained_sha256(rows.mapInArrow(quoted, f"_piece string{kinds}"), F.col("_piece"), [F.col(f"_by{i}") for i in range(len(by))], head[:-1].encode() + b', "selected_ids": [', b", ", b"]}")[1]


def feature_issues(records: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """``id, reason`` of records ``id, feature_file, feature_sha256`` whose file cannot be used.

    A path that leaves the cache's folder, by ``..`` too, is never looked up; others must be among
    ``files`` (``path, sha256``) with the digest that the record names.
    """
    path = resolved(rooted(F.col("feature_file"), F.lit(root)))
    rows = records.select("id", "feature_file", "feature_sha256", path.alias("_path"))
    inside = F.coalesce(contained(F.col("_path"), F.lit(root)), F.lit(False))
    outside = rows.where(~inside).select("id", F.lit("feature_path_outside_cache").alias("reason"))
    known = files.select(resolved(F.col("path")).alias("_path"), F.col("sha256").alias("feature_sha256")).distinct()
    lost = rows.where(inside).join(known, ["_path", "feature_sha256"], "left_anti")
    return outside.unionByName(lost.select("id", F.lit("missing_or_changed_feature").alias("reason")))


def admit(manifest: dict, records: DataFrame, files: DataFrame | None = None, root: str | None = None, whole_epochs: bool = False, validation_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Training and validation records of a cache that may be trained on; ValueError says why another may not.

    ``manifest`` has ``status, partial, selected_complete, source_counts, selected_counts``;
    ``records`` have ``ordinal, id, split, group, image_sha256, feature_file, feature_sha256``.
    Whole epochs need a whole training split. A held-out group or image among training rows, a repeated
    id, and a file that is missing, changed or outside the cache are refused.
    """
    if records.isEmpty():
        raise ValueError("the cache has no completed records")
    if manifest.get("selected_complete") is False or manifest.get("status") in UNFINISHED:
        raise ValueError("the cache is not complete yet")
    source, selected = (manifest.get(k, {}).get("train") for k in ("source_counts", "selected_counts"))
    known = source is not None and selected is not None
    partial = selected < source if known else manifest.get("status") == "partial" or manifest.get("partial", False)
    if whole_epochs and partial:
        raise ValueError("epochs need a whole training cache; a part of one allows a number of steps")
    training, validation = records.where("split = 'train'"), records.where("split = 'validation'")
    if validation_limit is not None:
        validation = validation.orderBy("ordinal").limit(validation_limit)
    if training.isEmpty() or validation.isEmpty():
        raise ValueError("training and validation records are both needed")
    held = records.where("split in ('validation', 'test')")
    if not overlap(held.select("id", "group", "image_sha256"), training.select("group", "image_sha256"), "group", "image_sha256").isEmpty():
        raise ValueError("held-out records share a group or an image with training records")
    used = training.unionByName(validation)
    n, distinct = used.agg(F.count("*"), F.countDistinct("id")).first()
    if n != distinct:
        raise ValueError("ids of records repeat")
    if files is not None:
        issue = feature_issues(used, files, root).orderBy("reason", "id").first()
        if issue is not None:
            raise ValueError(f"{issue.reason}: {issue.id}")
    return training, validation


def adapter_issues(adapter: dict, wanted: dict, keys: tuple[str, ...]) -> list[str]:
    """Dotted settings on which an adapter's configuration differs from what is wanted, such as ``cache_config.prefix``."""

    def value(config: dict, dotted: str):
        for part in dotted.split("."):
            config = config.get(part) if isinstance(config, dict) else None
        return config

    return [k for k in keys if value(adapter, k) != value(wanted, k)]


#: Steps that a resolution comes in, workers at most, and what seeds are below (fixed values).
RESOLUTION_STEP, MOST_WORKERS, SEEDS_BELOW = 32, 32, 2**63


def parameter_issues(values: dict, positive: tuple[str, ...] = (), not_negative: tuple[str, ...] = ()) -> list[str]:
    """What is wrong with parameters that must be over 0, or at least 0; those that are None or not given are not judged.

    Known by their names and judged where given: ``resolution`` (a multiple of 32), ``workers`` (1 to
    32), ``seed`` and ``seeds`` (whole, from 0 and below 2^63; several differ from each other), ``ratios`` (none
    negative, and together below 1).
    """
    given = lambda names: [(n, values[n]) for n in names if values.get(n) is not None]
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
    out = [f"{n} must be positive" for n, v in given(positive) if not v > 0] + [f"{n} must not be negative" for n, v in given(not_negative) if not v >= 0]
    for _, v in given(["resolution"]):
        out += [f"resolution must be a positive multiple of {RESOLUTION_STEP}"] * (not whole(v) or v < 1 or v % RESOLUTION_STEP > 0)
    for _, v in given(["workers"]):
        out += [f"workers must be from 1 to {MOST_WORKERS}"] * (not whole(v) or not 1 <= v <= MOST_WORKERS)
    for name, v in given(["seed", "seeds"]):
        each = list(v) if name == "seeds" else [v]
        out += [f"{name} must be whole numbers from 0 and below 2^63"] * (not each or not all(whole(x) and 0 <= x < SEEDS_BELOW for x in each))
        out += [f"{name} must differ from each other"] * (len(set(each)) < len(each))
    for _, v in given(["ratios"]):
        out += ["ratios must not be negative and must sum to less than 1"] * (not all(x >= 0 for x in v) or not sum(v) < 1)
    return out
