"""Joins of references to files, labels and overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, casefolded, contained, rooted


def pair_by_stem(images: DataFrame, labels: DataFrame, stem: str = "stem") -> DataFrame:
    """Full outer join by exact stem with ``issue``: missing_json, missing_image or null."""
    left = images.withColumn("_image", F.lit(True))
    right = labels.withColumn("_label", F.lit(True))
    joined = left.join(right, stem, "full_outer")
    return joined.withColumn("issue", F.when(F.col("_label").isNull(), "missing_json").when(F.col("_image").isNull(), "missing_image")).drop("_image", "_label")


def with_metadata(rows: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Left join by exact key with ``issue`` where nothing is found; folded keys must be unique in ``metadata``."""
    found = metadata.withColumn("_found", F.lit(True))
    return rows.join(found, key, "left").withColumn("issue", F.when(F.col("_found").isNull(), "source_manifest_missing_exact_stem")).drop("_found")


def with_override(rows: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Values of ``overrides`` win; a key with several different ones gets ``issue`` and keeps its own."""
    one = overrides.groupBy(key).agg(F.min(value).alias("_new"), F.countDistinct(value).alias("_n"))
    joined = rows.join(one, key, "left")
    clash = F.coalesce(F.col("_n") > 1, F.lit(False))
    return joined.withColumn(value, F.when(clash, F.col(value)).otherwise(F.coalesce("_new", value))).withColumn("issue", F.when(clash, "conflicting_caption_overrides")).drop("_new", "_n")


def resolve_references(entries: DataFrame, listing: DataFrame, root: str) -> DataFrame:
    """Resolve rows ``entry, filename, source_path, directory`` against a listing ``path``: ``entry, path, resolution``.

    First the existing paths within ``root`` that the entry names: an absolute file name, one of
    several parts below the root, or the base name below the root's ``source_path`` directory. One
    is taken, several are ambiguous. With none the lower-cased base name decides, if it is unique.
    """
    base = F.lit(root)
    name = F.replace(F.col("filename"), F.lit("\\"), F.lit("/"))
    where = F.replace(F.col("source_path"), F.lit("\\"), F.lit("/"))
    multi = name.contains("/")
    options = F.array_compact(
        F.array(
            F.when(multi, rooted(name, base)),
            F.when(where.isNotNull() & (where != ""), F.concat(rooted(F.rtrim(where, F.lit("/")), base), F.lit("/"), basename(name))),
        )
    )
    blank = F.coalesce(F.trim("filename"), F.lit("")) == ""
    known = entries.select("entry", F.when(blank, True).otherwise(False).alias("blank"), casefolded(basename(F.coalesce("filename", F.lit("")))).alias("folded"), F.array_distinct(options).alias("options"))
    listed = listing.select("path").distinct()
    direct = known.where("not blank").select("entry", F.explode("options").alias("path")).where(contained(F.col("path"), base)).join(listed, "path").groupBy("entry").agg(F.count("*").alias("n_direct"), F.min("path").alias("direct"))
    by_name = listed.groupBy(casefolded(basename(F.col("path"))).alias("folded")).agg(F.count("*").alias("n_named"), F.min("path").alias("named"))
    joined = known.join(direct, "entry", "left").join(by_name, "folded", "left")
    resolution = (
        F.when(F.col("blank"), "missing_image_reference")
        .when(F.col("n_direct") == 1, "referenced_path")
        .when(F.col("n_direct") > 1, "ambiguous_referenced_paths")
        .when(F.col("n_named") == 1, "unique_exact_basename")
        .when(F.col("n_named") > 1, "ambiguous_exact_basename")
        .otherwise("image_not_found")
    )
    out = joined.withColumn("resolution", resolution)
    path = F.when(F.col("resolution") == "referenced_path", F.col("direct")).when(F.col("resolution") == "unique_exact_basename", F.col("named"))
    return out.select("entry", path.alias("path"), "resolution")
