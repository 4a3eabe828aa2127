"""Registered queries: each operator on the table that stands in for its own, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as fa
from ..functions import text as ft
from ..functions.identity import identity_keys
from ..functions.isbn import canonical_isbn, filename_identity
from ..operators import cache, dedupe, gallery, gates, journal, lineage, resolve, schedule, select, split
from ..operators.components import group_ids, link_rows
from ..sources import tensors
from ..tables import shared_folder, stash

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SEED = 20260915


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Linking, groups and splits ---------------------------------------------------------------------

KEYS_SQL = r"""
    WITH RECURSIVE k AS (
      SELECT doc_id, 'text:' || sha256(text) AS key FROM documents
      UNION SELECT doc_id, 'letters:' || sha256(regexp_replace(lower(text), '[^a-z]', '', 'g')) FROM documents
      UNION SELECT doc_id, 'size:' || source || ':' || lang || ':' || n_chars // 100 FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL
    ), star AS (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY key) AS b FROM k),
    e AS (SELECT a, b FROM star WHERE a <> b UNION SELECT b, a FROM star WHERE a <> b),
    r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS root FROM documents d LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id),
    g AS (SELECT root, substr(sha256(string_agg(key, chr(10) ORDER BY key)), 1, 24) AS group_id FROM (SELECT DISTINCT root, key FROM c JOIN k USING (doc_id)) GROUP BY root),
    s AS (
      SELECT doc_id, root, group_id, ('0x' || substr(sha256('20260915:' || group_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS draw
      FROM c JOIN g USING (root)
    ), t AS (SELECT *, CASE WHEN draw < 0.1 THEN 'test' WHEN draw < 0.2 THEN 'validation' ELSE 'train' END AS split FROM s)
"""


def document_keys(docs: DataFrame) -> DataFrame:
    """``vertex, key``: documents are one if their texts, the letters of these, or source, language and length in hundreds agree."""
    keys = F.array_compact(
        F.array(
            F.concat(F.lit("text:"), ft.digest(F.col("text"))),
            F.concat(F.lit("letters:"), ft.digest(F.regexp_replace(F.lower("text"), "[^a-z]", ""))),
            F.concat(F.lit("size:"), "source", F.lit(":"), "lang", F.lit(":"), F.expr("n_chars div 100").cast("string")),
        )
    )
    return docs.select(F.col("doc_id").alias("vertex"), F.explode(keys).alias("key"))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, root, group_id, split`` of all documents."""
    keyed = stash(document_keys(table(spark, sf_dir, "documents")), "keyed")
    linked = stash(link_rows(keyed), "linked")
    joined = linked.join(group_ids(keyed, linked), "root", "left")
    return stash(joined.select(F.col("vertex").alias("doc_id"), "root", "group_id", split.split_of(SEED, F.col("group_id")).alias("split")), "grouped")


@query(KEYS_SQL + "SELECT doc_id, group_id, split FROM t")
def group_split(spark, sf_dir):
    return grouped(spark, sf_dir).select("doc_id", "group_id", "split")


ANCHORS_SQL = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'test' WHEN quality = 0 THEN 'validation' END AS tag FROM labels"


def anchored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = grouped(spark, sf_dir)
    tag = F.when(F.col("toxic") == 1, "test").when(F.col("quality") == 0, "validation")
    anchors = table(spark, sf_dir, "labels").select("doc_id", tag.alias("split")).where("split is not null")
    return rows, split.inherited(anchors.join(rows.select("doc_id", "root"), "doc_id").select("root", "split"))


@query(
    KEYS_SQL
    + f""", an AS (SELECT root, tag FROM ({ANCHORS_SQL}) JOIN c USING (doc_id) WHERE tag IS NOT NULL),
    i AS (SELECT root, max_by(tag, CASE tag WHEN 'test' THEN 2 WHEN 'validation' THEN 1 ELSE 0 END) AS tag FROM an GROUP BY root)
    SELECT doc_id, group_id, coalesce(i.tag, split) AS split, i.tag IS NOT NULL AS inherited FROM t LEFT JOIN i USING (root)"""
)
def group_split_inherited(spark, sf_dir):
    rows, tags = anchored(spark, sf_dir)
    return rows.join(tags, "root", "left").select("doc_id", "group_id", F.coalesce("inherited", "split").alias("split"), F.col("inherited").isNotNull().alias("inherited"))


@query(
    KEYS_SQL
    + f""", an AS (SELECT root, tag FROM ({ANCHORS_SQL}) JOIN c USING (doc_id) WHERE tag IS NOT NULL)
    SELECT g.group_id, string_agg(DISTINCT tag, ',' ORDER BY tag) AS existing_splits, max_by(tag, CASE tag WHEN 'test' THEN 2 WHEN 'validation' THEN 1 ELSE 0 END) AS selected
    FROM an JOIN g USING (root) GROUP BY g.group_id HAVING count(DISTINCT tag) > 1"""
)
def mixed_splits(spark, sf_dir):
    rows, tags = anchored(spark, sf_dir)
    names = rows.select("root", "group_id").distinct()
    return tags.where("mixed").join(names, "root").select("group_id", F.concat_ws(",", "tags").alias("existing_splits"), F.col("inherited").alias("selected"))


@query(KEYS_SQL + "SELECT group_id, count(*) AS n_rows FROM t GROUP BY group_id")
def component_sizes(spark, sf_dir):
    return grouped(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("n_rows"))


@query(
    r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:]+)', 1)) AS host FROM pages)
    SELECT substr(sha256('host:' || host), 1, 20) AS group_id, count(*) AS n_rows, min(page_id) AS first_page FROM h GROUP BY host"""
)
def page_groups(spark, sf_dir):
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:]+)", 1))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("vertex"), F.concat(F.lit("host:"), host).alias("key"))
    linked = stash(link_rows(pages), "linked")
    return linked.join(group_ids(pages, linked, 20), "root").groupBy("group_id").agg(F.count("*").alias("n_rows"), F.min("vertex").alias("first_page"))


BY_ID_SQL = "SELECT *, sha256(text) AS text_sha, CASE WHEN ('0x' || substr(sha256('20260915:' || doc_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.1 THEN 'test' WHEN ('0x' || substr(sha256('20260915:' || doc_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.2 THEN 'validation' ELSE 'train' END AS split FROM documents"


def by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split by their own id, so that copies do straddle splits."""
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("text_sha", ft.digest(F.col("text"))).withColumn("split", split.split_of(SEED, F.col("doc_id").cast("string")))


@query(
    f"""WITH s AS ({BY_ID_SQL}), k AS (SELECT 'source' AS key, source AS value, split FROM s UNION ALL SELECT 'text_sha', text_sha, split FROM s)
    SELECT key, value, count(DISTINCT split) AS splits FROM k WHERE value IS NOT NULL GROUP BY key, value HAVING count(DISTINCT split) > 1"""
)
def leakage_check(spark, sf_dir):
    return split.leaks(by_id(spark, sf_dir), ["source", "text_sha"])


@query(KEYS_SQL + ", l AS (SELECT group_id AS value, count(DISTINCT split) AS splits FROM t GROUP BY 1) SELECT 'group_id' AS key, value, splits FROM l WHERE splits > 1")
def leakage_of_groups(spark, sf_dir):
    return split.leaks(grouped(spark, sf_dir), ["group_id"])


@query(
    KEYS_SQL
    + """, o AS (SELECT group_id AS value, CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'validation' ELSE 'train' END AS split FROM t)
    SELECT 'group_id' AS key, value, count(DISTINCT split) AS splits FROM o GROUP BY value HAVING count(DISTINCT split) > 1"""
)
def leakage_of_rows_split_apart(spark, sf_dir):
    """What a split by row numbers tears apart: groups whose rows lie in several splits."""
    turn = F.col("doc_id") % 10
    rows = grouped(spark, sf_dir).withColumn("split", F.when(turn == 0, "test").when(turn == 1, "validation").otherwise("train"))
    return split.leaks(rows, ["group_id"])


@query(
    f"""WITH s AS ({BY_ID_SQL}) SELECT doc_id, split FROM s WHERE split <> 'train'
    AND (text_sha IN (SELECT text_sha FROM s WHERE split = 'train') OR n_chars IN (SELECT n_chars FROM s WHERE split = 'train'))"""
)
def heldout_overlap(spark, sf_dir):
    rows = by_id(spark, sf_dir).select("doc_id", "split", "text_sha", "n_chars")
    return split.overlap(rows.where("split != 'train'"), rows.where("split = 'train'"), "n_chars", "text_sha").select("doc_id", "split")


@query(
    KEYS_SQL
    + """SELECT n AS split, count(doc_id) AS n_rows, count(DISTINCT group_id) AS n_groups
    FROM (VALUES ('train'), ('validation'), ('test')) AS v(n) LEFT JOIN t ON t.split = n GROUP BY n"""
)
def split_counts(spark, sf_dir):
    return split.split_report(grouped(spark, sf_dir))


# Duplicates and conflicts -----------------------------------------------------------------------

DUPES_SQL = "SELECT doc_id, sha256(text) AS content, lang || '/' || source AS caption FROM documents"


def captioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as images: the text's digest is the content, language and source the caption."""
    return table(spark, sf_dir, "documents").select("doc_id", ft.digest(F.col("text")).alias("content"), F.concat_ws("/", "lang", "source").alias("caption"))


@query(f"SELECT content, count(*) AS n_rows, count(DISTINCT caption) AS n_captions FROM ({DUPES_SQL}) GROUP BY content HAVING count(DISTINCT caption) > 1")
def conflict_groups(spark, sf_dir):
    return dedupe.caption_conflicts(captioned(spark, sf_dir), "content", "caption")


@query(
    f"""WITH d AS ({DUPES_SQL}), f AS (SELECT content, count(DISTINCT caption) AS n, min(doc_id) AS first_id FROM d GROUP BY content)
    SELECT doc_id, CASE WHEN n > 1 THEN 'same_image_conflicting_captions' WHEN doc_id <> first_id THEN 'duplicate_image_same_caption' END AS reason FROM d JOIN f USING (content)"""
)
def conflict_exclusion(spark, sf_dir):
    return dedupe.resolve_duplicates(captioned(spark, sf_dir), "content", "caption", "doc_id").select("doc_id", "reason")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS content FROM documents GROUP BY text")
def exact_dedup(spark, sf_dir):
    rows = captioned(spark, sf_dir).withColumn("caption", F.lit("one"))
    return dedupe.resolve_duplicates(rows, "content", "caption", "doc_id").where("reason is null").select("doc_id", "content")


@query(
    f"""WITH g AS (SELECT content, count(*) AS n, count(DISTINCT caption) AS c FROM ({DUPES_SQL}) GROUP BY content HAVING count(*) > 1)
    SELECT count(*) AS n_groups, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows, count(*) FILTER (c > 1) AS alternative_caption_groups, coalesce(sum(n - c), 0)::BIGINT AS same_caption_extras FROM g"""
)
def dup_stats(spark, sf_dir):
    return dedupe.duplicate_statistics(captioned(spark, sf_dir), "content", "caption")


@query(
    """WITH n AS (SELECT CASE WHEN doc_id % 3 = 0 THEN upper(source) ELSE source END || '-' || lang AS name FROM documents)
    SELECT lower(name) AS folded, count(DISTINCT name) AS n_names FROM n GROUP BY 1 HAVING count(DISTINCT name) > 1"""
)
def casefold_collisions(spark, sf_dir):
    source = F.when(F.col("doc_id") % 3 == 0, F.upper("source")).otherwise(F.col("source"))
    return dedupe.folded_collisions(table(spark, sf_dir, "documents").select(F.concat(source, F.lit("-"), "lang").alias("name")), "name")


# References and joins ---------------------------------------------------------------------------


@query(
    r"""WITH p AS (SELECT page_id, '/root/' || regexp_replace(url, '^[a-z]+://', '') AS path FROM pages),
    l AS (SELECT DISTINCT path FROM p),
    n AS (SELECT lower(regexp_extract(path, '([^/]*)$', 1)) AS folded, count(*) AS n, min(path) AS named FROM l GROUP BY 1),
    e AS (SELECT page_id AS entry, CASE page_id % 3 WHEN 0 THEN regexp_extract(path, '([^/]*)$', 1) WHEN 1 THEN path ELSE 'no/' || page_id || '.jpg' END AS filename FROM p),
    d AS (SELECT e.entry, l.path FROM e JOIN l ON contains(filename, '/') AND l.path = CASE WHEN starts_with(filename, '/') THEN filename ELSE '/root/' || filename END)
    SELECT e.entry, CASE WHEN trim(filename) = '' THEN NULL WHEN d.path IS NOT NULL THEN d.path WHEN n.n = 1 THEN n.named END AS path,
      CASE WHEN trim(filename) = '' THEN 'missing_image_reference' WHEN d.path IS NOT NULL THEN 'referenced_path' WHEN n.n = 1 THEN 'unique_exact_basename'
        WHEN n.n > 1 THEN 'ambiguous_exact_basename' ELSE 'image_not_found' END AS resolution
    FROM e LEFT JOIN d USING (entry) LEFT JOIN n ON n.folded = lower(regexp_extract(filename, '([^/]*)$', 1))"""
)
def basename_resolution(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/root/"), F.regexp_replace("url", "^[a-z]+://", "")).alias("path"))
    name = F.when(F.col("page_id") % 3 == 0, ft.basename(F.col("path"))).when(F.col("page_id") % 3 == 1, F.col("path")).otherwise(F.concat(F.lit("no/"), F.col("page_id").cast("string"), F.lit(".jpg")))
    entries = pages.select(F.col("page_id").alias("entry"), name.alias("filename"), F.lit(None).cast("string").alias("source_path"))
    return resolve.resolve_references(entries, pages, "/root")


@query("SELECT coalesce(d.doc_id, l.doc_id) AS stem, CASE WHEN l.doc_id IS NULL THEN 'missing_json' WHEN d.doc_id IS NULL THEN 'missing_image' END AS issue FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id")
def exact_pair_join(spark, sf_dir):
    images, found = (table(spark, sf_dir, t).select(F.col("doc_id").alias("stem")) for t in ("documents", "labels"))
    return resolve.pair_by_stem(images, found).select("stem", "issue")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def stem_difference(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def stem_intersection(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").intersect(table(spark, sf_dir, "labels").select("doc_id"))


@query(
    """SELECT o_orderkey, c_name, CASE WHEN c_custkey IS NULL THEN 'source_manifest_missing_exact_stem' END AS issue
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey"""
)
def metadata_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("stem"))
    metadata = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("stem"), "c_name")
    return resolve.with_metadata(orders, metadata, "stem").select("o_orderkey", "c_name", "issue")


@query(
    """WITH o AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'override toxic' ELSE 'override' END AS caption FROM labels WHERE quality = 0
      UNION ALL SELECT doc_id, 'second' FROM labels WHERE quality = 0 AND toxic = 1),
    f AS (SELECT doc_id, min(caption) AS caption, count(DISTINCT caption) AS n FROM o GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN f.n > 1 THEN d.source ELSE coalesce(f.caption, d.source) END AS caption, CASE WHEN f.n > 1 THEN 'conflicting_caption_overrides' END AS issue
    FROM documents d LEFT JOIN f USING (doc_id)"""
)
def override_join(spark, sf_dir):
    low = table(spark, sf_dir, "labels").where("quality = 0")
    first = low.select("doc_id", F.when(F.col("toxic") == 1, "override toxic").otherwise("override").alias("caption"))
    second = low.where("toxic = 1").select("doc_id", F.lit("second").alias("caption"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("caption"))
    return resolve.with_override(rows, first.unionByName(second), "doc_id", "caption").select("doc_id", "caption", "issue")


@query("SELECT doc_id, caption, seed, condition FROM (SELECT doc_id, source AS caption FROM documents), (VALUES (17::BIGINT), (18)) s(seed), (VALUES ('base'), ('adapted')) c(condition)")
def condition_cross(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("caption"))
    return select.conditions(rows, ["base", "adapted"], [17, 18]).select("doc_id", "caption", "seed", "condition")


# Scalar functions -------------------------------------------------------------------------------


def odd_captions(doc_id: Column, text: Column) -> Column:
    """Captions with the faults that the documents lack, by turns."""
    turn = F.pmod(doc_id, F.lit(8))
    return (
        F.when(turn == 0, F.lit("  "))
        .when(turn == 1, F.concat(F.lit("{"), text))
        .when(turn == 2, F.concat(F.lit("Note: "), text))
        .when(turn == 3, F.concat(text, F.lit(" 한글")))
        .when(turn == 4, F.lit("1234"))
        .when(turn == 5, F.concat(text, F.lit(" <|end|>")))
        .when(turn == 6, F.concat(text, F.lit(" кириллица")))
        .otherwise(text)
    )


ODD_SQL = """SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '  ' WHEN 1 THEN '{' || text WHEN 2 THEN 'Note: ' || text WHEN 3 THEN text || ' 한글' WHEN 4 THEN '1234'
    WHEN 5 THEN text || ' <|end|>' WHEN 6 THEN text || ' кириллица' ELSE text END AS caption FROM documents"""


@query(
    rf"""WITH o AS ({ODD_SQL})
    SELECT doc_id,
      CASE WHEN trim(caption) = '' THEN 'caption_not_nonempty_string' ELSE concat_ws(',',
        CASE WHEN NOT regexp_matches(caption, '\p{{Latin}}') THEN 'caption_has_no_latin_letters' END,
        CASE WHEN regexp_matches(caption, '[^\P{{L}}\p{{Latin}}]') THEN 'caption_contains_non_latin_script' END,
        CASE WHEN regexp_matches(caption, '(?i)</?think>|```|<\||(?:^|\n)\s*(?:translation|english translation|note|explanation)\s*:') THEN 'caption_contains_translation_metadata' END,
        CASE WHEN regexp_matches(caption, '^\s*[{{\[]') THEN 'caption_contains_nested_structure' END) END AS issues,
      regexp_matches(caption, '[A-Za-z]') AND NOT regexp_matches(caption, '[\x{{1100}}-\x{{11FF}}\x{{3130}}-\x{{318F}}\x{{AC00}}-\x{{D7AF}}]') AS cacheable,
      trim(caption) <> '' AND regexp_matches(caption, '[A-Za-z]')
        AND NOT regexp_matches(caption, '[\x{{1100}}-\x{{11FF}}\x{{3040}}-\x{{30FF}}\x{{3130}}-\x{{318F}}\x{{3400}}-\x{{4DBF}}\x{{4E00}}-\x{{9FFF}}\x{{AC00}}-\x{{D7AF}}]')
        AND NOT regexp_matches(caption, '<\||\|>|<think>|</think>|```') AS promptable
    FROM o"""
)
def caption_screens(spark, sf_dir):
    caption = F.col("caption")
    rows = table(spark, sf_dir, "documents").select("doc_id", odd_captions(F.col("doc_id"), F.col("text")).alias("caption"))
    return rows.select("doc_id", F.concat_ws(",", ft.english_issues(caption)).alias("issues"), ft.cache_screen(caption).alias("cacheable"), ft.prompt_screen(caption).alias("promptable"))


ISBN_SQL = r"""
    WITH b AS (SELECT p_partkey, lpad((p_partkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS body FROM part),
    r AS (SELECT p_partkey, body, list_sum(list_transform(range(1, 10), lambda i: substr(body, i, 1)::INT * (11 - i))) AS s FROM b),
    v AS (SELECT p_partkey, body, CASE p_partkey % 4 WHEN 0 THEN body || CASE (11 - s % 11) % 11 WHEN 10 THEN 'X' ELSE ((11 - s % 11) % 11)::VARCHAR END
        WHEN 1 THEN substr(body, 1, 1) || '-' || substr(body, 2) || ' ' || CASE (11 - s % 11) % 11 WHEN 10 THEN 'x' ELSE ((11 - s % 11) % 11)::VARCHAR END
        WHEN 2 THEN '978' || body || '0' ELSE body || '0' END AS isbn, s FROM r),
    w AS (SELECT *, '978' || body AS long_body FROM v),
    c AS (SELECT *, ((10 - list_sum(list_transform(range(1, 13), lambda i: substr(long_body, i, 1)::INT * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10)::BIGINT::VARCHAR AS check13 FROM w)
"""


def isbns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book numbers made of part keys: valid ISBN-10, the same with signs, ISBN-13 and ISBN-10 that end in 0."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.lpad((F.col("p_partkey") * 7919 % 1_000_000_000).cast("string"), 9, "0").alias("body"))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), lambda a, i: a + F.substr("body", i, F.lit(1)).cast("int") * (11 - i))
    check = (11 - total % 11) % 11
    sign = lambda x: F.when(check == 10, F.lit(x)).otherwise(check.cast("string"))
    turn = F.col("p_partkey") % 4
    isbn = (
        F.when(turn == 0, F.concat("body", sign("X")))
        .when(turn == 1, F.concat(F.substring("body", 1, 1), F.lit("-"), F.substr("body", F.lit(2)), F.lit(" "), sign("x")))
        .when(turn == 2, F.concat(F.lit("978"), "body", F.lit("0")))
        .otherwise(F.concat("body", F.lit("0")))
    )
    return parts.select("p_partkey", "body", isbn.alias("isbn"))


@query(
    ISBN_SQL
    + """SELECT p_partkey, isbn, CASE WHEN p_partkey % 4 < 2 THEN long_body || check13 WHEN p_partkey % 4 = 2 THEN CASE WHEN check13 = '0' THEN isbn END
      ELSE CASE WHEN s % 11 = 0 THEN long_body || check13 END END AS canonical_isbn FROM c"""
)
def isbn_canonical(spark, sf_dir):
    return isbns(spark, sf_dir).select("p_partkey", "isbn", canonical_isbn(F.col("isbn")).alias("canonical_isbn"))


@query(
    ISBN_SQL
    + """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN upper(isbn) END AS isbn, CASE WHEN p_partkey % 4 = 0 THEN long_body || check13 END AS canonical_isbn,
      CASE WHEN p_partkey % 4 = 0 THEN p_partkey::VARCHAR END AS record FROM c WHERE p_partkey % 4 IN (0, 1)"""
)
def stem_identity(spark, sf_dir):
    stem = F.concat(F.lit("01_02T_03S_"), F.col("isbn"), F.lit("_"), F.col("p_partkey").cast("string"))
    # every other valid number has a space, which no stem may have
    rows = isbns(spark, sf_dir).where("p_partkey % 4 in (0, 1)").select("p_partkey", filename_identity(stem).alias("x"))
    return rows.select("p_partkey", "x.isbn", "x.canonical_isbn", "x.record")


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN json_valid(props) ELSE event_id % 5 = 4 END AS strict, event_id % 5 = 4 AS caption_only, event_id % 5 = 1 AS repeats_key FROM events"""
)
def json_strict(spark, sf_dir):
    turn = F.col("event_id") % 5
    document = (
        F.when(turn == 0, F.col("props"))
        .when(turn == 1, F.lit('{"a": 1, "a": 2}'))
        .when(turn == 2, F.lit('{"a": {"b": 1, "b": 2}}'))
        .when(turn == 3, F.lit('{"imageCaption": NaN}'))
        .otherwise(F.lit('{"imageCaption": "x"}'))
    )
    rows = table(spark, sf_dir, "events").select("event_id", document.alias("document"))
    return rows.select("event_id", ft.strict_object(F.col("document")).alias("strict"), ft.exact_keys(F.col("document"), "imageCaption").alias("caption_only"), F.coalesce(ft.duplicate_keys(F.col("document")), F.lit(False)).alias("repeats_key"))


@query(r"SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '(.)\.[^.]+$', '\1') AS stem, url LIKE 'http%' AS is_http FROM pages")
def source_stems(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ft.source_stem(F.col("url")).alias("stem"), F.col("url").startswith("http").alias("is_http"))


@query(
    r"""WITH i AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source || '-' || doc_id WHEN 1 THEN '../' || source ELSE upper(source) END AS id FROM documents)
    SELECT doc_id, regexp_full_match(id, '[A-Za-z0-9][A-Za-z0-9_-]{0,150}') AS safe, count(*) OVER (PARTITION BY lower(id)) > 1 AS repeated FROM i"""
)
def safe_ids(spark, sf_dir):
    turn = F.col("doc_id") % 3
    ids = F.when(turn == 0, F.concat_ws("-", "source", F.col("doc_id").cast("string"))).when(turn == 1, F.concat(F.lit("../"), "source")).otherwise(F.upper("source"))
    rows = table(spark, sf_dir, "documents").select("doc_id", ids.alias("id")).withColumn("folded", F.lower("id"))
    # counted and joined rather than windowed: one id may have very many rows
    counts = rows.groupBy("folded").agg((F.count("*") > 1).alias("repeated"))
    return rows.join(counts, "folded").select("doc_id", ft.safe_id(F.col("id")).alias("safe"), "repeated")


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages")
def html_escaped(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ft.html_escape(F.col("html")).alias("escaped"))


@query(
    """SELECT doc_id, substr(sha256(sha256(text) || chr(0) || source), 1, 24) AS id_v1,
      substr(sha256(doc_id::VARCHAR || chr(0) || sha256(source) || chr(0) || sha256(text)), 1, 24) AS id_v2 FROM documents"""
)
def record_ids(spark, sf_dir):
    sha = ft.digest(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", lineage.record_id_v1(sha, F.col("source")).alias("id_v1"), lineage.record_id_v2(F.col("doc_id").cast("string"), ft.digest(F.col("source")), sha).alias("id_v2"))


@query(
    r"""SELECT doc_id, regexp_replace(lower('Draw: ' || text), '^\s+|\s+$', '', 'g') AS prompt,
      len(regexp_extract_all('Draw: ' || text, '[^\s\x0B]+'))::BIGINT AS tokens, len(regexp_extract_all('Draw: ' || text, '[^\s\x0B]+')) > 512 AS over_length FROM documents"""
)
def prompt_lengths(spark, sf_dir):
    prompt = ft.prompt_text("Draw: ", F.col("text"))
    tokens = ft.proxy_tokens(prompt).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"), tokens.alias("tokens"), (tokens > 512).alias("over_length"))


# Reports ----------------------------------------------------------------------------------------


@query(
    rf"""WITH o AS ({ODD_SQL}), r AS (SELECT CASE WHEN trim(caption) = '' THEN 'empty_caption' WHEN NOT regexp_matches(caption, '[A-Za-z]') THEN 'no_letter'
      WHEN regexp_matches(caption, '^\s*[{{\[]') THEN 'looks_like_json' END AS reason FROM o)
    SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason"""
)
def reason_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(odd_captions(F.col("doc_id"), F.col("text")).alias("caption"))
    reason = gates.first_reason([("empty_caption", ft.squeezed(F.col("caption")) == ""), ("no_letter", ~F.col("caption").rlike("[A-Za-z]")), ("looks_like_json", F.col("caption").rlike(r"^\s*[{\[]"))])
    return gates.reason_counts(rows.select(reason.alias("reason")))


@query("SELECT count(*) AS n_rows, count(*) FILTER (n_chars > 5000) AS n_large, count(*) FILTER (lang <> 'en') AS n_not_english, count(DISTINCT source) AS n_sources FROM documents")
def conditional_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.agg(F.count("*").alias("n_rows"), F.count_if(F.col("n_chars") > 5000).alias("n_large"), F.count_if(F.col("lang") != "en").alias("n_not_english"), F.countDistinct("source").alias("n_sources"))


@query(
    f"""WITH s AS ({BY_ID_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sha256(doc_id::VARCHAR), doc_id) AS k FROM s),
    c AS (SELECT *, split = 'test' OR k <= CASE split WHEN 'train' THEN 40 ELSE 20 END AS taken FROM r)
    SELECT split, count(*) AS source_count, count(*) FILTER (taken) AS selected_count, count(*) > count(*) FILTER (taken) AS limited,
      (sum(len(regexp_extract_all(text, '[^\\s\\x0B]+')) * 2304 * 2 + 32 * 256 * 2 + 8192) FILTER (taken))::BIGINT AS estimated_bytes FROM c GROUP BY split""".replace("\\\\", "\\")
)
def cache_estimate(spark, sf_dir):
    rows = by_id(spark, sf_dir).select("doc_id", "split", ft.proxy_tokens(F.col("text")).alias("tokens"))
    taken = select.top_per_split(rows, "doc_id", {"train": 40, "validation": 20})
    chosen = taken.groupBy("split").agg(F.count("*").alias("selected_count"), F.sum(fa.latent_bytes(F.col("tokens"), 2304, 512)).alias("estimated_bytes"))
    counts = rows.groupBy("split").agg(F.count("*").alias("source_count"))
    return counts.join(chosen, "split", "left").select("split", "source_count", "selected_count", (F.col("source_count") > F.col("selected_count")).alias("limited"), "estimated_bytes")


# Selection --------------------------------------------------------------------------------------


@query(
    f"""WITH s AS ({BY_ID_SQL}), r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY sha256(doc_id::VARCHAR), doc_id) AS k FROM s)
    SELECT doc_id, split FROM r WHERE split = 'test' OR k <= CASE split WHEN 'train' THEN 40 ELSE 20 END"""
)
def hash_topk_per_split(spark, sf_dir):
    return select.top_per_split(by_id(spark, sf_dir).select("doc_id", "split"), "doc_id", {"train": 40, "validation": 20})


@query(
    """WITH h AS (SELECT doc_id, source, sha256(doc_id::VARCHAR) AS h FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) > 1 AS later FROM h)
    SELECT doc_id, source FROM r ORDER BY later, h, doc_id LIMIT 50"""
)
def diverse_topk(spark, sf_dir):
    return select.diverse(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", "source", 50)


@query("SELECT doc_id, 20260915 + row_number() OVER (ORDER BY doc_id) - 1 AS seed FROM documents")
def seed_assign(spark, sf_dir):
    return select.running_seed(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SEED).select("doc_id", "seed")


@query("SELECT doc_id, ('0x' || substr(sha256('42:' || doc_id), 1, 15))::BIGINT AS noise_seed FROM documents")
def noise_seeds(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", select.noise_seed(42, F.col("doc_id")).alias("noise_seed"))


# Features ---------------------------------------------------------------------------------------

MASK_SQL = "SELECT vec_id, embedding, list_transform(range(1, 65), lambda i: CASE WHEN i <= vec_id % 64 AND (i + vec_id) % 3 > 0 THEN 1 ELSE 0 END) AS mask FROM embeddings"


def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.when((i <= F.col("vec_id") % 64) & ((i + F.col("vec_id")) % 3 > 0), 1).otherwise(0))
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", mask.alias("mask"))


@query(
    f"""WITH m AS ({MASK_SQL}), n AS (SELECT *, greatest(1, list_max(list_transform(range(1, 65), lambda i: CASE WHEN mask[i] = 1 THEN i ELSE 1 END))) AS k FROM m)
    SELECT vec_id, k::BIGINT AS length, round(list_sum(list_transform(embedding[1:k], lambda x: x::DOUBLE)), 6) AS kept_sum, list_sum(mask[1:k])::BIGINT AS attended FROM n"""
)
def trim_mask(spark, sf_dir):
    rows = masked(spark, sf_dir).select("vec_id", fa.trim_to_mask(F.col("embedding"), F.col("mask")).alias("e"), fa.trim_to_mask(F.col("mask"), F.col("mask")).alias("m"))
    total = lambda c, zero: F.aggregate(c, zero, lambda a, x: a + x)
    return rows.select("vec_id", F.size("e").cast("long").alias("length"), F.round(total("e", F.lit(0.0)), 6).alias("kept_sum"), total("m", F.lit(0)).cast("long").alias("attended"))


@query(
    """SELECT vec_id, (64 - vec_id % 5)::BIGINT AS positive_length, greatest(64 - vec_id % 5, 61)::BIGINT AS padded_length,
      (greatest(64 - vec_id % 5, 61) - 61)::BIGINT AS negative_padding FROM embeddings"""
)
def cfg_pad(spark, sf_dir):
    n = (64 - F.col("vec_id") % 5).cast("int")
    positive, negative = F.slice("embedding", F.lit(1), n), F.slice("embedding", 1, 61)
    ones = lambda c: F.transform(c, lambda _: F.lit(1))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", n.alias("n"), fa.guidance(positive, ones(positive), negative, ones(negative), F.lit(0.0).cast("float")).alias("x"))
    zeros = F.size(F.filter("x.negative_mask", lambda m: m == 0))
    return rows.select("vec_id", F.col("n").cast("long").alias("positive_length"), F.size("x.negative").cast("long").alias("padded_length"), zeros.cast("long").alias("negative_padding"))


@query(
    f"""WITH m AS ({MASK_SQL}) SELECT vec_id, vec_id % 7 <> 0 AS finite, vec_id % 7 <> 0 AND list_contains(mask, 1) AS valid FROM m"""
)
def finite_check(spark, sf_dir):
    bad = F.when(F.col("vec_id") % 14 == 0, F.lit(float("nan"))).when(F.col("vec_id") % 7 == 0, F.lit(float("inf")))
    rows = masked(spark, sf_dir).select("vec_id", "mask", F.transform("embedding", lambda x, i: F.when(i == 3, F.coalesce(bad, x.cast("double"))).otherwise(x.cast("double"))).alias("e"))
    return rows.select("vec_id", fa.all_finite(F.col("e")).alias("finite"), fa.valid_text_features(F.transform("e", lambda x: F.array(x)), F.col("mask")).alias("valid"))


FLOW_SQL = "SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS clean, list_transform(list_reverse(embedding), lambda x: x::DOUBLE) AS noise, (vec_id % 10) / 10.0::DOUBLE AS s FROM embeddings"


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = lambda c: F.transform(c, lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", wide("embedding").alias("clean"), wide(F.reverse("embedding")).alias("noise"), ((F.col("vec_id") % 10) / 10.0).alias("s"))


@query(
    f"""WITH f AS ({FLOW_SQL}) SELECT vec_id, round((1 - s) * clean[1] + s * noise[1], 6) AS noisy_first, round(noise[1] - clean[1], 6) AS target_first, round(s * 1000, 6) AS timestep FROM f"""
)
def flow_mix(spark, sf_dir):
    noisy, target = fa.flow_noisy(F.col("clean"), F.col("noise"), F.col("s")), fa.flow_target(F.col("clean"), F.col("noise"))
    return flows(spark, sf_dir).select("vec_id", F.round(noisy[0], 6).alias("noisy_first"), F.round(target[0], 6).alias("target_first"), F.round(F.col("s") * 1000, 6).alias("timestep"))


@query(
    f"""WITH f AS ({FLOW_SQL}) SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: pow(clean[i] - noise[i], 2))) / 64, 5) AS loss FROM f"""
)
def flow_mse(spark, sf_dir):
    return flows(spark, sf_dir).select("vec_id", F.round(fa.mse(F.col("clean"), F.col("noise")), 5).alias("loss"))


@query(
    f"""WITH f AS ({FLOW_SQL}), l AS (SELECT vec_id % 10 AS bucket, list_sum(list_transform(range(1, 65), lambda i: pow(clean[i] - noise[i], 2))) / 64 AS loss FROM f)
    SELECT bucket, round(avg(loss), 4) AS mean_loss, count(*) AS n FROM l GROUP BY bucket"""
)
def mean_loss(spark, sf_dir):
    rows = flows(spark, sf_dir).select((F.col("vec_id") % 10).alias("bucket"), fa.mse(F.col("clean"), F.col("noise")).alias("loss"))
    return rows.groupBy("bucket").agg(F.round(F.avg("loss"), 4).alias("mean_loss"), F.count("*").alias("n"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 0.41407)), 5) AS scaled_sum FROM embeddings")
def latent_scaling(spark, sf_dir):
    values = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.aggregate(fa.scaled(values, 0.41407), F.lit(0.0), lambda a, x: a + x), 5).alias("scaled_sum"))


@query(
    """WITH d AS (SELECT p_partkey, 1 + p_partkey % 997 AS w, 1 + p_partkey * 31 % 1009 AS h FROM part),
    f AS (SELECT *, greatest(1, least(512, round_even(w * least(512 / w, 512 / h), 0)))::INT AS fw, greatest(1, least(512, round_even(h * least(512 / w, 512 / h), 0)))::INT AS fh FROM d)
    SELECT p_partkey, fw AS fitted_width, fh AS fitted_height, ((512 - fw) // 2)::INT AS offset_left, ((512 - fh) // 2)::INT AS offset_top FROM f"""
)
def letterbox_geometry(spark, sf_dir):
    w, h = 1 + F.col("p_partkey") % 997, 1 + F.col("p_partkey") * 31 % 1009
    rows = table(spark, sf_dir, "part").select("p_partkey", fa.letterbox(w, h, 512).alias("x"))
    return rows.select("p_partkey", F.col("x.width").alias("fitted_width"), F.col("x.height").alias("fitted_height"), F.col("x.left").alias("offset_left"), F.col("x.top").alias("offset_top"))


@query(
    """SELECT s::BIGINT AS step, round(0.0001 * least(1.0, s / 50.0) * least(1.0, greatest(0.1, (1000 - s + 1) / 950.0)), 12) AS lr FROM range(1, 1001) t(s)"""
)
def lr_schedule(spark, sf_dir):
    return schedule.learning_rates(spark, 1000, 50, 1e-4).select("step", F.round("lr", 12).alias("lr"))


@query(
    """WITH RECURSIVE g AS (SELECT n, w, greatest(1, (n + w - 1) // w) AS d FROM (SELECT n, (floor(sqrt(n - 1)) + 1)::BIGINT AS w FROM (SELECT max(c_custkey) + 1 AS n FROM customer))),
    walk(id, l, r, k) AS (
      SELECT c_custkey, c_custkey // d, c_custkey % d, 0 FROM customer, g
      UNION ALL
      SELECT id, CASE WHEN k % 2 = 0 THEN (l + ('0x' || substr(sha256('42:3:' || k % 4 || ':' || r), 1, 15))::BIGINT) % w ELSE l END,
        CASE WHEN k % 2 = 1 THEN (r + ('0x' || substr(sha256('42:3:' || k % 4 || ':' || l), 1, 15))::BIGINT) % d ELSE r END, k + 1
      FROM walk, g WHERE k = 0 OR k % 4 <> 0 OR l * d + r >= n
    )
    SELECT id AS c_custkey, (l * d + r)::BIGINT AS place FROM walk, g WHERE k > 0 AND k % 4 = 0 AND l * d + r < n"""
)
def epoch_places(spark, sf_dir):
    """The places of numbered customers in an epoch; the largest number is all that is asked of the table first."""
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", select.epoch_place(F.col("c_custkey"), (rows.agg(F.max("c_custkey")).first()[0] or 0) + 1, 42, 3).alias("place"))


@query(
    """WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('42:1:' || doc_id), doc_id) - 1 AS position, count(*) OVER () AS n FROM documents)
    SELECT doc_id, 1 AS epoch, position, ((n + 7) // 8 + position // 8 + 1)::BIGINT AS step, 1.0 / least(8, n - position // 8 * 8) AS loss_weight FROM o"""
)
def batch_plan(spark, sf_dir):
    return schedule.batch_plan(table(spark, sf_dir, "documents"), "doc_id", 8, 42, 1)


# Journals and lineage ---------------------------------------------------------------------------


@query(
    """SELECT user_id AS id, arg_max(event_type, event_id) AS event_type, round(arg_max(value, event_id), 6) AS value, max(event_id) AS last_seen, min(event_id) AS first_seen FROM events GROUP BY user_id"""
)
def journal_compact(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_type", "value", "event_id", F.col("event_id").alias("last_seen"))
    return journal.compact(lines, "id", "event_id").select("id", "event_type", F.round("value", 6).alias("value"), "last_seen", "first_seen")


@query(
    """WITH j AS (SELECT user_id AS id, arg_max(event_type, event_id) AS file, max(event_id)::VARCHAR AS sha FROM events GROUP BY user_id),
    f AS (SELECT event_type AS file, event_id::VARCHAR AS sha FROM events WHERE value > 20), w AS (SELECT c_custkey AS id FROM customer)
    SELECT id FROM w WHERE id NOT IN (SELECT id FROM j JOIN f USING (file, sha))"""
)
def journal_outstanding(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    lines = events.select(F.col("user_id").alias("id"), F.col("event_type").alias("file"), F.col("event_id").cast("string").alias("sha"), "event_id")
    files = events.where("value > 20").select(F.col("event_type").alias("file"), F.col("event_id").cast("string").alias("sha"))
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return journal.outstanding(wanted, journal.compact(lines, "id", "event_id"), files, "id", "file", "sha")


@query(
    r"""WITH d AS (SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}') AS d, (doc_id * 0)::INT AS z FROM documents)
    SELECT doc_id, d AS digest FROM d"""
)
def row_digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", lineage.row_digest("source", "lang", "doc_id").alias("digest"))


@query()
def content_fingerprint(spark, sf_dir):
    return lineage.content_fingerprint(table(spark, sf_dir, "documents"), "doc_id", ["doc_id", "text", "source"])


@query(
    """SELECT count(*) AS n_rows, sha256('[' || string_agg('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","text_sha256":"' || sha256(text) || '"}', ',' ORDER BY doc_id) || ']') AS sha256 FROM documents"""
)
def content_sha256(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", ft.digest(F.col("text")).alias("text_sha256"))
    return lineage.content_sha256(rows, ["doc_id"], rows.columns)


@query("WITH f AS (SELECT url AS path, sha256(html) AS sha FROM pages) SELECT count(*) AS n_files, sha256(string_agg(path || ' ' || sha, chr(10) ORDER BY path || ' ' || sha)) AS revision FROM f")
def file_set_revision(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), ft.digest(F.col("html")).alias("sha256"))
    return lineage.file_set_digest(files)


@query(
    """WITH a AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation FROM customer),
    b AS (SELECT id, CASE WHEN id % 5 = 0 THEN 'OTHER' ELSE segment END AS segment, CASE WHEN id % 3 = 0 THEN NULL ELSE nation END AS nation FROM a)
    SELECT id, concat_ws(',', CASE WHEN a.nation IS DISTINCT FROM b.nation THEN 'nation' END, CASE WHEN a.segment IS DISTINCT FROM b.segment THEN 'segment' END) AS differing FROM a JOIN b USING (id)"""
)
def config_difference(spark, sf_dir):
    segment, nation, i = F.col("c_mktsegment"), F.col("c_nationkey").cast("string"), F.col("c_custkey")
    left = F.create_map(F.lit("segment"), segment, F.lit("nation"), nation)
    right = F.create_map(F.lit("segment"), F.when(i % 5 == 0, "OTHER").otherwise(segment), F.lit("nation"), F.when(i % 3 != 0, nation))
    return table(spark, sf_dir, "customer").select(i.alias("id"), F.concat_ws(",", lineage.differing_keys(left, right)).alias("differing"))


@query(
    r"""SELECT doc_id, concat_ws(' ', CASE WHEN doc_id % 3 = 0 THEN 'isbn:' || doc_id || 'X' END,
      'title:' || nullif(regexp_replace(lower(source || ' / ' || lang), '[^\p{L}\p{N}]', '', 'g'), ''),
      'context:' || sha256(nullif(regexp_replace(CASE WHEN doc_id % 2 = 0 THEN text ELSE source END, '\s', '', 'g'), '')),
      CASE WHEN doc_id % 5 = 0 THEN 'existing-group:' || lang END) AS keys FROM documents"""
)
def row_identities(spark, sf_dir):
    number = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Book "), F.col("doc_id").cast("string"), F.lit("-x")))
    keys = identity_keys(number, F.concat("source", F.lit(" / "), "lang"), F.when(F.col("doc_id") % 2 == 0, F.col("text")), F.col("source"), F.when(F.col("doc_id") % 5 == 0, F.col("lang")), F.col("doc_id") % 2 == 0)
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", keys).alias("keys"))


@query()
def tensor_file_digests(spark, sf_dir):
    """Embeddings written as files of tensors, 64 of them, and digested as they are read back."""
    rows = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    number = F.col("vec_id").cast("string")
    named = rows.select(F.concat(F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("string"), F.lit(".safetensors")).alias("file"), number.alias("name"), F.col("embedding").cast("array<float>").alias("values"))
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/tensors-{uuid.uuid4().hex}"
    tensors.write_tensors(tensors.vectors_as_tensors(named), folder)
    digests = tensors.tensor_file_digests(tensors.read_tensors(spark, folder))
    return digests.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "n_tensors", "digest", "error")


@query()
def tensor_digests(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", lineage.tensor_digest(F.col("vec_id").cast("string"), F.col("embedding")).alias("digest"))


@query(
    f"""WITH s AS ({BY_ID_SQL}) SELECT doc_id FROM s WHERE split = 'validation' ORDER BY sha256(doc_id::VARCHAR), doc_id LIMIT 8"""
)
def validation_first(spark, sf_dir):
    held = by_id(spark, sf_dir).where("split = 'validation'").select("doc_id")
    return held.orderBy(select.hash_order(F.col("doc_id")), "doc_id").limit(8)


@query("SELECT coalesce(tag, 'none') AS split, count(*) AS n FROM (" + ANCHORS_SQL + ") GROUP BY 1")
def prior_counts(spark, sf_dir):
    tag = F.when(F.col("toxic") == 1, "test").when(F.col("quality") == 0, "validation").otherwise("none")
    return table(spark, sf_dir, "labels").groupBy(tag.alias("split")).agg(F.count("*").alias("n"))


@query(
    """WITH o AS (SELECT doc_id, seed, condition, condition || '/' || doc_id || '_' || seed || '.png' AS image, source AS caption
      FROM documents, (VALUES (17::BIGINT), (18)) s(seed), (VALUES ('adapted'), ('base')) c(condition))
    SELECT doc_id, seed, '<div>' || string_agg('<figure><img src="' || image || '"><figcaption>' || caption || '</figcaption></figure>', '' ORDER BY condition) || '</div>' AS html
    FROM o GROUP BY doc_id, seed"""
)
def gallery_lines(spark, sf_dir):
    rows = select.conditions(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("caption")), ["base", "adapted"], [17, 18])
    image = F.concat("condition", F.lit("/"), F.col("doc_id").cast("string"), F.lit("_"), F.col("seed").cast("string"), F.lit(".png"))
    return gallery.paired_gallery(rows.withColumn("image", image), "doc_id", "seed", "condition", "image", "caption")


@query(
    """SELECT doc_id AS id, CASE doc_id % 5 WHEN 2 THEN 'feature_path_outside_cache' WHEN 4 THEN 'feature_path_outside_cache' ELSE 'missing_or_changed_feature' END AS reason
    FROM documents WHERE doc_id % 5 IN (2, 3, 4)"""
)
def feature_issues(spark, sf_dir):
    docs, number, turn = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string"), F.col("doc_id") % 5
    prefix = F.when(turn == 0, "f/").when(turn == 1, "g/.././f//").when(turn == 2, "f/../../f/").when(turn == 3, "f/").otherwise("/elsewhere/f/")
    digest = ft.digest(F.col("text"))
    records = docs.select(F.col("doc_id").alias("id"), F.concat(prefix, number).alias("feature_file"), F.when(turn == 3, "0").otherwise(digest).alias("feature_sha256"))
    return cache.feature_issues(records, docs.select(F.concat(F.lit("/cache/f/"), number).alias("path"), digest.alias("sha256")), "/cache")


@query("SELECT split, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'validation' ELSE 'train' END AS split FROM customer WHERE c_custkey % 10 <> 1) GROUP BY split")
def admitted_records(spark, sf_dir):
    split_ = F.when(F.col("c_custkey") % 10 == 0, "validation").when(F.col("c_custkey") % 10 == 1, "test").otherwise("train")
    number = F.col("c_custkey").cast("string")
    records = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ordinal"), number.alias("id"), split_.alias("split"), number.alias("group"), F.lit(None).cast("string").alias("image_sha256"), number.alias("feature_file"), number.alias("feature_sha256"))
    training, validation = cache.admit({"status": "complete"}, records)
    return training.unionByName(validation).groupBy("split").agg(F.count("*").alias("n"))


@query(
    r"""SELECT doc_id, 'In: ' || source || ' ' || lang AS prompt, len(string_split_regex(trim('In: ' || source || ' ' || lang), '\s+'))::INT AS tokens,
      7 + row_number() OVER (ORDER BY doc_id) - 1 AS seed, CASE WHEN len(string_split_regex(trim('In: ' || source || ' ' || lang), '\s+')) > 2 THEN 'prompt_too_long' END AS issue FROM documents"""
)
def prompt_audit(spark, sf_dir):
    prompts = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "source", "lang").alias("imageCaption"))
    return gallery.prompt_audit(prompts, "In: ", "imageCaption", "doc_id", 7, 2).drop("imageCaption")


@query("""SELECT doc_id, '<p>' || source || ' &lt;' || lang || '&gt;</p><img loading="lazy" src="' || doc_id || '.png">' AS html FROM documents""")
def prompt_gallery(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit(" <"), "lang", F.lit(">")).alias("imageCaption"), F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("image"))
    return gallery.prompt_gallery(rows, "imageCaption", "image", "doc_id")


@query(
    r"""SELECT page_id, '/' || array_to_string(list_filter(string_split(regexp_replace(url, '^[a-z]+://[^/]+', '') , '/'), lambda p: p <> ''), '/') AS resolved, page_id % 3 <> 1 AS inside FROM pages"""
)
def resolved_paths(spark, sf_dir):
    path = F.regexp_replace("url", "^[a-z]+://[^/]+", "")
    odd = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/x/.."), path)).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/../."), path)).otherwise(F.concat(F.lit("//"), path))
    inner = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("/root/../rooted"), path)).otherwise(F.concat(F.lit("/root/a/.."), path))
    return table(spark, sf_dir, "pages").select("page_id", ft.resolved(odd).alias("resolved"), ft.contained(inner, F.lit("/root")).alias("inside"))
