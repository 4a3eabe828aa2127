"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode
from .collocations import collocations
from .columns import WORD
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .line_dedup import line_dedup
from .mixing import mix, source_targets
from .overlap_join import similar_components
from .quality import score as score_quality
from .quality import train as train_quality
from .rules import quality_rules
from .simhash import simhash_components
from .substring_dedup import substring_dedup
from .suffix_array import suffix_array_dedup
from .toxicity import score as score_toxicity
from .toxicity import train as train_toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_chunks_removed", "n_lines_removed", F.sha2("text", 256).alias("kept_sha256"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op4 that SQL can express."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sizes = documents(spark, sf_dir).groupBy("source").agg(F.sum(size).alias("source_size"))
    return source_targets(sizes).select("source", "source_size", F.round("target", 3).alias("target"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remainder(n: int) -> Column:
    """crc32 of the id as text, modulo n: what folds are cut by."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), F.coalesce(remainder(4) == 2, F.lit(False))
    model = train_quality(docs, labels(spark, sf_dir), ~held_out)
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), F.coalesce(remainder(5) == 0, F.lit(False))
    model = train_toxicity(docs, labels(spark, sf_dir), ~held_out)
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(documents(spark, sf_dir))


def tokenizer_path() -> str:
    """The public byte-level vocabulary that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), tokenizer_path(), with_ids=False)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_simhash": op2_simhash,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_array": op8_suffix_array,
    "op9_bpe": op9_bpe,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_ngram_jaccard": op13_ngram_jaccard,
    "mixing_targets": mixing_targets,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM d WHERE len(ws) >= 50),
        k AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS key FROM w),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) AS least FROM k) WHERE least < doc_id),
        gone AS (SELECT DISTINCT doc_id, i + j AS p FROM r, range(0, 50) AS o(j)),
        p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM p ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op8_suffix_array": r"""
        WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
        w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS key FROM d, range(0, (SELECT max(len(h)) FROM d) // 2) AS o(i) WHERE i + 400 <= len(h) // 2),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY key) AS c FROM w) WHERE c > 1),
        m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM r),
        g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
        s AS (SELECT doc_id, k, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, k),
        t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
        e AS (
          SELECT doc_id, h, sum(b - a) AS removed, count(a) AS spans, coalesce(string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a), '')
            || substr(h, (2 * coalesce(max(b), 0) + 1)::BIGINT) AS rest
          FROM d LEFT JOIN t USING (doc_id) GROUP BY doc_id, h
        )
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, spans::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM e
    """,
    "mixing_targets": r"""
        WITH s AS (SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS source_size FROM documents GROUP BY source),
        w AS (SELECT *, 2.0 * source_size AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s),
        l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
        f AS (SELECT arg_min(level, cap / w) AS level FROM l WHERE level * w <= cap)
        SELECT source, source_size, round(coalesce(least(cap, w * f.level), cap), 3) AS target FROM l, f
    """,
    "op10_quality_rules": r"""
        WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
        e AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, ws FROM w WHERE len(ws) >= 3),
        g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM e WHERE i + 2 <= len(ws)),
        twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
        rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        c AS (
          SELECT doc_id, host, len(ws)::BIGINT AS n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
          FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
        ), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
        h AS (SELECT host, count(*) AS n, sum(base_failed::INT)::DOUBLE AS f FROM b GROUP BY host),
        p AS (SELECT avg(f / n) AS m, coalesce(var_samp(f / n), 0) AS v, avg(1.0 / n) AS inv FROM h),
        k AS (SELECT m, greatest(1.0, least(1e6, m * (1 - m) / greatest(v - m * (1 - m) * inv, 1e-9) - 1)) AS k FROM p),
        r AS (SELECT host, round((f + m * k) / (n + k), 9) AS host_rate FROM h, k)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate,
          NOT base_failed AND host_rate <= (SELECT round(least(greatest(3 * m, 0.25), 0.5), 9) FROM k) AS kept
        FROM b JOIN r ON b.host IS NOT DISTINCT FROM r.host
    """,
    "op11_hard_negatives": r"""
        WITH v AS (
          SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
          FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, b.r AS other, list_dot_product(a.q, b.q)::BIGINT AS score
          FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.r != b.r
        ), p AS (
          SELECT r, anchor_id, id AS positive_id, other, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.r, p.other ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.r = s.r AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY p.r, p.other ORDER BY score DESC, id) <= 3
    """,
    "op12_collocations": r"""
        WITH p AS (
          SELECT row_number() OVER () AS p, lang, piece FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
          )
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g FROM w, (VALUES (1), (2), (3)) AS o(k)),
        f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY lang, k, g),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (
          SELECT c.lang, c.k, c.g, c.f AS a, x.f AS l, y.f AS r, j, (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1 AND f >= 10) AS c
          JOIN f AS x ON x.lang = c.lang AND x.g = c.g[:j] JOIN f AS y ON y.lang = c.lang AND y.g = c.g[j + 1:]
          QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, j) = 1
        ), t AS (SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS part FROM c WHERE k = 3) GROUP BY lang, part),
        s AS (SELECT c.lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM c LEFT JOIN t ON k = 2 AND t.lang = c.lang AND t.part = c.g WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM s JOIN n USING (lang) QUALIFY rank <= 2000
    """,
    "op13_ngram_jaccard": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
          SELECT r, md5(array_to_string(g, ' ')) AS s FROM (
            SELECT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws] ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS g FROM d
          ) GROUP BY ALL
        ), n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        i AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM s AS a JOIN s AS b ON a.s = b.s AND a.r != b.r GROUP BY a.r, b.r),
        e AS (SELECT x, y FROM i JOIN n AS p ON p.r = x JOIN n AS q ON q.r = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
        reach AS (SELECT r, r AS t FROM d UNION SELECT reach.r, e.y FROM reach JOIN e ON e.x = reach.t)
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
        FROM d LEFT JOIN n ON n.r = d.r JOIN reach ON reach.r = d.r JOIN d AS o ON o.r = reach.t GROUP BY d.r, d.doc_id
    """,
}
