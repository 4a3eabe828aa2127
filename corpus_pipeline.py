"""A training corpus in five stages; counted as part of the subpackage llm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.bpe import encode
from plumbline.llm.columns import WORD, spare
from plumbline.llm.line_dedup import line_dedup
from plumbline.llm.mixing import mix
from plumbline.llm.queries import documents, labels, remainder, tokenizer_path
from plumbline.llm.similar import keep_one_similar
from plumbline.llm.store import stash
from plumbline.llm.toxicity import score, train

TOXIC_FROM = 0.5


def _row() -> Column:
    """What tells rows apart whose ids repeat or are null: the id, and a hash of the text."""
    return F.struct("doc_id", F.xxhash64("text").alias("h"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below ``TOXIC_FROM``, as they are, whatever rows share or lack an id."""
    # the fold that the classifier's own query holds out is not learned from here either
    model = train(docs, labels(spark, sf_dir), F.coalesce(remainder(5) != 0, F.lit(False)))
    r = spare("_row", docs.columns)
    scored = score(docs.select(_row().alias("row"), "text"), model, "row")
    toxic = scored.where(F.col("score") >= TOXIC_FROM).select(F.col("row").alias(r)).distinct()
    return docs.join(stash(toxic, "toxic").hint("merge"), _same(r), "left_anti")


def _same(row: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(row)["doc_id"]) & (F.xxhash64("text") == F.col(row)["h"])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines and what repeats beside them; those of which no word is left go."""
    cut = line_dedup(docs).where((F.col("n_chunks_removed") == 0) | F.col("text").rlike(WORD))
    n_chars = F.when(F.col("n_chunks_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of texts that are 0.8 similar in shingles of five words."""
    return keep_one_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; equal rows are taken alike, and blank texts never."""
    r, s, n = (spare(x, docs.columns) for x in ("_row", "_source", "_copies"))
    mixed = mix(docs.select(_row().alias("row"), "text", "source"), "row")
    copies = mixed.where("copies > 0").select(F.col("row").alias(r), F.col("source").alias(s), F.col("copies").cast("int").alias(n)).distinct()
    taken = docs.join(stash(copies, "copies").hint("merge"), _same(r) & F.col("source").eqNullSafe(F.col(s)))
    return taken.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text that they decode to."""
    return encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: Model scores, 64-bit hashes of lines and shingles, and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written, so no stage runs twice."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
