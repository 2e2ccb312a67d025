"""Corpus preparation: STAGES in order, each reading what the one before it kept."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaica.llm.common import drop_stored, stored, table, written
from mosaica.llm.exact_dedup import exact_dedup
from mosaica.llm.packing import pack_documents
from mosaica.llm.quality import keep_quality
from mosaica.llm.secrets import mask_secrets
from mosaica.llm.simhash import near_dedup, similar_to_smaller


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; without labels all stay. Null and empty texts share one score, null and repeated ids are
    judged by their text like others; an empty table stays empty."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, one row with the largest doc_id stays (null is smaller than any other; of several rows with
    that doc_id the one with the smallest text and other columns). Null and empty texts are equal; an empty table stays empty."""
    sha = F.sha2(F.translate(F.coalesce("text", F.lit("")), ascii_uppercase, ascii_lowercase), 256)
    kept = exact_dedup(docs).where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count("*").alias("_n"))
    rows = docs.withColumn("_own", sha).join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")))
    rest = [c for c in docs.columns if c != "text"]
    repeated = rows.where("_n > 1").groupBy("_own").agg(F.min(F.struct("text", *rest)).alias("_row"))
    return rows.where("_n = 1").select(*docs.columns).unionByName(repeated.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns]))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: the smallest doc_id of a SimHash group (3-word shingles, 2 bits, as the
    operator's query), and then no document whose 5-word shingles are similar by 0.8 to those of one with a smaller doc_id.
    Rows are told apart and ordered by doc_id, null last, and a hash of the text; texts without words form one SimHash group. An empty table stays empty."""
    key = F.struct(F.isnull("doc_id").alias("none"), F.coalesce(F.col("doc_id"), F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("id"), F.xxhash64("text").alias("hash"))
    keyed = docs.withColumn("_key", key)
    kept = near_dedup(keyed, "_key").where("_key = component_id").select("_key").distinct()
    keyed = stored(keyed.join(kept, "_key", "left_semi"))
    return keyed.join(similar_to_smaller(keyed, "_key"), "_key", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by [secret]; n_chars follows. All rows stay; a null text stays null with a null n_chars."""
    return mask_secrets(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces in token sequences. Every row is a document of its own, null and repeated ids too; a null or empty text gives one
    piece, the end id; an empty table gives no pieces."""
    return pack_documents(docs)


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("secret_scan", secrets), ("best_fit_packing", packing)]

# A classifier, hashes and a tokenizer decide, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    start = written()
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        drop_stored(spark, start, keep=1)  # what the stage wrote on the way, and its input
    return STAGES[-1][1](spark, docs, sf_dir)
