"""Exact duplicates by whole content, safe under groups of any size (operator 6)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.frames import documents, whole_text
from reelforge.operators.durable import settle

SALTS = 16


def exact_duplicates(docs: DataFrame, digest: Column | None = None, salts: int = SALTS) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical; null is the empty text. The row with the largest ``doc_id`` stays; of rows that
    repeat both text and ``doc_id`` exactly one stays; null ids come last. ``digest`` groups the rows (SHA-256 unless given);
    texts are compared whole at each stage: within a task before the shuffle, within a salt of a digest, and between the
    salts' winners. Only rows whose digest occurs twice can have an equal, so the others keep their
    text at home. Different texts under one SHA-256 would fail the job. An empty table gives no rows; other columns
    are not read.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    texts = texts.withColumn("text_sha256", F.sha2("text", 256))
    texts = texts.withColumn("_digest", F.sha2(digest.cast("string"), 256) if digest is not None else F.col("text_sha256"))
    rows = settle(texts.select(
        "doc_id", "text_sha256", "_digest", F.monotonically_increasing_id().alias("_row")), "digests")

    repeated = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = may_hold(texts, bitmap_of(repeated, "_digest"), F.col("_digest"))
    by_salt = (
        shared.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("_digest", "_salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    classes = (
        by_salt.groupBy("_digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .where("group_size > 1").select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    single = (
        classes.groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
        .select("text_sha256", "keep_id", F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts under one SHA-256")))
                .otherwise(F.col("group_size")).cast("long").alias("group_size"))
    )
    top = rows.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct("doc_id", "_row"))["_row"].alias("_top"))
    winners = single.join(top.where("_n > 1"), "text_sha256").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod("_row", F.lit(salts)).cast("int"))
    return salted.join(winners, ["text_sha256", "_salt"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_top"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of equal texts in ``documents``, and which row of each stays."""
    return exact_duplicates(documents(spark, sf_dir))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
