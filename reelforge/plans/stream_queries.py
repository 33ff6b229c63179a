"""Landed files worked off by streams, with restarts between."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.operators import hygiene
from reelforge.operators.durable import staging_path
from reelforge.plans import sql_views as V
from reelforge.plans.bindings import countries, responses, table, title_id
from reelforge.plans.registry import query
from reelforge.streaming import enrichment, rejects


@query("features_streamed", f"""
WITH {V.DOCUMENTS} SELECT tconst, popularity, continent, action, comedy, drama, science_fiction, tv_movie, war FROM features""")
def features_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table from responses that land in three steps, each worked off by a stream that starts anew.

    The second step brings again what the first one had.
    """
    landing, path, checkpoint = (staging_path(spark, name) for name in ("landing", "enriched", "offsets"))
    landed = responses(spark, sf_dir).withColumnRenamed("tconst", "id")
    step = F.crc32("id") % 3
    for arrived in (step == 0, step <= 1, step == 2):
        enrichment.land(landed.where(arrived), landing)
        enrichment.enrich(enrichment.landed_responses(spark, landing), countries(spark, sf_dir), path, checkpoint).awaitTermination()
    return enrichment.streamed_features(spark, path).select(
        "tconst", "popularity", "continent", "action", "comedy", "drama", "science_fiction", "tv_movie", "war")


@query("rejects_streamed", f"""
WITH {V.DOCUMENTS} SELECT 'tt' || o_orderkey AS id, 'malformed' AS reason FROM orders WHERE o_orderkey % 29 = 0
UNION ALL SELECT requested, 'missing imdb_id' FROM docs WHERE tconst IS NULL
UNION ALL SELECT requested, 'missing runtime' FROM docs WHERE runtime IS NULL""")
def rejects_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects that the enriching stream logs, each once though responses land twice."""
    landing, path, checkpoint = (staging_path(spark, name) for name in ("landing", "enriched", "offsets"))
    landed = responses(spark, sf_dir).withColumnRenamed("tconst", "id")
    for arrived in (F.crc32("id") % 2 == 0, F.lit(True)):
        enrichment.land(landed.where(arrived), landing)
        enrichment.enrich(enrichment.landed_responses(spark, landing), countries(spark, sf_dir), path, checkpoint).awaitTermination()
    return enrichment.streamed_rejects(spark, path)


@query("reject_log_streamed", """
SELECT DISTINCT 'tt' || o_orderkey AS id, 'no document' AS reason FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def reject_log_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without line items, logged once each from a stream in which they come up several times, some of them late.

    They land by date in three steps, each worked off by a stream that starts anew; every second one comes up again a step
    later and every tenth one comes up first when the watermark may have passed it.
    """
    landing, path, checkpoint = (staging_path(spark, name) for name in ("landing", "log", "offsets"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    found = table(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("o_orderkey"))
    lost = hygiene.reject_rows(
        orders.join(found, "o_orderkey", "left_anti").withColumn("tconst", title_id("o_orderkey")), "tconst", F.lit("no document")).withColumn(
        "key", F.substring("id", 3, 20).cast("bigint"))
    dated = lost.join(orders.withColumnRenamed("o_orderkey", "key"), "key").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    step = F.when(F.year("at") < 1994, 0).when(F.year("at") < 1997, 1).otherwise(2) + F.when(F.col("key") % 10 == 0, 1).otherwise(0)
    placed = dated.withColumn("step", F.least(step, F.lit(2)))
    for number in range(3):
        again = (F.col("step") == number - 1) & (F.col("key") % 2 == 1)
        placed.where((F.col("step") == number) | again).select("id", "reason", "at").write.mode("append").parquet(landing)
        rejects.log_stream(rejects.landed_rejects(spark, landing), path, checkpoint, "200 days").awaitTermination()
    rejects.sweep(spark.read.parquet(landing), path)
    return rejects.logged_rejects(spark, path)
