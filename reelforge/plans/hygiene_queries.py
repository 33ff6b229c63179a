"""Sentinels, years, defaults, validation, typed scans."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.functions import missing, nested, numeric, text
from reelforge.operators import documents, hygiene
from reelforge.plans import sql_views as V
from reelforge.plans.bindings import responses, table, titles
from reelforge.plans.registry import query
from reelforge.schemas import ITEMS_CSV


@query("sentinel_to_null", f"""
WITH {V.TITLES} SELECT row_id, tconst,
  nullif(nullif(nullif("startYear", '\\N'), 'nan'), 'NULL') AS "startYear", nullif("endYear", '\\N') AS "endYear",
  nullif(nullif("runtimeMinutes", '\\N'), 'NULL') AS "runtimeMinutes",
  CASE WHEN "originalTitle" IN ('', '\\N', 'NULL') THEN NULL ELSE "originalTitle" END AS "originalTitle",
  CASE WHEN isnan("numVotes") THEN NULL ELSE "numVotes" END AS "numVotes"
FROM titles""")
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.sentinels_to_null(titles(spark, sf_dir)).select(
        "row_id", "tconst", "startYear", "endYear", "runtimeMinutes", "originalTitle", "numVotes"
    )


@query("year_repair", f'WITH {V.CLEAN} SELECT row_id, tconst, start_year AS "startYear" FROM clean')
def year_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.restore_years(titles(spark, sf_dir)).select("row_id", "tconst", "startYear")


@query("sentinel_to_default", f"""
WITH {V.CLEAN} SELECT row_id, coalesce(raw_start, -1) AS year_or_minus_one, coalesce(raw_end, 0) AS end_or_zero,
  coalesce(minutes, -1) AS minutes_or_minus_one, CAST(coalesce(trunc(votes), -1) AS INTEGER) AS votes_or_minus_one,
  coalesce(original_title, '') AS title_or_empty
FROM clean""")
def sentinel_to_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select(
        "row_id",
        missing.int_or_default("startYear", -1).alias("year_or_minus_one"),
        missing.int_or_default("endYear", 0).alias("end_or_zero"),
        missing.int_or_default("runtimeMinutes", -1).alias("minutes_or_minus_one"),
        F.coalesce(missing.nan_to_null("numVotes").try_cast("int"), F.lit(-1)).alias("votes_or_minus_one"),
        missing.text_or_empty("originalTitle").alias("title_or_empty"),
    )


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw CSV lines ``name,price,quantity``, some of them malformed."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    place = F.col("l_orderkey") + F.col("l_linenumber")
    part = F.col("l_partkey").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return lines.select(
        "l_orderkey",
        F.concat_ws(
            ",",
            F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit('"item '), part, F.lit(', large"')))
            .otherwise(F.concat(F.lit("item "), part)),
            F.when(place % 9 == 0, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")),
            F.when(place % 10 == 0, F.concat(quantity, F.lit(".5"))).otherwise(quantity),
        ).alias("line"),
    )


@query("typed_scan_rejects", """
SELECT l_orderkey,
  CASE WHEN l_partkey % 5 = 0 THEN 'item ' || l_partkey || ', large' ELSE 'item ' || l_partkey END AS name,
  CASE WHEN (l_orderkey + l_linenumber) % 9 <> 0 THEN l_extendedprice END AS price,
  CASE WHEN (l_orderkey + l_linenumber) % 10 <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity,
  (l_orderkey + l_linenumber) % 9 = 0 OR (l_orderkey + l_linenumber) % 10 = 0 AS is_malformed
FROM lineitem""")
def typed_scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = item_lines(spark, sf_dir).select("l_orderkey", nested.parse_line("line", ITEMS_CSV).alias("item"))
    return parsed.select(
        "l_orderkey", "item.name", "item.price", "item.quantity",
        F.col(f"item.{nested.CORRUPT}").isNotNull().alias("is_malformed"),
    )


def priced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with prices and quantities shifted down, so that some are negative."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return lines.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") - 20000).alias("price"),
        (F.col("l_quantity") - 10).alias("quantity"),
    )


@query("validate_rules", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice - 20000, 2) AS price, l_quantity - 10 AS quantity,
  concat_ws('; ', CASE WHEN l_extendedprice - 20000 < 0 THEN 'price >= 0' END,
                  CASE WHEN l_quantity - 10 < 0 THEN 'quantity >= 0' END) AS reasons
FROM lineitem WHERE l_extendedprice - 20000 < 0 OR l_quantity - 10 < 0""")
def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"price >= 0": F.col("price") >= 0, "quantity >= 0": F.col("quantity") >= 0}
    _, rejected = hygiene.validate(priced_items(spark, sf_dir), rules)
    return rejected.withColumns({"price": F.round("price", 2), "reasons": F.concat_ws("; ", "reasons")})


@query("integer_valued", """
WITH texts AS (
  SELECT l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN 'x' || CAST(l_quantity AS INTEGER)
    WHEN l_linenumber % 4 = 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0'
    WHEN l_linenumber % 4 = 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS text FROM lineitem)
SELECT l_orderkey, text,
  coalesce(TRY_CAST(text AS DOUBLE) = floor(TRY_CAST(text AS DOUBLE)), false) AS is_integer
FROM texts""")
def integer_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    kind = F.col("l_linenumber") % 4
    quantity = F.col("l_quantity").cast("int").cast("string")
    value = (
        F.when(kind == 0, F.concat(F.lit("x"), quantity)).when(kind == 1, F.concat(quantity, F.lit(".0")))
        .when(kind == 2, F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).otherwise(quantity)
    )
    return lines.select("l_orderkey", value.alias("text")).withColumn("is_integer", numeric.is_integer_valued("text"))


@query("derived_amounts", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_quantity, 2) AS total_price,
  round(l_extendedprice * CAST(0.8 AS DOUBLE), 3) AS discounted_price FROM lineitem""")
def derived_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(numeric.total_price("l_extendedprice", "l_quantity"), 2).alias("total_price"),
        F.round(numeric.discounted("l_extendedprice"), 3).alias("discounted_price"),
    )


@query("foreign_flag", f"""
WITH {V.CLEAN} SELECT tconst, coalesce(primary_title <> original_title, false) AS "foreignMovie" FROM clean""")
def foreign_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = titles(spark, sf_dir).select(
        "tconst",
        missing.text_or_empty("primaryTitle").alias("primary"), missing.text_or_empty("originalTitle").alias("original"),
    )
    return rows.select("tconst", text.is_foreign("primary", "original").alias("foreignMovie"))


@query("clean_pass", f"""
WITH {V.CLEAN}, whole AS (SELECT *, CAST(trunc(votes) AS INTEGER) AS whole_votes FROM clean),
means AS (
  SELECT avg(raw_start) FILTER (raw_start > 0) AS year_mean, avg(minutes) FILTER (minutes > 0) AS minutes_mean,
    avg(whole_votes) FILTER (whole_votes > 0) AS votes_mean FROM whole)
SELECT tconst, coalesce(raw_end, -1) AS "endYear", coalesce(original_title, '') AS "originalTitle",
  round(CASE WHEN raw_start IS NULL OR raw_start > 2022 THEN year_mean ELSE raw_start END, 4) AS "startYear",
  round(coalesce(minutes, minutes_mean), 4) AS "runtimeMinutes", round(coalesce(whole_votes, votes_mean), 4) AS "numVotes",
  coalesce(primary_title <> original_title, false) AS "foreignMovie"
FROM whole, means""")
def clean_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = hygiene.clean_titles(titles(spark, sf_dir))
    return cleaned.select(
        "tconst", "endYear", "originalTitle", F.round("startYear", 4).alias("startYear"),
        F.round("runtimeMinutes", 4).alias("runtimeMinutes"), F.round("numVotes", 4).alias("numVotes"), "foreignMovie",
    )


@query("document_rejects", f"""
WITH {V.QTY}
SELECT 'tt' || o_orderkey AS id, 'malformed' AS reason FROM orders WHERE o_orderkey % 29 = 0
UNION ALL SELECT 'tt' || o_orderkey, 'missing imdb_id' FROM orders WHERE o_orderkey % 29 <> 0 AND o_orderkey % 23 = 0
UNION ALL SELECT 'tt' || o_orderkey, 'missing runtime' FROM orders LEFT JOIN qty ON l_orderkey = o_orderkey
  WHERE o_orderkey % 29 <> 0 AND minutes IS NULL""")
def document_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.document_rejects(documents.parse_documents(responses(spark, sf_dir)), "tconst")


@query("reject_log", """
SELECT 'tt' || o_orderkey AS id, 'no document' AS reason FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND o_orderkey % 2 = 1""")
def reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects that the log lacks: titles without line items, requested twice; the even ones are logged."""
    ids = table(spark, sf_dir, "orders", "o_orderkey")
    found = table(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("o_orderkey"))
    lost = hygiene.reject_rows(
        ids.unionByName(ids).join(found, "o_orderkey", "left_anti").withColumn(
            "tconst", F.concat(F.lit("tt"), F.col("o_orderkey").cast("string"))),
        "tconst", F.lit("no document"),
    )
    logged = lost.where(F.substring("id", 3, 20).cast("bigint") % 2 == 0)
    return hygiene.new_rejects(lost, logged)
