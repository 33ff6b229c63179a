"""Enrichment, look-ups, differences, unions and ordered outputs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.constants import DEFAULT_REGION
from reelforge.functions.missing import nan_to_null
from reelforge.operators import credits, documents, hygiene, joins, model, profile
from reelforge.plans import sql_views as V
from reelforge.plans.bindings import countries, directing, features, table, title_id, titles, writing
from reelforge.plans.registry import query


@query("enrich_inner", f"""
WITH {V.DOCUMENTS}
SELECT row_id, f.tconst, label, popularity, continent, action, comedy, drama, science_fiction, tv_movie, war
FROM (SELECT o_orderkey AS row_id, 'tt' || o_orderkey AS tconst,
        CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS label FROM orders) t
JOIN features f ON f.tconst = t.tconst""")
def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = titles(spark, sf_dir).select("row_id", "tconst", "label")
    return joins.enrich(left, features(spark, sf_dir)).select(
        "row_id", "tconst", "label", "popularity", "continent", "action", "comedy", "drama", "science_fiction",
        "tv_movie", "war",
    )


@query("lookup_default", f"""
WITH {V.COUNTRIES} SELECT c_custkey, coalesce(nullif(region, ''), 'World') AS continent
FROM customer LEFT JOIN countries ON code = 'N' || c_nationkey""")
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    code = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    found = joins.lookup(customers, countries(spark, sf_dir), code, "alpha-2", "region", DEFAULT_REGION, "continent")
    return found.select("c_custkey", "continent")


@query("credits_left_join", f"""
WITH {V.DIRECTING}, {V.WRITING}, ids AS (SELECT *, row_number() OVER () AS edge FROM writing),
joined AS (SELECT edge, w.movie, writer, director FROM ids w LEFT JOIN
  (SELECT * FROM directing WHERE director IS NOT NULL) d ON w.movie = d.movie),
per_edge AS (SELECT edge, movie, writer, count(director) AS n_directors, count(*) AS n_joined_rows
  FROM joined GROUP BY edge, movie, writer)
SELECT movie, writer, n_directors, n_joined_rows FROM per_edge""")
def credits_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credits.credit_pairs_per_writer(writing(spark, sf_dir), directing(spark, sf_dir))


@query("incremental_anti", """
SELECT 'tt' || o_orderkey AS tconst FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def incremental_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles not processed yet; processed are those with a returned line."""
    requested = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst"))
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
    done = lines.where("l_returnflag = 'R'").select(title_id("l_orderkey").alias("tconst"))
    return joins.not_yet_done(requested, done, "tconst")


@query("membership_semi", """
SELECT 'tt' || o_orderkey AS tconst FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def membership_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst"))
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
    done = lines.where("l_returnflag = 'R'").select(title_id("l_orderkey").alias("tconst"))
    return joins.already_done(requested, done, "tconst")


@query("key_difference", f"""
WITH {V.DIRECTING}, {V.WRITING}
SELECT movie FROM directing WHERE director IS NOT NULL EXCEPT SELECT movie FROM writing WHERE writer IS NOT NULL""")
def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with a known director but no known writer."""
    return joins.key_difference(
        directing(spark, sf_dir).where("director is not null"), writing(spark, sf_dir).where("writer is not null"), "movie"
    )


@query("aligned_left_join", """
WITH scored AS (SELECT l_orderkey, min(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS prediction
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS row_id, coalesce(prediction = 1, true) AS prediction, l_orderkey IS NOT NULL AS was_scored
FROM orders LEFT JOIN scored ON l_orderkey = o_orderkey""")
def aligned_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions aligned with titles: repeated on the right, missing for some titles."""
    requested = table(spark, sf_dir, "orders", F.col("o_orderkey").alias("row_id"))
    scored = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").select(
        F.col("l_orderkey").alias("row_id"), (F.col("l_quantity") > 25).cast("double").alias("prediction")
    )
    return model.align_predictions(requested, scored, "row_id")


@query("union_by_name", """
SELECT 'tt' || o_orderkey AS tconst, o_totalprice AS popularity, NULL AS n_lines FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL SELECT 'tt' || l_orderkey, NULL, count(*) FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY l_orderkey""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feature tables with different columns appended; some of their keys are missing."""
    known = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice").select(
        F.when(F.col("o_orderkey") % 5 != 0, title_id("o_orderkey")).alias("tconst"),
        F.col("o_totalprice").alias("popularity"),
    )
    new = table(spark, sf_dir, "lineitem", "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    new = new.select(F.when(F.col("l_orderkey") % 4 != 0, title_id("l_orderkey")).alias("tconst"), "n_lines")
    return documents.append_features(known, new)


@query("topk_desc", f"""
WITH {V.CLEAN} SELECT row_id, tconst, votes AS "numVotes" FROM clean ORDER BY votes DESC NULLS LAST, row_id LIMIT 10""")
def topk_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = titles(spark, sf_dir).select("row_id", "tconst", nan_to_null("numVotes").alias("numVotes"))
    return profile.top_k(rows, "numVotes", "row_id", 10)


@query("row_order", f"""
WITH {V.TITLES} SELECT row_id, tconst, label FROM titles ORDER BY row_id""")
def row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select("row_id", "tconst", "label").orderBy("row_id")


@query("illegal_years", f"""WITH {V.CLEAN} SELECT row_id, tconst, start_year AS "startYear" FROM clean WHERE start_year > 2022""")
def illegal_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hygiene.restore_years(titles(spark, sf_dir)).select("row_id", "tconst", "startYear")
    return rows.where(F.col("startYear") > 2022)


def id_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per customer: the ids of the titles that have an external id."""
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    entry = F.map_from_arrays(F.array(title_id("o_orderkey")), F.array(F.col("o_orderkey") * 7 + 100))
    return orders.select(F.to_json(F.when(F.col("o_orderkey") % 6 != 0, entry)).alias("value"))


@query("id_map_lookup", """
SELECT 'tt' || o_orderkey AS tconst, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 7 + 100 END AS tmdb_id FROM orders""")
def id_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_map = documents.id_map_rows(id_objects(spark, sf_dir)).withColumnRenamed("imdb_id", "tconst")
    ids = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst"))
    return joins.aligned(ids, id_map, "tconst")


@query("map_merge", """
SELECT 'tt' || o_orderkey AS imdb_id, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 7 + 100 ELSE o_orderkey END AS tmdb_id
FROM orders""")
def map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newly found ids merged into the map; entries already known are kept."""
    known = documents.id_map_rows(id_objects(spark, sf_dir))
    found = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("imdb_id"), F.col("o_orderkey").alias("tmdb_id"))
    return joins.merge_map(known, found, "imdb_id", "tmdb_id")


@query("enrichment_plan", """
SELECT 'tt' || o_orderkey AS tconst, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 7 + 100 END AS tmdb_id,
  CASE WHEN o_orderkey % 6 <> 0 THEN 'fetch' WHEN o_orderkey % 12 = 0 THEN 'not found' ELSE 'map' END AS step
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def enrichment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each title is requested by two splits; finished are those with a returned line."""
    ids = table(spark, sf_dir, "orders", "o_orderkey", title_id("o_orderkey").alias("tconst"))
    not_found = ids.where(F.col("o_orderkey") % 12 == 0).select(
        F.col("tconst").alias("id"), F.lit("no match").alias("reason"))
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
    done = lines.where("l_returnflag = 'R'").select(title_id("l_orderkey").alias("tconst"))
    id_map = documents.id_map_rows(id_objects(spark, sf_dir))
    return documents.enrichment_plan(ids.unionByName(ids), id_map, not_found, done)


@query("union_all_ids", """
SELECT 'tt' || o_orderkey AS tconst, count(*) AS n_requests FROM
  (SELECT o_orderkey FROM orders UNION ALL SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""")
def union_all_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of several frames with duplicates kept, and how often each is requested."""
    ids = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst")).union(
        table(spark, sf_dir, "lineitem", title_id("l_orderkey").alias("tconst"))
    )
    return profile.value_counts(ids, "tconst").withColumnRenamed("n", "n_requests")
