"""Counts, means, medians, quartiles, nulls and correlations."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.functions import missing
from reelforge.operators import hygiene, moments, profile, sketches
from reelforge.operators.documents import genre_rollup
from reelforge.operators.durable import settle
from reelforge.plans import sql_views as V
from reelforge.plans.bindings import directing, features, row_genres, table, titles, writing
from reelforge.plans.registry import query


def typed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with years repaired and numbers typed, missing values as null."""
    return hygiene.restore_years(hygiene.sentinels_to_null(titles(spark, sf_dir))).withColumn(
        "runtimeMinutes", missing.to_double("runtimeMinutes")
    )


@query("year_repair_enriched", f"""
WITH {V.CLEAN}, genres AS (
  SELECT 'tt' || l_orderkey AS tconst, CAST(bool_or(p_type = 'ECONOMY') AS INTEGER) AS action,
    CAST(bool_or(p_type = 'PROMO') AS INTEGER) AS science_fiction
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT start_year AS "startYear", count(*) AS n_titles, round(avg(votes), 4) AS mean_votes,
  round(median(votes), 4) AS median_votes, sum(action)::BIGINT AS n_action, sum(science_fiction)::BIGINT AS n_science_fiction
FROM clean JOIN genres USING (tconst) WHERE start_year IS NOT NULL GROUP BY start_year""")
def year_repair_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years repaired, titles joined with their genres, votes profiled per year."""
    genres = genre_rollup(row_genres(spark, sf_dir), "row_id", "genre", ["Action", "Science Fiction"], counts=False)
    repaired = hygiene.restore_years(hygiene.sentinels_to_null(titles(spark, sf_dir, with_run_times=False)))
    rows = settle(repaired.where("startYear is not null").select("row_id", "startYear", "numVotes").join(genres, "row_id"))
    counts = rows.groupBy("startYear").agg(
        F.count(F.lit(1)).alias("n_titles"), F.round(F.avg("numVotes"), 4).alias("mean_votes"),
        F.sum("action").alias("n_action"), F.sum("science_fiction").alias("n_science_fiction"),
    )
    medians = profile.exact_medians(rows, ["startYear"], "numVotes", "median_votes")
    return counts.join(medians, "startYear", "left").withColumn("median_votes", F.round("median_votes", 4))


@query("label_mode", f"""
WITH {V.TITLES} SELECT label, count(*) AS n FROM titles GROUP BY label ORDER BY n DESC, label LIMIT 1""")
def label_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.most_frequent(titles(spark, sf_dir), "label")


@query("label_balance", f"WITH {V.TITLES} SELECT label, count(*) AS n FROM titles GROUP BY label")
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(titles(spark, sf_dir), "label")


@query("split_counts", f"WITH {V.TITLES} SELECT split, count(*) AS n FROM titles GROUP BY split")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.split_counts(titles(spark, sf_dir))


@query("credit_counts", f"""
WITH {V.DIRECTING}, {V.WRITING}
SELECT 'director' AS role, director AS person, count(movie) AS movie_count FROM directing WHERE director IS NOT NULL GROUP BY director
UNION ALL SELECT 'writer', writer, count(movie) FROM writing WHERE writer IS NOT NULL GROUP BY writer""")
def credit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [("director", directing), ("writer", writing)]
    directors, writers = [
        profile.group_counts(edges(spark, sf_dir), role, "movie", "movie_count")
        .select(F.lit(role).alias("role"), F.col(role).alias("person"), "movie_count")
        for role, edges in both
    ]
    return directors.unionByName(writers).orderBy("movie_count", "role", "person")


@query("year_profile", f"""
WITH {V.CLEAN} SELECT start_year AS "startYear", round(avg(votes), 4) AS mean_value,
  round(median(votes), 4) AS median_value, count(tconst) AS n
FROM clean WHERE start_year IS NOT NULL GROUP BY start_year""")
def year_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = settle(typed_titles(spark, sf_dir).select("startYear", "numVotes", "tconst"))
    rows = profile.group_profile(known, "startYear", "numVotes", "tconst")
    return rows.withColumns({
        "mean_value": F.round("mean_value", 4), "median_value": F.round("median_value", 4)
    })


def _summary_sql(name: str, value: str) -> str:
    quartiles = ", ".join(f"round(quantile_cont({value}, {p / 100}), 4) AS p{p}" for p in (25, 50, 75))
    return f"""SELECT '{name}' AS "column", count({value}) AS n, round(avg({value}), 4) AS mean,
      round(stddev_samp({value}), 4) AS std, round(CAST(min({value}) AS DOUBLE), 4) AS min,
      round(CAST(max({value}) AS DOUBLE), 4) AS max, {quartiles} FROM clean"""


@query("column_summary", f"WITH {V.CLEAN} " + " UNION ALL ".join(
    _summary_sql(name, value)
    for name, value in [("startYear", "start_year"), ("runtimeMinutes", "minutes"), ("numVotes", "votes")]))
def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["startYear", "runtimeMinutes", "numVotes"]
    rows = profile.column_summary(settle(typed_titles(spark, sf_dir).select(*columns)), columns)
    measures = [name for name in rows.columns if name not in ("column", "n")]
    return rows.withColumns({name: F.round(name, 4) for name in measures})


@query("null_profile", f"""
WITH {V.CLEAN}, counted AS (
  SELECT count(*) FILTER (original_title IS NULL) AS a, count(*) FILTER (start_year IS NULL) AS b,
    count(*) FILTER (minutes IS NULL) AS c, count(*) FILTER (votes IS NULL) AS d,
    count(*) FILTER (label IS NULL) AS e FROM clean)
SELECT 'originalTitle' AS "column", a AS n_null, a > 0 AS any_null FROM counted
UNION ALL SELECT 'startYear', b, b > 0 FROM counted UNION ALL SELECT 'runtimeMinutes', c, c > 0 FROM counted
UNION ALL SELECT 'numVotes', d, d > 0 FROM counted UNION ALL SELECT 'label', e, e > 0 FROM counted""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_titles(spark, sf_dir).select("originalTitle", "startYear", "runtimeMinutes", "numVotes", "label")
    return profile.null_profile(rows)


NUMERIC = {"year": "start_year", "minutes": "minutes", "votes": "votes", "label": "(label = 'True')::int"}


@query("correlation_matrix", f"WITH {V.CLEAN} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({x}, {y}), 4) AS corr FROM clean"
    for a, x in NUMERIC.items() for b, y in NUMERIC.items()))
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_titles(spark, sf_dir).select(
        F.col("startYear").alias("year"), F.col("runtimeMinutes").alias("minutes"), F.col("numVotes").alias("votes"),
        missing.label_flag("label").cast("int").alias("label"),
    )
    # two neighbouring doubles may round to 0.0 and -0.0
    return profile.correlation_matrix(rows, list(NUMERIC)).withColumn("corr", F.round("corr", 4) + F.lit(0.0))


@query("partition_sums")
def partition_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.partition_sums(titles(spark, sf_dir), "numVotes")


@query("nan_safe_total", f"""
WITH {V.CLEAN} SELECT round(sum(votes), 2) AS total, count(*) AS n_rows FROM clean""")
def nan_safe_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.partition_total(titles(spark, sf_dir), "numVotes").withColumn("total", F.round("total", 2))


def _profile_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS n_rows, count(*) - count("{column}") AS n_null,
      count(*) FILTER ("{column}" IN ('\\N', 'NULL', '', 'nan', 'NaN')) AS n_sentinel,
      count(DISTINCT "{column}") AS n_distinct, min("{column}") AS min_value, max("{column}") AS max_value FROM titles"""


PROFILED = ["primaryTitle", "originalTitle", "startYear", "endYear", "runtimeMinutes", "label"]


@query("column_profile", f"WITH {V.TITLES} " + " UNION ALL ".join(_profile_sql(name) for name in PROFILED))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(titles(spark, sf_dir).select(*PROFILED))


@query("feature_correlations", f"WITH {V.DOCUMENTS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 4) AS corr FROM features"
    for a in ("popularity", "vote_average", "vote_count", "action")
    for b in ("popularity", "vote_average", "vote_count", "action")))
def feature_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["popularity", "vote_average", "vote_count", "action"]
    return profile.correlation_matrix(features(spark, sf_dir), columns).withColumn("corr", F.round("corr", 4) + F.lit(0.0))


@query("events_by_type", """
SELECT event_type, round(avg(value), 4) AS mean_value, round(median(value), 4) AS median_value, count(*) AS n
FROM events GROUP BY event_type""")
def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group profile over the event table: few groups, each a large share of the rows."""
    events = table(spark, sf_dir, "events", "event_type", "value", "event_id")
    return profile.group_profile(events, "event_type", "value", "event_id").withColumns({
        "mean_value": F.round("mean_value", 4), "median_value": F.round("median_value", 4)
    })


PLACED = """placed AS (SELECT split, start_year, r_name AS region, votes FROM clean JOIN orders ON o_orderkey = row_id
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def placed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of titles with split, year and region."""
    rows = typed_titles(spark, sf_dir).select("row_id", "split", F.col("startYear").alias("start_year"), "numVotes")
    owners = table(spark, sf_dir, "orders", F.col("o_orderkey").alias("row_id"), "o_custkey")
    customers = table(spark, sf_dir, "customer", F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation", "n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    regions = table(spark, sf_dir, "region", "r_regionkey", F.col("r_name").alias("region"))
    return rows.join(owners, "row_id").join(customers, "o_custkey").join(nations, "n_nationkey").join(regions, "r_regionkey").select(
        "split", "start_year", "region", F.col("numVotes").alias("votes"))


def _levels_sql(grouping: str) -> str:
    names = ", ".join(f"CASE WHEN grouping({name}) = 0 THEN '{name}' END" for name in ("split", "start_year", "region"))
    return f"""WITH {V.CLEAN}, {PLACED} SELECT concat_ws(',', {names}) AS level, split, start_year, region, count(*) AS n,
  round(avg(votes), 4) AS mean, round(median(votes), 4) AS median FROM placed GROUP BY {grouping}"""


@query("cube_profile", _levels_sql("CUBE(split, start_year, region)"))
def cube_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes by split, year and region at all eight levels, medians exact at each."""
    found = profile.level_profile(placed_titles(spark, sf_dir), ["split", "start_year", "region"], "votes")
    return found.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 4)})


@query("rollup_profile", _levels_sql("ROLLUP(split, start_year, region)"))
def rollup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["split", "start_year", "region"]
    found = profile.level_profile(placed_titles(spark, sf_dir), names, "votes", profile.rollup_levels(names))
    return found.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 4)})


def _sketch_sql(columns: list[str], listed: tuple[str, ...]) -> str:
    def one(name: str) -> str:
        heavy = f"(SELECT string_agg(v || '=' || n, ';' ORDER BY v) FROM (SELECT {name}::VARCHAR AS v, count(*) AS n FROM orders WHERE {name} IS NOT NULL GROUP BY 1))" if name in listed else "NULL"
        return f"SELECT '{name}' AS \"column\", count(*) AS n_rows, count(*) - count({name}) AS n_null, true AS distinct_within, {heavy} AS heavy FROM orders"
    return " UNION ALL ".join(map(one, columns))


SKETCHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LISTED = ("o_orderstatus", "o_orderpriority")


@query("sketch_profile", _sketch_sql(SKETCHED, LISTED))
def sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column sketches of three parts of the orders, stored and merged: estimates of different values within four standard errors
    of the exact number, and the frequent values of columns with few, with their counts."""
    orders = table(spark, sf_dir, "orders")
    parts = [settle(sketches.column_sketches(orders.where(F.col("o_orderkey") % 3 == n), SKETCHED), "sketches") for n in range(3)]
    report = sketches.sketch_report(sketches.merged(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    exact = profile.column_profile(orders.select(*SKETCHED))
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * sketches.STANDARD_ERROR * F.col("exact"))
    items = F.array_join(F.sort_array(F.transform("heavy", lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string")))), ";")
    return report.join(exact.select("column", F.col("n_distinct").alias("exact")), "column").select(
        "column", "n_rows", "n_null", within.alias("distinct_within"), F.when(F.col("column").isin(*LISTED), items).alias("heavy"))


DIMENSIONS = 24


@query("wide_correlations", f"""
WITH long AS (SELECT vec_id, i, CASE WHEN (vec_id + i) % 13 = 0 THEN NULL ELSE embedding[i + 1]::DOUBLE + i END AS x FROM embeddings, range({DIMENSIONS}) AS dims(i))
SELECT 'e' || a.i AS column_a, 'e' || b.i AS column_b, count(*) FILTER (a.x IS NOT NULL AND b.x IS NOT NULL) AS n, round(corr(a.x, b.x), 6) AS correlation
FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def wide_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of all pairs of 24 columns of the vectors, some values missing, from the states of two parts merged."""
    vectors, names = table(spark, sf_dir, "embeddings", "vec_id", "embedding"), [f"e{i}" for i in range(DIMENSIONS)]
    wide = vectors.select("vec_id", *[
        F.when((F.col("vec_id") + i) % 13 != 0, F.col("embedding")[i].cast("double") + i).alias(name) for i, name in enumerate(names)])
    shift = [float(i) for i in range(DIMENSIONS)]
    parts = [moments.moment_states(wide.where(F.col("vec_id") % 2 == part), names, shift) for part in (0, 1)]
    found = moments.correlations(moments.merged_moments(parts[0].unionByName(parts[1])), names)
    return found.withColumn("correlation", F.round("correlation", 6))
