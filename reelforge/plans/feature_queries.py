"""Credits, genres, documents, imputation, scaling and series."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.constants import GENRES
from reelforge.functions import missing, nested
from reelforge.operators import credits, documents, hygiene, impute, knn, series
from reelforge.operators.durable import settle, staging_path
from reelforge.plans import classify
from reelforge.plans import sql_views as V
from reelforge.plans.bindings import (
    TYPE_GENRES, countries, directing, features, responses, table, title_genres, title_id, titles, writing,
)
from reelforge.plans.bindings import series as series_rows
from reelforge.plans.profile_queries import typed_titles
from reelforge.plans.registry import query
from reelforge.sources.files import pair_columns, read_columnar_credits, wide_line_rejects, wide_lines_to_long

SNAKE = [name.lower().replace(" ", "_") for name in GENRES]


@query("credit_features_pairs", f"""
WITH {V.DIRECTING}, {V.WRITING},
dc AS (SELECT director, count(movie) AS director_movie_count FROM directing WHERE director IS NOT NULL GROUP BY director),
wc AS (SELECT writer, count(movie) AS writer_movie_count FROM writing WHERE writer IS NOT NULL GROUP BY writer)
SELECT w.movie, max(director_movie_count) AS director_movie_count, count(director_movie_count) AS director_count,
  max(writer_movie_count) AS writer_movie_count, count(writer_movie_count) AS writer_count
FROM writing w LEFT JOIN directing d ON w.movie = d.movie
JOIN dc ON dc.director = d.director JOIN wc ON wc.writer = w.writer GROUP BY w.movie""")
def credit_features_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credits.credit_features(directing(spark, sf_dir), writing(spark, sf_dir), mode="pairs")


@query("credit_features_people", f"""
WITH {V.DIRECTING}, {V.WRITING},
de AS (SELECT DISTINCT * FROM directing WHERE director IS NOT NULL),
we AS (SELECT DISTINCT * FROM writing WHERE writer IS NOT NULL),
d AS (SELECT movie, max(n) AS director_movie_count, count(*) AS director_count FROM de
  JOIN (SELECT director, count(*) AS n FROM de GROUP BY director) USING (director) GROUP BY movie),
w AS (SELECT movie, max(n) AS writer_movie_count, count(*) AS writer_count FROM we
  JOIN (SELECT writer, count(*) AS n FROM we GROUP BY writer) USING (writer) GROUP BY movie)
SELECT 'tt' || o_orderkey AS tconst, coalesce(director_movie_count, 0) AS director_movie_count,
  coalesce(director_count, 0) AS director_count, coalesce(writer_movie_count, 0) AS writer_movie_count,
  coalesce(writer_count, 0) AS writer_count
FROM orders LEFT JOIN d ON d.movie = 'tt' || o_orderkey LEFT JOIN w ON w.movie = 'tt' || o_orderkey""")
def credit_features_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst"))
    return credits.with_credit_features(ids, directing(spark, sf_dir), writing(spark, sf_dir))


@query("credit_lookup", f"""
WITH {V.DIRECTING} SELECT movie, director FROM directing WHERE movie = 'tt936'""")
def credit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directing(spark, sf_dir).where(F.col("movie") == "tt936")


def _genre_sql(expression: str) -> str:
    return ", ".join(
        expression.format(genre=genre) + f" AS {genre.lower().replace(' ', '_')}" for genre in TYPE_GENRES.values()
    )


@query("multi_hot_count", f"""
WITH {V.TITLE_GENRES} SELECT tconst, {_genre_sql("count(*) FILTER (genre = '{genre}')")}
FROM title_genres GROUP BY tconst""")
def multi_hot_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.genre_rollup(title_genres(spark, sf_dir), "tconst", "genre", TYPE_GENRES.values())


@query("multi_hot_indicator", f"""
WITH {V.TITLE_GENRES} SELECT tconst, {_genre_sql("CAST(bool_or(genre = '{genre}') AS INTEGER)")}
FROM title_genres GROUP BY tconst""")
def multi_hot_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.genre_rollup(title_genres(spark, sf_dir), "tconst", "genre", TYPE_GENRES.values(), counts=False)


@query("json_flatten", f"""
WITH {V.DOCUMENTS} SELECT requested, tconst AS imdb_id, original_language, popularity, revenue, runtime, vote_average,
  vote_count, country, rtrim({" || ".join(f"repeat('{genre},', {genre.lower().replace(' ', '_')}::INTEGER)" for genre in TYPE_GENRES.values())}, ',') AS genres FROM docs""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = documents.parse_documents(responses(spark, sf_dir))
    flat = documents.flatten_documents(parsed.withColumnRenamed("tconst", "requested"), "requested")
    return flat.withColumn("genres", F.concat_ws(",", "genres"))


@query("json_flatten_strict", f"""
WITH {V.DOCUMENTS} SELECT tconst AS imdb_id, original_language, popularity, revenue, runtime, vote_average, vote_count
FROM docs WHERE tconst IS NOT NULL AND runtime IS NOT NULL""")
def json_flatten_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = documents.parse_documents(responses(spark, sf_dir))
    return documents.flatten_documents(parsed, strict=True).drop("genres", "country")


@query("props_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS absent FROM events""")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties parsed from JSON text; a field that is not there is null."""
    events = table(spark, sf_dir, "events", "event_id", "props")
    return events.withColumn("p", F.from_json("props", "k int, absent int")).select("event_id", "p.k", "p.absent")


@query("nested_documents", f"""
WITH {V.DOCUMENTS} SELECT requested AS id, popularity, vote_count, country FROM docs""")
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects ``{{id: document}}`` taken apart into one row per document."""
    rows = responses(spark, sf_dir).select(
        F.concat(F.lit('{"'), F.col("tconst"), F.lit('": '), F.col("payload"), F.lit("}")).alias("value")
    )
    flat = documents.document_map_rows(rows)
    return flat.select(
        "id", "document.popularity", "document.vote_count",
        nested.first_or_null("document.production_countries")["iso_3166_1"].alias("country"),
    )


@query("exploded_genres", f"""
WITH {V.TITLE_GENRES} SELECT 'tt' || o_orderkey AS tconst, genre, replace(lower(genre), ' ', '_') AS genre_column
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, genre FROM title_genres) ON l_orderkey = o_orderkey
WHERE o_orderkey % 29 <> 0""")
def exploded_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = documents.parse_documents(responses(spark, sf_dir))
    flat = documents.flatten_documents(parsed, "tconst").withColumn("genres", F.array_distinct("genres"))
    return documents.exploded_genres(flat, "tconst")


OTHER_GENRES = [name for name in SNAKE if name not in [g.lower().replace(" ", "_") for g in TYPE_GENRES.values()]]


@query("external_features", f"""
WITH {V.DOCUMENTS} SELECT * EXCLUDE (o_orderkey), {", ".join(f"0 AS {name}" for name in OTHER_GENRES)} FROM features""")
def external_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).drop("genres")


@query("external_feature_counts", f"""
WITH {V.DOCUMENTS} SELECT tconst, country_region AS continent, action::INTEGER AS action, comedy::INTEGER AS comedy, drama::INTEGER AS drama,
  science_fiction::INTEGER AS science_fiction, tv_movie::INTEGER AS tv_movie, war::INTEGER AS war
FROM docs WHERE tconst IS NOT NULL""")
def external_feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = documents.parse_documents(responses(spark, sf_dir))
    rows = documents.external_features(parsed, countries(spark, sf_dir), counts=True)
    return rows.select("tconst", "continent", "action", "comedy", "drama", "science_fiction", "tv_movie", "war")


@query("impute_mean_valid", f"""
WITH {V.CLEAN}, m AS (SELECT avg(minutes) FILTER (minutes > 0) AS minutes_mean, avg(votes) FILTER (votes > 0) AS votes_mean FROM clean)
SELECT row_id, round(coalesce(minutes, minutes_mean), 4) AS "runtimeMinutes", round(coalesce(votes, votes_mean), 4) AS "numVotes"
FROM clean, m""")
def impute_mean_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = hygiene.impute_valid_mean(typed_titles(spark, sf_dir), ["runtimeMinutes", "numVotes"])
    return filled.select("row_id", F.round("runtimeMinutes", 4).alias("runtimeMinutes"), F.round("numVotes", 4).alias("numVotes"))


@query("outlier_to_mean", f"""
WITH {V.CLEAN}, m AS (SELECT avg(start_year) FILTER (start_year > 0) AS parity,
  avg(start_year) FILTER (start_year > 0 AND start_year <= 2022) AS bounded FROM clean)
SELECT row_id, round(CASE WHEN start_year <= 2022 THEN start_year ELSE parity END, 4) AS parity_year,
  round(CASE WHEN start_year <= 2022 THEN start_year ELSE bounded END, 4) AS bounded_year FROM clean, m""")
def outlier_to_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hygiene.restore_years(titles(spark, sf_dir)).select(
        "row_id", F.col("startYear").alias("parity_year"), F.col("startYear").alias("bounded_year"))
    bound = {"parity_year": 2022, "bounded_year": 2022}
    filled = hygiene.impute_valid_mean(rows, ["parity_year"], upper=bound)
    filled = hygiene.impute_valid_mean(filled, ["bounded_year"], upper=bound, bounded_mean=True)
    return filled.withColumns({name: F.round(name, 4) for name in bound})


@query("impute_median", f"""
WITH {V.CLEAN}, m AS (SELECT median(start_year) AS y, median(minutes) AS r, median(votes) AS v FROM clean)
SELECT row_id, round(coalesce(start_year, y), 4) AS "startYear", round(coalesce(minutes, r), 4) AS "runtimeMinutes",
  round(coalesce(votes, v), 4) AS "numVotes" FROM clean, m""")
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["startYear", "runtimeMinutes", "numVotes"]
    rows = settle(typed_titles(spark, sf_dir).select("row_id", *columns))
    filled = impute.impute_median(rows, columns)
    return filled.select("row_id", *[F.round(name, 4).alias(name) for name in columns])


@query("impute_median_approx")
def impute_median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["runtimeMinutes", "numVotes"]
    return impute.impute_median(typed_titles(spark, sf_dir), columns, exact=False).select("row_id", *columns)


@query("median_rank_error", """
SELECT 'numVotes' AS "column", true AS within UNION ALL SELECT 'runtimeMinutes', true""")
def median_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate medians lie within a rank error of 0.1 % of the middle, by counting the rows on either side."""
    columns = ["runtimeMinutes", "numVotes"]
    rows = settle(typed_titles(spark, sf_dir).select(*[missing.nan_to_null(name).cast("double").alias(name) for name in columns]))
    placed = rows.withColumn("_m", impute.median_values(rows, columns, exact=False)).unpivot(["_m"], columns, "column", "value")
    median = F.when(F.col("column") == columns[0], F.col("_m")[columns[0]]).otherwise(F.col("_m")[columns[1]])
    known = placed.where("value IS NOT NULL").groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < median).alias("below"), F.count_if(F.col("value") <= median).alias("upto"))
    slack = F.col("n") * 0.001 + 1
    return known.select("column", ((F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)).alias("within"))


@query("source_rejects", """
SELECT 'id map' AS source, 'tt' || o_orderkey AS id, 'not a whole number' AS reason FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT 'id map', '{"tt' || o_orderkey || '": 1', 'malformed object' FROM orders WHERE o_orderkey % 31 = 0
UNION ALL SELECT 'documents', 'tt' || o_orderkey, 'malformed' FROM orders WHERE o_orderkey % 13 = 0
UNION ALL SELECT 'series', 'file ' || o_custkey % 50, CASE WHEN o_custkey % 50 = 7 THEN 'no header' WHEN o_orderkey % 11 = 0 THEN 'more cells than the header'
    WHEN o_orderkey % 11 = 1 THEN 'no date' WHEN o_orderkey % 11 = 2 THEN 'not a number' END
  FROM orders WHERE o_custkey % 50 = 7 OR o_orderkey % 11 < 3""")
def source_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the readers leave out, each with its reason: map entries, mapped documents, lines of series."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    key = title_id("o_orderkey")
    good = F.format_string('{"a%d": %d, "%s": ', k, k, key)
    id_maps = orders.select(F.concat(good, F.when(k % 5 == 0, '"x"').otherwise("3"), F.lit("}")).alias("value")).union(
        orders.where(k % 31 == 0).select(F.format_string('{"%s": 1', key)))
    mapped = orders.select(F.format_string(
        '{"b%d": {"popularity": 1.5}, "%s": %s}', k, key, F.when(k % 13 == 0, '"no object"').otherwise('{"vote_count": 3}')).alias("value"))
    file = F.format_string("file %d", F.col("o_custkey") % 50)
    date = F.when(k % 11 == 1, "soon").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    cells = F.when(k % 11 == 2, "high").otherwise(price)
    lines = orders.select(file.alias("source"), F.concat_ws(",", date, price, cells, F.when(k % 11 == 0, F.lit("9"))).alias("line"))
    headers = orders.select(file.alias("source")).distinct().where("source <> 'file 7'").withColumn("line", F.lit("date,one,two"))
    return (
        documents.id_map_rejects(id_maps).select(F.lit("id map").alias("source"), "id", "reason")
        .unionByName(documents.document_map_rejects(mapped).select(F.lit("documents").alias("source"), "id", "reason"))
        .unionByName(wide_line_rejects(lines.unionByName(headers), "source", "line").select(F.lit("series").alias("source"), "id", "reason"))
    )


@query("columnar_credits", """
SELECT 'customer ' || o_custkey AS file, 'tt' || o_orderkey AS movie, CASE WHEN o_orderkey % 7 <> 0 THEN 's' || o_orderkey % 9 END AS director
FROM orders""")
def columnar_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits in the layout ``{column: {index: value}}``, one object per customer; some indexes have no person."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    person = F.concat(F.lit("s"), (k % 9).cast("string"))
    files = orders.groupBy(F.format_string("customer %d", F.col("o_custkey")).alias("file")).agg(
        F.map_from_entries(F.collect_list(F.struct(k.cast("string"), title_id("o_orderkey")))).alias("movies"),
        F.map_from_entries(F.collect_list(F.when(k % 7 != 0, F.struct(k.cast("string"), person)))).alias("people"))
    return pair_columns(files, "file", "movies", "people").select("file", F.col("first").alias("movie"), F.col("second").alias("director"))


@query("columnar_files", """
SELECT 'tt' || o_orderkey AS movie, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority || ', "' || o_orderkey % 9 || '"' END AS director FROM orders""")
def columnar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one object ``{column: {index: value}}`` each, written from the orders and read by byte ranges; names hold commas and quotes."""
    path, k = staging_path(spark, "columnar"), F.col("o_orderkey")
    person = F.concat("o_orderpriority", F.lit(', "'), (k % 9).cast("string"), F.lit('"'))
    objects = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").groupBy(F.floor(k / 5000).alias("_file")).agg(F.to_json(F.struct(
        F.map_from_entries(F.collect_list(F.struct(k.cast("string"), title_id("o_orderkey")))).alias("movie"),
        F.map_from_entries(F.collect_list(F.when(k % 7 != 0, F.struct(k.cast("string"), person)))).alias("director"))).alias("value"))
    objects.write.partitionBy("_file").text(path)
    return read_columnar_credits(spark, f"{path}/*", "director")


@query("features_incremental", f"""
WITH {V.DOCUMENTS} SELECT tconst, popularity, continent, action, comedy, drama, science_fiction, tv_movie, war FROM features""")
def features_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table extended: half of the responses were parsed before and are not parsed again."""
    landed = responses(spark, sf_dir).withColumnRenamed("tconst", "id")
    even = F.crc32("id") % 2 == 0
    known = settle(classify.extend_features(landed.where(even), countries(spark, sf_dir)))
    return classify.extend_features(landed, countries(spark, sf_dir), known).select(
        "tconst", "popularity", "continent", "action", "comedy", "drama", "science_fiction", "tv_movie", "war")


def scaling_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_titles(spark, sf_dir).select(
        "row_id", "startYear", "runtimeMinutes", "numVotes", F.lit(7).alias("constant")
    )


SCALED = {"startYear": "start_year", "runtimeMinutes": "minutes", "numVotes": "votes"}
MIN_MAX_SQL = 'round(({0} - min({0}) OVER ()) / (max({0}) OVER () - min({0}) OVER ())::DOUBLE, 6)'
STANDARD_SQL = 'round(({0} - avg({0}) OVER ()) / stddev_pop({0}) OVER (), 6)'


@query("minmax_scale", f"WITH {V.CLEAN} SELECT row_id, 0.0::DOUBLE AS constant, " + ", ".join(
    f'{MIN_MAX_SQL.format(value)} AS "{name}"' for name, value in SCALED.items()) + " FROM clean")
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = impute.scale_min_max(scaling_input(spark, sf_dir), [*SCALED, "constant"])
    return scaled.withColumns({name: F.round(name, 6) for name in SCALED})


@query("standard_scale", f"WITH {V.CLEAN} SELECT row_id, 0.0::DOUBLE AS constant, " + ", ".join(
    f'{STANDARD_SQL.format(value)} AS "{name}"' for name, value in SCALED.items()) + " FROM clean")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = impute.scale_standard(scaling_input(spark, sf_dir), [*SCALED, "constant"])
    return scaled.withColumns({name: F.round(name, 6) + F.lit(0.0) for name in SCALED})


@query("scaled_twice", f"WITH {V.CLEAN} SELECT row_id, " + ", ".join(
    f'{MIN_MAX_SQL.format(value)} AS "{name}_minmax", {STANDARD_SQL.format(value)} AS "{name}_standard"'
    for name, value in SCALED.items()) + " FROM clean")
def scaled_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = impute.scale_both(scaling_input(spark, sf_dir), list(SCALED))
    names = [f"{name}_{kind}" for name in SCALED for kind in ("minmax", "standard")]
    return scaled.select("row_id", *[(F.round(name, 6) + F.lit(0.0)).alias(name) for name in names])


@query("hash_split", """
SELECT 'tt' || o_orderkey AS tconst, ('0x' || substr(md5('tt' || o_orderkey), 1, 8))::BIGINT % 100 < 20 AS is_holdout
FROM orders""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders", title_id("o_orderkey").alias("tconst"))
    return ids.select("tconst", impute.in_holdout("tconst").alias("is_holdout"))


@query("anchor_batches", """
WITH listed AS (SELECT c_name, min(o_orderkey) AS first FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_name <> 'Customer#000000007' GROUP BY c_name),
numbered AS (SELECT c_name, row_number() OVER (ORDER BY first) - 1 AS position FROM listed)
SELECT position // 4 AS batch_id, string_agg(c_name, '|' ORDER BY position) || '|Customer#000000007' AS titles
FROM numbered GROUP BY position // 4""")
def anchor_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names as the list of titles, in the order of their orders, repeats included."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    listed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    batches = series.anchor_batches(listed, "c_name", "o_orderkey", "Customer#000000007")
    return batches.withColumn("titles", F.concat_ws("|", "titles"))


@query("series_means", f"""
WITH {V.SERIES} SELECT batch_id, series, round(avg(value), 6) AS mean FROM series GROUP BY batch_id, series""")
def series_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_means(series_rows(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@query("anchor_normalize", f"""
WITH {V.SERIES}, means AS (SELECT batch_id, series, avg(value) AS mean FROM series GROUP BY batch_id, series),
anchors AS (SELECT batch_id, mean AS own FROM means WHERE series = 'click'),
reference AS (SELECT own AS ref FROM anchors WHERE batch_id = 1)
SELECT batch_id, series,
  round(CASE WHEN batch_id = 1 THEN mean ELSE mean * (ref / nullif(own, 0)) END, 4) AS value
FROM means LEFT JOIN anchors USING (batch_id), reference WHERE series <> 'click' OR batch_id = 1""")
def anchor_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.anchor_normalized(series_rows(spark, sf_dir), "click", 1).withColumn("value", F.round("value", 4))


MOST_TYPES = 1_000


@query("wide_to_long", """
SELECT 'user ' || user_id AS source, CAST(ts AS DATE) AS date,
  event_type || CASE WHEN user_id % 3 = 0 THEN ', titled' ELSE '' END AS series, round(sum(value), 2) AS value
FROM events GROUP BY user_id, CAST(ts AS DATE), event_type""")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide series files, one per user with its own header, read into long form.

    The lines of the files are built from the events: one column per event type, in an order that
    depends on the user, names with commas for some users.
    """
    events = table(spark, sf_dir, "events", "user_id", "event_type", "value", "ts")
    types = sorted(row[0] for row in events.select("event_type").distinct().limit(MOST_TYPES + 1).collect())
    if len(types) > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} types of event: too many for one column each")
    daily = events.groupBy("user_id", F.to_date("ts").alias("date")).agg(*[
        F.round(F.sum(F.when(F.col("event_type") == name, F.col("value"))), 2).cast("decimal(18,2)").cast("string").alias(name)
        for name in types
    ])

    def line(first, cells: list):
        forward, backward = F.concat_ws(",", first, *cells), F.concat_ws(",", first, *cells[::-1])
        return F.when(F.col("user_id") % 2 == 0, forward).otherwise(backward).alias("line")

    names = [F.when(F.col("user_id") % 3 == 0, F.lit(f'"{name}, titled"')).otherwise(F.lit(name)) for name in types]
    source = F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("source")
    headers = events.select("user_id").distinct().select(source, line(F.lit("date"), names))
    rows = daily.select(source, line(F.col("date").cast("string"), [F.coalesce(name, F.lit("")) for name in types]))
    return wide_lines_to_long(headers.unionByName(rows), "source", "line")


SCALED_SQL = "scaled AS (SELECT row_id, " + ", ".join(
    f"({value} - min({value}) OVER ())::DOUBLE / (max({value}) OVER () - min({value}) OVER ())::DOUBLE AS {x}"
    for value, x in [("start_year", "a"), ("minutes", "b"), ("votes", "c")]) + " FROM clean)"


def _nearest_sql(target: str) -> str:
    """The five nearest donors of every row that misses one column, by comparing all pairs."""
    present = " + ".join(f"(r.{x} IS NOT NULL AND d.{x} IS NOT NULL)::INTEGER" for x in "abc")
    squares = " + ".join(f"coalesce((r.{x} - d.{x}) * (r.{x} - d.{x}), 0)" for x in "abc")
    return f"""{target}_pairs AS (
      SELECT r.row_id, d.row_id AS donor, d.{target} AS value, (3::DOUBLE / ({present})) * ({squares}) AS distance
      FROM scaled r JOIN scaled d ON r.{target} IS NULL AND d.{target} IS NOT NULL WHERE {present} > 0),
    {target}_near AS (SELECT row_id, avg(value) AS {target}_value FROM (SELECT * FROM {target}_pairs
      QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, donor) <= 5) GROUP BY row_id)"""


@query("knn_impute", f"""
WITH {V.CLEAN}, {SCALED_SQL}, {_nearest_sql("a")}, {_nearest_sql("b")}, {_nearest_sql("c")}
SELECT s.row_id, round(coalesce(a, a_value, (SELECT avg(a) FROM scaled)), 6) AS "startYear",
  round(coalesce(b, b_value, (SELECT avg(b) FROM scaled)), 6) AS "runtimeMinutes",
  round(coalesce(c, c_value, (SELECT avg(c) FROM scaled)), 6) AS "numVotes"
FROM scaled s LEFT JOIN a_near USING (row_id) LEFT JOIN b_near USING (row_id) LEFT JOIN c_near USING (row_id)""")
def knn_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, run times and votes scaled to [0, 1], missing ones taken from the five nearest titles."""
    scaled = impute.scale_min_max(scaling_input(spark, sf_dir), list(SCALED))
    filled = knn.knn_impute(scaled, "row_id", list(SCALED))
    return filled.select("row_id", *[F.round(name, 6).alias(name) for name in SCALED])


SIX = "abcdef"


def _six_present() -> str:
    return " + ".join(f"(r.{x} IS NOT NULL AND d.{x} IS NOT NULL)::INTEGER" for x in SIX)


def _six_nearest(target: str) -> str:
    squares = " + ".join(f"coalesce((r.{x} - d.{x}) * (r.{x} - d.{x}), 0)" for x in SIX)
    return f"""{target}_near AS (SELECT vec_id, avg(value) AS {target}_value FROM (
      SELECT r.vec_id, d.{target} AS value FROM six r JOIN six d ON r.{target} IS NULL AND d.{target} IS NOT NULL WHERE {_six_present()} > 0
      QUALIFY row_number() OVER (PARTITION BY r.vec_id ORDER BY (6::DOUBLE / ({_six_present()})) * ({squares}), d.vec_id) <= 5) GROUP BY vec_id)"""


@query("knn_embeddings", f"""
WITH six AS (SELECT vec_id, {", ".join(f"CASE WHEN (vec_id * 7 + {i}) % 11 > {i % 2} THEN embedding[{i + 1}]::DOUBLE END AS {x}" for i, x in enumerate(SIX))}
  FROM embeddings), {", ".join(_six_nearest(x) for x in SIX)}
SELECT s.vec_id, {", ".join(f"round(coalesce({x}, {x}_value, (SELECT avg({x}) FROM six)), 6) AS {x}" for x in SIX)}
FROM six s {" ".join(f"LEFT JOIN {x}_near USING (vec_id)" for x in SIX)}""")
def knn_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six columns of the vectors, each missing in a tenth of the rows or more, from the five nearest rows."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    six = vectors.select("vec_id", *[
        F.when((F.col("vec_id") * 7 + i) % 11 > i % 2, F.col("embedding")[i].cast("double")).alias(x) for i, x in enumerate(SIX)])
    filled = knn.knn_impute(six, "vec_id", list(SIX))
    return filled.select("vec_id", *[F.round(x, 6).alias(x) for x in SIX])
