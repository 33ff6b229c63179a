"""The given tables in the roles of the title pipeline.

The tables hold no missing values, so each role puts them in by a fixed rule on the key: rows are changed,
never left out. ``sql_views`` states the same roles for the oracle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.operators.documents import external_features, parse_documents

# ---- fixed values: part type -> genre that stands for it ----
TYPE_GENRES = {
    "ECONOMY": "Action", "LARGE": "Comedy", "MEDIUM": "Drama", "PROMO": "Science Fiction",
    "SMALL": "TV Movie", "STANDARD": "War",
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def title_id(key: str) -> Column:
    return F.concat(F.lit("tt"), F.col(key).cast("string"))


def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity")
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").cast("int").alias("minutes")
    )


def titles(spark: SparkSession, sf_dir: str, with_run_times: bool = True) -> DataFrame:
    """Raw titles from orders: sentinels, misplaced and illegal years, NaN votes, textual labels.

    Run times are sums over the line items; without them that table is not read.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus",
                   "o_orderpriority")
    k = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    priority = F.col("o_orderpriority")
    no_year = F.when(k % 3 == 0, r"\N").when(k % 3 == 1, "nan").otherwise("NULL")
    timed = orders.join(run_times(spark, sf_dir), "o_orderkey", "left") if with_run_times else orders.withColumn("minutes", F.lit(None).cast("int"))
    raw = timed.select(
        k.alias("row_id"),
        title_id("o_orderkey").alias("tconst"),
        priority.alias("primaryTitle"),
        F.when(k % 10 == 0, "").when(k % 10 == 3, r"\N").when(k % 10 == 5, "NULL")
        .when(k % 10 == 7, F.lit(None)).when(k % 4 == 1, F.concat(priority, F.lit(" é")))
        .otherwise(priority).alias("originalTitle"),
        F.when(k % 7 == 0, no_year).when(k % 17 == 5, "2500").otherwise(year).alias("startYear"),
        F.when((k % 7 == 0) & (k % 11 != 3), year).otherwise(r"\N").alias("endYear"),
        F.when(k % 11 == 0, r"\N").when(F.col("minutes").isNull(), "NULL")
        .otherwise(F.col("minutes").cast("string")).alias("runtimeMinutes"),
        F.when(k % 13 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias("numVotes"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("label"),
        F.when(k % 10 == 0, "validation").when(k % 10 == 1, "test").otherwise("train").alias("split"),
    )
    return raw if with_run_times else raw.drop("runtimeMinutes")


def directing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    unknown = (F.col("l_orderkey") + F.col("l_linenumber")) % 6 == 0
    return lines.select(
        title_id("l_orderkey").alias("movie"),
        F.when(~unknown, F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("director"),
    )


def writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    unknown = (F.col("l_orderkey") + 2 * F.col("l_linenumber")) % 5 == 0
    return lines.select(
        title_id("l_orderkey").alias("movie"),
        F.when(~unknown, F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("writer"),
    )


def row_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: number of the title's row and genre."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type")
    pairs = [F.lit(text) for pair in TYPE_GENRES.items() for text in pair]
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("row_id"), F.create_map(*pairs)[F.col("p_type")].alias("genre")
    )


def title_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: title and genre."""
    return row_genres(spark, sf_dir).select(title_id("row_id").alias("tconst"), "genre")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the country lookup: some withheld, one with an empty region."""
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region")
    return (
        nations.where(F.col("n_nationkey") % 8 != 7)
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("alpha-2"),
            F.when(F.col("n_nationkey") == 4, "").otherwise(F.col("r_name")).alias("region"),
        )
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses ``(tconst, payload)``: JSON text, some of it cut off, some without an id."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type")
    contents = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").cast("int").alias("minutes"),
            *[F.count_if(F.col("p_type") == name).alias(name) for name in TYPE_GENRES],
        )
    )
    k = F.col("o_orderkey")
    # a genre is listed as often as it is met in the title
    mentions = [
        F.array_repeat(F.struct(F.lit(i).alias("id"), F.lit(genre).alias("name")), F.coalesce(name, F.lit(0)).cast("int"))
        for i, (name, genre) in enumerate(TYPE_GENRES.items())
    ]
    code = F.struct(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("iso_3166_1"))
    document = F.struct(
        F.when(k % 23 != 0, title_id("o_orderkey")).alias("imdb_id"),
        F.lower("c_mktsegment").alias("original_language"),
        (F.col("o_totalprice") / 1000).alias("popularity"),
        F.floor("o_totalprice").alias("revenue"),
        F.col("minutes").alias("runtime"),
        (k % 100 / 10).alias("vote_average"),
        (k % 1000).cast("int").alias("vote_count"),
        F.flatten(F.array(*mentions)).alias("genres"),
        F.when(k % 19 == 0, F.array().cast("array<struct<iso_3166_1:string>>"))
        .otherwise(F.array(code)).alias("production_countries"),
    )
    text = F.to_json(document)
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(contents, "o_orderkey", "left")
        .select(
            title_id("o_orderkey").alias("tconst"),
            F.when(k % 29 == 0, F.substring(text, F.lit(1), F.length(text) - 5)).otherwise(text).alias("payload"),
        )
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_documents(responses(spark, sf_dir))
    return external_features(parsed, countries(spark, sf_dir))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as interest series: one batch per user, the anchor ``click`` in every batch."""
    events = table(spark, sf_dir, "events", "user_id", "event_type", "value", "ts")
    is_anchor = F.col("event_type") == "click"
    return events.select(
        F.col("user_id").alias("batch_id"),
        F.to_date("ts").alias("date"),
        F.when(is_anchor, F.col("event_type"))
        .otherwise(F.concat_ws(" ", "event_type", F.col("user_id").cast("string"))).alias("series"),
        F.when(is_anchor & (F.col("user_id") % 37 == 5), 0.0).otherwise(F.col("value")).alias("value"),
    )


