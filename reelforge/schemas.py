"""Schemas of every input. Sources never infer types."""

from pyspark.sql import types as T

TITLES_CSV = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("tconst", T.StringType()),
    T.StructField("primaryTitle", T.StringType()),
    T.StructField("originalTitle", T.StringType()),
    T.StructField("startYear", T.StringType()),
    T.StructField("endYear", T.StringType()),
    T.StructField("runtimeMinutes", T.StringType()),
    T.StructField("numVotes", T.StringType()),
    T.StructField("label", T.StringType()),
])
HIDDEN_TITLES_CSV = T.StructType(TITLES_CSV.fields[:-1])

# The lookup keeps codes as text: they carry leading zeros, and "NA" is Namibia.
COUNTRIES_CSV = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "name", "alpha-2", "alpha-3", "country-code", "iso_3166-2", "region", "sub-region",
        "intermediate-region", "region-code", "sub-region-code", "intermediate-region-code",
    )
])

DOCUMENT = T.StructType([
    T.StructField("imdb_id", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("runtime", T.IntegerType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.IntegerType()),
    T.StructField("genres", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())]))),
    T.StructField("production_countries", T.ArrayType(T.StructType([
        T.StructField("iso_3166_1", T.StringType()), T.StructField("name", T.StringType())]))),
])

ITEMS_CSV = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
])

CREDIT_LINES = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("movie", "tconst", "director", "director_id", "writer", "writer_id")
])

LANDED = T.StructType([T.StructField("id", T.StringType()), T.StructField("payload", T.StringType())])

REJECT_EVENTS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("at", T.TimestampType())])
