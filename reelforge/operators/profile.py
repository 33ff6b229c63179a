"""Profiles of tables: counts, means, medians, quartiles, nulls, correlations."""

from itertools import combinations, combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.constants import SENTINELS
from reelforge.operators.durable import settle
from reelforge.operators.quantiles import exact_medians, exact_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value with its count; of equally frequent values the smallest."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(1)


def group_counts(df: DataFrame, group: str, counted: str, alias: str) -> DataFrame:
    """Non-null values per group; rows without a group are left out."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(counted).alias(alias))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The k rows with the largest values, missing values last, ties by key."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(key)).limit(k)


def group_profile(df: DataFrame, group: str, value: str, key: str) -> DataFrame:
    """Mean and median of a value, and number of rows, per group.

    Reads ``df`` three times; settle it first if it is costly to compute. So do ``column_summary`` and the
    exact ``impute.impute_median``.
    """
    known = df.where(F.col(group).isNotNull())
    means = known.groupBy(group).agg(F.avg(value).alias("mean_value"), F.count(key).alias("n"))
    return means.join(exact_medians(known, [group], value, "median_value"), group, "left")


def level_profile(df: DataFrame, dimensions: list[str], value: str, levels: list[list[str]] | None = None) -> DataFrame:
    """Rows, mean and exact median of a value at several levels of grouping: ``level``, the dimensions, ``n``, ``mean``, ``median``.

    ``levels`` lists the grouping sets, all subsets of the dimensions (a cube) unless given; ``rollup_levels`` gives those of a
    roll-up. ``level`` names the dimensions that a row is grouped by; the others are null in it, as is a dimension whose value is
    null. Every row stands once in each level; counts and means are combined map-side, and medians come from
    ``exact_quantiles``, so the level of all rows together is as safe as any.
    """
    levels = levels if levels is not None else [list(some) for size in range(len(dimensions), -1, -1) for some in combinations(dimensions, size)]
    keys = [f"_k{i}" for i in range(len(dimensions))]
    texts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit("")) for name in dimensions]  # quantiles need groups without nulls
    sets = F.array(*[F.struct(
        F.lit(",".join(level)).alias("level"), *[(text if name in level else F.lit("")).alias(key) for name, text, key in zip(dimensions, texts, keys)],
        *[(F.col(f"`{name}`") if name in level else F.lit(None).cast(df.schema[name].dataType)).alias(name) for name in dimensions]) for level in levels])
    rows = settle(df.select(F.explode(sets).alias("_set"), F.col(value).cast("double").alias("_value")).select("_set.*", "_value"))
    stats = rows.groupBy("level", *keys, *dimensions).agg(F.count(F.lit(1)).alias("n"), F.avg("_value").alias("mean"))
    medians = exact_medians(rows, ["level", *keys], "_value", "median")
    return stats.join(medians, ["level", *keys], "left").select("level", *dimensions, "n", "mean", "median")


def rollup_levels(dimensions: list[str]) -> list[list[str]]:
    return [dimensions[:size] for size in range(len(dimensions), -1, -1)]


def _stacked(df: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """A one-row frame of ``<field>_<i>`` columns as one row per name."""
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{field}_{i}").alias(field) for field in fields])
        for i, name in enumerate(names)
    ]
    return df.select(F.explode(F.array(*rows)).alias("r")).select(
        "r.column", *[F.col(f"r.{field}").cast(dtype).alias(field) for field, dtype in fields.items()]
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls, and whether there is any, per column, from one aggregate."""
    names = df.columns
    counted = df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(f"n_null_{i}") for i, name in enumerate(names)])
    stacked = _stacked(counted, names, {"n_null": "bigint"})
    return stacked.withColumn("any_null", F.col("n_null") > 0)


def column_types(df: DataFrame) -> DataFrame:
    """Names and types of a frame, as a frame."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles and maximum per numeric column."""
    numbers = df.select(*[
        F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias(name) for name in columns
    ])
    measures = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    counted = numbers.agg(*[
        function(name).alias(f"{field}_{i}")
        for i, name in enumerate(columns) for field, function in measures.items()
    ])
    basics = _stacked(counted, columns, {"n": "bigint", "mean": "double", "std": "double", "min": "double",
                                         "max": "double"})
    long = numbers.unpivot([], columns, "column", "value")
    quartiles = exact_quantiles(long, ["column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return basics.join(quartiles, "column", "left")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, pairwise complete, from one aggregate."""
    pairs = list(combinations_with_replacement(columns, 2))

    def known(name: str):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))

    counted = df.agg(*[F.corr(known(a), known(b)).alias(f"corr_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"corr_{i}").alias("corr"))
        for i, pair in enumerate(pairs) for a, b in dict.fromkeys([pair, pair[::-1]])
    ]
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def column_profile(df: DataFrame) -> DataFrame:
    """Nulls, sentinel texts, distinct values, smallest and largest text per column.

    Values are first counted per (column, value), so a value that fills a third of a column is collapsed
    map-side, and only then rolled up per column.
    """
    texts = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])
    values = texts.unpivot([], df.columns, "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return values.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(F.col("value").isin(*SENTINELS), F.col("n"))), F.lit(0)).alias("n_sentinel"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def partition_sums(df: DataFrame, column: str) -> DataFrame:
    """Sum of a column per partition of the frame, NaN and null counted as zero."""
    value = F.coalesce(F.nanvl(F.col(column), F.lit(0.0)), F.lit(0.0))
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_rows")
    )


def partition_total(df: DataFrame, column: str) -> DataFrame:
    """The partition sums added up."""
    return partition_sums(df, column).agg(F.sum("total").alias("total"), F.sum("n_rows").alias("n_rows"))
