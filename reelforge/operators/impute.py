"""Median imputation and scaling."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.functions.missing import nan_to_null
from reelforge.operators.quantiles import exact_medians


def median_values(df: DataFrame, columns: list[str], exact: bool = True) -> Column:
    """Struct of the medians of several columns, as one scalar subquery."""
    if exact:
        long = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
        medians = exact_medians(long.unpivot([], columns, "column", "value"), ["column"], "value", "median")
        picked = [F.max(F.when(F.col("column") == name, F.col("median"))).alias(name) for name in columns]
        return medians.agg(F.struct(*picked).alias("medians")).scalar()
    picked = [F.percentile_approx(nan_to_null(F.col(name)), 0.5, 1000).alias(name) for name in columns]
    return df.agg(F.struct(*picked).alias("medians")).scalar()


def fill_with(df: DataFrame, columns: list[str], values: Column) -> DataFrame:
    """Replace null and NaN by the fields of a struct, such as a fitted scalar subquery."""
    # attached once: a scalar subquery repeats its plan wherever it is mentioned
    return df.withColumn("_values", values).withColumns({
        name: F.coalesce(nan_to_null(F.col(name).cast("double")), F.col("_values")[name]) for name in columns
    }).drop("_values")


def impute_median(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Replace null and NaN by the column's median, exact or within a rank error of 0.1 %."""
    return fill_with(df, columns, median_values(df, columns, exact))


def scaling(df: DataFrame, columns: list[str]) -> Column:
    """What both scalers need to know about ``df``, as one scalar subquery; use it on any frame.

    The divisors ``width`` and ``spread`` are null for a constant column. They are made here and not per row: of six columns
    scaled twice, the longer expressions make a method of more than the 8,000 bytes that the JVM compiles.
    """
    measures = []
    for name in columns:
        value = nan_to_null(F.col(name).cast("double"))
        lowest, deviation = F.min(value), F.stddev_pop(value)
        measures.append(F.struct(
            lowest.alias("min"), F.nullif(F.max(value) - lowest, F.lit(0.0)).alias("width"),
            F.avg(value).alias("mean"), F.nullif(deviation, F.lit(0.0)).alias("spread"),
        ).alias(name))
    return df.agg(F.struct(*measures).alias("scaling")).scalar()


def _rescaled(column: str, fitted: Column, origin: str, divisor: str) -> Column:
    value, measures = nan_to_null(F.col(column).cast("double")), fitted[column]
    return F.when(value.isNotNull() & measures[divisor].isNull(), 0.0).otherwise((value - measures[origin]) / measures[divisor])


def min_max(column: str, fitted: Column) -> Column:
    """Scaled to [0, 1]; a constant column becomes 0 and null stays null."""
    return _rescaled(column, fitted, "min", "width")


def standard(column: str, fitted: Column) -> Column:
    """Centred and divided by the population standard deviation; a constant column becomes 0."""
    return _rescaled(column, fitted, "mean", "spread")


def _scaled(df: DataFrame, columns: list[str], fitted: Column | None, scalers: dict) -> DataFrame:
    fitted = scaling(df, columns) if fitted is None else fitted
    return df.withColumn("_fitted", fitted).withColumns({
        name + suffix: scaler(name, F.col("_fitted")) for suffix, scaler in scalers.items() for name in columns
    }).drop("_fitted")


def scale_min_max(df: DataFrame, columns: list[str], fitted: Column | None = None) -> DataFrame:
    return _scaled(df, columns, fitted, {"": min_max})


def scale_standard(df: DataFrame, columns: list[str], fitted: Column | None = None) -> DataFrame:
    return _scaled(df, columns, fitted, {"": standard})


def scale_both(df: DataFrame, columns: list[str], fitted: Column | None = None) -> DataFrame:
    """The same columns scaled twice, as ``<name>_minmax`` and ``<name>_standard``."""
    return _scaled(df, columns, fitted, {"_minmax": min_max, "_standard": standard})


def in_holdout(key: str, percent: int = 20) -> Column:
    """Stable split by a hash of the key: true for about ``percent`` % of the keys."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return digest % 100 < percent
