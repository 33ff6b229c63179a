"""Repair of raw title tables."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.constants import LAST_VALID_YEAR
from reelforge.functions import missing, text
from reelforge.functions.numeric import broken_rules


def sentinels_to_null(df: DataFrame) -> DataFrame:
    """Every sentinel text and every NaN of a frame becomes null, in one projection."""
    cleaned = []
    for name, dtype in df.dtypes:
        if dtype == "string":
            cleaned.append(missing.to_null(F.col(f"`{name}`")).alias(name))
        elif dtype in ("double", "float"):
            cleaned.append(F.nanvl(F.col(f"`{name}`"), F.lit(None).cast(dtype)).alias(name))
        else:
            cleaned.append(F.col(f"`{name}`"))
    return df.select(*cleaned)


def restore_years(df: DataFrame, start: str = "startYear", end: str = "endYear") -> DataFrame:
    """Start year as int, taken from the end year where that is where it was stored; end year dropped."""
    return df.withColumn(start, missing.first_int(start, end)).drop(end)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split a frame into rows that keep all rules and rejects with the names of the rules they broke."""
    checked = df.withColumn("reasons", broken_rules(rules))
    return (
        checked.where(F.size("reasons") == 0).drop("reasons"),
        checked.where(F.size("reasons") > 0),
    )


def reject_rows(df: DataFrame, key: str, reason: Column) -> DataFrame:
    """``(id, reason)`` of the rows whose reason is not null."""
    return df.select(F.col(key).cast("string").alias("id"), reason.alias("reason")).where("reason is not null")


def new_rejects(rejects: DataFrame, logged: DataFrame) -> DataFrame:
    """Rejects not logged before, each once."""
    return rejects.dropDuplicates(["id", "reason"]).join(logged, ["id", "reason"], "left_anti")


def valid_means(df: DataFrame, columns: Iterable[str], upper: Mapping[str, float] | None = None) -> Column:
    """Struct of the means over positive values of several columns, as one scalar subquery.

    ``upper`` optionally leaves values above a bound out of the mean as well.
    """
    upper = upper or {}
    means = []
    for name in columns:
        counted = F.col(name) > 0
        if name in upper:
            counted = counted & (F.col(name) <= F.lit(upper[name]))
        means.append(F.avg(F.when(counted, F.col(name))).alias(name))
    return df.agg(F.struct(*means).alias("means")).scalar()


def impute_valid_mean(df: DataFrame, columns: list[str], upper: Mapping[str, float] | None = None,
                      bounded_mean: bool = False) -> DataFrame:
    """Replace missing values, and values above an upper bound, by the mean of the positive values.

    The mean takes in the values above the bound unless ``bounded_mean`` is set. All means come from one
    aggregate over the frame; results are double.
    """
    upper = upper or {}
    # attached once: a scalar subquery repeats its plan wherever it is mentioned
    with_means = df.withColumn("_means", valid_means(df, columns, upper if bounded_mean else None))
    filled = {}
    for name in columns:
        value = F.col(name).cast("double")
        usable = value.isNotNull() & (value >= 0)
        if name in upper:
            usable = usable & (value <= F.lit(upper[name]))
        filled[name] = F.when(usable, value).otherwise(F.col("_means")[name])
    return with_means.withColumns(filled).drop("_means")


def clean_titles(df: DataFrame) -> DataFrame:
    """The whole cleaning pass: years, run times and votes imputed, titles cleaned, foreign flag set."""
    typed = df.withColumns({
        "startYear": missing.to_int("startYear"),
        "endYear": missing.int_or_default("endYear", -1),
        "runtimeMinutes": missing.to_int("runtimeMinutes"),
        "numVotes": missing.nan_to_null(F.col("numVotes")).try_cast("bigint"),
        "primaryTitle": missing.text_or_empty("primaryTitle"),
        "originalTitle": missing.text_or_empty("originalTitle"),
    })
    imputed = impute_valid_mean(
        typed, ["startYear", "runtimeMinutes", "numVotes"], upper={"startYear": LAST_VALID_YEAR}
    )
    return imputed.withColumn("foreignMovie", text.is_foreign("primaryTitle", "originalTitle"))
