"""Joins that keep the shape of their left side, and joins that stay balanced under hot keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.operators.durable import BROADCAST_ROWS, broadcast_if_small, settle

HOT_ROWS = 1_000_000


def _keys(rows: DataFrame, key: str) -> DataFrame:
    """Different keys only, combined map-side: repeats on the right of a semi- or anti-join cannot be split when they meet."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct()


def enrich(titles: DataFrame, features: DataFrame, key: str = "tconst") -> DataFrame:
    """Titles with their features; titles without features are dropped."""
    return titles.join(features, key, "inner")


def not_yet_done(requested: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been processed before."""
    return requested.join(_keys(done, key), key, "left_anti")


def already_done(requested: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return requested.join(_keys(done, key), key, "left_semi")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks. ``count()`` gives the size of the difference."""
    return left.select(key).distinct().join(_keys(right, key), key, "left_anti")


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that can never multiply the rows of ``left``: one row per key is kept on the right.

    Of repeated keys the smallest row is kept, a choice that does not depend on the run.
    """
    values = [name for name in right.columns if name != key]
    single = right.groupBy(key).agg(F.min(F.struct(*values)).alias("_row")).select(key, "_row.*")
    return left.join(single, key, "left")


def lookup(facts: DataFrame, dimension: DataFrame, key: Column, dimension_key: str, value: str,
           default: str, alias: str | None = None) -> DataFrame:
    """Look up upper-cased codes in a dimension; unknown codes and empty values get the default.

    The dimension is broadcast if it has few rows, and joined by shuffle if not.
    """
    target = alias or value
    table = dimension.select(F.upper(F.col(f"`{dimension_key}`")).alias("_code"), F.col(value).alias("_value"))
    table = table.where(F.col("_code").isNotNull()).groupBy("_code").agg(F.min("_value").alias("_value"))
    return (
        facts.withColumn("_code", F.upper(key))
        .join(broadcast_if_small(table), "_code", "left")
        .withColumn(target, F.coalesce(F.nullif(F.col("_value"), F.lit("")), F.lit(default)))
        .drop("_code", "_value")
    )


def attach_counts(facts: DataFrame, counts: DataFrame, key: str, size: str, how: str = "inner",
                  hot_rows: int = HOT_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join facts to their per-key row counts, balanced when one key holds a third of the facts.

    The counts have one row per key, so only the facts can be skewed: ``spread_join`` cuts a key of over ``hot_rows`` of
    them into as many salts as that takes. Facts with a null key meet no count and are not shuffled.
    """
    counts = counts.select(key, size).where(F.col(key).isNotNull())
    joined = spread_join(facts.where(F.col(key).isNotNull()), counts, [key], how, hot_rows, broadcast_rows).select(*facts.columns, size)
    if how == "inner":
        return joined
    nulls = facts.where(F.col(key).isNull()).withColumn(size, F.lit(None).cast(counts.schema[size].dataType))
    return joined.unionByName(nulls)


def spread_join(facts: DataFrame, table: DataFrame, keys: list[str], how: str = "left", hot_rows: int = HOT_ROWS,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join facts to a table of one row per key, balanced under keys of any number of facts.

    A small table is broadcast. Otherwise a key of over ``hot_rows`` facts is cut into as many salts as its count asks for,
    so that no task gets many more than ``hot_rows`` of its facts; its row of the table is repeated once per salt. Which
    salt a fact has follows from a hash of its columns: facts should be different rows. ``how`` is ``left`` or
    ``inner``; facts with a null among their keys meet nothing.
    """
    table = settle(table)
    small = broadcast_if_small(table, broadcast_rows)
    if small is not table:
        return facts.join(small, keys, how)
    counts = facts.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = broadcast_if_small(settle(counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))), broadcast_rows)
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*facts.columns), F.col("_salts"))).cast("int")
    marked = facts.join(hot, keys, "left").withColumn("_salt", salt).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    spread = table.join(hot, keys, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return marked.join(spread, [*keys, "_salt"], how).drop("_salt")


def spread_many(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join in which a key may have many rows on either side or both.

    A small side is broadcast. Otherwise a key of over ``hot_rows`` rows on a side is cut there into as many salts as its count
    asks for, and the other side's rows of it are repeated for each: the pairs of a hot key lie on a grid of
    tasks of at most ``hot_rows`` rows a side. Rows with a null among their keys meet nothing.
    """
    left, right = settle(left.dropna(subset=keys)), settle(right.dropna(subset=keys))
    for one, other in ((right, left), (left, right)):
        small = broadcast_if_small(one, broadcast_rows)
        if small is not one:
            return other.join(small, keys)

    def hot(rows: DataFrame, salts: str) -> DataFrame:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        return counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias(salts))

    both = broadcast_if_small(settle(hot(left, "_ls").join(hot(right, "_rs"), keys, "full")), broadcast_rows)

    def placed(rows: DataFrame, own: str, theirs: str, own_salt: str, their_salt: str) -> DataFrame:
        marked = rows.join(both, keys, "left")
        salted = marked.withColumn(own_salt, F.pmod(F.xxhash64(*rows.columns), F.coalesce(own, F.lit(1))).cast("int"))
        every = F.sequence(F.lit(0), F.coalesce(theirs, F.lit(1)) - 1)
        return salted.withColumn(their_salt, F.explode(every)).drop("_ls", "_rs")

    grid = placed(left, "_ls", "_rs", "_a", "_b").join(placed(right, "_rs", "_ls", "_b", "_a"), [*keys, "_a", "_b"])
    return grid.drop("_a", "_b")


def merge_map(known: DataFrame, found: DataFrame, key: str, value: str) -> DataFrame:
    """Map tables merged: entries already known win, new keys are added."""
    added = not_yet_done(found.select(key, value), known, key)
    return known.select(key, value).unionByName(added)


def append_rows(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Union of frames with different columns; rows without a key are dropped."""
    return known.unionByName(new, allowMissingColumns=True).dropna(subset=[key])
