"""Column profiles as sketches: one pass, a few kilobytes a column, and merged from run to run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12  # 2^12 registers: a relative standard error of about 1.6 %
STANDARD_ERROR = 1.04 / 2 ** (PRECISION / 2)
HEAVY = 100
TRACKED = 10_000


def column_sketches(df: DataFrame, columns: list[str] | None = None, precision: int = PRECISION, tracked: int = TRACKED) -> DataFrame:
    """One row per column: ``column``, ``n_rows``, ``n_null``, ``distinct_sketch`` (HyperLogLog), ``heavy_sketch`` (frequent items).

    One aggregate over the frame, combined map-side; values count as text, null apart. Store the rows and give them to
    ``merged`` with those of other runs or parts: the result is that of one run over all rows.
    """
    columns = columns or df.columns
    texts = df.select(*[F.col(f"`{name}`").cast("string").alias(f"c{i}") for i, name in enumerate(columns)])
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i in range(len(columns)):
        aggregates += [F.count(f"c{i}").alias(f"v{i}"), F.hll_sketch_agg(f"c{i}", F.lit(precision)).alias(f"d{i}"),
                       F.expr(f"approx_top_k_accumulate(c{i}, {tracked})").alias(f"h{i}")]
    one = texts.agg(*aggregates)
    rows = F.array(*[F.struct(
        F.lit(name).alias("column"), F.col("n").alias("n_rows"), (F.col("n") - F.col(f"v{i}")).alias("n_null"),
        F.col(f"d{i}").alias("distinct_sketch"), F.col(f"h{i}").alias("heavy_sketch")) for i, name in enumerate(columns)])
    return one.select(F.inline(rows))


def merged(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Rows of ``column_sketches`` of several runs or parts as one row per column."""
    return sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"approx_top_k_combine(heavy_sketch, {tracked})").alias("heavy_sketch"))


def sketch_report(sketches: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``column``, ``n_rows``, ``n_null``, ``n_distinct`` (estimated), ``heavy``: up to ``heavy`` (value, n), most frequent first.

    The estimate of different values has a relative standard error of ``STANDARD_ERROR``. Counts of frequent values are exact
    while a column has at most three quarters of ``TRACKED`` different values; beyond that they are upper bounds, and every value of more than about
    3.5 / ``TRACKED`` of the rows is among them.
    """
    items = F.filter(F.expr(f"approx_top_k_estimate(heavy_sketch, {heavy})"), lambda x: x["item"].isNotNull())
    return sketches.select(
        "column", "n_rows", "n_null", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.transform(items, lambda x: F.struct(x["item"].alias("value"), x["count"].alias("n"))).alias("heavy"))
