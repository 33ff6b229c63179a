"""Global row numbers without a single-task window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.operators.durable import broadcast_if_small, settle

ROWS_PER_BUCKET = 1_000_000


def with_position(df: DataFrame, order_by: str, alias: str = "position", buckets: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order of a column with unique values.

    The rows are dealt by range into buckets of about ``ROWS_PER_BUCKET`` rows, as many as that takes, and stored with their
    bucket, so that a retried task finds every row where it was. Rows are numbered inside their bucket, and the sizes of
    the earlier buckets are added; only the table of bucket sizes is summed in one task. Rows that fit one bucket are sorted and
    numbered as they are. Counts ``df`` first; settle it if it is costly to compute.
    """
    if buckets is None:
        buckets = df.count() // ROWS_PER_BUCKET + 1
        if buckets == 1:
            return df.repartition(1).sortWithinPartitions(order_by).withColumn(alias, F.monotonically_increasing_id())
    bucketed = settle(df.repartitionByRange(max(1, buckets), order_by).withColumn("_bucket", F.spark_partition_id()))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(
        bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("_bucket").orderBy(order_by)
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(broadcast_if_small(offsets), "_bucket")
        .withColumn(alias, F.col("_offset") + F.col("_rank") - 1)
        .drop("_bucket", "_rank", "_offset")
    )
