"""Interest series measured in separate batches that share an anchor series."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.constants import SERIES_PER_BATCH
from reelforge.functions.numeric import rescale
from reelforge.operators.durable import settle
from reelforge.operators.numbering import with_position


def anchor_batches(titles: DataFrame, title: str, order_by: str, anchor: str, size: int = SERIES_PER_BATCH) -> DataFrame:
    """Titles in batches of ``size``, the anchor added to each: ``(batch_id, titles)``.

    A title that occurs several times is asked for once, at its first place in the order.
    """
    listed = (
        titles.where(F.col(title) != anchor)
        .groupBy(title).agg(F.min(order_by).alias("_first"))
    )
    numbered = with_position(settle(listed), "_first")
    return (
        numbered.groupBy(F.floor(F.col("position") / size).alias("batch_id"))
        .agg(F.array_sort(F.collect_list(F.struct("position", title))).alias("_members"))
        .select("batch_id", F.array_append(F.col("_members")[title], F.lit(anchor)).alias("titles"))
    )


def batches_to_fetch(batches: DataFrame, fetched: DataFrame) -> DataFrame:
    return batches.join(fetched.select("batch_id"), "batch_id", "left_anti")


def series_means(long: DataFrame) -> DataFrame:
    """Mean of every series of every batch."""
    return long.groupBy("batch_id", "series").agg(F.avg("value").alias("mean"))


def anchor_normalized(long: DataFrame, anchor: str, reference_batch) -> DataFrame:
    """Series means on the scale of the reference batch: ``(batch_id, series, value)``.

    Each batch is rescaled by (anchor mean in the reference batch / anchor mean in this batch). The
    anchor appears once, with its reference mean. A batch whose anchor mean is zero or missing has null.
    """
    means = series_means(long)
    is_anchor = F.col("series") == anchor
    reference = means.where(is_anchor & (F.col("batch_id") == reference_batch)).agg(F.max("mean")).scalar()
    own = F.max(F.when(is_anchor, F.col("mean"))).over(Window.partitionBy("batch_id"))
    is_reference = F.col("batch_id") == reference_batch
    return means.withColumn("_own", own).where(~is_anchor | is_reference).select(
        "batch_id", "series",
        F.when(is_reference, F.col("mean")).otherwise(rescale("mean", reference, "_own")).alias("value"),
    )
