"""Work along a sorted key and time where one key may hold any share of the rows: as-of joins, sessions, calendars.

Rows are dealt by range of key and time, so a large key spans several buckets and no task gets more than a bucket. Within
a bucket a window does the work; what has to pass from bucket to bucket is one row per bucket.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelforge.operators.durable import broadcast_if_small, settle

ROWS_PER_BUCKET = 1_000_000


def _dealt(rows: DataFrame, keys: list[str], *order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The rows by range of keys and order in buckets of about ``rows_per_bucket`` rows, stored with their ``_bucket``."""
    stored = settle(rows, "runs")
    buckets = stored.count() // rows_per_bucket + 1
    return settle(stored.repartitionByRange(buckets, *keys, *order).withColumn("_bucket", F.spark_partition_id()), "buckets")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], strict: bool = False,
              suffix: str = "_asof", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` before it: its ``values`` and its time, named with ``suffix``.

    Rows meet under equal ``by``; "before" takes in the same time unless ``strict``. Of right rows of one key and time the
    one with the greatest values counts. A left row without one before it, or with a null key or time, has nulls. ``left``
    keeps its rows, repeats too. Both sides are sorted together by key and time in buckets; a bucket that
    begins within a key is handed the last right row of that key from the buckets before.
    """
    names = [f"{name}{suffix}" for name in [on, *values]]
    whole = left.select(F.struct(*[F.col(f"`{name}`") for name in left.columns]).alias("_row"), *by, on)
    complete = F.lit(True)
    for name in [*by, on]:
        complete = complete & F.col(name).isNotNull()
    single = right.where(complete).groupBy(*by, on).agg(F.max(F.struct(*values)).alias("_values") if values else F.lit(0).alias("_values"))
    single = single.select(*by, on, F.struct(F.col(on), *[F.col(f"_values.{name}").alias(name) for name in values]).alias("_found"))
    kind = single.schema["_found"].dataType
    both = (
        whole.where(complete).select(*by, on, F.lit(0 if strict else 1).alias("_side"), "_row", F.lit(None).cast(kind).alias("_found"))
        .unionByName(single.select(*by, on, F.lit(1 if strict else 0).alias("_side"), F.lit(None).cast(whole.schema["_row"].dataType).alias("_row"), "_found"))
    )
    dealt = _dealt(both, by, on, "_side", rows_per_bucket=rows_per_bucket)
    inside = Window.partitionBy("_bucket", *by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("_last", F.last("_found", ignorenulls=True).over(inside)).where("_row IS NOT NULL")

    key = F.struct(*by)
    last = F.max(F.when(F.col("_found").isNotNull(), F.struct(F.col(on).alias("_at"), "_found")))["_found"]
    ends = settle(dealt.groupBy("_bucket", *by).agg(last.alias("_found")).where("_found IS NOT NULL"), "ends")
    begins = dealt.groupBy("_bucket").agg(F.min(key).alias("_key")).select(F.col("_bucket").alias("_at"), "_key.*")
    handed = ends.join(broadcast_if_small(settle(begins, "begins")), by).where(F.col("_bucket") < F.col("_at")).groupBy("_at", *by).agg(
        F.max(F.struct("_bucket", "_found"))["_found"].alias("_handed")).withColumnRenamed("_at", "_bucket")
    joined = swept.join(broadcast_if_small(settle(handed, "handed")), ["_bucket", *by], "left")
    matched = F.coalesce("_last", "_handed")
    result = joined.select("_row", matched.alias("_match")).unionByName(
        whole.where(~complete).select("_row", F.lit(None).cast(kind).alias("_match")))
    return result.select("_row.*", *[F.col(f"_match.{old}").alias(new) for old, new in zip([on, *values], names)])


def sessions(events: DataFrame, by: list[str], on: str, gap: str, totals: dict[str, Column] | None = None,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Events of a key with at most ``gap`` (an interval such as ``30 minutes``) from one to the next, as one row each.

    Returns ``by``, ``session_start``, ``session_end`` (of the last event), ``n_events`` and ``totals``: columns of ``events`` to
    sum, by name. Rows with a null key or time are left out. Sessions are made inside buckets; only the first and last
    of a key in each bucket can go on in another, and only those are looked at again.
    """
    totals = totals or {}
    step = F.expr(f"INTERVAL {gap}")
    rows = events.select(*by, on, *[value.alias(name) for name, value in totals.items()]).dropna(subset=[*by, on])
    dealt = _dealt(rows, by, on, rows_per_bucket=rows_per_bucket)
    inside = Window.partitionBy("_bucket", *by).orderBy(on)
    opened = dealt.withColumn("_new", F.when(F.col(on) > F.lag(on).over(inside) + step, 1).otherwise(0))
    numbered = opened.withColumn("_no", F.sum("_new").over(inside.rangeBetween(Window.unboundedPreceding, 0)))
    sums = [F.sum(name).alias(name) for name in totals]
    parts = settle(numbered.groupBy("_bucket", *by, "_no").agg(
        F.min(on).alias("session_start"), F.max(on).alias("session_end"), F.count(F.lit(1)).alias("n_events"), *sums), "sessions")
    spans = parts.groupBy("_bucket", *by).agg(F.max("_no").alias("_last"))
    wide = spans.groupBy(*by).agg(F.count(F.lit(1)).alias("_buckets")).where("_buckets > 1").select(*by, F.lit(True).alias("_wide"))
    wide = broadcast_if_small(settle(spans.join(broadcast_if_small(settle(wide, "wide")), by), "spans"))  # at most two rows a bucket
    marked = parts.join(wide, ["_bucket", *by], "left")
    at_border = F.coalesce(F.col("_wide") & ((F.col("_no") == 0) | (F.col("_no") == F.col("_last"))), F.lit(False))
    kept = ["session_start", "session_end", "n_events", *totals]
    along = Window.partitionBy(*by).orderBy("session_start", "_bucket")
    border = marked.where(at_border).withColumn("_new", F.when(F.col("session_start") > F.lag("session_end").over(along) + step, 1).otherwise(0))
    border = border.withColumn("_joined", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = border.groupBy(*by, "_joined").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n_events").alias("n_events"), *sums)
    return marked.where(~at_border).select(*by, *kept).unionByName(merged.select(*by, *kept))


def sliding_totals(events: DataFrame, by: list[str], on: str, size: str, step: str, totals: dict[str, Column]) -> DataFrame:
    """Totals over windows of ``size`` that begin every ``step``: ``by``, ``window_start``, ``n_events`` and ``totals``.

    Each row counts in size / step windows; counts and sums are combined map-side, so a key of any size is safe.
    """
    return (
        events.dropna(subset=[on]).groupBy(*by, F.window(on, size, step).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n_events"), *[F.sum(value).alias(name) for name, value in totals.items()])
        .select(*by, F.col("_w.start").alias("window_start"), "n_events", *totals)
    )


def on_full_calendar(series: DataFrame, by: list[str], day: str, values: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each series on all days from its first to its last: ``by``, ``day``, ``values``, ``is_filled``.

    Days without a row carry the last row before them forward, whole: its nulls too. Of several rows of a day the one with the greatest
    values counts. The days are made from first and last day, the rest is an as-of join.
    """
    rows = series.dropna(subset=[*by, day])
    ends = rows.groupBy(*by).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    days = ends.select(*by, F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))).alias(day))
    filled = asof_join(days, rows, by, day, values, rows_per_bucket=rows_per_bucket)
    return filled.select(*by, day, *[F.col(f"{name}_asof").alias(name) for name in values], (F.col(f"{day}_asof") < F.col(day)).alias("is_filled"))


def running_sums(rows: DataFrame, by: list[str], order: str, sums: dict[str, Column], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` with sums over the rows of their key that come before them: one column of whole numbers per entry of ``sums``.

    ``order`` tells the rows of a key apart; keys are not null. Sums run inside buckets; a bucket adds what the buckets before it hold of the key that
    it begins with, which is one row per bucket.
    """
    dealt = _dealt(rows.select("*", *[value.cast("long").alias(f"_{name}") for name, value in sums.items()]), by, order, rows_per_bucket=rows_per_bucket)
    earlier = Window.partitionBy("_bucket", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.select("*", *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(name) for name in sums])
    totals = settle(dealt.groupBy("_bucket", *by).agg(*[F.sum(f"_{name}").alias(f"_t_{name}") for name in sums]), "totals")
    begins = totals.groupBy("_bucket").agg(F.min(F.struct(*by)).alias("_key")).select(F.col("_bucket").alias("_at"), "_key.*")
    handed = totals.join(broadcast_if_small(settle(begins, "begins")), by).where(F.col("_bucket") < F.col("_at")).groupBy("_at", *by).agg(
        *[F.sum(f"_t_{name}").alias(f"_h_{name}") for name in sums]).withColumnRenamed("_at", "_bucket")
    joined = inside.join(broadcast_if_small(settle(handed, "handed")), ["_bucket", *by], "left")
    return joined.select(*rows.columns, *[(F.col(name) + F.coalesce(f"_h_{name}", F.lit(0))).alias(name) for name in sums])
