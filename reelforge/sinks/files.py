"""Writers. All are distributed: no frame goes through the driver or through one task."""

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.operators.durable import settle
from reelforge.operators.hygiene import new_rejects
from reelforge.sinks.parts import Parts


def write_parquet(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write or append Parquet. To rebuild a table from itself, write to a new path."""
    df.write.mode(mode).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists") -> None:
    """Delimited text with a header; nested columns are written as JSON text."""
    flat = [
        F.to_json(F.col(f"`{name}`")).alias(name) if dtype.startswith(("array", "struct", "map")) else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ]
    df.select(*flat).write.mode(mode).option("sep", sep).option("header", True).csv(path)


def write_labels(df: DataFrame, path: str, *columns: str) -> None:
    """Chosen columns as CSV with a header."""
    df.select(*columns).write.option("header", True).csv(path)


def write_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """``key,value`` lines without a header; keys with commas are quoted."""
    df.select(key, value).write.option("quote", '"').option("escape", '"').csv(path)


def write_predictions(aligned: DataFrame, path: str, order_by: str = "row_id", prediction: str = "prediction") -> None:
    """One ``True`` or ``False`` per input row, no header, in input order.

    The sort is a distributed range sort: part files in name order, read one after another, are the whole
    column in order, and none has to hold all of it.
    """
    text = F.initcap(F.col(prediction).cast("boolean").cast("string")).alias(prediction)
    aligned.orderBy(order_by).select(text).write.csv(path)


def write_id_map(id_map: DataFrame, path: str, ids_per_object: int = 100_000) -> None:
    """The id map as JSON objects, one per line, each with about ``ids_per_object`` ids."""
    parts = max(1, ceil(id_map.count() / ids_per_object))
    bucket = F.pmod(F.xxhash64("imdb_id"), F.lit(parts))
    objects = id_map.groupBy(bucket.alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("imdb_id", "tmdb_id")))).alias("value")
    )
    objects.select("value").write.text(path)


def log_rejects(rejects: DataFrame, path: str, logged: DataFrame | None = None) -> None:
    """Append rejects ``(id, reason)`` that are not in the log yet, each once."""
    new = rejects.dropDuplicates(["id", "reason"]) if logged is None else new_rejects(rejects, logged)
    new.write.mode("append").parquet(path)


BATCHES_PER_FOLDER = 1_000


def write_batches(df: DataFrame, path: str, per_folder: int = BATCHES_PER_FOLDER) -> None:
    """Write per-batch output; batches present in ``df`` replace their old rows, others stay. ``read_batches`` reads it.

    A part ``batch_range`` holds ``per_folder`` neighbouring batches, written by one task, so that their number stays small. Rows of
    other batches in a part that is touched are carried over into its new folder. All parts come into force at once; a job
    that fails leaves the old rows, and one that meets another writer's work raises ``Conflict``.
    """
    table = Parts(df.sparkSession, path)
    number, parts = table.state()
    new = settle(df.withColumn("batch_range", F.floor(F.col("batch_id") / per_folder)))
    touched = [row[0] for row in new.select("batch_range").distinct().collect()]  # one row for each range
    old = table.read(df.schema, only={str(name) for name in touched})
    if old is not None:
        kept = old.join(new.select("batch_id").distinct(), "batch_id", "left_anti")
        new = new.unionByName(kept.withColumn("batch_range", F.floor(F.col("batch_id") / per_folder)))
    folder = table.new_folder()
    new.repartition("batch_range").write.partitionBy("batch_range").parquet(f"{path}/{folder}")
    named = {str(name): f"{folder}/batch_range={'__HIVE_DEFAULT_PARTITION__' if name is None else name}" for name in touched}
    table.commit(number, {**parts, **named})


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all batches in force, or None if none were written."""
    return Parts(spark, path).read()
