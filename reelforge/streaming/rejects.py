"""The reject log kept up to date from a stream of rejects, each logged once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelforge.operators.hygiene import new_rejects
from reelforge.schemas import REJECT_EVENTS
from reelforge.sinks.parts import Parts

SWEPT = "swept"


def landed_rejects(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """A stream over a folder of Parquet files ``(id, reason, at)``; ``at`` is when the reject came up."""
    return spark.readStream.schema(REJECT_EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once_each(rejects: DataFrame, delay: str) -> DataFrame:
    """The first of equal rejects that come up within ``delay`` of each other.

    The state holds a key until the watermark, ``delay`` behind the latest event, has passed it, so it is
    bounded by what comes up in that time. What arrives later than the watermark is left out: ``sweep`` finds it.
    """
    return rejects.withWatermark("at", delay).dropDuplicatesWithinWatermark(["id", "reason"])


def log_stream(rejects: DataFrame, path: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Log all rejects that have landed since the last run, each once, and stop.

    Repeats within ``delay`` never leave the keyed state; repeats after it are told by the log. Each micro-batch is a part of the
    log, which a batch that is run again replaces.
    """
    log = Parts(rejects.sparkSession, path)

    def add(batch: DataFrame, batch_id: int) -> None:
        part = f"batch-{batch_id:012d}"
        logged = log.read(without={part})
        new = batch.select("id", "reason").dropDuplicates()
        log.put(part, new if logged is None else new_rejects(new, logged))

    return (
        once_each(rejects, delay).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def sweep(landed: DataFrame, path: str) -> None:
    """Log what the stream passed over as too late: the landed rejects (a batch frame) that the log lacks."""
    log = Parts(landed.sparkSession, path)
    logged = log.read()
    rows = landed.select("id", "reason").dropDuplicates()
    missed = rows if logged is None else new_rejects(rows, logged)
    earlier = log.read(only={SWEPT})
    log.put(SWEPT, missed if earlier is None else earlier.unionByName(missed))


def logged_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    """The log: ``(id, reason)``, each once."""
    return Parts(spark, path).read()
