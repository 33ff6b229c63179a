"""The feature table kept up to date from landed responses, file by file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelforge.operators import documents, joins
from reelforge.operators.durable import settle
from reelforge.operators.hygiene import new_rejects
from reelforge.schemas import LANDED
from reelforge.sinks.parts import Parts

FILES_PER_BATCH = 1_000


def landed_responses(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream over a folder of JSON lines ``{"id", "payload"}``; files that land later are picked up by the next run."""
    return spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).json(path)


def feature_parts(spark: SparkSession, path: str) -> Parts:
    return Parts(spark, f"{path}/features")


def reject_parts(spark: SparkSession, path: str) -> Parts:
    return Parts(spark, f"{path}/rejects")


def _one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest: a response that lands twice in a batch counts once."""
    values = [name for name in rows.columns if name != key]
    return rows.groupBy(key).agg(F.min(F.struct(*values)).alias("_row")).select(key, "_row.*").select(*rows.columns)


def add_batch(batch: DataFrame, batch_id: int, countries: DataFrame, path: str) -> None:
    """Put the features and rejects of one micro-batch into their tables, each as a part of its own.

    Titles that other batches have brought are not parsed again. The part is named by the batch, and what the batch itself
    may have written before is left out of what counts as known: a batch that is run again after a failure
    replaces its part by the same rows.
    """
    spark, part = batch.sparkSession, f"batch-{batch_id:012d}"
    features, rejects = feature_parts(spark, path), reject_parts(spark, path)
    known = features.read(without={part})
    fresh = batch if known is None else joins.not_yet_done(batch.withColumnRenamed("id", "tconst"), known, "tconst").withColumnRenamed("tconst", "id")
    parsed = settle(documents.parse_documents(fresh), "parsed")
    faults = documents.document_rejects(parsed, "id").dropDuplicates(["id", "reason"])
    logged = rejects.read(without={part})
    rejects.put(part, faults if logged is None else new_rejects(faults, logged))
    features.put(part, _one_per_key(documents.external_features(parsed, countries), "tconst"))


def enrich(landed: DataFrame, countries: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Work off all files that have landed since the last run, in micro-batches, and stop.

    Offsets and finished batches are in ``checkpoint``; with the parts in ``path`` a run that was
    cut off anywhere goes on without loss or repeats. ``countries`` is read anew by every batch.
    """
    return (
        landed.writeStream.foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, countries, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def streamed_features(spark: SparkSession, path: str) -> DataFrame | None:
    """The feature table so far; a title that several batches brought at once has its smallest row."""
    rows = feature_parts(spark, path).read()
    return None if rows is None else _one_per_key(rows, "tconst")


def streamed_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    return reject_parts(spark, path).read()


def land(responses: DataFrame, path: str) -> None:
    """Add responses ``(id, payload)`` to a landing folder as JSON lines."""
    responses.select("id", "payload").write.mode("append").json(path)
