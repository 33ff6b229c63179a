"""Results that are read several times, and joins with a side of checked size."""

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session (as in tests) gets a folder of its own; a cluster has no such folder, so
    that is an error and not a silent recomputation.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="reelforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_open_scopes: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Everything staged inside the block is removed at its end: write or collect the results in it.

    A long session frees its disk so; without a block what was staged stays until the driver's Python ends, because a frame
    that a caller holds may read it.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.remove(paths)
        for path in paths:
            _remove(spark, path)


def staging_path(spark: SparkSession, label: str = "staged") -> str:
    """A new path in the shared folder; what is written there goes with the open ``staging`` block or when the driver's Python ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    else:
        atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the folder's owner clears it
        pass


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged path that is no longer read, before its block ends."""
    _remove(spark, path)


def settle(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it from there.

    This cuts the lineage: stored rows outlive lost executors, and later reads are pruned scans.
    """
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side of a join for broadcast if it has at most ``rows`` rows of ``bytes_`` in all; else leave it unmarked.

    The planner cannot know the size of an aggregate beforehand: without the mark it would shuffle the large
    side before it learns that it need not have. Give it settled or stored frames, which are cheap to count.
    """
    width = sum((F.coalesce(F.length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name, _ in df.dtypes), F.lit(0))
    count, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if count <= rows and size <= bytes_ else df
