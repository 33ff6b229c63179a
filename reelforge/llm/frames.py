"""Small helpers on frames that several operators of this folder share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 64 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def partitions_for(df: DataFrame, bytes_each: int = PARTITION_BYTES) -> int:
    """A number of partitions of about ``bytes_each`` for the data behind ``df``, from the planner's size of it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = -(-size // bytes_each) if size < 1 << 60 else 0  # an unknown size is a huge number
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def carried(docs: DataFrame, *names: str | Column) -> DataFrame:
    """``docs`` as one column ``_doc`` beside the named ones: its other columns may have any names."""
    every = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(every.alias("_doc"), *names)


def changed(docs: DataFrame, text: Column) -> Column:
    """``_doc`` with another text, and with ``n_chars`` after it where the documents have that column."""
    new = F.col("_doc").withField("text", text)
    return new.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else new
