"""One rule for missing values: sentinel text, NaN and null all become null, once, at the source."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelforge.constants import SENTINELS


def to_null(column: Column | str, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Text column with every sentinel replaced by null."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(~text.isin(*sentinels), text)


def nan_to_null(column: Column | str) -> Column:
    """Numeric column with NaN replaced by null."""
    number = F.col(column) if isinstance(column, str) else column
    return F.nanvl(number, F.lit(None).cast("double"))


def to_int(column: Column | str, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Text to int, decimals cut off. Sentinels and malformed text become null instead of failing the job."""
    text = to_null(column, sentinels)
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def to_double(column: Column | str, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Text to double, with sentinels, malformed text and the text NaN as null."""
    return nan_to_null(to_null(column, sentinels).try_cast("double"))


def int_or_default(column: Column | str, default: int, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Text to int, missing values replaced by a marker such as -1 or 0."""
    return F.coalesce(to_int(column, sentinels), F.lit(default))


def text_or_empty(column: Column | str, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Text with missing values as the empty string."""
    return F.coalesce(to_null(column, sentinels), F.lit(""))


def first_int(*columns: Column | str) -> Column:
    """First of several text columns that holds an int: restores a value stored in the wrong column."""
    return F.coalesce(*[to_int(column) for column in columns])


def label_flag(column: Column | str) -> Column:
    """The texts 'True' and 'False' as a boolean, anything else as null."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(text == "True", F.lit(True)).when(text == "False", F.lit(False))
