"""Functions over arrays, structs, maps and JSON text."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_document(text: Column | str, schema: T.StructType) -> Column:
    """JSON text to a struct. The extra field ``_corrupt_record`` holds text that is not valid JSON."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(_column(text), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_line(text: Column | str, schema: T.StructType) -> Column:
    """One CSV line to a struct, malformed lines in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_csv(_column(text), wide.simpleString()[len("struct<"):-1].replace(":", " "),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def field_of_each(array: Column | str, field: str) -> Column:
    """One field of every struct in an array; a missing array gives an empty one."""
    return F.coalesce(F.transform(_column(array), lambda item: item[field]), F.array().cast("array<string>"))


def first_or_null(array: Column | str) -> Column:
    return F.try_element_at(_column(array), F.lit(1))


def missing_fields(document: Column, required: Iterable[str]) -> Column:
    """Names of required fields that are null, as an array."""
    return F.array_compact(F.array(*[F.when(document[name].isNull(), F.lit(name)) for name in required]))


def indicator_columns(array: Column | str, names: dict[str, str]) -> list[Column]:
    """One 0/1 column per value, from an array: ``{column name: value}``."""
    array = _column(array)
    return [
        F.coalesce(F.array_contains(array, value), F.lit(False)).cast("int").alias(name)
        for name, value in names.items()
    ]


def count_columns(array: Column | str, names: dict[str, str]) -> list[Column]:
    """As ``indicator_columns``, but how many times each value occurs."""
    array = _column(array)

    def mentions(value: str) -> Column:
        return F.coalesce(F.size(F.filter(array, lambda item: item == value)), F.lit(0))

    return [mentions(value).alias(name) for name, value in names.items()]
