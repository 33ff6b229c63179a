"""Census and folding of unexpected characters in text columns."""

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelforge.constants import ACCENT_MAP
from reelforge.functions import text


def char_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count the characters outside the allowed class, over all columns: ``(ch, n)``.

    One scan; the counts are combined map-side, so the shuffle carries one row per character and task.
    """
    texts = df.select(F.explode(F.array(*columns)).alias("_text"))
    return (
        texts.select(F.explode(text.special_char_list("_text")).alias("ch"))
        .groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
    )


def corrupted_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Rows whose text still holds characters outside the allowed class, with those characters."""
    return df.select(*keep, text.special_chars(column).alias("special_chars")).where("special_chars != ''")


def base_character(char: Column | str) -> Column:
    """First code point of a character's canonical decomposition."""

    # local, so that it travels to the workers by value
    def first_of_decomposition(chars: pd.Series) -> pd.Series:
        return chars.map(lambda ch: unicodedata.normalize("NFD", ch)[:1])

    return F.pandas_udf(first_of_decomposition, T.StringType())(char)


def discover_letters(chars: DataFrame) -> DataFrame:
    """``(ch, letter)`` for characters whose base is an ASCII letter and that the fixed map lacks.

    Runs over distinct characters only, so the Python step never sees more rows than Unicode has
    characters.
    """
    unknown = chars.select("ch").distinct().where(~F.col("ch").isin(*ACCENT_MAP))
    return unknown.withColumn("letter", base_character("ch")).where(text.is_ascii_letter("letter"))


def letter_map(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The fixed map plus the letters discovered in ``df``.

    Comes to the driver: at most as many entries as Unicode has letters with an ASCII base (under 2,000).
    """
    found = discover_letters(char_census(df, columns)).orderBy("ch").collect()
    return {**ACCENT_MAP, **{row.ch: row.letter for row in found}}


def clean_text_columns(df: DataFrame, columns: list[str], split: str | None = None) -> DataFrame:
    """Fold accents in all columns, with letters discovered in the data.

    ``split`` restricts the folding to one value of the ``split`` column; the census still reads every
    row. One projection, whatever the number of mapped characters.
    """
    mapping = letter_map(df, columns)

    def folded(name: str):
        clean = text.fold_accents(name, mapping)
        return clean if split is None else F.when(F.col("split") == split, clean).otherwise(F.col(name))

    return df.withColumns({name: folded(name) for name in columns})
