"""Characters, accents and names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.constants import ACCENT_MAP, ALLOWED_CHARS
from reelforge.functions import text
from reelforge.operators import census
from reelforge.plans.bindings import table
from reelforge.plans.registry import query

KEYS, LETTERS = "".join(ACCENT_MAP), "".join(ACCENT_MAP.values())
OUTSIDE = "'[^" + ALLOWED_CHARS.replace("'", "''") + "]'"
CHARS = f"chars AS (SELECT doc_id, unnest(regexp_extract_all(text, {OUTSIDE})) AS ch FROM documents)"
LETTER = "strip_accents(ch) ~ '^[a-zA-Z]$'"


@query("char_census", f"WITH {CHARS} SELECT ch, count(*) AS n FROM chars GROUP BY ch")
def char_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.char_census(table(spark, sf_dir, "documents", "text"), ["text"])


@query("accent_fold", f"SELECT doc_id, translate(text, '{KEYS}', '{LETTERS}') AS folded FROM documents")
def accent_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", text.fold_accents("text").alias("folded")
    )


@query("corrupted_rows", f"""
SELECT doc_id, array_to_string(regexp_extract_all(text, {OUTSIDE}), '') AS special_chars
FROM documents WHERE len(regexp_extract_all(text, {OUTSIDE})) > 0""")
def corrupted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.corrupted_rows(table(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id")


@query("codepoint_label", f"""
WITH {CHARS} SELECT DISTINCT ch, printf('U+%04X', unicode(ch)) AS code_point FROM chars""")
def codepoint_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = census.char_census(table(spark, sf_dir, "documents", "text"), ["text"])
    return chars.select("ch", text.code_point("ch").alias("code_point"))


@query("unknown_char_map", f"""
WITH {CHARS} SELECT DISTINCT ch, strip_accents(ch) AS letter FROM chars
WHERE {LETTER} AND instr('{KEYS}', ch) = 0""")
def unknown_char_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.discover_letters(census.char_census(table(spark, sf_dir, "documents", "text"), ["text"]))


@query("title_hygiene", f"""
WITH both_splits AS (
  SELECT 'train' AS split, doc_id AS row_id, text AS "primaryTitle", lang || ' — ' || source AS "originalTitle" FROM documents
  UNION ALL SELECT 'validation', conv_id * 1000 + turn, text, role || ' é' FROM conversations
), chars AS (
  SELECT DISTINCT unnest(regexp_extract_all("primaryTitle" || "originalTitle", {OUTSIDE})) AS ch FROM both_splits
), found AS (
  SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS keys, coalesce(string_agg(strip_accents(ch), '' ORDER BY ch), '') AS letters
  FROM chars WHERE {LETTER} AND instr('{KEYS}', ch) = 0
)
SELECT split, row_id, translate("primaryTitle", '{KEYS}' || keys, '{LETTERS}' || letters) AS "primaryTitle",
  translate("originalTitle", '{KEYS}' || keys, '{LETTERS}' || letters) AS "originalTitle"
FROM both_splits, found""")
def title_hygiene(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select(
        F.lit("train").alias("split"), F.col("doc_id").alias("row_id"), F.col("text").alias("primaryTitle"),
        F.concat_ws(" — ", "lang", "source").alias("originalTitle"),
    )
    validation = table(spark, sf_dir, "conversations", "conv_id", "turn", "text", "role").select(
        F.lit("validation").alias("split"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
        F.col("text").alias("primaryTitle"), F.concat(F.col("role"), F.lit(" é")).alias("originalTitle"),
    )
    return census.clean_text_columns(train.unionByName(validation), ["primaryTitle", "originalTitle"])


@query("snake_case_names", """
SELECT DISTINCT p_name AS name, replace(lower(p_name), ' ', '_') AS column_name FROM part
UNION ALL SELECT DISTINCT o_orderpriority, replace(lower(o_orderpriority), ' ', '_') FROM orders""")
def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part", F.col("p_name").alias("name")).distinct().unionByName(
        table(spark, sf_dir, "orders", F.col("o_orderpriority").alias("name")).distinct()
    )
    return names.select("name", text.snake_case("name").alias("column_name"))


@query("long_leftovers", f"""
SELECT doc_id, len(regexp_extract_all(text, {OUTSIDE}))::INTEGER AS n_special
FROM documents WHERE len(regexp_extract_all(text, {OUTSIDE})) > 1""")
def long_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with more than one character outside the allowed class."""
    rows = census.corrupted_rows(table(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id")
    return rows.select("doc_id", F.length("special_chars").alias("n_special")).where("n_special > 1")
