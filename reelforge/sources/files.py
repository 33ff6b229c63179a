"""Readers of title, credit, lookup, item, map, document and series files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelforge import schemas
from reelforge.functions import missing, nested, text
from reelforge.operators.documents import document_map_rows, id_map_rows
from reelforge.operators.durable import broadcast_if_small, settle
from reelforge.operators.hygiene import sentinels_to_null
from reelforge.operators.runs import ROWS_PER_BUCKET, asof_join, running_sums


def _title_lines(spark: SparkSession, path: str, split: str, skip_files: str | None) -> DataFrame:
    schema = schemas.TITLES_CSV if split == "train" else schemas.HIDDEN_TITLES_CSV
    wide = T.StructType([*schema.fields, T.StructField(nested.CORRUPT, T.StringType())])
    # whole lines are parsed even if few columns are used: only then are faults in the others seen
    raw = spark.read.option("columnPruning", False).schema(wide).csv(
        path, header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=nested.CORRUPT)
    return raw if skip_files is None else raw.where(~F.col("_metadata.file_name").rlike(skip_files))


def read_titles(spark: SparkSession, path: str, split: str, skip_files: str | None = None) -> DataFrame:
    """Title CSVs of one folder or file as typed rows with their ``split``.

    The first column is the row id. Files without a label column (any split but ``train``) get a null
    label. ``skip_files`` is a regular expression: files whose name matches are left out. Malformed lines are in
    ``title_rejects``.
    """
    raw = _title_lines(spark, path, split, skip_files)
    raw = raw.where(F.col(nested.CORRUPT).isNull() & F.col("row_id").isNotNull()).drop(nested.CORRUPT)
    label = F.col("label") if split == "train" else F.lit(None).cast("string")
    return sentinels_to_null(raw.withColumns({"label": label, "split": F.lit(split)})).withColumn(
        "numVotes", missing.to_double("numVotes")
    )


def title_rejects(spark: SparkSession, path: str, split: str, skip_files: str | None = None) -> DataFrame:
    """``(id, reason)`` of title lines with too many or too few fields, or without a whole number as row id."""
    raw = _title_lines(spark, path, split, skip_files)
    return raw.where(F.col(nested.CORRUPT).isNotNull() | F.col("row_id").isNull()).select(
        F.coalesce(F.col(nested.CORRUPT), F.col("tconst")).alias("id"), F.lit("malformed line").alias("reason"))


def read_all_titles(spark: SparkSession, train: str, validation: str, test: str,
                    skip_files: str | None = None) -> DataFrame:
    """The three splits as one frame, so that every later step runs once."""
    return (
        read_titles(spark, train, "train", skip_files)
        .unionByName(read_titles(spark, validation, "validation"))
        .unionByName(read_titles(spark, test, "test"))
    )


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """The quoted country lookup, all text."""
    return spark.read.schema(schemas.COUNTRIES_CSV).csv(path, header=True, quote='"')


def read_credits(spark: SparkSession, path: str, person: str) -> DataFrame:
    """Credits from JSON lines, as ``(movie, person)``; both documented sets of names are accepted."""
    rows = spark.read.schema(schemas.CREDIT_LINES).json(path)
    return rows.select(
        F.coalesce("movie", "tconst").alias("movie"),
        F.coalesce(person, f"{person}_id").alias(person),
    )


def read_columns(spark: SparkSession, path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """JSON files of the layout ``{column: {index: value}}`` as rows ``(file, column, index, value)``.

    The text reader cuts such a file at its commas and so hands it to many tasks by byte range, however large the one object
    in it is. Two running sums over the pieces of a file put it together again: an odd number of quotes before a piece
    says that it goes on with a text that holds a comma, and such pieces are joined to the entry that they belong to. Entries are told their
    column by the last one before them that opens one. Values are texts; null is null.
    """
    pieces = spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"), "value")
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '[^"]', ""))
    counted = running_sums(pieces, ["file"], "at", {"quotes": quotes}, rows_per_bucket)
    begun = running_sums(counted, ["file"], "at", {"entry": F.when(F.col("quotes") % 2 == 0, 1).otherwise(0)}, rows_per_bucket)
    number = F.col("entry") + F.when(F.col("quotes") % 2 == 0, 1).otherwise(0)
    entries = begun.groupBy("file", number.alias("entry")).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "value")))["value"], ",").alias("text"))
    opening = r'^\s*\{?\s*"((?:[^"\\]|\\.)*)"\s*:\s*\{'
    opens = F.col("text").rlike(opening)
    headers = entries.where(opens).select("file", "entry", F.regexp_extract("text", opening, 1).alias("column"))
    named = asof_join(entries, headers, ["file"], "entry", ["column"], rows_per_bucket=rows_per_bucket)
    rest = F.regexp_replace(F.regexp_replace("text", opening, ""), r"\s*\}\s*(\}\s*)?$", "")
    pairs = F.map_entries(F.from_json(F.concat(F.lit("{"), rest, F.lit("}")), "map<string,string>"))
    return named.select("file", F.col("column_asof").alias("column"), F.explode(pairs).alias("_pair")).select(
        "file", "column", F.col("_pair.key").alias("index"), F.col("_pair.value").alias("value"))


def read_columnar_credits(spark: SparkSession, path: str, person: str) -> DataFrame:
    """Credits from the layout ``{column: {index: value}}``, one JSON object per file, however large; both documented sets of names.

    An index of the title's column keeps its row where no person has it.
    """
    cells = settle(read_columns(spark, path), "columns")
    titles = cells.where(F.col("column").isin("movie", "tconst")).select("file", "index", F.col("value").alias("movie"))
    people = cells.where(F.col("column").isin(person, f"{person}_id")).select("file", "index", F.col("value").alias(person))
    return titles.join(people, ["file", "index"], "left").select("movie", person)


def pair_columns(rows: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Two map columns ``{index: value}`` as rows ``(key, index, first, second)``; an index of the first map keeps its row."""
    left = rows.select(key, F.explode(first).alias("index", "first"))
    right = rows.select(key, F.explode(second).alias("index", "second"))
    return left.join(right, [key, "index"], "left")


def read_id_map(spark: SparkSession, path: str, indented: bool = False) -> DataFrame:
    """JSON objects ``{id: external id}``, one per line, as rows ``(imdb_id, tmdb_id)``.

    ``indented`` reads files that hold one object spread over many lines; one task reads such a file.
    """
    return id_map_rows(spark.read.text(path, wholetext=indented), "value")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Objects ``{id: document}``, one per line, as rows ``(id, document)``."""
    return document_map_rows(spark.read.text(path), "value")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item lines as typed rows; malformed lines are kept in ``_corrupt_record``."""
    schema = T.StructType([*schemas.ITEMS_CSV.fields, T.StructField(nested.CORRUPT, T.StringType())])
    return spark.read.schema(schema).csv(
        path, header=True, quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord=nested.CORRUPT
    )


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet, restricted to the named columns."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def _wide_lines(lines: DataFrame, source: str, line: str, index: str) -> DataFrame:
    """Data lines as ``(source, line, names)``; ``names`` is null where the file has no header.

    A file's header is its line whose first field is ``index``. Only lines that begin like a header are cut into cells
    for that: a line of many commas costs no other line anything, and data lines are cut by the caller, once.
    """
    lines = lines.select(F.col(source).alias("source"), F.col(line).alias("line"))
    quoted = '"' + index.replace('"', '""') + '"'
    likely = F.coalesce(F.col("line").startswith(index) | F.col("line").startswith(quoted), F.lit(False))
    first = F.get(F.when(likely, text.csv_cells("line")), F.lit(0))
    is_header = F.coalesce(first == index, F.lit(False))
    headers = lines.where(likely).where(is_header).groupBy("source").agg(F.min(text.csv_cells("line")).alias("names"))
    return lines.where(~is_header).join(broadcast_if_small(settle(headers)), "source", "left")


def wide_lines_to_long(lines: DataFrame, source: str, line: str, index: str = "date") -> DataFrame:
    """CSV lines of files with different headers, as ``(source, date, series, value)``.

    ``lines`` holds the raw lines of all files with the file they came from; files may have any number of columns.
    Blank cells and flags are left out; everything else that gives no row is in ``wide_line_rejects``.
    """
    rows = _wide_lines(lines, source, line, index).where("names IS NOT NULL")
    # the generator keeps filters on the cells from cutting every line once more
    rows = rows.select("source", "names", F.explode(F.array(text.csv_cells("line"))).alias("cells")).where("size(cells) <= size(names)")
    return (
        rows.select(
            F.col("source").alias(source), F.element_at("cells", 1).try_cast("date").alias("date"),
            F.posexplode(F.slice("cells", F.lit(2), F.size("cells"))).alias("_pos", "_text"), "names")
        .select(source, "date", F.get("names", F.col("_pos") + 1).alias("series"), F.col("_text").try_cast("double").alias("value"))
        .where("date IS NOT NULL AND value IS NOT NULL")
    )


def wide_line_rejects(lines: DataFrame, source: str, line: str, index: str = "date") -> DataFrame:
    """``(id, line, reason)``: lines of files without a header, longer than their header, without a date, and with cells that are no number or flag."""
    # the generator keeps filters on the reason from cutting every line once more
    rows = _wide_lines(lines, source, line, index).select("source", "line", "names", F.explode(F.array(text.csv_cells("line"))).alias("cells"))
    words = F.exists(F.slice("cells", F.lit(2), F.size("cells")), lambda cell: cell.try_cast("double").isNull() & ~F.lower(F.trim(cell)).isin("", "true", "false"))
    reason = (
        F.when(F.col("names").isNull(), "no header").when(F.size("cells") > F.size("names"), "more cells than the header")
        .when(F.element_at("cells", 1).try_cast("date").isNull(), "no date").when(words, "not a number")
    )
    return rows.select(F.col("source").alias("id"), "line", reason.alias("reason")).where("reason IS NOT NULL")


def read_wide_series(spark: SparkSession, path: str, index: str = "date") -> DataFrame:
    """A folder of wide series files; ``source`` is the file name."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("source"), "value")
    return wide_lines_to_long(lines, "source", "value", index)


def union_wide_frame(df: DataFrame, index: str, batch) -> DataFrame:
    """One wide frame, one column per series, as ``(batch_id, index, series, value)``."""
    series = [name for name in df.columns if name != index]
    return df.unpivot([index], series, "series", "value").withColumn("batch_id", F.lit(batch))
