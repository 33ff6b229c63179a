"""External documents: which to ask for, and how to flatten them into a feature table."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.constants import BASIC_FIELDS, DEFAULT_REGION, GENRES
from reelforge.functions import nested, text
from reelforge.operators.joins import append_rows, lookup, not_yet_done
from reelforge.schemas import DOCUMENT

SNAKE_GENRES = {genre.lower().replace(" ", "_"): genre for genre in GENRES}


def parse_documents(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed responses with the payload parsed to a struct ``document``.

    The parsed value goes through a generator of one row: a filter on one of its fields would otherwise be
    pushed below the parser and parse every payload once more.
    """
    parsed = F.explode(F.array(nested.parse_document(payload, DOCUMENT))).alias("document")
    return responses.select(*[name for name in responses.columns if name != payload], parsed)


def document_rejects(parsed: DataFrame, key: str, required: Iterable[str] = BASIC_FIELDS) -> DataFrame:
    """``(id, reason)``, one row per fault: malformed text, or one of the required fields missing."""
    document = F.col("document")
    malformed = document[nested.CORRUPT].isNotNull()
    lacking = F.transform(nested.missing_fields(document, required), lambda name: F.concat(F.lit("missing "), name))
    reasons = F.when(malformed, F.array(F.lit("malformed"))).otherwise(lacking)
    return parsed.select(F.col(key).cast("string").alias("id"), F.explode(reasons).alias("reason"))


def flatten_documents(parsed: DataFrame, *keep: str, strict: bool = False) -> DataFrame:
    """Basic fields, genre names and first production country of each document.

    Lenient by default: absent fields are null. With ``strict`` documents that lack a basic field are
    left out (``document_rejects`` lists them).
    """
    rows = parsed.where(F.col(f"document.{nested.CORRUPT}").isNull())
    if strict:
        rows = rows.where(F.size(nested.missing_fields(F.col("document"), BASIC_FIELDS)) == 0)
    return rows.select(
        *keep,
        *[F.col(f"document.{name}").alias(name) for name in BASIC_FIELDS],
        nested.field_of_each("document.genres", "name").alias("genres"),
        nested.first_or_null("document.production_countries")["iso_3166_1"].alias("country"),
    )


def external_features(parsed: DataFrame, countries: DataFrame, counts: bool = False,
                      code: str = "alpha-2", region: str = "region") -> DataFrame:
    """The external feature table: basic fields, genres, continent and one column per genre.

    Genre columns are 0/1, or the number of mentions with ``counts``. Documents without an id are dropped.
    """
    flat = flatten_documents(parsed).withColumnRenamed("imdb_id", "tconst").dropna(subset=["tconst"])
    placed = lookup(flat, countries, F.col("country"), code, region, DEFAULT_REGION, "continent")
    columns = nested.count_columns if counts else nested.indicator_columns
    return placed.drop("country").select("*", *columns("genres", SNAKE_GENRES))


def genre_rollup(rows: DataFrame, key: str, genre: str, genres: Iterable[str], counts: bool = True) -> DataFrame:
    """Multi-hot columns per key from one row per (key, genre), for a fixed list of genres.

    One partial aggregate and one shuffle; a key with very many rows is combined map-side. A key whose
    genre is null keeps its row of zeros.
    """
    hits = {name: F.count_if(F.col(genre) == name) for name in genres}
    return rows.groupBy(key).agg(*[
        (n if counts else (n > 0).cast("int")).alias(name.lower().replace(" ", "_")) for name, n in hits.items()
    ])


def exploded_genres(flat: DataFrame, key: str) -> DataFrame:
    """One row per (key, genre), in snake case too; a document without genres keeps a row."""
    rows = flat.select(key, F.explode_outer("genres").alias("genre"))
    return rows.withColumn("genre_column", text.snake_case("genre"))


def append_features(known: DataFrame, new: DataFrame) -> DataFrame:
    """Known and new feature rows together; columns may differ, rows without a key are dropped."""
    return append_rows(known, new, "tconst")


SHORT_OBJECT = 2_000  # characters
_SPACE, _TEXT = r"[ \t\n\r]*", r'"[^"\\\p{Cntrl}]*"'
_WHOLE, _NUMBER = r"(?:0|-?[1-9][0-9]{0,17})", r"-?(?:0|[1-9][0-9]{0,17})(?:\.[0-9]{1,15})?"


def _pairs(value: str) -> str:
    pair = f"{_TEXT}{_SPACE}:{_SPACE}{value}"
    return f"{pair}(?:{_SPACE},{_SPACE}{pair})*+"


_PLAIN = f"(?:{_TEXT}|{_WHOLE})"
_NESTED = f"(?:{_TEXT}|{_NUMBER}|\\{{{_SPACE}(?:{_pairs(f'(?:{_TEXT}|{_NUMBER})')})?{_SPACE}\\}})"


def map_entries(json_objects: DataFrame, column: str = "value", as_written: bool = False) -> DataFrame:
    """JSON objects as rows ``(id, text)``, one per entry; the text of a nested value is its JSON.

    An object that is not valid JSON is one row with a null id and its own text. Short objects of texts without escapes and of
    whole numbers are cut by pattern: the parser keeps a table of all names that it meets, and copies it for each object, which
    for ids that come once costs far more than the rest. With ``as_written`` that holds for other numbers and for objects of such values too;
    their JSON then is as it was written, and not in the parser's form.
    """
    source, value = F.col(column), _NESTED if as_written else _PLAIN
    whole = F.array(F.struct(F.lit(None).cast("string").alias("key"), source.alias("value")))

    def parsed_entries(parsed):
        return F.when(parsed.isNull() & source.isNotNull(), whole).otherwise(F.map_entries(parsed))

    def entry(key, text):
        return F.struct(key.alias("key"), F.when(text.startswith('"'), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text).alias("value"))

    # the array of one map has an object parsed once, not once for each use
    parsed = F.transform(F.array(F.from_json(source, "map<string,string>")), parsed_entries)[0]
    keys, texts = (F.regexp_extract_all(source, F.lit(f'"([^"]*)"{_SPACE}:{_SPACE}({value})'), F.lit(group)) for group in (1, 2))
    short = (F.length(source) <= SHORT_OBJECT) & source.rlike(f"\\A{_SPACE}\\{{{_SPACE}{_pairs(value)}{_SPACE}\\}}{_SPACE}\\z")
    # the generator keeps filters on an entry from parsing every object once more
    return json_objects.select(F.explode(F.when(short, F.zip_with(keys, texts, entry)).otherwise(parsed)).alias("entry")).select(
        F.col("entry.key").alias("id"), F.col("entry.value").alias("text"))


def id_map_rows(json_objects: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects ``{id: external id}`` as rows; entries without a whole number are in ``id_map_rejects``."""
    entries = map_entries(json_objects, column)
    return entries.select(F.col("id").alias("imdb_id"), F.col("text").try_cast("bigint").alias("tmdb_id")).where(
        "imdb_id IS NOT NULL AND tmdb_id IS NOT NULL")


def id_map_rejects(json_objects: DataFrame, column: str = "value") -> DataFrame:
    """``(id, reason)`` of what ``id_map_rows`` leaves out; for a malformed object the id is its text."""
    entries = map_entries(json_objects, column)
    bad = entries.where("id IS NULL OR text IS NULL OR try_cast(text AS bigint) IS NULL")
    return bad.select(
        F.coalesce("id", "text").alias("id"),
        F.when(F.col("id").isNull(), "malformed object").otherwise("not a whole number").alias("reason"))


def document_map_rows(json_objects: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects ``{id: document}`` as rows ``(id, document)``, each document parsed by itself.

    A document that is not an object of the expected form keeps its row, with its text in ``_corrupt_record``.
    """
    entries = map_entries(json_objects, column).where("id IS NOT NULL")
    return parse_documents(entries, "text")


def document_map_rejects(json_objects: DataFrame, column: str = "value") -> DataFrame:
    """``(id, reason)`` of malformed objects (the id is their text) and of malformed documents in them."""
    entries = map_entries(json_objects, column, as_written=True)
    # objects and their documents in one pass: two would parse every object twice
    parsed = parse_documents(entries.select("id", "text", F.when(F.col("id").isNotNull(), F.col("text")).alias("payload")))
    malformed = F.col("document")[nested.CORRUPT].isNotNull()
    return parsed.select(
        F.coalesce("id", "text").alias("id"), F.when(F.col("id").isNull(), "malformed object").when(malformed, "malformed").alias("reason")
    ).where("reason IS NOT NULL")


def enrichment_plan(titles: DataFrame, id_map: DataFrame, not_found: DataFrame, features: DataFrame) -> DataFrame:
    """What each title still needs: ``(tconst, step)`` for every title that is not finished.

    ``map`` - no external id known; ``fetch`` - id known, document not yet in the feature table;
    ``not found`` - the id search has failed before. Finished titles are left out.
    """
    open_titles = not_yet_done(titles.select("tconst").distinct(), features, "tconst")
    known = id_map.select(F.col("imdb_id").alias("tconst"), "tmdb_id").groupBy("tconst").agg(F.min("tmdb_id").alias("tmdb_id"))
    failed = not_found.select(F.col("id").alias("tconst")).distinct().withColumn("_failed", F.lit(True))
    return (
        open_titles.join(known, "tconst", "left").join(failed, "tconst", "left")
        .select(
            "tconst", "tmdb_id",
            F.when(F.col("tmdb_id").isNotNull(), "fetch")
            .when(F.col("_failed"), "not found").otherwise("map").alias("step"),
        )
    )


def documents_to_fetch(id_map: DataFrame, features: DataFrame) -> DataFrame:
    """Mapped ids whose document is not in the feature table."""
    return not_yet_done(id_map.withColumnRenamed("imdb_id", "tconst"), features, "tconst")
