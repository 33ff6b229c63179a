"""Credit features of titles, from edge tables (title, director) and (title, writer)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.operators.durable import settle
from reelforge.operators.joins import attach_counts
from reelforge.operators.profile import group_counts


def movies_per_person(edges: DataFrame, person: str) -> DataFrame:
    """How many titles each person is credited for."""
    return group_counts(edges, person, "movie", f"{person}_movie_count")


def _per_title(edges: DataFrame, person: str, **limits: int) -> DataFrame:
    """Per title: the largest movie count among its people, and the number of people."""
    size = f"{person}_movie_count"
    counted = attach_counts(edges, movies_per_person(edges, person), person, size, **limits)
    return counted.where(F.col("movie").isNotNull()).groupBy("movie").agg(
        F.max(size).alias(size), F.count(F.lit(1)).alias(f"{person}_count")
    )


def credit_pairs_per_writer(writing: DataFrame, directing: DataFrame, **limits: int) -> DataFrame:
    """Writers left-joined with directors on the title, without writing out the product.

    Each writer row carries ``n_directors``, the directors matched, and ``n_joined_rows``, the rows that the
    plain join would give for it (one when there is no director). Everything computed from the product
    follows from these; the product itself grows with the square of a hot title's credits.
    """
    directors = group_counts(directing, "movie", "director", "n_directors")
    joined = attach_counts(writing, directors, "movie", "n_directors", how="left", **limits)
    return joined.withColumns({
        "n_directors": F.coalesce("n_directors", F.lit(0)),
        "n_joined_rows": F.greatest(F.coalesce("n_directors", F.lit(0)), F.lit(1)),
    })


def credit_features(directing: DataFrame, writing: DataFrame, mode: str = "people", **limits: int) -> DataFrame:
    """Per title: largest movie count and number of directors and of writers.

    ``people`` counts different people on each side; a title without people on one side has zeros there.
    ``pairs`` counts the (writer, director) pairs of the title on both sides and leaves out titles that
    lack either; since those are all combinations, the count is the product of the two sides' rows.
    ``limits`` are those of ``attach_counts``.
    """
    if mode == "people":
        directing, writing = settle(directing.distinct()), settle(writing.distinct())
    directors = _per_title(directing, "director", **limits)
    writers = _per_title(writing, "writer", **limits)
    if mode == "pairs":
        pairs = F.col("director_count") * F.col("writer_count")
        return directors.join(writers, "movie", "inner").withColumns(
            {"director_count": pairs, "writer_count": pairs}
        )
    if mode != "people":
        raise ValueError(f"mode must be 'people' or 'pairs', not {mode!r}")
    return directors.join(writers, "movie", "full").na.fill(0)


def with_credit_features(titles: DataFrame, directing: DataFrame, writing: DataFrame,
                         mode: str = "people") -> DataFrame:
    """Every title with its credit features; in ``people`` mode titles without credits get zeros."""
    features = credit_features(directing, writing, mode).withColumnRenamed("movie", "tconst")
    joined = titles.join(features, "tconst", "left")
    if mode == "people":
        joined = joined.na.fill(0, [name for name in features.columns if name != "tconst"])
    return joined
