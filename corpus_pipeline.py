"""The corpus pipeline: documents through its stages in order, each stored and read again.

All stages but the last keep the columns of their input, whatever their names; texts of any length are taken whole; an empty
table stays empty. What becomes of nulls, empty texts and repeated rows is said by each.
"""

from pyspark.sql import DataFrame, SparkSession

from reelforge.llm.frames import documents
from reelforge.llm.language import in_known_language
from reelforge.llm.lines import without_repeated_lines
from reelforge.llm.mixing import mixed_documents
from reelforge.llm.packing import pack
from reelforge.llm.similar import one_of_each
from reelforge.operators.durable import settle


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus labels; texts without letters, null and empty ones, go. Repeated rows stay."""
    return in_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came before, or nearly so; what is left as blanks only goes. Null and empty texts stay, as do rows that
    repeat id and text (they are one document)."""
    return without_repeated_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, a null id first. Of repeated rows one stays; texts
    without words, null ones too, are duplicates of nothing but rows of their own id."""
    return one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight, as documents: once for each copy that it takes of one. Texts without words, null ones too, go;
    repeated rows count each."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of a fixed length; null is the empty text, a piece of one id; repeated rows are
    packed each."""
    return pack(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: No SQL can state trained filters, tokenizers or seeded draws: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents`` one after the other."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return docs
