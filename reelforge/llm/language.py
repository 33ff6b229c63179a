"""Language identification with bit-sliced Bloom filters of character n-grams (operator 5)."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.frames import carried, documents
from reelforge.llm.rawtext import mixed

UNKNOWN = "und"
SAMPLE_ROWS = 4_000  # labelled documents per language that the filters are learned from, on average
SLOTS = 1 << 20
HASHES = 3
LEAST_COUNT = 2
LEAST_SHARE = 0.25
PIECE_CHARS = 1 << 19
LEAST_SCORE = 0.3


class Filters(NamedTuple):
    """One Bloom filter per language, bit-sliced: ``words[w, slot]`` holds slot's bit of languages 64 w .. 64 w + 63."""

    languages: tuple[str, ...]
    words: np.ndarray
    false_rate: np.ndarray


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character trigrams of many texts and the text of each, in order.

    Texts are lower-cased; whatever stands between letters is one boundary, as are both ends. A trigram is three code
    points in one word of 63 bits.
    """
    joined = "\0" + "\0".join(t.replace("\0", " ") if "\0" in t else t for t in texts).lower() + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(points == 0)
    inside = _letters()[points]
    points = np.where(inside, points, np.uint32(0))
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the boundary after a word
    keep[:-1] |= inside[1:] & ~inside[:-1]  # and the one before; one of the two is dropped below
    text = np.cumsum(np.bincount(ends, minlength=len(points)))[keep] - 1
    points = points[keep].astype(np.uint64)
    double = np.zeros(len(points), bool)
    double[1:] = (points[1:] == 0) & (points[:-1] == 0) & (text[1:] == text[:-1])
    points, text = points[~double], text[~double]
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = points[:-2] | points[1:-1] << np.uint64(21) | points[2:] << np.uint64(42)
    middle = points[1:-1] != 0
    return keys[middle], text[1:-1][middle]


def _pieces(column) -> list[tuple[int, list[str]]]:
    """Runs of texts of some MB each, or one text; null is empty."""
    texts, pieces, size = [], [], 0
    first = 0
    for at, text in enumerate(column.to_pylist()):
        texts.append(text or "")
        size += len(texts[-1])
        if size >= PIECE_CHARS:
            pieces.append((first, texts))
            texts, size, first = [], 0, at + 1
    return pieces + [(first, texts)] if texts else pieces


def learn(labelled: DataFrame, slots: int = SLOTS, hashes: int = HASHES) -> Filters:
    """Filters from ``text`` and ``lang``; rows with a null are left out.

    A language's filter holds a trigram that it uses at least ``LEAST_COUNT`` times and at ``LEAST_SHARE`` or more of the
    highest rate among the languages. About ``SAMPLE_ROWS`` documents of each language are read, picked by a hash of the
    text: the bound of the fit. Counting is a distributed sum; the driver gets ``slots`` words at most.
    """
    labelled = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(rows))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)]) if languages else F.create_map()
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, SAMPLE_ROWS / rows[lang]))]) if languages else F.create_map()
    if not languages:
        return Filters((), np.zeros((1, slots), np.uint64), np.zeros(0))
    picked = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches):
        for batch in batches:
            numbers = np.asarray(batch.column("number"))
            for first, texts in _pieces(batch.column("text")):
                keys, text = grams(texts)
                of = numbers[first + text]
                for lang in np.unique(of):
                    found, n = np.unique(keys[of == lang], return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "number": pa.array(np.full(len(found), lang), pa.int32()),
                        "gram": pa.array(found.astype(np.int64)), "n": pa.array(n, pa.int64())})

    counts = (
        picked.select(number[F.col("lang")].alias("number"), "text").mapInArrow(count, "number int, gram long, n long")
        .groupBy("number", "gram").agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("number").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "number").withColumn("rate", F.col("n") / F.col("total"))
    best = rates.groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("number", "n", "rate")).alias("uses"))  # a use per language
    held = best.select("gram", F.explode("uses").alias("u")).where(
        (F.col("u.n") >= LEAST_COUNT) & (F.col("u.rate") >= LEAST_SHARE * F.col("top")))

    def place(batches):
        for batch in batches:
            keys = np.asarray(batch.column("gram")).astype(np.uint64)
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array(np.concatenate(_slots(keys, slots, hashes)).astype(np.int64)),
                "number": pa.array(np.tile(np.asarray(batch.column("number")), hashes), pa.int32())})

    placed = (
        held.select("gram", F.col("u.number").alias("number")).mapInArrow(place, "slot long, number int")
        .groupBy("slot", F.floor(F.col("number") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, number % 64)")).alias("bits")).toPandas()
    )
    words = np.zeros((-(-len(languages) // 64), slots), np.uint64)
    words[placed["word"].to_numpy(int), placed["slot"].to_numpy(int)] = placed["bits"].to_numpy(np.int64).astype(np.uint64)
    filled = [((words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))]
    return Filters(languages, words, np.array(filled) ** hashes)


def _slots(keys: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    high = mixed(keys)
    low = mixed(high ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    return [((high + np.uint64(i) * low) % np.uint64(slots)).astype(np.int64) for i in range(hashes)]


def scores(texts: list[str], filters: Filters, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of trigrams, and for each language the share of them that it holds, corrected for false positives."""
    keys, text = grams(texts)
    n = np.bincount(text, minlength=len(texts))
    slots = _slots(keys, filters.words.shape[1], hashes)
    found = np.zeros((len(texts), len(filters.languages)))
    for w, table in enumerate(filters.words):
        mask = table[slots[0]]
        for slot in slots[1:]:
            mask &= table[slot]
        for i in range(64 * w, min(64 * w + 64, len(filters.languages))):
            found[:, i] = np.bincount(text, (mask >> np.uint64(i % 64)) & np.uint64(1), len(texts))
    wrong = filters.false_rate
    return n, np.clip((found - n[:, None] * wrong) / np.maximum(n[:, None] * (1 - wrong), 1e-9), 0, 1)


def predicted(text: Column, spark, filters: Filters) -> Column:
    """A struct of ``lang_pred`` and ``score``; the filters have a fixed size and are broadcast.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or where nothing was learned. Ties go to
    the language first by name. The score is the share of the text's trigrams that the language holds.
    """
    shared = spark.sparkContext.broadcast(filters)

    def predict(column: pa.Array) -> pa.Array:
        known = shared.value
        names, values = [], []
        for _, texts in _pieces(column):
            if not known.languages:
                names += [UNKNOWN] * len(texts)
                values += [0.0] * len(texts)
                continue
            n, share = scores(texts, known)
            best = share.argmax(axis=1)
            names += [known.languages[b] if m else UNKNOWN for b, m in zip(best, n)]
            values += np.where(n > 0, share[np.arange(len(texts)), best], 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang_pred", "score"])

    return F.arrow_udf(predict, "lang_pred string, score double")(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept out of the fit: CRC-32 of the id as text leaves 2 by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``_doc`` (all columns of ``docs``), ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.

    Learned from the labelled rows of ``docs`` that are not held out; a null id is neither held out nor learned from. Null
    texts and texts without letters are ``und``; texts of any length are read whole; rows that repeat an id or a text have a row each;
    an empty table gives no rows.
    """
    filters = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    guess = predicted(F.col("text"), docs.sparkSession, filters)
    return carried(docs, "doc_id", "text").withColumn("_guess", guess).select(
        "_doc", "doc_id", held_out().alias("held_out"), F.col("_guess.lang_pred").alias("lang_pred"), F.col("_guess.score").alias("score"))


def in_known_language(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents of a language that was learned: others, and texts without letters, null ones among them, go.

    A document stays if its best language holds at least ``least`` of its trigrams. Columns stay, whatever their names; rows that repeat
    another stay or go with it.
    """
    return identify(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_doc.*")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
