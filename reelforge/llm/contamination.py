"""Benchmark passages found in documents: a prefix-filtered join of word shingles (operator 12). DataFrame functions only."""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.frames import documents, whole_text
from reelforge.operators.durable import broadcast_if_small, settle
from reelforge.operators.joins import spread_join

# Fixed value: what parts words; capitals are lower-cased and no break.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
MARK = 0  # the key of the row that each document has of its own


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else: other letters stay."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BREAKS), "")


def shingle_key(*hashes: Column) -> Column:
    """A number for a run of words, given their hashes."""
    return F.xxhash64(F.lit(len(hashes)), *hashes)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item`` (the id as text; null is empty), ``window`` (its words with one space between) and ``words`` (how many): each once."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(lowered(whole_text())).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - F.lit(window - 1), F.lit(1)))
    return (
        rows.where(F.size("all") > 0).select("item", "all", F.explode(starts).alias("at"))
        .select("item", F.slice("all", F.col("at"), window).alias("part"))
        .select("item", F.array_join("part", " ").alias("window"), F.size("part").alias("words")).distinct()
    )


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``window``, ``words``, ``size`` of its shingles, ``offset`` and ``key`` of each."""
    size = F.least(F.col("words"), F.lit(shingle))
    rows = windows.select("window", "words").distinct().select(
        "*", size.alias("size"), F.transform(F.split("window", " "), lambda w: F.xxhash64(w)).alias("_h"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("size"))).alias("offset"))
    hashes = [F.get("_h", F.col("offset") + i) for i in range(shingle)]
    key = F.coalesce(*[F.when(F.col("size") == n, shingle_key(*hashes[:n])) for n in range(1, shingle + 1)])
    return rows.select("window", "words", "size", "offset", key.alias("key"))


def shared_shingles(docs: DataFrame, shingles: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Where documents hold a shingle of the items: ``doc_id``, ``row``, ``k1``, ``k2`` (hashes of id and text), ``n_words``, ``pos``, ``key``.

    Each document has one more row, with the key ``MARK`` at ``pos`` = ``n_words``. The texts are read once; what is
    stored follows the shingles that documents and items share.
    """
    sizes = [row["size"] for row in shingles.select("size").distinct().collect()]  # at most `shingle` numbers
    keys = settle(shingles.select("key").union(docs.sparkSession.range(1).select(F.lit(MARK).cast("long"))).distinct(), "keys")
    texts = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", whole_text()).alias("k1"),
        F.xxhash64(F.lit(1), "doc_id", whole_text()).alias("k2"), words_of(whole_text()).alias("_words"))
    own = ["doc_id", "row", "k1", "k2"]
    hashed = texts.select(*own, F.transform("_words", lambda w: F.xxhash64(
        F.when(F.lower(w) == w, w).otherwise(lowered(w)))).alias("_h"))  # most words have no capitals
    nothing = F.array(F.lit(None).cast("long"))
    runs = F.arrays_zip(F.concat("_h", nothing).alias("h0"), *[
        F.slice("_h", i + 1, F.greatest(F.size("_h"), F.lit(1))).alias(f"h{i}") for i in range(1, shingle)])
    placed = hashed.select(*own, F.size("_h").alias("n_words"), F.posexplode(runs).alias("pos", "_run"))
    hashes = [F.col(f"_run.h{i}") for i in range(shingle)]
    here = [F.when(F.col("pos") + n <= F.col("n_words"), shingle_key(*hashes[:n])) for n in sizes]
    mark = F.when(F.col("pos") == F.col("n_words"), F.lit(MARK).cast("long"))
    key = F.coalesce(mark, here[0]) if len(here) == 1 else F.explode(F.array(mark, *here))
    keyed = placed.select(*own, "n_words", "pos", key.alias("key"))
    few = broadcast_if_small(keys)
    if few is not keys:
        return settle(keyed.where("key IS NOT NULL").join(few, "key"), "shingles")
    return settle(spread_join(may_hold(keyed.where("key IS NOT NULL"), bitmap_of(keys, "key"), F.col("key")), keys, ["key"], "inner"), "shingles")


def candidates(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """Places where a window may stand: ``row``, ``k1``, ``k2``, ``window``, ``words``, ``start``.

    A window's shingles are ordered by how often the documents hold them. As a window must be there whole, its prefix is the
    rarest one; a window that lacks one anywhere is left out. The shingle's place gives the window's, which
    must lie within the document.
    """
    rarity = found.where(F.col("pos") < F.col("n_words")).groupBy("key").agg(F.count(F.lit(1)).alias("_often"))
    prefix = (
        shingles.join(broadcast_if_small(settle(rarity, "rarity")), "key", "left").groupBy("window", "words")
        .agg(F.min(F.struct("_often", "key", "offset")).alias("_first"), F.count_if(F.col("_often").isNull()).alias("_absent"))
        .where("_absent = 0").select("window", "words", F.col("_first.key").alias("key"), F.col("_first.offset").alias("offset"))
    )
    listed = prefix.groupBy("key").agg(F.collect_list(F.struct("window", "words", "offset")).alias("_windows"))
    start = F.col("pos") - F.col("_w.offset")
    places = spread_join(found.where(F.col("pos") < F.col("n_words")), listed, ["key"], "inner")
    return (
        places.select("row", "k1", "k2", "n_words", "pos", F.explode("_windows").alias("_w"))
        .where((start >= 0) & (start + F.col("_w.words") <= F.col("n_words")))
        .select("row", "k1", "k2", "_w.window", "_w.words", start.cast("int").alias("start"))
    )


def contained(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The candidates that the text bears out, one row per different document: ``k1``, ``k2``, ``found`` (start, words, window).

    Of rows that repeat id and text one is looked at. Only the texts that have candidates are shuffled.
    """
    one = places.groupBy("k1", "k2").agg(F.min("row").alias("_one"))
    asked = settle(
        spread_join(places, one, ["k1", "k2"], "inner").where(F.col("row") == F.col("_one"))
        .groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "words", "window")).alias("asked")), "asked")
    texts = docs.select(
        F.xxhash64("doc_id", whole_text()).alias("k1"), F.xxhash64(F.lit(1), "doc_id", whole_text()).alias("k2"), whole_text().alias("text"))
    wanted = may_hold(texts, bitmap_of(asked, "k1"), F.col("k1")).dropDuplicates(["k1", "k2"])

    def borne_out(words: Column) -> Column:
        return F.filter("asked", lambda c: F.array_join(F.slice(words, c["start"] + 1, c["words"]), " ") == c["window"])

    every = F.transform(F.array(words_of(lowered(F.col("text")))), borne_out)[0]  # the words are found once, not once a place
    return settle(
        wanted.hint("merge").join(asked, ["k1", "k2"]).select("k1", "k2", every.alias("found")).where(F.size("found") > 0), "found")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` (start and end in words, of each hit run), ``items`` (sorted).

    A window is ``window`` words of an item in a row; an item of fewer words is one window; an item without words, null
    among them, has none. A word is hit if it lies in an occurrence of a window. Items whose id is null go under the empty text;
    items that repeat an id are one. Null and empty documents have no words; texts of any length are compared whole; rows that repeat a
    ``doc_id`` have a row each; other columns are not read. No items leave all documents clean; no documents give no rows.
    """
    windows = settle(item_windows(items, window), "windows")
    shingles = settle(window_shingles(windows, shingle), "item-shingles")
    if shingles.isEmpty():
        return docs.select(
            "doc_id", F.size(words_of(whole_text())).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    found = shared_shingles(docs, shingles, shingle)
    verified = contained(docs, settle(candidates(found, shingles), "places"))

    every = verified.select("k1", "k2", F.inline("found")).select("k1", "k2", "start", (F.col("start") + F.col("words")).alias("end"))
    in_order = Window.partitionBy("k1", "k2").orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opened = every.withColumn("_new", F.when(F.col("start") <= before, 0).otherwise(1))
    runs = opened.withColumn("_run", F.sum("_new").over(in_order)).groupBy("k1", "k2", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy("k1", "k2").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    seen = verified.select("k1", "k2", F.explode(F.array_distinct(F.col("found.window"))).alias("window"))
    named = spread_join(seen, windows.groupBy("window").agg(F.collect_set("item").alias("_items")), ["window"], "inner")
    by_doc = named.select("k1", "k2", F.explode("_items").alias("_item")).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set("_item")).alias("items"))
    results = spans.join(by_doc, ["k1", "k2"])
    own = found.where((F.col("key") == MARK) & (F.col("pos") == F.col("n_words")))
    return spread_join(own, results, ["k1", "k2"], "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op12_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document of ``documents``: how many of its words lie in windows of ``benchmark`` items, and of which items."""
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = (
    r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")
OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_SQL_WORDS} AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS win, least(len(words), {WINDOW}) AS size
    FROM (SELECT *, unnest(range(1, greatest(len(words) - {WINDOW - 1}, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
places AS (
    SELECT row_no, i, size, array_to_string(words[i : i + size - 1], ' ') AS win FROM (
        SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))),
met AS (SELECT p.row_no, p.i, p.size, w.item FROM places p JOIN windows w ON p.win = w.win AND p.size = w.size),
hit AS (SELECT row_no, count(DISTINCT word) AS n_hit FROM (SELECT row_no, unnest(range(i, i + size)) AS word FROM met) GROUP BY row_no),
named AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row_no, item FROM met) GROUP BY row_no)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row_no) LEFT JOIN named USING (row_no)
"""
