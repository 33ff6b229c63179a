"""Join of documents whose sets of word n-grams are similar: MinHash banding with exact verification (operator 8)."""

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.components import connected
from reelforge.llm.frames import carried, documents, whole_text
from reelforge.llm.rawtext import Hasher, mixed, utf8, word_hashes
from reelforge.operators.durable import settle
from reelforge.operators.joins import spread_join

NGRAM = 5
LEAST = 0.8
RECALL = 0.99999
ROWS_PER_BAND = 5
BLOCK_NGRAMS = 1 << 15
PIECE_BYTES = 1 << 20
SEED = 5


def bands_for(least: float = LEAST, recall: float = RECALL, rows: int = ROWS_PER_BAND) -> int:
    """Bands of ``rows`` MinHashes with which a pair of similarity ``least`` meets at least once with chance ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - least**rows)))


def ngram_sets(column, n: int = NGRAM):
    """Per text, the sorted different hashes of its word n-grams.

    Words stand between ASCII white space. A text of fewer than ``n`` words is one n-gram; a text without words has none.
    """
    raw, limits = utf8(column)
    hasher, weights = Hasher(), [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(n)]
    first = 0
    while first < len(limits) - 1:
        last = max(first + 1, int(np.searchsorted(limits, limits[first] + PIECE_BYTES, "right")) - 1)
        words, ranges = word_hashes(raw[limits[first] : limits[last]], limits[first : last + 1] - limits[first], hasher)
        grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            grams += words[k : k + len(grams)] * weights[k]
        grams = mixed(grams)
        for low, high in zip(ranges[:-1].tolist(), ranges[1:].tolist()):
            if high - low >= n:
                yield np.unique(grams[low : high - n + 1])
            elif high > low:
                yield mixed((words[low:high] * np.array(weights[: high - low])).sum(keepdims=True) + np.uint64(high - low))
            else:
                yield np.zeros(0, np.uint64)
        first = last


def band_keys(grams: np.ndarray, multipliers: np.ndarray, rows: int) -> np.ndarray:
    """One key per band: a hash of the band's MinHashes."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 512):
        np.minimum(least, (grams[at : at + 512, None] * multipliers).min(axis=0), out=least)
    by_band = least.reshape(-1, rows)
    key = np.arange(len(by_band), dtype=np.uint64)
    for k in range(rows):
        key = mixed(key ^ by_band[:, k] + np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _digest(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


def _signed(n: int, rows: int, bands: int):
    def signed(batches):
        multipliers = np.random.default_rng(SEED).integers(0, 1 << 63, rows * bands, np.uint64) << np.uint64(1) | np.uint64(1)
        for batch in batches:
            sets, sizes, keys = [], [], []
            for grams in ngram_sets(batch.column("text"), n):
                sets.append(_digest(grams) if len(grams) else None)
                sizes.append(len(grams))
                keys.append(band_keys(grams, multipliers, rows) if len(grams) else np.zeros(0, np.int64))
            limits = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "hash": batch.column("hash"),
                "set": pa.array(sets, pa.binary()), "size": pa.array(sizes, pa.int64()),
                "bands": pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))})
    return signed


def _with_sets(n: int):
    def with_sets(batches):
        for batch in batches:
            found = [g.tobytes() for g in ngram_sets(batch.column("text"), n)]
            yield pa.RecordBatch.from_pydict({
                "set": pa.array([blake2b(g, digest_size=16).digest() for g in found], pa.binary()), "grams": pa.array(found, pa.binary())})
    return with_sets


def _linked(least: float):
    """Links between the sets of two blocks: per set its number of linked documents, and a forest of the links."""
    def linked(batches):
        for batch in batches:
            for number in range(batch.num_rows):  # one pair of blocks at a time
                row = {name: batch.column(name)[number].as_py() for name in batch.schema.names}
                own = row["left"] == row["right"]
                left = row["ours"]
                right = left if own else row["theirs"]
                ours = [np.frombuffer(x["grams"], np.uint64) for x in left]
                theirs = ours if own else [np.frombuffer(x["grams"], np.uint64) for x in right]
                sizes = np.array([len(x) for x in theirs])
                every = np.concatenate(theirs)
                order = np.argsort(every, kind="stable")
                every, of = every[order], np.repeat(np.arange(len(theirs)), sizes)[order]
                copies = np.array([x["copies"] for x in right])
                counts = {}
                parent: dict = {}

                def root(x):
                    while parent.setdefault(x, x) != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                edges = []
                for at, grams in enumerate(ours):
                    low = np.searchsorted(every, grams, "left")
                    many = np.searchsorted(every, grams, "right") - low
                    places = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
                    shared = np.bincount(of[places], minlength=len(theirs))
                    near = shared / (len(grams) + sizes - shared) >= least
                    if own:
                        near[at] = False
                    hits = np.flatnonzero(near)
                    if not len(hits):
                        continue
                    name = left[at]["set"]
                    counts[name] = counts.get(name, 0) + int(copies[hits].sum())
                    for other in hits.tolist():
                        label = right[other]["set"]
                        if not own:
                            counts[label] = counts.get(label, 0) + left[at]["copies"]
                        a, b = root(name), root(label)
                        if a != b:
                            parent[a] = b
                            edges.append((name, label))
                yield pa.RecordBatch.from_pydict({
                    "set": pa.array([*counts, *(a for a, _ in edges)], pa.binary()),
                    "links": pa.array([*counts.values(), *(0 for _ in edges)], pa.int64()),
                    "other": pa.array([*(None for _ in counts), *(b for _, b in edges)], pa.binary())})
    return linked


def _identity(*columns) -> tuple[Column, Column]:
    return F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2")


def similar_documents(docs: DataFrame, n: int = NGRAM, least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``n_links``, ``kept``, and ``hash`` (of the text).

    Texts are lower-cased. Two documents are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``least``; ``n_links`` counts a document's links, copies too. A class is a connected component of links; ``class_id`` is its
    smallest ``doc_id`` and that document is ``kept`` (of rows that repeat it, one). Null ids come first. Texts without
    words, null among them, are linked with nothing and kept. Texts of any length are compared whole; other columns are not
    read, whatever their names. An empty table gives no rows.

    Documents with equal sets are one class from the start and travel as one. Classes meet where a band's key is
    equal. What meets is cut into blocks of about ``BLOCK_NGRAMS`` n-grams by the largest bucket of each class, so that
    similar classes share a block, and pairs of blocks that share a key are verified on whole sets. So the shuffles
    carry blocks and never the pairs of a bucket; a task gives counts and a spanning forest of its links, not the
    links. With the production settings a pair at the threshold is missed with chance 1 - ``recall``.
    """
    bands = bands_for(least, recall)
    texts = docs.select("doc_id", F.lower(whole_text()).alias("text"), F.xxhash64(whole_text()).alias("hash"))
    signed = settle(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _signed(n, ROWS_PER_BAND, bands), "row long, doc_id long, hash long, set binary, size long, bands array<long>"), "signatures")
    classes = settle(
        signed.where("set IS NOT NULL").groupBy("set").agg(
            F.min(F.struct("doc_id", "hash", "row")).alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("size").alias("size"), F.first("bands").alias("bands")), "classes")

    keys = classes.select("set", "size", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = settle(shared, "buckets")
    met = settle(may_hold(keys, bitmap_of(shared, "key"), F.col("key")).join(shared, "key"), "members")
    homes = met.groupBy("set").agg(F.max(F.struct("members", "key"))["key"].alias("home"), F.max("size").alias("size"))
    weights = homes.groupBy("home").agg(F.ceil(F.sum("size") / BLOCK_NGRAMS).alias("parts"))
    blocks = settle(
        homes.join(weights, "home").select("set", F.xxhash64("home", F.pmod(F.xxhash64("set"), F.col("parts"))).alias("block")), "blocks")

    in_bucket = met.join(blocks, "set").groupBy("key").agg(F.sort_array(F.collect_set("block")).alias("all"))
    pairs = (
        in_bucket.select("all", F.posexplode("all").alias("at", "left"))
        .select("left", F.explode(F.slice("all", F.col("at") + 1, F.size("all"))).alias("right")).distinct()
    )
    wanted = classes.join(blocks, "set", "left_semi").select(F.xxhash64("least.doc_id", "least.hash").alias("place"))
    chosen = may_hold(texts, bitmap_of(wanted, "place"), F.xxhash64("doc_id", "hash"))
    contents = (
        chosen.select("text").mapInArrow(_with_sets(n), "set binary, grams binary").dropDuplicates(["set"])
        .join(blocks, "set").join(classes.select("set", "copies"), "set")
        .groupBy("block").agg(F.collect_list(F.struct("set", "copies", "grams")).alias("held"))
    )
    contents = settle(contents, "contents")
    nothing = F.array().cast(contents.schema["held"].dataType)
    verified = settle(
        pairs.join(contents.select(F.col("block").alias("left"), F.col("held").alias("ours")), "left")
        .join(contents.select(F.col("block").alias("right"), F.col("held").alias("theirs")), "right")
        .withColumn("theirs", F.when(F.col("left") == F.col("right"), nothing).otherwise(F.col("theirs")))
        .mapInArrow(_linked(least), "set binary, links long, other binary"), "links")
    roots = connected(verified.where("other IS NOT NULL").select(F.col("set").alias("a"), F.col("other").alias("b")))
    named = roots.join(classes.select(F.col("set").alias("node"), "least"), "node")
    kept = named.groupBy("root").agg(F.min("least").alias("first"))
    links = verified.groupBy("set").agg(F.sum("links").alias("links"))
    grouped = (
        classes.select("set", "copies", "least")
        .join(roots.join(kept, "root").select(F.col("node").alias("set"), "first"), "set", "left").join(links, "set", "left")
        .select("set", F.coalesce("first", "least").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return spread_join(signed.drop("bands"), grouped, ["set"], "left").select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"), "hash")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each class of similar ones; columns stay. Rows that repeat id and text count once."""
    kept = similar_documents(docs, **settings).where("kept").select(*_identity("doc_id", "hash"))
    keyed = carried(docs, "doc_id", "text").withColumn("_hash", F.xxhash64(whole_text()))
    first, second = _identity("doc_id", "_hash")
    return (
        keyed.select("_doc", first.alias("_k1"), second.alias("_k2"))
        .join(kept.distinct().withColumnsRenamed({"k1": "_k1", "k2": "_k2"}), ["_k1", "_k2"])
        .dropDuplicates(["_k1", "_k2"]).select("_doc.*")
    )


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Classes and links of ``documents`` whose 5-word sets are at least 0.8 similar."""
    return similar_documents(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "kept")


OP8_SQL = f"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x09-\\x0D\\x20]+'), lambda w: w <> '') AS words FROM documents),
sets AS (
    SELECT row_no, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {NGRAM} THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - {NGRAM - 2}), lambda i: array_to_string(words[i : i + {NGRAM - 1}], ' '))) END AS grams
    FROM texts),
grams AS (SELECT row_no, unnest(grams) AS gram FROM sets),
pairs AS (
    SELECT a.row_no AS a, b.row_no AS b, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.row_no < b.row_no
    GROUP BY a.row_no, b.row_no),
links AS (
    SELECT a, b FROM pairs JOIN sets x ON x.row_no = a JOIN sets y ON y.row_no = b
    WHERE shared::DOUBLE / (len(x.grams) + len(y.grams) - shared) >= {LEAST}),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT row_no AS a, row_no AS b FROM sets UNION SELECT r.a, e.b FROM reach r JOIN two_way e ON e.a = r.b),
classes AS (SELECT a AS row_no, min(b) AS class FROM reach GROUP BY a),
degrees AS (SELECT a AS row_no, count(*) AS n FROM two_way GROUP BY a)
SELECT doc_id, first_value(doc_id) OVER same AS class_id, coalesce(n, 0) AS n_links, row_number() OVER same = 1 AS kept
FROM sets JOIN classes USING (row_no) LEFT JOIN degrees USING (row_no) WINDOW same AS (PARTITION BY class ORDER BY doc_id NULLS FIRST, row_no)
"""
