"""Phrases that occur together far more often than apart, from a weighted de Bruijn graph of words (operator 11)."""

import functools
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import CHUNK
from reelforge.llm.frames import documents, whole_text
from reelforge.llm.rawtext import Hasher, mixed, runs, utf8
from reelforge.operators.durable import settle
from reelforge.operators.joins import spread_join

LEAST = 30
MOST = 2000
COVER = 80
SCALE = 2_000_000
BLOCK_BYTES = 1 << 19
LEAST_BITS = 1 << 20
MOST_BITS = 1 << 30  # 128 MB: a fuller bitmap only lets more pairs through
RANKED_AT_ONCE = 50_000
GRAM = ["h1", "h2", "h3", "h4"]

# Bytes that part words, and those of them that also end a piece.
_BLANK, _STOP = np.ones(256, np.uint8), np.zeros(256, bool)
_STOP[[*b".,;:!?", 10, 11, 12, 13]] = True
_BLANK[[9, 32]] = 0
_BLANK[_STOP] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _blocks(batch, hasher: Hasher):
    """Runs of whole texts of about half a MB: their bytes, words (start, end, hash), row of each word, and which words have a next one in their piece."""
    raw, limits = utf8(batch.column("text"))
    first = 0
    while first < len(limits) - 1:
        last = max(first + 1, int(np.searchsorted(limits, limits[first] + BLOCK_BYTES, "right")) - 1)
        low = _LOWER[raw[limits[first] : limits[last]]]
        ends_of = limits[first : last + 1] - limits[first]
        starts, ends = runs(_BLANK[low], ends_of)
        hashes = hasher(low, starts, ends)
        hashes[hashes == 0] = 1  # 0 stands for no word
        row = np.searchsorted(ends_of, starts, "right") - 1
        stops = np.cumsum(_STOP[low], dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int64)
        follows = np.zeros(len(starts), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (stops[1:] == stops[:-1])
        yield low, starts, ends, hashes, row + first, follows
        first = last


def _languages(batch) -> tuple[np.ndarray, list]:
    """A number for each row's language in this batch, and the languages."""
    codes, names = pd.factorize(batch.column("lang").to_pandas())
    return codes, names.tolist()


def _pair_keys(hashes: np.ndarray, codes: np.ndarray, names: list) -> np.ndarray:
    """A hash of each word with its language and the word after it."""
    seeds = np.array([int.from_bytes(blake2b(name.encode(), digest_size=8).digest()) for name in names] or [0], np.uint64)
    after = np.append(hashes[1:], np.uint64(0))
    return mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + mixed(after ^ seeds[codes]))


def _pairs(batches):
    hasher = Hasher()
    for batch in batches:
        codes, names = _languages(batch)
        for _, _, _, hashes, row, follows in _blocks(batch, hasher):
            keys, counts = np.unique(_pair_keys(hashes, codes[row], names)[follows], return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "n": pa.array(counts.astype(np.int64))})


def _grams(bitmap):
    """Per block: the grams of up to four words that start at each word, counted, and the words of frequent pairs."""
    def grams(batches):
        hasher, bits = Hasher(), np.frombuffer(bitmap.value, np.uint8)
        mask = np.uint64(len(bits) * 8 - 1)
        for batch in batches:
            codes, names = _languages(batch)
            for low, starts, ends, hashes, row, follows in _blocks(batch, hasher):
                if not len(starts):
                    continue
                slot = _pair_keys(hashes, codes[row], names) & mask
                two = follows & ((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                three = two & np.append(two[1:], False)
                four = three & np.append(three[1:], False)
                word, different = pd.factorize(hashes)
                wide = len(different) + 1

                def at(steps: int, there: np.ndarray) -> np.ndarray:
                    """The word some steps on, from 1; 0 where the gram has ended."""
                    return np.where(there, np.append(word[steps:], np.zeros(steps, word.dtype)) + 1, 0)

                front, _ = pd.factorize((word * len(names) + codes[row]) * wide + at(1, two))
                back, backs = pd.factorize(at(2, three) * wide + at(3, four))
                _, place, counts = np.unique(front * len(backs) + back, return_index=True, return_counts=True)

                def there(steps: int, held: np.ndarray) -> np.ndarray:
                    return np.where(held[place], np.append(hashes[steps:], np.zeros(steps, np.uint64))[place], np.uint64(0)).view(np.int64)

                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array(names, pa.string()).take(pa.array(codes[row[place]])),
                    "h1": pa.array(hashes[place].view(np.int64)), "h2": pa.array(there(1, two)), "h3": pa.array(there(2, three)),
                    "h4": pa.array(there(3, four)), "word": pa.nulls(len(place), pa.string()), "n": pa.array(counts.astype(np.int64))})
                used = two | np.append(False, two[:-1])
                example = np.full(len(different), -1)
                example[word[used]] = np.flatnonzero(used)
                example = example[example >= 0]
                data = low.tobytes()
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[example].tolist(), ends[example].tolist())]
                nothing = pa.array(np.zeros(len(example), np.int64))
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.nulls(len(example), pa.string()), "h1": pa.array(hashes[example].view(np.int64)), "h2": nothing,
                    "h3": nothing, "h4": nothing, "word": pa.array(texts, pa.string()), "n": nothing})
    return grams


def _bits_of(keys: DataFrame) -> bytes:
    """The keys as a bitmap of 16 bits a key, a power of two between ``LEAST_BITS`` and ``MOST_BITS``."""
    size = max(LEAST_BITS, min(MOST_BITS, 1 << max(0, 16 * keys.count() - 1).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit(size - 1))
    chunks = keys.groupBy(F.floor(slot / CHUNK).alias("at")).agg(F.bitmap_construct_agg(slot % CHUNK).alias("bits")).collect()
    bitmap, step = bytearray(size // 8), CHUNK // 8
    for chunk in chunks:
        bitmap[chunk["at"] * step : (chunk["at"] + 1) * step] = chunk["bits"]
    return bytes(bitmap)


def longest_grams(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The graph's edges and what corrects them: ``lang``, ``h1`` to ``h4``, ``word``, ``n``.

    Every word occurrence is the start of one gram: itself and up to three words after it, as hashes, 0 where the piece has
    ended. A gram of four words is an edge between the nodes of its first and last three; a shorter one is the
    correction for a piece's end. Pieces also end between words that follow each other fewer than ``least`` times: no phrase
    that is looked for holds such a pair, so no count that matters changes, and what is shuffled follows the
    frequent pairs and not the text. A bitmap of frequent pairs serves for that; a false hit only keeps a pair. Rows with a
    ``word`` have ``n`` 0 and tell which word a hash of a frequent pair stands for; two words of one hash fail the job.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    pairs = texts.mapInArrow(_pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    frequent = settle(pairs.select("key"), "pairs")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bits_of(frequent))
    schema = "lang string, h1 long, h2 long, h3 long, h4 long, word string, n long"
    return settle(
        texts.mapInArrow(_grams(bitmap), schema).groupBy("lang", *GRAM, "word").agg(F.sum("n").alias("n")), "grams")


def _flow(longer: DataFrame, ended: DataFrame, size: int) -> DataFrame:
    """Counts of all grams of ``size`` words: the flow out of each node, and the pieces that end with it."""
    key = ["lang", *GRAM[:size]]
    return settle(longer.select(*key, "f").union(ended.select(*key, "f")).groupBy(*key).agg(F.sum("f").alias("f")), "flow")


def gram_counts(edges: DataFrame) -> dict[int, DataFrame]:
    """Counts of all grams of 4, 3, 2 and 1 words of the graph: ``lang``, hashes, ``f``."""
    grams = edges.where("word IS NULL").withColumnRenamed("n", "f").drop("word")
    ended = {4: grams.where("h4 <> 0"), 3: grams.where("h3 <> 0 AND h4 = 0"), 2: grams.where("h2 <> 0 AND h3 = 0"), 1: grams.where("h2 = 0")}
    counts = {4: ended[4]}
    for size in (3, 2, 1):
        counts[size] = _flow(counts[size + 1], ended[size], size)
    return counts


def unary_paths(counts: dict[int, DataFrame], least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Maximal paths of edges through unary nodes, and those nodes.

    A node is unary if one edge brings all of its flow and one edge takes all of it. Paths: ``lang``, ``hashes`` of their
    words in order, and ``f``, which all edges and inner nodes share. Nodes: ``lang``, ``h1`` to ``h3``. Each edge finds the
    first edge of its path by pointer doubling, in as many rounds as the logarithm of the longest path. There are no
    cycles: before each occurrence of a unary node stands another one, and pieces have a start.
    """
    edges = counts[4].where(F.col("f") >= least)
    nodes = counts[3].where(F.col("f") >= least)
    end = [F.col(name).alias(to) for name, to in zip(GRAM[1:], GRAM)]
    into = edges.select("lang", *end, "f", F.col("h1").alias("before")).join(nodes, ["lang", *GRAM[:3], "f"], "left_semi")
    out = edges.select("lang", *GRAM, "f").join(nodes, ["lang", *GRAM[:3], "f"], "left_semi")
    passed = settle(into.join(out, ["lang", *GRAM[:3], "f"]), "links")
    edge = F.struct("lang", *GRAM)
    led = settle(passed.select(
        edge.alias("edge"), F.struct("lang", F.col("before").alias("h1"), F.col("h1").alias("h2"), F.col("h2").alias("h3"),
                                     F.col("h3").alias("h4")).alias("head"), F.lit(1).cast("long").alias("steps")), "paths")
    while True:
        onward = led.select(F.col("edge").alias("head"), F.col("head").alias("_head"), F.col("steps").alias("_steps"))
        led = settle(led.join(onward, "head", "left").select(
            "edge", F.coalesce("_head", "head").alias("head"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.col("_head").isNotNull().alias("moved")), "paths")
        if led.where("moved").isEmpty():
            break
    placed = edges.select(edge.alias("edge"), "f").join(led.select("edge", "head", "steps"), "edge", "left")
    paths = placed.groupBy(F.coalesce("head", "edge").alias("head"), "f").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("steps", F.lit(0)).alias("steps"), F.col("edge.h4").alias("h")))).alias("_last"))
    return (
        paths.select("head.lang", F.concat(F.array("head.h1", "head.h2", "head.h3"), F.col("_last.h")).alias("hashes"), "f"),
        passed.select("lang", *GRAM[:3]).distinct(),
    )


def _padded(frame: DataFrame, size: int) -> DataFrame:
    return frame.select("lang", *GRAM[:size], *[F.lit(0).cast("long").alias(name) for name in GRAM[size:]], "f")


def _part(first: int, last: int) -> list:
    """The words from ``first`` to before ``last`` of a gram as a gram."""
    inside = GRAM[first:last]
    return [*[F.col(name) for name in inside], *[F.lit(0).cast("long")] * (4 - len(inside))]


def scored(counts: dict[int, DataFrame], least: int = LEAST) -> DataFrame:
    """Candidates of 2 to 4 words that no longer one covers: ``lang``, hashes, ``a``, ``l``, ``r``, ``score``.

    Nodes inside unary paths are covered by their edges, which are as frequent, and never get this far. For the
    others the largest count of a longer candidate that holds them decides.
    """
    frequent = {size: frame.where(F.col("f") >= least) for size, frame in counts.items()}
    _, inner = unary_paths(counts, least)
    outer = frequent[3].join(inner, ["lang", *GRAM[:3]], "left_anti")
    key = ["lang", *GRAM]
    all_of = functools.reduce(DataFrame.union, [_padded(frequent[size], size) for size in (1, 2, 3, 4)])

    def inside(size: int) -> list:
        return [F.struct(*[c.alias(n) for c, n in zip(_part(at, at + part), GRAM)])
                for part in range(2, size) for at in range(size - part + 1)]

    covers = functools.reduce(DataFrame.union, [
        frequent[size].select("lang", F.explode(F.array(*inside(size))).alias("_in"), "f") for size in (3, 4)])
    covers = covers.groupBy("lang", *[F.col(f"_in.{name}").alias(name) for name in GRAM]).agg(F.max("f").alias("_longer"))
    candidates = functools.reduce(DataFrame.union, [_padded(frequent[2], 2), _padded(outer, 3), _padded(frequent[4], 4)])
    whole = "decimal(38,0)"
    kept = settle(
        candidates.withColumnRenamed("f", "a").join(covers, key, "left")
        .where(F.col("_longer").isNull() | (F.col("_longer").cast(whole) * 100 < F.col("a").cast(whole) * COVER)).drop("_longer"), "candidates")

    def sides(size: int):
        cuts = [F.struct(F.lit(cut).alias("cut"), F.lit(side).alias("side"), *[c.alias(f"p{i}") for i, c in enumerate(part, 1)])
                for cut in range(1, size) for side, part in (("l", _part(0, cut)), ("r", _part(cut, size)))]
        return F.array(*cuts)

    size = F.when(F.col("h3") == 0, 2).when(F.col("h4") == 0, 3).otherwise(4)
    parts = kept.withColumn("_size", size).select(*key, "a", F.explode(
        F.when(F.col("_size") == 2, sides(2)).when(F.col("_size") == 3, sides(3)).otherwise(sides(4))).alias("_part"))
    parts = parts.select(*key, "a", "_part.*")
    table = all_of.select("lang", *[F.col(name).alias(f"p{i}") for i, name in enumerate(GRAM, 1)], "f")
    found = spread_join(parts, table, ["lang", "p1", "p2", "p3", "p4"], "inner")

    def value(cut: int, side: str):
        return F.max(F.when((F.col("cut") == cut) & (F.col("side") == side), F.col("f")))

    cut_counts = found.groupBy(*key, "a").agg(*[value(cut, side).alias(f"{side}{cut}") for cut in (1, 2, 3) for side in "lr"])

    def score(cut: int):
        exact = F.expr(f"CAST((CAST(a AS {whole}) * {SCALE}) div (CAST(l{cut} AS {whole}) + CAST(r{cut} AS {whole})) AS bigint)")
        return F.when(F.col(f"l{cut}").isNotNull(), F.struct(
            exact.alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))

    least_cut = F.array_min(F.filter(F.array(score(1), score(2), score(3)), lambda x: x.isNotNull()))
    return cut_counts.withColumn("_cut", least_cut).select(*key, "a", "_cut.l", "_cut.r", "_cut.score")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """The first ``most`` phrases of each language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Null ``lang`` is ``und``; null and empty texts have no words; texts of any length are read whole, in blocks of whole texts
    of about half a MB; rows that repeat an id or a text count each; other columns are not read. Ties go to the larger count, then
    to the phrase that comes first in byte order. An empty table gives no rows. Counts are longs, products decimals of 38 digits.
    """
    edges = longest_grams(docs, least)
    candidates = settle(scored(gram_counts(edges), least), "scored")
    salts = max(1, -(-candidates.count() // RANKED_AT_ONCE))
    best = [F.col("score").desc(), F.col("a").desc()]
    salted = candidates.withColumn("_salt", F.pmod(F.xxhash64(*GRAM), F.lit(salts)))
    for groups in (["lang", "_salt"], ["lang"]):  # ties at the end stay until their words are known
        salted = salted.withColumn("_rank", F.rank().over(Window.partitionBy(*groups).orderBy(*best))).where(F.col("_rank") <= most)
    words = edges.where("word IS NOT NULL").groupBy("h1").agg(F.collect_list("word").alias("_words")).select(
        F.col("h1").alias("h"), F.when(F.size("_words") > 1, F.raise_error(F.lit("two words under one hash")))
        .otherwise(F.col("_words")[0]).cast("string").alias("word"))
    best_of = settle(salted.drop("_salt", "_rank"), "best")
    spelled = best_of.select("*", F.posexplode(F.array(*GRAM)).alias("at", "h")).where("h <> 0")
    key = ["lang", *GRAM, "a", "l", "r", "score"]
    named = spread_join(spelled, words, ["h"], "inner").groupBy(*key).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    totals = edges.where("word IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(*best, "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to four words of each language of ``documents``."""
    found = collocations(documents(spark, sf_dir))
    return found.withColumn("rank", F.col("rank").cast("long"))


OP11_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
grams AS (
    SELECT lang, words[i : i + k - 1] AS g, k FROM (
        SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM split, range(1, 5) AS sizes(k))),
counted AS (SELECT lang, g, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= {LEAST}),
covered AS (
    SELECT lang, part, max(f) AS longer FROM (
        SELECT lang, f, g[i : i + p - 1] AS part FROM (
            SELECT *, unnest(range(1, k - p + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS p FROM frequent WHERE k > 2)))
    GROUP BY lang, part),
kept AS (
    SELECT c.lang, c.g, c.k, c.f AS a FROM frequent c LEFT JOIN covered v ON c.lang = v.lang AND c.g = v.part
    WHERE c.k > 1 AND (v.longer IS NULL OR 100::HUGEINT * v.longer < {COVER}::HUGEINT * c.f)),
cuts AS (
    SELECT x.lang, x.g, x.a, cut, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * x.a) // (l.f + r.f) AS score
    FROM (SELECT lang, g, a, k, unnest(range(1, k)) AS cut FROM kept) x
    JOIN counted l ON l.lang = x.lang AND l.g = x.g[1 : cut] JOIN counted r ON r.lang = x.lang AND r.g = x.g[cut + 1 : x.k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
           array_to_string(g, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {MOST}
"""
