"""Sources mixed to target weights over fixed-length token blocks (operator 7). DataFrame functions only."""

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.frames import carried, changed, documents
from reelforge.operators.durable import broadcast_if_small, settle
from reelforge.operators.joins import spread_join

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD_SLOTS = 8192
ROUNDS = 10
PAGE = 8192
MOST_COPIES = 1 << 10
KEY_STEP = 1_000_003  # keeps the keys of sources and copies apart
SEED = 20_250_711
ROWS_AT_ONCE = 20_000
SLOTS_AT_ONCE = 50_000


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A keyed pseudorandom permutation of 0 .. size - 1 for any size: the swap-or-not shuffle.

    In each round, ``index`` and its mirror ``c - index`` swap places or not, as a hash of the larger of the two says.
    ``key`` is a number from 0 to 2^60; the constants of the rounds come from the seed.
    """
    draw = random.Random(SEED)
    constants = F.array(*[F.lit(draw.randrange(1 << 60)).cast("long") for _ in range(ROUNDS)])

    def turn(at: Column, constant: Column) -> Column:
        mirror = F.pmod(constant + key - at, size)
        return F.when(F.xxhash64(constant, F.greatest(at, mirror)) < 0, mirror).otherwise(at)

    return F.aggregate(constants, index.cast("long"), turn)


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST,
                   block: int = BLOCK) -> DataFrame:
    """One row per source: its number by code point (null last), size, target, blocks, and slots of the mix.

    Targets follow the weights, stop at ``most`` times the source's size, and share the excess by weight among the rest
    until none is above: sources in order of size per weight are full up to the first whose part of what is left is below
    its stop. The windows are over sources, not rows.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    stop = F.col("source_size") * F.lit(float(most))
    every = Window.partitionBy()
    earlier = Window.orderBy(F.col("_stop") / F.col("_weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        numbered.withColumn("_weight", weight).withColumn("_stop", stop)
        .withColumn("_tokens", F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("_stop").over(earlier), F.lit(0.0)))
        .withColumn("_weights", F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0)))
        .withColumn("_full", F.col("_stop") / F.col("_weight") <= F.col("_tokens") / F.col("_weights"))
    )
    first_open = F.min(F.when(~F.col("_full"), F.struct(F.col("_stop") / F.col("_weight"), "sid", F.col("_tokens") / F.col("_weights")))).over(every)
    targets = (
        shares.withColumn("_rate", first_open["col3"])
        .withColumn("target", F.when(F.col("_full") | F.col("_rate").isNull(), F.col("_stop")).otherwise(F.col("_rate") * F.col("_weight")))
        .withColumn("target", F.least("target", "_stop"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    )
    slots = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.floor(F.col("blocks") * most).cast("long")))
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    return (
        targets.withColumn("slots", F.coalesce(slots, F.lit(0)))
        .withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0)))
        .select("sid", "source", "source_size", "target", "blocks", "slots", "first_slot")
    )


def draw_blocks(sources: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot of the mix: ``shard``, ``slot``, ``sid``, ``copy`` and ``block``.

    First the counts: a keyed permutation deals the sources' slots over the output, so how many slots of a shard each source
    gets is a multinomial draw under the condition that all shards together meet the targets. Then the blocks: a
    source's slots are numbered in order of the shards by prefix sums of its drawn counts, and within a shard by slot, and
    that index is mapped through the source's own permutation of block indexes, one for each time that it is gone through. So a
    change of the draw changes which block stands where. Slots are made from pages of ``PAGE`` slots, by
    as many tasks as their number asks for, and stored, since two steps read them.
    """
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    pages = sources.where("slots > 0").withColumn("_page", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / PAGE))))
    pages = pages.repartition(total // SLOTS_AT_ONCE + 1, "sid", "_page").withColumn("_first", F.col("_page") * PAGE)
    dealt = pages.select("sid", "blocks", "first_slot", F.explode(F.sequence(
        F.col("_first"), F.least(F.col("_first") + PAGE, F.col("slots")) - 1)).alias("_order"))
    slot = permuted(F.col("first_slot") + F.col("_order"), F.lit(max(total, 1)), F.lit(0))
    dealt = settle(dealt.select("sid", "blocks", slot.alias("slot")).withColumn("shard", F.floor(F.col("slot") / shard_slots)), "slots")
    counts = dealt.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("_drawn"))
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "shard", F.coalesce(F.sum("_drawn").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("sid", "shard").orderBy("slot")
    drawn = (
        dealt.withColumn("_at", F.row_number().over(inside) - 1).join(broadcast_if_small(settle(counts, "shards")), ["sid", "shard"])
        .withColumn("_order", F.col("_before") + F.col("_at")).withColumn("copy", F.floor(F.col("_order") / F.col("blocks")))
    )
    block = permuted(F.col("_order") - F.col("copy") * F.col("blocks"), F.col("blocks"), (F.col("sid") * MOST_COPIES + F.col("copy")) * KEY_STEP)
    return drawn.select("shard", "slot", "sid", "copy", block.alias("block"))


def block_parts(sized: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The parts of the blocks that each document fills: ``row``, ``sid``, ``block``, ``first_word``, ``words``.

    A source's documents lie one behind the other in an order by hash of id and text, whatever the partitions of the scan: rows
    that agree in both are of one size, and which of them comes first changes nothing. Their places are prefix sums over buckets of
    about ``ROWS_AT_ONCE`` rows, so that a source of any size is summed by many tasks.
    """
    spread = max(1, sized.count() // ROWS_AT_ONCE + 1)
    order = F.xxhash64(F.lit(SEED), "doc_id", "digest")
    rows = sized.withColumn("_hash", order).withColumn("_bucket", F.pmod("_hash", F.lit(spread)))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_size")).select(
        F.col("source").alias("_source"), F.col("_bucket").alias("_at"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_hash", "doc_id", "digest", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = named(
        rows.withColumn("_end", F.sum("size").over(inside))
        .join(buckets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_at")))
        .withColumn("_start", F.col("_before") + F.col("_end") - F.col("size")), sources, "sid")
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("size") - 1) / block)
    low = F.greatest(F.col("block") * block, F.col("_start"))
    high = F.least((F.col("block") + 1) * block, F.col("_start") + F.col("size"))
    return placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last))).select(
        "row", "sid", "block", (low - F.col("_start")).alias("first_word"), (high - low).alias("words"))


def named(rows: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    """Rows with columns of their source: broadcast if the sources are few, else joined with salts for large ones."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    return spread_join(rows.withColumn("_key", key), sources.select(key.alias("_key"), *columns), ["_key"], "inner").drop("_key")


def sized_rows(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``source``, ``size`` and ``digest`` of each document; null text has no words. Stored, since rows are numbered."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return settle(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", size.alias("size"), F.xxhash64("text").alias("digest")), "sizes")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target`` of its source, ``taken`` words (repeats counted), and
    ``shards``, the number of output shards that hold some of them.

    The mix holds ``share`` times all words. Null sources are one source, numbered last; documents without words, null
    text among them, take nothing; texts of any length are cut into blocks; rows that repeat a ``doc_id`` count each for themselves;
    other columns are not read. Reruns agree, also under other partitions. An empty table gives no rows.
    """
    sized = sized_rows(docs)
    sources = settle(source_targets(sized, weights, share, most, block), "sources")
    drawn = draw_blocks(sources).select("sid", "block", "shard")
    times = drawn.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"), F.collect_set("shard").alias("_shards"))
    taken = (
        block_parts(sized, sources, block).hint("merge").join(times, ["sid", "block"])  # see mixed_documents
        .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.flatten(F.collect_set("_shards")).alias("_shards"))
    )
    return named(sized.join(taken, "row", "left"), sources, "source_size", "target").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce(F.size(F.array_distinct("_shards")), F.lit(0)).cast("long").alias("shards"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document once for each copy that the mix takes of it.

    A copy of which all blocks are taken keeps its text; else it holds the words of the blocks taken, one space between
    words. ``n_chars`` follows the text. Documents of which nothing is taken are left out.
    """
    block = settings.pop("block", BLOCK)
    stored = settle(carried(docs).withColumn("row", F.monotonically_increasing_id()), "mixed")
    size = F.coalesce(F.regexp_count("_doc.text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = settle(stored.select("row", "_doc.doc_id", "_doc.source", size.alias("size"), F.xxhash64("_doc.text").alias("digest")), "sizes")
    sources = settle(source_targets(sized, block=block, **settings), "sources")
    # The planner takes exploded rows to be as few as those that they come from, and would broadcast them all.
    drawn = draw_blocks(sources).select("sid", "block", "copy")
    parts = block_parts(sized, sources, block).hint("merge").join(drawn, ["sid", "block"])
    copies = parts.groupBy("row", "copy").agg(
        F.sum("words").alias("_taken"), F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("_parts"))
    words = F.regexp_extract_all("_doc.text", F.lit(WORD), F.lit(0))

    def chosen(every: Column) -> Column:
        return F.array_join(F.flatten(F.transform("_parts", lambda p: F.slice(
            every, (p["first_word"] + 1).cast("int"), p["words"].cast("int")))), " ")

    cut = F.transform(F.array(words), chosen)[0]  # the words are found once, not once for each part
    partly = F.col("_taken") < F.col("size")
    return (
        stored.join(copies.join(sized.select("row", "size"), "row").hint("merge"), "row")
        .select("_doc", F.when(partly, cut).alias("_cut"))
        .select(F.when(F.col("_cut").isNull(), F.col("_doc")).otherwise(changed(docs, F.col("_cut"))).alias("_doc")).select("_doc.*")
    )


def op7_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all ``documents`` by weight of their sources: what it takes of each document."""
    return mix(documents(spark, sf_dir))
