"""Repeated and nearly repeated lines taken out of documents: a segment-partition edit join (operator 1).

DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.frames import carried, changed, documents, whole_text
from reelforge.operators.durable import settle
from reelforge.operators.joins import spread_join

DISTANCE = 1
LEAST_CHARS = 12
HOT_LINES = 200
FINE_CHARS = 1024
COARSE_PARTS = 64


def _segment(length: Column, number: int, distance: int) -> tuple[Column, Column]:
    """Start and length of one of the ``distance + 1`` even segments of a line; the longer ones come last."""
    parts = distance + 1
    base, longer = F.floor(length / parts), length % parts
    start = F.lit(number) * base + F.greatest(F.lit(0), F.lit(number) - (F.lit(parts) - longer))
    return start.cast("int"), (base + F.when(F.lit(number) >= F.lit(parts) - longer, 1).otherwise(0)).cast("int")


def segment_keys(line: Column, length: Column, distance: int) -> Column:
    """Array of ``(key, probe)``, or null: the line's own segments (``probe`` false) and the substrings it looks up (true).

    Lines within ``distance`` edits share a segment of the shorter one, at nearly the same place in the longer one: for a
    line shorter by d, segment i (from 0) starts at most i places from its own place and at most distance - i
    places from that place shifted by d. A key is a hash of the indexed line's length, the segment's number and its
    characters. A line's own segments are at once its look-ups among lines of its length at the same place.
    """
    keys = []
    for number in range(distance + 1):
        start, size = _segment(length, number, distance)
        keys.append(F.struct(F.xxhash64(length, F.lit(number), F.substring(line, start + 1, size)).alias("key"), F.lit(False).alias("probe")))
    for shorter in range(distance + 1):
        for number in range(distance + 1):
            start, size = _segment(length - shorter, number, distance)
            low, high = max(-number, shorter - (distance - number)), min(number, shorter + distance - number)
            for off in range(low, high + 1):
                if (shorter, off) == (0, 0):
                    continue
                at = start + off
                inside = (at >= 0) & (at + size <= length) & (length > shorter)
                key = F.xxhash64(length - shorter, F.lit(number), F.substring(line, at + 1, size))
                keys.append(F.when(inside, F.struct(key.alias("key"), F.lit(True).alias("probe"))))
    return F.array(*keys)


def compared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The lines that are compared: ``place`` (``doc_id``, hash of the text, number from 0), ``line`` without outer blanks, its hash."""
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("hash", F.xxhash64("text"))
    lines = texts.select("doc_id", "hash", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.select(F.struct("doc_id", "hash", "at").alias("place"), F.trim("line").alias("line")).withColumn("size", F.length("line"))
    return lines.where(F.col("size") >= least_chars).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), F.col("line"))})


def remainder_keys(line: Column, length: Column) -> Column:
    """Array of ``(key, probe)`` under which lines one edit apart meet: the line without one of its parts.

    Parts are single characters, or ``COARSE_PARTS`` even segments of a line of over ``FINE_CHARS`` characters. One changed
    character lies in one part, and the rest of the two lines is equal; a character more lies in a part of the shorter line that
    is one longer in the other, which looks that up (``probe``). A key hashes length, part and rest, so
    lines that share one differ within a part, whatever else they have in common with others.
    """
    def without(size: Column, more: int) -> Column:
        parts = F.when(size <= FINE_CHARS, size).otherwise(COARSE_PARTS).cast("int")

        def rest(number: Column) -> Column:
            base, longer = F.floor(size / parts), size % parts
            start = (number * base + F.greatest(F.lit(0), number - (parts - longer))).cast("int")
            end = start + (base + F.when(number >= parts - longer, 1).otherwise(0)).cast("int") + more
            return F.xxhash64(size, number, F.substring(line, F.lit(1), start), F.substring(line, end + 1, length))

        return F.transform(F.sequence(F.lit(0), parts - 1), lambda number: F.struct(rest(number).alias("key"), F.lit(bool(more)).alias("probe")))

    return F.when(length > 1, F.concat(without(length, 0), without(length - 1, 1))).otherwise(without(length, 0))


def _linked(left: DataFrame, right: DataFrame, once: Column, distance: int) -> DataFrame:
    """Pairs of different lines that share a key and are near; the distance is part of the join's condition, so no other pair becomes a row."""
    close = F.levenshtein("line", "theirs", distance) >= 0
    return left.join(right, (left["key"] == right["key"]) & once & (F.col("line") != F.col("theirs")) & close).select("line", "first", "theirs", "other")


def _meeting(keyed: DataFrame) -> DataFrame:
    """The rows whose key an indexed and a different line share (and few others): ``key``, ``probe``, ``line``, its ``first`` place."""
    shared = (
        keyed.groupBy("key").agg(F.min("h1").alias("least"), F.max("h1").alias("most"), F.min("probe").alias("probe"))
        .where("NOT probe AND least <> most").select("key")
    )
    return settle(may_hold(keyed, bitmap_of(shared, "key"), F.col("key")).groupBy("key", "probe", "line").agg(F.min("place").alias("first")), "lines")


def near_lines(lines: DataFrame, distance: int = DISTANCE, hot_lines: int = HOT_LINES) -> DataFrame:
    """Pairs of different lines within ``distance`` edits: hash and first place of both (``h1 h2 first``, ``g1 g2 other``).

    Equal lines are one from the start. A bitmap of the keys that different lines share keeps all other lines at home, so
    that only lines with a possible partner are shuffled with their text. With a distance of 1, a key of over ``hot_lines``
    different lines (a common opening, say) is not gone through in pairs: its lines meet again by what is left of them without
    one part, which no more lines share than differ in that part alone. Greater distances go through the pairs of all keys.
    """
    keyed = lines.withColumn("_k", F.explode(segment_keys(F.col("line"), F.col("size"), distance))).where("_k IS NOT NULL").select("place", "line", "h1", "_k.*")
    met = _meeting(keyed)
    once = F.col("probe") | (F.col("line") < F.col("theirs"))

    def links_of(rows: DataFrame) -> DataFrame:
        others = rows.select("key", "probe", F.col("line").alias("theirs"), F.col("first").alias("other"))
        return _linked(rows.where("NOT probe").select("key", "line", "first"), others, once, distance)

    hot = settle(met.groupBy("key").agg(F.countDistinct("line").alias("_lines")).where(F.col("_lines") > hot_lines), "hot-keys")
    if distance != 1 or hot.isEmpty():
        links = links_of(met)
    else:
        marked = spread_join(met, hot, ["key"], "left")
        crowd = settle(marked.where("_lines IS NOT NULL").groupBy("line").agg(F.min("first").alias("place")), "crowd")
        again = crowd.select("place", "line", F.xxhash64("line").alias("h1"), F.explode(remainder_keys(F.col("line"), F.length("line"))).alias("_k"))
        links = links_of(marked.where("_lines IS NULL").drop("_lines")).union(links_of(_meeting(again.select("place", "line", "h1", "_k.*"))))
    return links.select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"), "first",
        F.xxhash64("theirs").alias("g1"), F.xxhash64(F.lit(1), F.col("theirs")).alias("g2"), "other").distinct()


def repeated_lines(docs: DataFrame, distance: int = DISTANCE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The lines to take out: ``doc_id``, ``hash`` of the text, ``dropped`` (sorted line numbers).

    Lines come in order of document id (null first), hash of the text, and number. A line goes if an equal line
    comes before it, or if its first equal has a line within ``distance`` edits before it. Lines of fewer than ``least_chars`` characters (outer blanks
    aside) are too short to tell and stay. Null and empty texts have none; rows that repeat id and text
    count as one document; lines of any length are compared whole; other columns are not read. An empty table gives no rows.
    """
    lines = compared_lines(docs, least_chars)
    links = near_lines(lines, distance)
    later = links.select(F.when(F.col("first") > F.col("other"), F.struct("h1", "h2")).otherwise(F.struct(F.col("g1").alias("h1"), F.col("g2").alias("h2"))).alias("_l"))
    near = later.select("_l.*").distinct().withColumn("first", F.lit(None).cast(lines.schema["place"].dataType)).withColumn("near", F.lit(True))
    many = (
        lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first <> last").select("h1", "h2", "first", F.lit(False).alias("near"))
    )
    rules = settle(near.unionByName(many).groupBy("h1", "h2").agg(F.max("near").alias("near"), F.max("first").alias("first")), "rules")
    gone = (
        may_hold(lines.drop("line", "size"), bitmap_of(rules, "h1"), F.col("h1")).join(rules, ["h1", "h2"])
        .where(F.col("near") | (F.col("place") != F.col("first")))
    )
    return gone.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.hash").alias("hash")).agg(
        F.sort_array(F.collect_set("place.at")).alias("dropped"))


def with_dropped_lines(docs: DataFrame, **settings) -> DataFrame:
    """``_doc`` (all columns of ``docs``) and ``_dropped``: the numbers of the lines to take out, or null."""
    gone = repeated_lines(docs, **settings).withColumnsRenamed({"doc_id": "_id", "hash": "_gone", "dropped": "_dropped"})
    keyed = carried(docs, "doc_id", F.xxhash64(whole_text()).alias("_hash"))  # the text travels once, inside _doc
    return keyed.join(
        gone, (F.col("_hash") == F.col("_gone")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("_doc", "_dropped")


def kept_text(text: Column, dropped: Column) -> Column:
    lines = F.split(text, "\n")
    return F.when(dropped.isNull(), text).otherwise(
        F.array_join(F.filter(lines, lambda line, at: ~F.array_contains(dropped, at)), "\n"))


def without_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` without repeated lines; columns stay, ``n_chars`` follows. Documents of which only blanks are left go."""
    cut = with_dropped_lines(docs, **settings).withColumn("_left", kept_text(F.col("_doc.text"), F.col("_dropped")))
    left = cut.where(F.col("_dropped").isNull() | (F.length(F.trim("_left")) > 0))
    return left.select(
        F.when(F.col("_dropped").isNull(), F.col("_doc")).otherwise(changed(docs, F.col("_left"))).alias("_doc")).select("_doc.*")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: number of lines, the numbers of those taken out, and the SHA-256 of the text that is left."""
    cut = with_dropped_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "_doc.doc_id", F.size(F.split(whole_text("_doc.text"), "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.array_join(F.transform("_dropped", lambda at: at.cast("string")), ","), F.lit("")).alias("dropped"),
        F.sha2(kept_text(whole_text("_doc.text"), F.col("_dropped")), 256).alias("text_sha256"))


OP1_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT row_no, doc_id, pos, trim(line) AS line FROM (
        SELECT row_no, doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (
            SELECT row_no, doc_id, string_split(text, chr(10)) AS l FROM texts))
    WHERE length(trim(line)) >= {LEAST_CHARS}),
firsts AS (SELECT line, min((doc_id, pos)) AS fst, length(line) AS size FROM lines GROUP BY line),
near AS (
    SELECT DISTINCT b.line FROM firsts a JOIN firsts b ON b.size BETWEEN a.size - {DISTANCE} AND a.size + {DISTANCE} AND a.fst < b.fst
    AND (left(a.line, (least(a.size, b.size) // 2)::BIGINT) = left(b.line, (least(a.size, b.size) // 2)::BIGINT)
         OR right(a.line, (least(a.size, b.size) // 2)::BIGINT) = right(b.line, (least(a.size, b.size) // 2)::BIGINT))
    WHERE levenshtein(a.line, b.line) <= {DISTANCE}),
gone AS (
    SELECT row_no, string_agg(pos, ',' ORDER BY pos) AS dropped, list(pos) AS ats
    FROM lines JOIN firsts USING (line) WHERE (doc_id, pos) <> fst OR line IN (SELECT line FROM near) GROUP BY row_no)
SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, coalesce(dropped, '') AS dropped,
       sha256(CASE WHEN ats IS NULL THEN text ELSE
           coalesce(array_to_string([x FOR x, i IN string_split(text, chr(10)) IF NOT list_contains(ats, i - 1)], chr(10)), '') END) AS text_sha256
FROM texts LEFT JOIN gone USING (row_no)
"""
