"""Secrets in texts: a trigram inverted index picks candidates, regular expressions verify them (operator 3).

DataFrame functions only.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.frames import documents, whole_text
from reelforge.llm.patterns import spans, trigram_query
from reelforge.operators.durable import settle


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules. A run of 18 or more AKIA letters, or of 16 or more hex digits, is the whole run.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Public forms of further secrets.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", whole_text().alias("text")).withColumn("_text", F.xxhash64("text"))


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The trigrams that the rules' queries name, in order."""
    return sorted({t for rule in rules for clause in trigram_query(rule.pattern) or () for t in clause})


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings of the trigrams over lower-cased whole texts: ``trigram`` number, ``doc_id``, ``_text`` (a hash of the text)."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return _keyed(docs).select("doc_id", "_text", F.explode(found).alias("trigram"))


def _words_of(clause: frozenset[str], trigrams: list[str]) -> dict[int, int]:
    words: dict[int, int] = {}
    for t in clause:
        at = trigrams.index(t)
        words[at // 63] = words.get(at // 63, 0) | 1 << at % 63
    return words


def candidates(index: DataFrame, rules: tuple[Rule, ...], trigrams: list[str]) -> DataFrame:
    """Documents whose postings meet the query of a rule: ``doc_id``, ``_text`` and the ``kinds`` that may match.

    The postings of a document meet as bits of words, first within a task and then across.
    """
    sets = [
        F.bit_or(F.when(F.floor(F.col("trigram") / 63) == w, F.expr("shiftleft(1L, cast(trigram % 63 as int))")).otherwise(F.lit(0))).alias(f"_w{w}")
        for w in range(-(-len(trigrams) // 63))
    ]
    held = index.groupBy("doc_id", "_text").agg(*sets)

    def met(clause: frozenset[str]) -> Column:
        tests = [F.col(f"_w{w}").bitwiseAND(F.lit(bits)) == bits for w, bits in _words_of(clause, trigrams).items()]
        return tests[0] if len(tests) == 1 else F.forall(F.array(*tests), lambda t: t)

    def meets(rule: Rule) -> Column:
        return F.exists(F.array(*[met(clause) for clause in trigram_query(rule.pattern)]), lambda t: t)

    kinds = F.array_compact(F.array(*[F.when(meets(rule), F.lit(rule.kind)) for rule in rules]))
    return held.select("doc_id", "_text", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, ``_text`` and ``found``: the spans ``(start, end, kind)`` of all rules, per document, unordered.

    Null text is the empty text. Rules that name mandatory trigrams read only the candidates that the index gives; the
    others read every text. Texts of any length are matched whole. Spans of one kind never overlap: the leftmost counts; spans of
    different kinds may, and each is kept. Rows that repeat ``doc_id`` and text get the same spans; other columns are not read; an
    empty table gives no rows.
    """
    indexed = tuple(rule for rule in rules if trigram_query(rule.pattern) is not None)
    scanned = tuple(rule for rule in rules if rule not in indexed)
    nothing = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def matches(rule: Rule) -> Column:
        return F.when(F.col("text").rlike(rule.pattern), spans(F.col("text"), rule.pattern, rule.kind, rule.group, rule.least)).otherwise(nothing)

    everywhere = _keyed(docs).select("doc_id", "_text", F.concat(nothing, *[matches(rule) for rule in scanned]).alias("_all"))
    if not indexed:
        return everywhere.withColumnRenamed("_all", "found")
    trigrams = vocabulary(indexed)
    chosen = settle(candidates(trigram_index(docs, trigrams), indexed, trigrams), "candidates")
    named = chosen.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "kinds")
    verified = (
        may_hold(_keyed(docs), bitmap_of(chosen, "_text"), F.col("_text"))
        .dropDuplicates(["doc_id", "_text"])
        .join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
        .select("_id", "_hash", F.concat(*[
            F.when(F.array_contains("kinds", rule.kind), matches(rule)).otherwise(nothing) for rule in indexed
        ]).alias("_some"))
        .where(F.size("_some") > 0)
    )
    return everywhere.join(
        verified, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left"
    ).select("doc_id", "_text", F.when(F.col("_some").isNull(), F.col("_all")).otherwise(F.concat("_all", "_some")).alias("found"))


def _of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)


def _joined(found: Column, kinds: list[str]) -> Column:
    placed = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(placed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Numbers and spans of secrets in every text of ``documents``."""
    found = find_secrets(documents(spark, sf_dir))
    base, every = [r.kind for r in BASE], [r.kind for r in RULES]
    ours = F.filter("found", lambda s: s["kind"].isin(*base))
    counts = [F.size(_of_kind(F.col("found"), k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(ours, base), 256).alias("base_sha256"), _joined(F.col("found"), every).alias("spans"))


def _sql_spans(rule: Rule) -> str:
    """DuckDB: one row per match, its place from the lengths of matches and gaps before it."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT row_no, '{rule.kind}' AS kind, {RULES.index(rule)} AS n, k,
           list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0) AS s,
           length(hits[k]) AS size
    FROM (SELECT row_no, hits, sizes, gaps, unnest(range(1, len(hits) + 1)) AS k FROM (
        SELECT row_no, regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_extract_all(text, '{pattern}', {rule.group}) AS sizes,
               string_split_regex(text, '{pattern}') AS gaps FROM texts WHERE regexp_matches(text, '{pattern}')))
    WHERE length(sizes[k]) >= {rule.least}"""


OP3_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_sql_spans(rule) for rule in RULES)}),
named AS (SELECT *, kind || ':' || s || ':' || (s + size) AS span FROM found),
grouped AS (
    SELECT row_no, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
           string_agg(span, ',' ORDER BY s, n) FILTER (n < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY s, n) AS spans
    FROM named GROUP BY row_no)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN grouped USING (row_no)
"""
