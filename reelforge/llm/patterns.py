"""Boolean trigram queries of regular expressions, and spans of their matches, as columns."""

from re import _constants as parts
from re import _parser as parser

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_STRINGS = 64

#: Clauses in disjunction; a clause is a set of trigrams that must all occur. ``None`` says nothing: scan fully.
Query = frozenset[frozenset[str]] | None


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> Query:
    """What lower-cased text must hold to match ``pattern``: clauses of mandatory trigrams, or ``None``."""
    texts, query = _walk(parser.parse(pattern))
    return _least(_both(query, _any_of(texts)))


def _any_of(texts: set[str] | None) -> Query:
    if texts is None or not all(len(text) > 2 for text in texts):
        return None
    return frozenset(trigrams(text) for text in texts)


def _both(left: Query, right: Query) -> Query:
    if left is None or right is None:
        return right if left is None else left
    return _least(frozenset(a | b for a in left for b in right))


def _least(query: Query) -> Query:
    return query and frozenset(c for c in query if not any(other < c for other in query))


def _walk(tree) -> tuple[set[str] | None, Query]:
    """All texts a part can match, if they are few; else what is mandatory in it."""
    texts, query, whole = {""}, None, True
    for op, value in tree:
        some, must = _one(op, value)
        joined = None if some is None or texts is None else {a + b for a in texts for b in some}
        if joined is None or len(joined) > MOST_STRINGS:
            query, whole = _both(query, _any_of(texts)), False
            joined = some
        texts, query = joined, _both(query, must)
    return (texts, query) if whole else (None, _both(query, _any_of(texts)))


def _one(op, value) -> tuple[set[str] | None, Query]:
    if op is parts.LITERAL:
        return {chr(value).lower()}, None
    if op is parts.IN:
        letters = set()
        for kind, held in value:
            if kind is parts.LITERAL:
                letters.add(chr(held).lower())
            elif kind is parts.RANGE and held[1] - held[0] < 8:
                letters |= {chr(c).lower() for c in range(held[0], held[1] + 1)}
            else:
                return None, None
        return (letters, None) if len(letters) <= 8 else (None, None)
    if op is parts.SUBPATTERN:
        return _walk(value[3])
    if op is parts.BRANCH:
        branches = [_walk(branch) for branch in value[1]]
        if all(texts is not None for texts, _ in branches):
            return set().union(*(texts for texts, _ in branches)), None
        queries = [_both(query, _any_of(texts)) for texts, query in branches]
        return None, None if None in queries else frozenset().union(*queries)
    if op in (parts.MAX_REPEAT, parts.MIN_REPEAT, parts.POSSESSIVE_REPEAT):
        least, most, body = value
        texts, query = _walk(body)
        if (least, most) == (0, 1) and texts is not None:
            return texts | {""}, None
        if least == most and texts is not None and len(texts) ** least <= MOST_STRINGS:
            whole = {""}
            for _ in range(least):
                whole = {a + b for a in whole for b in texts}
            return whole, None
        return None, _both(query, _any_of(texts)) if least else None
    return None, None


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of ``(start, end, kind)``, code points, end exclusive.

    Matches whose ``group`` has fewer than ``least`` characters are dropped after matching. Places follow from the lengths
    of the matches and of the text between them.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.split(text, pattern, -1)
    return _spans(hits, sizes, gaps, kind, least)


def _spans(hits: Column, sizes: Column, gaps: Column, kind: str, least: int) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:string,size:int>>").alias("found"))
    rows = F.arrays_zip(F.transform(hits, F.length).alias("n"), F.transform(sizes, F.length).alias("size"), F.transform(gaps, F.length).alias("gap"))

    def step(state: Column, row: Column) -> Column:
        low = state["at"] + row["gap"]
        high = low + F.coalesce(row["n"], F.lit(0))
        one = F.struct(low.alias("start"), high.alias("end"), F.lit(kind).alias("kind"), row["size"].alias("size"))
        found = F.when(row["size"] >= least, F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(high.alias("at"), found.alias("found"))

    matched = F.aggregate(rows, start, step, lambda state: state["found"])
    return F.transform(matched, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
