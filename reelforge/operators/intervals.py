"""Joins on spans: points in spans, and spans that overlap, as equi-joins on bins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.operators.durable import broadcast_if_small, settle
from reelforge.operators.joins import HOT_ROWS, spread_many

LEVELS = 63
FEW_ROWS = 64  # spans of a key on a side that meet each other without bins


def _level(start: Column, end: Column) -> Column:
    """The least level whose bins (2^level long) are at least as long as the span: it lies in one bin or two neighbouring ones."""
    length = (end - start + 1).cast("double")
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), F.ceil(F.log2(length)))).cast("int")


def _shifted(value: Column, level: str) -> Column:
    """The number of the bin that holds a value."""
    return F.call_function("shiftright", value.cast("long"), F.col(level))


def _in_bins(rows: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each bin of its ``_level`` that a span touches."""
    return rows.withColumn("_bin", F.explode(F.sequence(_shifted(F.col(start), "_level"), _shifted(F.col(end), "_level"))))


def points_in_spans(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, by: list[str] | None = None,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs of a point and a span that holds it, ends included: the columns of both.

    Points and ends are whole numbers (days, seconds). ``by`` are columns of equal names on both sides that have to agree. Each span goes to one or
    two bins of the level that fits its length, so a long span costs no more than a short one; each point looks
    into its bin of every level that some span has, at most 63. A bin with very many points or spans is cut into a
    grid of tasks. Spans that end before they start hold nothing; rows with nulls meet nothing.
    """
    by = by or []
    held = spans.where(F.col(start) <= F.col(end)).dropna(subset=by)
    held = held.withColumn("_level", _level(F.col(start).cast("long"), F.col(end).cast("long")))
    levels = [row[0] for row in held.select("_level").distinct().collect()]  # at most 63
    looking = points.where(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(level) for level in sorted(levels) or [0]])))
    looking = looking.withColumn("_bin", _shifted(F.col(at), "_level"))
    met = spread_many(looking, _in_bins(held, start, end), [*by, "_level", "_bin"], hot_rows)
    columns = [*points.columns, *[name for name in spans.columns if name not in by]]
    return met.where(F.col(at).between(F.col(start), F.col(end))).select(*columns)


def overlapping_spans(left: DataFrame, right: DataFrame, start: str, end: str, by: list[str] | None = None,
                      suffix: str = "_right", hot_rows: int = HOT_ROWS, few_rows: int = FEW_ROWS) -> DataFrame:
    """Pairs of spans that share a point, ends included: the columns of ``left`` and those of ``right`` with ``suffix`` (but ``by``).

    Keys of ``by`` that have at most ``few_rows`` spans on either side are joined as they are: each span is moved once, and meets
    few others. The spans of all other keys meet in bins. Every span has a home: its one or two bins at the level that fits it. The longer span of a pair is met in its home by the
    shorter one, which looks into its own one or two bins of that level; the shorter span's home is not looked at. Two spans
    that meet in two bins are told apart by the bin that holds the later of their starts, so that each pair comes once.
    """
    by = by or []
    s, e = f"{start}{suffix}", f"{end}{suffix}"
    ours = settle(left.where(F.col(start) <= F.col(end)).dropna(subset=by), "spans")
    theirs = ours if right is left else settle(right.where(F.col(start) <= F.col(end)).dropna(subset=by), "spans")
    crowded = [rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > few_rows).select(*by)
               for rows in ([ours] if right is left else [ours, theirs])] if by else []
    theirs = theirs.select(*by, *[F.col(f"`{name}`").alias(f"{name}{suffix}") for name in right.columns if name not in by])
    meet = (F.col(start) <= F.col(e)) & (F.col(s) <= F.col(end))
    columns = [*left.columns, *[name for name in theirs.columns if name not in by]]
    if not by:
        return _met_in_bins(ours, theirs, (start, end, s, e), by, hot_rows).where(meet).select(*columns)
    crowded = settle(crowded[0] if len(crowded) == 1 else crowded[0].union(crowded[1]).distinct(), "crowded")
    if crowded.isEmpty():
        return _met_by_key(ours, theirs, by).where(meet).select(*columns)
    keys = broadcast_if_small(crowded)
    few = _met_by_key(*(rows.join(keys, by, "left_anti") for rows in (ours, theirs)), by)
    many = _met_in_bins(*(rows.join(keys, by, "left_semi") for rows in (ours, theirs)), (start, end, s, e), by, hot_rows)
    return few.where(meet).select(*columns).unionByName(many.where(meet).select(*columns))


def _met_by_key(ours: DataFrame, theirs: DataFrame, by: list[str]) -> DataFrame:
    """Rows of equal keys side by side; merged unless a side is small, whatever the size of its file."""
    small = broadcast_if_small(theirs)
    return ours.join(small if small is not theirs else theirs.hint("merge"), by)


def _met_in_bins(ours: DataFrame, theirs: DataFrame, ends: tuple[str, str, str, str], by: list[str], hot_rows: int) -> DataFrame:
    """Pairs of spans that touch a common bin of the level of the longer one, in the bin of the later start only."""
    start, end, s, e = ends
    columns = [*ours.columns, *[name for name in theirs.columns if name not in by]]
    ours = settle(ours.withColumn("_own", _level(F.col(start).cast("long"), F.col(end).cast("long"))), "spans")
    theirs = settle(theirs.withColumn("_theirs", _level(F.col(s).cast("long"), F.col(e).cast("long"))), "spans")

    def looking(rows: DataFrame, level: str, levels: list[int], strictly: bool) -> DataFrame:
        every = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
        return rows.withColumn("_level", F.explode(F.filter(every, lambda x: x > F.col(level) if strictly else x >= F.col(level))))

    own_levels = sorted(row[0] for row in ours.select("_own").distinct().collect())  # at most 63 each
    their_levels = sorted(row[0] for row in theirs.select("_theirs").distinct().collect())
    keys = [*by, "_level", "_bin"]
    home, their_home = (_in_bins(rows.withColumn("_level", F.col(level)), low, high) for rows, level, low, high in (
        (ours, "_own", start, end), (theirs, "_theirs", s, e)))
    longer = spread_many(_in_bins(looking(theirs, "_theirs", own_levels, False), s, e), home, keys, hot_rows)
    shorter = spread_many(_in_bins(looking(ours, "_own", their_levels, True), start, end), their_home, keys, hot_rows)
    both = longer.select(*columns, "_level", "_bin").unionByName(shorter.select(*columns, "_level", "_bin"))
    return both.where(_shifted(F.greatest(F.col(start), F.col(s)), "_level") == F.col("_bin"))
