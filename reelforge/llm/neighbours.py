"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing (operator 10)."""

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.rawtext import mixed
from reelforge.operators.durable import settle


class Search(NamedTuple):
    """``projections`` per table, each cut into cells of ``width``; ``probes`` buckets are visited in each table."""

    tables: int = 14
    projections: int = 10
    width: float = 2.5
    probes: int = 80
    seed: int = 11


EVERY = 20
NEAREST = 20
QUERIES_AT_ONCE = 4_096
PROBED_AT_ONCE = 128
ROWS_AT_ONCE = 16_384
HELD = 1_000_000
#: Lengths of one range differ by at most this factor, but for the last range, which has all that are shorter still.
RANGE = 1.3
RANGES = 40
#: Ranges of fewer rows than this, or than this share of all rows, are compared whole.
LEAST_HASHED = 256
LEAST_SHARE = 1 / 256
PIECES = 8


def probe_sets(projections: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of perturbed projections in order of expected cost; a projection's number is its rank by distance to a wall.

    The two walls of each projection, ``2 * projections`` in all, are ranked from near to far. The expected
    square of the distance by rank gives the order of sets (the query's own bucket first), found with a heap by
    shifting or adding the last rank. Walls ``j`` and ``2 m - 1 - j`` are those of one projection and exclude each other.
    """
    m = projections
    j = np.arange(1, 2 * m + 1)
    far = 2 * m + 1 - j
    cost = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - far / (m + 1) + far * (far + 1) / (4 * (m + 1) * (m + 2)))
    found, waiting = [()], [(cost[0], (0,))]
    while waiting and len(found) < probes:
        total, ranks = heapq.heappop(waiting)
        if len({min(r, 2 * m - 1 - r) for r in ranks}) == len(ranks):
            found.append(ranks)
        if ranks[-1] + 1 < 2 * m:
            step = cost[ranks[-1] + 1]
            heapq.heappush(waiting, (total - cost[ranks[-1]] + step, ranks[:-1] + (ranks[-1] + 1,)))
            heapq.heappush(waiting, (total + step, ranks + (ranks[-1] + 1,)))
    return found


def _planes(search: Search, table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([search.seed, table])
    return random.standard_normal((size + 1, search.projections)), random.uniform(0, search.width, search.projections)


def _bucket(cells: np.ndarray) -> np.ndarray:
    key = np.zeros(cells.shape[:-1], np.uint64)
    for i in range(cells.shape[-1]):
        key = mixed(key ^ cells[..., i].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(array.flatten(), np.float64).reshape(len(array), -1)


def _lifted(vectors: np.ndarray, longest: np.ndarray | None) -> np.ndarray:
    """On the unit sphere of one more dimension, where the nearest point is the one with the largest inner product."""
    if longest is None:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.hstack([unit, np.zeros((len(vectors), 1))])
    short = vectors / longest
    return np.hstack([short, np.sqrt(np.maximum(0, 1 - (short**2).sum(axis=1, keepdims=True)))])


def _index(search: Search, longest: dict[int, float]):
    """Each range of lengths is lifted by its own longest vector and has tables of its own."""
    def rows(batches):
        for batch in batches:
            ranges = np.asarray(batch.column("range"), np.int64)
            lifted = _lifted(_matrix(batch.column("vector")), np.array([[longest[r]] for r in ranges.tolist()]).reshape(-1, 1))
            for table in range(search.tables):
                planes, shift = _planes(search, table, lifted.shape[1] - 1)
                cells = np.floor((lifted @ planes + shift) / search.width)
                yield pa.RecordBatch.from_pydict({
                    "table": pa.array(ranges * search.tables + table, pa.int32()), "bucket": pa.array(_bucket(cells)),
                    "first": batch.column("first"), "vector": batch.column("vector")})
    return rows


def _probes(search: Search, ranges: list[int]):
    sets = probe_sets(search.projections, search.probes)

    def rows(batches):
        m = search.projections
        for batch in batches:
            lifted = _lifted(_matrix(batch.column("vector")), None)
            for table in range(search.tables):
                planes, shift = _planes(search, table, lifted.shape[1] - 1)
                place = (lifted @ planes + shift) / search.width
                cells = np.floor(place)
                low = place - cells
                ranked = np.argsort(np.hstack([low, 1 - low]), axis=1, kind="stable")
                for ranks in sets:
                    moved = cells.copy()
                    for r in ranks:
                        wall = ranked[:, r]
                        moved[np.arange(len(moved)), wall % m] += np.where(wall < m, -1, 1)
                    bucket = pa.array(_bucket(moved))
                    for at in ranges:
                        yield pa.RecordBatch.from_pydict({
                            "table": pa.array(np.full(len(lifted), at * search.tables + table), pa.int32()), "bucket": bucket,
                            "query": batch.column("first"), "vector": batch.column("vector")})
    return rows


def _best(query: np.ndarray, first: np.ndarray, score: np.ndarray, most: int):
    """Each query's ``most`` largest scores, ties to the smaller id; a candidate found twice counts once."""
    order = np.lexsort((first, -score, query))
    query, first, score = query[order], first[order], score[order]
    same = np.zeros(len(query), bool)
    same[1:] = (query[1:] == query[:-1]) & (first[1:] == first[:-1])
    query, first, score = query[~same], first[~same], score[~same]
    starts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return query[rank < most], first[rank < most], score[rank < most]


def _rerank(most: int):
    """Exact scores of blocks of queries against the blocks of the buckets they visit; the best of each task."""
    def rows(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(name) for name in ("queries", "theirs", "firsts", "ours")]
            for queries, theirs, firsts, ours in zip(*columns):
                query, first = np.asarray(queries.values), np.asarray(firsts.values)
                score = _matrix(theirs.values) @ _matrix(ours.values).T
                if len(first) > most:
                    kept = np.argpartition(-score, most - 1, axis=1)
                    edge = np.take_along_axis(score, kept[:, most - 1 : most], axis=1)
                    at, of = np.nonzero(score >= edge)
                else:
                    at, of = np.divmod(np.arange(score.size), len(first))
                held.append((query[at], first[of], score[at, of]))
                size += len(at)
                if size >= HELD:
                    held = [_best(*(np.concatenate(x) for x in zip(*held)), most)]
                    size = len(held[0][0])
                    if size >= HELD // 2:
                        yield _rows(*held[0])
                        held, size = [], 0
        if held:
            yield _rows(*_best(*(np.concatenate(x) for x in zip(*held)), most))

    def _rows(query, first, score):
        return pa.RecordBatch.from_pydict({"query": pa.array(query), "first": pa.array(first), "score": pa.array(score)})
    return rows


def nearest(vectors: DataFrame, queries: DataFrame, nearest_: int = NEAREST, search: Search = Search()) -> DataFrame:
    """The nearest found of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Both frames have ``vec_id`` and ``embedding``; queries are rows of ``vectors``, and a query's own row is no candidate.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with null ids or of another length
    than most. Of rows that repeat a ``vec_id`` the smallest vector counts. Equal vectors are one candidate that stands
    for its ``nearest_ + 1`` smallest ids, which are all that ties can name; so a vector may have any number of
    copies. Vectors are cut into ranges of length, each hashed by its own longest vector; a query probes all ranges, and ranges
    of few rows are compared whole. Every vector is indexed in each table of its range; candidates of all probed buckets are scored
    exactly, whole buckets in blocks. A query that finds too few is compared with all vectors. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    usable = (
        vectors.select("vec_id", F.col("embedding").alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    )
    sizes = usable.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("vector") == sizes["size"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    most = nearest_ + 1
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    distinct = settle(
        usable.withColumn("_at", F.row_number().over(smallest)).where(F.col("_at") <= most)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
        .withColumn("first", F.col("members")[0]), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    norms = distinct.withColumn("norm", norm)
    longest, rows = norms.agg(F.max("norm"), F.count(F.lit(1))).first()
    number = F.least(F.greatest(F.floor(F.log(F.lit(longest) / F.col("norm")) / F.log(F.lit(RANGE))), F.lit(0)), F.lit(RANGES - 1)).cast("int")
    norms = norms.withColumn("range", number)
    each = norms.groupBy("range").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n")).collect()
    hashed = {r["range"]: r["longest"] for r in each if r["n"] >= max(LEAST_HASHED, rows * LEAST_SHARE)}
    whole = [r["range"] for r in each if r["range"] not in hashed]
    asked = settle(
        usable.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
        .join(distinct.select("vector", "first"), "vector").select("vec_id", "first", "vector"), "queries")
    n_asked = asked.count()
    # each query becomes all of its probes: few rows that have to be spread over tasks before
    asked_once = asked.groupBy("first").agg(F.first("vector").alias("vector")).repartition(n_asked // PROBED_AT_ONCE + 1, "first")

    kind = vectors.schema["embedding"].dataType.simpleString()
    inside = F.col("range").isin(sorted(hashed))
    index = norms.where(inside).select("first", "vector", "range").mapInArrow(
        _index(search, hashed), f"table int, bucket long, first long, vector {kind}")
    probes = asked_once.mapInArrow(_probes(search, sorted(hashed)), f"table int, bucket long, query long, vector {kind}")
    pieces = max(PIECES, rows // ROWS_AT_ONCE)

    def pieces_of(some: DataFrame) -> DataFrame:
        return some.select(F.lit(-1).alias("table"), F.pmod(F.xxhash64(F.lit(1), "first"), F.lit(pieces)).cast("long").alias("bucket"), "first", "vector")

    def all_pieces(some: DataFrame) -> DataFrame:
        return some.select(F.lit(-1).alias("table"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))).alias("bucket"), F.col("first").alias("query"), "vector")

    salts = [max(1, n // at_once) for n, at_once in ((rows, ROWS_AT_ONCE), (n_asked, QUERIES_AT_ONCE))]

    def scores(index: DataFrame, probes: DataFrame) -> DataFrame:
        candidates = index.groupBy("table", "bucket", F.pmod(F.xxhash64("first"), F.lit(salts[0])).alias("_block")).agg(
            F.collect_list("first").alias("firsts"), F.collect_list("vector").alias("ours"))
        visits = probes.groupBy("table", "bucket", F.pmod(F.xxhash64("query"), F.lit(salts[1])).alias("_part")).agg(
            F.collect_list("query").alias("queries"), F.collect_list("vector").alias("theirs"))
        # both sides are far larger than the planner can tell from the tables that they come from: never broadcast one
        return visits.hint("merge").join(candidates, ["table", "bucket"]).select("queries", "theirs", "firsts", "ours").mapInArrow(
            _rerank(most), "query long, first long, score double")

    if whole:
        index, probes = index.unionByName(pieces_of(norms.where(~inside))), probes.unionByName(all_pieces(asked_once))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    top = settle(
        scores(index, probes).groupBy("query", "first").agg(F.max("score").alias("score"))
        .withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= most), "top")
    served = top.where(F.col("_rank") == min(most, rows)).select("query")
    poor = settle(asked_once.join(served, F.col("first") == F.col("query"), "left_anti"), "poor")
    if not poor.isEmpty():
        again = (
            scores(pieces_of(distinct), all_pieces(poor)).groupBy("query", "first").agg(F.max("score").alias("score"))
            .withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= most))
        top = top.join(served, "query", "left_semi").unionByName(again)
    lists = (
        top.join(distinct.select("first", "members"), "first").groupBy("query")
        .agg(F.flatten(F.collect_list(F.transform("members", lambda m: F.struct((-F.col("score")).alias("loss"), m.alias("vec_id"))))).alias("_all"))
        .select("query", F.slice(F.sort_array("_all"), 1, most).alias("_all"))
    )
    own = asked.select(F.col("vec_id").alias("query_id"), F.col("first").alias("query")).join(lists, "query")
    others = F.slice(F.filter("_all", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest_)
    return own.select("query_id", F.posexplode(others).alias("_at", "_hit")).select(
        "query_id", (F.col("_at") + 1).alias("rank"), F.col("_hit.vec_id").alias("vec_id"), (-F.col("_hit.loss")).alias("score"))


def op10_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of ``embeddings`` by inner product for every twentieth of them."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
