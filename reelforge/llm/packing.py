"""Documents packed into sequences of a fixed length, best fit in bulk rounds (operator 4)."""

import zlib
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.frames import documents, whole_text
from reelforge.llm.tokens import END_ID, VOCABULARY, tokenizer, with_end
from reelforge.operators.durable import settle

CAPACITY = 4096
RANKED_AT_ONCE = 200_000


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of ``capacity`` where it has more.

    One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``. No shuffle.
    """
    def cut(batches):
        for batch in batches:
            ids, limits = with_end(*tokenizer(vocabulary).encode(batch.column("text")), end_id)
            sizes = np.diff(limits)
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            low = limits[row] + start
            data = memoryview(ids.astype("<u4").view(np.uint8))
            crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(low.tolist(), length.tolist())]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                limits_of = pa.array(np.append(low, len(ids)).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(limits_of, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, schema)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` pieces of each length; returns runs ``(length, first_rank, last_rank, sequence, offset)``.

    Rank ``r`` of a run goes to sequence ``sequence + r - first_rank``. Pieces of equal length, and gaps of equal
    size, are interchangeable, so the range-sorted pieces and gaps are held as runs: at most ``capacity`` sizes each,
    however many documents there are. A round is one sweep over both in order of size: the largest pieces first take
    the smallest gap that holds them (their successor); pieces that want the same gaps get them by rank, the rest
    go on to the next larger gap; each gap takes one piece a round and its rest is a gap of the next round. When no
    piece finds a gap, new sequences are opened for the largest pieces: as many as the tokens left need at least, and one
    for each piece of over half the capacity.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[list[int]]] = {}
    runs, opened = [], 0

    def take(intervals: list[list[int]], n: int):
        while n:
            first, size = intervals[-1]
            used = min(n, size)
            yield first, used
            n -= used
            if used == size:
                intervals.pop()
            else:
                intervals[-1] = [first + used, size - used]

    def place(length: int, first: int, n: int, offset: int) -> None:
        runs.append((length, rank[length], rank[length] + n - 1, first, offset))
        rank[length] += n
        left[length] -= n

    while left:
        tokens = sum(length * n for length, n in left.items())
        forced = sum(n for length, n in left.items() if 2 * length > capacity)
        to_open = max(forced, -(-tokens // capacity))
        for length in sorted(left, reverse=True):
            n = min(to_open, left[length])
            if n:
                place(length, opened, n, 0)
                if length < capacity:
                    gaps.setdefault(capacity - length, []).append([opened, n])
                opened += n
                to_open -= n
        while True:
            sizes, after = sorted(gaps), defaultdict(list)
            for length in sorted((x for x in left if left[x]), reverse=True):
                at = bisect_left(sizes, length)  # the successor
                while left[length] and at < len(sizes):
                    size = sizes[at]
                    n = min(left[length], sum(many for _, many in gaps[size]))
                    for first, many in take(gaps[size], n):
                        place(length, first, many, capacity - size)
                        after[size - length].append([first, many])
                    if not gaps[size]:
                        del gaps[size], sizes[at]
            after.pop(0, None)
            for size, intervals in after.items():
                gaps.setdefault(size, []).extend(intervals)
            if not after and not any(at >= x for at in gaps for x in left if left[x]):
                break
        left = {length: n for length, n in left.items() if n}
    return runs


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Where each piece of each document goes: ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Only documents of more than ``capacity`` ids are cut. Pieces are numbered among those of equal length without
    bringing a length to one task (a salt cuts large ones into runs), and joined to the runs of ``best_fit`` by
    length and rank; the runs are few because they follow sizes, not documents, and are broadcast. Null text is the empty text: a
    piece of one id. Rows that repeat a ``doc_id`` are packed each for itself; an empty table gives no rows.
    """
    pieces = settle(token_pieces(docs, capacity, vocabulary, end_id, with_ids), "pieces")
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = best_fit(counts, capacity)
    salts = max(1, -(-max(counts.values(), default=0) // RANKED_AT_ONCE))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(inside) - 1)
    if salts > 1:
        earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
        before = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).select(
            "length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        ranked = ranked.join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    table = pd.DataFrame(runs, columns=["_length", "_from", "_to", "_sequence", "offset"], dtype="int64")
    placed = docs.sparkSession.createDataFrame(
        table, "_length long, _from long, _to long, _sequence long, offset long")
    return ranked.join(
        F.broadcast(placed),
        (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_from"), F.col("_to")),
    ).select(*pieces.columns, (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Where each piece of each of ``documents`` goes in sequences of 4,096 tokens."""
    packed = pack(documents(spark, sf_dir))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
