"""The nearest donors in cells: questions meet the donors of the cells that they were sent to.

A question meets every donor of its cells, hundreds or thousands each. As rows of a join, the pairs within its radius would
all be sorted to rank them, and spilled. Here the donors of a cell, in order of their keys, and then its questions are one
sorted stream; a task holds the donors of one cell and a batch of questions, and hands on k rows at most per question and cell.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIRS = 1_000_000  # compared at a time


def answers(reach: DataFrame, placed: DataFrame, names: list[str], k: int, distances: Callable, values: Callable) -> DataFrame:
    """``question, answer``: the mean value of the k nearest donors, those of the smaller key if they are equally near.

    ``reach`` has a row per question and cell: ``question, cell, radius, aside`` and ``q_<name>`` columns; ``placed`` has
    ``donor, cell, value`` and the columns ``names``. ``distances(questions, aside, donors)`` gives a matrix, infinite where
    a donor does not count; ``values(aside, value, donors, who, which)`` what the donors ``which`` lend to the questions ``who``.
    """
    key = placed.schema["donor"].dataType
    held = placed.select("cell", F.lit(None).cast("long").alias("question"), "donor", F.col("value").alias("number"), F.lit(0.0).alias("aside"), *names)
    asked = reach.select(
        "cell", "question", F.lit(None).cast(key).alias("donor"), F.col("radius").alias("number"), F.col("aside").cast("double").alias("aside"),
        *[F.col(f"q_{x}").alias(x) for x in names])
    parts = int(reach.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = held.unionByName(asked).repartition(parts, "cell").sortWithinPartitions("cell", F.asc_nulls_first("question"), "donor")
    near = stream.mapInArrow(_nearest(names, k, distances, values), f"question long, donor {key.simpleString()}, value double, distance double")
    ranked = Window.partitionBy("question").orderBy("distance", "donor")
    return near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).groupBy("question").agg(F.avg("value").alias("answer"))


def _nearest(names: list[str], k: int, distances: Callable, values: Callable):
    """Function over the sorted stream: up to k donors of its cell for each question, within its radius."""
    pairs = PAIRS

    # local, so that they travel to the workers by value
    def numbers(part, name):
        return part.column(name).to_numpy(zero_copy_only=False)

    def points(part):
        return np.column_stack([numbers(part, x) for x in names])

    def best(distance, radius):
        """Row and column numbers of the k smallest of each row within its radius, equal ones in order of the columns."""
        limit = radius
        if distance.shape[1] > k:
            limit = np.minimum(radius, np.partition(distance, k - 1, axis=1)[:, k - 1])
        who, which = np.nonzero((distance <= limit[:, None]) & (distance < np.inf))
        order = np.lexsort((distance[who, which], who))  # stable
        who, which = who[order], which[order]
        first = np.r_[True, who[1:] != who[:-1]] if len(who) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        rank = np.arange(len(who)) - np.repeat(starts, np.diff(np.r_[starts, len(who)]))
        return who[rank < k], which[rank < k]

    def compared(part, keys, value, donors):
        asked, aside, radius = points(part), numbers(part, "aside"), numbers(part, "number")
        question = numbers(part, "question")
        step = max(1, pairs // len(donors))
        for start in range(0, len(asked), step):
            some = slice(start, start + step)
            distance = distances(asked[some], aside[some], donors)
            who, which = best(distance, radius[some])
            if len(who):
                yield pa.RecordBatch.from_arrays([
                    pa.array(question[some][who], pa.int64()), keys.take(pa.array(which)),
                    pa.array(values(aside[some], value, donors, who, which), pa.float64()), pa.array(distance[who, which], pa.float64()),
                ], names=["question", "donor", "value", "distance"])

    def nearest(batches):
        cell, waiting, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = numbers(batch, "cell")
            asks = batch.column("question").is_valid().to_numpy(zero_copy_only=False)
            borders = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip(np.r_[0, borders], np.r_[borders, len(cells)]):
                part = batch.slice(start, end - start)
                if cells[start] != cell:
                    cell, waiting, held = cells[start], [], None
                if not asks[start]:
                    waiting.append(part)
                    continue
                if held is None:
                    table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    held, waiting = (table.column("donor"), numbers(table, "number"), points(table)), []
                yield from compared(part, *held)

    return nearest
