"""The k nearest rows for any number of columns and of patterns of missing ones.

``knn`` projects the donors on each pattern of present columns, which is best for few patterns. Here each donor stays one
row, whatever the patterns:

* Donors with the same columns present form a *family* if they fill a cell; the others share one family, whose tree is
  split by what is present as well as by values. Cells, about ``CELL_ROWS`` donors each, keep a bounding box per column,
  which columns all of their donors have, and which any of them has.
* Above the cells stand levels of nodes that hold ``FAN`` neighbours each. Questions that miss the same columns are cut into
  blocks of neighbours, and a block goes down from the top: at each level the nodes that surely hold k donors give a
  radius, and only nodes that may hold something within it are opened.
* The least distance to a node counts the columns that all its donors share with the question, divided by the most columns
  that any can share; the most distance is exact where all share the same, and else that of the worst column.
"""

from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.operators import knn_cells
from reelforge.operators.durable import settle

CELL_ROWS = 64
SAMPLE_PER_CELL = 10
MAX_CELLS = 200_000
MAX_NUMBERS = 5_000_000  # in all boxes together: what each task is given
FAN = 16
BLOCK = 256
MIXED = "mixed"


def estimates(rows: DataFrame, asked: DataFrame, names: list[str], k: int, split) -> DataFrame | None:
    """``key, near_0, near_1, ...`` for the rows of ``asked``: per missing column the mean over the k nearest rows that have it.

    ``rows`` has ``key`` and the columns ``names``; ``asked`` is a part of it. ``split`` cuts points into a tree. None if nothing is asked.
    """
    width = len(names)
    mask = F.concat(*[F.when(F.col(x).isNull(), "0").otherwise("1") for x in names])
    asked = asked.select("key", *names, mask.alias("mask")).where(F.col("mask").contains("0") & F.col("mask").contains("1"))
    if asked.isEmpty():
        return None
    zeros = [F.coalesce(x, F.lit(0.0)).alias(f"z_{x}") for x in names]
    targets = F.filter(F.array(*[F.when(F.col(x).isNull(), F.lit(i)) for i, x in enumerate(names)]), lambda t: t.isNotNull())
    wanted = asked.select("key", "mask", *names, *zeros, F.explode(targets).alias("target"))
    identity = ["mask", "target", *[f"z_{x}" for x in names]]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    questions = settle(
        wanted.select(*identity, *names).dropDuplicates(identity).repartition(parts, *identity).sortWithinPartitions(*identity)
        .withColumn("question", F.monotonically_increasing_id()), "questions")

    same = Window.partitionBy("mask", *names).orderBy("donor")
    offered = rows.select(F.col("key").alias("donor"), *names, mask.alias("mask")).where(F.col("mask").contains("1"))
    donors = settle(offered.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") <= k).drop("_rank"), "donors")
    total = donors.count()
    most = max(1, min(MAX_CELLS, MAX_NUMBERS // (4 * width)))
    cell_rows = max(CELL_ROWS, ceil(total / min(most, sqrt(10 * total))))
    counts = donors.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cell_rows)
    families = sorted(row["mask"] for row in counts.collect())  # at most total / cell_rows
    trees = _trees(donors, families, names, cell_rows, total, split)
    placed = donors.withColumn("cell", _cell_column(trees, width)("mask", *names))
    boxes = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *[f(x).alias(f"{label}_{x}") for label, f in (("lo", F.min), ("hi", F.max), ("has", F.count)) for x in names]
    ).orderBy("cell").toPandas()  # at most as many cells as the trees have leaves

    reach = questions.drop("mask", *[f"z_{x}" for x in names]).mapInPandas(
        _cells_in_reach(_levels(boxes, names), names, k), ", ".join(["question long", "cell long", "radius double", "target int", *[f"q_{x} double" for x in names]]))
    answers = knn_cells.answers(
        reach.withColumn("aside", F.col("target")), placed.withColumn("value", F.lit(None).cast("double")), names, k, *_comparison(width))
    answered = questions.hint("merge").join(answers, "question").select(*identity, "answer")
    return wanted.hint("merge").join(answered, identity).groupBy("key").agg(*[
        F.max(F.when(F.col("target") == i, F.col("answer"))).alias(f"near_{i}") for i in range(width)])


def _comparison(width: int):
    """Distances over the columns that questions and donors share, infinite without any or without the target, and the donors' values."""

    # local, so that they travel to the workers by value
    def distances(questions, aside, donors):
        squares, shared = np.zeros((len(questions), len(donors))), np.zeros((len(questions), len(donors)))
        for i in range(width):
            gap = questions[:, i, None] - donors[None, :, i]
            both = ~np.isnan(gap)
            squares += np.where(both, gap * gap, 0.0)
            shared += both
        counts = (shared > 0) & ~np.isnan(donors[:, aside.astype(int)].T)
        return np.where(counts, width / np.maximum(shared, 1) * squares, np.inf)

    def values(aside, value, donors, who, which):
        return donors[which, aside.astype(int)[who]]

    return distances, values


def _trees(donors: DataFrame, families: list[str], names: list[str], cell_rows: int, total: int, split) -> dict[str, tuple]:
    """A tree per family from a sample of about ``SAMPLE_PER_CELL`` donors per cell; it places borders and nothing else."""
    fraction = min(1.0, SAMPLE_PER_CELL / cell_rows)
    sampled = donors.select("mask", *names)
    points = (sampled.sample(fraction, seed=1) if fraction < 1.0 else sampled).toPandas()
    family = np.where(points["mask"].isin(families), points["mask"], MIXED)
    leaf, trees, first = max(1, round(cell_rows * fraction)), {}, 0
    for name in [*families, MIXED]:
        inside = points[family == name]
        trees[name] = (first, *split(_features(inside["mask"], inside[names].to_numpy(dtype=float), name), leaf))
        first += len(trees[name][1])
    return trees


def _features(masks: pd.Series, points: np.ndarray, family: str) -> np.ndarray:
    """What a family's tree is split by: values, missing ones as 0, and for mixed donors also what is present, at twice its weight."""
    filled = np.nan_to_num(points)
    if family != MIXED or not len(points):
        return filled if family != MIXED else np.zeros((0, 2 * points.shape[1]))
    present = np.frombuffer("".join(masks).encode(), np.uint8).reshape(len(points), -1) - 48.0
    scale = 2 * np.max(np.ptp(filled, axis=0), initial=1.0)
    return np.hstack([filled, present * scale])


def _cell_column(trees: dict[str, tuple], width: int):
    def find(mask: pd.Series, *coordinates: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in coordinates])
        family = np.where(mask.isin(list(trees)), mask, MIXED)
        cells = np.zeros(len(points), np.int64)
        for name in np.unique(family):
            at = np.flatnonzero(family == name)
            first, column, cut, left, right = trees[name]
            features = _descended(mask.iloc[at], points[at], name, column, width)
            node = np.zeros(len(at), np.int64)
            while True:
                inner = np.flatnonzero(column[node] >= 0)
                if not len(inner):
                    break
                here = node[inner]
                node[inner] = np.where(features(inner, column[here]) <= cut[here], left[here], right[here])
            cells[at] = first + node
        return pd.Series(cells)

    return F.pandas_udf(find, "long")


def _descended(masks: pd.Series, points: np.ndarray, family: str, column: np.ndarray, width: int):
    """Function from row and column numbers to what the tree compares; presence has any positive value, since its cuts are at 0."""
    filled = np.nan_to_num(points)
    if family != MIXED:
        return lambda rows, columns: filled[rows, columns]
    present = np.frombuffer("".join(masks).encode(), np.uint8).reshape(len(points), -1) - 48.0
    every = np.hstack([filled, present * np.finfo(float).max])
    return lambda rows, columns: every[rows, columns]


def _levels(boxes: pd.DataFrame, names: list[str]) -> list[tuple]:
    """From the cells up: (cell numbers or None, donors, low, high, all have, any has); each node holds ``FAN`` of the level below."""
    n, lo, hi = boxes["n"].to_numpy(), boxes[[f"lo_{x}" for x in names]].to_numpy(dtype=float), boxes[[f"hi_{x}" for x in names]].to_numpy(dtype=float)
    counts = boxes[[f"has_{x}" for x in names]].to_numpy()
    every, some = counts == n[:, None], counts > 0
    lo, hi = np.where(some, lo, np.inf), np.where(some, hi, -np.inf)
    centres = np.hstack([np.where(some, lo / 2, 0.0) + np.where(some, hi / 2, 0.0), every * 2.0 * np.max(np.abs(np.where(some, hi, 0.0)), initial=1.0)]) if len(n) else np.zeros((0, 1))
    order, waiting = [], [np.arange(len(n))]
    while waiting:  # neighbours side by side
        at = waiting.pop()
        if len(at) <= FAN:
            order.append(at)
            continue
        inside = centres[at]
        ranked = at[np.argsort(inside[:, np.argmax(np.ptp(inside, axis=0))], kind="stable")]
        half = -(-len(at) // (2 * FAN)) * FAN
        waiting += [ranked[half:], ranked[:half]]
    order = np.concatenate(order) if order else np.zeros(0, int)
    levels = [(boxes["cell"].to_numpy()[order], n[order], lo[order], hi[order], every[order], some[order])]
    while len(levels[-1][1]) > FAN:
        _, n, lo, hi, every, some = levels[-1]
        at = np.arange(0, len(n), FAN)
        levels.append((None, np.add.reduceat(n, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                       np.logical_and.reduceat(every, at), np.logical_or.reduceat(some, at)))
    return levels


def _cells_in_reach(levels: list[tuple], names: list[str], k: int):
    """Function over batches of questions: the cells that each has to be compared with, and its radius."""
    width = len(names)

    # local, so that they travel to the workers by value
    def bounds(low, high, nodes, present, target):
        """Least and most distance between boxes of questions and nodes, and which nodes can count and how many donors surely do."""
        n, lo, hi, every, some = nodes
        surely, maybe = every & present, some & present
        n_all, n_any = surely.sum(axis=1), maybe.sum(axis=1)
        possible = some[:, target] & (n_any > 0)
        certain = np.where(every[:, target] & (n_all > 0), n, 0)
        least, most, worst = (np.zeros((len(low), len(n))) for _ in range(3))
        for i in np.flatnonzero(present):
            with np.errstate(invalid="ignore"):
                near = np.maximum(np.maximum(lo[None, :, i] - high[:, None, i], low[:, None, i] - hi[None, :, i]), 0.0) ** 2
                far = np.maximum(np.abs(lo[None, :, i] - high[:, None, i]), np.abs(hi[None, :, i] - low[:, None, i])) ** 2
            least += np.where(surely[:, i], near, 0.0)
            counted = np.where(maybe[:, i], far, 0.0)
            most += counted
            np.maximum(worst, counted, out=worst)
        exact = n_all == n_any
        weight = width / np.maximum(n_any, 1)
        return least * weight, np.where(exact, most * weight, width * worst), possible, certain

    def radii(most, certain):
        order = np.argsort(most, axis=1)
        enough = np.cumsum(certain[order], axis=1) >= k
        line = np.arange(len(most))
        radius = np.where(enough.any(axis=1), most[line, order[line, np.argmax(enough, axis=1)]], np.inf)
        return radius * (1 + 1e-9) + 1e-12

    def blocks(points):
        waiting = [np.arange(len(points))]
        while waiting:
            at = waiting.pop()
            if len(at) <= BLOCK:
                yield at
                continue
            inside = points[at]
            order = at[np.argsort(inside[:, np.argmax(np.ptp(inside, axis=0))], kind="stable")]
            waiting += [order[: len(at) // 2], order[len(at) // 2 :]]

    def surviving(low, high, present, target):
        """Cells that a question within the box may need, by going down from the top."""
        open_nodes = np.arange(len(levels[-1][1]))
        for depth in range(len(levels) - 1, -1, -1):
            nodes = tuple(part[open_nodes] for part in levels[depth][1:])
            least, most, possible, certain = bounds(low[None], high[None], nodes, present, target)
            open_nodes = open_nodes[possible & (least[0] <= radii(most, certain)[0])]
            if depth:
                below = (open_nodes[:, None] * FAN + np.arange(FAN)).ravel()
                open_nodes = below[below < len(levels[depth - 1][1])]
        return open_nodes

    def reach(batches):
        for batch in batches:
            points = batch[names].to_numpy(dtype=float)
            masks = [row.tobytes().decode() for row in (49 - np.isnan(points)).astype(np.uint8)]
            for at in pd.Series(range(len(points))).groupby([masks, batch["target"].to_numpy()]).indices.values():
                present, target = ~np.isnan(points[at[0]]), int(batch["target"].iloc[at[0]])
                filled = np.nan_to_num(points[at])
                for rows in blocks(filled):
                    asked = filled[rows]
                    inside = surviving(asked.min(axis=0), asked.max(axis=0), present, target)
                    if not len(inside):
                        continue
                    nodes, cells = tuple(part[inside] for part in levels[0][1:]), levels[0][0][inside]
                    step = max(1, 1_000_000 // len(inside))
                    for start in range(0, len(rows), step):
                        part = asked[start : start + step]
                        least, most, possible, certain = bounds(part, part, nodes, present, target)
                        radius = radii(most, certain)
                        who, which = np.nonzero(possible & (least <= radius[:, None]))
                        numbers = at[rows[start : start + step]][who]
                        yield pd.DataFrame({
                            "question": batch["question"].to_numpy()[numbers], "cell": cells[which], "radius": radius[who],
                            "target": np.int32(target), **{f"q_{x}": points[numbers, i] for i, x in enumerate(names)}})

    return reach
