"""Imputation by the k nearest rows, exact, without comparing every row with every other.

The distance between two rows counts the columns both have: ``d / shared * sum of squared differences``
with ``d`` columns in all. A missing value becomes the mean over the k nearest rows that have that column;
equal distances are ordered by key. A row that shares no column with any donor gets the column's mean.

How the work is cut down:

* A *unit* is a pattern of present columns together with one missing column. Per unit, donors are
  projected on the pattern, and of donors that coincide there only the k with the smallest keys are kept,
  because no other can be among the k nearest. Repeated rows, however many, collapse map-side. Rows that
  ask the same question are asked once.
* Donors of a unit that lack the same columns form a *family*. Families are cut into cells by median
  splits taken from a sample of bounded size; the sample places the borders and nothing else.
* Counts and bounding boxes of the cells (at most ``MAX_CELLS`` plus one per family) are known to every
  task. Questions are cut into blocks of neighbours; a block's bounding box leaves out the cells that none of its questions
  can need. For each question the others give a radius that surely holds k donors; it is sent
  only to cells that meet it, and ``knn_cells`` finds the k nearest of each.
"""

from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.constants import NEIGHBOURS
from reelforge.functions.missing import nan_to_null
from reelforge.operators import knn_any, knn_cells
from reelforge.operators.durable import settle

MOST_COLUMNS = 40  # a family's number holds a bit per column beside that of its unit
PROJECTED = 64  # patterns that donors are projected on; the others, and wider frames, go through knn_any
BLOCK = 256
MAX_CELLS = 200_000
CELL_ROWS = 64
SAMPLE_PER_CELL = 10


def knn_impute(df: DataFrame, key: str, columns: list[str], k: int = NEIGHBOURS) -> DataFrame:
    """``key`` and ``columns`` of ``df`` with missing values imputed from the k nearest rows.

    ``key`` is unique and not null. Scale the columns first: distances add their squares. Any number of columns and of
    patterns of missing ones will do: rows of the ``PROJECTED`` most frequent patterns are asked of projected donors, all others go
    through ``knn_any``.
    """
    names = [f"x{i}" for i in range(len(columns))]

    rows = df.select(
        F.col(key).alias("key"), *[nan_to_null(F.col(name).cast("double")).alias(x) for name, x in zip(columns, names)]
    )
    narrow = len(columns) <= MOST_COLUMNS
    bits = [F.when(F.col(x).isNotNull(), F.lit(1 << i).cast("long")).otherwise(0) for i, x in enumerate(names)] if narrow else []
    rows = settle(rows.withColumn("has", sum(bits, F.lit(0).cast("long"))))
    means = rows.agg(F.struct(*[F.avg(x).alias(x) for x in names]).alias("m")).scalar()

    full = (1 << len(columns)) - 1
    lacking = rows.where(F.col("has") != full) if narrow else rows
    patterns = [row["has"] for row in lacking.groupBy("has").count().orderBy(F.desc("count"), "has").limit(PROJECTED).collect()] if narrow else []
    found = [_estimates(rows, names, k, patterns), knn_any.estimates(rows, lacking.where(~F.col("has").isin(patterns)), names, k, _split)]
    found = [part for part in found if part is not None]
    estimates = found[0].unionByName(found[-1]) if len(found) == 2 else found[0] if found else None
    if estimates is not None:
        rows = rows.join(estimates, "key", "left")
    filled = [
        F.coalesce(F.col(x), F.col(f"near_{i}") if estimates is not None else F.lit(None), F.col("_means")[x]).alias(name)
        for i, (name, x) in enumerate(zip(columns, names))
    ]
    return rows.withColumn("_means", means).select(F.col("key").alias(key), *filled)


def _estimates(rows: DataFrame, names: list[str], k: int, patterns: list[int]) -> DataFrame | None:
    """``key, near_0, near_1, ...`` for the rows of some patterns; None when there is nothing to ask."""
    width = len(names)
    units = [(pattern, i) for pattern in sorted(patterns) if pattern for i in range(width) if not pattern >> i & 1]
    if not units:
        return None
    unit_list = F.array(*[
        F.struct(F.lit(u).alias("unit"), F.lit(pattern).cast("long").alias("pattern"), F.lit(i).alias("target"))
        for u, (pattern, i) in enumerate(units)
    ])

    asked = rows.where(F.col("has").isin(patterns)).select(
        "key", "has", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in names],
        F.explode(F.filter(unit_list, lambda u: u["pattern"] == F.col("has"))).alias("u"),
    ).select("key", "u.unit", "u.target", *names)
    # Spread evenly and over all cores: a question is few bytes but much work. Distinct rows, hashed and
    # sorted, so the ids come out the same if a partition is computed again.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    questions = settle(
        asked.select("unit", *names).distinct().repartition(parts, "unit", *names)
        .sortWithinPartitions("unit", *names).withColumn("question", F.monotonically_increasing_id())
    )

    donors = settle(_donors(rows, unit_list, names, k))
    families = {
        row.family: row.n for row in donors.groupBy("family").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not families:
        return None
    trees = _trees(donors, families, names)
    placed = donors.withColumn("cell", _cell_column(trees, width)(F.col("family"), *[F.col(x) for x in names]))
    boxes = placed.groupBy("family", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(x).alias(f"lo_{x}") for x in names], *[F.max(x).alias(f"hi_{x}") for x in names],
    ).orderBy("cell").toPandas()  # at most MAX_CELLS and one per family

    reach = questions.mapInPandas(
        _cells_in_reach(_cells_by_unit(boxes, names), names, k),
        ", ".join(["question long", "cell long", *[f"q_{x} double" for x in names], "aside double", "radius double"]),
    )
    answers = knn_cells.answers(reach, placed, names, k, *_comparison(width))
    answered = questions.hint("merge").join(answers, "question").drop("question")
    return asked.hint("merge").join(answered, ["unit", *names]).groupBy("key").agg(*[
        F.max(F.when(F.col("target") == i, F.col("answer"))).alias(f"near_{i}") for i in range(width)
    ])


def _comparison(width: int):
    """Distances of questions and projected donors, weighted by ``aside``, and the donors' values."""

    # local, so that they travel to the workers by value
    def distances(questions, aside, donors):
        squares = np.zeros((len(questions), len(donors)))
        for i in range(width):
            gap = questions[:, i, None] - donors[None, :, i]
            squares += gap * gap
        return aside[:, None] * squares

    def values(aside, value, donors, who, which):
        return value[which]

    return distances, values


def _donors(rows: DataFrame, unit_list, names: list[str], k: int) -> DataFrame:
    """Donors of every unit: projected, and at most k of those that coincide."""
    width = len(names)

    def usable(u):
        has_target = F.col("has").bitwiseAND(F.element_at(powers, u["target"] + 1)) != 0
        return has_target & (F.col("has").bitwiseAND(u["pattern"]) != 0)

    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(width)])
    offered = rows.select(
        F.col("key").alias("donor"), "has", *names, F.explode(F.filter(unit_list, usable)).alias("u")
    )
    shared = F.col("has").bitwiseAND(F.col("u.pattern"))
    projected = offered.select(
        "donor",
        (F.col("u.unit").cast("long") * (1 << width) + shared).alias("family"),
        F.element_at(F.array(*names), F.col("u.target") + 1).alias("value"),
        *[F.when(shared.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.col(x)).otherwise(0.0).alias(x) for i, x in enumerate(names)],
    )
    same_place = Window.partitionBy("family", *names).orderBy("donor")
    return projected.withColumn("rank", F.row_number().over(same_place)).where(F.col("rank") <= k).drop("rank")


def _trees(donors: DataFrame, families: dict[int, int], names: list[str]) -> dict[int, tuple]:
    """Split trees per family, from a sample of about ``SAMPLE_PER_CELL`` rows per cell.

    A question is weighed against every cell and then compared with the rows of about ten, so its cost is
    least with about the square root of ten times the rows as the number of cells.

    A tree is (first cell, split column or -1, cut, left child, right child); its cells are its nodes.
    """
    total = sum(families.values())
    cell_rows = max(CELL_ROWS, ceil(total / min(MAX_CELLS, sqrt(10 * total))))
    fraction = min(1.0, SAMPLE_PER_CELL / cell_rows)
    sampled = donors.select("family", *names)
    if fraction < 1.0:
        sampled = sampled.sample(fraction, seed=1)
    points = sampled.toPandas()
    leaf = max(1, round(cell_rows * fraction))
    of_family = dict(list(points.groupby("family")[names]))
    trees, first = {}, 0
    for family in sorted(families):
        sample = of_family[family].to_numpy() if family in of_family else np.empty((0, len(names)))
        trees[family] = (first, *_split(sample, leaf))
        first += len(trees[family][1])
    return trees


def _split(points: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """Halve the widest column at its median until at most ``leaf`` points are left."""
    column, cut, left, right = [-1], [0.0], [-1], [-1]
    open_nodes = [(0, points)]
    while open_nodes:
        node, inside = open_nodes.pop()
        if len(inside) <= leaf:
            continue
        widest = int(np.argmax(np.ptp(inside, axis=0)))
        values = inside[:, widest]
        # the largest value may not be the cut: both halves have to hold points
        at = min(np.median(values), np.max(values[values < values.max()], initial=values.min()))
        lower = values <= at
        if lower.all():
            continue
        column[node], cut[node] = widest, float(at)
        left[node], right[node] = len(column), len(column) + 1
        for half in (inside[lower], inside[~lower]):
            open_nodes.append((len(column), half))
            column.append(-1), cut.append(0.0), left.append(-1), right.append(-1)
    return np.array(column), np.array(cut), np.array(left), np.array(right)


def _cell_column(trees: dict[int, tuple], width: int):
    """Column function: the cell of a donor."""

    # local, so that it travels to the workers by value
    def find(family: pd.Series, *coordinates: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy() for c in coordinates])
        families = family.to_numpy()
        cells = np.zeros(len(families), dtype=np.int64)
        for one in np.unique(families):
            at = np.flatnonzero(families == one)
            first, column, cut, left, right = trees[int(one)]
            node = np.zeros(len(at), dtype=np.int64)
            while True:
                inner = np.flatnonzero(column[node] >= 0)
                if not len(inner):
                    break
                here = node[inner]
                lower = points[at[inner], column[here]] <= cut[here]
                node[inner] = np.where(lower, left[here], right[here])
            cells[at] = first + node
        return pd.Series(cells)

    return F.pandas_udf(find, "long")


def _cells_by_unit(boxes: pd.DataFrame, names: list[str]) -> dict[int, tuple]:
    """Per unit: cells, row counts, box corners, which columns count, and the weight of the distance."""
    width = len(names)
    unit = boxes["family"].to_numpy() >> width
    shared = boxes["family"].to_numpy() & ((1 << width) - 1)
    counts_column = (shared[:, None] >> np.arange(width)) & 1
    weight = width / counts_column.sum(axis=1)
    lo = boxes[[f"lo_{x}" for x in names]].to_numpy()
    hi = boxes[[f"hi_{x}" for x in names]].to_numpy()
    cells, n = boxes["cell"].to_numpy(), boxes["n"].to_numpy()
    return {
        int(u): tuple(part[unit == u] for part in (cells, n, lo, hi, counts_column.astype(float), weight))
        for u in np.unique(unit)
    }


def _cells_in_reach(by_unit: dict[int, tuple], names: list[str], k: int):
    """Function over batches of questions: the cells each has to be compared with."""
    width = len(names)

    # local, so that it travels to the workers by value
    def bounds(low, high, lo, hi, counts_column, weight):
        """Least and most distance of boxes of questions to boxes of cells."""
        least = np.zeros((len(low), len(lo)))
        most = np.zeros((len(low), len(lo)))
        for i in range(width):
            below, above = lo[None, :, i] - high[:, None, i], low[:, None, i] - hi[None, :, i]
            least += counts_column[:, i] * np.maximum(np.maximum(below, above), 0.0) ** 2
            most += counts_column[:, i] * np.maximum(np.abs(lo[None, :, i] - high[:, None, i]), np.abs(hi[None, :, i] - low[:, None, i])) ** 2
        return least * weight, most * weight

    def radii(most, n):
        order = np.argsort(most, axis=1)
        enough = np.cumsum(n[order], axis=1) >= k
        line = np.arange(len(most))
        radius = np.where(enough.any(axis=1), most[line, order[line, np.argmax(enough, axis=1)]], np.inf)
        return radius * (1 + 1e-9) + 1e-12

    def blocks(points):
        """Row numbers of neighbours, halved along the widest column until few are left."""
        waiting = [np.arange(len(points))]
        while waiting:
            at = waiting.pop()
            if len(at) <= BLOCK:
                yield at
                continue
            inside = points[at]
            order = at[np.argsort(inside[:, np.argmax(np.ptp(inside, axis=0))], kind="stable")]
            waiting += [order[: len(at) // 2], order[len(at) // 2 :]]

    def reach(batches):
        for batch in batches:
            for unit, questions in batch.groupby("unit"):
                if unit not in by_unit:
                    continue
                points, numbers = questions[names].to_numpy(), questions["question"].to_numpy()
                for rows in blocks(points):
                    asked = points[rows]
                    cells, n, lo, hi, counts_column, weight = by_unit[unit]
                    least, most = bounds(asked.min(axis=0)[None], asked.max(axis=0)[None], lo, hi, counts_column, weight)
                    inside = np.flatnonzero(least[0] <= radii(most, n)[0])
                    cells, n, lo, hi, counts_column, weight = (part[inside] for part in by_unit[unit])
                    step = max(1, 1_000_000 // len(cells))
                    for start in range(0, len(rows), step):
                        part = asked[start : start + step]
                        least, most = bounds(part, part, lo, hi, counts_column, weight)
                        radius = radii(most, n)
                        who, which = np.nonzero(least <= radius[:, None])
                        near = part[who] * counts_column[which]
                        yield pd.DataFrame({
                            "question": numbers[rows[start : start + step]][who], "cell": cells[which],
                            **{f"q_{x}": near[:, i] for i, x in enumerate(names)},
                            "aside": weight[which], "radius": radius[who],
                        })

    return reach
