"""Correlations of many columns as a state that tasks build and runs merge.

One ``corr`` for each pair is a plan of some thousand aggregates at a hundred columns. Here a task turns its batches into one
row of sums, with a matrix product for each batch; rows of tasks, parts or runs are added up.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = 4  # numbers of pairs, sums, squares, products


def moment_states(df: DataFrame, columns: list[str], shift: list[float] | None = None) -> DataFrame:
    """One row per task: ``shift`` (a number per column) and ``state``, the sums over all pairs of columns, of rows that have both.

    Values are taken relative to ``shift``, near the means, so that large means cost no digits: the columns' means unless
    given. States are merged only with others of the same shift. Null, NaN and infinite values are missing.
    """
    values = [F.coalesce(F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None)), F.lit(None)).alias(f"c{i}") for i, name in enumerate(columns)]
    numbers = df.select(*values)
    if shift is None:
        finite = [F.avg(F.when(F.abs(f"c{i}") < float("inf"), F.col(f"c{i}"))) for i in range(len(columns))]
        shift = [mean or 0.0 for mean in numbers.agg(*finite).first()]
    centre, width = np.array(shift), len(columns)

    def sums(batches):
        total = np.zeros((KINDS, width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.asarray(column.fill_null(np.nan), np.float64) for column in batch.columns]) - centre
            held = np.isfinite(x)
            x = np.where(held, x, 0.0)
            there = held.astype(np.float64)
            for kind, (a, b) in enumerate(((there, there), (x, there), (x * x, there), (x, x))):
                total[kind] += a.T @ b
        yield pa.RecordBatch.from_pydict({
            "shift": pa.array([centre.tolist()], pa.list_(pa.float64())), "state": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    return numbers.mapInArrow(sums, "shift array<double>, state array<double>")


def merged_moments(states: DataFrame) -> DataFrame:
    """States of tasks, parts or runs added up: one row per shift. Positions are summed map-side, so no task gets all states."""
    sums = states.select("shift", F.posexplode("state").alias("at", "value")).groupBy("shift", "at").agg(F.sum("value").alias("value"))
    return sums.groupBy("shift").agg(F.sort_array(F.collect_list(F.struct("at", "value")))["value"].alias("state"))


def correlations(state: DataFrame, columns: list[str]) -> DataFrame:
    """``column_a``, ``column_b``, ``n`` rows that have both, and their ``correlation``, for each pair of columns, of a merged state.

    The correlation is null where either column does not vary.
    """
    width = len(columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(width) for j in range(i + 1, width)])
    rows = state.select("state", F.explode(pairs).alias("p"))

    def cell(kind: int, a: str, b: str):
        return F.get("state", F.lit(kind * width * width) + F.col(f"p.{a}") * width + F.col(f"p.{b}"))

    names = F.array(*[F.lit(name) for name in columns])
    cells = rows.select(
        F.get(names, F.col("p.i")).alias("column_a"), F.get(names, F.col("p.j")).alias("column_b"), cell(0, "i", "j").alias("n"),
        cell(1, "i", "j").alias("sa"), cell(1, "j", "i").alias("sb"), cell(2, "i", "j").alias("qa"), cell(2, "j", "i").alias("qb"), cell(3, "i", "j").alias("p"))
    spread = F.sqrt(F.greatest(F.col("n") * F.col("qa") - F.col("sa") ** 2, F.lit(0.0)) * F.greatest(F.col("n") * F.col("qb") - F.col("sb") ** 2, F.lit(0.0)))
    varies = spread > 1e-12 * F.col("n") * F.sqrt(F.col("qa") * F.col("qb"))
    return cells.select("column_a", "column_b", F.col("n").cast("long").alias("n"), F.when(
        varies, (F.col("n") * F.col("p") - F.col("sa") * F.col("sb")) / spread).alias("correlation"))
