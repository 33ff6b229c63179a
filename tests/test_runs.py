"""Work along keys and time against plain Python, with buckets so small that keys go over many of them."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelforge.operators import intervals, joins, moments, runs, sketches


def drawn(seed, n, keys, most):
    draw = random.Random(seed)
    return [(i, draw.choice(keys), draw.choice([None, *range(most)]) if draw.random() < 0.3 else draw.randrange(most), round(draw.uniform(0, 9), 2)) for i in range(n)]


HOT = ["hot"] * 8 + ["a", "b", None]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [15, 1_000_000])
def test_asof_matches_a_scan(spark, strict, rows_per_bucket):
    left, right = drawn(1, 300, HOT, 400), drawn(2, 60, HOT, 400)
    left += [left[0]] * 3
    schema = "id int, k string, t int, v double"
    found = runs.asof_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], "t", ["v"], strict, rows_per_bucket=rows_per_bucket)
    assert found.columns == ["id", "k", "t", "v", "t_asof", "v_asof"]
    expected = []
    for row in left:
        before = [(t, v) for _, k, t, v in right if k is not None and k == row[1] and t is not None and row[2] is not None and (t < row[2] or t == row[2] and not strict)]
        expected.append((*row, *max(before, default=(None, None))))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_asof_passes_over_empty_buckets_and_sides(spark):
    schema = "k string, t int, v double"
    right = spark.createDataFrame([("x", 0, 1.5)], schema)
    left = spark.createDataFrame([("x", t, 0.0) for t in range(500)] + [("y", 3, 0.0)], schema)
    found = runs.asof_join(left, right, ["k"], "t", ["v"], rows_per_bucket=20)
    assert Counter((r.k, r.v_asof) for r in found.collect()) == {("x", 1.5): 500, ("y", None): 1}
    assert runs.asof_join(left, right.limit(0), ["k"], "t", ["v"]).where("t_asof IS NOT NULL").count() == 0
    assert runs.asof_join(left.limit(0), right, ["k"], "t", ["v"]).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [7, 1_000_000])
def test_sessions_match_a_scan(spark, rows_per_bucket):
    rows = drawn(3, 400, HOT, 3000) + [(900 + i, "long", 10 * i, 1.0) for i in range(100)]
    events = spark.createDataFrame(rows, "id int, k string, t int, v double").withColumn("ts", F.timestamp_seconds("t"))
    found = runs.sessions(events, ["k"], "ts", "10 seconds", {"total": F.col("v")}, rows_per_bucket)
    by_key, expected = defaultdict(list), []
    for _, k, t, v in rows:
        if k is not None and t is not None:
            by_key[k].append((t, v))
    for k, points in by_key.items():
        group = []
        for t, v in [*sorted(points), (10**9, 0)]:
            if group and t - group[-1][0] > 10:
                expected.append((k, group[0][0], group[-1][0], len(group), round(sum(x for _, x in group), 4)))
                group = []
            group.append((t, v))
    rows = [(r.k, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n_events, round(r.total, 4)) for r in found.collect()]
    assert sorted(rows) == sorted(expected)
    assert ("long", 0, 990, 100, 100.0) in rows
    assert runs.sessions(events.limit(0), ["k"], "ts", "10 seconds").count() == 0


def test_calendar_is_full(spark):
    rows = [("a", "2024-01-01", 1.0), ("a", "2024-01-04", None), ("a", "2024-01-06", 3.0), ("a", "2024-01-06", 2.0), ("b", "2024-02-28", 5.0), ("b", "2024-03-01", 6.0), (None, "2024-01-01", 0.0)]
    series = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.to_date("d"))
    found = runs.on_full_calendar(series, ["k"], "d", ["v"], rows_per_bucket=3)
    assert [(r.k, str(r.d)[5:], r.v, r.is_filled) for r in found.orderBy("k", "d").collect()] == [
        ("a", "01-01", 1.0, False), ("a", "01-02", 1.0, True), ("a", "01-03", 1.0, True), ("a", "01-04", None, False), ("a", "01-05", None, True),
        ("a", "01-06", 3.0, False), ("b", "02-28", 5.0, False), ("b", "02-29", 5.0, True), ("b", "03-01", 6.0, False)]


def spans(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        start = draw.choice([draw.randrange(-50, 1000), 500, 512])
        rows.append((i, draw.choice(["x", "x", "y", None]), start, start + draw.choice([0, 0, 1, 5, 64, 900, -3])))
    return rows + [(n, "x", None, 5), (n + 1, "x", 5, None), (n + 2, "x", -(2**40), 2**40)]


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def joined_how(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(joins.spread_many, "__defaults__", (joins.HOT_ROWS, 0))
    return request.param


@pytest.mark.parametrize("by", [[], ["k"]])
def test_points_in_spans_match_all_pairs(spark, joined_how, by):
    held = spans(4, 150)
    points = [(i, random.Random(i).choice(["x", "y", None]), random.Random(i).choice([500, 512, None, *range(-60, 1100, 50)])) for i in range(120)]
    frame = spark.createDataFrame(held, "id int, k string, lo long, hi long")
    looked = spark.createDataFrame(points, "p int, k string, t long")
    if not by:
        looked = looked.drop("k")
    found = intervals.points_in_spans(looked, frame, "t", "lo", "hi", by, hot_rows=9)
    expected = [(p, i) for p, pk, t in points for i, k, lo, hi in held
                if None not in (t, lo, hi) and lo <= t <= hi and (not by or (pk is not None and pk == k))]
    assert Counter((r.p, r.id) for r in found.collect()) == Counter(expected)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_overlapping_spans_match_all_pairs(spark, joined_how, by):
    left, right = spans(5, 90), spans(6, 70)
    schema = "id int, k string, lo long, hi long"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    found = intervals.overlapping_spans(a, b, "lo", "hi", by, hot_rows=9)
    good = lambda s: None not in s[2:] and s[2] <= s[3]
    expected = [(x[0], y[0]) for x in left for y in right
                if good(x) and good(y) and x[2] <= y[3] and y[2] <= x[3] and (not by or (x[1] is not None and x[1] == y[1]))]
    assert Counter((r.id, r.id_right) for r in found.collect()) == Counter(expected)


@pytest.mark.parametrize("few", [0, 12, 64])
def test_overlapping_spans_of_small_keys_need_no_bins(spark, few):
    """All keys in bins, some, and none; where none is, each span is moved once."""
    rows = spans(8, 90)
    frame = spark.createDataFrame(rows, "id int, k string, lo long, hi long")
    found = intervals.overlapping_spans(frame, frame, "lo", "hi", ["k"], few_rows=few)
    good = [x for x in rows if None not in x and x[2] <= x[3]]
    expected = [(x[0], y[0]) for x in good for y in good if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]]
    assert Counter((r.id, r.id_right) for r in found.collect()) == Counter(expected)
    other = intervals.overlapping_spans(frame, frame.where("id % 3 > 0"), "lo", "hi", ["k"], few_rows=few)
    assert Counter((r.id, r.id_right) for r in other.collect()) == Counter(pair for pair in expected if pair[1] % 3)
    assert few < 64 or "_level" not in found._jdf.queryExecution().toString()


def test_no_nested_loops_and_no_cross_joins(spark):
    frame = spark.createDataFrame(spans(7, 20), "id int, k string, lo long, hi long")
    points = spark.range(50).withColumnRenamed("id", "t")
    for result in (intervals.points_in_spans(points, frame, "t", "lo", "hi"), intervals.overlapping_spans(frame, frame, "lo", "hi")):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.points_in_spans(points, frame.limit(0), "t", "lo", "hi").count() == 0
    assert intervals.overlapping_spans(frame.limit(0), frame, "lo", "hi").count() == 0


@pytest.mark.parametrize("rows", [0, 100])
def test_a_key_of_many_salts_meets_everything(spark, rows):
    facts = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"), "id")
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("lone", 3), (None, 4)], "k string, v int")
    found = joins.spread_join(facts, table, ["k"], "left", hot_rows=50, broadcast_rows=rows)
    expected = facts.join(table, ["k"], "left")
    assert sorted(found.select(*expected.columns).collect()) == sorted(expected.collect())
    if not rows:
        salted = found._jdf.queryExecution().executedPlan().toString()
        assert "_salts" in salted and "NestedLoop" not in salted


def test_sketches_merge_and_keep_their_error(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, "often").when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("v"), (F.col("id") % 2000).cast("string"))).alias("odd name"))
    parts = [sketches.column_sketches(rows.where(F.col("key") % 4 == n)) for n in range(4)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    for frame in (sketches.merged(union), sketches.column_sketches(rows)):
        report = {r.column: r for r in sketches.sketch_report(frame, 3).collect()}
        assert report["key"].n_rows == 60_000 and report["odd name"].n_null == rows.where("`odd name` IS NULL").count()
        for name in rows.columns:
            exact = rows.select(F.count_distinct(f"`{name}`")).first()[0]
            assert abs(report[name].n_distinct - exact) <= 4 * sketches.STANDARD_ERROR * exact
        assert report["odd name"].heavy[0].asDict() == {"value": "often", "n": 20_000}
    assert {r.n_rows for r in sketches.sketch_report(sketches.column_sketches(rows.limit(0))).collect()} == {0}


@pytest.mark.parametrize("rows_per_bucket", [9, 1_000_000])
def test_running_sums_match_a_scan(spark, rows_per_bucket):
    draw = random.Random(9)
    rows = [(i, draw.choice(["hot", "hot", "hot", "a", None]), draw.randrange(5)) for i in range(200)]
    found = runs.running_sums(spark.createDataFrame(rows, "t int, k string, v int"), ["k"], "t", {"n": F.lit(1), "total": F.col("v")}, rows_per_bucket)
    before, expected = defaultdict(lambda: (0, 0)), []
    for t, k, v in rows:
        expected.append((t, k, v, *before[k]))
        before[k] = (before[k][0] + 1, before[k][1] + v)
    assert sorted(tuple(r) for r in found.where("k IS NOT NULL").collect()) == sorted(row for row in expected if row[1] is not None)


def test_moments_match_numpy_and_merge(spark):
    random_ = np.random.default_rng(2)
    matrix = random_.normal(size=(500, 30)) @ random_.normal(size=(30, 30)) + 1e6 * np.arange(30)
    matrix[random_.random(matrix.shape) < 0.1] = np.nan
    matrix[:, 4] = 7.0
    matrix[3, 5], matrix[:, 6] = np.inf, np.nan
    names = [f"a {i}" for i in range(30)]
    frame = spark.createDataFrame([tuple(map(float, row)) for row in matrix], ", ".join(f"`{name}` double" for name in names)).repartition(7)
    whole = moments.moment_states(frame, names)
    found = {(r.column_a, r.column_b): (r.n, r.correlation) for r in moments.correlations(moments.merged_moments(whole), names).collect()}
    assert len(found) == 30 * 29 // 2
    clean = np.where(np.isfinite(matrix), matrix, np.nan)
    for (a, b), (n, value) in found.items():
        x, y = clean[:, names.index(a)], clean[:, names.index(b)]
        both = ~np.isnan(x) & ~np.isnan(y)
        assert n == both.sum()
        expected = None if not both.any() or np.ptp(x[both]) == 0 or np.ptp(y[both]) == 0 else np.corrcoef(x[both], y[both])[0, 1]
        assert value == (None if expected is None else pytest.approx(expected, abs=1e-9))
    shift = whole.first()["shift"]
    parts = [moments.moment_states(frame.where(condition), names, shift) for condition in ("`a 0` > 0", "NOT `a 0` > 0 OR `a 0` IS NULL")]
    again = moments.correlations(moments.merged_moments(parts[0].unionByName(parts[1])), names)
    assert {(r.column_a, r.column_b): r.n for r in again.collect()} == {pair: n for pair, (n, _) in found.items()}
    assert moments.correlations(moments.merged_moments(moments.moment_states(frame.limit(0), names)), names).where("n > 0").count() == 0
