"""Table operators: quirks, hot keys, and comparison with brute force."""

import math
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelforge.operators import census, credits, documents, hygiene, impute, joins, knn, knn_any, knn_cells, numbering, profile, quantiles, series
from reelforge.plans import model_queries


def rows_of(frame, *order):
    return [tuple(row) for row in (frame.orderBy(*order) if order else frame).collect()]


# --- joins -------------------------------------------------------------------------------------------

def test_lookup_keeps_na_and_defaults(spark):
    countries = spark.createDataFrame([("NA", "Africa"), ("AQ", ""), ("US", "Americas")], "`alpha-2` string, region string")
    facts = spark.createDataFrame([(1, "na"), (2, "AQ"), (3, "ZZ"), (4, "us"), (5, None)], "id int, code string")
    got = joins.lookup(facts, countries, F.col("code"), "alpha-2", "region", "World", "continent")
    assert rows_of(got.select("id", "continent"), "id") == [
        (1, "Africa"), (2, "World"), (3, "World"), (4, "Americas"), (5, "World")]


def test_aligned_never_multiplies_rows(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 2), ("a", 1), ("c", 3)], "k string, v int")
    assert rows_of(joins.aligned(left, right, "k"), "k") == [("a", 1), ("b", None), ("c", 3)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_take_the_other_way_and_give_the_same(spark, how):
    facts = spark.createDataFrame([("hot", i) for i in range(20)] + [("a", 1), ("b", 2), ("b", 3), ("lone", 1)], "k string, v int")
    counts = facts.where("k <> 'lone'").groupBy("k").agg(F.count("*").alias("n"))
    whole = rows_of(facts.join(counts, "k", how), "k", "v")
    assert rows_of(joins.attach_counts(facts, counts, "k", "n", how), "k", "v") == whole
    split = joins.attach_counts(facts, counts, "k", "n", how, hot_rows=5, broadcast_rows=0)
    assert rows_of(split, "k", "v") == whole


def test_maps_unions_and_differences(spark):
    known = spark.createDataFrame([("a", 1)], "k string, v int")
    found = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    assert rows_of(joins.merge_map(known, found, "k", "v"), "k") == [("a", 1), ("b", 2)]
    extra = spark.createDataFrame([("c", "x"), (None, "y")], "k string, w string")
    assert rows_of(joins.append_rows(known, extra, "k"), "k") == [("a", 1, None), ("c", None, "x")]
    assert rows_of(joins.key_difference(found, known, "k")) == [("b",)]
    assert rows_of(joins.not_yet_done(found, known, "k")) == [("b", 2)]
    assert rows_of(joins.already_done(found, known, "k")) == [("a", 9)]


def test_rejects_are_logged_once(spark):
    logged = spark.createDataFrame([("a", "no match")], "id string, reason string")
    lost = spark.createDataFrame([("a", "no match"), ("b", "no match"), ("b", "no match")], "id string, reason string")
    assert rows_of(hygiene.new_rejects(lost, logged)) == [("b", "no match")]


# --- hygiene -----------------------------------------------------------------------------------------

def test_clean_titles(spark):
    raw = spark.createDataFrame([
        ("a", "Amélie", None, "2000", r"\N", "90", 10.0),
        ("b", "B", "Bé", r"\N", "1999", r"\N", float("nan")),
        ("c", "C", r"\N", "2500", r"\N", "110", 30.0),
        ("d", "D", "D", "2001", "NULL", "NULL", None),
    ], "tconst string, primaryTitle string, originalTitle string, startYear string, endYear string, runtimeMinutes string, numVotes double")
    got = hygiene.clean_titles(raw).select("tconst", "startYear", "endYear", "runtimeMinutes", "numVotes", "foreignMovie")
    mean = (2000 + 2500 + 2001) / 3
    assert rows_of(got, "tconst") == [
        ("a", 2000.0, -1, 90.0, 10.0, False), ("b", mean, 1999, 100.0, 20.0, True),
        ("c", mean, -1, 110.0, 30.0, False), ("d", 2001.0, -1, 100.0, 20.0, False),
    ]
    repaired = hygiene.restore_years(raw)
    assert rows_of(repaired.select("tconst", "startYear"), "tconst") == [("a", 2000), ("b", 1999), ("c", 2500), ("d", 2001)]
    assert "endYear" not in repaired.columns


def test_mean_domain_can_be_bounded(spark):
    years = spark.createDataFrame([(2000.0,), (2500.0,), (None,)], "y double")
    parity = hygiene.impute_valid_mean(years, ["y"], {"y": 2022})
    assert sorted(r[0] for r in parity.collect()) == [2000.0, 2250.0, 2250.0]
    bounded = hygiene.impute_valid_mean(years, ["y"], {"y": 2022}, bounded_mean=True)
    assert [r[0] for r in bounded.collect()] == [2000.0] * 3


def test_validation_splits_rows(spark):
    items = spark.createDataFrame([("a", 1.0, 1), ("b", -1.0, 1)], "name string, price double, quantity int")
    good, bad = hygiene.validate(items, {"price >= 0": F.col("price") >= 0, "quantity >= 0": F.col("quantity") >= 0})
    assert rows_of(good) == [("a", 1.0, 1)] and rows_of(bad) == [("b", -1.0, 1, ["price >= 0"])]


# --- characters --------------------------------------------------------------------------------------

def test_census_and_discovery(spark):
    titles = spark.createDataFrame([("Ègale Ñandú = x", "é"), ("{plain}", "éé")], "a string, b string")
    counts = dict(rows_of(census.char_census(titles, ["a", "b"])))
    assert counts == {"È": 1, "Ñ": 1, "ú": 1, "=": 1, "{": 1, "}": 1, "é": 3}
    assert rows_of(census.discover_letters(census.char_census(titles, ["a"])), "ch") == [("È", "E"), ("Ñ", "N")]
    cleaned = census.clean_text_columns(titles, ["a", "b"])
    assert rows_of(cleaned, "a") == [("Egale Nandu = x", "e"), ("{plain}", "ee")]


def test_folding_one_split_only(spark):
    titles = spark.createDataFrame([("train", "é"), ("test", "é")], "split string, t string")
    assert rows_of(census.clean_text_columns(titles, ["t"], split="train"), "split") == [("test", "é"), ("train", "e")]


# --- credits -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def edges(spark):
    directing = spark.createDataFrame(
        [("m1", "d1"), ("m1", "d2"), ("m1", "d3"), ("m2", "d1"), ("m4", None)], "movie string, director string")
    writing = spark.createDataFrame(
        [("m1", "w1"), ("m1", "w2"), ("m2", "w1"), ("m3", "w1")], "movie string, writer string")
    return directing, writing


@pytest.mark.parametrize("hot_rows", [1, 2, 1_000_000])
def test_credit_modes(edges, hot_rows):
    directing, writing = edges
    columns = ["movie", "director_movie_count", "director_count", "writer_movie_count", "writer_count"]
    limits = {"hot_rows": hot_rows, "broadcast_rows": 0 if hot_rows < 1000 else 1000}
    pairs = credits.credit_features(directing, writing, "pairs", **limits).select(*columns)
    assert rows_of(pairs, "movie") == [("m1", 2, 6, 3, 6), ("m2", 2, 1, 3, 1)]
    people = credits.credit_features(directing, writing, "people", **limits).select(*columns)
    assert rows_of(people, "movie") == [("m1", 2, 3, 3, 2), ("m2", 2, 1, 3, 1), ("m3", 0, 0, 3, 1)]


@pytest.mark.parametrize("hot_rows", [1, 3, 1_000_000])
def test_pairs_per_writer_equal_the_plain_join(edges, hot_rows):
    directing, writing = edges
    plain = writing.join(directing.where("director is not null"), "movie", "left").groupBy("movie", "writer").agg(
        F.count("director").alias("n_directors"), F.count("*").alias("n_joined_rows"))
    ours = credits.credit_pairs_per_writer(writing, directing, hot_rows=hot_rows, broadcast_rows=0)
    assert rows_of(ours, "movie", "writer") == rows_of(plain, "movie", "writer")


def test_titles_without_credits(spark, edges):
    titles = spark.createDataFrame([("m1",), ("m9",)], "tconst string")
    got = credits.with_credit_features(titles, *edges).select("tconst", "director_count", "writer_count")
    assert rows_of(got, "tconst") == [("m1", 3, 2), ("m9", 0, 0)]
    pairs = credits.with_credit_features(titles, *edges, mode="pairs").select("tconst", "director_count")
    assert rows_of(pairs, "tconst") == [("m1", 6), ("m9", None)]


# --- documents ---------------------------------------------------------------------------------------

def test_external_features(spark):
    countries = spark.createDataFrame([("NA", "Africa"), ("AQ", "")], "`alpha-2` string, region string")
    responses = spark.createDataFrame([
        ("t1", '{"imdb_id":"t1","genres":[{"id":1,"name":"War"},{"id":1,"name":"War"},{"id":2,"name":"TV Movie"}],"production_countries":[{"iso_3166_1":"na"}]}'),
        ("t2", '{"imdb_id":"t2","genres":[],"production_countries":[]}'),
        ("t3", "{broken"),
        ("t4", '{"popularity": 1.0}'),
    ], "id string, payload string")
    parsed = documents.parse_documents(responses)
    columns = ["tconst", "continent", "war", "tv_movie", "action"]
    assert rows_of(documents.external_features(parsed, countries).select(*columns), "tconst") == [
        ("t1", "Africa", 1, 1, 0), ("t2", "World", 0, 0, 0)]
    counted = documents.external_features(parsed, countries, counts=True)
    assert rows_of(counted.select(*columns), "tconst") == [("t1", "Africa", 2, 1, 0), ("t2", "World", 0, 0, 0)]
    assert len([c for c in counted.columns]) == 9 + 19
    rejects = documents.document_rejects(parsed, "id", ["imdb_id"])
    assert rows_of(rejects, "id") == [("t3", "malformed"), ("t4", "missing imdb_id")]
    assert rows_of(documents.exploded_genres(documents.flatten_documents(parsed), "imdb_id"), "imdb_id", "genre")[1:] == [
        ("t1", "TV Movie", "tv_movie"), ("t1", "War", "war"), ("t1", "War", "war"), ("t2", None, None)]


def test_enrichment_plan(spark):
    titles = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "tconst string")
    id_map = spark.createDataFrame([("a", 1), ("b", 2)], "imdb_id string, tmdb_id long")
    not_found = spark.createDataFrame([("c", "no match")], "id string, reason string")
    done = spark.createDataFrame([("b",)], "tconst string")
    plan = documents.enrichment_plan(titles, id_map, not_found, done)
    assert rows_of(plan, "tconst") == [("a", 1, "fetch"), ("c", None, "not found"), ("d", None, "map")]
    assert rows_of(documents.documents_to_fetch(id_map, done)) == [("a", 1)]


# --- quantiles and profiles --------------------------------------------------------------------------

@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.0])), min_size=1, max_size=60))
def test_exact_quantiles(spark, data):
    frame = spark.createDataFrame([(g, v) for g, v in data] + [("a", None), ("a", float("nan"))], "g string, v double")
    wanted = {"low": 0.0, "p25": 0.25, "p50": 0.5, "high": 1.0}
    for groups in (["g"], []):
        got = quantiles.exact_quantiles(frame, groups, "v", wanted).collect()
        for row in got:
            values = [v for g, v in data if not groups or g == row["g"]]
            for name, p in wanted.items():
                assert math.isclose(row[name], np.quantile(values, p), rel_tol=1e-12, abs_tol=1e-9)


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "hot_rows": 1_000, "bracket_rows": 50}])
def test_exact_quantiles_of_large_skewed_groups(spark, limits):
    frame = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.when(F.col("id") % 4 == 0, 7.0).otherwise((F.col("id") * 7919 % 100_003).cast("double")).alias("v"))
    got = {r["g"]: (r["m"], r["q"]) for r in quantiles.exact_quantiles(frame, ["g"], "v", {"m": 0.5, "q": 0.9}, 100, **limits).collect()}
    expected = {r["g"]: (r["m"], r["q"]) for r in frame.groupBy("g").agg(
        F.percentile("v", 0.5).alias("m"), F.percentile("v", 0.9).alias("q")).collect()}
    assert got.keys() == expected.keys()
    for group, both in got.items():
        assert both == pytest.approx(expected[group])


def test_profiles(spark):
    frame = spark.createDataFrame([(1, 1.0, "x"), (2, float("nan"), ""), (3, 5.0, None)], "k int, v double, t string")
    assert {r["column"]: (r["n_null"], r["any_null"]) for r in profile.null_profile(frame).collect()} == {
        "k": (0, False), "v": (0, False), "t": (1, True)}
    summary = profile.column_summary(frame, ["v"]).first()
    assert (summary["n"], summary["mean"], summary["p50"], summary["max"]) == (2, 3.0, 3.0, 5.0)
    assert profile.partition_total(frame, "v").first()[0] == 6.0
    columns = {r["column"]: tuple(r)[1:] for r in profile.column_profile(frame.select("t")).collect()}
    assert columns == {"t": (3, 1, 1, 2, "", "x")}
    assert rows_of(profile.column_types(frame)) == [("k", "int"), ("v", "double"), ("t", "string")]
    assert rows_of(profile.top_k(frame.select("k", F.nanvl("v", F.lit(None)).alias("v")), "v", "k", 2)) == [(3, 5.0), (1, 1.0)]


# --- numbering and series ----------------------------------------------------------------------------

def test_positions(spark):
    frame = spark.range(1000).select((F.col("id") * F.col("id") * 37).alias("id"))
    got = rows_of(numbering.with_position(frame, "id", buckets=16), "id")
    assert [position for _, position in got] == list(range(1000))


def test_anchor_batches(spark):
    titles = spark.createDataFrame([(i, t) for i, t in enumerate("abacdAef")], "row_id long, title string")
    assert rows_of(series.anchor_batches(titles, "title", "row_id", "A"), "batch_id") == [
        (0, ["a", "b", "c", "d", "A"]), (1, ["e", "f", "A"])]


def test_anchor_normalisation(spark):
    long = spark.createDataFrame([
        (0, "A", 50.0), (0, "x", 10.0), (1, "A", 25.0), (1, "y", 10.0), (1, "y", 30.0), (2, "A", 0.0), (2, "z", 1.0)],
        "batch_id int, series string, value double")
    assert rows_of(series.anchor_normalized(long, "A", 0), "batch_id", "series") == [
        (0, "A", 50.0), (0, "x", 10.0), (1, "y", 40.0), (2, "z", None)]
    fetched = spark.createDataFrame([(0,)], "batch_id int")
    batches = spark.createDataFrame([(0,), (1,)], "batch_id int")
    assert rows_of(series.batches_to_fetch(batches, fetched)) == [(1,)]


# --- imputation and scaling --------------------------------------------------------------------------

def test_median_and_constant_columns(spark):
    frame = spark.createDataFrame([(1.0, 3), (2.0, 3), (10.0, 3), (float("nan"), 3), (None, None)], "v double, c int")
    assert sorted(r[0] for r in impute.impute_median(frame, ["v"]).collect()) == [1.0, 2.0, 2.0, 2.0, 10.0]
    scaled = impute.scale_both(frame, ["v", "c"]).collect()
    assert [r["c_minmax"] for r in scaled] == [0.0, 0.0, 0.0, 0.0, None]
    assert [r["c_standard"] for r in scaled] == [0.0, 0.0, 0.0, 0.0, None]
    known = np.array([1.0, 2.0, 10.0])
    assert [r["v_standard"] for r in scaled[:3]] == pytest.approx((known - known.mean()) / known.std())
    assert [r["v_minmax"] for r in scaled[:3]] == pytest.approx([0.0, 1 / 9, 1.0]) and scaled[3]["v_minmax"] is None


def test_approximate_median_is_near_in_rank(spark):
    frame = spark.range(10_001).select(F.when(F.col("id") % 10 != 3, F.col("id").cast("double")).alias("v"))
    filled = impute.impute_median(frame, ["v"], exact=False)
    assert filled.where("v is null").count() == 0
    extra = filled.exceptAll(frame.where("v is not null")).distinct().collect()
    assert len(extra) == 1 and abs(extra[0][0] - 5000) <= 10_001 * 0.002


def test_partition_sums_add_up(spark):
    frame = spark.range(0, 100, 1, 5).select(F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("v"))
    sums = profile.partition_sums(frame, "v").collect()
    assert len(sums) == 5 and sum(r["n_rows"] for r in sums) == 100
    assert sum(r["total"] for r in sums) == sum(i for i in range(100) if i % 4)


def test_scaling_fitted_on_one_frame_used_on_another(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    other = spark.createDataFrame([(5.0,), (20.0,)], "v double")
    assert [r[0] for r in impute.scale_min_max(other, ["v"], impute.scaling(train, ["v"])).collect()] == [0.5, 2.0]


def test_scaling_many_columns_stays_compiled(spark, tmp_path):
    """The JVM does not compile a method of over 8,000 bytes: six columns scaled twice in the regressions were one, run byte by byte."""
    names = [f"c{i}" for i in range(6)]
    spark.range(100).select(*[(F.col("id") % (i + 2)).cast("double").alias(name) for i, name in enumerate(names)]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no code before it has run
    try:
        code = impute.scale_both(rows, names, impute.scaling(rows, names))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000, sizes


def test_scaled_parts_store_what_a_fit_reads_again(spark):
    rows = spark.range(50).select(
        F.concat(F.lit("tt"), "id").alias("tconst"), (F.col("id") % 2).cast("double").alias(model_queries.model.LABEL_INDEX),
        F.col("id").cast("double").alias("v"), F.lit(3.0).alias("c"))
    train, held_out, inputs = model_queries.scaled_parts(rows.where("id < 40"), rows.where("id >= 40"), ["v", "c"])
    assert inputs == ["v_minmax", "c_minmax", "v_standard", "c_standard"]
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "CASE" not in plan and "Subquery" not in plan
    expected = impute.scale_both(rows.where("id < 40"), ["v", "c"]).select(model_queries.model.LABEL_INDEX, *inputs)
    assert train.exceptAll(expected).count() == 0 and train.count() == 40
    last = held_out.orderBy(F.col("id").desc()).first()
    assert last["v_minmax"] == pytest.approx(49 / 39) and last["c_standard"] == 0.0


def brute_force(matrix: np.ndarray, k: int) -> np.ndarray:
    filled = matrix.copy()
    rows, width = matrix.shape
    for r in range(rows):
        for j in np.flatnonzero(np.isnan(matrix[r])):
            ranked = []
            for d in range(rows):
                both = ~np.isnan(matrix[r]) & ~np.isnan(matrix[d])
                if not np.isnan(matrix[d, j]) and both.any():
                    ranked.append((width / both.sum() * ((matrix[r, both] - matrix[d, both]) ** 2).sum(), d))
            near = [matrix[d, j] for _, d in sorted(ranked)[:k]]
            filled[r, j] = np.mean(near) if near else np.nanmean(matrix[:, j])
    return filled


def knn_matrix(spark, matrix, k=5):
    names = [f"c{i}" for i in range(matrix.shape[1])]
    data = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(matrix)]
    frame = spark.createDataFrame(data, "key long, " + ", ".join(f"{n} double" for n in names))
    return np.array([tuple(r)[1:] for r in knn.knn_impute(frame, "key", names, k).orderBy("key").collect()], dtype=float)


@pytest.mark.parametrize("seed,decimals", [(0, 6), (1, 1)])
def test_knn_equals_brute_force(spark, monkeypatch, seed, decimals):
    """Small cells, so that many are cut off; one decimal gives many equal distances and repeated rows."""
    monkeypatch.setattr(knn, "CELL_ROWS", 4)
    random = np.random.default_rng(seed)
    matrix = np.round(random.random((160, 3)), decimals)
    matrix[random.random((160, 3)) < 0.15] = np.nan
    matrix[7] = np.nan
    matrix[20:60] = matrix[20]  # a quarter of the rows are copies
    assert knn_matrix(spark, matrix) == pytest.approx(brute_force(matrix, 5))


@pytest.mark.parametrize("projected", [0, 2])
@pytest.mark.parametrize("decimals", [6, 1])
def test_knn_of_rare_patterns_equals_brute_force(spark, monkeypatch, projected, decimals):
    """All or most patterns without projection; cells so small that there are several levels of them."""
    monkeypatch.setattr(knn, "PROJECTED", projected)
    monkeypatch.setattr(knn_any, "CELL_ROWS", 4)
    monkeypatch.setattr(knn_any, "FAN", 3)
    monkeypatch.setattr(knn_any, "BLOCK", 5)
    random = np.random.default_rng(3)
    matrix = np.round(random.random((200, 4)), decimals)
    matrix[random.random((200, 4)) < 0.2] = np.nan
    matrix[7] = np.nan
    matrix[20:70] = matrix[20]
    assert knn_matrix(spark, matrix) == pytest.approx(brute_force(matrix, 5))


def test_knn_of_sixty_columns(spark):
    """Almost every row has a pattern of its own."""
    random = np.random.default_rng(4)
    matrix = np.round(random.random((150, 60)) + np.arange(150)[:, None] % 5, 6)
    matrix[random.random((150, 60)) < 0.1] = np.nan
    matrix[:, 3] = np.nan
    matrix[5, 3] = 2.0
    assert knn_matrix(spark, matrix) == pytest.approx(brute_force(matrix, 5))


@pytest.mark.parametrize("projected", [0, 64])
def test_knn_broadcasts_no_questions(spark, monkeypatch, projected):
    """The cells that questions reach are many times the questions' file, by whose size the planner would broadcast them."""
    monkeypatch.setattr(knn, "PROJECTED", projected)
    random = np.random.default_rng(5)
    matrix = random.random((80, 3))
    matrix[random.random((80, 3)) < 0.2] = np.nan
    names = ["a", "b", "c"]
    frame = spark.createDataFrame(
        [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(matrix)], "key long, a double, b double, c double")
    plan = knn.knn_impute(frame, "key", names)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("projected", [0, 64])
def test_knn_joins_no_pairs(spark, monkeypatch, projected):
    """All pairs of a question and a donor of its cells were rows of a join, sorted to be ranked: 40 GB on the disk at 60 times sf0.1."""
    monkeypatch.setattr(knn, "PROJECTED", projected)
    frame = spark.createDataFrame([(i, i / 9 if i % 4 else None, i % 5 + 0.5) for i in range(60)], "key long, a double, b double")
    plan = knn.knn_impute(frame, "key", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("cell#" in line for line in joins)
    assert "MapInArrow" in plan


@pytest.mark.parametrize("projected", [0, 64])
def test_knn_with_text_keys_in_small_batches(spark, monkeypatch, projected):
    """Few rows and pairs at a time, one value that is as near as others many times: the smaller keys are taken."""
    monkeypatch.setattr(knn, "PROJECTED", projected)
    monkeypatch.setattr(knn_cells, "PAIRS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        random = np.random.default_rng(6)
        matrix = np.round(random.random((150, 3)), 1)
        matrix[random.random((150, 3)) < 0.15] = np.nan
        data = [(f"k{i:03}", *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(matrix)]
        frame = spark.createDataFrame(data, "key string, a double, b double, c double").repartition(3)
        filled = knn.knn_impute(frame, "key", ["a", "b", "c"]).orderBy("key").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [row.key for row in filled] == [row[0] for row in data]
    assert np.array([tuple(row)[1:] for row in filled], dtype=float) == pytest.approx(brute_force(matrix, 5))


def test_knn_with_a_coarse_sample(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 4)
    monkeypatch.setattr(knn, "SAMPLE_PER_CELL", 1)
    random = np.random.default_rng(5)
    matrix = random.random((120, 2))
    matrix[:15, 0] = np.nan
    assert knn_matrix(spark, matrix) == pytest.approx(brute_force(matrix, 5))


def test_knn_edges(spark):
    few = np.array([[1.0, np.nan], [2.0, 4.0], [9.0, 8.0]])
    assert knn_matrix(spark, few).tolist() == [[1.0, 6.0], [2.0, 4.0], [9.0, 8.0]]
    apart = np.array([[1.0, np.nan], [np.nan, 4.0], [np.nan, 8.0]])
    assert knn_matrix(spark, apart).tolist() == [[1.0, 6.0], [1.0, 4.0], [1.0, 8.0]]
    whole = np.array([[1.0, 2.0]])
    assert knn_matrix(spark, whole).tolist() == [[1.0, 2.0]]


def test_staged_rows_go_with_their_block(spark):
    from pathlib import Path

    from reelforge.operators import durable
    folder = Path(durable.shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    with durable.staging(spark):
        kept = durable.settle(spark.range(5))
        assert kept.count() == 5 and len(set(folder.iterdir()) - before) == 1
        with pytest.raises(ValueError), durable.staging(spark):
            durable.settle(spark.range(3))
            raise ValueError
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before


def test_levels_match_plain_python(spark):
    rows = [(a, b, v) for i, (a, b) in enumerate([("x", 1), ("x", 1), ("x", None), (None, 2), ("y", 2), (None, None), ("", 1)]) for v in (float(i), float(i * i), None, 7.5)]
    frame = spark.createDataFrame(rows, "a string, b int, v double")
    found = sorted(map(tuple, profile.level_profile(frame, ["a", "b"], "v").collect()), key=repr)
    expected = []
    for level, key in (("a,b", lambda r: r[:2]), ("a", lambda r: (r[0], None)), ("b", lambda r: (None, r[1])), ("", lambda r: (None, None))):
        for group in {key(r) for r in rows}:
            values = sorted(r[2] for r in rows if key(r) == group and r[2] is not None)
            middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
            expected.append((level, *group, sum(key(r) == group for r in rows), pytest.approx(sum(values) / len(values)), pytest.approx(middle)))
    assert len(found) == len(expected)
    for row in expected:
        assert any(row == other for other in found), row
    some = profile.level_profile(frame, ["a", "b"], "v", profile.rollup_levels(["a", "b"]))
    assert {r.level for r in some.select("level").distinct().collect()} == {"a,b", "a", ""}
