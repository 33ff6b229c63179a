"""Streams: restarts, batches that run again, repeats and late data."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from reelforge.operators import documents
from reelforge.sinks.parts import Parts
from reelforge.streaming import enrichment, rejects


def document(key, votes=1):
    return json.dumps({"imdb_id": key, "original_language": "en", "popularity": 1.0, "revenue": 1, "runtime": 90, "vote_average": 5.0,
                       "vote_count": votes, "genres": [{"id": 1, "name": "Drama"}], "production_countries": [{"iso_3166_1": "n1"}]})


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / name) for name in ("landing", "table", "offsets")]


@pytest.fixture
def countries(spark):
    return spark.createDataFrame([("N1", "Europe")], "`alpha-2` string, region string")


def run(spark, countries, places, **settings):
    landing, path, checkpoint = places
    enrichment.enrich(enrichment.landed_responses(spark, landing, **settings), countries, path, checkpoint).awaitTermination()


def land(spark, rows, landing):
    enrichment.land(spark.createDataFrame(rows, "id string, payload string").coalesce(1), landing)


def keys(spark, path):
    return sorted(r.tconst for r in enrichment.streamed_features(spark, path).collect())


def test_each_file_is_worked_off_once(spark, countries, places):
    land(spark, [("t1", document("t1")), ("t2", document("t2")), ("t3", "{broken")], places[0])
    land(spark, [("t1", document("t1", 9)), ("t4", document(None)), (None, document("t5")), ("t6", None)], places[0])
    run(spark, countries, places, files_per_batch=1)
    assert keys(spark, places[1]) == ["t1", "t2", "t5"]
    before = enrichment.feature_parts(spark, places[1]).state()
    run(spark, countries, places)
    assert enrichment.feature_parts(spark, places[1]).state() == before  # nothing new, nothing written
    land(spark, [("t2", document("t2", 7)), ("t7", document("t7"))], places[0])
    run(spark, countries, places)
    table = {r.tconst: r for r in enrichment.streamed_features(spark, places[1]).collect()}
    assert sorted(table) == ["t1", "t2", "t5", "t7"]
    assert table["t2"].vote_count == 1 and table["t7"].continent == "Europe" and table["t7"].drama == 1
    found = sorted((r.id, r.reason) for r in enrichment.streamed_rejects(spark, places[1]).collect())
    assert ("t3", "malformed") in found and ("t4", "missing imdb_id") in found and len(found) == len(set(found))


def test_a_run_cut_off_midway_goes_on_without_loss_or_repeats(spark, countries, places, monkeypatch):
    land(spark, [("t1", document("t1")), ("bad", "{")], places[0])
    put, calls = Parts.put, []

    def failing(self, part, rows):
        put(self, part, rows)
        calls.append(part)
        if len(calls) == 1:  # rejects are in, features are not
            raise OSError("lost the driver")

    monkeypatch.setattr(Parts, "put", failing)
    with pytest.raises(Exception, match="lost the driver"):
        run(spark, countries, places)
    land(spark, [("t2", document("t2"))], places[0])
    run(spark, countries, places)
    assert calls[0] == calls[1]  # the same batch again
    assert keys(spark, places[1]) == ["t1", "t2"]
    assert [r.id for r in enrichment.streamed_rejects(spark, places[1]).collect()] == ["bad"]


def test_a_batch_that_runs_again_gives_the_same_part(spark, countries, places):
    batch = spark.createDataFrame([("t1", document("t1")), ("t1", document("t1")), ("x", "{")], "id string, payload string")
    for _ in range(2):
        enrichment.add_batch(batch, 0, countries, places[1])
    enrichment.add_batch(batch, 1, countries, places[1])
    assert keys(spark, places[1]) == ["t1"]
    assert enrichment.streamed_rejects(spark, places[1]).count() == 1
    assert enrichment.feature_parts(spark, places[1]).read().count() == 1


def test_stream_equals_batch(spark, countries, places):
    rows = [(f"t{i}", document(f"t{i}", i)) for i in range(50)]
    for start in range(0, 50, 10):
        land(spark, rows[start : start + 10], places[0])
    run(spark, countries, places, files_per_batch=2)
    batch = documents.external_features(documents.parse_documents(spark.createDataFrame(rows, "id string, payload string")), countries)
    assert sorted(batch.collect()) == sorted(enrichment.streamed_features(spark, places[1]).select(*batch.columns).collect())


DAY = datetime.datetime(2024, 1, 1)


def reject(key, day):
    return (key, "no document", DAY + datetime.timedelta(days=day))


def land_rejects(spark, rows, landing):
    spark.createDataFrame(rows, "id string, reason string, at timestamp").coalesce(1).write.mode("append").parquet(landing)


def test_rejects_are_logged_once_under_a_watermark(spark, places):
    landing, path, checkpoint = places
    seen = []
    for rows in ([reject("a", 1), reject("a", 1), reject("b", 2)], [reject("a", 3), reject("c", 40)], [reject("late", 5), reject("b", 41), reject("d", 42)], [reject("a", 90)]):
        land_rejects(spark, rows, landing)
        rejects.log_stream(rejects.landed_rejects(spark, landing), path, checkpoint, "10 days").awaitTermination()
        seen.append(sorted(r.id for r in rejects.logged_rejects(spark, path).collect()))
    assert seen == [["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"], ["a", "b", "c", "d"]]  # too late for the stream: "late"
    for _ in range(2):
        rejects.sweep(spark.read.parquet(landing), path)
        assert sorted(r.id for r in rejects.logged_rejects(spark, path).collect()) == ["a", "b", "c", "d", "late"]


def test_the_state_expires(spark, places):
    """Keys that the watermark has passed leave the state."""
    landing, path, checkpoint = places
    for day in (0, 100, 200, 300):
        land_rejects(spark, [reject(f"k{day}-{i}", day) for i in range(20)], landing)
        query = rejects.log_stream(rejects.landed_rejects(spark, landing), path, checkpoint, "1 day")
        query.awaitTermination()
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 40
    assert rejects.logged_rejects(spark, path).count() == 80
    assert rejects.once_each(spark.readStream.schema(rejects.REJECT_EVENTS).parquet(landing), "1 day").isStreaming


def test_nothing_landed(spark, countries, places):
    land(spark, [("t", document("t"))], places[0])
    assert enrichment.streamed_features(spark, places[1]) is None
    empty = spark.createDataFrame([], "id string, payload string")
    enrichment.add_batch(empty, 0, countries, places[1])
    assert enrichment.streamed_features(spark, places[1]).count() == 0
    assert enrichment.streamed_features(spark, places[1]).where(F.col("tconst").isNotNull()).count() == 0
