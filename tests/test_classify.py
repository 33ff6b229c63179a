"""From files to prediction files."""

import json

import pytest

from reelforge.operators.durable import broadcast_if_small, settle, shared_folder
from reelforge.plans import classify

HEADER = ",tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes"


def line(i: int) -> str:
    year, end = (r"\N", str(1990 + i % 30)) if i % 7 == 0 else (str(1990 + i % 30), r"\N")
    minutes = r"\N" if i % 11 == 0 else str(80 + i % 40)
    votes = "" if i % 13 == 0 else str(1000.0 + 10 * i)
    return f'{i},tt{i},"Título {i}, È",,{year},{end},{minutes},{votes}'


def is_good(i: int) -> bool:
    return i % 3 == 0


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("titles")
    (folder / "train").mkdir()
    train, validation, test = range(0, 240), range(240, 270), range(270, 300)
    for part in (1, 2):
        rows = [f"{line(i)},{is_good(i)}" for i in train if i % 2 == part - 1]
        (folder / "train" / f"train-{part}.csv").write_text("\n".join([HEADER + ",label", *rows]) + "\n")
    (folder / "train" / "train-0.csv").write_text(HEADER + ",label\n999,tt999,x,x,2000,\\N,1,1,True\n")
    for name, rows in (("validation", validation), ("test", test)):
        (folder / f"{name}.csv").write_text("\n".join([HEADER, *map(line, rows)]) + "\n")
    titles = classify.load_titles(
        spark, str(folder / "train"), str(folder / "validation.csv"), str(folder / "test.csv"), skip_files=r"-0\.csv$")
    responses = spark.createDataFrame([
        (f"tt{i}", json.dumps({
            "imdb_id": f"tt{i}", "original_language": "en", "popularity": 9.0 if is_good(i) else 1.0, "revenue": i,
            "runtime": 90, "vote_average": 5.0, "vote_count": i, "genres": [{"id": 1, "name": "War"}] if i % 2 else [],
            "production_countries": [{"iso_3166_1": "nl"}] if i % 5 else []}))
        for i in range(300) if i % 10 != 4], "id string, payload string")
    countries = spark.createDataFrame([("NL", "Europe")], "`alpha-2` string, region string")
    return titles, responses, countries


def test_titles_are_loaded_and_cleaned(inputs):
    titles, _, _ = inputs
    row = titles.where("tconst = 'tt7'").first()
    assert (row.primaryTitle, row.originalTitle, row.startYear, row.split) == ("Titulo 7, E", None, 1997, "train")
    assert titles.count() == 300 and titles.where("tconst = 'tt999'").count() == 0


def test_features_grow_without_repeats(inputs):
    _, responses, countries = inputs
    first = classify.extend_features(responses.where("id < 'tt2'"), countries)
    both = classify.extend_features(responses, countries, settle(first))
    assert both.count() == both.select("tconst").distinct().count() == 270
    assert sorted(r[0] for r in both.select("continent").distinct().collect()) == ["Europe", "World"]


def test_predictions_line_up_with_titles(inputs, tmp_path):
    titles, responses, countries = inputs
    rows = classify.model_rows(titles, classify.extend_features(responses, countries))
    fitted = classify.train(rows)
    for split, first in (("validation", 240), ("test", 270)):
        classify.predict_to(fitted, rows, titles, split, str(tmp_path / split))
        lines = "".join(p.read_text() for p in sorted((tmp_path / split).glob("part-*"))).split()
        assert lines == [str(is_good(i) or i % 10 == 4) for i in range(first, first + 30)]


def test_settled_rows_live_in_the_named_folder(spark):
    frame = settle(spark.range(5))
    assert all(name.removeprefix("file://").startswith(shared_folder(spark).removeprefix("file://")) for name in frame.inputFiles())
    assert "FileScan parquet" in frame._jdf.queryExecution().executedPlan().toString()


def test_only_small_sides_are_marked(spark):
    def hinted(frame):
        return "broadcast" in frame._jdf.queryExecution().logical().toString()

    assert hinted(broadcast_if_small(spark.range(5), 5)) and not hinted(broadcast_if_small(spark.range(6), 5))
