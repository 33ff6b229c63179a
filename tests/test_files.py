"""Readers and writers, on files made here."""

import json

import pytest
from pyspark.sql import functions as F

from reelforge.functions.text import csv_cells
from reelforge.operators import documents
from reelforge.sinks import files as sinks
from reelforge.sinks.parts import Conflict, Parts
from reelforge.sources import files as sources


def rows_of(frame, *order):
    return [tuple(row) for row in (frame.orderBy(*order) if order else frame).collect()]


def text_of(path, pattern="part-*"):
    return "".join(part.read_text() for part in sorted(path.glob(pattern)))


HEADER = ",tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes"


def test_titles(spark, tmp_path):
    train = tmp_path / "train"
    train.mkdir()
    (train / "train-1.csv").write_text(HEADER + ',label\n3,tt3,"A, ""b""",,\\N,1999,90,10.0,True\n')
    (train / "train-2.csv").write_text(HEADER + ",label\n1,tt1,Amélie,NULL,2000,\\N,\\N,,False\n")
    (train / "train-0.csv").write_text(HEADER + ",label\n9,tt9,x,x,2000,\\N,1,1,False\n")
    hidden = tmp_path / "hidden.csv"
    hidden.write_text(HEADER + "\n2,tt2,C,C,2001,\\N,80,NaN\n")
    titles = sources.read_all_titles(spark, str(train), str(hidden), str(hidden), skip_files=r"-0\.csv$")
    assert rows_of(titles, "split", "row_id") == [
        (2, "tt2", "C", "C", "2001", None, "80", None, None, "test"),
        (1, "tt1", "Amélie", None, "2000", None, None, None, "False", "train"),
        (3, "tt3", 'A, "b"', None, None, "1999", "90", 10.0, "True", "train"),
        (2, "tt2", "C", "C", "2001", None, "80", None, None, "validation"),
    ]


def test_countries_keep_text(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text(
        "name,alpha-2,alpha-3,country-code,iso_3166-2,region,sub-region,intermediate-region,region-code,sub-region-code,intermediate-region-code\n"
        'Namibia,NA,NAM,516,ISO 3166-2:NA,Africa,x,"",002,202,018\n"Bonaire, Saba",BQ,BES,004,x,Americas,x,y,019,419,029\n'
        'Antarctica,AQ,ATA,010,x,"","","","","",""\n')
    frame = sources.read_countries(spark, str(path))
    assert rows_of(frame.select("name", "`alpha-2`", "`country-code`", F.coalesce("region", F.lit("")).alias("region")), "name") == [
        ("Antarctica", "AQ", "010", ""), ("Bonaire, Saba", "BQ", "004", "Americas"), ("Namibia", "NA", "516", "Africa")]


def test_credits_both_layouts(spark, tmp_path):
    lines = tmp_path / "directing.json"
    lines.write_text('{"movie":"m1","director":"d1"}\n{"tconst":"m2","director_id":"d2"}\n')
    assert rows_of(sources.read_credits(spark, str(lines), "director"), "movie") == [("m1", "d1"), ("m2", "d2")]
    columnar = tmp_path / "writing.json"
    columnar.write_text(json.dumps({"movie": {"0": "m1", "1": "m2"}, "writer": {"0": "w1", "1": "w2"}}))
    assert rows_of(sources.read_columnar_credits(spark, str(columnar), "writer"), "movie") == [("m1", "w1"), ("m2", "w2")]


def test_items(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text('name,price,quantity\nPhone,100,1\n"Cable, long",10.5,x\n')
    items = sources.read_items(spark, str(path))
    assert rows_of(items, "name") == [("Cable, long", 10.5, None, '"Cable, long",10.5,x'), ("Phone", 100.0, 1, None)]


def test_id_map_round_trip(spark, tmp_path):
    id_map = spark.createDataFrame([("tt1", 1), ("tt2", 2), ("tt3", 3)], "imdb_id string, tmdb_id long")
    sinks.write_id_map(id_map, str(tmp_path / "map"), ids_per_object=1)
    assert rows_of(sources.read_id_map(spark, str(tmp_path / "map")), "imdb_id") == [("tt1", 1), ("tt2", 2), ("tt3", 3)]
    (tmp_path / "old.json").write_text(json.dumps({"tt4": 4, "tt5": 5}, indent=2))
    assert rows_of(sources.read_id_map(spark, str(tmp_path / "old.json"), indented=True), "imdb_id") == [("tt4", 4), ("tt5", 5)]


def test_documents(spark, tmp_path):
    path = tmp_path / "documents.json"
    path.write_text('{"tt1": {"popularity": 1.5, "genres": [{"id": 1, "name": "War"}]}, "tt2": {}}\n')
    frame = sources.read_documents(spark, str(path))
    assert rows_of(frame.select("id", "document.popularity", "document.genres.name"), "id") == [
        ("tt1", 1.5, ["War"]), ("tt2", None, None)]


def test_wide_series(spark, tmp_path):
    folder = tmp_path / "series"
    folder.mkdir()
    (folder / "0.csv").write_text('date,"The One, again",Two,Anchor,isPartial\n2020-01-05,1,2,50,False\n2020-01-12,3,,50,False\n')
    (folder / "1.csv").write_text("date,Anchor,Three,isPartial\n2020-01-05,25,10,False\n")
    long = sources.read_wide_series(spark, str(folder))
    got = [(source, str(date), series, value) for source, date, series, value in rows_of(long, "source", "date", "series")]
    assert got == [
        ("0.csv", "2020-01-05", "Anchor", 50.0), ("0.csv", "2020-01-05", "The One, again", 1.0), ("0.csv", "2020-01-05", "Two", 2.0),
        ("0.csv", "2020-01-12", "Anchor", 50.0), ("0.csv", "2020-01-12", "The One, again", 3.0),
        ("1.csv", "2020-01-05", "Anchor", 25.0), ("1.csv", "2020-01-05", "Three", 10.0)]


def test_one_wide_frame(spark):
    wide = spark.createDataFrame([("d1", 1.0, 2.0)], "date string, a double, b double")
    assert rows_of(sources.union_wide_frame(wide, "date", 4), "series") == [("d1", "a", 1.0, 4), ("d1", "b", 2.0, 4)]


def test_parquet_append_and_select(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([("a", 1)], "k string, v int")
    sinks.write_parquet(frame, path)
    sinks.write_parquet(frame, path)
    assert rows_of(sources.read_table(spark, path, "k")) == [("a",), ("a",)]


def test_delimited_text(spark, tmp_path):
    frame = spark.createDataFrame([("a", ["x", "y"], 1.5)], "k string, g array<string>, v double")
    sinks.write_delimited(frame, str(tmp_path / "out"))
    assert text_of(tmp_path / "out").splitlines()[0] == "k;g;v"
    back = spark.read.csv(str(tmp_path / "out"), sep=";", header=True)
    assert rows_of(back) == [("a", '["x","y"]', "1.5")]


def test_predictions_keep_input_order(spark, tmp_path):
    frame = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).alias("prediction")).orderBy(F.rand(1))
    sinks.write_predictions(frame, str(tmp_path / "predictions"))
    assert text_of(tmp_path / "predictions").split() == [str(i % 3 == 0) for i in range(500)]


def test_labels_and_pairs(spark, tmp_path):
    frame = spark.createDataFrame([("tt1", True, "a, b", 1.5)], "tconst string, label boolean, t string, v double")
    sinks.write_labels(frame.coalesce(1), str(tmp_path / "labels"), "tconst", "label")
    assert text_of(tmp_path / "labels") == "tconst,label\ntt1,true\n"
    sinks.write_pairs(frame, str(tmp_path / "pairs"), "t", "v")
    assert text_of(tmp_path / "pairs") == '"a, b",1.5\n'


def test_reject_log_grows_once(spark, tmp_path):
    path = str(tmp_path / "rejects")
    lost = spark.createDataFrame([("a", "no match"), ("a", "no match")], "id string, reason string")
    sinks.log_rejects(lost, path)
    sinks.log_rejects(lost.union(spark.createDataFrame([("b", "no match")], lost.schema)), path, spark.read.parquet(path))
    assert rows_of(spark.read.parquet(path), "id") == [("a", "no match"), ("b", "no match")]


def test_batches_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "batches")
    sinks.write_batches(spark.createDataFrame([(1, 1.0), (2, 2.0)], "batch_id int, v double"), path)
    sinks.write_batches(spark.createDataFrame([(2, 9.0)], "batch_id int, v double"), path)
    assert rows_of(sinks.read_batches(spark, path).select("batch_id", "v"), "batch_id") == [(1, 1.0), (2, 9.0)]
    sinks.write_batches(spark.createDataFrame([(2500, 3.0), (None, 4.0)], "batch_id int, v double"), path)
    assert len(sinks.read_batches(spark, path).collect()) == 4
    assert len(Parts(spark, path).tidy()) == 1 and len(sinks.read_batches(spark, path).collect()) == 4


def test_a_failed_write_leaves_the_old_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "batches")
    assert sinks.read_batches(spark, path) is None
    sinks.write_batches(spark.createDataFrame([(1, 1.0), (2, 2.0)], "batch_id int, v double"), path)
    broken = spark.createDataFrame([(1, 5.0), (2, 0.0)], "batch_id int, v double")
    broken = broken.withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("midway"))).otherwise(F.col("v")).cast("double"))
    with pytest.raises(Exception, match="midway"):
        sinks.write_batches(broken, path)
    written = []
    monkeypatch.setattr(Parts, "commit", lambda *args: written.append(args) or (_ for _ in ()).throw(OSError("lost the driver")))
    with pytest.raises(OSError):
        sinks.write_batches(spark.createDataFrame([(1, 7.0)], "batch_id int, v double"), path)
    monkeypatch.undo()
    assert written and rows_of(sinks.read_batches(spark, path), "batch_id") == [(1, 1.0), (2, 2.0)]


def test_two_writers_of_one_range(spark, tmp_path):
    """The later one fails; nothing that was committed is lost."""
    path = str(tmp_path / "batches")
    sinks.write_batches(spark.createDataFrame([(1, 1.0)], "batch_id int, v double"), path)
    table = Parts(spark, path)
    number, parts = table.state()
    sinks.write_batches(spark.createDataFrame([(2, 2.0)], "batch_id int, v double"), path)
    with pytest.raises(Conflict):
        table.commit(number, {**parts, "0": "data-of-the-slower-writer"})
    assert rows_of(sinks.read_batches(spark, path), "batch_id") == [(1, 1.0), (2, 2.0)]


def test_append_of_new_documents(spark, tmp_path):
    known = spark.createDataFrame([("t1", 1.0)], "tconst string, popularity double")
    new = spark.createDataFrame([("t2", 1), (None, 0)], "tconst string, war int")
    sinks.write_parquet(documents.append_features(known, new), str(tmp_path / "features"), mode="errorifexists")
    assert rows_of(spark.read.parquet(str(tmp_path / "features")), "tconst") == [("t1", 1.0, None), ("t2", None, 1)]


def test_faulty_title_lines_are_rejected(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(",tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes,label\n"
                    "0,t0,A,,2000,\\N,90,5.0,True\nnone,t1,B,,2001,\\N,91,6.0,False\n2,t2,C\n3,t3,D,,2002,\\N,92,7.0,True\n")
    assert [r.tconst for r in sources.read_titles(spark, str(path), "train").select("tconst").collect()] == ["t0", "t3"]
    rejects = sources.title_rejects(spark, str(path), "train").collect()
    assert sorted(r.id.split(",")[1] if "," in r.id else r.id for r in rejects) == ["t1", "t2"]


def test_series_of_any_width_and_header(spark):
    names = ["week", *(f"s{i}" for i in range(12))]
    lines = [("a", ",".join(names)), ("a", "2020-01-05," + ",".join(str(i) for i in range(12))), ("a", "2020-01-12,1,True,x"),
             ("a", "2020-01-19," + ",".join("1" * 13)), ("a", "soon,1"), ("b", "2020-01-05,1,2"), ("a", "2020-01-26,5,,")]
    frame = spark.createDataFrame(lines, "file string, text string")
    long = sources.wide_lines_to_long(frame, "file", "text", "week")
    assert sorted((str(r.date), r.series, r.value) for r in long.collect()) == sorted(
        [("2020-01-05", f"s{i}", float(i)) for i in range(12)] + [("2020-01-12", "s0", 1.0), ("2020-01-26", "s0", 5.0)])
    rejects = {(r.id, r.reason) for r in sources.wide_line_rejects(frame, "file", "text", "week").collect()}
    assert rejects == {("a", "not a number"), ("a", "more cells than the header"), ("a", "no date"), ("b", "no header")}


def test_one_object_is_read_by_many_tasks(spark, tmp_path):
    """One large object, cut at commas and put together again, commas and quotes inside texts too."""
    names = {str(i): [f"n{i}", f"a, b {i}", 'say "x, y"', "back\\\\", '\\\\",', "{,}", "é, 漢", "", None][i % 9] for i in range(400)}
    movies = {str(i): f"tt{i}" for i in range(0, 400)}
    (tmp_path / "one.json").write_text(json.dumps({"tconst": movies, "writer_id": names, "empty": {}}))
    (tmp_path / "two.json").write_text(json.dumps({"movie": {"5": "x, y"}, "writer": {}}, indent=2) + "\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
        assert spark.read.text(str(tmp_path / "one.json"), lineSep=",").rdd.getNumPartitions() > 10
        found = sources.read_columns(spark, str(tmp_path), rows_per_bucket=50)
        rows = {(r.file.rsplit("/", 1)[1], r.column, r["index"]): r.value for r in found.collect()}
        credits = sources.read_columnar_credits(spark, str(tmp_path), "writer").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert rows == {**{("one.json", "tconst", i): v for i, v in movies.items()}, **{("one.json", "writer_id", i): v for i, v in names.items()}, ("two.json", "movie", "5"): "x, y"}
    assert sorted(map(tuple, credits), key=repr) == sorted([(movies[i], names[i]) for i in movies] + [("x, y", None)], key=repr)


def test_one_line_of_many_cells_costs_no_other_file_anything(spark):
    lines = [("a", "date,x,y"), ("a", "2020-01-05,1,2"), ("a", "2020-01-06," + "7," * 50_000 + "8"), ("b", 'date,"q, ""z"""'), ("b", "2020-01-07,4"),
             ("b", '"2020-01-08","5"'), ("b", "2020-01-09,,,,"), ("b", '2020-01-10,"open'), ("b", None), ("b", "")]
    frame = spark.createDataFrame(lines, "file string, text string")
    assert "from_csv" not in sources.wide_lines_to_long(frame, "file", "text")._jdf.queryExecution().toString()
    long = sorted((r.file, str(r.date), r.series, r.value) for r in sources.wide_lines_to_long(frame, "file", "text").collect())
    assert long == [("a", "2020-01-05", "x", 1.0), ("a", "2020-01-05", "y", 2.0), ("b", "2020-01-07", 'q, "z"', 4.0), ("b", "2020-01-08", 'q, "z"', 5.0)]
    rejects = [(r.id, r.reason) for r in sources.wide_line_rejects(frame, "file", "text").collect()]
    assert ("a", "more cells than the header") in rejects and ("b", "not a number") in rejects


@pytest.mark.parametrize("line", ["a,b", "", ",", ",a", "a,,", '"x,y",z', '"say ""hi""",2', ',,"",3', '"open, 1', 'a"b,c', "é,漢", '"",'])
def test_cells_match_a_csv_reader(spark, line):
    import csv
    expected = next(csv.reader([line]), [""]) or [""]
    while len(expected) > 1 and expected[-1] == "":
        expected.pop()
    if line == '"open, 1':
        expected = ['"open', " 1"]  # a quote that is never closed is a letter
    found = spark.range(1).select(csv_cells(F.lit(line)).alias("cells")).first()["cells"]
    assert [cell or "" for cell in found] == expected


ODD_OBJECTS = [
    '{"a": 1, "b": "x"}', ' {"a":-7,\t"a" : 0}\n', '{"a": ""}', '{"": "y"}', '{}', '{"a": 01}', '{"a": -0}', '{"a": 1.50}', '{"a": 1e3}', '{"a": null, "b": true}',
    '{"a": "q\\"r"}', '{"a": "t\\u00e9"}', '{"a": "x\ty"}', "{'a': 1}", '{"a": 1,}', '{"a": 1} tail', '{"a" 1}', '{"a": {"b": 1.50, "c": "d, \\"e\\": 2"}}',
    '{"a": {"b": 1, "c": "d"}, "e": {}}', '{"a": {"vote_count": "x"}, "b": {"genres": 1}, "c": 2.5, "d": "no"}', '{"a": [1, 2]}', '[1]', '"t"', "7", "", " ", "{", None,
    '{"a": "' + "x" * 3000 + '"}', '{"\u00e9\u6f22": 12345678901234567890}', '{"a": 1}\x0b']


def test_entries_cut_by_pattern_are_those_of_the_parser(spark, monkeypatch):
    rows = spark.createDataFrame([(text,) for text in ODD_OBJECTS], "value string")

    def everything():
        return [sorted(map(tuple, frame.collect()), key=repr) for frame in (
            documents.map_entries(rows), documents.id_map_rejects(rows), documents.id_map_rows(rows), documents.document_map_rejects(rows))]

    cut = everything()
    monkeypatch.setattr(documents, "SHORT_OBJECT", -1)
    assert cut == everything()


def test_objects_and_lines_are_parsed_once(spark):
    rows = spark.createDataFrame([('{"a": 1}',)], "value string")
    plan = documents.document_map_rejects(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapType(StringType,StringType,true)") + plan.count("map<string,string>") <= 1 and "Union" not in plan
    lines = spark.createDataFrame([("a", "date,x"), ("a", "2020-01-05,1")], "file string, text string")
    plan = sources.wide_line_rejects(lines, "file", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_one_bad_entry_loses_nothing_else(spark):
    rows = spark.createDataFrame([('{"b": 2, "c": "x", "d": null}',), ("{broken",), (None,)], "value string")
    assert rows_of(documents.id_map_rows(rows), "imdb_id") == [("b", 2)]
    assert rows_of(documents.id_map_rejects(rows), "id") == [
        ("c", "not a whole number"), ("d", "not a whole number"), ("{broken", "malformed object")]
    mapped = spark.createDataFrame([('{"t1": {"popularity": 1.5}, "t2": 7, "t3": {"genres": 1}}',), ("[",)], "value string")
    assert ("t1", 1.5) in rows_of(documents.document_map_rows(mapped).select("id", "document.popularity"), "id")
    assert {("t2", "malformed"), ("[", "malformed object")} <= set(rows_of(documents.document_map_rejects(mapped), "id"))
