"""Column functions on invented edge rows."""

from pyspark.sql import functions as F

from reelforge.constants import ACCENT_MAP, GENRES
from reelforge.functions import missing, nested, numeric, text
from reelforge.schemas import DOCUMENT, ITEMS_CSV


def values(spark, schema, rows, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_sentinels_nan_and_null_are_one(spark):
    rows = [(r"\N",), ("NULL",), ("",), ("nan",), ("NaN",), (None,), ("x",), ("12",), ("1.5",)]
    got = values(spark, "t string", rows, missing.to_null("t"), missing.to_int("t"), missing.to_double("t"),
                 missing.int_or_default("t", -1), missing.text_or_empty("t"))
    assert got[:6] == [(None, None, None, -1, "")] * 6
    assert got[6:] == [("x", None, None, -1, "x"), ("12", 12, 12.0, 12, "12"), ("1.5", 1, 1.5, 1, "1.5")]


def test_first_int_takes_the_misplaced_year(spark):
    rows = [(r"\N", "1999"), ("nan", "2001"), (r"\N", r"\N"), ("1980", "1990"), ("abc", None)]
    assert values(spark, "a string, b string", rows, missing.first_int("a", "b")) == [
        (1999,), (2001,), (None,), (1980,), (None,)]


def test_fold_accents(spark):
    rows = [("Amélie ß",), ("ớ Ớ å",), ("plain",), (None,), ("a=b{c}",)]
    assert values(spark, "t string", rows, text.fold_accents("t")) == [
        ("Amelie S",), ("o O a",), ("plain",), (None,), ("a=b{c}",)]
    assert len(ACCENT_MAP) == 39 and all(len(k) == len(v) == 1 for k, v in ACCENT_MAP.items())


def test_special_chars(spark):
    rows = [("Amélie = {ß}!",), ("all ok (1) [2] ^*",)]
    got = values(spark, "t string", rows, text.special_chars("t"), text.special_char_list("t"))
    assert got == [("é={ß}", ["é", "=", "{", "ß", "}"]), ("", [])]


def test_code_point(spark):
    rows = [("ớ",), ("é",), ("A",), ("😀",)]
    assert values(spark, "t string", rows, text.code_point("t")) == [("U+1EDB",), ("U+00E9",), ("U+0041",), ("U+1F600",)]


def test_names_letters_and_foreign_titles(spark):
    assert values(spark, "t string", [("Science Fiction",)], text.snake_case("t"), text.is_ascii_letter("t")) == [
        ("science_fiction", True)]
    rows = [("a", "a"), ("a", "b"), ("a", ""), ("a", None)]
    assert values(spark, "p string, o string", rows, text.is_foreign("p", "o")) == [(False,), (True,), (False,), (False,)]


def test_integer_valued(spark):
    rows = [("5.0",), ("5.5",), ("x",), ("7",), (None,), ("NaN",), ("Infinity",)]
    assert [r[0] for r in values(spark, "t string", rows, numeric.is_integer_valued("t"))] == [
        True, False, False, True, False, False, False]


def test_amounts_and_rescaling(spark):
    got = values(spark, "p double, q int, own double", [(100.0, 3, 25.0), (10.0, 0, 0.0)],
                 numeric.total_price("p", "q"), numeric.discounted("p"), numeric.rescale("p", F.lit(50.0), "own"))
    assert got == [(300.0, 80.0, 200.0), (0.0, 8.0, None)]


def test_broken_rules(spark):
    rules = {"price >= 0": F.col("price") >= 0, "quantity >= 0": F.col("quantity") >= 0}
    rows = [(1.0, 1), (-1.0, 1), (-1.0, -1), (None, 1)]
    assert [r[0] for r in values(spark, "price double, quantity int", rows, numeric.broken_rules(rules))] == [
        [], ["price >= 0"], ["price >= 0", "quantity >= 0"], ["price >= 0"]]


def test_item_lines(spark):
    rows = [('"a, b",1.5,3',), ("c,x,3",), ("d,2.0,1.5",)]
    item = nested.parse_line("line", ITEMS_CSV)
    got = values(spark, "line string", rows, item["name"], item["price"], item["quantity"], item[nested.CORRUPT].isNotNull())
    assert got == [("a, b", 1.5, 3, False), ("c", None, 3, True), ("d", 2.0, None, True)]


def test_documents(spark):
    rows = [('{"imdb_id": "t1", "genres": [{"name": "War"}, {"name": "War"}], "production_countries": [{"iso_3166_1": "US"}]}',),
            ('{"imdb_id": "t2", "genres": []}',), ('{"imdb_id": "t3"',)]
    document = nested.parse_document("d", DOCUMENT)
    names = {"war": "War", "drama": "Drama"}
    genres = nested.field_of_each(document["genres"], "name")
    got = values(spark, "d string", rows, document["imdb_id"], document[nested.CORRUPT].isNotNull(), genres,
                 nested.first_or_null(document["production_countries"])["iso_3166_1"],
                 *nested.indicator_columns(genres, names), *nested.count_columns(genres, names))
    assert got == [
        ("t1", False, ["War", "War"], "US", 1, 0, 2, 0),
        ("t2", False, [], None, 0, 0, 0, 0),
        (None, True, [], None, 0, 0, 0, 0),
    ]


def test_missing_fields(spark):
    frame = spark.createDataFrame([(("a", None),)], "d struct<x:string,y:string>")
    assert frame.select(nested.missing_fields(F.col("d"), ["x", "y"])).first()[0] == ["y"]


def test_genres():
    assert len(GENRES) == 19
