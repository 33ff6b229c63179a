import re

import pytest
from pyspark.sql import functions as F

from reelforge.llm import contamination as c
from reelforge.operators import joins

from .conftest import with_clashing_columns

LOWER = {code: code + 32 for code in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + size]), set()).add("" if item is None else str(item))
    found = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for window, owners in windows.items():
            n = len(window)
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) == window:
                    hit.update(range(at, at + n))
                    named |= owners
        found.append((doc_id, len(w), len(hit), sorted(named)))
    return sorted(found, key=repr)


def rows_of(frame):
    rows = frame.collect()
    for row in rows:
        assert sum(s.end - s.start for s in row.spans) == row.n_hit
        assert all(a.end < b.start for a, b in zip(row.spans, row.spans[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows), key=repr)


ITEM = "One two three four five six seven eight nine ten eleven twelve"
ITEMS = [(10, ITEM), (9, "short item"), (9, "another text of id nine with more than ten words in it all"), (None, "null id has words enough"),
         (3, None), (4, "..."), (5, "solo"), (6, "a b a b a b a b a b a b"), (7, ITEM), (8, "É naïve É naïve 漢字 x")]
DOCS = [(1, f"before {ITEM.upper()} after"), (2, "one two three four five six seven eight nine TEN"), (3, "one two three four five six seven eight nine"),
        (4, None), (5, ""), (6, "...!"), (7, "a short, item! and short\nitem solo"), (8, "a b " * 40), (9, "é naïve É naïve 漢字 x É NAïVE É naïve 漢字 X"),
        (10, "É naïve É naïve 漢字 x"), (None, "null id has words enough"), (None, None), (7, "other text, same id: solo"), (11, "solo " * 5000 + ITEM),
        (1, f"before {ITEM.upper()} after"), (12, "one-two_three four;five six seven eight nine ten eleven twelve thirteen")]


@pytest.mark.parametrize("size,shingle", [(10, 3), (10, 1), (4, 2), (1, 3)])
@pytest.mark.parametrize("broadcast", [True, False])
def test_matches_brute_force(spark, monkeypatch, size, shingle, broadcast):
    if not broadcast:  # everything by shuffle, with salts
        monkeypatch.setattr(c, "broadcast_if_small", lambda df, *rest: df)
        monkeypatch.setattr(joins.spread_join, "__defaults__", ("left", 50, 0))
    docs = with_clashing_columns(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("window", F.lit(1)).withColumn("key", F.lit(2))
    assert rows_of(c.contamination(docs, items, size, shingle)) == brute_force(DOCS, ITEMS, size)


def test_empty_tables(spark, no_docs):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows_of(c.contamination(docs, nothing)) == brute_force(DOCS, [], 10)
    assert rows_of(c.contamination(docs, items.where("item_id IN (3, 4)"))) == brute_force(DOCS, [], 10)
    assert c.contamination(no_docs, items).count() == 0


def test_corpus(spark, corpus, small_dir):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    found = rows_of(c.contamination(corpus, items))
    assert found == brute_force(docs, [(r.item_id, r.text) for r in items.collect()], 10)


def test_a_passage_in_a_third_of_all_rows(spark):
    rows = [(i, f"word{i} {ITEM} more" if i % 3 == 0 else f"clean text number {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = c.contamination(docs, items).where("n_hit > 0").agg(F.count("*"), F.min("n_hit"), F.max("n_hit")).first()
    assert tuple(found) == (1000, 12, 12)


def test_no_python_in_the_plan(spark, small_dir):
    plan = c.op12_benchmark_decontamination(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
