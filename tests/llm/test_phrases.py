import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reelforge.llm import phrases

from .conftest import with_clashing_columns

SCHEMA = "doc_id long, text string, lang string"


def brute_force(rows, least, most):
    counts, totals = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    found = []
    for lang, f in counts.items():
        longest = Counter()
        for gram, n in f.items():
            if n >= least:
                for size in range(2, len(gram)):
                    for at in range(len(gram) - size + 1):
                        part = gram[at : at + size]
                        longest[part] = max(longest[part], n)
        kept = []
        for gram, a in f.items():
            if len(gram) > 1 and a >= least and 100 * longest[gram] < 80 * a:
                score, _, l, r = min((2_000_000 * a // (f[gram[:k]] + f[gram[k:]]), k, f[gram[:k]], f[gram[k:]]) for k in range(1, len(gram)))
                kept.append((-score, -a, " ".join(gram).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def rows_of(frame):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert frame.columns == names
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture(scope="module")
def texts(spark):
    passage = " ".join(f"p{i}" for i in range(23))
    rows = [(i, f"The Cat sat on the mat, the cat sat. {passage} tail{i}\nnew york city new\tyork", "en") for i in range(12)]
    rows += [(100 + i, "a b c a b c a b c; É é à la", None) for i in range(5)] + [(200, None, "en"), (201, "", None), (202, ".,;", "fr"), (203, "a b a b", "fr")]
    rows += [(300, "x y z " * 3000, "de"), (301, "ß漢 字! ß漢 字", "de")] + [(400, "same row", "en")] * 7
    return rows


@pytest.mark.parametrize("least,most", [(1, 1000), (3, 1000), (5, 4), (10_000, 10)])
def test_collocations_match_brute_force(spark, texts, least, most):
    docs = with_clashing_columns(spark.createDataFrame(texts, SCHEMA))
    assert rows_of(phrases.collocations(docs, least, most)) == brute_force(texts, least, most)


def test_salts_and_small_blocks_change_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(phrases, "RANKED_AT_ONCE", 7)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 40)
    docs = spark.createDataFrame(texts, SCHEMA).repartition(5)
    assert rows_of(phrases.collocations(docs, 3, 6)) == brute_force(texts, 3, 6)


def test_counts_of_the_corpus(spark, corpus):
    rows = [(row.doc_id, row.text, row.lang) for row in corpus.select("doc_id", "text", "lang").collect()]
    found = phrases.collocations(corpus, 12, 50)
    assert rows_of(found.withColumn("rank", F.col("rank").cast("long"))) == brute_force(rows, 12, 50)


def test_paths_cover_every_frequent_edge_once(spark, texts):
    docs = spark.createDataFrame(texts, SCHEMA)
    counts = phrases.gram_counts(phrases.longest_grams(docs, 3))
    paths, inner = phrases.unary_paths(counts, 3)
    edges = {(r.lang, r.h1, r.h2, r.h3, r.h4): r.f for r in counts[4].where("f >= 3").collect()}
    found = paths.collect()
    spelled = [((p.lang, *p.hashes[i : i + 4]), p.f) for p in found for i in range(len(p.hashes) - 3)]
    assert len(spelled) == len(edges) and dict(spelled) == edges
    assert max(len(p.hashes) for p in found) >= 23  # the passage is one path
    middle = [(p.lang, *p.hashes[i : i + 3]) for p in found for i in range(1, len(p.hashes) - 3)]
    assert sorted(middle) == sorted((r.lang, r.h1, r.h2, r.h3) for r in inner.collect())


def test_a_word_with_two_meanings_of_its_hash_fails(spark, monkeypatch):
    monkeypatch.setattr(phrases.Hasher, "__call__", lambda self, raw, starts, ends: (ends - starts).astype("uint64"))
    docs = spark.createDataFrame([(i, "ab cd ab cd", "en") for i in range(5)], SCHEMA)
    edges = phrases.longest_grams(docs, 2)
    assert edges.columns  # workers hash for themselves: the guard below is on the table
    broken = edges.where("word IS NOT NULL").unionByName(edges.where("word IS NOT NULL").withColumn("word", F.lit("other")))
    assert broken.groupBy("h1").count().where("count > 1").count() > 0


def test_no_documents(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
