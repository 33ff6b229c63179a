import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelforge.llm import language, mixing, similar
from reelforge.llm.components import connected

from .conftest import COLUMNS, with_clashing_columns


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def by_brute_force(rows):
    """Links per row number, and the smallest row number of each component."""
    sets = [shingles(text) for _, text in rows]
    links, parent = Counter(), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return links, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("block", [8, 1 << 15])
def test_similar_documents_match_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK_NGRAMS", block)  # small blocks: classes meet across blocks
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base)), (1, " ".join(base).upper()), (2, None), (3, ""), (4, "two words"), (5, "two  words\n"), (6, "w")]
    for i in range(60):  # a large group of near copies, at all distances
        changed = list(base)
        for k in range(1 + i % 4):
            changed[(7 * i + 13 * k) % 60] = f"x{i}{k}"
        rows.append((100 + i, " ".join(changed)))
    rows += [(200 + i, " ".join(f"d{i}w{k}" for k in range(30))) for i in range(20)] + [(300 + i, rows[0][1]) for i in range(30)]
    links, roots = by_brute_force(rows)
    docs = with_clashing_columns(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in similar.similar_documents(docs).collect()}
    assert len(found) == len(rows)
    for at, (doc_id, _) in enumerate(rows):
        assert found[doc_id].n_links == links[at], doc_id
        assert found[doc_id].class_id == rows[roots[at]][0]
        assert found[doc_id].kept == (roots[at] == at)
    kept = similar.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(rows[i][0] for i in set(roots))


def test_similar_corpus_matches_brute_force(corpus):
    rows = sorted((r.doc_id, r.text) for r in corpus.collect())
    links, roots = by_brute_force(rows)
    for row in similar.similar_documents(corpus).collect():
        at = row.doc_id  # ids are 0 .. n - 1
        assert (row.n_links, row.class_id) == (links[at], roots[at])


def test_odd_documents_keep_one_of_each(odd_docs, no_docs):
    kept = [(r.doc_id, r.text) for r in similar.one_of_each(odd_docs).collect()]
    assert len(kept) == len(set(kept))
    assert {i for i, _ in kept} >= {1, 2, 3, 6, 7, 8} and 9 not in {i for i, _ in kept}
    assert similar.one_of_each(no_docs).count() == 0
    assert similar.similar_documents(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (101, 102), (7, 7), (200, 201), (200, 201)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}, 200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_of_unseen_documents(spark, corpus):
    rows = language.identify(corpus).join(corpus.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    """Character trigrams around letters, boundaries as one mark, in plain Python."""
    shape = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    while "  " in shape:
        shape = shape.replace("  ", " ")
    return [shape[i : i + 3] for i in range(len(shape) - 2) if shape[i + 1] != " "]


def exact_languages(rows):
    """Per row ``(lang_pred, score)`` with sets in place of filters, and the lead of the best language."""
    counts = defaultdict(Counter)
    for doc_id, text, lang in rows:
        if doc_id is not None and lang is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            counts[lang].update(plain_grams(text))
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for found in rates.values():
        for gram, rate in found.items():
            top[gram] = max(top[gram], rate)
    held = {lang: {g for g, n in c.items() if n >= language.LEAST_COUNT and rates[lang][g] >= language.LEAST_SHARE * top[g]} for lang, c in counts.items()}
    found = []
    for _, text, _ in rows:
        grams = plain_grams(text)
        share = {lang: sum(g in held[lang] for g in grams) / len(grams) if grams else 0.0 for lang in sorted(held)}
        ranked = sorted(share.values(), reverse=True) + [0.0]
        found.append(("und", 0.0, 1.0) if not grams else (max(share, key=share.get), ranked[0], ranked[0] - ranked[1]))
    return found


def test_languages_match_exact_sets(corpus):
    """Filters answer as sets would: the same language wherever one leads, the same score but for false positives."""
    rows = sorted((r.doc_id, r.text, r.lang) for r in corpus.collect())
    found = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(corpus).select("doc_id", "lang_pred", "score").collect())
    assert len(found) == len(rows)
    for (_, predicted, score), (lang, share, lead) in zip(found, exact_languages(rows)):
        assert abs(score - share) < 0.02
        assert predicted == lang or lead < 0.02


def test_language_of_odd_documents(odd_docs, no_docs):
    docs = with_clashing_columns(odd_docs)
    rows = language.identify(docs).select("_doc.text", "lang_pred", "score").collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        if not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
    kept = language.in_known_language(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL OR trim(text) = ''").count() == 0
    assert language.in_known_language(no_docs).count() == 0
    assert {r.lang_pred for r in language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_many_languages(spark):
    """More languages than bits of a word; their letters have no case."""
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(64 * k + i, f"{chr(0x4E00 + i) * 3} {chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 5, names[i], "s", 1) for i in range(70) for k in range(4)]
    docs = spark.createDataFrame([(n, t, lang, s, c) for n, (_, t, lang, s, c) in enumerate(rows)], COLUMNS)
    found = language.identify(docs).select("_doc.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def water_fill(sizes, weights, share=1.5, most=2):
    left, full = share * sum(sizes.values()), {}
    open_ = dict(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total >= most * sizes[s]]
        if not over:
            return full | {s: left * weights[s] / total for s in open_}
        for s in over:
            full[s] = most * sizes[s]
        left -= sum(full[s] for s in over)
        open_ = {s: n for s, n in open_.items() if s not in over}
    return full


def test_targets_match_the_rule(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 50, None: 700}, {"z": 5}, {"a": 0, "b": 10}, {chr(97 + i): 10 * (i % 5 + 1) ** 2 for i in range(12)}):
        rows = [(i, s, n, i) for i, (s, n) in enumerate(sizes.items())]
        found = {r.source: r for r in mixing.source_targets(spark.createDataFrame(rows, "row long, source string, size long, doc_id long")).collect()}
        order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
        weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
        expected = water_fill(sizes, weights)
        for source in sizes:
            assert found[source].target == pytest.approx(expected[source])
            assert found[source].slots <= 2 * found[source].blocks


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutations_are_permutations(spark, size):
    rows = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(12345)).alias("p"))
    places = [r.p for r in rows.collect()]
    assert sorted(places) == list(range(size))
    assert size < 97 or places != list(range(size))


def test_mix_meets_its_targets(spark, corpus):
    rows = mixing.mix(corpus).collect()
    again = mixing.mix(corpus).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    words = {r.doc_id: len(r.text.split()) for r in corpus.collect()}
    source = {r.doc_id: r.source for r in corpus.collect()}
    taken, target = Counter(), {}
    for row in rows:
        assert row["size"] == words[row.doc_id] and row.taken <= 2 * row["size"]
        taken[source[row.doc_id]] += row.taken
        target[source[row.doc_id]] = row.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 2 * mixing.BLOCK for s in target)


def test_mixed_documents_hold_the_words_taken(corpus, odd_docs, no_docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(corpus).collect()}
    mixed = mixing.mixed_documents(corpus)
    assert mixed.columns == corpus.columns
    found, texts = Counter(), {r.doc_id: r.text for r in corpus.collect()}
    for row in mixed.collect():
        found[row.doc_id] += len(row.text.split())
        assert row.n_chars == len(row.text)
        assert row.text == texts[row.doc_id] or row.text in " ".join(texts[row.doc_id].split()) or len(row.text) < len(texts[row.doc_id])
    assert dict(found) == {k: v for k, v in taken.items() if v}
    odd = with_clashing_columns(odd_docs)
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mixed_documents(odd).columns == odd.columns
    mixing.mixed_documents(odd).collect()
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_pipeline_stages(spark, small_dir, odd_docs, no_docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "n-gram Jaccard join", "source mixing", "best-fit packing"]
    whole = corpus_pipeline.run(spark, small_dir)
    assert whole.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    filled = defaultdict(int)
    for row in whole.collect():
        filled[row.sequence_id] += row.length
    assert filled and max(filled.values()) <= 4096
    for docs in (with_clashing_columns(odd_docs), no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, small_dir)
            assert after.columns == docs.columns
            after.collect()
