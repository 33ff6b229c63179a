from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from reelforge.llm import lines
from reelforge.llm.bitmaps import bitmap_of, may_hold
from reelforge.llm.exact import exact_duplicates

from .conftest import with_clashing_columns


def test_bitmap_never_loses_a_key(spark):
    keys = spark.range(0, 5000).select((F.col("id") * 7919).alias("k"))
    rows = spark.range(0, 200_000).withColumnRenamed("id", "k")
    kept = may_hold(rows, bitmap_of(keys, "k"), F.col("k"))
    assert kept.columns == ["k"]
    inside = rows.join(keys, "k").count()
    assert kept.join(keys, "k").count() == inside
    assert kept.count() < inside + 200


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates_match_brute_force(odd_docs, weak):
    digest = F.length("text") if weak else None  # many texts under one digest
    rows = exact_duplicates(with_clashing_columns(odd_docs), digest=digest, salts=3).collect()
    groups = defaultdict(list)
    for row in odd_docs.collect():
        groups[row.text or ""].append(row.doc_id)
    assert len(rows) == odd_docs.count()
    for text, ids in groups.items():
        found = [r for r in rows if r.text_sha256 == sha256(text.encode()).hexdigest()]
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(r.doc_id or -1 for r in found) == sorted(i or -1 for i in ids)
        assert {r.keep_id for r in found} == {best}
        assert {r.group_size for r in found} == {len(ids)}
        assert [r.doc_id for r in found if r.kept] == [best]


def test_empty_tables(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert lines.without_repeated_lines(no_docs).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_lines_match_brute_force(spark, distance):
    base = "the quick brown fox jumps over"
    texts = {base, base[1:], base[:-1], base.replace("q", "k"), base + "s", "x" + base, base[:10] + base[12:], base[:5] + "zz" + base[7:],
             "a short line!", "a short lime!", "a short lines!", "ab", "b", "completely different words", base[3:] + "abc"}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts))], "doc_id long, text string")
    compared = lines.compared_lines(docs, least_chars=1)
    found = {frozenset((r["first"].doc_id, r["other"].doc_id)) for r in lines.near_lines(compared, distance).collect()}
    names = sorted(texts)
    usable = lambda t: len(t) > distance  # noqa: E731  a line must have a character for each segment
    expected = {frozenset((i, j)) for i, a in enumerate(names) for j, b in enumerate(names)
                if i < j and usable(a) and usable(b) and edit_distance(a, b) <= distance}
    assert {p for p in found if all(usable(names[i]) for i in p)} == expected


@pytest.mark.parametrize("fine", [1024, 8])
def test_hot_segments_match_brute_force(spark, monkeypatch, fine):
    """Lines that share a half, near or not, with their keys counted as hot."""
    monkeypatch.setattr(lines, "FINE_CHARS", fine)
    monkeypatch.setattr(lines, "COARSE_PARTS", 3)
    opening = "a shared opening, "
    texts = {f"{opening}{i:04d}" for i in range(0, 300, 7)} | {f"{opening}{i:03d}" for i in range(0, 90, 4)} | {f"{i:04d}{opening}" for i in range(40)}
    texts |= {f"{opening}{'xyz' * i}" for i in range(5)} | {"ab", "b", "c", "bc", opening, opening.strip(), "é" + opening, opening + "é"}
    names = sorted(texts)
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    compared = lines.compared_lines(docs, least_chars=1)
    found = {frozenset((r["first"].doc_id, r["other"].doc_id)) for r in lines.near_lines(compared, 1, hot_lines=3).collect()}
    stripped = [name.strip(" ") for name in names]
    expected = {frozenset((i, j)) for i, a in enumerate(stripped) for j, b in enumerate(stripped)
                if i < j and a != b and len(a) > 1 and len(b) > 1 and edit_distance(a, b) <= 1}
    first = {}
    for i, name in enumerate(stripped):
        first.setdefault(name, i)
    expected = {frozenset(first[stripped[i]] for i in pair) for pair in expected}
    assert {p for p in found if all(len(stripped[i]) > 1 for i in p)} == expected


def test_a_crowd_of_lines_that_share_a_half(spark):
    """All pairs of 8,000 lines would take minutes."""
    rows = spark.range(8_000).select("id", F.format_string("A long shared opening of a line of text, then %06d", F.col("id") * 37).alias("text"))
    found = lines.repeated_lines(rows.withColumnRenamed("id", "doc_id"))
    expected, held = set(), set()
    for i in range(8_000):
        number = f"{i * 37:06d}"
        near = {number[:k] + d + number[k + 1 :] for k in range(len(number)) for d in "0123456789"} | {number[:k] + number[k + 1 :] for k in range(len(number))}
        if near & held:
            expected.add(i)
        held.add(number)
    assert {r.doc_id for r in found.collect()} == expected


def test_repeated_lines_of_odd_documents(odd_docs):
    docs = with_clashing_columns(odd_docs)
    cut = {(r["_doc"].doc_id, r["_doc"].text): r["_dropped"] for r in lines.with_dropped_lines(docs).collect()}
    assert cut[(4, "same line of text here\nanother line of text here")] is None
    assert cut[(5, "same line of text here\nanother line of text there")] == [0, 1]  # equal, and one letter apart
    assert sum(1 for (i, t), d in cut.items() if i == 9 and d == [0]) == 1  # the long text again
    kept = lines.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 9 not in ids and 3 in ids and ids.count(5) == 1 and 1 in ids and 7 in ids


def test_lines_match_the_rule_read_out(corpus):
    """Keeping the first of equal or near lines, over a whole table, by brute force."""
    seen, expected = {}, {}
    for row in corpus.select("doc_id", "text").sort("doc_id").collect():
        for at, line in enumerate(row.text.split("\n")):
            line = line.strip(" ")
            if len(line) < lines.LEAST_CHARS:
                continue
            known = line in seen
            if not known:
                seen[line] = any(
                    abs(len(o) - len(line)) <= 1 and (len(o) != len(line) or sum(x != y for x, y in zip(o, line)) <= 1)
                    and edit_distance(o, line) <= 1 for o in seen)
            if known or seen[line]:
                expected.setdefault(row.doc_id, []).append(at)
    found = {r.doc_id: r.dropped for r in lines.repeated_lines(corpus).collect()}
    assert found == expected
