"""The mix against a version in plain Python that hashes as Spark does."""

import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from reelforge.llm import mixing

from .conftest import with_clashing_columns


def spark_hash(*values):
    """Spark's xxhash64; ints stand for longs, tuples of one int for ints."""
    seed = 42
    for value in values:
        if value is not None:
            raw = struct.pack("<i", *value) if isinstance(value, tuple) else struct.pack("<q", value) if isinstance(value, int) else value.encode()
            seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def permuted(index, size, key):
    draw = random.Random(mixing.SEED)
    for constant in [draw.randrange(1 << 60) for _ in range(mixing.ROUNDS)]:
        mirror = (constant + key - index) % size
        index = mirror if spark_hash(constant, max(index, mirror)) < 0 else index
    return index


def brute_force(rows, targets):
    """``(doc_id, size, taken, shards)`` of each row; ``targets`` gives the number, blocks and slots of each source."""
    total = sum(slots for _, _, slots in targets.values())
    dealt, first = defaultdict(list), 0
    for sid, blocks, slots in sorted(targets.values()):
        for order in range(slots):
            dealt[sid].append(permuted(first + order, total, 0))
        first += slots
    taken = defaultdict(list)
    for sid, blocks, _ in targets.values():
        for order, slot in enumerate(sorted(dealt[sid])):  # by shard, then slot
            copy, at = divmod(order, blocks)
            taken[sid, permuted(at, blocks, (sid * mixing.MOST_COPIES + copy) * mixing.KEY_STEP)].append(slot // mixing.SHARD_SLOTS)
    found, by_source = [], defaultdict(list)
    for doc_id, text, source in rows:
        digest = spark_hash(text)
        by_source[source].append((spark_hash((mixing.SEED,), doc_id, digest), doc_id, digest, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    for source, docs in by_source.items():
        at = 0
        for _, doc_id, _, size in sorted(docs, key=lambda d: (d[0], d[1] is not None, d[1] or 0, d[2])):
            words, shards = 0, set()
            for block in range(at // mixing.BLOCK, (at + size - 1) // mixing.BLOCK + 1) if size else ():
                inside = min(at + size, (block + 1) * mixing.BLOCK) - max(at, block * mixing.BLOCK)
                words += inside * len(taken[targets[source][0], block])
                shards.update(taken[targets[source][0], block])
            found.append((doc_id, size, words, len(shards)))
            at += size
    return sorted(found, key=repr)


def result(docs):
    return sorted(((r.doc_id, r["size"], r.taken, r.shards) for r in mixing.mix(docs).collect()), key=repr)


@pytest.mark.parametrize("shard_slots", [8192, 40])
def test_mix_matches_plain_python(spark, corpus, monkeypatch, shard_slots):
    monkeypatch.setattr(mixing.draw_blocks, "__defaults__", (shard_slots,))
    monkeypatch.setattr(mixing, "SHARD_SLOTS", shard_slots)
    rows = [(r.doc_id, r.text, r.source) for r in corpus.collect()]
    rows += [(1, rows[0][1], None), (1, rows[0][1], None), (1, "same id, other words", None), (None, "no id", "x"), (7, None, "x"), (8, "", "only empty")]
    docs = with_clashing_columns(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sources = mixing.source_targets(mixing.sized_rows(docs)).collect()
    found = result(docs)
    assert found == brute_force(rows, {r.source: (r.sid, r.blocks, r.slots) for r in sources})
    assert shard_slots > 40 or max(shards for *_, shards in found) > 1


def test_partitions_change_nothing(spark, corpus, small_dir, tmp_path):
    expected = result(corpus)
    assert result(corpus.repartition(7, "text")) == expected
    assert result(corpus.orderBy(F.desc("doc_id")).coalesce(1)) == expected
    corpus.repartition(30).write.parquet(str(tmp_path / "split"))
    assert result(spark.read.parquet(str(tmp_path / "split"))) == expected
    held = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        assert result(spark.read.parquet(f"{small_dir}/documents.parquet")) == expected
        texts = Counter((r.doc_id, r.text) for r in mixing.mixed_documents(spark.read.parquet(f"{small_dir}/documents.parquet")).collect())
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert texts == Counter((r.doc_id, r.text) for r in mixing.mixed_documents(corpus).collect())


def test_the_draw_is_in_the_plan(spark, corpus):
    plan = mixing.mix(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "shard" in plan and "_before" in plan
    counts = Counter()
    sources = mixing.source_targets(mixing.sized_rows(corpus))
    for row in mixing.draw_blocks(sources, 50).collect():
        counts[row.shard] += 1
    assert set(list(counts.values())[:-1]) <= {50} or max(counts.values()) == 50


def test_slots_are_made_by_many_tasks(spark):
    sources = spark.createDataFrame([(0, 900_000, 1_000_000, 0), (1, 10, 20, 1_000_000)], "sid int, blocks long, slots long, first_slot long")
    drawn = mixing.draw_blocks(sources)
    assert drawn.count() == 1_000_020
    assert drawn.select("sid", "block", "copy").distinct().count() == 1_000_020
