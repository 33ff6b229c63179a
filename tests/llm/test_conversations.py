import random
import re
import zlib
from collections import defaultdict
from functools import cache
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from reelforge.llm import conversations as c
from reelforge.llm import lattice

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(kinds):
    """Least (cost, edits) over all edits, by recursion; a kind is (initial of the role, fault)."""
    inserted = {0: 2, 1: 2, 2: 3, 3: 2}
    order = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def rest(at, state, inserts):
        found = [(0, "")] if at == len(kinds) and state in (0, 3) else []
        if at < len(kinds):
            initial, fault = kinds[at]
            found.append((2, "D", at + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                if (state, initial) in order:
                    found.append((late, "K", at + 1, order[state, initial], 0))
                found += [(1 + late, "R", at + 1, order[state, role], 0) for role in "ua" if (state, role) in order]
        if inserts < 3:
            found.append((5, "I", at, inserted[state], inserts + 1))
        totals = []
        for cost, letter, *to in found:
            after = rest(*to) if to else (0, "")
            if after is not None:
                totals.append((cost + after[0], letter + after[1]))
        return min(totals, default=None)

    return rest(0, 0, 0)


def apply(audit, rows):
    kept, rows = [], iter(rows)
    total = len(audit) - audit.count("D")
    expected = (["system"] if total % 2 else []) + ["user", "assistant"] * (total // 2)
    for letter in audit:
        row = next(rows) if letter != "I" else None
        if letter == "D":
            continue
        role = expected[len(kept)]
        kept.append((role, "") if letter == "I" else (row[1] if letter == "K" else role, row[2]))
    return kept


def spaced(value):
    return " " if value is None else str(value)


def brute_force(rows, damage):
    conversations, named = defaultdict(list), {row[0] for row in rows}
    for conv, turn, role, text in rows:
        role, text = spaced(role), spaced(text)
        fault = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20 if damage else 19
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        conversations[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    found = {}
    for conv in named:
        turns = sorted(conversations[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).hexdigest()))
        seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            kinds.append((role[:1], fault))
            if fault:
                counts[fault] += 1
        numbers = [t for t, _, _ in turns if t is not None]
        cost, audit = cheapest(tuple(kinds))
        found[conv] = {
            "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, **counts,
            "illegal": sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": sha256("\n".join(f"{r}:{t}" for r, t in apply(audit, turns)).encode()).hexdigest()}
    return found


def result_of(frame):
    rows = [row.asDict() for row in frame.collect()]
    assert len({row["conv_id"] for row in rows}) == len(rows)
    return {row.pop("conv_id"): row for row in rows}


def odd_rows(seed, conversations=40):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(draw.randrange(0, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, turn * 3, None, 1]), draw.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]),
                         draw.choice(["Hello there.", "What? ", "no end", "", None, " \n\t", "Hello there.", f"é {turn}!", "x" * 5000 + "."])))
    return rows


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("piece", [1, 3, c.ROWS_PER_PIECE])
def test_reports_match_brute_force(spark, damage, piece):
    rows = odd_rows(piece)
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("codes", F.lit("x")).withColumn("digest", F.lit(0)).withColumn("audit", F.lit("y"))
    used = c.damaged(turns) if damage else turns
    assert result_of(c.repair_report(used, turns, piece=piece)) == brute_force(rows, damage)


def test_repaired_rows_are_legal_and_match_the_report(spark):
    rows = odd_rows(5)
    turns = spark.createDataFrame(rows, SCHEMA)
    report = result_of(c.repair_report(turns))
    texts = defaultdict(list)
    for row in sorted(c.repaired(turns).collect(), key=lambda r: r.turn):
        assert row.turn == len(texts[row.conv_id])
        texts[row.conv_id].append(f"{row.role}:{row.text}")
    for conv, found in report.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in texts[conv]))
        assert sha256("\n".join(texts[conv]).encode()).hexdigest() == found["repaired_sha256"]


@pytest.mark.parametrize("length", range(8))
def test_lattice_matches_recursion(length):
    draw, faults = random.Random(length), [None, "truncated", "blank", "duplicate"]
    for _ in range(150):
        kinds = tuple((draw.choice("suaux"), draw.choice([None, None, *faults])) for _ in range(length))
        codes = "".join(lattice.code_of("sua".find(role) % 4, faults.index(fault)) for role, fault in kinds)
        assert lattice.least_audit(codes)[:2] == cheapest(kinds), kinds


def test_one_conversation_of_most_rows(spark):
    """A conversation of many rows, most of them the same, goes through pieces."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "ok." if i % 3 else f"text {i}.") for i in range(1500)] + [(2, 0, "user", "Hi.")]
    rows += [(1, 7, "user", "ok.")] * 200
    turns = spark.createDataFrame(rows, SCHEMA)
    whole, cut = result_of(c.repair_report(turns)), result_of(c.repair_report(turns, piece=100))
    assert whole == cut and whole[2]["audit"] == "D"


def test_dropped_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert result_of(c.repair_report(c.damaged(turns), turns)) == {gone: {
        "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": sha256(b"").hexdigest()}}
    assert c.repair_report(turns.limit(0)).count() == 0
