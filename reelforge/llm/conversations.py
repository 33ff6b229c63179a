"""Conversations with a broken structure brought back to a legal order of roles (operator 13)."""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.frames import partitions_for
from reelforge.llm.lattice import (
    BLANK, DELETE, DUPLICATE, FINAL, INSERT, KEEP, ROLES, SOUND, TRUNCATED, code_of, exit_costs, least_audit,
)
from reelforge.operators.durable import settle
from reelforge.operators.joins import spread_join

# What blank texts lack, and how texts end.
SEEN = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
LEGAL = ("su", "ua", "au")
ROWS_PER_PIECE = 50_000
CACHED_CODES = 100_000
ORDER = ["turn", "role", "digest"]


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with faults put in by rule: a checksum of ``conv_id:turn`` drops, empties, cuts, repeats or relabels a row.

    Nulls count as one space, in the checksum's text as in role and text.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")), "UTF-8")) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("_fault")).where("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digested(turns: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"))


def conversation_codes(turns: DataFrame, piece: int = ROWS_PER_PIECE) -> DataFrame:
    """``conv_id`` and ``codes``: one letter a row, for its role and its first fault, in order of turn, role and digest of the text.

    Rows that are the same travel as one with a count. A later row with the role and digest of an earlier one is a duplicate: the
    first turns are an aggregate, joined back with salts where one text is very common. Rows are dealt by range of
    conversation and turn, so that a conversation of any length is put in order by many tasks.
    """
    rows = _digested(turns)
    fault = F.when(~F.col("text").rlike(SEEN), BLANK).when(F.col("text").rlike(ENDED), SOUND).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == ROLES[0], 0).when(initial == ROLES[1], 1).when(initial == ROLES[2], 2).otherwise(3)
    key = F.xxhash64("conv_id", "role", "digest")
    narrow = settle(
        rows.select("conv_id", *ORDER, role.alias("kind"), fault.alias("fault"))
        .groupBy("conv_id", *ORDER, "kind", "fault").agg(F.count(F.lit(1)).alias("times"))
        .withColumns({"k1": key, "k2": F.xxhash64(F.lit(1), "conv_id", "role", "digest"), "at": F.struct(F.col("turn").isNotNull(), "turn")}), "turns")
    firsts = narrow.groupBy("k1", "k2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    marked = spread_join(narrow, firsts, ["k1", "k2"], "left")

    def letter(fault_of: Column) -> Column:
        return F.char(F.lit(ord(code_of(0, 0))) + 4 * F.col("kind") + fault_of)

    copy = F.when(F.col("fault") == BLANK, F.lit(BLANK)).otherwise(F.lit(DUPLICATE))
    again = (F.col("first") < F.col("at")) & (F.col("fault") != BLANK)
    coded = marked.select("conv_id", *ORDER, F.concat(
        letter(F.when(again, DUPLICATE).otherwise(F.col("fault"))), F.repeat(letter(copy), F.col("times").cast("int") - 1)).alias("code"))
    parts = narrow.count() // piece + 1
    dealt = coded.repartitionByRange(parts, "conv_id", *ORDER).withColumn("part", F.spark_partition_id())
    pieces = dealt.groupBy("conv_id", "part").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(F.struct(F.col("turn").isNotNull(), *ORDER), "code"))), lambda x: x["code"]), "").alias("codes"))
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "codes"))), lambda x: x["codes"]), "").alias("codes"))


def _audited(batches):
    """Short conversations: equal texts of codes have one answer, kept from row to row."""
    known: dict[str, tuple] = {}
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        found = []
        for text in codes:
            if text not in known:
                if len(known) >= CACHED_CODES:
                    known.clear()
                known[text] = least_audit(text)
            found.append(known[text])
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch.column("conv_id"), "codes": batch.column("codes"),
            "audit": pa.array([audit for _, audit, _ in found], pa.string()), "cost": pa.array([cost for cost, _, _ in found], pa.int64())})


def _costs(batches):
    """Per piece of a long conversation: least costs between the states before and after it, as text ``from to cost``."""
    for batch in batches:
        rows = [[f"{enter} {to} {cost}" for enter in range(4) for to, cost in exit_costs(text, enter).items()]
                for text in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "at": batch.column("at"), "costs": pa.array(rows, pa.list_(pa.string()))})


def _left(batches):
    """Per long conversation: what each state at the end of each of its pieces still costs."""
    for batch in batches:
        for number in range(batch.num_rows):
            pieces = batch.column("pieces")[number].as_py()
            leave, after = dict(FINAL), []
            for one in reversed(pieces):
                after.append(leave)
                held: dict[int, int] = {}
                for enter, to, cost in (map(int, text.split()) for text in one["costs"]):
                    if to in leave and cost + leave[to] < held.get(enter, cost + leave[to] + 1):
                        held[enter] = cost + leave[to]
                leave = held
            after.reverse()
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([batch.column("conv_id")[number].as_py()] * len(pieces), pa.int64()), "at": pa.array([p["at"] for p in pieces], pa.int64()),
                "leave": pa.array([[f"{state} {cost}" for state, cost in x.items()] for x in after], pa.list_(pa.string()))})


def _walks(batches):
    """Per piece of a long conversation and state before it: the edits, their state at the end, and the cost to the conversation's end."""
    for batch in batches:
        for number in range(batch.num_rows):
            leave = {int(state): int(cost) for state, cost in (text.split() for text in batch.column("leave")[number].as_py())}
            codes, found = batch.column("codes")[number].as_py(), []
            for enter in range(4):
                cost, audit, to = least_audit(codes, {enter: 0}, leave)
                found.append({"enter": enter, "leave": to, "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column("conv_id").slice(number, 1), "at": batch.column("at").slice(number, 1),
                "walks": pa.array([found], pa.list_(pa.struct([("enter", pa.int64()), ("leave", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])))})


def _chained(batches):
    """Per long conversation: the walks of its pieces that follow on each other, from the start."""
    for batch in batches:
        for number in range(batch.num_rows):
            state, audit, cost = 0, [], None
            for one in batch.column("pieces")[number].as_py():
                walk = one["walks"][state]
                cost = walk["cost"] if cost is None else cost
                audit.append(walk["audit"])
                state = walk["leave"]
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column("conv_id").slice(number, 1), "codes": batch.column("codes").slice(number, 1),
                "audit": pa.array(["".join(audit)]), "cost": pa.array([cost], pa.int64())})


def cheapest_edits(coded: DataFrame, piece: int = ROWS_PER_PIECE) -> DataFrame:
    """``conv_id``, ``codes``, ``audit`` and ``cost`` of the cheapest edits of each conversation.

    A conversation of over ``piece`` rows is cut into pieces that tasks work on side by side: least costs between the states at a
    piece's ends, then, with what each state still costs after the piece, its edits for every state before it. Only
    the four states of each piece are chained one after the other.
    """
    result = "conv_id long, codes string, audit string, cost long"
    short = coded.where(F.length("codes") <= piece).mapInArrow(_audited, result)
    long = settle(coded.where(F.length("codes") > piece), "long")
    if long.isEmpty():
        return short
    starts = F.sequence(F.lit(0).cast("long"), F.floor((F.length("codes") - 1) / piece))
    cut = long.select("conv_id", F.length("codes").alias("_n"), "codes", F.explode(starts).alias("at")).select(
        "conv_id", "at", F.substring("codes", F.col("at").cast("int") * piece + 1, F.lit(piece)).alias("codes"))
    many = max(1, long.agg(F.sum(F.ceil(F.length("codes") / piece))).first()[0])
    cut = settle(cut.repartition(many, "conv_id", "at"), "pieces")
    costs = cut.mapInArrow(_costs, "conv_id long, at long, costs array<string>")
    by_conversation = costs.groupBy(F.col("conv_id")).agg(F.sort_array(F.collect_list(F.struct("at", "costs"))).alias("pieces"))
    left = by_conversation.mapInArrow(_left, "conv_id long, at long, leave array<string>")
    same = F.col("c.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("c.at") == F.col("l.at"))
    walks = cut.alias("c").join(left.alias("l"), same).select("c.conv_id", "c.at", "c.codes", "l.leave").mapInArrow(
        _walks, "conv_id long, at long, walks array<struct<enter:long,leave:long,cost:long,audit:string>>")
    walks = walks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "walks"))).alias("pieces"))
    chained = long.alias("c").join(walks.alias("l"), F.col("c.conv_id").eqNullSafe(F.col("l.conv_id"))).select(
        "c.conv_id", "c.codes", "l.pieces").mapInArrow(_chained, result)
    return short.union(chained)


class _Repair:
    """One conversation on its way through a task: its rows come in order, and its repaired rows go out one by one."""

    def __init__(self, conv_id, codes: str, audit: str, cost: int) -> None:
        self.conv_id, self.codes, self.audit, self.cost = conv_id, codes, audit, cost
        kept = sum(audit.count(letter) for letter in set(audit) - {DELETE})
        self.odd, self.given, self.next, self.row = kept % 2, 0, 0, 0
        self.least = self.most = None
        self.turns = 0

    def _expected(self) -> str:
        """The role that stands at the next place of the repaired conversation."""
        at = self.given - self.odd
        return "system" if at < 0 else ("user", "assistant")[at % 2]

    def inserted(self):
        while self.next < len(self.audit) and self.audit[self.next] == INSERT:
            yield self._expected(), ""
            self.next += 1
            self.given += 1

    def take(self, turn, role: str, text: str):
        if turn is not None and turn != self.most:  # turns come in order
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1
        yield from self.inserted()
        letter = self.audit[self.next]
        self.next += 1
        if letter != DELETE:
            yield (role if letter == KEEP else self._expected()), text
            self.given += 1

    def counts(self) -> dict:
        number = {fault: sum(self.codes.count(code_of(role, fault)) for role in range(4)) for fault in (TRUNCATED, BLANK, DUPLICATE)}
        pairs = {code_of(a, x) + code_of(b, y) for a, ra in enumerate(ROLES) for b, rb in enumerate(ROLES) if ra + rb in LEGAL
                 for x in range(4) for y in range(4)} if len(self.codes) > 1 else ()
        return {
            "gaps": self.most - self.least + 1 - self.turns if self.turns else 0, "blank": number[BLANK], "duplicate": number[DUPLICATE],
            "truncated": number[TRUNCATED], "illegal": sum(a + b not in pairs for a, b in zip(self.codes, self.codes[1:]))}


def _streamed(out):
    """Conversations one after the other: ``out(repair, rows)`` gets each with an iterator over its repaired rows, and makes records."""
    def streamed(batches):
        current, records, schema = None, None, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "codes", "audit", "cost", "turn", "role", "text")]
            made = []
            for conv_id, codes, audit, cost, turn, role, text in zip(*columns):
                if codes is not None:  # the head of the next conversation
                    if current is not None:
                        made += records.close()
                    current = _Repair(conv_id, codes, audit, cost)
                    records = out(current)
                else:
                    made += records.add(current.take(turn, role, text))
            if made:
                yield pa.RecordBatch.from_pylist(made, out.schema)
        if current is not None:
            if made := records.close():
                yield pa.RecordBatch.from_pylist(made, out.schema)
    return streamed


class _Report:
    """One record per conversation; the repaired text goes into a running digest and is never held."""

    schema = pa.schema([("conv_id", pa.int64()), *[(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def __init__(self, repair: _Repair) -> None:
        self.repair, self.digest, self.lines = repair, hashlib.sha256(), 0

    def add(self, rows) -> list:
        for role, text in rows:
            self.digest.update(f"{chr(10) * (self.lines > 0)}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.lines += 1
        return []

    def close(self) -> list:
        self.add(self.repair.inserted())
        return [{"conv_id": self.repair.conv_id, **self.repair.counts(), "cost": self.repair.cost, "audit": self.repair.audit,
                 "repaired_sha256": self.digest.hexdigest()}]


class _Rows:
    """The repaired rows."""

    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def __init__(self, repair: _Repair) -> None:
        self.repair, self.at = repair, 0

    def add(self, rows) -> list:
        made = []
        for role, text in rows:
            made.append({"conv_id": self.repair.conv_id, "turn": self.at, "role": role, "text": text})
            self.at += 1
        return made

    def close(self) -> list:
        return self.add(self.repair.inserted())


def _stream(turns: DataFrame, ids: DataFrame, out, schema: str, piece: int) -> DataFrame:
    """Heads (codes and edits) and rows of each conversation side by side in one task, in order, without holding a conversation.

    The digest of a conversation's text has to be computed from front to back, so its rows pass through one task; they
    are sorted on disk and read once.
    """
    edits = settle(cheapest_edits(settle(conversation_codes(turns, piece), "codes"), piece), "edits")
    untouched = ids.join(edits, ids["conv_id"].eqNullSafe(edits["conv_id"]), "left_anti")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))]
    heads = edits.select("conv_id", "codes", "audit", "cost", *nothing).union(
        untouched.select("conv_id", F.lit(""), F.lit(""), F.lit(0).cast("long"), *nothing))
    rows = _digested(turns).select(
        "conv_id", F.lit(None).cast("string").alias("codes"), F.lit(None).cast("string").alias("audit"), F.lit(None).cast("long").alias("cost"),
        F.col("turn").cast("long").alias("turn"), "role", "digest", "text")
    together = heads.union(rows).repartition(partitions_for(turns), "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("codes").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
    return together.mapInArrow(_streamed(out), schema)


def repair_report(turns: DataFrame, ids: DataFrame | None = None, piece: int = ROWS_PER_PIECE) -> DataFrame:
    """One row per conversation: ``conv_id``, counts of ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal``, the
    ``cost`` and the ``audit`` of the cheapest repair, and ``repaired_sha256`` of the repaired ``role:text`` lines.

    Rows stand in order of turn (nulls first), role, and SHA-256 of the text. Null roles and texts are one space, so such texts are
    blank; rows without a ``conv_id`` are one conversation; rows that repeat another are duplicates. Texts and conversations
    may be of any length. ``ids`` lists further conversations, which have zeros and no edits. Other columns are not read.
    An empty table gives no rows.
    """
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _stream(turns, (turns if ids is None else ids).select("conv_id").distinct(), _Report, schema, piece)


def repaired(turns: DataFrame, piece: int = ROWS_PER_PIECE) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``turn`` (from 0), ``role``, ``text``. Other rules as in ``repair_report``."""
    return _stream(turns, turns.select("conv_id").distinct(), _Rows, "conv_id long, turn long, role string, text string", piece)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """The conversations of ``conversations``, damaged by rule and repaired: what was wrong, what it cost, and the result's digest."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(damaged(turns), turns)


def _sql_step(state: int) -> str:
    """The cheapest way on from a state: use up the row, after up to two inserted rows."""
    def using(at: int) -> str:
        options = [f"struct_pack(c := t{at}.c + 2, a := 'D' || t{at}.a, r := t{at}.r)"]
        after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[at]
        for initial, to in after.items():
            options.append(f"CASE WHEN fault < 2 AND initial = '{initial}' THEN struct_pack(c := t{to}.c + late, a := 'K' || t{to}.a, r := role || ':' || text || chr(10) || t{to}.r) END")
        for initial, name in (("u", "user"), ("a", "assistant")):
            if initial in after:
                to = after[initial]
                options.append(f"CASE WHEN fault < 2 THEN struct_pack(c := t{to}.c + 1 + late, a := 'R' || t{to}.a, r := '{name}:' || text || chr(10) || t{to}.r) END")
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"

    names = {2: "user", 3: "assistant"}
    chains, at, lines = [(using(state), 0, "")], state, ""
    for inserts in (1, 2):
        at = [2, 2, 3, 2][at]
        lines += f"{names[at]}:" + "\n"
        chains.append((using(at), inserts, lines))
    parts = []
    for step, inserts, text in chains:
        body = " || ".join(f"'{line}:' || chr(10)" for line in text.replace(":", "").split()) or "''"
        parts.append(f"list_transform([{step}], lambda x: struct_pack(c := x.c + {5 * inserts}, a := '{'I' * inserts}' || x.a, r := {body} || x.r))[1]")
    return f"list_min([{', '.join(parts)}])"


def _sql_end(state: int) -> str:
    """What is left to insert after the last row."""
    rows = {0: "", 1: "user assistant", 2: "assistant", 3: ""}[state].split()
    return f"struct_pack(c := {5 * len(rows)}, a := '{'I' * len(rows)}', r := {' || '.join(f'''{chr(39)}{r}:{chr(39)} || chr(10)''' for r in rows) or chr(39) * 2})"


OP13_SQL = f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crcs AS (
    SELECT key, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(key) + 1), lambda i: unicode(key[i])::BIGINT),
        lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
        4294967295::BIGINT) % 20 AS damage FROM (SELECT DISTINCT key FROM keyed)),
rows0 AS (
    SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
           CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM keyed JOIN crcs USING (key) WHERE damage <> 0),
rows1 AS (SELECT *, row_number() OVER () AS row_no FROM rows0),
placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), row_no) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, row_no) AS again FROM rows1),
faults AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2 WHEN again > 1 THEN 3
                   WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
coded AS (SELECT *, CASE WHEN fault = 1 THEN 5 ELSE 0 END AS late FROM faults),
counts AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
           count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id),
back AS (
    SELECT conv_id, n AS i, {', '.join(f'{_sql_end(state)} AS t{state}' for state in range(4))} FROM counts
    UNION ALL
    SELECT b.conv_id, b.i - 1, {', '.join(f'{_sql_step(state)}' for state in range(4))}
    FROM back b JOIN coded x ON x.conv_id IS NOT DISTINCT FROM b.conv_id AND x.i = b.i),
best AS (SELECT conv_id, t0 AS t FROM back WHERE i = 0)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(t.c, 0)::BIGINT AS cost, coalesce(t.a, '') AS audit,
       sha256(coalesce(left(t.r, greatest(length(t.r) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best t0_ ON t0_.conv_id IS NOT DISTINCT FROM o.conv_id
"""
