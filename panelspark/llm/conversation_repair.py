"""Repair of conversations by the cheapest edits, found as lightest derivations (Knuth's agenda).

A repaired conversation has the role initials ``(s?(ua)+)?``. Items of the deduction system are
(rows consumed, state of that grammar); a deduction keeps, reroles, deletes or inserts a row, adds
its cost and appends its letter to the audit. Values (cost, audit) never fall along a deduction,
so items leave the agenda in rising order and the first goal item is the answer, ties going to the
least audit in ASCII. (Two audits of one item and cost are never prefixes of one another: they
consume the same rows and inserts cost.)

Rows are put in order once, by ranges of (conversation, turn, ...), and numbered; a block is up to
256 consecutive rows, whatever conversations they belong to. What a conversation has in a block is
summed up as its lightest derivations from each state to each state; these are the deductions of a
second agenda over its blocks. So a conversation of any length is dealt over many tasks, up to the
audit itself, which is one value. Without blocks at the edges a conversation is settled at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import in_runs, saved

#: Rows of a block (2^8), and blocks or groups of blocks that are joined at once (2^4).
BLOCK_BITS, FAN_BITS = 8, 4
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT = 1, 2, 3
_LONG = (1 << 63) - 1

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The turn that may follow, by initial.
_KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_FOLLOWS = (2, 2, 3, 2)
_ACCEPTS = (0, 3)
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

Value = tuple[int, str]


def lightest(n: int, start: int, deductions: Callable, closed: bool) -> dict[int, Value]:
    """The lightest (cost, audit) of the items (n, state) that derive from (0, start).

    ``deductions(i, state)`` gives (cost, letters, i', state'). ``closed``: only the goal, the
    lightest of the accepting states; otherwise every state.
    """
    agenda, final, ends = [(0, "", 0, start)], set(), {}
    while agenda:
        cost, audit, i, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n and (not closed or state in _ACCEPTS):
            ends[state] = (cost, audit)
            if closed:
                break
        for more, letters, j, after in deductions(i, state):
            if (j, after) not in final:
                heappush(agenda, (cost + more, audit + letters, j, after))
    return ends


def edits(initials: list[str], faults: list[int]) -> Callable:
    """Deductions over rows: insert before row i, or keep, rerole or delete it."""

    def deductions(i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        after = _FOLLOWS[state]
        yield INSERT, "I", i, after
        if i == len(initials):
            return
        yield DELETE, "D", i + 1, state
        if faults[i] in (BLANK_FAULT, DUPLICATE_FAULT):
            return
        more = TRUNCATED if faults[i] == TRUNCATED_FAULT else 0
        yield REROLE + more, "R", i + 1, after
        kept = _KEEPS.get((state, initials[i]))
        if kept is not None:
            yield more, "K", i + 1, kept

    return deductions


def _over(blocks: list[list[tuple[int, int, int, str]]]) -> Callable:
    """Deductions over blocks: each has its own lightest (from, to, cost, audit)."""

    def deductions(i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        if i < len(blocks):
            for before, after, cost, audit in blocks[i]:
                if before == state:
                    yield cost, audit, i + 1, after

    return deductions


# -- damage (the fixture of the registered query) ------------------------------------------------


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults by crc32("conv:turn") mod 20: 0 is dropped, 1 empty, 2 without ``.!?``, 3 twice,
    4 of role user. Nulls of role, text and in the key count as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat_ws(":", spaced(conv), spaced(turn))) % 20
    return (
        rows.select(
            F.col(conv).alias(conv),
            F.col(turn).alias(turn),
            F.when(way == 4, F.lit("user")).otherwise(spaced(role)).alias(role),
            F.when(way == 1, F.lit(""))
            .when(way == 2, F.regexp_replace(spaced(text), "[.!?]", ""))
            .otherwise(spaced(text))
            .alias(text),
            way.alias("_way"),
        )
        .filter("_way <> 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_way") == 3, 2).otherwise(1))))
        .drop("_way", "_copy")
    )


# -- rows in order -------------------------------------------------------------------------------


def _name(conv: str):
    return F.coalesce(F.concat(F.lit("s"), F.col(conv).cast("string")), F.lit("n"))


def _in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(name, turn, role, text, digest, at): ``at`` rises along each conversation, by turn (nulls first),
    role and SHA-256 of the text. Rows that are equal in all of them are dealt by a random key."""
    rows = rows.select(
        _name(conv).alias("name"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = rows.withColumn("any", F.rand(5))
    order = ["name", F.col("turn").asc_nulls_first(), "role", "digest", "any"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.drop("any").withColumn("at", F.monotonically_increasing_id())


def _facts(turns: DataFrame) -> DataFrame:
    """(name, at, blk, initial, fault) of each row: the first fault of a row counts."""
    first = turns.groupBy("name", "role", "digest").agg(F.min("at").alias("at"))
    facts = turns.select(
        "name",
        "at",
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("whole"),
    ).join(first.select("at", F.lit(True).alias("first")), "at", "left")
    fault = (
        F.when(F.col("blank"), BLANK_FAULT)
        .when(F.col("first").isNull(), DUPLICATE_FAULT)
        .when(~F.col("whole"), TRUNCATED_FAULT)
        .otherwise(0)
    )
    return facts.select("name", "at", F.shiftright("at", BLOCK_BITS).alias("blk"), "initial", fault.alias("fault"))


# -- summaries of blocks -------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SUMMARY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("blk", T.LongType()),
        T.StructField("blks", T.ArrayType(T.LongType())),
        T.StructField("ns", T.ArrayType(T.IntegerType())),
        *(T.StructField(c, T.LongType()) for c in _COUNTS),
        T.StructField("head", T.StringType()),
        T.StructField("tail", T.StringType()),
        T.StructField("ways", T.ArrayType(T.StructType([
            T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()),
            T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
        ]))),
    ]
)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _ways(n: int, deductions: Callable, starts, closed: bool) -> list[dict]:
    return [
        {"before": start, "after": state, "cost": cost, "audit": audit}
        for start in starts
        for state, (cost, audit) in lightest(n, start, deductions, closed).items()
    ]


def _summed_up(schema: pa.Schema, rows_of_block: int) -> Callable:
    """Whole blocks of facts -> one summary for each conversation in a block."""

    def work(table: pa.Table) -> pa.Table:
        made = []
        name, at, blk, initial, fault = (table[c].to_pylist() for c in ("name", "at", "blk", "initial", "fault"))
        low = 0
        for high in range(1, len(name) + 1):
            if high < len(name) and name[high] == name[low] and blk[high] == blk[low]:
                continue
            letters, faults = initial[low:high], fault[low:high]
            # a conversation may go on beyond the first and the last row of a block
            opened = at[low] % rows_of_block == 0
            closed = high < len(name) and blk[high] == blk[low]
            made.append(
                {
                    "name": name[low], "blk": blk[low], "blks": [blk[low]], "ns": [high - low],
                    "blank": faults.count(BLANK_FAULT), "duplicate": faults.count(DUPLICATE_FAULT),
                    "truncated": faults.count(TRUNCATED_FAULT),
                    "illegal": sum(pair not in _LEGAL for pair in zip(letters, letters[1:])),
                    "head": letters[0], "tail": letters[-1],
                    "ways": _ways(high - low, edits(letters, faults), range(4) if opened else (0,), closed),
                }
            )
            low = high
        return pa.Table.from_pylist(made, schema)

    return work


def _joined(group: list[dict], starts, closed: bool) -> dict:
    """One summary of consecutive ones."""
    blocks = [[(w["before"], w["after"], w["cost"], w["audit"]) for w in one["ways"]] for one in group]
    return {
        "name": group[0]["name"], "blk": group[0]["blk"],
        "blks": [b for one in group for b in one["blks"]], "ns": [n for one in group for n in one["ns"]],
        **{c: sum(one[c] for one in group) for c in _COUNTS},
        "illegal": sum(one["illegal"] for one in group) + sum(
            (x["tail"], y["head"]) not in _LEGAL for x, y in zip(group, group[1:])),
        "head": group[0]["head"], "tail": group[-1]["tail"],
        "ways": _ways(len(blocks), _over(blocks), starts, closed),
    }


def _groups_of(table: pa.Table, keys: list[str]) -> Iterator[list[dict]]:
    group: list[dict] = []
    for row in table.to_pylist():
        if group and any(row[k] != group[0][k] for k in keys):
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _levelled(schema: pa.Schema) -> Callable:
    def work(table: pa.Table) -> pa.Table:
        made = [_joined(group, range(4), False) for group in _groups_of(table, ["name", "up"])]
        return pa.Table.from_pylist(made, schema)

    return work


_PLAN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("blk", T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField("state", T.IntegerType()),
        T.StructField("audit", T.StringType()),
        *(T.StructField(c, T.LongType()) for c in (*_COUNTS, "cost")),
    ]
)


def _state(emitted: int, of: int) -> int:
    """State after some of all rows of a repaired conversation; an odd number of rows begins with s."""
    turns = emitted - of % 2
    return 0 if emitted == 0 else 1 if turns == 0 else 2 if turns % 2 else 3


def _settled(schema: pa.Schema) -> Callable:
    """All summaries of a conversation -> its audit, cut by blocks; the first row has the totals."""

    def work(table: pa.Table) -> pa.Table:
        made = []
        for group in _groups_of(table, ["name"]):
            whole = _joined(group, (0,), True)
            (best,) = whole["ways"]
            audit, low, emitted = best["audit"], 0, 0
            of = len(audit) - audit.count("D")
            for k, (blk, n) in enumerate(zip(whole["blks"], whole["ns"])):
                high, used = low, 0
                while used < n:
                    used += audit[high] != "I"
                    high += 1
                if k == len(whole["blks"]) - 1:
                    high = len(audit)
                part = audit[low:high]
                totals = {"audit": audit, "cost": best["cost"], **{c: whole[c] for c in _COUNTS}} if k == 0 else {}
                made.append({"name": whole["name"], "blk": blk, "part": part, "state": _state(emitted, of), **totals})
                emitted += len(part) - part.count("D")
                low = high
        return pa.Table.from_pylist(made, schema)

    return work


# -- repaired rows -------------------------------------------------------------------------------


def _applied(schema: pa.Schema) -> Callable:
    """Rows of whole blocks with their part of the audit -> rows of the repaired conversations."""

    def work(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in schema.names}
        columns = (table[c].to_pylist() for c in ("name", "blk", "turn", "role", "text", "part", "state"))
        own, left, state, place = None, iter(()), 0, 0

        def emit(name, blk, turn, role, text, edit):
            nonlocal place
            for c, v in zip(schema.names, (name, blk, place, turn, role, text, edit)):
                out[c].append(v)
            place += 1

        def insert():
            nonlocal state
            state = _FOLLOWS[state]
            emit(*own, None, _ROLE[state], "", "I")

        for name, blk, turn, role, text, part, begin in zip(*columns):
            if (name, blk) != own:
                for _ in left:  # what is left of a part are inserted rows
                    insert()
                own, left, state, place = (name, blk), iter(part), begin, 0
            letter = next(left)
            while letter == "I":
                insert()
                letter = next(left)
            if letter != "D":
                state = _KEEPS[state, role[:1]] if letter == "K" else _FOLLOWS[state]
                emit(name, blk, turn, role if letter == "K" else _ROLE[state], text, letter)
        for _ in left:
            insert()
        return pa.Table.from_pydict(out, schema)

    return work


class Repair(NamedTuple):
    """``conversations``: name, audit, cost, blank, duplicate, truncated, illegal and gaps, a row for each
    conversation. ``rows``: name, blk, place, turn (null: inserted), role, text, edit (K, R or I), in the
    order of (blk, place) within a name."""

    conversations: DataFrame
    rows: DataFrame


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block_bits: int = BLOCK_BITS, fan_bits: int = FAN_BITS,
) -> Repair:
    """Repair every conversation at least cost.

    Null roles and texts are one space, a null ``conv`` is a conversation of its own, null turns
    come first; rows of equal turns stand by role and SHA-256 of the text. A role is known by its
    first character. Blank rows and repeats of an earlier (role, text) must go. Other columns are
    not looked at. No rows give no conversations.
    """
    turns = saved(_in_order(rows, conv, turn, role, text), "repair-turns")
    facts = _facts(turns).withColumn("blk", F.shiftright("at", block_bits))
    summary, plan = _arrow(_SUMMARY), _arrow(_PLAN)
    by_block = facts.repartition("blk").sortWithinPartitions("blk", "at")
    level = saved(by_block.mapInArrow(in_runs(["blk"], _summed_up(summary, 1 << block_bits)), _SUMMARY), "repair-blocks")
    bits = 0
    while (level.groupBy("name").count().agg(F.max("count")).first()[0] or 0) > 1 << fan_bits:
        bits += fan_bits
        grouped = level.withColumn("up", F.shiftright("blk", bits))
        grouped = grouped.repartition("name", "up").sortWithinPartitions("name", "up", "blk")
        level = saved(grouped.mapInArrow(in_runs(["name", "up"], _levelled(summary)), _SUMMARY), "repair-level")
    by_name = level.repartition("name").sortWithinPartitions("name", "blk")
    plans = saved(by_name.mapInArrow(in_runs(["name"], _settled(plan)), _PLAN), "repair-plans")

    parts = plans.select("name", "blk", "part", "state")
    dealt = turns.withColumn("blk", F.shiftright("at", block_bits)).join(parts, ["name", "blk"])
    dealt = dealt.repartition("blk").sortWithinPartitions("blk", "at")
    made = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("blk", T.LongType()),
            T.StructField("place", T.IntegerType()),
            turns.schema["turn"],
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("edit", T.StringType()),
        ]
    )
    repaired = dealt.mapInArrow(in_runs(["blk"], _applied(_arrow(made))), made)

    exact = F.col("turn").cast("decimal(38,0)")
    gaps = F.max(exact) - F.min(exact) + 1 - F.countDistinct("turn")
    gaps = turns.groupBy("name").agg(F.coalesce(F.when(gaps > _LONG, _LONG).otherwise(gaps).cast("long"), F.lit(0)).alias("gaps"))
    totals = plans.filter("audit IS NOT NULL").select("name", "audit", "cost", *_COUNTS)
    return Repair(totals.join(gaps, "name"), repaired)


def digests(rows: DataFrame) -> DataFrame:
    """(name, sha256): of ``role:text`` of each conversation's repaired rows, joined by line breaks.
    Texts stream through the hash, so a conversation of any length takes no more memory than a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, made = None, None, ([], [])
        for batch in batches:
            for name, role, text in zip(*(batch.column(c).to_pylist() for c in ("name", "role", "text"))):
                if name != own:
                    if own is not None:
                        made[0].append(own)
                        made[1].append(digest.hexdigest())
                    own, digest = name, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.string()) for m in made], names=["name", "sha256"])
                made = ([], [])
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([digest.hexdigest()])], names=["name", "sha256"])

    ordered = rows.select("name", "blk", "place", "role", "text").repartition("name")
    return ordered.sortWithinPartitions("name", "blk", "place").mapInArrow(work, "name string, sha256 string")


def report(
    originals: DataFrame, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repair of ``rows`` for every conversation of ``originals``: those without rows have zeros, an
    empty audit and the hash of nothing."""
    found = repair(rows, conv, turn, role, text)
    every = originals.select(F.col(conv).alias("conv_id"), _name(conv).alias("name")).distinct()
    all_of = every.join(found.conversations, "name", "left").join(digests(found.rows), "name", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return all_of.select(
        "conv_id",
        *map(zero, ("gaps", *_COUNTS, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
