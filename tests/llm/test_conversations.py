"""Conversation repair against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelspark.llm import conversation_repair as cr

FIELDS = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        out.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired rows) over all edits, left to right; only the best of a row and state go on."""
    best = {0: (0, "", [])}
    follows = {0: "u", 1: "u", 2: "a", 3: "u"}
    state_of = {"s": 1, "u": 2, "a": 3}
    role_of = {"u": "user", "a": "assistant"}

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                r = follows[state]
                better(table, state_of[r], (cost + 3, audit + "I", out + [(role_of[r], "")]))
        return table

    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            better(after, state, (cost + 4, audit + "D", out))
            if fault in (0, 3):
                more, r = (3 if fault else 0), follows[state]
                better(after, state_of[r], (cost + 3 + more, audit + "R", out + [(role_of[r], text)]))
                if role[:1] == r or (state == 0 and role[:1] == "s"):
                    better(after, state_of[role[:1]], (cost + more, audit + "K", out + [(role, text)]))
        best = after
    return min((v for s, v in inserted(best).items() if s in (0, 3)), key=lambda v: v[:2])


def want(originals, rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).digest(), text, turn))
    out = []
    for conv in {r[0] for r in originals}:
        group = sorted(groups[conv])
        pairs = [(g[1], g[3]) for g in group]
        turns = [g[4] for g in group if g[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds, ok = faults(pairs), {("s", "u"), ("u", "a"), ("a", "u")}
        illegal = sum((a[0][:1], b[0][:1]) not in ok for a, b in zip(pairs, pairs[1:]))
        cost, audit, made = brute(pairs)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, kinds.count(1), kinds.count(2), kinds.count(3), illegal, cost, audit, sha))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(seed, n, longest):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "Why?", " \n", "", "So it is!  ", "and", "Good.", "One", "x. "]
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice([*texts, None, f"{rng.random()}.", f"{rng.random()}.", f"{rng.random()}.", f"{rng.random()}"])
            turn = rng.choice([turn, turn, turn + rng.randrange(3), None])
            rows += [(conv or None, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def test_repair_matches_brute_force(spark, found):
    rows = conversations(3, 150, 9)
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    for c in ("name", "at", "blk", "cost", "audit", "part", "_way", "_copy"):
        df = df.withColumn(c, F.lit("x"))
    assert found(cr.report(df, df), *COLUMNS) == want(rows, rows)


def test_long_conversations_span_blocks_and_levels(spark, found):
    rows = conversations(4, 3, 700)
    df = spark.createDataFrame(rows, FIELDS).repartition(7)
    want_all = {r[0]: r for r in want(rows, rows)}
    got = cr.repair(df, block_bits=2, fan_bits=1)
    for row in got.conversations.collect():
        conv = None if row["name"] == "n" else int(row["name"][1:])
        mine = want_all[conv]
        assert tuple(row[c] for c in COLUMNS[1:-1]) == mine[1:-1]
    hashes = {None if r["name"] == "n" else int(r["name"][1:]): r["sha256"] for r in cr.digests(got.rows).collect()}
    assert hashes == {c: r[-1] for c, r in want_all.items() if r[-1] != hashlib.sha256(b"").hexdigest()}


def test_damage(spark, found):
    rows = [(c, t, r, "A. b! c?") for c in range(40) for t, r in enumerate(["system", "user", "assistant", None])]
    rows += [(None, None, None, None), (50, None, "user", None)]
    made = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(name.encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if way == 1 else text.replace(".", "").replace("!", "").replace("?", "") if way == 2 else text
        made += [(conv, turn, "user" if way == 4 else role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    df = spark.createDataFrame(rows, FIELDS)
    got = found(cr.damaged(df), "conv_id", "turn", "role", "text")
    assert got == sorted(made, key=lambda r: tuple((v is not None, v) for v in r))
    assert found(cr.report(df, cr.damaged(df)), *COLUMNS) == want(rows, made)


def test_empty_long_and_extreme(spark, found):
    none = spark.createDataFrame([], FIELDS)
    assert cr.report(none, none).count() == 0
    rows = [(1, -(2**62), "user", "word " * 40_000), (1, 2**62, "assistant", "b."), (2, 5, "user", "dropped")]
    df = spark.createDataFrame(rows, FIELDS)
    got = found(cr.report(df, df.filter("conv_id = 1")), *COLUMNS)
    assert got == want(rows, rows[:2]) and got[1][-1] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("seed", range(3))
def test_agenda_pops_the_least(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [(rng.choice("suat"), rng.choice(["x.", "y", "", f"{rng.random()}."])) for _ in range(rng.randrange(6))]
        found = cr.lightest(len(rows), 0, cr.edits([r for r, _ in rows], faults(rows)), True)
        assert list(found.values()) == [brute(rows)[:2]]
