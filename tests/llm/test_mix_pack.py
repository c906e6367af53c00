"""Mixing and packing."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelspark.llm import mixing, packing
from tests.llm.test_dedup import ODD, words


def reshared(sizes, share=1.5, most=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        parts = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and left * weight[s] / parts > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else left * weight[s] / parts if parts else 0 for s in names}
        full |= over


def corpus(seed, n):
    rng = random.Random(seed)
    names = ["src0"] * 30 + [f"src{i}" for i in range(1, 9)] + ["Z", "é", "", None]
    return [(i, "w " * rng.choice([0, 1, 5, 40, 300]), None, rng.choice(names)) for i in range(n)]


@pytest.mark.parametrize("n", [40, 3000])
def test_mix_reaches_every_target(docs, n):
    rows = corpus(n, n)
    got = mixing.mix(docs(rows, clash=True)).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    source = {r[0]: r[3] for r in rows}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    want = reshared(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and -1e-6 < target[s] - taken[s] < 1 + 1e-6
    again = mixing.mix(docs(rows, parts=7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_mix_takes_a_run_of_the_random_order(docs):
    got = sorted(mixing.mix(docs([(i, "w w w", None, s) for i in range(500) for s in ["a"]])).collect(), key=lambda r: r["rkey"])
    passes = [r["taken"] // 3 for r in got]
    assert passes == sorted(passes, reverse=True) and {2, 1} >= set(passes)


def test_mix_odd_rows_and_no_rows(docs):
    got = mixing.mix(docs(ODD)).collect()
    assert len(got) == len(ODD) and sum(r["taken"] for r in got) == int(1.5 * sum(len(words(t)) for _, t in ODD))
    assert mixing.mix(docs([])).count() == 0
    assert {r["taken"] for r in mixing.mix(docs([(1, None), (2, " ")])).collect()} == {0}


def test_mix_plan_is_native(docs, plan):
    df = docs(corpus(1, 50))
    for made in (mixing.mix(df), mixing.copies(df, mixing.mix(df))):
        assert not any(x in plan(made) for x in ("Python", "Pandas", "Arrow"))


def test_copies_hold_the_words_taken(docs):
    rows = corpus(4, 400)
    df = docs(rows, clash=True)
    mixed = mixing.mix(df)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    made = mixing.copies(df, mixed)
    assert made.columns == df.columns
    held = defaultdict(int)
    for r in made.collect():
        held[r["doc_id"]] += len(words(r["text"]))
        assert words(rows[r["doc_id"]][1])[: len(words(r["text"]))] == words(r["text"])
    assert held == {i: n for i, n in taken.items() if n}


# -- packing


def test_plan_fills_bins_without_overlap():
    rng = random.Random(2)
    histogram = {rng.randrange(1, 65): rng.randrange(1, 400) for _ in range(30)}
    placements, bins = packing.plan(histogram, (16, 32, 64), 2)
    held = defaultdict(list)
    for length, rank, count, first, offset in placements.tolist():
        for k in range(count):
            held[first + k].append((offset, length))
    assert sum(placements[:, 2]) == sum(histogram.values())
    ends = {first + k: (capacity, filled) for first, count, capacity, filled in bins.tolist() for k in range(count)}
    assert set(held) == set(ends)
    for b, parts in held.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        capacity, filled = ends[b]
        assert at == filled and capacity == min(c for c in (16, 32, 64) if c >= filled)
    one_size = packing.plan(histogram, (64,), 2)[1]
    assert sum(c + 2 for c, _ in ends.values()) <= (one_size[:, 1] * (one_size[:, 2] + 2)).sum()


def test_plan_is_best_fit_on_one_length_and_large_counts():
    placements, bins = packing.plan({10: 3_000_001}, (16, 32), 2)
    assert bins[:, 1].sum() == 1_000_001 and len(placements) < 10
    assert bins[np_argmax(bins), 2] == 32
    assert packing.plan({}, (16,))[0].shape == (0, 5)


def np_argmax(bins):
    return int(bins[:, 1].argmax())


def test_pack_places_every_word_once(docs):
    rows = corpus(6, 300) + [(1000 + i, t) for i, (_, t) in enumerate(ODD)] + [(None, "a b"), (5000, "x y z"), (5000, "x y z")]
    got = packing.pack(docs(rows, clash=True), capacities=(32, 64, 128)).collect()
    size = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        size[r["doc_id"]] += r["length"]
        if r["length"]:
            bins[r["bin_id"]].append(r)
        else:
            assert r["bin_id"] is None and r["capacity"] is None
        assert r["start"] == 128 * r["piece"] and r["length"] <= 128
    want = defaultdict(int)
    for i, text, *_ in rows:
        want[i] += len(words(text))
    assert size == want
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["length"]
        assert at == parts[0]["filled"] and parts[0]["capacity"] == min(c for c in (32, 64, 128) if c >= at)


def test_pack_no_rows_and_no_words(docs):
    assert packing.pack(docs([])).count() == 0
    assert [r["length"] for r in packing.pack(docs([(1, None)])).collect()] == [0]
