"""Exact, near, substring and line deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import exact_dedup, line_dedup, minhash_dedup, substring_dedup
from panelspark.llm.common import components

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, "two  words"),
    (8, "two words"), (8, "two words"), (9, "é x y"), (10, "long " * 30_000), (11, "long " * 29_000), (None, "nobody"),
]


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def sentences(seed, n, length, vocabulary=400):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(length)) for _ in range(n)]


def roots(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


# -- exact


def test_exact_groups_and_winners(docs, found):
    out = exact_dedup.exact_dedup(docs(ODD, clash=True), F.col("doc_id") % 2 == 0)
    got = found(out, "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(
        [
            (None, None, 1, True), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 1, True),
            (6, 6, 4, True), (7, 6, 4, False), (8, 6, 4, False), (8, 6, 4, False), (9, 9, 1, True), (10, 10, 1, True), (11, 11, 1, True),
        ],
        key=lambda r: tuple((v is not None, v) for v in r),
    )
    text = {r["doc_id"]: r["text_sha256"] for r in out.collect()}
    assert text[7] == hashlib.sha256(b"two words").hexdigest() and text[1] == hashlib.sha256(b"").hexdigest()


def test_exact_without_history_or_news(docs, found):
    rows = [(i, f"t{i % 7}") for i in range(50)]
    for history in (F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        got = found(exact_dedup.exact_dedup(docs(rows), history), "doc_id", "keep_id")
        assert got == [(i, i % 7) for i in range(50)]
    assert exact_dedup.exact_dedup(docs([]), F.lit(True)).count() == 0


def test_perfect_hash_is_minimal_and_knows_its_members():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, bits, slots = exact_dedup.build(b"".join(keys))
    assert sorted(slots.tolist()) == list(range(5000)) and bits.sum() == 5000
    held = b"".join(keys[i] for i in np.argsort(slots))
    assert exact_dedup.find(sizes, bits, held, b"".join(keys)).tolist() == slots.tolist()
    others = b"".join(hashlib.sha256(f"x{i}".encode()).digest() for i in range(500))
    assert (exact_dedup.find(sizes, bits, held, others) == -1).all()


# -- components


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(70, 71), (71, 72), (72, 70), (5, 5)]
    edges += [(None, 3), (80, 80)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    got = {r["node"]: r["component"] for r in got}
    nodes = {x for e in edges for x in e if x is not None} - {80}
    want = roots(nodes, [e for e in edges if None not in e and e[0] != e[1]])
    assert got == want


# -- near


def jaccard_links(rows, width):
    sets = {}
    for i, text in rows:
        w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return sets, links


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(docs, found, width):
    rng = random.Random(width)
    rows = []
    for text in sentences(width, 40, 60):
        w = text.split()
        for _ in range(rng.choice([1, 1, 3, 12])):
            v = list(w)
            for _ in range(rng.choice([0, 1, 2, 4])):
                v[rng.randrange(len(v))] = f"x{rng.randrange(50)}"
            rows.append((len(rows) + 1, " ".join(v)))
    rows += [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "one two"), (1005, "x " * 20_000), (1006, "x " * 19_000)]
    sets, links = jaccard_links(rows, width)
    want = roots(sets, links)
    got = found(minhash_dedup.near_duplicates(docs(rows, clash=True), width=width), "doc_id", "n_shingles", "component_id", "kept")
    assert got == [(i, len(sets[i]), want[i], want[i] == i) for i in sorted(sets)]


def test_near_duplicates_repeated_ids_nulls_and_no_rows(docs, found):
    a, b = sentences(3, 2, 40)
    got = found(minhash_dedup.near_duplicates(docs([(5, a), (5, b), (7, a), (9, b), (None, a), (11, None)])), "doc_id", "component_id", "kept")
    assert got == [(None, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (11, 11, True)]
    assert minhash_dedup.near_duplicates(docs([])).count() == 0


def test_chains_of_near_duplicates_in_one_bucket(docs, found):
    # each text differs from the next by a little and from the far ones by a lot
    w = sentences(8, 1, 300)[0].split()
    rows = [(i + 1, " ".join(f"y{k}" if k < 12 * i else x for k, x in enumerate(w))) for i in range(20)]
    sets, links = jaccard_links(rows, 2)
    want = roots(sets, links)
    got = found(minhash_dedup.near_duplicates(docs(rows), width=2), "doc_id", "component_id")
    assert got == sorted(want.items()) and len(links) < 190


def test_super_min_hash_estimates_and_covers_all_lanes():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for n in (1, 3, 40, 1500):
        sets = [pool[:n], pool[n // 4 : n // 4 + n], pool[:n]]
        signature = minhash_dedup.super_min_hash(np.concatenate(sets), np.repeat([0, 1, 2], n), 3)
        assert (signature != 0xFFFFFFFF).all() and (signature[0] == signature[2]).all()
        true = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
        assert abs((signature[0] == signature[1]).mean() - true) < 0.16


# -- substrings


def repeats(rows, span):
    seen = Counter()
    lists = [(i, words(t)) for i, t in rows]
    for _, w in lists:
        seen.update(tuple(w[k : k + span]) for k in range(len(w) - span + 1))
    out = []
    for i, w in lists:
        gone = set()
        for k in range(len(w) - span + 1):
            if seen[tuple(w[k : k + span])] > 1:
                gone.update(range(k, k + span))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("span", [3, 8, 35])
def test_repeats_match_brute_force(docs, found, span):
    rng = random.Random(span)
    passages = sentences(span, 6, span + 9)
    rows = []
    for i, text in enumerate(sentences(span + 1, 60, 90, 5000)):
        w = text.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages).split()
            a = rng.randrange(3)
            w[rng.randrange(len(w)) : 0] = p[a : a + rng.choice([span - 1, span, span + 5])]
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, " "), (102, "la " * 300), (103, rows[0][1]), (104, "a\tb  c\nd" * 20), (None, rows[1][1]), (103, rows[0][1])]
    got = found(substring_dedup.remove_repeats(docs(rows, clash=True), span), "doc_id", "n_words", "n_removed", "kept")
    assert got == repeats(rows, span)


def test_repeats_spans_and_no_rows(docs):
    a, b = sentences(9, 2, 50, 9000)
    rows = substring_dedup.remove_repeats(docs([(1, f"head {a} tail"), (2, f"{b} {a}")])).collect()
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in rows}
    assert spans == {1: [(1, 51)], 2: [(50, 100)]}
    assert substring_dedup.remove_repeats(docs([])).count() == 0


# -- lines


def kept_lines(texts, dense=2):
    """Lines left of each text, in the order given: the rule line by line."""
    firsts, out = {}, []
    for at, text in enumerate(texts):
        lines = (text or "").split("\n")
        p = [i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        h = [int(hashlib.md5(lines[i].encode()).hexdigest()[:8], 16) for i in p]
        ends = (0, len(p) - 1)
        b = [i for j, i in enumerate(p) if j in ends or (h[j] * 31 + h[j + 1]) % 3 < dense]
        gone = set()
        for k in range(len(b) - 1):
            left = lines[b[max(k - 1, 0)] : b[k]]
            right = lines[b[k + 1] + 1 : b[min(k + 2, len(b) - 1)] + 1]
            chunk = tuple(lines[b[k] : b[k + 1] + 1])
            if chunk not in firsts:
                firsts[chunk] = left, right
                continue
            n = same(left[::-1], firsts[chunk][0][::-1])
            gone |= set(range(b[k] - n, b[k + 1] + 1 + same(right, firsts[chunk][1])))
        out.append([x for i, x in enumerate(lines) if i not in gone])
    return out


def same(one, two):
    n = 0
    while n < min(len(one), len(two)) and one[n] == two[n]:
        n += 1
    return n


def test_lines_match_brute_force(docs, found):
    rng = random.Random(5)
    pool = [f"line {i}" for i in range(40)]
    blocks = [[rng.choice(pool) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(80):
        lines = [f"own {i} {k}" for k in range(rng.randrange(4))]
        for _ in range(rng.randrange(3)):
            lines += rng.choice(blocks) + [f"more {rng.random()}"]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n\n\n"), (104, "x\n" * 5000), (105, rows[3][1])]
    rows += [(106, "head\n\nbody one\n \nbody two\n"), (107, "new\n\nbody one\n \nbody two\nend"), (108, "head\n\nnew")]
    for dense in (2, 3):
        want = []
        for (i, text), kept in zip(rows, kept_lines([t for _, t in rows], dense)):
            n = (text or "").count("\n") + 1
            want.append((i, None if text is None else "\n".join(kept), n, n - len(kept)))
        out = line_dedup.dedup_lines(docs(rows, clash=True), chosen=dense)
        assert found(out, "doc_id", "text", "_n_lines", "_n_removed") == want and sum(w[3] for w in want) > 50


def test_lines_exact_setting_removes_every_repeated_run(docs):
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(12)))) for i in range(120)]
    runs, want = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 1):
            if (lines[k], lines[k + 1]) in runs:
                gone |= {k, k + 1}
            runs.add((lines[k], lines[k + 1]))
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    out = line_dedup.dedup_lines(docs(rows), chosen=line_dedup.DIVISOR)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want and want != dict(rows)


@pytest.mark.parametrize("length, least", [(2, 0.0), (3, 0.3), (6, 0.9), (20, 0.97)])
def test_lines_recall_of_planted_passages(docs, length, least):
    rows = []
    for i in range(300):
        passage = [f"passage {i} {k} {length}" for k in range(length)]
        for copy in (0, 1000):
            around = [f"own {i} {copy} {k} {length}" for k in range(6)]
            rows.append((i + copy, "\n".join(around[:3] + passage + around[3:])))
    out = line_dedup.dedup_lines(docs(rows)).collect()
    removed = {r["doc_id"]: r["_n_removed"] for r in out}
    assert sum(removed[i] for i in range(300)) == 0
    share = sum(removed[i + 1000] for i in range(300)) / (300 * length)
    print(f"{length} lines: {share:.3f}")
    assert least <= share <= 1


def test_lines_of_repeated_rows_and_no_rows(docs, found):
    text = "\n".join(f"l{i}" for i in range(12))
    out = line_dedup.dedup_lines(docs([(1, text), (1, text), (1, text + "\nend"), (None, text)]))
    removed = defaultdict(list)
    for r in out.collect():
        removed[r["doc_id"]].append(r["_n_removed"])
    assert max(removed[None]) == 0 and min(removed[1]) > 0  # a null id comes first
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_lines_keep_other_columns(docs):
    df = docs([(1, "a\nb", "en", "s")], clash=True)
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "_n_lines", "_n_removed"]
    assert out.first()["source"] == "s"
