"""Benchmark decontamination against brute force."""

import random
import re

from pyspark.sql import functions as F

from panelspark.llm import decontamination as dc

ITEMS = "item_id long, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


def brute(docs, items, window=10):
    won = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            won.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in won}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in won:
                    hit.update(range(i, i + k))
                    found |= won[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def check(found, docs_df, docs, items_df, items, **more):
    got = dc.contamination(docs_df, items_df, **more)
    got = got.withColumn("list", F.array_join("items", ","))
    assert found(got, "doc_id", "n_words", "n_hit", "list") == brute(docs, items, more.get("window", 10))
    return got


def test_planted_passages(spark, docs, found):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([12, 25, 10, 40])))) for i in range(30)]
    items += [(i, items[i % 30][1]) for i in range(30, 34)]  # equal items
    rows = []
    for i in range(200):
        text = [word() for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(3)):
            w = items[rng.randrange(30)][1].split()
            low = rng.randrange(len(w) - 8)
            at = rng.randrange(len(text))
            text[at:at] = w[low : low + rng.randrange(8, 20)]
        rows.append((i, rng.choice([" ", "\n", "-", "__"]).join(text).upper() if i % 3 else " ".join(text)))
    df = docs(rows, clash=True).withColumn("n_words", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("wid", F.lit(1))
    items_df = spark.createDataFrame(items, ITEMS).withColumn("k", F.lit(1)).withColumn("passage", F.lit("x"))
    got = check(found, df, rows, items_df, items)
    assert {r["doc_id"] for r in got.filter("n_hit > 0").select("doc_id").collect()} != set()
    assert got.filter("n_hit <> aggregate(spans, 0L, (n, s) -> n + s.length)").isEmpty()
    assert got.filter("exists(spans, s -> s.start < 0 OR s.start + s.length > n_words)").isEmpty()
    assert set(got.columns) >= {"component", "digest", "text", "lang"}


def test_short_items_case_and_odd_rows(spark, docs, found):
    items = [(1, "The"), (2, "of the"), (3, "É one"), (4, None), (5, " ... "), (6, "a b c d e f g h i j k"), (None, "x y z q"), (7, "K2")]
    rows = [
        (1, None), (2, ""), (3, "of THE of the"), (4, "é one"), (5, "É ONE"), (6, "a b c d e f g h i j"), (7, "b-c-d-e-f-g-h-i-j-k"),
        (8, "a b c d e f g h i"), (None, "x y z q"), (9, "X y Z\x00q the"), (9, "x y z q the"), (9, "x y z q the"), (9, "nothing"),
        (10, "K2 k2"), (11, "the " * 40_000), (12, "the of the"),
    ]
    check(found, docs(rows), rows, spark.createDataFrame(items, ITEMS), items)
    for none in ([], [(1, None)]):
        check(found, docs(rows), rows, spark.createDataFrame(none, ITEMS), none)
    check(found, docs([]), [], spark.createDataFrame(items, ITEMS), items)
    check(found, docs(rows), rows, spark.createDataFrame(items, ITEMS), items, window=3, shingle=2)


def test_without_broadcast_and_without_python(spark, docs, found, plan, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(11))) for i in range(8)]
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(30)) + " " + items[i % 8][1]) for i in range(40)]
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    got = check(found, docs(rows), rows, spark.createDataFrame(items, ITEMS), items)
    assert not re.search("Python|Arrow|Pandas", plan(got))
    shingles = plan(dc._shingles(docs(rows).selectExpr("doc_id AS _id", "text AS _text"), [3], "_id"))
    assert not re.search("Python|Arrow|Pandas|Exchange Hash", shingles)
