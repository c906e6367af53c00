"""Vector compression against brute force."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from panelspark.llm import vector_codes as vc


def brute(rows, parts=4, entries=256, rounds=4):
    """(id, label, codes, error, label_error) and the digest of the codebooks, with Python integers."""
    kept = [(i, la, [math.floor(1024 * x) for x in v]) for i, v, la in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, _, v in kept), default=0)
    dim = -(-dim // parts) * parts
    width = dim // parts
    kept = [(i, la, v + [0] * (dim - len(v))) for i, la, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(p, c[p])[1] for c in cut]
            for k in set(at):
                mine = [c[p] for c, a in zip(cut, at) if a == k]
                books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    out, by_label = [], {}
    for (i, la, _), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = min(sum(d for d, _ in found), 2**63 - 1)
        by_label[la] = by_label.get(la, 0) + error
        out.append((i, la, [k for _, k in found], error))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [(*r, min(by_label[r[1]], 2**63 - 1)) for r in out], hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, entries, schema="vec_id long, embedding array<double>, label int"):
    df = spark.createDataFrame(rows, schema).repartition(4)
    for c in ("id", "v", "codes", "sizes", "name", "part"):
        df = df.withColumn(c, F.lit("x"))
    got, books = vc.compress(df, entries=entries)
    order = lambda r: (r[0] is None, r[0] or 0, str(r))
    want, digest = brute(rows, entries=entries)
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(want, key=order)
    assert books.sha256() == digest
    return books


@pytest.mark.parametrize("entries", [4, 16, 256])
def test_codes_match_brute_force(spark, entries):
    rng = random.Random(entries)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], rng.choice([0, 1, None])) for i in range(300)]
    rows += [(900 + i, rows[7][1], 1) for i in range(9)] + [(3, rows[3][1], 0), (None, rows[5][1], 0)]
    rows += [(950, None, 0), (951, [None] + [0.0] * 11, 0), (952, [float("nan")] * 12, 0), (953, [float("-inf")] * 12, 1)]
    check(spark, rows, entries)


def test_few_odd_and_large_vectors(spark):
    check(spark, [(5, [0.1, -0.2, 0.3], 1), (4, [], None), (6, [1.0] * 6, 1)], 256)
    check(spark, [(i, [s * 1e6, 2.0**40, -3.5, s * 1e9], 0) for i, s in enumerate([1, -1, 0.5, 2, 2])], 2)
    check(spark, [(1, [], 0), (2, [], 0)], 4)
    huge = spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    got, _ = vc.compress(huge, entries=1)
    assert [r["error"] for r in got.collect()] == [2**63 - 1] * 2


def test_no_vectors_and_decoding(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label string")
    got, books = vc.compress(none)
    assert got.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    rows = [(1, [0.5, 0.25, -1.0, 2.0], "a")]
    got, books = vc.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"))
    assert vc.decoded(got.first()["codes"], books) == rows[0][1]
