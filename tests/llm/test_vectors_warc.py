"""Embedding near-dedup and WARC archives."""

import gzip
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import embedding_dedup, warc
from panelspark.session import scratch_dir
from tests.llm.test_dedup import roots

# -- vectors


def clusters(seed, sizes, dim=16, spread=0.05):
    rng = np.random.default_rng(seed)
    return [(c + spread * rng.standard_normal(dim)).tolist() for n in sizes for c in [rng.standard_normal(dim)] for _ in range(n)]


def linked(rows, threshold=0.93):
    ok = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v) / np.linalg.norm(v), label
    ids = sorted(ok)
    return [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= threshold
    ]


@pytest.mark.parametrize("window", [4, 256])
def test_vectors_match_brute_force(spark, found, window):
    vectors = clusters(1, [1] * 80 + [2] * 20 + [40, 7])
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[150], 0) for i in range(30)]  # equal vectors
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [1e-200] * 16, [1e200] * 16]
    rows += [(2000 + i, v, 1) for i, v in enumerate(odd)] + [(3000, vectors[0], None), (3001, vectors[0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    df = df.withColumn("component", F.lit(1)).withColumn("node", F.lit(1)).withColumn("dim", F.lit("x"))
    links = linked([(i, v, la) for i, v, la in rows if i not in (2008, 2009)]) + [(2008, 2009)]
    want = roots([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = found(embedding_dedup.near_vectors(df, window=window, passes=40 if window == 4 else None), "vec_id", "n_links", "component_id", "kept")
    assert got == [(i, degree[i], want[i], want[i] == i) for i in sorted(degree)]


def test_vectors_float_nulls_and_no_rows(spark, found):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert found(embedding_dedup.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == [
        (None, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
    ]
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_passes_grow_with_the_table():
    few, many = embedding_dedup.passes_for(1000, 0.93), embedding_dedup.passes_for(10**9, 0.93)
    assert 4 <= few < many < 200


def leaning(seed, n, pairs, mean_cosine, dim=64):
    """Vectors with a common direction, then partners of the first ``pairs`` at a cosine of 0.931 to 0.95."""
    rng = np.random.default_rng(seed)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    side = lambda k: unit(np.hstack([np.zeros((k, 1)), rng.standard_normal((k, dim - 1))]))
    head = np.eye(dim)[:1]
    rest = side(n)
    a = math.sqrt(mean_cosine) * head + math.sqrt(1 - mean_cosine) * rest
    cosine = (rng.uniform(0.931, 0.95, (pairs, 1)) - mean_cosine) / (1 - mean_cosine)
    other = side(pairs)
    other = unit(other - (other * rest[:pairs]).sum(1, keepdims=True) * rest[:pairs])
    b = math.sqrt(mean_cosine) * head + math.sqrt(1 - mean_cosine) * (cosine * rest[:pairs] + np.sqrt(1 - cosine**2) * other)
    return np.vstack([a, b])


@pytest.mark.parametrize("window", [8, 64])
def test_links_of_a_label_that_leans_one_way(spark, window):
    m = leaning(3, 6000, 400, 0.8)
    n = embedding_dedup.measured_passes(m, len(m), 0.93, window)
    assert n > 1.5 * embedding_dedup.passes_for(len(m), 0.93, window)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_vectors(df, window=window).collect()}
    assert len(got) == len(m) and sum(got[i] == got[6000 + i] for i in range(400)) >= 399

@pytest.mark.parametrize("rows", [200, 5000, 20_000])
def test_a_label_of_any_size_goes_through_windows(spark, monkeypatch, rows):
    """No label has all its pairs compared unless that is asked for; planted links are found."""
    rng = np.random.default_rng(rows)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    n = rows // 10
    a = unit(rng.standard_normal((rows - n, 32)))
    other = rng.standard_normal((n, 32))
    other = unit(other - (other * a[:n]).sum(1, keepdims=True) * a[:n])
    cosine = rng.uniform(0.931, 0.95, (n, 1))
    m = np.vstack([a, cosine * a[:n] + np.sqrt(1 - cosine**2) * other])
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<double>, label int")
    passes = []
    plan = embedding_dedup._with_passes
    monkeypatch.setattr(embedding_dedup, "_with_passes", lambda *a: passes.append(plan(*a)) or passes[0])
    monkeypatch.setattr(embedding_dedup, "_all_pairs", None)
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_vectors(df).collect()}
    [planned] = passes[0].collect()
    assert planned["passes"] >= (1 if rows == 200 else embedding_dedup.LEAST_PASSES)
    assert len(got) == rows and sum(got[i] == got[rows - n + i] for i in range(n)) >= 0.99 * n
    monkeypatch.undo()
    if rows == 5000:
        every = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_vectors(df, all_pairs=True).collect()}
        assert sum(got[i] != every[i] for i in every) <= 0.01 * n


# -- warc

HTML = [
    (1, "http://a/ b", "<p>é</p>" * 400), (2, "http://a/2", "x" * 999), (3, "http://a/3", "x" * 999), (4, None, None), (5, "", ""),
    (6, "http://a/6", "<p>é</p>" * 400), (7, "http://a/7", "WARC/1.1\r\n\r\n0\r\n\r\n" * 300), (8, "http://a/8", "漢" * 60_000),
    (9, "http://a/9", "<p>é</p>" * 400), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (11, "u", "y" * 1000), (None, "u", "z" * 2000), (12, "u", "z" * 2000),
]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    return df.withColumn("digest", F.lit("x")).withColumn("bytes", F.lit(1)).withColumn("head", F.lit(1))


def test_round_trip(spark, found):
    got = found(warc.round_trip(pages(spark, HTML)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
    head = {}
    for i, _, html in HTML:
        if i is not None:
            head[html or ""] = max(head.get(html or "", i), i)
    want = []
    for i, _, html in HTML:
        data = (html or "").encode()
        again = len(data) >= 1000 and head[html or ""] != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", head[html or ""] if again else None, None))
    assert got == sorted(want, key=lambda r: tuple((v is not None, v) for v in r))
    assert warc.round_trip(pages(spark, HTML[:0])).count() == 0


def test_segments_payloads_and_addresses_come_back(spark):
    path = scratch_dir(spark, "test-warc")
    warc.write_warc(pages(spark, HTML), path, segment=200)
    parts = warc.read_records(spark, path)
    assert parts.filter("kind = 'continuation'").count() > 500
    back = {r["record_id"].split(":")[2]: r for r in warc.read_warc(spark, path).collect()}
    assert back["8"]["payload"].decode() == "漢" * 60_000 and back["7"]["payload"].decode() == HTML[6][2]
    assert back["9"]["uri"] == "http://a/9" and back["1"]["uri"] == "http://a/%20b" and back["4"]["payload"] == b""


def archive(spark, *members):
    path = scratch_dir(spark, "test-warc")
    from pathlib import Path

    Path(path).mkdir(parents=True)
    (Path(path) / "a.warc.gz").write_bytes(b"".join(gzip.compress(m + b"\r\n\r\n") for m in members))
    return {r["record_id"]: r for r in warc.read_warc(spark, path).collect()}


def test_damaged_records_are_named(spark):
    digest = hashlib.sha1(b"p" * 5000).hexdigest()
    whole = list(warc.records(1, "u", b"p" * 5000, digest, None, 5000, 1000))
    me = whole[0].split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0].decode()
    assert archive(spark, *reversed(whole))[me]["payload"] == b"p" * 5000
    assert "missing" in archive(spark, *whole[:2], *whole[3:])[me]["problem"]
    assert "missing" in archive(spark, *whole[:-1])[me]["problem"]
    longer = whole[-1].replace(b"Total-Length: ", b"Total-Length: 1")
    assert "total length" in archive(spark, *whole[:-1], longer)[me]["problem"]
    wrong = [w.replace(digest.encode(), b"0" * 40) for w in whole]
    got = archive(spark, *wrong)
    assert "digest" in next(iter(got.values()))["problem"]


def test_chunked_framing():
    body = "añb".encode() * 3000
    assert warc.unchunked(warc.chunked(body, 7)) == body and warc.unchunked(b"0\r\n\r\n") == b""
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for broken in (b"3\r\nabcd\r\n0\r\n\r\n", b"5\r\nabc", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)
