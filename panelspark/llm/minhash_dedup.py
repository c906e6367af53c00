"""Near-duplicate documents by SuperMinHash, banding, verification on full sets and union-find.

A document is the set of its word shingles. SuperMinHash draws for each element a permutation of
the lanes and gives the lane at rank j a value in [j, j + 1): ranks are correlated within an
element, which lowers the variance, and levels above the largest lane value need not be looked
at, which ends most texts after one or two levels.

Equal sets are one set from the start. Candidates share a band. Instead of all pairs of a bucket,
stars are verified: in each round every document is compared with one pivot of one of its
buckets, which joins a group of any size in a few linear rounds. Only what then still lies apart
in a bucket is compared pair by pair: in blocks by signature, then on the full sets, documents of
the smaller component visiting the pages of the larger one until one links them. Nothing is
capped and no pair is a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import (
    LOWER,
    components,
    done_with,
    in_runs,
    mix,
    partitions,
    pieces,
    saved,
    word_hashes,
    word_starts,
)

#: Bands and lanes per band. Two sets of similarity 0.8 share no band with probability 5e-5.
BANDS, ROWS = 25, 5
LANES = BANDS * ROWS
#: Star rounds before the rest of a bucket is compared pair by pair: at most so many, and none
#: after one that links under FEW of the documents still apart. Documents per block.
ROUNDS, FEW, BLOCK = 6, 0.05, 128
#: Signatures that agree in fewer lanes than this many standard deviations below the threshold
#: are not candidates (one sided: 3e-5).
SIGMAS = 4.0
_R = 25
_STEP = 0x9E3779B97F4A7C15


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets of 64-bit shingle hashes) for runs of texts."""
    for first, last, data, offsets in pieces(column):
        data = LOWER[data]
        starts, before = word_starts(data, offsets)
        words = word_hashes(data, starts)
        folded = words.copy()
        for i in range(1, min(width, len(words))):
            folded = mix(folded[:-1] * np.uint64(_STEP) + words[i:])
        sets = []
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            if b - a >= width:
                sets.append(np.unique(folded[a : b - width + 1]))
            elif b > a:
                one = words[a : a + 1]
                for i in range(a + 1, b):
                    one = mix(one * np.uint64(_STEP) + words[i : i + 1])
                sets.append(one + np.uint64(b - a))  # a short text is no shingle of a longer one
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def super_min_hash(elements: np.ndarray, owner: np.ndarray, n: int, lanes: int = LANES) -> np.ndarray:
    """Signatures (n, lanes) of n sets whose elements are listed with their owner. Rank and fraction
    of a lane are one number: rank * 2^25 + fraction."""
    signature = np.full((n, lanes), 0xFFFFFFFF, np.uint32)
    flat = signature.reshape(-1)
    permutation, at = None, None
    for level in range(lanes):
        draw = mix(elements + np.uint64((level + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
        pick = level + ((draw >> np.uint64(32)) * np.uint64(lanes - level) >> np.uint64(32)).astype(np.int64)
        if permutation is None:
            slot = pick
        else:
            slot = permutation[at, pick].astype(np.int64)
            permutation[at, pick] = permutation[:, level]
        value = (draw & np.uint64((1 << _R) - 1)).astype(np.uint32) | np.uint32(level << _R)
        np.minimum.at(flat, owner * lanes + slot, value)
        open_sets = signature.max(axis=1) >= np.uint32(level + 1 << _R)
        going = open_sets[owner]
        left = np.count_nonzero(going)
        if not left or level == lanes - 1:
            break
        if level == 0 or left < 0.7 * len(going):
            elements, owner = elements[going], owner[going]
            if level == 0:
                permutation = np.tile(np.arange(lanes, dtype=np.uint8), (left, 1))
                permutation[np.arange(left), pick[going]] = 0
            else:
                permutation = permutation[going]
            at = np.arange(left)
    return signature


def _features(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), width):
                sizes = np.array([len(s) for s in sets])
                elements = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), sizes)
                signature = super_min_hash(elements, owner, len(sets))
                bands = np.zeros((len(sets), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    bands = mix(bands * np.uint64(_STEP) + signature[:, r::ROWS])
                low = (signature ^ signature >> np.uint32(16)).astype(np.uint16)
                ends = np.append(0, np.cumsum(sizes))
                sums = []
                for salt in (1, 2):
                    total = np.append(np.uint64(0), np.cumsum(mix(elements + np.uint64(salt * _STEP & (2**64 - 1))), dtype=np.uint64))
                    sums.append((total[ends[1:]] - total[ends[:-1]]).astype(np.int64))
                columns = [
                    batch.column("doc_id").slice(first, len(sets)),
                    pa.array(sizes.astype(np.int64)),
                    *map(pa.array, sums),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.view(np.int64).ravel())),
                    pa.array([row.tobytes() for row in low], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "h1", "h2", "bands", "lanes"])

    return work


def _linked(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y), 1):
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return both > 0 and 100 * both >= threshold * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= threshold * union."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [s for _, sets in shingle_sets(batch.column("ta"), width) for s in sets]
            right = [s for _, sets in shingle_sets(batch.column("tb"), width) for s in sets]
            linked = [_linked(x, y, threshold) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a")
    both = with_a.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long")


def _stars(members: DataFrame, round_no: int) -> DataFrame:
    """One pair (a, b) per document: itself and the pivot of one of its undecided buckets."""
    order = F.col("doc") if round_no == 0 else F.xxhash64("doc", F.lit(round_no))
    pivots = members.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "doc", "component")).alias("p"))
    pivots = pivots.select("bucket", F.col("p.doc").alias("b"), F.col("p.component").alias("c"))
    apart = members.join(pivots, "bucket").filter("component <> c")
    return apart.groupBy(F.col("doc").alias("a")).agg(F.min("b").alias("b"))


def _undecided(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(bucket, doc, component) of the buckets that still hold several components."""
    members = members.select("bucket", "band", "doc")
    if labels is None:
        return members.withColumn("component", F.col("doc"))
    labels = labels.withColumnRenamed("node", "doc")
    members = members.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    several = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return members.join(several.filter("lo < hi").select("bucket"), "bucket")


def _narrowed(members: DataFrame, labels: DataFrame | None, label: str) -> DataFrame:
    left = saved(_undecided(members, labels), label)
    done_with(members)
    return left


def _sized(members: DataFrame) -> DataFrame:
    """(doc, component, size, page): a component's size in documents; pages hold about BLOCK of them."""
    docs = members.select("doc", "component").distinct()
    sizes = docs.groupBy("component").agg(F.count("*").alias("size"))
    page = F.pmod(F.xxhash64("doc"), F.ceil(F.col("size") / BLOCK))
    return docs.join(sizes, "component").select("doc", "component", "size", page.alias("page"))


def _least_agreement(threshold: int) -> int:
    share = threshold / 100
    return int(np.ceil(LANES * share - SIGMAS * np.sqrt(LANES * share * (1 - share))))


def _lanes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, LANES)


def _rest(members: DataFrame, lanes: DataFrame, threshold: int) -> DataFrame:
    """(doc, other): documents and the components, no smaller than their own, in which some document
    shares a bucket with them and has a signature close to theirs. A pair counts in the first of
    the buckets that it shares."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    rows = members.drop("component").join(sizes, "bucket").withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("n")))
    rows = rows.join(lanes, "doc").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    keys, least = ["bucket", "i", "j"], _least_agreement(threshold)

    def close(lanes: np.ndarray, band: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        near = []
        for p in range(0, len(a), 20_000):
            same = lanes[a[p : p + 20_000]] == lanes[b[p : p + 20_000]]
            enough = np.flatnonzero(same.sum(axis=1) >= least)
            first = same[enough].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            near.append(p + enough[first == band[a[p + enough]]])
        return np.concatenate(near)

    def work(table: pa.Table) -> pa.Table:
        doc, component, mine, bucket, band, i, j, size = (
            table[c].to_numpy() for c in ("doc", "component", "mine", "bucket", "band", "i", "j", "size")
        )
        lanes = _lanes(table["lanes"])
        new = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        out, held, looked = [np.zeros((0, 2), np.int64)], [], 0
        for lo, hi in zip(new, np.append(new[1:], len(doc))):
            a, b = np.triu_indices(hi - lo, 1)
            a, b = a + lo, b + lo
            apart = component[a] != component[b]
            if i[lo] != j[lo]:
                apart &= mine[a] != mine[b]
            held.append((a[apart], b[apart]))
            looked += len(a)
            if looked > 200_000 or hi == len(doc):
                a, b = (np.concatenate(x) for x in zip(*held))
                if len(a):
                    near = close(lanes, band, a, b)
                    a, b = a[near], b[near]
                    turn = (size[b] < size[a]) | (size[b] == size[a]) & (component[b] < component[a])
                    a, b = np.where(turn, b, a), np.where(turn, a, b)
                    out.append(np.unique(np.stack([doc[a], component[b]], axis=1), axis=0))
                held, looked = [], 0
        pairs = np.unique(np.concatenate(out), axis=0)
        return pa.table({"doc": pairs[:, 0], "other": pairs[:, 1]})

    rows = rows.select(*keys, "band", "doc", "component", "mine", "size", "lanes")
    rows = rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(in_runs(keys, work), "doc long, other long").distinct()


def _visited(visits: DataFrame, sized: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """Links (a, b) between visitors and components, one for each page at most.

    The documents of a page lie ready and visitors pass by, so pairs are never rows. A page with
    many visitors is laid out several times. ``texts`` has doc, text and lanes.
    """
    pages = sized.groupBy("component").agg(F.max("page").alias("last")).withColumnRenamed("component", "other")
    guests = visits.join(pages, "other").withColumn("page", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    times = guests.groupBy("other", "page").agg(F.ceil(F.count("*") / (4 * BLOCK)).alias("n"))
    guests = guests.join(times, ["other", "page"]).withColumn("part", F.pmod(F.xxhash64("doc"), F.col("n")))
    homes = sized.select("doc", F.col("component").alias("other"), "page").join(times, ["other", "page"])
    homes = homes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keys, least = ["other", "page", "part"], _least_agreement(threshold)
    rows = homes.select(*keys, F.lit(0).alias("guest"), "doc").unionAll(guests.select(*keys, F.lit(1).alias("guest"), "doc"))
    rows = rows.join(texts, "doc").repartition(partitions(rows.sparkSession), *keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = [], None  # (doc, set, lanes) of the page
        for batch in batches:
            sets = [s for _, sets in shingle_sets(batch.column("text"), width) for s in sets]
            names = [batch.column(c).to_pylist() for c in (*keys, "guest", "doc")]
            links = []
            for mine, lane, *key, guest, doc in zip(sets, _lanes(batch.column("lanes")), *names):
                if at != key:
                    here, at, table = [], key, None
                if not guest:
                    here.append((doc, mine, lane))
                    continue
                if table is None:
                    table = np.array([x[2] for x in here])
                near = (table == lane).sum(axis=1)
                for k in np.argsort(-near, kind="stable"):
                    if near[k] < least:
                        break
                    if _linked(mine, here[k][1], threshold):
                        links.append((doc, here[k][0]))
                        break
            a, b = (pa.array(c, pa.int64()) for c in (zip(*links) if links else ([], [])))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    return rows.sortWithinPartitions(*keys, "guest").mapInArrow(work, "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: int = 80, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Words are runs of anything but ASCII whitespace, A-Z in lower case. A text of fewer than
    ``width`` words is one shingle of all its words; null and blank texts have none and link with
    nothing. Links need 100 * intersection >= ``threshold`` * union; ``component_id`` is the
    smallest id reachable over links. Rows that share an id are one node. A null id has a null
    component and is kept.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, lanes binary"
    features = saved(rows.mapInArrow(_features(width), schema), "near-features")
    same = ["n_shingles", "h1", "h2"]
    sets = features.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    of_set = features.select("doc_id", *same).join(sets, same)
    copies = saved(of_set.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "near-copies")
    reps = features.join(copies.select(F.col("a").alias("doc_id")), "doc_id", "left_anti").filter("n_shingles > 0")
    reps = reps.filter("doc_id IS NOT NULL")
    buckets = reps.select(F.posexplode("bands").alias("band", "bucket"), F.col("doc_id").alias("doc"))
    shared = buckets.groupBy("bucket").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi")
    members = saved(buckets.join(shared.select("bucket"), "bucket"), "near-buckets")
    involved = members.select("doc").distinct()
    texts = saved(rows.withColumnRenamed("doc_id", "doc").join(involved, "doc", "left_semi"), "near-texts")

    links, labels = None, None
    for round_no in range(rounds):
        members = _narrowed(members, labels, f"near-open-{round_no}")
        found = saved(_verified(_stars(members, round_no), texts, width, threshold), f"near-links-{round_no}")
        links = found if links is None else links.unionAll(found)
        labels = components(links, f"near-{round_no}")
        if found.count() < FEW * members.select("doc").distinct().count():
            break
    members = _narrowed(members, labels, "near-open")
    sized = saved(_sized(members), "near-sizes")
    lanes = reps.select(F.col("doc_id").alias("doc"), "lanes")
    visits = saved(_rest(members, lanes.join(sized.drop("page"), "doc"), threshold), "near-visits")
    texts = texts.join(lanes, "doc")
    links = links.unionAll(saved(_visited(visits, sized, texts, width, threshold), "near-links"))
    groups = components(links.unionAll(copies), "near").withColumnRenamed("node", "doc_id")
    out = features.select("doc_id", "n_shingles").join(groups, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
