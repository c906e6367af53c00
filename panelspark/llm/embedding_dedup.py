"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors of a label lexicographically by the concatenated signs of random
projections and compares every vector with a bounded window of its neighbours. How many passes a
label needs is measured on a sample of its own vectors, as vectors that lean one way share signs;
a label that fits into a window has one pass, which misses nothing. Pairs that reach the
threshold are united across passes; inside every group found, all pairs are then compared in
blocks, which counts the links exactly however many there are. Equal vectors are one vector with
a multiplicity throughout, and each window hands on a spanning forest of its links, so a group
of any size costs a few rows per vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import components, in_runs, partitions, saved

#: Signs per pass, neighbours compared on either side, vectors per block of a group.
BITS, WINDOW, BLOCK = 62, 256, 256
#: Vectors per block of a label whose pairs are all compared.
ALL_BLOCK = 512
#: Share of links at the threshold that all passes together may miss.
MISS = 1e-4
#: To measure passes: vectors sampled from a label, pairs at the threshold made of them, passes tried.
SAMPLE, PROBES, TRIALS = 8192, 256, 32
LEAST_PASSES, MOST_PASSES = 4, 1 << 12

_ROWS = "vec_id long, label string, dim int, vec binary"


def passes_for(rows: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has met in a window but for ``miss``: two vectors
    share a sign with probability 1 - angle / pi and must share log2(rows / window) of them."""
    same = 1 - math.acos(threshold) / math.pi
    once = same ** max(1.0, math.log2(max(rows, 2) / window) + 1)
    return max(LEAST_PASSES, math.ceil(math.log(miss) / math.log(1 - min(once, 0.999))))


def _planes(seed: int, p: int, dim: int, bits: int) -> np.ndarray:
    return np.random.default_rng([seed, p, dim]).standard_normal((dim, bits))


def _keys(m: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return ((m @ planes) > 0) @ (1 << np.arange(planes.shape[1], dtype=np.int64)[::-1])


def measured_passes(units: np.ndarray, rows: int, threshold: float, window: int = WINDOW, miss: float = MISS, seed: int = 7) -> int:
    """:func:`passes_for` a label of so many rows, of which ``units`` are a sample; 1 where a window
    holds them all.

    Pairs at the threshold, apart in a direction in which the label's vectors differ, are put into
    the order of some passes; those with no more than a window's share of the sample between them
    would have met. Shares too small for the sample are carried on from larger ones. The chance to
    meet differs from pair to pair, as a beta distribution of the mean and spread found.
    """
    if rows <= window + 1:
        return 1
    dim, rng = units.shape[1], np.random.default_rng([seed, rows])
    one, two, three = rng.integers(len(units), size=(3, PROBES))
    apart = units[two] - units[three] + 1e-9 * rng.standard_normal((PROBES, dim))
    apart -= (apart * units[one]).sum(axis=1, keepdims=True) * units[one]
    apart /= np.maximum(np.sqrt((apart * apart).sum(axis=1, keepdims=True)), 1e-300)
    other = threshold * units[one] + math.sqrt(max(0.0, 1 - threshold * threshold)) * apart
    between = np.empty((TRIALS, PROBES), np.int64)
    for p in range(TRIALS):
        planes = _planes(seed, p, dim, BITS)
        keys = _keys(units, planes)
        ends = np.sort([keys[one], _keys(other, planes)], axis=0)
        keys = np.sort(keys)
        between[p] = np.searchsorted(keys, ends[1], "right") - np.searchsorted(keys, ends[0])
    share = window / rows
    seen = max(share, 8 / len(units))
    met = between <= seen * len(units)
    mean = met.mean()
    chance = max(mean - met.mean(axis=1).std(ddof=1) / math.sqrt(TRIALS), 1 / met.size)
    mean = max(mean, chance)
    if share < seen:
        wider = (between <= 16 * seen * len(units)).mean()
        chance *= (share / seen) ** (math.log(wider / mean) / math.log(16))
    each = met.mean(axis=0)
    spread = max(each.var() - (each * (1 - each)).mean() / (TRIALS - 1), 0) / mean**2
    both = (1 - chance) / max(spread * chance, 1e-6) - 1
    a, b = chance * both, (1 - chance) * both

    def missed(n: int) -> float:
        if chance >= 1 or both <= 0:
            return -math.inf if chance >= 1 else 0.0
        return math.lgamma(both) + math.lgamma(b + n) - math.lgamma(b) - math.lgamma(both + n)

    low, high = passes_for(rows, threshold, window, miss), MOST_PASSES
    if missed(high) > math.log(miss):
        raise ValueError("vectors of a label lean one way too much for sorted passes; ask for all pairs or a wider window")
    while low < high:
        n = (low + high) // 2
        low, high = (low, n) if missed(n) <= math.log(miss) else (n + 1, high)
    return low


def valid_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, dim, vec) of usable vectors; bytes as float64, or float32 if they came so."""
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    rows = vectors.filter(F.col(label).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast(kind).alias("v")
    )
    dtype = np.float32 if kind == "array<float>" else np.float64

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, packed = [], []
            for i, v in enumerate(batch.column("v")):
                values = v.values
                if values is None or not len(values) or values.null_count:
                    continue
                values = values.to_numpy(zero_copy_only=False).astype(dtype)
                if np.isfinite(values).all() and values.any():
                    keep.append(i)
                    packed.append(values.tobytes())
            found = batch.take(pa.array(keep, pa.int64()))
            dims = pa.array([len(x) // dtype().itemsize for x in packed], pa.int32())
            columns = [found.column("vec_id"), found.column("label"), dims, pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "dim", "vec"])

    return rows.mapInArrow(work, _ROWS)


def _matrix(column, dim: int, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dim).astype(np.float64)


def _units(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _with_passes(unique: DataFrame, threshold: float, window: int, passes: int | None, seed: int, dtype) -> DataFrame:
    """(label, dim, rows, passes) of every label and dimension; 0 passes: all pairs."""
    group = ["label", "dim"]
    sizes = saved(unique.groupBy(*group).agg(F.count("*").alias("rows")), "vectors-sizes")
    if passes is not None:
        return sizes.withColumn("passes", F.lit(passes))
    large = sizes.filter(F.col("rows") > window + 1)
    sample = unique.join(large, group).filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col("rows")) < SAMPLE)

    def work(table: pa.Table) -> pa.Table:
        out = {"label": [], "dim": [], "passes": []}
        for lo, hi, dim in _runs(table, group):
            part = table.slice(lo, hi - lo)
            units = _units(_matrix(part["vec"], dim, dtype))
            n = measured_passes(units, part["rows"][0].as_py(), threshold, window, seed=seed)
            for k, v in zip(out, (part["label"][0].as_py(), dim, n)):
                out[k].append(v)
        return pa.table({k: pa.array(v, pa.string() if k == "label" else pa.int32()) for k, v in out.items()})

    sample = sample.select(*group, "rows", "vec_id", "vec").repartition(partitions(unique.sparkSession), *group)
    sample = sample.sortWithinPartitions(*group, "vec_id")
    measured = sample.mapInArrow(in_runs(group, work), "label string, dim int, passes int")
    found = sizes.join(measured, group, "left").withColumn("passes", F.coalesce("passes", F.lit(1)))
    return saved(found, "vectors-passes")


def _projected(rows: DataFrame, bits: int, seed: int, dtype) -> DataFrame:
    """rows once per pass of their label, with the sort key of the pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = batch.filter(pa.array(dims == dim))
                m = _matrix(mine.column("vec"), int(dim), dtype)
                n_passes = mine.column("passes").to_numpy()
                for p in range(n_passes.max()):
                    if (n_passes <= p).any():
                        more = n_passes > p
                        mine, m, n_passes = mine.filter(pa.array(more)), m[more], n_passes[more]
                    keys = _keys(m, _planes(seed, p, int(dim), bits))
                    pass_no = pa.array(np.full(len(keys), p, np.int32))
                    columns = [pass_no, mine.column("label"), mine.column("dim"), pa.array(keys, pa.int64())]
                    columns += [mine.column("vec_id"), mine.column("vec")]
                    yield pa.RecordBatch.from_arrays(columns, ["pass", "label", "dim", "key", "vec_id", "vec"])

    return rows.mapInArrow(work, "pass int, label string, dim int, key long, vec_id long, vec binary")


def _forest(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the same things connected: one per vector at most."""
    root = np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(ids[a]), int(ids[b])))
    return out


def _windows(sorted_rows: DataFrame, threshold: float, window: int, dtype) -> DataFrame:
    """(a, b) links inside partitions, and the rows on either side of each border between them."""
    group = ["pass", "label", "dim"]
    edge = [*group, "vec_id", "vec"]
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    names = ["a", "b", "border", "side", *edge]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        nulls = [pa.nulls(0, k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), *kinds)]

        def links(pairs):
            a, b = (pa.array(c, pa.int64()) for c in (zip(*pairs) if pairs else ([], [])))
            return pa.RecordBatch.from_arrays([a, b, *(pa.nulls(len(a), k.type) for k in nulls[2:])], names)

        def border(table: pa.Table, number: int, side: int):
            n = table.num_rows
            columns = [pa.nulls(n, pa.int64())] * 2 + [pa.array([x] * n, pa.int32()) for x in (number, side)]
            columns += [table[c].combine_chunks() if table[c].num_chunks != 1 else table[c].chunk(0) for c in edge]
            return pa.RecordBatch.from_arrays(columns, names)

        tail, head = None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                new = pa.Table.from_batches([batch.slice(at, 1024)]).select(edge)
                if head < window:
                    yield border(new.slice(0, window - head).combine_chunks(), part - 1, 1)
                    head += min(new.num_rows, window - head)
                both = pa.concat_tables([tail, new]) if tail is not None else new
                both = both.combine_chunks()
                first = both.num_rows - new.num_rows
                for lo, hi, dim in _runs(both, group):
                    if hi - lo > 1 and hi > first:
                        yield links(_linked(both.slice(lo, hi - lo), dim, max(0, first - lo), threshold, window, dtype))
                tail = both.slice(max(0, both.num_rows - window))
        if tail is not None and head:
            yield border(tail.combine_chunks(), part, 0)

    schema = "a long, b long, border int, side int, pass int, label string, dim int, vec_id long, vec binary"
    return sorted_rows.mapInArrow(work, schema)


def _runs(table: pa.Table, keys: list[str]) -> Iterator[tuple[int, int, int]]:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        column = table[key].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    at = np.append(np.flatnonzero(new), table.num_rows)
    dims = table["dim"].to_numpy()
    yield from ((int(a), int(b), int(dims[a])) for a, b in zip(at[:-1], at[1:]))


def _linked(rows: pa.Table, dim: int, first: int, threshold: float, window: int, dtype) -> list[tuple[int, int]]:
    """Links of each row from ``first`` on with the ``window`` rows before it."""
    units = _units(_matrix(rows["vec"], dim, dtype))
    close = units[first:] @ units.T >= threshold
    right, left = np.nonzero(close)
    right = right + first
    near = (left < right) & (right - left <= window)
    return _forest(rows["vec_id"].to_numpy(), left[near], right[near])


def _at_borders(rows: DataFrame, threshold: float, window: int, dtype) -> DataFrame:
    """Links over the border of two partitions."""

    def work(table: pa.Table) -> pa.Table:
        pairs = []
        for lo, hi, dim in _runs(table, ["border", "pass", "label", "dim"]):
            part = table.slice(lo, hi - lo)
            pairs += _linked(part, dim, 0, threshold, 2 * window, dtype) if hi - lo > 1 else []
        a, b = zip(*pairs) if pairs else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ["border", "pass", "label", "dim"]
    rows = rows.filter("border IS NOT NULL").drop("a", "b").repartition(partitions(rows.sparkSession), *keys)
    return rows.sortWithinPartitions(*keys, "side", "vec_id").mapInArrow(in_runs(keys, work), "a long, b long")


def _all_pairs(rows: DataFrame, threshold: float, block: int, dtype) -> DataFrame:
    """(a, b) links from (vec_id, label, dim, vec, rows): all pairs of a label, block by block."""
    blocks = F.ceil(F.col("rows") / block)
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64("vec_id"), blocks))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.withColumn("i", F.least("_mine", "_other")).withColumn("j", F.greatest("_mine", "_other"))
    keys = ["label", "dim", "i", "j"]

    def work(table: pa.Table) -> pa.Table:
        pairs = []
        for lo, hi, dim in _runs(table, keys):
            part = table.slice(lo, hi - lo)
            mine, ids = part["_mine"].to_numpy(), part["vec_id"].to_numpy()
            units = _units(_matrix(part["vec"], dim, dtype))
            # rows of the first block come before those of the second
            cut = int((mine == mine[0]).sum())
            if part["i"][0].as_py() == part["j"][0].as_py():
                left, right = np.nonzero(np.triu(units @ units.T >= threshold, 1))
            else:
                left, right = np.nonzero(units[:cut] @ units[cut:].T >= threshold)
                right = right + cut
            pairs += _forest(ids, left, right)
        a, b = zip(*pairs) if pairs else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = rows.select(*keys, "_mine", "vec_id", "vec").repartition(partitions(rows.sparkSession), *keys)
    return rows.sortWithinPartitions(*keys, "_mine", "vec_id").mapInArrow(in_runs(keys, work), "a long, b long")


def _counted(members: DataFrame, threshold: float, block: int, dtype) -> DataFrame:
    """(vec_id, n_links) from (component, vec_id, n, dim, vec): all pairs of a group, block by block."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).alias("_blocks"))
    rows = members.join(sizes, "component")
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64("vec_id"), F.col("_blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumn("i", F.least("_mine", "_other")).withColumn("j", F.greatest("_mine", "_other"))
    keys = ["component", "i", "j"]

    def work(table: pa.Table) -> pa.Table:
        ids, counts = [], []
        for lo, hi, dim in _runs(table, keys):
            part = table.slice(lo, hi - lo)
            units = _units(_matrix(part["vec"], dim, dtype))
            vec, n, mine = (part[c].to_numpy() for c in ("vec_id", "n", "_mine"))
            close = units @ units.T >= threshold
            np.fill_diagonal(close, False)
            if part["i"][0].as_py() != part["j"][0].as_py():
                close &= mine[:, None] != mine[None, :]
            ids.append(vec)
            counts.append(close @ n)
        return pa.table({"vec_id": np.concatenate(ids), "links": np.concatenate(counts)})

    rows = rows.select(*keys, "_mine", "vec_id", "n", "dim", "vec").repartition(partitions(rows.sparkSession), *keys)
    found = rows.sortWithinPartitions(*keys).mapInArrow(in_runs(keys, work), "vec_id long, links long")
    return found.groupBy("vec_id").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    window: int = WINDOW,
    passes: int | None = None,
    seed: int = 7,
    all_pairs: bool = False,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Links join vectors of equal, non-null label and equal dimension with a cosine of at least
    ``threshold`` in double precision. Null, empty, zero and non-finite vectors, and those with null
    components, link with nothing. A row with a null key has no links and is kept. Rows that repeat
    a key are vectors of their own in ``n_links`` and one node of the components. ``passes`` are
    measured unless given; ``all_pairs`` compares all vectors of a label instead, in blocks.
    """
    dtype = np.float32 if dict(vectors.dtypes)[vector] == "array<float>" else np.float64
    rows = valid_vectors(vectors, key, vector, label).filter("vec_id IS NOT NULL")
    rows = saved(rows.withColumn("same", F.md5("vec")), "vectors")
    reps = rows.groupBy("label", "dim", "same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    reps = saved(reps, "vectors-same")
    unique = rows.join(reps, ["label", "dim", "same"]).filter("vec_id = rep")
    unique = saved(unique.dropDuplicates(["label", "dim", "same"]).select("vec_id", "label", "dim", "vec", "n"), "vectors-unique")
    plan = _with_passes(unique, threshold, window, 0 if all_pairs else passes, seed, dtype)
    planned = unique.drop("n").join(plan, ["label", "dim"])
    copies = plan.agg(F.sum(F.col("rows") * F.col("passes"))).first()[0] or 0
    n_parts = max(1, min(4 * partitions(rows.sparkSession), copies // (8 * window)))
    order = ["pass", "label", "dim", "key", "vec_id"]
    projected = _projected(planned.filter("passes > 0 AND rows > 1"), BITS, seed, dtype)
    projected = projected.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    found = saved(_windows(projected, threshold, window, dtype), "vectors-windows")
    links = found.filter("a IS NOT NULL").select("a", "b").unionAll(_at_borders(found, threshold, window, dtype))
    if all_pairs:
        links = links.unionAll(_all_pairs(planned.filter("rows > 1"), threshold, ALL_BLOCK, dtype))
    copies = rows.join(reps, ["label", "dim", "same"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    groups = saved(components(links.unionAll(copies), "vectors"), "vectors-groups")
    members = unique.join(groups, unique["vec_id"] == groups["node"]).drop("node")
    # rows that share an id may have brought different labels or dimensions into a group
    members = members.withColumn("component", F.concat_ws(":", "component", "label", "dim"))
    counts = _counted(members, threshold, BLOCK, dtype)
    per_set = reps.join(counts, reps["rep"] == counts["vec_id"], "left").select(
        "label", "dim", "same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    per_row = rows.join(per_set, ["label", "dim", "same"])
    per_id = per_row.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    out = vectors.select(F.col(key).cast("long").alias("vec_id")).join(per_id, "vec_id", "left")
    out = out.join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
