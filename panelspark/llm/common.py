"""What several operators share: reading, saving, packed text, words, hashes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import scratch_dir
from panelspark.sources import hadoop

#: Whitespace of every contract here, as a Java and Python regular expression class.
SPACES = r"[\x20\x09-\x0D]"
WORDS = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a numpy step looks at together; a longer text is a step of its own.
PIECE = 1 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def letting_go(spark: SparkSession):
    """Inside, shuffle files go with the query that made them."""
    return _setting(spark, _CLEANUP, "true")


def saved(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a table into the shared scratch folder and read it back: cuts the lineage, survives
    lost executors, and lets go of the shuffle files that made it."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with letting_go(spark):
        df.write.option("compression", compression).parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch = path
    return made


def done_with(df: DataFrame) -> None:
    """Delete what :func:`saved` wrote, once nothing that is still to run reads it."""
    hadoop.delete(df._scratch)


def set_aside(docs: DataFrame, text: str, *more) -> DataFrame:
    """``_row`` (every column but the text), ``_text`` and more: no column can clash with those of a step."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.struct(*rest).alias("_row"), F.col(text).alias("_text"), *more)


def taken_back(columns: list[str], text: str, new_text) -> list:
    """The columns of documents that were set aside, in their order, with a new text."""
    return [new_text.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -- words and hashes over Arrow text ---------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[:, _IS_SPACE] = 0
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows of about ``size`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word in ``data``, and the number of words before each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_IS_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, offsets)


def word_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    solid = ~_IS_SPACE[data]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = solid[tails]
    return np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each word (0 or 1: two independent ones)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = data[starts[0] :]
    starts = starts - starts[0]
    small = np.int32 if len(data) < 1 << 31 else np.int64
    at = np.arange(len(data), dtype=small)
    at -= np.repeat(starts.astype(small), np.diff(np.append(starts, len(data))))
    powers = np.full(int(at.max()) + 1, _BASE[which], np.uint64)
    powers[0] = 1
    values = _BYTE[which][data]
    values *= np.multiply.accumulate(powers)[at]
    return mix(np.add.reduceat(values, starts))


def in_runs(keys: list[str], work: Callable[[pa.Table], pa.Table | None]) -> Callable:
    """For mapInArrow over a partition sorted by ``keys``: hands whole groups to ``work``, many at a
    time, holding no more than a batch and the group that a batch breaks off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            other = np.zeros(new.num_rows, bool)
            for key in keys:
                column = new[key].to_numpy()
                other |= column != column[-1]
            other = np.flatnonzero(other)
            cut = int(other[-1]) + 1 if len(other) else 0
            if held and any(held[-1][k][-1].as_py() != new[k][0].as_py() for k in keys):
                yield from _batches(work(pa.concat_tables(held).combine_chunks()))
                held = []
            if cut:
                yield from _batches(work(pa.concat_tables([*held, new.slice(0, cut)]).combine_chunks()))
                held = []
            held.append(new.slice(cut))
        if held:
            yield from _batches(work(pa.concat_tables(held).combine_chunks()))

    return run


def _batches(made: pa.Table | None) -> Iterator[pa.RecordBatch]:
    if made is not None and made.num_rows:
        yield from made.to_batches(max_chunksize=20_000)


def ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash range (0 .. n - 1) of each hash, rising with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def n_ranges_for(chunks: DataFrame, chunk_bytes: int, range_bytes: int = 1 << 28) -> int:
    """Hash ranges such that a range gets the hashes of about ``range_bytes`` of text, and no fewer
    than shuffle partitions or 64."""
    return max(64, partitions(chunks.sparkSession), chunks.count() * chunk_bytes // range_bytes)


def groups(keys: np.ndarray) -> list[tuple[int, int]]:
    """(first, last + 1) of each run of equal keys."""
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return list(zip(new.tolist(), np.append(new[1:], len(keys)).tolist()))


def short(hashes: np.ndarray) -> bytes:
    """The low 40 bits of hashes: within a range they tell things apart but for one in millions."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unshort(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


# -- connected components ---------------------------------------------------------------------


#: Rows per file of tables of edges.
_EDGES = 50_000


def components(edges: DataFrame, label: str, most: int = 40) -> DataFrame:
    """(node, component) of every node of the edges (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps, each an aggregate and a join, so a hub of any
    degree is spread by Spark (skew join) and nothing meets in one task or the driver. Ends when
    every edge leads from a node to the root of its star. Nulls and loops are dropped.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), f"{label}-edges")
    files = edges.count() // _EDGES + 1  # steps keep the number of edges or lower it
    for _ in range(most):
        if _are_stars(edges):
            break
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = saved(large.coalesce(files), f"{label}-large")
        done_with(edges)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = down.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        edges = saved(small.coalesce(files), f"{label}-small")
        done_with(large)
    else:
        raise RuntimeError(f"the components have not settled in {most} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two edges down, or one edge down and another up to it."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    seen = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return seen.filter("down + up > 1 AND down > 0").isEmpty()
