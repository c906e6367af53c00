"""Vector compression: each part of a vector becomes the number of its nearest codebook entry.

Components are whole numbers (``floor(scale * x)``), so few distinct ones meet in a dimension.
Vectors are packed into chunks with one dictionary of distinct integers per dimension and a code
for each component. For every round a task tabulates the squared differences of a dictionary's
integers to all codebook entries; the distances of a part are then rows of these tables, gathered
by the codes and added up. Nothing is multiplied per vector, and all sums are exact.

Only codebooks (``entries`` x dimensions integers) pass through the driver. A task hands on one
sum for each entry and dimension it used, whatever the number of its vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import done_with, saved

#: Vectors of a chunk: its codes fit 16 bits and a table of distances stays at a few MB.
CHUNK = 2048
#: Integers beyond are held to this size; distances that exceed a long are given as the largest long.
MOST = 1 << 62
_LONG = (1 << 63) - 1


class Codebooks(NamedTuple):
    """``entries``: parts x entries x width integers (Python integers where they are large)."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()


def _kept(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, v) of the vectors without null, NaN or infinite components."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("v").isNotNull() & finite)


def _integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """Rows x dim integers; missing trailing components are 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    x = np.zeros((len(lengths), dim))
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x[row, at] = flat
    with np.errstate(over="ignore"):
        whole = np.floor(x * scale)
    if whole.size and np.abs(whole).max() >= 1 << 52:  # beyond, doubles are whole numbers already
        return np.array([[max(-MOST, min(MOST, int(c) if abs(c) < 2.0**63 else (MOST if c > 0 else -MOST))) for c in r]
                         for r in whole], np.int64)
    return whole.astype(np.int64)


def pack(vectors: DataFrame, dim: int, scale: float = 1024.0) -> DataFrame:
    """Chunks (ids, labels, sizes, values, codes) of the kept vectors (id, label, v): for each
    dimension the distinct integers in rising order, and 16-bit codes by dimension."""
    kind = {f.name: f.dataType for f in vectors.schema.fields}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(low, CHUNK)
                whole = _integers(rows.column("v"), dim, scale)
                found = [np.unique(whole[:, d], return_inverse=True) for d in range(dim)]
                ends = pa.array([0, rows.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(ends, rows.column("id")),
                        pa.ListArray.from_arrays(ends, rows.column("label")),
                        pa.array([np.array([len(v) for v, _ in found], "<i4").tobytes()], pa.binary()),
                        pa.array([b"".join(v.astype("<i8").tobytes() for v, _ in found)], pa.binary()),
                        pa.array([b"".join(c.astype("<u2").tobytes() for _, c in found)], pa.binary()),
                    ],
                    names=["ids", "labels", "sizes", "values", "codes"],
                )

    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kind["id"])),
            T.StructField("labels", T.ArrayType(kind["label"])),
            *(T.StructField(name, T.BinaryType()) for name in ("sizes", "values", "codes")),
        ]
    )
    return vectors.select("id", "label", "v").mapInArrow(work, schema)


def nearest(values: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry for one part of each vector of a chunk.

    ``values``: the dictionary of each dimension; ``codes``: dimensions x vectors; ``book``:
    entries x dimensions. Ties go to the lower index.
    """
    n, far = codes.shape[1], 0
    if len(values):
        far = max(int(max(abs(int(v.min())), abs(int(v.max())))) for v in values)
        far = far + max((abs(int(x)) for x in book.ravel()), default=0)
    exact = far * far * max(1, len(values))
    kind = np.int32 if exact < 1 << 31 else np.int64 if exact < 1 << 63 else object
    total = np.zeros((n, len(book)), kind)
    for d, own in enumerate(values):
        differences = own.astype(kind)[:, None] - book[:, d].astype(kind)[None, :]
        total += (differences * differences)[codes[d]]
    best = total.argmin(1)
    return best, total[np.arange(n), best]


def _parts(row: dict, books: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(part, dictionaries, codes) of a packed chunk."""
    sizes = np.frombuffer(row["sizes"], "<i4")
    ends = np.cumsum(sizes)
    values = np.frombuffer(row["values"], "<i8")
    width = books.shape[2]
    codes = np.frombuffer(row["codes"], "<u2").reshape(len(sizes), -1) if len(sizes) else np.zeros((0, len(row["ids"])), "<u2")
    for part in range(books.shape[0]):
        dims = range(part * width, (part + 1) * width)
        yield part, [values[ends[d] - sizes[d] : ends[d]] for d in dims], codes[part * width : (part + 1) * width]


def _sums(books: np.ndarray):
    """One row for each entry and dimension that a task's parts fall to: their number and sum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, object)
        for batch in batches:
            for row in batch.to_pylist():
                for part, values, codes in _parts(row, books):
                    best, _ = nearest(values, codes, books[part])
                    count[part] += np.bincount(best, minlength=books.shape[1])
                    for d, own in enumerate(values):
                        # entry x distinct integer occurrences; the sum of a chunk may pass 64 bits where they are large
                        big = len(own) and max(abs(int(own[0])), abs(int(own[-1]))) * len(best) >= 1 << 62
                        whole = np.zeros(books.shape[1], object if big else np.int64)
                        np.add.at(whole, best, own.astype(whole.dtype)[codes[d]])
                        total[part, :, d] += whole
        part, entry = np.nonzero(count)
        width = books.shape[2]
        made = [
            (int(p), int(e), at, int(count[p, e]), int(total[p, e, at]))
            for p, e in zip(part, entry)
            for at in range(width)
        ]
        if made:
            part, entry, at, n, sums = map(list, zip(*made))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()), pa.array(n, pa.int64()),
                 pa.array(sums, pa.decimal128(38, 0))],
                names=["part", "entry", "at", "n", "total"],
            )

    return work


def _first(kept: DataFrame, parts: int, entries: int, dim: int, scale: float) -> Codebooks:
    """The parts of the ``entries`` smallest ids, ascending; null ids come last, equal ids by their components."""
    least = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    column = pa.array([list(r["v"]) for r in least], pa.list_(pa.float64()))
    whole = _integers(column, dim, scale)
    return Codebooks(whole.reshape(len(whole), parts, dim // parts).transpose(1, 0, 2).copy())


def fit(chunks: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """Codebooks after ``rounds`` of assignment and averaging (floor of sum by count); unused entries stay."""
    for _ in range(rounds):
        if not books.entries.size:
            break
        summed = (
            chunks.mapInArrow(_sums(books.entries), "part int, entry int, at int, n bigint, total decimal(38,0)")
            .groupBy("part", "entry", "at")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        )
        moved = books.entries.copy()
        for r in summed.collect():  # entries x dimensions rows at most
            moved[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
        books = Codebooks(moved)
    return books


def encode(chunks: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, codes: one index per part, error) of each packed vector."""
    kind = {f.name: f.dataType.elementType for f in chunks.schema.fields if f.name in ("ids", "labels")}
    entries = books.entries

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("ids"), batch.column("labels")
            for i, row in enumerate(batch.select(["ids", "sizes", "values", "codes"]).to_pylist()):
                found = [nearest(values, codes, entries[part]) for part, values, codes in _parts(row, entries)]
                n = len(row["ids"])
                codes = np.stack([best for best, _ in found], 1).astype(np.int32)
                error = [min(_LONG, sum(int(far[j]) for _, far in found)) for j in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, 1).flatten(),
                        labels.slice(i, 1).flatten(),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel())),
                        pa.array(error, pa.int64()),
                    ],
                    names=["id", "label", "codes", "error"],
                )

    schema = T.StructType(
        [
            T.StructField("id", kind["ids"]),
            T.StructField("label", kind["labels"]),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            T.StructField("error", T.LongType()),
        ]
    )
    return chunks.mapInArrow(work, schema)


def compress(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: float = 1024.0,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(id, label, codes, error, label_error) of each vector that can be compressed, and the codebooks.

    Vectors that are null or hold null, NaN or infinite components are left out. Each component
    becomes ``floor(scale * x)``, held to 2^62; errors beyond a long are the largest long. A
    vector shorter than the longest, or than a multiple of ``parts``, ends in zeros. The first
    codebooks are the parts of the vectors with the smallest ids (fewer than ``entries`` where
    there are fewer vectors); null ids come last, equal ids by components. Rows that repeat are
    vectors of their own. No vectors give no rows and empty codebooks. ``label_error`` sums the
    errors of equal labels, null being one of them. Other columns of ``vectors`` are not looked at.
    """
    if not 0 < entries <= 1 << 12:
        raise ValueError("codebooks hold 1 to 4,096 entries")  # a chunk's distances: 32 MB at most
    kept = _kept(vectors, key, vector, label)
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    dim = -(-longest // parts) * parts
    books = _first(kept, parts, entries, dim, scale)
    chunks = saved(pack(kept, dim, scale), "vectors-packed", "zstd")
    books = fit(chunks, books, rounds)
    told = saved(encode(chunks, books), "vectors-coded")
    done_with(chunks)
    name = F.struct(F.col("label").isNull().alias("none"), F.col("label").alias("is"))  # null labels are equal
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG)).cast("long")
    # a written table has a size, so Spark broadcasts it up to its threshold and joins by shuffle beyond
    by_label = saved(told.groupBy(name.alias("name")).agg(total.alias("label_error")), "vectors-labels")
    mine = (F.col("label").isNull() == F.col("name.none")) & F.col("label").eqNullSafe(F.col("name.is"))
    return told.join(by_label, mine).select("id", "label", "codes", "error", "label_error"), books


def decoded(codes: list[int] | Row, books: Codebooks, scale: float = 1024.0) -> list[float]:
    """The vector that a list of codes stands for."""
    return [int(x) / scale for part, c in enumerate(codes) for x in books.entries[part][c]]
