"""Best-fit packing into bins of several permitted lengths.

Only the histogram of lengths, which the largest capacity bounds, reaches the driver. Best fit
decreasing runs on it with whole ranges of equal bins and equal pieces at once: its result is a
short list of placements "pieces i.. of length L go to bins b.. at offset f". The pieces
themselves stay in Spark, get a rank among those of their length, and look their placement up.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import pieces, saved, word_starts

CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of a bin besides its capacity, in tokens.
OVERHEAD = 32


def plan(histogram: dict[int, int], capacities: tuple[int, ...], overhead: int = OVERHEAD):
    """The cheapest plan over which of the capacities bins may open at; all serve to shrink them."""
    capacities = sorted(capacities)
    choices = [(*some, capacities[-1]) for n in range(len(capacities)) for some in combinations(capacities[:-1], n)]
    plans = (_plan(histogram, opening, capacities, overhead) for opening in choices)
    return min(plans, key=lambda made: int((made[1][:, 1] * (made[1][:, 2] + overhead)).sum()))


def _plan(histogram: dict[int, int], opening: tuple[int, ...], capacities: list[int], overhead: int):
    """(placements, bins): arrays (length, first rank, count, first bin, offset) and
    (first bin, count, capacity, contents).

    Pieces go by falling length to the fullest bins that still hold them. Where none does, bins
    open at the capacity that costs least per token when filled with copies of the piece, as far
    as there are copies; at the end each bin shrinks to the smallest capacity that holds it.
    """
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room left: (first bin, count, contents)
    rooms: list[int] = []
    placements, n_bins = [], 0

    def put(room: int, group: tuple[int, int, int]) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append(group)

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                left = count - rank

                def cost(capacity: int) -> tuple[float, int]:
                    each = min(capacity // length, left)
                    return (capacity + overhead) / (each * length), capacity

                capacity = min((c for c in opening if c >= length), key=cost)
                bins = max(1, left // max(1, capacity // length))
                put(capacity, (n_bins, bins, 0))
                n_bins += bins
                continue
            room = rooms[at]
            first, bins, held = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            placed = min(bins, count - rank)
            placements.append((length, rank, placed, first, held))
            put(room - length, (first, placed, held + length))
            if placed < bins:
                put(room, (first + placed, bins - placed, held))
            rank += placed
    ends = [
        (first, bins, capacities[bisect_left(capacities, held)], held)
        for room in groups
        for first, bins, held in groups[room]
        if held
    ]
    table = lambda rows, width: np.array(sorted(rows), np.int64).reshape(-1, width)
    return table(placements, 5), table(ends, 4)


def _cut(largest: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId()
        used = np.zeros(largest + 1, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            known = np.array(batch.column("doc_id").is_valid())
            for first, last, data, offsets in pieces(batch.column("text")):
                size = np.diff(word_starts(data, offsets)[1])
                parts = np.maximum(1, -(-size // largest))
                owner = np.repeat(np.arange(last - first), parts)
                part = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                length = np.minimum(size[owner] - part * largest, largest)
                rank = np.empty(len(length), np.int64)
                order = np.argsort(length, kind="stable")
                values, starts, counts = np.unique(length[order], return_index=True, return_counts=True)
                rank[order] = np.arange(len(order)) - np.repeat(starts, counts) + np.repeat(used[values], counts)
                used[values] += counts
                row = owner + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row].astype(np.int64) if known.all() else np.where(known[row], ids[row], 0).astype(np.int64), mask=~known[row]),
                        pa.array(part),
                        pa.array(length),
                        pa.array(np.full(len(row), chunk)),
                        pa.array(rank),
                    ],
                    ["doc_id", "piece", "length", "chunk", "rank"],
                )

    return work


def pack(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, bin_id, bin_offset, capacity, filled: one row per piece.

    A document's length is its number of words; above the largest capacity it is cut into pieces
    of that size and a rest. A document without words is one piece of length 0 in no bin. Rows
    that repeat are packed as often as they occur. Which of several pieces of equal length takes
    which place follows the order in which the rows were written.
    """
    spark, largest = docs.sparkSession, max(capacities)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, piece long, length long, chunk long, rank long"
    rows = saved(rows.mapInArrow(_cut(largest), schema), "pack-pieces")
    per_chunk = rows.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = saved(per_chunk.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-counts")
    histogram = per_chunk.filter("length > 0").groupBy("length").agg(F.sum("n").alias("n")).collect()
    shared = spark.sparkContext.broadcast(plan({r["length"]: r["n"] for r in histogram}, capacities, overhead))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placements, bins = shared.value
        keys = placements[:, 0] << 44 | placements[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            none = length == 0
            bin_id = np.zeros(len(length), np.int64)
            offset, capacity, filled = bin_id.copy(), bin_id.copy(), bin_id.copy()
            if len(placements):
                at = np.maximum(np.searchsorted(keys, length << 44 | rank, "right") - 1, 0)
                bin_id = placements[at, 3] + rank - placements[at, 1]
                offset = placements[at, 4]
                group = np.maximum(np.searchsorted(bins[:, 0], bin_id, "right") - 1, 0)
                capacity, filled = bins[group, 2], bins[group, 3]
            piece = batch.column("piece").to_numpy()
            columns = [batch.column("doc_id"), batch.column("piece"), pa.array(piece * largest), batch.column("length")]
            columns += [pa.array(x, mask=none) for x in (bin_id, offset, capacity, filled)]
            names = ["doc_id", "piece", "start", "length", "bin_id", "bin_offset", "capacity", "filled"]
            yield pa.RecordBatch.from_arrays(columns, names)

    ranked = rows.join(per_chunk.drop("n"), ["length", "chunk"])
    ranked = ranked.select("doc_id", "piece", "length", (F.col("rank") + F.col("base")).alias("rank"))
    schema = "doc_id long, piece long, start long, length long, bin_id long, bin_offset long, capacity long, filled long"
    return ranked.mapInArrow(work, schema)
