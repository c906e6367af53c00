"""Repeated passages of words by fixed-block anchors.

Every text is cut into non-overlapping blocks; their hashes are the index, and every rolling
window of a block's length probes it. As a window of ``span`` words holds a whole block of
``(span + 1) // 2`` words wherever it starts, each repeat of ``span`` words is hit. Hits are then
extended: the windows around them are compared as wholes, and adjoining repeats make up maximal
ones.

Texts travel as chunks. Hashes go, packed by hash range, to where they meet; back comes a bit for
each. Within a chunk a hash is sent once, so a passage that fills a third of all texts is a few
bytes per chunk, and no pair of its copies is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import (
    groups,
    in_runs,
    mix,
    n_ranges_for,
    pieces,
    ranges,
    saved,
    short,
    unshort,
    word_hashes,
    word_starts,
)

#: Words of the shortest repeat; bytes of text per chunk.
SPAN, CHUNK = 35, 1 << 20

_BASES = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)
_CHUNKS = "chunk long, ids array<long>, ends array<long>, data binary"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, last, data, offsets in pieces(batch.column("text"), CHUNK):
            columns = [
                pa.array([number], pa.int64()),
                pa.array([batch.column("doc_id").slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                pa.array([offsets[1:].tolist()], pa.list_(pa.int64())),
                pa.array([data.tobytes()], pa.binary()),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "ids", "ends", "data"])


class _Chunk:
    """Words of a chunk and the hashes of their runs."""

    def __init__(self, row: dict):
        self.data = row["data"]
        data, self.offsets = np.frombuffer(self.data, np.uint8), np.append(0, row["ends"]).astype(np.int64)
        self._starts, self.before = word_starts(data, self.offsets)
        self.n = len(self._starts)
        self._left = np.repeat(self.before[1:], np.diff(self.before)) - np.arange(self.n)
        self.in_text = np.arange(self.n) - np.repeat(self.before[:-1], np.diff(self.before))

    def starts_of(self, length: int) -> np.ndarray:
        """Words at which a run of this length begins."""
        return np.flatnonzero(self._left >= length)

    def runs(self, starts: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hash of the run of words at each start."""
        base = _BASES[which]
        powers, back = np.full(self.n + 1, base, np.uint64), np.full(self.n + 1, pow(base, -1, 2**64), np.uint64)
        powers[0] = back[0] = 1
        sums = np.zeros(self.n + 1, np.uint64)
        words = word_hashes(np.frombuffer(self.data, np.uint8), self._starts, which)
        np.cumsum(words * np.multiply.accumulate(powers)[: self.n], out=sums[1:])
        return mix((sums[starts + length] - sums[starts]) * np.multiply.accumulate(back)[starts])


def _probes(chunk: _Chunk, block: int):
    """(starts of rolling windows, their distinct hashes, which is whose, how often, whether a block)."""
    starts = chunk.starts_of(block)
    hashes, which, often = np.unique(chunk.runs(starts, block), return_inverse=True, return_counts=True)
    anchor = np.zeros(len(hashes), bool)
    anchor[which[chunk.in_text[starts] % block == 0]] = True
    return starts, hashes, which, often, anchor


def _candidates(chunk: _Chunk, hits: np.ndarray, block: int, span: int):
    """(starts of windows that hold a hit, their distinct hashes, which is whose, how often)."""
    near = np.zeros(chunk.n + 1, np.int64)
    np.add.at(near, np.maximum(hits - (span - block), 0), 1)
    np.add.at(near, hits + 1, -1)
    starts = chunk.starts_of(span)
    starts = starts[np.cumsum(near)[starts] > 0]
    both = np.empty(len(starts), [("one", np.uint64), ("two", np.uint32)])
    both["one"], both["two"] = chunk.runs(starts, span), chunk.runs(starts, span, 1).astype(np.uint32)
    order = np.argsort(both["one"], kind="stable")
    if len(order) and (np.diff(both["two"][order].astype(np.int64))[np.diff(both["one"][order]) == 0] != 0).any():
        order = np.lexsort((both["two"], both["one"]))
    new = np.append(True, both[order][1:] != both[order][:-1])[: len(order)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return starts, both[order][new], which, np.bincount(which, minlength=int(new.sum()))


def _packed(chunk: int, hashes: np.ndarray, n_ranges: int, columns: list) -> pa.RecordBatch:
    cuts = np.searchsorted(ranges(hashes, n_ranges), np.arange(n_ranges + 1))
    some = np.flatnonzero(np.diff(cuts))
    made = [pa.array(some), pa.array(np.full(len(some), chunk))]
    made += [pa.array([pack(cuts[r], cuts[r + 1]) for r in some], pa.binary()) for pack in columns]
    return pa.RecordBatch.from_arrays(made, ["range", "chunk", "hashes", "more"])


def _send_probes(n_ranges: int, block: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, hashes, _, _, anchor = _probes(_Chunk(row), block)
                pack = [lambda a, b: short(hashes[a:b]), lambda a, b: np.packbits(anchor[a:b]).tobytes()]
                yield _packed(row["chunk"], hashes, n_ranges, pack)

    return work


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _answered(table: pa.Table, meet) -> pa.Table:
    out = {"range": [], "chunk": [], "hits": []}
    for lo, hi in groups(table["range"].to_numpy()):
        part = table.slice(lo, hi - lo)
        sizes, hits = meet(part["hashes"].to_pylist(), part["more"].to_pylist())
        ends = np.append(0, np.cumsum(sizes))
        out["range"] += part["range"].to_pylist()
        out["chunk"] += part["chunk"].to_pylist()
        out["hits"] += [np.packbits(hits[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({k: pa.array(v, pa.binary() if k == "hits" else pa.int64()) for k, v in out.items()})


def _meet_probes(hashes: list[bytes], anchors: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Which windows of other chunks have the same hash, one of them being a block."""
    sizes = [len(h) // 5 for h in hashes]
    probes = unshort(b"".join(hashes))
    blocks = np.concatenate([_bits(a, n) for a, n in zip(anchors, sizes)])
    index = np.unique(probes[blocks])
    at = np.searchsorted(index, probes)
    found = at < len(index)
    found[found] = index[at[found]] == probes[found]
    several = np.bincount(at[found], minlength=len(index)) > 1
    found[found] = several[at[found]]
    return sizes, found


def _meet_windows(hashes: list[bytes], rest: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Which whole windows occur in other chunks too."""
    sizes = [len(h) // 8 for h in hashes]
    one, two = np.frombuffer(b"".join(hashes), np.uint64), np.frombuffer(b"".join(rest), np.uint32)
    order = np.lexsort((two, one))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    hits = np.zeros(len(one), bool)
    hits[order[1:][same]] = True
    hits[order[:-1][same]] = True
    return sizes, hits


def _hit_starts(row: dict, name: str, hashes: np.ndarray, n_ranges: int) -> np.ndarray:
    """The answers of all ranges to a chunk's hashes, in their order."""
    sizes = np.diff(np.searchsorted(ranges(hashes, n_ranges), np.arange(n_ranges + 1)))
    parts = [_bits(a, n) for a, n in zip(row[name] or [], sizes[sizes > 0])]
    return np.concatenate(parts) if parts else np.zeros(len(hashes), bool)


def _extended(row: dict, n_ranges: int, block: int, span: int):
    chunk = _Chunk(row)
    starts, hashes, which, often, anchor = _probes(chunk, block)
    hit = _hit_starts(row, "probed", hashes, n_ranges) | (often > 1) & anchor
    return chunk, _candidates(chunk, starts[hit[which]], block, span)


def _send_windows(n_ranges: int, block: int, span: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, (_, hashes, _, _) = _extended(row, n_ranges, block, span)
                one, two = np.ascontiguousarray(hashes["one"]), np.ascontiguousarray(hashes["two"])
                pack = [lambda a, b: one[a:b].tobytes(), lambda a, b: two[a:b].tobytes()]
                yield _packed(row["chunk"], one, n_ranges, pack)

    return work


def _kept(n_ranges: int, block: int, span: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk, (starts, hashes, which, often) = _extended(row, n_ranges, block, span)
                again = _hit_starts(row, "repeated", hashes["one"], n_ranges) | (often > 1)
                edges = np.zeros(chunk.n + 1, np.int64)
                np.add.at(edges, starts[again[which]], 1)
                np.add.at(edges, starts[again[which]] + span, -1)
                gone = np.cumsum(edges)[: chunk.n] > 0
                texts, spans = [], []
                for t in range(len(chunk.offsets) - 1):
                    words = chunk.data[chunk.offsets[t] : chunk.offsets[t + 1]].split()
                    out = gone[chunk.before[t] : chunk.before[t + 1]]
                    if out.any():
                        turns = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                        spans.append([{"start": a, "end": b} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())])
                        words = [w for w, o in zip(words, out.tolist()) if not o]
                    else:
                        spans.append([])
                    texts.append(b" ".join(words))
                sizes = np.diff(chunk.before)
                removed = np.append(0, np.cumsum(gone))[chunk.before]
                span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns = [pa.array(row["ids"], pa.int64()), pa.array(sizes), pa.array(np.diff(removed))]
                columns += [pa.array(spans, span_type), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return work


def remove_repeats(docs: DataFrame, span: int = SPAN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, spans, kept of every row.

    A word goes if a window of ``span`` words around it begins anywhere else too, in the same text
    or another; all copies go, none is spared. ``spans`` are the maximal removed runs as word
    numbers, ``kept`` the words left, joined by one space. Words are runs of anything but ASCII
    whitespace. Null and blank texts have no words and an empty ``kept``. Repeated rows repeat
    each other. Windows are told apart by 96 bits of hash.
    """
    if span < 3:
        raise ValueError("a span has at least three words")
    block = (span + 1) // 2
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunks = saved(rows.mapInArrow(_chunked, _CHUNKS), "repeats-chunks", "zstd")
    n_ranges = n_ranges_for(chunks, CHUNK)

    def answers(sent: DataFrame, meet, name: str) -> DataFrame:
        dealt = sent.repartition(n_ranges, "range").sortWithinPartitions("range")
        work = in_runs(["range"], lambda table: _answered(table, meet))
        back = dealt.mapInArrow(work, "range long, chunk long, hits binary")
        back = back.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "hits"))).alias("a"))
        return saved(back.select("chunk", F.col("a.hits").alias(name)), f"repeats-{name}")

    packed = "range long, chunk long, hashes binary, more binary"
    probed = answers(chunks.mapInArrow(_send_probes(n_ranges, block), packed), _meet_probes, "probed")
    chunks = chunks.join(probed, "chunk", "left")
    repeated = answers(chunks.mapInArrow(_send_windows(n_ranges, block, span), packed), _meet_windows, "repeated")
    chunks = chunks.join(repeated, "chunk", "left")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    out = chunks.mapInArrow(_kept(n_ranges, block, span), schema)
    return out.withColumn("kept", F.col("kept").cast("string"))
