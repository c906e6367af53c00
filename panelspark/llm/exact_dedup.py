"""Exact deduplication against a history that is indexed by minimal perfect hashes.

The distinct digests of everything seen before are cut into shards by their bits. A shard's index
is one row: bit levels of a minimal perfect hash, and slots with the full digest and the locator
of the row that stays. A newcomer's digest is hashed to its slot and compared byte by byte there;
what is no member is grouped among the newcomers themselves. Copies are counted before any
shuffle of digests, so a text that makes up a third of all rows is one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import mix, partitions, saved

#: Digests that a shard is made for; shards are also at least four per shuffle partition.
SHARD_KEYS = 1 << 15
_LEVELS = 32

_INDEX = "shard long, level_bits array<int>, bits binary, digests binary, winners array<long>, counts array<long>"
_GROUPS = "digest binary, keep_id long, group_size long, member boolean"


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", *more) -> DataFrame:
    """(doc_id, digest, ...): SHA-256 of the text with each run of whitespace as one space; null is empty."""
    run = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), run, " ")
    return docs.select(F.col(key).alias("doc_id"), F.unhex(F.sha2(normal, 256)).alias("digest"), *more)


def _words(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(packed, ">u8").reshape(-1, 4).astype(np.uint64)
    return words[:, 0], words[:, 1]


def _slots(level: int, size: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix((first + seed) ^ mix(second + seed)) % np.uint64(size)).astype(np.int64)


def build(packed: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all bits, slot of each key): keys that meet no other on a level get a
    bit there, the rest go on to the next; a key's slot is the rank of its bit."""
    first, second = _words(packed)
    left = np.arange(len(first))
    sizes, bits, owners = [], [], []
    for level in range(_LEVELS):
        if not len(left):
            break
        size = 2 * len(left) + 1
        at = _slots(level, size, first[left], second[left])
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        owner = np.full(size, -1)
        owner[at[mine]] = left[mine]
        sizes.append(size)
        bits.append(alone)
        owners.append(owner[alone])
        left = left[~mine]
    if len(left):
        raise ValueError("two keys of a shard are equal")
    order = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    slots = np.empty(len(first), np.int64)
    slots[order] = np.arange(len(order))
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slots


def find(sizes: list[int], bits: np.ndarray, held: bytes, wanted: bytes) -> np.ndarray:
    """Slot of each wanted digest, -1 where its slot holds other bytes or there is none."""
    first, second = _words(wanted)
    rank = np.cumsum(bits) - 1
    slot = np.full(len(first), -1)
    left, base = np.arange(len(first)), 0
    for level, size in enumerate(sizes):
        at = _slots(level, size, first[left], second[left]) + base
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    mine = np.frombuffer(wanted, np.uint8).reshape(-1, 32)
    theirs = np.frombuffer(held, np.uint8).reshape(-1, 32)
    found = np.flatnonzero(slot >= 0)
    slot[found[(theirs[slot[found]] != mine[found]).any(axis=1)]] = -1
    return slot


def _packed(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    packed = _packed(rows["digest"])
    sizes, bits, slots = build(packed)
    order = np.argsort(slots)
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int64()),
            "level_bits": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": pa.array([np.frombuffer(packed, "V32")[order].tobytes()], pa.binary()),
            "winners": pa.array([rows["keep_id"].take(order).to_pylist()], pa.list_(pa.int64())),
            "counts": pa.array([rows["group_size"].take(order).to_pylist()], pa.list_(pa.int64())),
        }
    )


def _look_up(key: tuple, index: pa.Table, new: pa.Table) -> pa.Table:
    held, winners, counts, sizes, bits = b"", [], [], [], np.zeros(0, bool)
    if index.num_rows:
        shard = index.to_pylist()[0]
        held, winners, counts, sizes = shard["digests"], shard["winners"], shard["counts"], shard["level_bits"]
        bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(sizes)).astype(bool)
    digest, first, size = (new[c].to_pylist() for c in ("digest", "keep_id", "group_size"))
    slots = find(sizes, bits, held, b"".join(digest)) if digest else []
    rows = [[held[32 * i : 32 * i + 32], w, c, True] for i, (w, c) in enumerate(zip(winners, counts))]
    for d, f, n, slot in zip(digest, first, size, slots):
        if slot < 0:
            rows.append([d, f, n, False])
        else:
            row = rows[slot]
            row[1] = min((x for x in (row[1], f) if x is not None), default=None)
            row[2] += n
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.bool_())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "keep_id", "group_size", "member"])


def _counted(rows: DataFrame, shards: int) -> DataFrame:
    seen = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    bits = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long")
    return seen.withColumn("shard", F.pmod(bits, F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard from (doc_id, digest) rows; write it to keep it."""
    return _counted(history, shards).groupBy("shard").applyInArrow(_build_shard, _INDEX)


def resolve(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """(digest, keep_id, group_size, member) of the history and the new (doc_id, digest) rows together."""
    new = _counted(rows, shards)
    return index.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_look_up, _GROUPS)


def exact_dedup(docs: DataFrame, is_history, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, member for every row of ``docs``.

    ``is_history`` is a condition on the columns of ``docs``: the rows that were taken in earlier
    and make up the index. The winner of a group is its smallest key, wherever it lies. Null and
    empty texts are one text. A null key never wins against another; rows that repeat a winning
    key are all kept, as nothing tells them apart. ``member``: the index holds the digest.
    """
    old = F.coalesce(is_history, F.lit(False)).alias("old")
    rows = saved(digests(docs, key, text, old), "exact-digests")
    spark = docs.sparkSession
    shards = max(4 * partitions(spark), rows.count() // SHARD_KEYS + 1)
    index = saved(build_index(rows.filter("old"), shards), "exact-index")
    groups = resolve(index, rows.filter("NOT old"), shards)
    out = rows.join(groups, "digest")
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "member",
    )
