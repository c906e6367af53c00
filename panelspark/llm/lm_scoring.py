"""Language-model scores from a log-frequency Bloom filter.

Texts become chunks: a row holds some texts as one stream of numbers of the chunk's own words.
Pairs of words, and single words as pairs with a context of their own, are sent packed by hash
range to be counted. A range holds whole contexts and makes its part of a Bloom filter, in which an
n-gram of count c is entered once per step of its logarithm; beside it stands what each context's
continuations are held at in sum. That is the model: rows of bounded size, which grow with the
distinct n-grams. To score, it is broadcast slice after slice of at most ``SLICE`` bytes: probing an
n-gram step by step until one is missing gives its quantised count. Contexts of more than a
thousandth of all tokens (so no more than a thousand) are spread over all ranges and their sums put
together, so no context is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import (
    LOWER,
    done_with,
    groups,
    in_runs,
    mix,
    n_ranges_for,
    pieces,
    ranges,
    saved,
    scratch_dir,
    short,
    unshort,
    word_hashes,
    word_starts,
)

#: Bytes of text per chunk.
CHUNK = 1 << 21
#: A hash range has the n-grams of about MOST_BYTES of text, all of which are entered; an entry has
#: BITS bits, an n-gram's count is kept to a factor of BASE.
MOST_BYTES, BITS, HASHES, BASE = 16 << 20, 10, 5, 1.5
#: Bytes of the model that are broadcast at a time.
SLICE = 32 << 20
#: N-grams probed at a time.
_PROBED = 1 << 20
#: Weight of the share of a pair in its context: sum of the context / (that + PRIOR), times PAIR.
PAIR, PRIOR = 0.5, 2.0
#: A context with this share of all tokens is spread over all ranges.
_OFTEN = 1000
_END, _START, _ROOT = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D)
_STEP, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << 40) - 1)

_CHUNKS = "chunk long, ids array<long>, held array<boolean>, ends array<int>, words binary, trained binary, low binary, high binary"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        trains = np.array(batch.column("training").to_pylist(), bool)
        for first, last, data, offsets in pieces(batch.column("text"), CHUNK):
            data = LOWER[data]
            starts, before = word_starts(data, offsets)
            n = last - first
            ends = (before[1:] + np.arange(1, n + 1)).astype(np.int32)
            tokens = np.full(len(starts) + n, _END, np.uint64)
            inside = np.ones(len(tokens), bool)
            inside[ends - 1] = False
            tokens[inside] = word_hashes(data, starts)
            words, stream = np.unique(tokens, return_inverse=True)
            training = np.repeat(trains[first:last], np.diff(np.append(0, ends)))
            trained = np.bincount(stream[training], minlength=len(words)).astype(np.int64)
            # numbers in two planes: the upper one is mostly zeros and packs well
            high = (stream >> 16).astype(np.uint8 if len(words) <= 1 << 24 else np.uint32)
            columns = [
                pa.array([number], pa.int64()),
                pa.array([batch.column("doc_id").slice(first, n).to_pylist()], pa.list_(pa.int64())),
                pa.array([(~trains[first:last]).tolist()], pa.list_(pa.bool_())),
                pa.array([ends.tolist()], pa.list_(pa.int32())),
                pa.array([words.tobytes()], pa.binary()),
                pa.array([trained.astype(np.uint32).tobytes()], pa.binary()),
                pa.array([stream.astype(np.uint16).tobytes()], pa.binary()),
                pa.array([high.tobytes() if len(words) > 1 << 16 else b""], pa.binary()),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CHUNKS.split(", ")])


def _stream(row: dict) -> np.ndarray:
    numbers = np.frombuffer(row["low"], np.uint16).astype(np.int64)
    if row["high"]:
        wide = np.uint8 if len(row["high"]) == len(numbers) else np.uint32
        numbers |= np.frombuffer(row["high"], wide).astype(np.int64) << 16
    return numbers


def _pairs(row: dict, n_ranges: int, hot: np.ndarray) -> dict:
    """Distinct pairs of a chunk (numbers of first and second word, hashes, ranges), the pair of each
    token, and the order by range, first, second in which pairs are sent. The number of the start of
    a text is n, that of the context of single words n + 1; the last n pairs have it."""
    words, stream, ends = np.frombuffer(row["words"], np.uint64), _stream(row), np.array(row["ends"])
    n = len(words)
    before = np.append(n, stream[:-1])
    before[ends[:-1]] = n
    pairs, which = np.unique(before * (n + 2) + stream, return_inverse=True)
    pairs = np.append(pairs, (n + 1) * (n + 2) + np.arange(n))
    first, second = pairs // (n + 2), pairs % (n + 2)
    named = np.append(words, [_START, _ROOT])
    hashes = mix(mix(named * _STEP)[first] + named[second])
    is_hot = np.isin(named, hot)
    where = ranges(np.where(is_hot[first], hashes, mix(named)[first]), n_ranges)
    order = np.argsort(where, kind="stable")
    # runs of one range and one first word, in the order sent
    runs = np.flatnonzero(np.append(True, (np.diff(where[order]) != 0) | (np.diff(first[order]) != 0)))
    inside = np.arange(len(order)) - np.repeat(runs, np.diff(np.append(runs, len(order))))
    runs = np.flatnonzero(inside % 255 == 0)  # a length is one byte
    return {"named": named, "first": first, "second": second, "hashes": hashes, "which": which, "range": where, "order": order, "runs": runs}


def _packed_words(n_ranges: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, trained = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["trained"], np.uint32)
                seen = np.bincount(_stream(row), minlength=len(words)).astype(np.uint32)
                cuts = np.searchsorted(ranges(words, n_ranges), np.arange(n_ranges + 1))
                some = np.flatnonzero(np.diff(cuts))
                columns = [
                    pa.array(some),
                    pa.array(np.full(len(some), row["chunk"])),
                    pa.array([words[cuts[r] : cuts[r + 1]].tobytes() for r in some], pa.binary()),
                    *(pa.array([x[cuts[r] : cuts[r + 1]].tobytes() for r in some], pa.binary()) for x in (trained, seen)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["range", "chunk", "hashes", "counts", "seen"])

    return work


def _packed_pairs(n_ranges: int, hot: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = _pairs(row, n_ranges, hot)
                training = np.repeat(~np.array(row["held"]), np.diff(np.append(0, row["ends"])))
                counts = np.bincount(p["which"][training], minlength=len(p["hashes"]))
                counts[len(counts) - len(p["named"]) + 2 :] = np.frombuffer(row["trained"], np.uint32)
                order, runs = p["order"], p["runs"]
                hashes, counts = p["hashes"][order], counts[order]
                firsts, lengths = p["named"][p["first"][order[runs]]], np.diff(np.append(runs, len(order)))
                cuts = np.searchsorted(p["range"][order], np.arange(n_ranges + 1))
                run_cuts = np.searchsorted(p["range"][order[runs]], np.arange(n_ranges + 1))
                some = np.flatnonzero(np.diff(cuts))
                of = lambda x, c, r: x[c[r] : c[r + 1]]
                # seen once, mostly: larger counts are listed apart, by their place
                columns = [
                    pa.array(some),
                    pa.array(np.full(len(some), row["chunk"])),
                    pa.array([short(of(firsts, run_cuts, r)) for r in some], pa.binary()),
                    pa.array([of(lengths, run_cuts, r).astype(np.uint8).tobytes() for r in some], pa.binary()),
                    pa.array([short(of(hashes, cuts, r)) for r in some], pa.binary()),
                    pa.array([np.packbits(of(counts, cuts, r) > 0).tobytes() for r in some], pa.binary()),
                    pa.array([_more(of(counts, cuts, r)) for r in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["range", "chunk", "firsts", "runs", "hashes", "trained", "more"])

    return work


_PACKED = "range long, chunk long, firsts binary, runs binary, hashes binary, trained binary, more binary"


def _more(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts > 1)
    return np.stack([at, counts[at]]).astype(np.uint32).tobytes()


def _levels(counts: np.ndarray) -> np.ndarray:
    """Number of steps of each count: 0 for 0."""
    steps = np.floor(np.log(np.maximum(counts, 0.1)) / np.log(BASE) + 1e-9).astype(np.int64) + 1
    return np.where(counts > 0, steps, 0)


def _places(hashes: np.ndarray, level: int, sizes) -> np.ndarray:
    """(HASHES, n) places in a filter of the low 40 bits of hashes at a level."""
    low = hashes & np.uint64((1 << 40) - 1)
    one = mix(low + np.uint64(level * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
    two = mix(one) | np.uint64(1)
    return np.stack([(one + np.uint64(i) * two) % np.asarray(sizes, np.uint64) for i in range(HASHES)]).astype(np.int64)


def _filter(hashes: np.ndarray, levels: np.ndarray) -> tuple[bytes, int]:
    """(bits, number of bits) of n-grams with their steps."""
    size = max(64, int(levels.sum()) * BITS)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        bits[_places(hashes[levels >= level], level, size).ravel()] = True
    return np.packbits(bits).tobytes(), size


def _answers(table: pa.Table) -> pa.Table:
    """For each range: exact training counts of the words of each chunk, and the words that are often seen."""
    out = {k: [] for k in ("range", "chunk", "counts", "n_words", "n_tokens", "words", "seen")}
    for lo, hi in groups(table["range"].to_numpy()):
        rows = table.slice(lo, hi - lo).to_pylist()
        hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
        trained, seen = (np.concatenate([np.frombuffer(r[c], np.uint32) for r in rows]) for c in ("counts", "seen"))
        words, which = np.unique(hashes, return_inverse=True)
        counts, seen = np.bincount(which, trained).astype(np.int64), np.bincount(which, seen).astype(np.int64)
        # more than a thousandth of all tokens is more than a thousandth of those of the range
        often = np.flatnonzero(seen * _OFTEN >= seen.sum())
        found, at = counts[which], 0
        for i, row in enumerate(rows):
            n = len(row["hashes"]) // 8
            out["range"].append(row["range"])
            out["chunk"].append(row["chunk"])
            out["counts"].append(found[at : at + n].tobytes())
            out["n_words"].append(0 if i else int((counts > 0).sum()))
            out["n_tokens"].append(0 if i else int(counts.sum()))
            out["words"].append([] if i else words[often].view(np.int64).tolist())
            out["seen"].append([] if i else seen[often].tolist())
            at += n
    return pa.table({k: pa.array(v, _KINDS.get(k, pa.int64())) for k, v in out.items()})


_KINDS = {k: pa.binary() for k in ("counts", "firsts", "runs", "hashes", "bits", "sums")}
_KINDS |= {"words": pa.list_(pa.int64()), "seen": pa.list_(pa.int64()), "hot": pa.list_(pa.int64()), "hot_sums": pa.list_(pa.float64())}


def _held(part: pa.Table, hot: np.ndarray) -> dict:
    """The row of the model of one range."""
    asked, counts, firsts = [], [], []
    for first, runs, packed, trained, more in zip(*(part[c].to_pylist() for c in ("firsts", "runs", "hashes", "trained", "more"))):
        hashes = unshort(packed)
        n = np.unpackbits(np.frombuffer(trained, np.uint8), count=len(hashes)).astype(np.int64)
        at, larger = np.frombuffer(more, np.uint32).reshape(2, -1)
        n[at] = larger
        asked.append(hashes[n > 0])
        firsts.append(np.repeat(unshort(first), np.frombuffer(runs, np.uint8))[n > 0])
        counts.append(n[n > 0])
    asked, counts, firsts = map(np.concatenate, (asked, counts, firsts))
    order = np.argsort(asked)
    asked, counts, firsts = asked[order], counts[order], firsts[order]
    new = np.flatnonzero(np.append(True, asked[1:] != asked[:-1])) if len(asked) else np.zeros(0, np.int64)
    asked, firsts = asked[new], firsts[new]
    levels = _levels(np.add.reduceat(counts, new)) if len(new) else np.zeros(0, np.int64)
    contexts, which = np.unique(firsts, return_inverse=True)
    sums = np.bincount(which, _count_of(levels), minlength=len(contexts))
    apart = np.isin(contexts, hot & _LOW)
    bits, size = _filter(asked, levels)
    return {
        "bits": bits, "size": size, "firsts": short(contexts[~apart]), "sums": sums[~apart].astype(np.float32).tobytes(),
        "hot": contexts[apart].view(np.int64).tolist(), "hot_sums": sums[apart].tolist(), "n_words": int((firsts == _ROOT & _LOW).sum()),
    }


def _rows_of_model(hot: np.ndarray):
    def work(table: pa.Table) -> pa.Table:
        out = {c.split()[0]: [] for c in _MODEL.split(", ")}
        for lo, hi in groups(table["range"].to_numpy()):
            part = table.slice(lo, hi - lo)
            for name, value in {"range": part["range"][0].as_py(), **_held(part, hot)}.items():
                out[name].append(value)
        return pa.table({k: pa.array(v, _KINDS.get(k, pa.int64())) for k, v in out.items()})

    return work


_MODEL = "range long, bits binary, size long, firsts binary, sums binary, hot array<long>, hot_sums array<double>, n_words long"


def _joined(rows: list, first: int, last: int) -> dict:
    """One filter of the filters of the ranges from ``first`` to before ``last``, each at whole bytes."""
    sizes, bases = np.full(last - first, 64), np.zeros(last - first, np.int64)
    parts, firsts, sums, base = [bytes(8)], [np.zeros(0, np.uint64)] * (last - first), [np.zeros(0, np.float32)] * (last - first), 8
    for row in rows:
        i = row["range"] - first
        sizes[i], bases[i] = row["size"], base * 8
        firsts[i], sums[i] = bytes(row["firsts"]), np.frombuffer(row["sums"], np.float32)
        parts.append(bytes(row["bits"]))
        base += len(parts[-1])
    return {"bits": b"".join(parts), "sizes": sizes, "bases": bases, "firsts": firsts, "sums": sums, "first": first}


def probed(held: dict, hashes: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Steps of each n-gram (of a range of the slice): the filter is asked level by level until one is missing."""
    bits = np.frombuffer(held["bits"], np.uint8)
    sizes, bases = held["sizes"][where], held["bases"][where]
    levels, left, level = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 0
    while len(left) and level < 120:  # BASE ** 120 is beyond any count
        level += 1
        at = _places(hashes[left], level, sizes[left]) + bases[left]
        there = np.ones(len(left), bool)
        for place in at:
            there &= bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1 == 1
        left = left[there]
        levels[left] = level
    return levels


def _count_of(levels: np.ndarray) -> np.ndarray:
    """Quantised count after so many steps."""
    low = np.ceil(BASE ** (levels - 1.0) - 1e-9)
    # the whole numbers of a step lie evenly between its ends
    middle = (low + np.maximum(low, np.ceil(BASE ** (levels * 1.0) - 1e-9) - 1)) / 2
    return np.where(levels > 0, middle, 0.0)


def _asked(slice_):
    """Answers of the slice that was broadcast: steps of each pair, sum of each run of a first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = slice_.value
        known = {}
        for batch in batches:
            rows, at = batch.to_pylist(), 0
            sizes = np.cumsum([len(r["hashes"]) // 5 for r in rows])
            while at < len(rows):
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _PROBED, "right")))
                part, at = rows[at:end], end
                hashes = [unshort(r["hashes"]) for r in part]
                lengths = [len(h) for h in hashes]
                where = np.repeat([r["range"] - held["first"] for r in part], lengths)
                steps = np.split(probed(held, np.concatenate(hashes), where).astype(np.uint8), np.cumsum(lengths)[:-1])
                sums = []
                for r in part:
                    i = r["range"] - held["first"]
                    if i not in known:
                        known = {i: (unshort(held["firsts"][i]) if len(held["firsts"][i]) else np.zeros(0, np.uint64), held["sums"][i])}
                    names, values = known[i]
                    firsts = unshort(r["firsts"])
                    found = np.searchsorted(names, firsts)
                    there = np.append(names, np.uint64(0))[found] == firsts
                    there &= found < len(names)
                    sums.append(np.where(there, np.append(values, np.float32(0))[found], np.float32(0)).astype(np.float32).tobytes())
                columns = [pa.array([r[c] for r in part], pa.int64()) for c in ("range", "chunk")]
                columns += [pa.array([x.tobytes() for x in steps], pa.binary()), pa.array(sums, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["range", "chunk", "steps", "sums"])

    return work


def _answered(model: dict, asks: DataFrame, slice_bytes: int) -> DataFrame:
    """(range, chunk, steps, sums) of everything asked: a job per slice, which reads its own questions alone."""
    spark, filters = asks.sparkSession, model["filters"]
    starts, used = [0], 0
    weight = (F.length("bits") + F.length("firsts") + F.length("sums")).alias("weight")
    for row in filters.select("range", weight).orderBy("range").collect():  # two numbers a range
        if used and used + row["weight"] > slice_bytes:
            starts.append(row["range"])
            used = 0
        used += row["weight"]
    path, schema = scratch_dir(spark, "lm-steps"), "range long, chunk long, steps binary, sums binary"
    for first, last in zip(starts, [*starts[1:], model["n_ranges"]]):
        inside = (F.col("range") >= first) & (F.col("range") < last)
        rows = filters.filter(inside).select("range", "bits", "size", "firsts", "sums").collect()
        held = spark.sparkContext.broadcast(_joined(rows, first, last))
        answers = asks.filter(inside).mapInArrow(_asked(held), schema)
        answers.write.option("compression", "zstd").parquet(f"{path}/slice={first}")
        held.unpersist()
    made = spark.read.schema(schema).parquet(path)
    made._scratch = path
    return made


def _scores(row: dict, model: dict) -> list[np.ndarray]:
    """Of each text of a chunk: number of tokens, score; with exact counts also known tokens and base score."""
    stream, ends = _stream(row), np.array(row["ends"])
    starts = np.append(0, ends[:-1])
    p = _pairs(row, model["n_ranges"], model["hot"])
    n, order = len(p["named"]) - 2, p["order"]
    steps, sums = (np.frombuffer(b"".join(row[c]), kind) for c, kind in (("steps", np.uint8), ("sums", np.float32)))
    together, context = np.empty(len(order)), np.empty(len(order))
    together[order] = _count_of(steps.astype(np.int64))
    context[order] = np.repeat(sums, np.diff(np.append(p["runs"], len(order))))
    at = np.minimum(np.searchsorted(model["hot"], p["named"]), len(model["hot"]) - 1)
    hot = model["hot"][at] == p["named"]
    context = np.where(hot[p["first"]], model["hot_sums"][at][p["first"]], context)
    together = np.minimum(together, context)
    single = (together[len(order) - n :] + 1) / (context[-1] + model["n_words"] + 1)
    weight = PAIR * context / (context + PRIOR)
    chance = np.log10(weight * together / np.maximum(context, 1) + (1 - weight) * single[p["second"]])
    add = np.add.reduceat
    out = [np.diff(np.append(0, ends)), add(chance[p["which"]], starts)]
    if "counts" in row:
        counts = np.frombuffer(b"".join(row["counts"]), np.int64)
        base = np.log10((counts + 1) / (model["n_tokens"] + model["exact_words"] + 1))
        out += [add((counts > 0)[stream].astype(np.int64), starts), add(base[stream], starts)]
    return out


def _scored(model: dict):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                n_tokens, score, *exact = _scores(row, model)
                columns = {"doc_id": pa.array(row["ids"], pa.int64()), "n_tokens": pa.array(n_tokens), "score": pa.array(score)}
                if exact:
                    columns |= {"held_out": pa.array(row["held"]), "n_known": pa.array(exact[0]), "base_score": pa.array(exact[1])}
                    columns["train_tokens"] = pa.array(np.full(len(score), model["n_tokens"]))
                yield pa.RecordBatch.from_pydict(columns)

    return work


# -- the operator -----------------------------------------------------------------------------


def _chunks(docs: DataFrame, training: Column, key: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    return saved(rows.mapInArrow(_chunked, _CHUNKS), "lm-chunks", "zstd")


def _by_range(packed: DataFrame, n_ranges: int, work, schema: str, label: str) -> DataFrame:
    dealt = packed.repartition(n_ranges, "range").sortWithinPartitions("range")
    return saved(dealt.mapInArrow(in_runs(["range"], work), schema), label, "zstd")


def _counted(chunks: DataFrame, n_ranges: int) -> tuple[DataFrame, np.ndarray]:
    """(exact counts of the words of each chunk, sorted hashes of the contexts that are spread)."""
    words = chunks.select("chunk", "words", "trained", "low", "high")
    schema = "range long, chunk long, hashes binary, counts binary, seen binary"
    words = words.mapInArrow(_packed_words(n_ranges), schema)
    schema = "range long, chunk long, counts binary, n_words long, n_tokens long, words array<long>, seen array<long>"
    answers = _by_range(words, n_ranges, _answers, schema, "lm-answers")
    tokens = chunks.agg(F.sum(F.element_at("ends", -1).cast("long"))).first()[0] or 0
    often = answers.select(F.explode(F.arrays_zip("words", "seen")).alias("w")).filter(F.col("w.seen") * _OFTEN >= tokens)
    often = [r[0] for r in often.select("w.words").collect()]  # at most _OFTEN of them
    return answers, np.unique(np.append(np.array(often, np.int64).view(np.uint64), [_START, _ROOT]))


def _model(filters: DataFrame, n_ranges: int, hot: np.ndarray) -> dict:
    """The filters and what is not in them: the sums of contexts that are spread, the number of words."""
    parts = filters.select(F.explode(F.arrays_zip("hot", "hot_sums")).alias("h"))
    sums = {int(r[0]) & (1 << 40) - 1: r[1] for r in parts.groupBy("h.hot").agg(F.sum("h.hot_sums")).collect()}
    return {
        "filters": filters,
        "n_ranges": n_ranges,
        "hot": hot,
        "hot_sums": np.array([sums.get(int(h) & (1 << 40) - 1, 0.0) for h in hot]),
        "n_words": filters.agg(F.sum("n_words")).first()[0] or 0,
    }


def _by_chunk(answers: DataFrame, *columns: str) -> DataFrame:
    found = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", *columns))).alias("a"))
    return found.select("chunk", *(F.col("a").getField(c).alias(c) for c in columns))


def _shipped(model: dict) -> dict:
    return {k: v for k, v in model.items() if k != "filters"}


def _fitted(chunks: DataFrame, n_ranges: int, hot: np.ndarray) -> dict:
    packed = chunks.mapInArrow(_packed_pairs(n_ranges, hot), _PACKED)
    return _model(_by_range(packed, n_ranges, _rows_of_model(hot), _MODEL, "lm-model"), n_ranges, hot)


def _asked_of(chunks: DataFrame, model: dict, slice_bytes: int) -> DataFrame:
    """Answers to all pairs of all chunks. Questions are sorted by range inside each file, without a
    shuffle: a slice's job opens every file, but reads only the pages of its ranges."""
    asks = chunks.mapInArrow(_packed_pairs(model["n_ranges"], model["hot"]), _PACKED).select("range", "chunk", "firsts", "hashes")
    asks = saved(asks.sortWithinPartitions("range"), "lm-asks", "zstd")
    answers = _answered(model, asks, slice_bytes)
    done_with(asks)
    return _by_chunk(answers, "steps", "sums")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", most_bytes: int = MOST_BYTES) -> dict:
    """A model of the texts of all rows, for :func:`apply` and :func:`save`. Null texts are empty texts;
    without rows every word has the same probability."""
    chunks = _chunks(docs, F.lit(True), key, text)
    n_ranges = n_ranges_for(chunks, CHUNK, most_bytes)
    counts, hot = _counted(chunks, n_ranges)
    model = _fitted(chunks, n_ranges, hot)
    done_with(counts)
    done_with(chunks)
    return model


def save(model: dict, path: str) -> None:
    """Write a model as two Parquet tables below ``path``, which must not exist; the second one ends it."""
    spark = model["filters"].sparkSession
    model["filters"].write.parquet(f"{path}/filters")
    row = (model["n_ranges"], model["n_words"], model["hot"].view(np.int64).tolist(), model["hot_sums"].tolist())
    spark.createDataFrame([row], "n_ranges long, n_words long, hot array<long>, hot_sums array<double>").write.parquet(f"{path}/rest")


def load(spark: SparkSession, path: str) -> dict:
    rest = spark.read.parquet(f"{path}/rest").first()
    hot, sums = np.array(rest["hot"], np.int64).view(np.uint64), np.array(rest["hot_sums"], np.float64)
    filters = spark.read.schema(_MODEL).parquet(f"{path}/filters")
    return {"filters": filters, "n_ranges": rest["n_ranges"], "n_words": rest["n_words"], "hot": hot, "hot_sums": sums}


def apply(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_tokens, score of every row under a model that need not have seen any of them. The
    score does not depend on ``slice_bytes``, the bytes of the model that are broadcast at a time."""
    chunks = _chunks(docs, F.lit(False), key, text)
    given = chunks.drop("trained").join(_asked_of(chunks, model, slice_bytes), "chunk")
    return given.mapInArrow(_scored(_shipped(model)), "doc_id long, n_tokens long, score double")


def score(
    docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", most_bytes: int = MOST_BYTES, slice_bytes: int = SLICE
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``training`` is the condition for rows to learn from. Words are runs of anything but ASCII
    whitespace with A-Z in lower case; a text ends with a token of its own, so null and blank texts
    have one token. ``base_score`` uses exact counts of single tokens; ``score`` is the model's
    log10 probability, which sums to 1 over the known words and one unknown but for what the filter
    wrongly affirms (about 1 % of pairs never seen). Words are told apart by 64 bits of hash.
    Repeated rows count as often as they are there. ``most_bytes`` of text make a hash range: fewer
    bytes, more and smaller filters, which hold the same n-grams. The same as :func:`fit` and
    :func:`apply`, with exact counts of single words beside it.
    """
    chunks = _chunks(docs, training, key, text)
    n_ranges = n_ranges_for(chunks, CHUNK, most_bytes)
    counts, hot = _counted(chunks, n_ranges)
    model = _fitted(chunks, n_ranges, hot)
    totals = counts.agg(F.sum("n_words").alias("w"), F.sum("n_tokens").alias("t")).first()
    model |= {"exact_words": totals["w"] or 0, "n_tokens": totals["t"] or 0}
    asked = _asked_of(chunks, model, slice_bytes)
    given = chunks.drop("trained").join(_by_chunk(counts, "counts"), "chunk").join(asked, "chunk")
    schema = "doc_id long, n_tokens long, score double, held_out boolean, n_known long, base_score double, train_tokens long"
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return given.mapInArrow(_scored(_shipped(model)), schema).select(*names)
