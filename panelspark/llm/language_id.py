"""Language identification by prediction by partial matching.

For each language the bytes of a bounded sample of labelled documents make a context tree of
variable order: a context of three bytes is a node where the language has it often enough, else
its suffix stands for it. Escape probabilities (method C) hand what a node has not seen to its
suffix, down to 1/256 for every byte. A tree is kept sparse, as sorted runs of the bytes it has
seen and of its nodes, about 1 MB for 9 MB of text; it is fitted in a task of its language.

The statistics are frozen, so the cost of a byte is a function of its three predecessors. A piece
of text looks its distinct runs of four bytes up in every tree, once each; a text's exact code
length under a language is the sum over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import LOWER, pieces

#: Documents per language that the model is fitted on (the expected number; whole texts, by hash).
SAMPLE = 3000
#: A context of three bytes is a node of a language from this many bytes seen after it.
LEAST_SEEN = 8
#: Fixed point of costs: 1/1024 bit, so sums are whole numbers and do not depend on their order.
_UNIT = 1024
UNDETERMINED = "und"
_ORDER = 3
#: A text is unlike a language if its bits per byte exceed the mean of other texts of the language by
#: SPREADS standard deviations, each taken as LEAST_SPREAD of the mean at least; told from LEAST_TEXTS.
SPREADS, LEAST_SPREAD, LEAST_TEXTS = 12, 0.05, 5


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with three line feeds before each text, and the position of each byte of text."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data)) + _ORDER * (owner + 1)
    out = np.full(len(data) + _ORDER * (len(offsets) - 1), 10, np.uint8)
    out[at] = LOWER[data]
    return out, at


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for first, last, data, offsets in pieces(batch.column("text")):
            padded, at = _padded(data, offsets)
            wide = padded.astype(np.uint32)
            grams = wide[at] | wide[at - 1] << 8 | wide[at - 2] << 16 | wide[at - 3] << 24
            names, which = np.unique(langs[first:last].astype(str), return_inverse=True)
            owner = np.repeat(which, np.diff(offsets))
            for i, name in enumerate(names):
                found, counts = np.unique(grams[owner == i], return_counts=True)
                columns = [pa.array([str(name)] * len(found)), pa.array(found.astype(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def fit_language(gram: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """The tree of one language from runs of four bytes (as numbers, the last byte lowest) and counts.

    For orders 0 to 3: (runs of context and byte, their costs, contexts, costs of escaping them),
    runs and contexts in rising order, costs in units of 1/1024 bit.
    """
    tree = []
    for order in range(_ORDER + 1):
        run, which = np.unique(gram & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
        seen = np.bincount(which, n)
        context, owner = np.unique(run >> np.uint32(8), return_inverse=True)
        total, kinds = np.bincount(owner, seen), np.bincount(owner)
        kept = total >= LEAST_SEEN if order == _ORDER else np.ones(len(context), bool)
        all_of = total + kinds
        cost = np.round(-np.log2(seen / all_of[owner]) * _UNIT).astype(np.int32)
        escape = np.round(-np.log2(kinds / all_of) * _UNIT).astype(np.int32)
        tree.append((run[kept[owner]], cost[kept[owner]], context[kept], escape[kept]))
    return tree


def fit(grams: list[tuple[str, int, int]]) -> dict:
    """The model from (language, four bytes as a number, count)."""
    langs = sorted({g[0] for g in grams})
    mine = {lang: [g[1:] for g in grams if g[0] == lang] for lang in langs}
    return {"langs": langs, "trees": [fit_language(*(np.array(x, t) for x, t in zip(zip(*mine[lang]), (np.uint32, np.float64)))) for lang in langs]}


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``asked`` is among the keys, and its value."""
    if not len(keys):
        return np.zeros(len(asked), bool), np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return keys[at] == asked, values[at]


def _costs(tree: list, grams: np.ndarray) -> np.ndarray:
    """Cost of the last byte of each run of four under one tree."""
    out, left = np.zeros(len(grams), np.int32), np.arange(len(grams))
    for order in range(_ORDER, -1, -1):
        runs, costs, contexts, escapes = tree[order]
        asked = grams[left] & np.uint32((1 << 8 * (order + 1)) - 1)
        found, cost = _look_up(runs, costs, asked)
        out[left[found]] += cost[found]
        left, asked = left[~found], asked[~found]
        is_node, escape = _look_up(contexts, escapes, asked >> np.uint32(8))
        out[left[is_node]] += escape[is_node]
    out[left] += 8 * _UNIT
    return out


def _distinct(padded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of four bytes that end at some places, and which of them ends at each."""
    low = padded[at].astype(np.uint16) | padded[at - 1].astype(np.uint16) << 8
    high = padded[at - 2].astype(np.uint16) | padded[at - 3].astype(np.uint16) << 8
    met = np.zeros(1 << 16, bool)
    met[low] = met[high] = True
    pairs = np.flatnonzero(met)
    if len(pairs) > 1 << 12:
        return np.unique(low | high.astype(np.uint32) << 16, return_inverse=True)
    number = np.zeros(1 << 16, np.int32)
    number[pairs] = np.arange(len(pairs))
    cell = number[high] * np.int32(len(pairs)) + number[low]
    met = np.zeros(len(pairs) ** 2, bool)
    met[cell] = True
    cells = np.flatnonzero(met)
    number = np.zeros(len(met), np.int32)
    number[cells] = np.arange(len(cells))
    return (pairs[cells // len(pairs)] << 16 | pairs[cells % len(pairs)]).astype(np.uint32), number[cell]


def code_lengths(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits (in units of 1/1024) of each text under each language."""
    out = np.zeros((len(offsets) - 1, len(model["langs"])), np.int64)
    if not len(data):
        return out
    grams, which = _distinct(*_padded(data, offsets))
    full = np.flatnonzero(np.diff(offsets))
    for i, tree in enumerate(model["trees"]):
        out[full, i] = np.add.reduceat(_costs(tree, grams)[which], offsets[:-1][full], dtype=np.int64)
    return out


def _packed(tree: list) -> bytes:
    return b"".join(np.int64(len(x)).tobytes() + x.astype("<u4" if j % 2 == 0 else "<i4").tobytes() for part in tree for j, x in enumerate(part))


def _unpacked(blob: bytes) -> list[tuple[np.ndarray, ...]]:
    parts, low = [], 0
    for j in range(4 * (_ORDER + 1)):
        size = int(np.frombuffer(blob, "<i8", 1, low)[0])
        parts.append(np.frombuffer(blob, "<u4" if j % 2 == 0 else "<i4", size, low + 8))
        low += 8 + 4 * size
    return [tuple(parts[j : j + 4]) for j in range(0, len(parts), 4)]


def _fitted(table: pa.Table) -> pa.Table:
    gram, n = table["gram"].to_numpy().astype(np.uint32), table["n"].to_numpy().astype(np.float64)
    tree = _packed(fit_language(gram, n))
    return pa.table({"lang": pa.array([table["lang"][0].as_py()], pa.string()), "tree": pa.array([tree], pa.binary())})


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> dict:
    """Fit on about ``sample`` whole documents of each language (all, where there are fewer)."""
    rows = _sampled(docs, text, lang, key, sample)
    if rows is None:
        return {"langs": []}
    counted = rows.mapInArrow(_grams, "lang string, gram long, n long")
    grams = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # a group: the distinct runs of four bytes of a language's sample; a tree comes back for each
    trees = grams.groupBy("lang").applyInArrow(_fitted, "lang string, tree binary").collect()
    trees = sorted((r["lang"], bytes(r["tree"])) for r in trees)
    return {"langs": [lang for lang, _ in trees], "trees": [_unpacked(tree) for _, tree in trees]}


def _sampled(docs: DataFrame, text: str, lang: str, key: str, sample: int) -> DataFrame | None:
    """(lang, text) of about ``sample`` labelled documents of each language; None without labels."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    sizes = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("part"))
    parts = {r["lang"]: r["part"] for r in sizes.collect()}  # one row per language
    if not parts:
        return None
    part = F.element_at(F.create_map(*(F.lit(x) for item in sorted(parts.items()) for x in item)), F.col("lang"))
    point = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(4)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.filter(point < part).select("lang", "text")


def usual(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> dict:
    """language -> (mean, standard deviation) of the bits per byte of its texts, and their mean
    length: a model of one half of the labelled documents tells it of a sample of the other half."""
    half = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string"), F.lit(5)), F.lit(2))
    model = train(docs.filter(half == 0), text, lang, key, sample)
    rows = _sampled(docs.filter((half == 1) & F.col(text).cast("string").rlike(r"\p{L}")), text, lang, key, sample)
    if rows is None or not model["langs"]:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample of each language

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        at = {name: i for i, name in enumerate(model["langs"])}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, last, data, offsets in pieces(batch.column("text")):
                bits, sizes = code_lengths(model, data, offsets), np.diff(offsets)
                known = np.array([i for i, name in enumerate(langs[first:last]) if name in at], np.int64)
                own = bits[known, [at[langs[first + i]] for i in known]] if len(known) else np.zeros(0)
                columns = [pa.array([langs[first + i] for i in known], pa.string()), pa.array(own / _UNIT / sizes[known], pa.float64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes[known], pa.int64())], ["lang", "x", "size"])

    told = rows.mapInArrow(work, "lang string, x double, size long").groupBy("lang")
    told = told.agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.stddev("x").alias("sd"), F.avg("size").alias("size"))
    return {r["lang"]: (r["x"], r["sd"], r["size"]) for r in told.collect() if r["n"] >= LEAST_TEXTS}  # a row per language


def _unlike(model: dict, bits: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the best language codes a text far worse than its own. A text varies as one of the
    length of its distinct runs of four bytes: short texts and those that repeat a word, more."""
    sizes, best, per_byte = np.diff(offsets), bits.argmin(axis=1), bits.min(axis=1) / _UNIT
    per_byte = per_byte / np.maximum(sizes, 1)
    far = np.flatnonzero(per_byte > _limits(model, best, sizes))
    runs = [len({data[i : i + 4].tobytes() for i in range(offsets[k], offsets[k + 1])}) for k in far]
    out = np.zeros(len(sizes), bool)
    out[far] = per_byte[far] > _limits(model, best[far], np.array(runs, np.int64))
    return out


def _limits(model: dict, best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Most bits per byte of texts like the language they are told to be."""
    unknown = (np.inf, 0.0, 1.0)
    mean, spread, size = np.array([model["usual"].get(name, unknown) for name in model["langs"]]).T[:, best]
    spread = np.maximum(spread, LEAST_SPREAD * mean)
    return mean + SPREADS * spread * np.sqrt(np.maximum(1.0, size / np.maximum(sizes, 1)))


def predict(docs: DataFrame, model: dict, text: str = "text", *columns: Column | str) -> DataFrame:
    """The columns asked for, plus ``lang_pred`` and ``score``: the probability of that language
    given the text if all are equally likely beforehand.

    Texts that are null or without a letter, and all texts under a model that learned nothing,
    are ``und`` with score 0. Ties go to the name that sorts first. If the model has ``usual``, of
    :func:`usual`, texts that their best language codes far worse than its own are ``und`` too.
    """
    asked = docs.select(*columns)
    with_text = text in asked.columns  # then it travels once
    rest = [c for c in columns if not (isinstance(c, str) and c == text)]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *rest).alias("_in"),
        F.col(text).alias("_text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample of each language
    schema = rows.select("_in", *["_text"] * with_text).schema.add("lang_pred", "string").add("score", "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column("_text")
            valid = batch.column("_letters").to_numpy(zero_copy_only=False).copy()
            names, scores = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            if model["langs"]:
                for first, last, data, offsets in pieces(column):
                    bits = code_lengths(model, data, offsets)
                    best = bits.argmin(axis=1)
                    more = (bits - bits.min(axis=1, keepdims=True)) / _UNIT
                    names[first:last] = np.array(model["langs"], object)[best]
                    scores[first:last] = 1 / np.exp2(-more).sum(axis=1)
                    if "usual" in model:
                        valid[first:last] &= ~_unlike(model, bits, data, offsets)
            names[~valid], scores[~valid] = UNDETERMINED, 0.0
            made = {"_in": batch.column("_in")} | ({"_text": column} if with_text else {})
            made |= {"lang_pred": pa.array(names.tolist(), pa.string()), "score": pa.array(scores)}
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    told = rows.mapInArrow(work, schema)
    given = [F.col("_text").alias(c) if c == text else F.col("_in").getField(c).alias(c) for c in asked.columns]
    return told.select(*given, "lang_pred", "score")
