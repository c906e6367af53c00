"""Benchmark passages in documents by a prefix-filtered set join, DataFrame operations only.

A window is a run of consecutive words of an item; as a set it holds the shingles (runs of up to
three words) at its positions. A document holds the window only if it holds all of them, so by the
prefix filter at full containment one shingle is enough to join on: the rarest. Rarity is counted
over all documents; a window of which some shingle is in no document is out at once.

1. The shingles of all items are looked for in all documents and counted.
2. The rarest shingle of each window is joined with the shingles of the documents; where the window
   would begin before a document or end after it, the pair is no candidate.
3. Candidates go back to their documents and are compared with as many words as the window has.

Shingles meet by hashes of words that are lower-cased in full; the comparison in step 3 is exact.
Documents are read once in each step and never shuffled whole in the first two: what leaves a task
is a count, or a candidate. The item side is broadcast while its rows are counted to be few, and
joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import done_with, saved, set_aside

#: What parts words: they hold ASCII letters and digits, and all beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: In texts that are not lower-cased yet.
_BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 3
#: Rows of shingles up to which they are broadcast (a few dozen bytes each).
BROADCAST_ROWS = 1_000_000


def _split(text: Column, between: str = _BETWEEN) -> Column:
    """Words of a text; a search for matches would copy the text for every one of them."""
    return F.array_remove(F.split(text, between, -1), "")


def _words(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    return _split(F.translate(text, _UPPER, _LOWER))


def _shingles(rows: DataFrame, widths: list[int], *columns: str) -> DataFrame:
    """columns, pos (from 0), n (words) and hash of each shingle of ``_text``, by all of the widths.

    Words are lower-cased in full, which equates more than the exact comparison does, never less.
    """
    rows = rows.select(*columns, _split(F.lower(F.coalesce("_text", F.lit("")))).alias("w"))
    rows = rows.select(*columns, "w", F.size("w").alias("n"), F.posexplode("w").alias("pos", "first"))

    def hashed(width: int) -> Column:
        rest = [F.get("w", F.col("pos") + k) for k in range(1, width)]
        return F.xxhash64(F.lit(width), "first", *rest)

    if len(widths) == 1:
        rows = rows.filter(F.col("pos") <= F.col("n") - widths[0])
        return rows.select(*columns, "pos", "n", hashed(widths[0]).alias("hash"))
    every = F.array(*(F.when(F.col("pos") <= F.col("n") - w, hashed(w)) for w in widths))
    rows = rows.select(*columns, "pos", "n", F.explode(every).alias("hash"))
    return rows.filter("hash IS NOT NULL")


def windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, k, passage): the distinct windows of each item, k words joined by spaces."""
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), _words(F.col(text)).alias("w"))
    rows = rows.withColumn("k", F.least(F.size("w"), F.lit(window))).filter("k > 0")
    rows = rows.select("item", "k", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("i"))
    return rows.select("item", "k", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("passage")).distinct()


def _joined(docs: DataFrame, small: DataFrame, how: str = "inner") -> DataFrame:
    """Shingles of documents with a saved table by hash; the table is broadcast if it is counted to be small."""
    return docs.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, "hash", how)


def _candidates(docs: DataFrame, distinct: DataFrame, shingle: int) -> DataFrame:
    """(_id, _tag, start, wid): where a window may begin in a document."""
    wide = F.least(F.col("k"), F.lit(shingle))
    at = F.explode(F.sequence(F.lit(0), F.col("k") - wide)).alias("offset")
    tokens = distinct.select("wid", "k", wide.alias("width"), F.split(F.lower("passage"), " ").alias("w"), at)
    # the hash of a shingle has to come out as for documents: width, first word, the others
    rest = [F.when(F.col("width") > j, F.get("w", F.col("offset") + j)) for j in range(1, shingle)]
    tokens = tokens.select("wid", "k", "offset", F.xxhash64("width", F.get("w", F.col("offset")), *rest).alias("hash"))
    tokens = saved(tokens, "leaks-tokens")
    widths = sorted(r[0] for r in distinct.select(wide).distinct().collect())  # 1 to ``shingle`` at most
    if not widths:
        return docs.select("_id", "_tag", F.lit(0).alias("start"), F.lit(0).cast("long").alias("wid")).limit(0)

    known = saved(tokens.select("hash").distinct(), "leaks-known")
    seen = _joined(_shingles(docs, widths), known)
    seen = saved(seen.groupBy("hash").agg(F.count("*").alias("seen")), "leaks-seen")
    done_with(known)

    ranked = tokens.join(seen, "hash", "left")
    rarest = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "hash", "offset", "k"))
    prefix = ranked.groupBy("wid").agg(rarest.alias("t")).filter("t.seen > 0")
    prefix = saved(prefix.select("wid", "t.hash", "t.offset", "t.k"), "leaks-prefix")
    done_with(tokens)
    done_with(seen)
    found = _joined(_shingles(docs, widths, "_id", "_tag"), prefix)
    start = F.col("pos") - F.col("offset")
    return found.filter((start >= 0) & (start + F.col("k") <= F.col("n"))).select("_id", "_tag", start.alias("start"), "wid")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` and ``items`` (which replace columns of these names).

    ``spans``: (start, length) in words of the stretches that windows of items cover, in order and
    apart; ``n_hit`` words lie in them. ``items``: ids of the items with a window in the document,
    as strings in code point order; a null id counts as one item and prints as an empty string.
    Null and empty texts have no words and hold nothing, an item without words is nowhere, an item
    shorter than ``window`` is one window. Rows of equal id are documents of their own; equal items
    and repeated windows count once.
    """
    won = saved(windows(items, item, item_text, window), "leaks-windows")
    # equal windows of several items are one
    distinct = won.groupBy("k", "passage").agg(F.count("*").alias("held"))
    distinct = saved(distinct.withColumn("wid", F.monotonically_increasing_id()), "leaks-distinct")
    tag = F.xxhash64(F.col(text))  # splits rows that share an id; those that share both share candidates, too
    plain = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), tag.alias("_tag"))
    candidates = saved(_candidates(plain, distinct, shingle).distinct(), "leaks-candidates")

    full = candidates.join(distinct.select("wid", "k", "passage"), "wid")
    by_doc = full.groupBy("_id", "_tag").agg(F.collect_list(F.struct("start", "k", "wid", "passage")).alias("_may"))
    by_doc = by_doc.select(F.col("_id").alias("_cid"), F.col("_tag").alias("_ctag"), "_may")
    rows = plain.select("_id", "_tag", "_text")
    mine = F.col("_id").eqNullSafe(F.col("_cid")) & F.col("_tag").eqNullSafe(F.col("_ctag"))
    verified = rows.join(by_doc, mine).withColumn("_w", F.explode(F.array(_words(F.col("_text")))))
    same = F.filter("_may", lambda m: F.array_join(F.slice("_w", m["start"] + 1, m["k"]), " ") == m["passage"])
    verified = verified.select("_id", F.md5("_text").alias("_md5"), same.alias("_is")).filter("size(_is) > 0")
    verified = saved(verified.dropDuplicates(["_id", "_md5"]), "leaks-verified")
    done_with(candidates)

    wids = F.array_distinct(F.transform("_is", lambda m: m["wid"]))
    which = verified.select("_id", "_md5", F.explode(wids).alias("wid"))
    which = which.join(distinct.select("wid", "k", "passage"), "wid").join(won, ["k", "passage"])
    which = which.groupBy("_id", "_md5").agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = _spans(verified).select("_id", "_md5", "spans").join(
        which.select(F.col("_id").alias("_wid"), F.col("_md5").alias("_wmd5"), "items"),
        F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_md5") == F.col("_wmd5")),
    )
    both = saved(both.select(F.col("_id").alias("_bid"), F.col("_md5").alias("_bmd5"), "spans", "items"), "leaks-found")
    done_with(verified)

    n_words = F.size(_split(F.coalesce(F.col(text), F.lit("")), _BETWEEN_ANY_CASE)).cast("long").alias("_n")
    whole = set_aside(docs, text, F.col(key).alias("_id"), F.md5(F.col(text)).alias("_md5"), n_words)
    out = whole.join(both, F.col("_id").eqNullSafe(F.col("_bid")) & (F.col("_md5") == F.col("_bmd5")), "left")
    none = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.coalesce("spans", none)
    made = ("n_words", "n_hit", "spans", "items")
    return out.select(
        *(F.col("_text").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns if c not in made),
        F.col("_n").alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_hit"),
        spans.alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _spans(rows: DataFrame) -> DataFrame:
    """rows with ``spans``: the stretches of words that the windows in ``_is`` cover together."""
    inside = F.flatten(F.transform("_is", lambda m: F.sequence(m["start"], m["start"] + m["k"] - 1)))
    # a generator keeps the array from being computed again for each element below
    rows = rows.withColumn("_in", F.explode(F.array(F.array_sort(F.array_distinct(inside)))))
    first = F.filter("_in", lambda x, i: (i == 0) | (F.get("_in", i - 1) < x - 1))
    last = F.filter("_in", lambda x, i: F.coalesce(F.get("_in", i + 1) > x + 1, F.lit(True)))
    spans = F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("length")))
    return rows.withColumn("spans", spans).drop("_in")
