"""Mixing sources to target weights with DataFrame operations only.

Every document gets a hash-random key. Keys are uniform, so equal slices of the key space are a
range partitioning within each source; running sums go up in three levels (within a slice,
slices within a stretch, stretches within a source) and no window holds more than a few hundred
rows unless a source has tens of millions of slices. A source's budget is cut exactly: whole
passes over all its documents, then one more pass in key order up to the word on which it ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import WORDS, saved, set_aside, taken_back

#: Documents per slice and slices per stretch, on average.
SLICE, STRETCH = 64, 256


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(skey, n_docs, source_size, target) from one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share`` of all
    sizes; none takes over ``most`` times its size and the others divide what it leaves. Solved in
    one pass: by rising size per weight, a source is full if the level reached by those left is
    above it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("w", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn(
        "level",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("w").over(after),
    ).withColumn("full", F.col("cap") <= F.col("w") * F.col("level"))
    # past the first source that is not full, levels fall: too much is taken off before them
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level)
    return rows.select("skey", "n_docs", "source_size", F.coalesce(target, F.col("cap")).alias("target"))


def mix(
    docs: DataFrame,
    weights: list[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """doc_id, rkey, size, source_size, target, taken: one row per row of ``docs``.

    ``taken`` counts words, repeats included: ``floor(target / source_size)`` whole passes, then
    documents in order of the random key up to the budget, the last one in part. Null and empty
    texts have size 0. Rows with equal ids are rows of their own; where also the sizes are equal
    it is undefined which of them comes first, with the same rows as result. ``rkey`` is the
    MD5 of seed and id.
    """
    return saved(_mixed(docs, weights, share, most, seed, key, text, source), "mix")


def _mixed(docs, weights, share, most, seed, key, text, source) -> DataFrame:
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("skey"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("rkey"),
        n_words(text).alias("size"),
    )
    rows = saved(rows, "mix-sizes")
    sizes = rows.groupBy("skey", "source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    # a written table has a size, so Spark broadcasts it up to its threshold and joins by shuffle beyond
    per_source = saved(targets(sizes, list(weights), share, most), "mix-targets")
    rows = rows.drop("source").join(per_source, "skey")
    slices = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / SLICE))
    point = F.conv(F.substring("rkey", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("slice", F.floor(point * slices / F.lit(2.0**32)).cast("long"))
    rows = rows.withColumn("stretch", F.floor(F.col("slice") / STRETCH))

    fine = rows.groupBy("skey", "stretch", "slice").agg(F.sum("size").alias("words"))
    coarse = fine.groupBy("skey", "stretch").agg(F.sum("words").alias("words"))
    by_source = Window.partitionBy("skey").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select("skey", "stretch", F.coalesce(F.sum("words").over(by_source), F.lit(0)).alias("base"))
    by_stretch = Window.partitionBy("skey", "stretch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn("offset", F.coalesce(F.sum("words").over(by_stretch), F.lit(0))).drop("words")
    fine = fine.join(coarse, ["skey", "stretch"]).select("skey", "slice", (F.col("base") + F.col("offset")).alias("base"))

    by_slice = Window.partitionBy("skey", "slice").orderBy("rkey", "doc_id", "size")
    inside = F.coalesce(F.sum("size").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # not left to the join above: dealt by source alone, a large source would be one task
    rows = rows.repartition("skey", "slice").withColumn("inside", inside).join(fine, ["skey", "slice"])
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.floor(F.col("target") - passes * F.col("source_size"))
    last = F.least(F.col("size"), F.greatest(F.lit(0), left - F.col("base") - F.col("inside")))
    taken = (passes * F.col("size") + last).cast("long")
    return rows.select("doc_id", "rkey", "size", "source_size", "target", taken.alias("taken"))


def copies(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The mix as rows of ``docs``: a document as often as it is taken, the last copy cut after the
    words that its budget still holds (words then joined by one space).

    Rows that share an id get the same number of words as the first of them. Documents without
    words are not in a mix.
    """
    plan = mixed.groupBy("doc_id", "size").agg(F.max("taken").alias("_taken")).filter("_taken > 0")
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "_taken")
    whole = set_aside(docs, text, F.col(key).alias("_key"), n_words(text).alias("_words"))
    rows = whole.join(plan, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size")))))
    left = F.least(F.col("_size"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("_text"), F.lit(WORDS), F.lit(0)), F.lit(1), left), " ")
    kept = F.when(left < F.col("_size"), cut).otherwise(F.col("_text"))
    return rows.select(*taken_back(docs.columns, text, kept))
