"""Deduplication of multi-line passages by content-defined chunks of lines, DataFrame operations only.

The rule. Of the lines of a text that are not blank, the first and the last are boundaries, and so
is each whose rolling hash (31 * hash of the line + hash of the next line that is not blank) modulo
``divisor`` is below ``chosen``. A boundary inside a passage depends on lines of the passage alone,
so a passage is cut alike wherever it stands. A chunk reaches from one boundary to the next, both
included. Of chunks equal byte by byte in the whole table the first occurrence by (key, MD5 of the
text, line) stays; each other one is removed, together with the lines before it, back to the
boundary before, and after it, on to the boundary after, as far as they equal byte by byte the
lines around the first occurrence. ``chosen = divisor`` makes every line a boundary: then every run
of two lines that occurred before goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import done_with, saved, set_aside, taken_back

#: A line is a boundary with a probability of CHOSEN / DIVISOR.
DIVISOR, CHOSEN = 3, 2
_FACTOR = 31
_SOLID = r"[^\\x20\\x09-\\x0D]"


def _tag(text: str) -> Column:
    """MD5 of the text, which tells rows of equal id apart."""
    return F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_tag")


def _with_lines(docs: DataFrame) -> DataFrame:
    # a generator keeps an array from being computed again for each element taken from it
    return docs.withColumn("_lines", F.explode(F.array(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1))))


def _chunks(docs: DataFrame, divisor: int, chosen: int) -> DataFrame:
    """_id, _tag, first and last line of each chunk, the boundaries before and after, digest."""
    rows = _with_lines(docs)
    solid = F.expr(f"filter(sequence(0, size(_lines) - 1), i -> get(_lines, i) RLIKE '{_SOLID}')")
    rows = rows.withColumn("_p", F.explode(F.array(solid))).filter("size(_p) > 1")
    hashes = F.expr("transform(_p, i -> CAST(conv(substring(md5(get(_lines, i)), 1, 8), 16, 10) AS BIGINT))")
    rows = rows.withColumn("_h", F.explode(F.array(hashes)))
    bounds = F.expr(
        "transform(filter(sequence(0, size(_p) - 1), j -> j = 0 OR j = size(_p) - 1 OR "
        f"(get(_h, j) * {_FACTOR} + get(_h, j + 1)) % {divisor} < {chosen}), j -> get(_p, j))"
    )
    rows = rows.withColumn("_b", F.explode(F.array(bounds)))
    chunk = F.expr(
        "transform(sequence(0, size(_b) - 2), k -> struct(get(_b, k) AS start, get(_b, k + 1) AS stop, "
        "coalesce(get(_b, k - 1), get(_b, k)) AS before, coalesce(get(_b, k + 2), get(_b, k + 1)) AS after))"
    )
    rows = rows.withColumn("c", F.explode(chunk)).select("_id", "_tag", "_lines", "c.*")
    text = _between("start", "stop")
    return rows.select("_id", "_tag", "start", "stop", "before", "after", F.unhex(F.md5(text)).alias("digest"))


def _run(start: str, stop: str) -> Column:
    """The lines from start to stop, both included; stop may be start - 1."""
    return F.expr(f"slice(_lines, {start} + 1, {stop} - {start} + 1)")


def _between(start: str, stop: str) -> Column:
    return F.array_join(_run(start, stop), "\n")


def _equal(one: str, two: str, place: str) -> Column:
    """How many leading elements, by the place in an array that ``place`` makes of k = 1, 2 …, are equal."""
    most = f"least(size({one}), size({two}))"
    differs = f"get({one}, {place.format(one)}) <> get({two}, {place.format(two)})"
    return F.expr(
        f"if({most} = 0, 0, coalesce(array_min(filter(sequence(1, {most}), k -> {differs})) - 1, {most}))"
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR, chosen: int = CHOSEN
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, plus ``_n_lines`` and ``_n_removed`` (which
    replace columns of these names).

    Each line that goes equals an earlier line that stays. Null texts stay null; a text of which
    nothing is left is empty. A trailing line break ends in an empty line; a line that is blank
    makes no chunk of its own but belongs to the one around it. Rows equal in key and text stand
    for the same occurrence: each of them keeps what the first one keeps. A null key comes before
    all others.
    """
    mine = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), _tag(text))
    chunks = saved(_chunks(mine, divisor, chosen), "lines-chunks", "zstd")
    here = F.struct(F.col("_id").isNotNull().alias("n"), "_id", "_tag", "start")
    repeated = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(here).alias("first")).filter("n > 1")
    is_first = (
        F.col("_id").eqNullSafe(F.col("first._id"))
        & (F.col("_tag") == F.col("first._tag"))
        & (F.col("start") == F.col("first.start"))
    )
    seen = chunks.join(repeated.drop("n"), "digest").withColumn("is_first", is_first)
    mark = F.struct("digest", "is_first", "start", "stop", "before", "after")
    marks = seen.groupBy("_id", "_tag").agg(F.collect_set(mark).alias("_marks"))
    marked = _with_lines(mine.join(_named(marks, "_marks"), _same_text()))
    marked = marked.withColumn("m", F.explode("_marks")).select("_id", "_tag", "_lines", "m.*")
    marked = marked.select(
        "_id",
        "_tag",
        "digest",
        "is_first",
        "start",
        "stop",
        _between("start", "stop").alias("chunk"),
        _run("before", "start - 1").alias("left"),
        _run("stop + 1", "after").alias("right"),
    )
    marked = saved(marked, "lines-seen", "zstd")
    done_with(chunks)
    first = marked.filter("is_first").select(
        "digest", F.col("chunk").alias("original"), F.col("left").alias("left1"), F.col("right").alias("right1")
    )
    first = first.dropDuplicates(["digest"])  # rows equal in key and text
    gone = marked.filter("NOT is_first").join(first, "digest").filter("chunk = original")
    gone = gone.withColumn("start", F.col("start") - _equal("left", "left1", "size({}) - k"))
    gone = gone.withColumn("stop", F.col("stop") + _equal("right", "right1", "k - 1"))
    gone = gone.groupBy("_id", "_tag").agg(F.collect_set(F.struct("start", "stop")).alias("_runs"))
    whole = set_aside(docs, text, F.col(key).alias("_id"), _tag(text))
    rows = _with_lines(whole.join(_named(gone, "_runs"), _same_text(), "left"))
    left = F.expr(
        "array_except(sequence(0, size(_lines) - 1), "
        "coalesce(flatten(transform(_runs, r -> sequence(r.start, r.stop))), array()))"
    )
    rows = rows.withColumn("_left", F.explode(F.array(F.when(F.col("_runs").isNotNull(), left))))
    joined = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    lines = F.size("_lines").cast("long")
    return rows.select(
        *taken_back(
            [c for c in docs.columns if c not in ("_n_lines", "_n_removed")],
            text,
            F.when(F.col("_left").isNull(), F.col("_text")).otherwise(joined),
        ),
        lines.alias("_n_lines"),
        F.when(F.col("_left").isNull(), F.lit(0)).otherwise(lines - F.size("_left")).cast("long").alias("_n_removed"),
    )


def _named(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(F.col("_id").alias("_rid"), F.col("_tag").alias("_rtag"), *columns)


def _same_text() -> Column:
    return F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_tag") == F.col("_rtag"))
