"""(date x source) panels cut into blocks of dates and tiles of sources.

Rolling frames count *calendar rows*: the distinct dates of the whole panel, in
order, whether or not a given source reports that day. The functions here number
that calendar, cut it into blocks of ``block`` dates that overlap by the longest
frame (``reach``), and pack every source of a block into one aligned array per
observable. Pairs are then formed tile by tile inside a block.

Every packed group has a size fixed by ``block``, ``reach`` and ``tile``, so
neither a long history nor many sources nor a busy source can outgrow a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.names import c, literal


class PanelIndex:
    """Dates and sources of a panel, usable inside expressions; found in one pass over it.

    Held as one scalar subquery: the sorted days and, per calendar day since the first, the
    number of the latest panel date; and the sorted sources. Its size depends on the span of
    the dates (Spark's date type ends at 3.65 million days, about 30 MB; 20 years of history are
    60 KB) and on the number of sources, whose pairs are the result; never on the number of rows.
    Both sets are combined on the map side.
    """

    def __init__(self, panel: DataFrame, tile: int, date: str = "date", source: str = "source"):
        by_day = """flatten(transform(days, (day, i) ->
            array_repeat(i, coalesce(datediff(get(days, i + 1), day), 1))))"""
        self._spark = panel.sparkSession
        self._value = (
            panel.agg(
                F.sort_array(F.collect_set(c(date))).alias("days"),
                F.sort_array(F.collect_set(c(source))).alias("sources"),
            )
            .selectExpr(
                f"""struct(days, size(days) AS n, get(days, 0) AS first, {by_day} AS by_day, sources,
                int(ceil(greatest(size(sources), 1) / {tile})) AS tiles)"""
            )
            .scalar()
        )

    @property
    def size(self) -> Column:
        return self._value["n"]

    @property
    def tiles(self) -> Column:
        """Number of tiles the sources are to be spread over."""
        return self._value["tiles"]

    def index_of(self, date: Column) -> Column:
        return F.get(self._value["by_day"], F.datediff(date, self._value["first"]))

    def date_at(self, index: Column) -> Column:
        return F.get(self._value["days"], index)

    def sources(self) -> DataFrame:
        """One row per source, with the numbers of dates (``n``) and tiles."""
        one = self._spark.range(1, numPartitions=1)
        whole = one.select(self._value["sources"].alias("all"), self.size.alias("n"), self.tiles.alias("tiles"))
        return whole.select(F.explode("all").alias("source"), "n", "tiles")


@dataclass(frozen=True)
class Layout:
    """How a panel is cut: dates per block, overlap, sources per tile.

    The expressions read a column ``block``; those that need the length of the
    calendar also read a column ``n``.
    """

    block: int
    reach: int
    tile: int

    @property
    def first_index(self) -> str:
        """Calendar number of the first date held by a block (overlap included)."""
        return f"greatest(block * {self.block} - {self.reach}, 0)"

    @property
    def overlap(self) -> str:
        """Dates of a block that belong to the one before."""
        return f"(block * {self.block} - {self.first_index})"

    @property
    def length(self) -> str:
        return f"(least((block + 1) * {self.block}, n) - {self.first_index})"

    @property
    def last_block(self) -> str:
        return f"((n - 1) div {self.block})"

    def blocks_of(self, index: str) -> str:
        """Blocks that hold the date numbered ``index``: its own and the next."""
        return (
            f"sequence({index} div {self.block}, "
            f"least(({index} + {self.reach}) div {self.block}, {self.last_block}))"
        )


def packed_series(
    panel: DataFrame, observables: Sequence[str], index: PanelIndex, layout: Layout
) -> DataFrame:
    """One aligned array per (observable, block, source): ``v[i]`` or null per date.

    ``tiles`` is the number of tiles the sources are to be spread over.

    ``panel`` has ``date``, ``source`` and the observables as doubles. Every source
    has a row for every block, as the pairs of a block are formed from all sources
    of the panel. A repeated (date, source) fails the query.
    """
    names = [f"v{i}" for i in range(len(observables))]
    values = ", ".join(names)
    reports = (
        panel.select(
            "source",
            index.index_of(F.col("date")).alias("d_idx"),
            index.size.alias("n"),
            index.tiles.alias("tiles"),
            # NaN counts as missing
            *[F.nanvl(c(name), F.lit(None)).alias(v) for name, v in zip(observables, names)],
        )
        .where("d_idx IS NOT NULL")
        .selectExpr("*", f"explode({layout.blocks_of('d_idx')}) AS block")
        .selectExpr(
            "source", "n", "tiles", "block", f"d_idx - {layout.first_index} AS pos", *names
        )
    )
    presence = (
        index.sources()
        .selectExpr(
            "source",
            "n",
            "tiles",
            f"explode(sequence(0L, {layout.last_block})) AS block",
            "CAST(NULL AS INT) AS pos",
            *[f"CAST(NULL AS DOUBLE) AS {v}" for v in names],
        )
    )
    cells = (
        reports.unionByName(presence)
        # one shuffle serves both aggregations below
        .repartition("source", "block")
        .groupBy("source", "block", "n", "tiles", "pos")
        .agg(*[F.first(v).alias(v) for v in names], F.count(F.lit(1)).alias("copies"))
        .groupBy("source", "block", "n", "tiles")
        .agg(
            F.expr(
                f"""sort_array(collect_list(CASE
                      WHEN pos IS NULL THEN NULL
                      WHEN copies = 1 THEN struct(pos, {values})
                      ELSE raise_error(concat('duplicate (date, source) in panel for source ', source))
                    END))"""
            ).alias("cells")
        )
        .selectExpr("source", "block", "tiles", "cells", f"{layout.length} AS length")
    )

    def aligned(v: str) -> str:
        """Values in date order with nulls filled in between, in one pass."""
        return f"""CASE WHEN size(cells) = length THEN transform(cells, cell -> cell.{v})
            ELSE concat(
              flatten(transform(cells, (cell, i) -> concat(
                array_repeat(double(NULL), int(cell.pos - coalesce(get(cells, i - 1).pos, -1) - 1)),
                array(cell.{v})))),
              array_repeat(double(NULL),
                int(length - coalesce(get(cells, size(cells) - 1).pos, -1) - 1))) END"""

    series = [
        f"struct({literal(observable)} AS observable, {aligned(v)} AS v)"
        for observable, v in zip(observables, names)
    ]
    return cells.selectExpr("source", "block", "tiles", f"inline(array({', '.join(series)}))")


PAIR_KEYS = ("observable", "block", "tile1", "tile2")


def source_pairs(series: DataFrame, tasks: int | None = None) -> DataFrame:
    """All unordered source pairs of every (observable, block), as array pairs.

    Sources are hashed into about ``N / tile`` tiles; a pair belongs to exactly one
    (tile1 <= tile2), and each series is sent to the tile pairs it takes part in.
    A task therefore sees at most two tiles of one block, and the shuffle carries
    packed arrays, ``N / tile`` copies each, rather than ``N`` rows per value.
    ``tasks`` is the number of tasks to divide them over, at least the usual number.
    """
    # not left to AQE: it would size partitions by these small arrays, although
    # each of them stands for all its pairs
    spark = series.sparkSession
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, tasks or 1
    )
    grouped = (
        series.selectExpr("*", "int(pmod(xxhash64(source), tiles)) AS tile")
        .selectExpr("*", "explode(sequence(0, tiles - 1)) AS other")
        .selectExpr(
            "observable",
            "block",
            "least(tile, other) AS tile1",
            "greatest(tile, other) AS tile2",
            "tile",
            "struct(source, v) AS member",
        )
        .repartition(partitions, *PAIR_KEYS)
        .groupBy(*PAIR_KEYS)
        .agg(
            F.expr("collect_list(CASE WHEN tile = tile1 THEN member END)").alias("low"),
            F.expr("collect_list(CASE WHEN tile = tile2 THEN member END)").alias("high"),
        )
    )
    return grouped.selectExpr(
        *PAIR_KEYS,
        """inline(flatten(transform(low, a -> transform(
             filter(high, b -> tile1 != tile2 OR a.source < b.source),
             b -> CASE WHEN a.source < b.source
               THEN struct(a.source AS source1, b.source AS source2, a.v AS x, b.v AS y)
               ELSE struct(b.source AS source1, a.source AS source2, b.v AS x, a.v AS y) END))))""",
    )
