"""Rates jobs: load curves, compute window correlations, keep them in a table."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import (
    DEFAULT_START,
    DEFAULT_TENORS,
    DEFAULT_WINDOWS,
    RATE_FOLDERS,
    RATE_TABLES,
    WINDOW_CORR_KEY,
    WINDOW_CORR_TABLE,
)
from panelspark.operators.correlation import DCORR, PEARSON, tasks_for, window_correlations
from panelspark.operators.coverage import coverage
from panelspark.names import c
from panelspark.operators.keyed import deduplicate, upsert
from panelspark.operators.tables import TableStore, align_to, any_of
from panelspark.operators.transforms import CastDate, RenameTenors, SourceFromFilename
from panelspark.plans.ingest import load_directories_into_tables
from panelspark.sources import hadoop

# Tables whose tenors are correlated; spot FX is loaded alongside but has none.
CORRELATED_TABLES = ("zero_rates", "par_rates")
# Artefact names by method.
ARTEFACT_PREFIX = {PEARSON: "corr_dfs_melted", DCORR: "dcorr_dfs_melted"}


def load_rates(spark: SparkSession, root: str, should_load: bool = True) -> dict[str, bool]:
    """Load the curve folders under ``root``: file stem as source, tenor names normalised.

    Dates are stored as dates, so that a first day is a filter of the scan."""
    return load_directories_into_tables(
        spark,
        {table: f"{root.rstrip('/')}/{folder}" for table, folder in RATE_FOLDERS.items()},
        extensions={".parquet"},
        transforms=[SourceFromFilename(), RenameTenors(), CastDate("date")],
        should_load=should_load,
    )


def rate_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The rate tables, ``date`` as a date also where it was stored as text; fails naming every missing one."""
    store = TableStore(spark)
    missing = [name for name in RATE_TABLES if not store.exists(name)]
    if missing:
        raise LookupError(f"Missing rate tables: {', '.join(missing)}. Load them first.")
    frames = {name: store.table(name) for name in RATE_TABLES}
    return {
        name: df if dict(df.dtypes)["date"] == "date" else df.withColumn("date", F.to_date("date"))
        for name, df in frames.items()
    }


def rates_coverage(spark: SparkSession) -> DataFrame:
    return coverage(rate_tables(spark))


def since(df: DataFrame, start: dt.date = DEFAULT_START) -> DataFrame:
    return df.where(F.col("date") >= F.lit(start))


def last_date(df: DataFrame, table: str) -> str:
    """Latest date as ``YYYYMMDD``, for artefact names."""
    latest = df.agg(F.date_format(F.max("date"), "yyyyMMdd").alias("d")).first()["d"]
    if latest is None:
        raise ValueError(f"No rows in {table} since the start date")
    return latest


class CorrelationArtefacts:
    """Computed correlations kept as parquet under one folder.

    ``{prefix}_{table}_{start}_{last}/window_size={W}``, with a note ``_complete`` of the tenors
    and window sizes that are there, written last. What the note does not vouch for counts as
    absent, so a job that was cut off is computed again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, method: str, table: str, start: dt.date, last: str) -> str:
        return f"{self.folder}/{ARTEFACT_PREFIX[method]}_{table}_{start:%Y%m%d}_{last}"

    def _complete(self, path: str) -> dict[str, list]:
        note = hadoop.read_text(f"{path}/_complete")
        return json.loads(note) if note else {"tenors": [], "windows": []}

    def write(
        self,
        df: DataFrame,
        table: str,
        *,
        tenors: Sequence[str] = DEFAULT_TENORS,
        windows: Sequence[int] = DEFAULT_WINDOWS,
        start: dt.date = DEFAULT_START,
        overwrite: bool = False,
    ) -> list[str]:
        """Compute what is missing (or everything), all methods in one job; returns the folders asked for.

        Where other tenors are kept, they are computed again along with the new ones.
        """
        df = since(df, start)
        last = last_date(df, table)
        paths = {method: self.path(method, table, start, last) for method in ARTEFACT_PREFIX}
        kept = {m: {"tenors": [], "windows": []} if overwrite else self._complete(p) for m, p in paths.items()}
        asked = [f"{path}/window_size={w}" for path in paths.values() for w in windows]
        known = set.intersection(*(set(k["tenors"]) for k in kept.values()))
        ready = set.intersection(*(set(k["windows"]) for k in kept.values()))
        if set(tenors) <= known and set(windows) <= ready:
            return asked
        if set(tenors) <= known:
            todo = [w for w in windows if w not in ready]
        else:
            known, todo = known | set(tenors), sorted(ready | set(windows))
            ready = set()
        staged = f"{self.folder}/_staged-{uuid.uuid4().hex}"
        size = df.agg(F.count_distinct("date").alias("dates"), F.count_distinct("source").alias("sources")).first()
        tasks = tasks_for(size["dates"], size["sources"], len(known), todo)
        rows = window_correlations(df, sorted(known), todo, list(ARTEFACT_PREFIX), tasks=tasks)
        rows.write.partitionBy("corr_type", "window_size").parquet(staged)
        for method, path in paths.items():
            hadoop.delete(f"{path}/_complete")
            if not ready:
                hadoop.delete(path)
            for w in todo:
                part = f"corr_type={method}/window_size={w}"
                hadoop.delete(f"{path}/window_size={w}")
                if hadoop.exists(f"{staged}/{part}"):  # a window may be longer than the history
                    hadoop.move(f"{staged}/{part}", f"{path}/window_size={w}")
            note = {"tenors": sorted(known), "windows": sorted(ready.union(todo))}
            hadoop.write_text(f"{path}/_complete", json.dumps(note))
        hadoop.delete(staged)
        return asked

    def read(
        self,
        df: DataFrame,
        table: str,
        *,
        tenors: Sequence[str] | None = None,
        windows: Sequence[int] = DEFAULT_WINDOWS,
        start: dt.date = DEFAULT_START,
    ) -> DataFrame | None:
        """The kept rows of one rate table, or None if nothing complete is kept."""
        last = last_date(since(df, start), table)
        schema = "date date, Correlation double, observable string, source1 string, source2 string, window_size int"
        parts = []
        for method in ARTEFACT_PREFIX:
            path = self.path(method, table, start, last)
            have = set(self._complete(path)["windows"]).intersection(windows)
            if have:
                rows = self.spark.read.schema(schema).parquet(path).where(F.col("window_size").isin(sorted(have)))
                parts.append(rows.withColumn("corr_type", F.lit(method)))
        if not parts:
            return None
        rows = reduce(DataFrame.unionByName, parts).withColumn("rate_table", F.lit(table))
        return rows if tenors is None else rows.where(F.col("observable").isin(list(tenors)))


# Partitions window_corr by time.
YEAR = "year"
_COLUMNS = ("date", "Correlation", "observable", "source1", "source2", "window_size", "corr_type")


def save_window_corr(
    spark: SparkSession, rows: DataFrame, table: str = WINDOW_CORR_TABLE, strict: bool = False
) -> None:
    """Upsert correlation rows by key, the new ones winning.

    Zero and par curves yield rows with the same seven columns, so ``rate_table`` is
    part of the table and of its key. ``strict`` leaves it out; later rows then
    replace those of the other curve. The table is partitioned by curve, method, window and
    year. Only partitions that the batch has rows of are read, and only those in which a row is
    new or other than before are written, all in one job.
    """
    key = list(WINDOW_CORR_KEY)
    extra = [] if strict else ["rate_table"]
    if strict and "rate_table" in rows.columns:
        rows = deduplicate(
            rows.withColumn("__par", F.col("rate_table") == "par_rates"), key, "last", ["__par"]
        )
    rows = rows.withColumn(YEAR, F.year("date"))
    store = TableStore(spark)
    if not store.exists(table):
        partitions = [*extra, "corr_type", "window_size", YEAR]
        plain = ["date", "Correlation", "observable", "source1", "source2"]
        store.create_table(table, rows.select(*plain, *partitions).schema, partition_by=partitions)
    existing = store.table(table)
    partitions = store.partitioning(table)
    rows = align_to(rows.select(*_COLUMNS, *extra, *({YEAR} & set(existing.columns))), existing.schema)
    # curves x methods x window sizes x years of the batch
    touched = [part.asDict() for part in rows.select(*partitions).distinct().collect()]
    if not touched:
        return
    held = existing.where(any_of(touched))
    changed = [part.asDict() for part in rows.exceptAll(held).select(*partitions).distinct().collect()]
    if changed:
        here = any_of(changed)
        store.replace_partitions(table, upsert(existing.where(here), rows.where(here), key + extra), changed)


def watermarks(spark: SparkSession, table: str = WINDOW_CORR_TABLE) -> DataFrame:
    """rate_table, corr_type, window_size, last: how far each kind of correlation is computed."""
    by = ["rate_table", "corr_type", "window_size"]
    return TableStore(spark).table(table).groupBy(*by).agg(F.max("date").alias("last"))


def new_correlations(
    panel: DataFrame,
    last: dt.date | None,
    tenors: Sequence[str] = DEFAULT_TENORS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    methods: Sequence[str] = tuple(ARTEFACT_PREFIX),
) -> DataFrame:
    """Correlations of the dates after ``last``, from these dates and the ``max(windows) - 1`` before.

    The rows are those of the whole panel, sources without a value since then included.
    """
    if last is None:
        return window_correlations(panel, tenors, windows, methods)
    reach = max(windows) - 1
    days = panel.where(F.col("date") <= F.lit(last)).select("date").distinct().orderBy(F.desc("date")).limit(max(reach, 1))
    first = days.agg(F.min("date")).first()[0] if reach else None
    lately = panel.where(F.col("date") >= F.lit(first) if first else F.col("date") > F.lit(last))
    # a source that has gone quiet still has rows, which are null
    quiet = panel.select("source").distinct().join(lately.select("source").distinct(), "source", "left_anti")
    blank = [F.lit(None).cast("double").alias(t) for t in tenors]
    start = lately.agg(F.min("date").alias("date")).where("date IS NOT NULL")
    filled = lately.select("date", "source", *map(c, tenors)).unionByName(
        quiet.crossJoin(F.broadcast(start)).select("date", "source", *blank)
    )
    return window_correlations(filled, tenors, windows, methods).where(F.col("date") > F.lit(last))


def extend_window_corr(
    spark: SparkSession,
    *,
    tenors: Sequence[str] = DEFAULT_TENORS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    start: dt.date = DEFAULT_START,
    table: str = WINDOW_CORR_TABLE,
) -> dict[str, int]:
    """Bring ``window_corr`` up to the last dates of the rate tables; returns the dates added by table.

    Each curve, method and window goes on from its own last date. New dates are computed from
    the window before them, and written to the partitions of their years. Dates that were
    changed after they had been computed need the whole run.
    """
    frames = rate_tables(spark)
    known = {}
    if TableStore(spark).exists(table):
        known = {(r["rate_table"], r["corr_type"], r["window_size"]): r["last"] for r in watermarks(spark, table).collect()}
    added = {}
    for name in CORRELATED_TABLES:
        panel = since(frames[name], start)
        groups: dict[tuple, list] = {}
        for method in ARTEFACT_PREFIX:
            for window in windows:
                groups.setdefault((method, known.get((name, method, window))), []).append(window)
        days = 0
        for (method, last), sizes in groups.items():
            fresh = panel if last is None else panel.where(F.col("date") > F.lit(last))
            new = fresh.select("date").distinct().count()
            if new:
                rows = new_correlations(panel, last, tenors, sizes, [method])
                save_window_corr(spark, rows.withColumn("rate_table", F.lit(name)), table)
            days = max(days, new)
        added[name] = days
    return added


def window_corr_strict(spark: SparkSession, table: str = WINDOW_CORR_TABLE) -> DataFrame:
    """The seven result columns without ``rate_table``; par rows stand for shared keys."""
    df = TableStore(spark).table(table)
    if "rate_table" not in df.columns:
        return df.select(*_COLUMNS)
    rank = F.when(F.col("rate_table") == "par_rates", 1).otherwise(0)
    best = df.groupBy(*WINDOW_CORR_KEY).agg(
        F.max_by("Correlation", F.struct(rank, F.col("rate_table"))).alias("Correlation")
    )
    return best.select(*_COLUMNS)


def create_correlation_files(
    spark: SparkSession,
    folder: str,
    *,
    tenors: Sequence[str] = DEFAULT_TENORS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    start: dt.date = DEFAULT_START,
    overwrite: bool = True,
) -> list[str]:
    """Correlation artefacts of the zero and par tables; no table is written."""
    frames, artefacts = rate_tables(spark), CorrelationArtefacts(spark, folder)
    paths = []
    for table in CORRELATED_TABLES:
        paths += artefacts.write(
            frames[table], table, tenors=tenors, windows=windows, start=start, overwrite=overwrite
        )
    return paths


def run_rates(
    spark: SparkSession,
    *,
    root: str | None = None,
    folder: str | None = None,
    load_from_files: bool = False,
    create_corr_files: bool = False,
    populate_from_files: bool = False,
    tenors: Sequence[str] = DEFAULT_TENORS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    start: dt.date = DEFAULT_START,
    overwrite: bool = False,
) -> dict[str, object]:
    """The whole rates job; every step is off unless asked for.

    ``load_from_files`` fills the rate tables from ``root``; ``create_corr_files``
    computes missing artefacts in ``folder``; ``populate_from_files`` upserts the
    artefacts into ``window_corr``.
    """
    loaded: dict[str, bool] = {}
    if load_from_files:
        if root is None:
            raise ValueError("root is required to load files")
        loaded = load_rates(spark, root)
    summary: dict[str, object] = {"zero_rates_rows": 0, "directories_loaded": loaded}
    if not create_corr_files and not populate_from_files:
        return summary
    failed = [table for table, done in loaded.items() if not done]
    if failed:
        raise ValueError(f"Directory load did not create tables: {', '.join(failed)}")
    frames = rate_tables(spark)
    if folder is None:
        raise ValueError("folder is required for correlation files")
    artefacts = CorrelationArtefacts(spark, folder)
    if create_corr_files:
        create_correlation_files(
            spark, folder, tenors=tenors, windows=windows, start=start, overwrite=overwrite
        )
    if populate_from_files:
        for table in CORRELATED_TABLES:
            rows = artefacts.read(frames[table], table, tenors=tenors, windows=windows, start=start)
            if rows is None:
                raise LookupError(f"No complete correlation files of {table} in {folder}")
            save_window_corr(spark, rows)
    summary["zero_rates_rows"] = frames["zero_rates"].count()
    return summary
