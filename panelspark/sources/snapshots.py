"""Dated snapshot folders: ``{root}/{source}/{YYYY-MM-DD}/transformed/{dataset}``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import RATE_FOLDERS
from panelspark.names import literal, q, qtable
from panelspark.sources.files import list_data_files
from panelspark.sources.hadoop import exists, list_folders
from panelspark.sources.readers import load_files


def snapshot_friday(date: Column, weeks: int = 0) -> Column:
    """The Friday on or before ``date``, moved by whole weeks (negative = back)."""
    return F.date_add(F.next_day(F.date_sub(date, 7), "FRI"), 7 * weeks)


def last_friday(date: dt.date, weeks: int = 0) -> dt.date:
    """:func:`snapshot_friday` for one date, to name a snapshot folder."""
    return date - dt.timedelta(days=(date.isoweekday() + 2) % 7 - 7 * weeks)


def snapshot_path(root: str, source: str, date: dt.date | str, dataset: str = "") -> str:
    day = date if isinstance(date, str) else date.isoformat()
    return f"{root.rstrip('/')}/{source}/{day}/transformed/{dataset}".rstrip("/")


def read_snapshot(
    spark: SparkSession, root: str, source: str, date: dt.date | str, **options
) -> dict[str, DataFrame]:
    """The rate datasets of one snapshot, keyed by table name, read in place.

    Subfolders are included. Datasets the snapshot does not have are left out.
    ``options`` are those of :func:`panelspark.sources.readers.load_files`.
    """
    found = {}
    for table, folder in RATE_FOLDERS.items():
        path = snapshot_path(root, source, date, folder)
        if exists(path):
            found[table] = load_files(spark, list_data_files(path, recursive=True), **options)
    return found


# Partitions added by one statement.
_AT_ONCE = 200


def register_snapshots(
    spark: SparkSession, table: str, root: str, dataset: str, sources: Sequence[str] | None = None
) -> DataFrame:
    """All dated snapshots of one parquet dataset as a table partitioned by ``source`` and ``date``.

    The table is made over the folders where they lie, so a filter on source or date, or a join
    with a table of dates (dynamic pruning), leaves all other folders unread. Only the names of
    folders come to the driver. Folders that came or went since the last call are added or dropped;
    files in subfolders of a dataset's folder are not part of it.
    """
    found = {}
    for source in list_folders(root) if sources is None else sources:
        for day in list_folders(f"{root.rstrip('/')}/{source}"):
            path = snapshot_path(root, source, day, dataset)
            if _is_day(day) and exists(path):
                found[source, day] = path
    if not found:
        raise FileNotFoundError(f"{root} holds no snapshot of {dataset}")
    if not spark.catalog.tableExists(qtable(table)):
        newest = found[max(found, key=lambda at: at[1])]
        plain = spark.read.parquet(newest).schema
        columns = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in plain if f.name not in ("source", "date"))
        spark.sql(
            f"CREATE TABLE {qtable(table)} ({columns}, source STRING, date DATE) USING parquet "
            f"PARTITIONED BY (source, date) LOCATION {literal(f'{root}/_snapshots-{dataset}')}"
        )
    held = spark.sql(f"SHOW PARTITIONS {qtable(table)}").select("partition").collect()
    known = {tuple(unquote(part.split("=", 1)[1]) for part in row[0].split("/")) for row in held}
    spec = lambda at: f"PARTITION (source = {literal(at[0])}, date = {literal(at[1])})"
    new = [f"{spec(at)} LOCATION {literal(found[at])}" for at in sorted(found.keys() - known)]
    for low in range(0, len(new), _AT_ONCE):
        spark.sql(f"ALTER TABLE {qtable(table)} ADD {' '.join(new[low : low + _AT_ONCE])}")
    for at in sorted(known - found.keys()):
        spark.sql(f"ALTER TABLE {qtable(table)} DROP {spec(at)}")
    return spark.table(qtable(table))


def _is_day(name: str) -> bool:
    try:
        return dt.date.fromisoformat(name).isoformat() == name
    except ValueError:
        return False


def snapshots_of_fridays(snapshots: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the snapshots of the Fridays on or before some days (a column ``day``), read once each."""
    fridays = days.select(snapshot_friday(F.col("day")).alias("date")).distinct()
    # Spark prunes partitions only by a side with a filter; this one is true of every date
    fridays = fridays.where(F.col("date") >= F.lit("0001-01-01").cast("date"))
    return snapshots.join(F.broadcast(fridays), "date", "left_semi")
