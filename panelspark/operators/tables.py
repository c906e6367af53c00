"""Catalog tables: create, append, change, query.

Plain parquet tables know no UPDATE, DELETE or MERGE, so changing operations write the new
content to a folder of its own, a version, and then point the catalog at it:

* a table without partitions by one ``ALTER TABLE ... SET LOCATION``;
* a partitioned one by a table property that names the version, then partition by partition.
  Whoever reads through :class:`TableStore` finishes a switch that was cut off first, so rows
  are those before the property was set, or those after the whole change.

A table is never absent meanwhile. Only where a table is created anew with other columns, its
content goes to ``<table>__staging``, the table is dropped and the staging table renamed;
``TableStore.recover`` finishes that, too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.names import c, check_case_collisions, literal, q, qtable
from panelspark.operators import keyed
from panelspark.sources import hadoop

# Names the version folder that a partitioned table is being switched to.
_PENDING = "panelspark.pending"
# Partitions added by one statement.
_AT_ONCE = 200
# Fixed value: how partition folders name a null.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Storage type names accepted besides Spark's own.
TYPE_ALIASES = {"TEXT": "string", "INTEGER": "bigint", "REAL": "double"}


def type_family(kind: T.DataType) -> str:
    """Types that may be appended to one another."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "integer"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "real"
    return kind.simpleString()


def _fitted(column: Column, given: T.DataType, kind: T.DataType, name: str) -> Column:
    """A cast under which no decimal place is lost without a word (integers raise by themselves)."""
    cast = column.cast(kind)
    if given == kind or not isinstance(kind, T.DecimalType) or isinstance(given, T.IntegralType):
        return cast
    exact = column.cast("string").cast("decimal(38,18)") if isinstance(given, T.FractionalType) else column
    lost = F.raise_error(F.concat(F.lit(f"{name}: "), column.cast("string"), F.lit(f" does not fit into {kind.simpleString()}")))
    return F.when(exact.isNull() | (cast == exact), cast).otherwise(lost.cast(kind))


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` in the columns of ``target``: names without case, missing ones null. A number with
    more decimal places than a decimal column keeps fails when it is written."""
    check_case_collisions(df.columns)
    given = {name.lower(): name for name in df.columns}
    known = {field.name.lower(): field for field in target.fields}
    for lower, name in given.items():
        if lower not in known:
            raise ValueError(f"The table has no column {name!r} to append to, only {target.names}")
        ours, theirs = df.schema[name].dataType, known[lower].dataType
        if type_family(ours) != type_family(theirs):
            raise ValueError(f"{name!r}: {ours.simpleString()} does not fit into {theirs.simpleString()}")
    return df.select(
        *[
            (
                _fitted(c(given[lower]), df.schema[given[lower]].dataType, field.dataType, field.name)
                if lower in given
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for lower, field in known.items()
        ]
    )


def _same(values: Mapping[str, Any]) -> Column:
    return reduce(Column.__and__, [c(name).eqNullSafe(F.lit(value)) for name, value in values.items()])


def any_of(rows: Sequence[Mapping[str, Any]]) -> Column:
    """Rows that agree with one of some sets of values of the same columns.

    Sets that differ in the last column alone are one condition, so that hundreds of partitions
    do not make a plan of thousands of comparisons."""
    *names, last = rows[0]
    groups: dict[tuple, set] = {}
    for row in rows:
        groups.setdefault(tuple(row[name] for name in names), set()).add(row[last])
    conditions = []
    for first, values in groups.items():
        here = c(last).isin(sorted(values - {None}))
        here = here | c(last).isNull() if None in values else here
        conditions.append(_same(dict(zip(names, first))) & here if names else here)
    return reduce(Column.__or__, conditions)


def _spec(folder: str) -> str:
    """``a=1/b=x`` as a PARTITION clause; Spark casts the texts to the columns' types."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    values = [(unquote(name), None if value == _NULL_FOLDER else unquote(value)) for name, value in pairs]
    return ", ".join(f"{q(name)} = {'NULL' if value is None else literal(value)}" for name, value in values)


class TableStore:
    """Tables of the session's catalog, addressed by name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    # -- reading ---------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(qtable(table))

    def table(self, name: str) -> DataFrame:
        """The rows of a table, after a change that was cut off has been finished."""
        self.recover(name)
        return self.spark.table(qtable(name))

    def partitioning(self, table: str) -> list[str]:
        """The columns a table is partitioned by."""
        columns = self.spark.catalog.listColumns(qtable(table))
        return [column.name for column in columns if column.isPartition]

    def require(self, tables: Sequence[str]) -> None:
        """Fail naming *all* missing tables."""
        missing = [name for name in tables if not self.exists(name)]
        if missing:
            raise LookupError(f"Missing tables: {', '.join(missing)}")

    def select(
        self,
        table: str,
        columns: Sequence[str] | None = None,
        where: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        return keyed.select_rows(self.table(table), columns, where)

    def run_query(self, sql: str) -> DataFrame:
        """Result of one read-only query; anything else does not parse as a subquery."""
        return self.spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")

    def execute(self, query: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> DataFrame:
        """One SQL statement with ``?`` (sequence) or ``:name`` (mapping) parameters."""
        args = dict(params) if isinstance(params, Mapping) else list(params)
        return self.spark.sql(query, args=args or None)

    # -- creating --------------------------------------------------------------

    def create_table(
        self,
        table: str,
        schema: T.StructType | Mapping[str, str],
        overwrite: bool = False,
        partition_by: Sequence[str] = (),
    ) -> bool:
        """Create an empty table; False if it exists and may not be replaced."""
        if not self._make_room(table, overwrite):
            return False
        if isinstance(schema, T.StructType):
            schema = {field.name: field.dataType.simpleString() for field in schema.fields}
        check_case_collisions(schema)
        columns = ", ".join(
            f"{q(name)} {TYPE_ALIASES.get(kind.upper(), kind)}" for name, kind in schema.items()
        )
        parts = f" PARTITIONED BY ({', '.join(map(q, partition_by))})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE {qtable(table)} ({columns}) USING parquet{parts}")
        return True

    def create_table_from(
        self,
        table: str,
        df: DataFrame,
        overwrite: bool = False,
        partition_by: Sequence[str] = (),
    ) -> bool:
        """Create a table with the rows of ``df``; an existing one is left alone
        unless ``overwrite``. ``df`` may read the table it replaces."""
        check_case_collisions(df.columns)
        if self.exists(table):
            if not overwrite:
                return False
            self._replace(table, df, partition_by)
        else:
            self._write(table, df, partition_by)
        return True

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {qtable(table)}")

    # -- appending -------------------------------------------------------------

    def append_to_table(
        self, table: str, df: DataFrame, duplicate_check_columns: Sequence[str] | None = None
    ) -> int:
        """Append by column name; returns the number of rows added.

        With ``duplicate_check_columns``, rows whose key is already in the table are
        skipped.
        """
        existing = self.table(table)
        rows = align_to(df, existing.schema)
        if duplicate_check_columns is not None:
            given = {name.lower() for name in df.columns}
            absent = [name for name in duplicate_check_columns if name.lower() not in given]
            if absent:
                raise ValueError(f"Duplicate check columns missing from the new rows: {absent}")
            rows = keyed.rows_with_new_keys(rows, existing, duplicate_check_columns)
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(qtable(table))
        return seen.get["rows"]

    def insert(self, table: str, data: Mapping[str, Any] | Sequence[Mapping[str, Any]]) -> int:
        """Insert literal rows; the columns are those of the first row."""
        rows = [data] if isinstance(data, Mapping) else list(data)
        if not rows:
            return 0
        known = {field.name.lower(): field for field in self.table(table).schema.fields}
        unknown = [name for name in rows[0] if name.lower() not in known]
        if unknown:
            raise ValueError(f"Columns {unknown} do not exist in table {table!r}")
        late = sorted({name for row in rows for name in row} - rows[0].keys())
        if late:
            raise ValueError(f"Later rows have columns that the first one lacks: {late}")
        schema = T.StructType([T.StructField(n, known[n.lower()].dataType) for n in rows[0]])
        values = [tuple(row.get(name) for name in rows[0]) for row in rows]
        return self.append_to_table(table, self.spark.createDataFrame(values, schema))

    # -- changing --------------------------------------------------------------

    def update(self, table: str, data: Mapping[str, Any], where: Mapping[str, Any]) -> int:
        """Set columns of matching rows; returns how many matched.

        Of a partitioned table only the partitions that hold matches are written anew, unless
        a partition column itself is set."""
        moves = {name.lower() for name in data} & {name.lower() for name in self.partitioning(table)}
        return self._change(table, lambda df: keyed.update_rows(df, data, where), where, bool(moves))

    def delete(self, table: str, where: Mapping[str, Any]) -> int:
        """Remove matching rows; returns how many. Partitions as in :meth:`update`."""
        return self._change(table, lambda df: keyed.delete_rows(df, where), where, False)

    def remove_duplicates(
        self,
        table: str,
        columns: Sequence[str] | None = None,
        keep: str = "first",
        order_by: Sequence[str] = (),
    ) -> int:
        """Keep one row per key; returns the number of rows removed."""
        self.require([table])
        before = self.table(table)
        unique = keyed.deduplicate(before, columns, keep, order_by)
        return before.count() - self._switch(table, unique)

    def upsert(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
    ) -> int:
        """Add rows, replacing those with the same key; returns the table's new size."""
        before = self.table(table)
        return self._switch(table, keyed.upsert(before, align_to(df, before.schema), keys, order_by))

    def recover(self, table: str) -> bool:
        """Finish a change that was cut off; True if there was one."""
        if self.exists(table):
            shown = self.spark.sql(f"SHOW TBLPROPERTIES {qtable(table)}").collect()
            version = {row[0]: row[1] for row in shown}.get(_PENDING)
            if version is not None:
                self._finish(table, version)
            return version is not None
        if not self.exists(f"{table}__staging"):
            return False
        self._rename(f"{table}__staging", table)
        return True

    # -- helpers ---------------------------------------------------------------

    def _change(self, table: str, change, where: Mapping[str, Any], everywhere: bool) -> int:
        before, parts = self.table(table), self.partitioning(table)
        hits = before.where(keyed.matches(where))
        if everywhere or not parts:
            found = hits.count()
            if found:
                self._switch(table, change(before))
            return found
        # one row per partition that holds a match
        touched = hits.groupBy(*map(c, parts)).count().collect()
        if touched:
            values = [{name: row[name] for name in parts} for row in touched]
            self.replace_partitions(table, change(before.where(any_of(values))), values)
        return sum(row["count"] for row in touched)

    def replace_partitions(self, table: str, rows: DataFrame, touched: Sequence[Mapping[str, Any]]) -> int:
        """Make ``rows`` the content of some partitions, in one job; returns how many there are.

        Partitions of which no row is left are dropped, all others stay as they are."""
        names = self.partitioning(table)
        types = self.table(table).select(*map(c, names)).schema
        given = self.spark.createDataFrame([tuple(row[n] for n in names) for row in touched], types)
        return self._switch(table, rows, [r[0] for r in given.select(self._folder_of(names)).collect()])

    @staticmethod
    def _folder_of(names: Sequence[str]) -> Column:
        """The folder of a row's partition, as far as it tells partitions apart."""
        texts = [F.concat(F.lit(f"{n}="), F.coalesce(c(n).cast("string"), F.lit(_NULL_FOLDER))) for n in names]
        return F.concat_ws("/", *texts)

    def _make_room(self, table: str, overwrite: bool) -> bool:
        if self.exists(table):
            if not overwrite:
                return False
            self.drop(table)
        return True

    def _write(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> int:
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(qtable(table))
        return seen.get["rows"]

    def _replace(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> int:
        """New content, columns and partitions for a table; returns the rows written."""
        before, parts = self.table(table), list(partition_by)
        plain = [name for name in df.columns if name not in parts]
        same = [(n, df.schema[n].dataType) for n in [*plain, *parts]] == [(f.name, f.dataType) for f in before.schema]
        if same and parts == self.partitioning(table):
            return self._switch(table, df)
        staging = f"{table}__staging"
        self.drop(staging)
        rows = self._write(staging, df, partition_by)
        self.drop(table)
        self._rename(staging, table)
        return rows

    def _detail(self, table: str, partition: str = "") -> dict[str, str]:
        described = self.spark.sql(f"DESCRIBE EXTENDED {qtable(table)} {partition}").collect()
        what = "# Detailed Partition" if partition else "# Detailed Table"
        at = max(i for i, row in enumerate(described) if row[0].startswith(what))
        # sections on the storage follow; of a name that comes twice the first counts
        return {row[0]: row[1] for row in reversed(described[at:])}

    def _switch(self, table: str, df: DataFrame, touched: Sequence[str] | None = None) -> int:
        """Write a version of a table, or of the partitions ``touched``, and make it the content."""
        detail, parts = self._detail(table), self.partitioning(table)
        root = detail["Location"].rstrip("/")
        version = f"{root}/_v-{uuid.uuid4().hex}" if parts else f"{root.split('__v-')[0]}__v-{uuid.uuid4().hex}"
        df = df.select(*map(c, self.spark.table(qtable(table)).columns))
        # rows of a partition come together, split where it is large: few files, whatever the number of tasks
        writer = (df.hint("rebalance", *map(c, parts)) if parts else df).write
        (writer.partitionBy(*parts) if parts else writer).parquet(version)
        rows = self.spark.read.schema(df.schema).parquet(version).count()  # from the footers
        if not parts:
            self.spark.sql(f"ALTER TABLE {qtable(table)} SET LOCATION {literal(version)}")
            if detail.get("Type") == "MANAGED":
                hadoop.delete(root)
            return rows
        made = self._folders(version)
        held = {unquote(row[0]): row[0] for row in self.spark.sql(f"SHOW PARTITIONS {qtable(table)}").collect()}
        replaced = held if touched is None else {name: held[name] for name in touched if name in held}
        old = {folder: self._detail(table, f"PARTITION ({_spec(folder)})")["Location"] for folder in replaced.values()}
        hadoop.write_text(f"{version}/_switch", json.dumps({"made": made, "old": old}))
        self.spark.sql(f"ALTER TABLE {qtable(table)} SET TBLPROPERTIES ({literal(_PENDING)} = {literal(version)})")
        self._finish(table, version)
        return rows

    def _folders(self, version: str) -> list[str]:
        """The partition folders of a version."""
        start = hadoop.qualified(version).removeprefix("file:").rstrip("/")
        paths = (path.removeprefix("file:").replace("//", "/") for path in hadoop.list_files(version, True))
        found = (path.removeprefix(start).strip("/").rpartition("/")[0] for path in paths)
        return sorted({folder for folder in found if folder})

    def _finish(self, table: str, version: str) -> None:
        """Point partitions at a version. Can be cut off and done again at any step."""
        note = json.loads(hadoop.read_text(f"{version}/_switch"))
        held = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {qtable(table)}").collect()}
        place = {folder: f"LOCATION {literal(f'{version}/{folder}')}" for folder in note["made"]}
        for folder in place.keys() & held:
            self.spark.sql(f"ALTER TABLE {qtable(table)} PARTITION ({_spec(folder)}) SET {place[folder]}")
        new = [f"PARTITION ({_spec(folder)}) {place[folder]}" for folder in place.keys() - held]
        for low in range(0, len(new), _AT_ONCE):
            self.spark.sql(f"ALTER TABLE {qtable(table)} ADD {' '.join(new[low : low + _AT_ONCE])}")
        for folder in note["old"].keys() & held - set(note["made"]):
            self.spark.sql(f"ALTER TABLE {qtable(table)} DROP IF EXISTS PARTITION ({_spec(folder)})")
        for folder, location in note["old"].items():
            if location.rstrip("/").endswith("=" + folder.rpartition("=")[2]):  # a partition's own folder
                hadoop.delete(location)
        self.spark.sql(f"ALTER TABLE {qtable(table)} UNSET TBLPROPERTIES IF EXISTS ({literal(_PENDING)})")

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {qtable(old)} RENAME TO {qtable(new)}")
        if self.partitioning(new):
            # some catalogs leave partitions registered at the folder of the old name
            self.spark.sql(f"MSCK REPAIR TABLE {qtable(new)} SYNC PARTITIONS")
