"""Registered queries over the driver's tables, each beside the SQL it must equal.

``QUERIES`` maps a name to ``f(spark, sf_dir) -> DataFrame`` and ``SQL`` the same
name to a DuckDB statement. All of them read whole tables.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.names import PATH_COL
from panelspark.operators import keyed
from panelspark.operators.concat import strict_concat
from panelspark.operators.correlation import DCORR, PEARSON, correlation_matrix, window_correlations
from panelspark.operators.coverage import coverage as coverage_report
from panelspark.operators.steps import build_transforms
from panelspark.operators.tables import TableStore, align_to
from panelspark.operators.transforms import (
    CastDate,
    CastNumericStrings,
    FilenamePart,
    FileSource,
    LitColumn,
    MapColumn,
    Melt,
    PrefixedMelt,
    RenameTenors,
    SourceFromFilename,
    apply_transforms,
)
from panelspark.config import RATE_FOLDERS
from panelspark.plans.ingest import (
    load_directories_into_tables,
    load_equity_eod,
    load_files_into_tables,
    load_world_bank,
)
from panelspark.plans.rates import CorrelationArtefacts, extend_window_corr, run_rates, since
from panelspark.session import scratch_dir
from panelspark.sources import hadoop
from panelspark.sources.files import list_data_files, opened
from panelspark.sources.preview import preview_file, preview_frame
from panelspark.sources.readers import load_directory
from panelspark.sources.snapshots import (
    last_friday,
    read_snapshot,
    register_snapshots,
    snapshot_friday,
    snapshot_path,
    snapshots_of_fridays,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


class Workspace:
    """Folders, tables and databases of one query, gone once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self._folders, self._tables, self._databases = spark, [], [], []

    def folder(self, label: str) -> str:
        self._folders.append(scratch_dir(self.spark, label))
        return self._folders[-1]

    def table(self, label: str) -> str:
        self._tables.append(f"panelspark_{label}_{uuid.uuid4().hex}")
        return self._tables[-1]

    @contextlib.contextmanager
    def database(self, label: str):
        """A database of its own, current inside the block, as jobs use fixed table names."""
        name, outer = f"panelspark_{label}_{uuid.uuid4().hex}", self.spark.catalog.currentDatabase()
        self.spark.sql(f"CREATE DATABASE {name}")
        self._databases.append(name)
        self.spark.catalog.setCurrentDatabase(name)
        try:
            yield name
        finally:
            self.spark.catalog.setCurrentDatabase(outer)

    def result(self, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, "result")
        df.write.parquet(path)
        for name in self._databases:
            self.spark.sql(f"DROP DATABASE {name} CASCADE")
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        for folder in self._folders:
            hadoop.delete(folder)
        return self.spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rounded(df: DataFrame, name: str = "Correlation") -> DataFrame:
    """Four decimals and no negative zero.

    Counts give exact ties such as 0.09375; the shift decides them alike everywhere.
    """
    return df.withColumn(name, F.round(F.col(name) + F.lit(1e-9), 4) + F.lit(0.0))


# -- rolling correlation -------------------------------------------------------

ORDERS_PANEL = """
o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS source,
        sum(o_totalprice) AS price, CAST(count(*) AS DOUBLE) AS n
      FROM orders GROUP BY 1, 2)"""


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value and number of orders by priority."""
    return (
        read(spark, sf_dir, "orders")
        .groupBy(
            F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("source")
        )
        .agg(F.sum("o_totalprice").alias("price"), F.count(F.lit(1)).cast("double").alias("n"))
    )


def _grid_sql(observable: str) -> str:
    """Calendar x source pairs with both values, null unless both report."""
    return f"""
cal AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM o)),
s AS (SELECT DISTINCT source FROM o),
g AS (SELECT cal.date, cal.i, a.source AS source1, b.source AS source2,
        CASE WHEN y.{observable} IS NOT NULL THEN x.{observable} END AS x,
        CASE WHEN x.{observable} IS NOT NULL THEN y.{observable} END AS y
      FROM cal CROSS JOIN s a JOIN s b ON a.source < b.source
      LEFT JOIN o x ON x.date = cal.date AND x.source = a.source
      LEFT JOIN o y ON y.date = cal.date AND y.source = b.source)"""


def pearson_sql(panel: str, observable: str, windows) -> str:
    parts = [
        f"""
SELECT date, source1, source2, '{observable}' AS observable, {w} AS window_size,
  'pearson' AS corr_type,
  CASE WHEN count(x) OVER w >= {w // 3} AND NOT isnan(corr(x, y) OVER w)
       THEN round(corr(x, y) OVER w + 1e-9, 4) + 0.0 END AS "Correlation"
FROM g WINDOW w AS (PARTITION BY source1, source2 ORDER BY i
                    ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"""
        for w in windows
    ]
    return f"WITH {panel}, {_grid_sql(observable)} " + " UNION ALL ".join(parts)


def dcorr_sql(panel: str, observable: str, w: int) -> str:
    """Distance correlation from the distances of all date pairs less than ``w`` apart."""
    return f"""
WITH {panel}, {_grid_sql(observable)},
v AS (SELECT source1, source2, i, x, y FROM g WHERE x IS NOT NULL),
k AS (SELECT unnest(range(1, {w})) AS k),
d AS (SELECT a.source1, a.source2, a.i AS hi, b.i AS lo, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy
      FROM v a CROSS JOIN k
      JOIN v b ON b.source1 = a.source1 AND b.source2 = a.source2 AND b.i = a.i - k.k),
e AS (SELECT i AS t, date, source1, source2 FROM g WHERE i >= {w}),
c AS (SELECT source1, source2, t, count(*) AS n
      FROM (SELECT source1, source2, unnest(range(i, i + {w})) AS t FROM v) GROUP BY ALL),
m AS (SELECT source1, source2, hi, lo, dx, dy, unnest(range(hi, lo + {w})) AS t FROM d),
q AS (SELECT source1, source2, t, 2 * sum(dx * dy) AS ab, 2 * sum(dx * dx) AS aa,
        2 * sum(dy * dy) AS bb, 2 * sum(dx) AS a, 2 * sum(dy) AS b FROM m GROUP BY ALL),
r AS (SELECT source1, source2, t, p, sum(dx) AS rx, sum(dy) AS ry FROM (
        SELECT source1, source2, t, hi AS p, dx, dy FROM m
        UNION ALL SELECT source1, source2, t, lo AS p, dx, dy FROM m) GROUP BY ALL),
h AS (SELECT source1, source2, t, sum(rx * ry) AS xy, sum(rx * rx) AS xx, sum(ry * ry) AS yy
      FROM r GROUP BY ALL),
z AS (SELECT source1, source2, t,
        ab / n ** 2 + a * b / n ** 4 - 2 * xy / n ** 3 AS cv,
        aa / n ** 2 + a * a / n ** 4 - 2 * xx / n ** 3 AS vx,
        bb / n ** 2 + b * b / n ** 4 - 2 * yy / n ** 3 AS vy
      FROM q JOIN h USING (source1, source2, t) JOIN c USING (source1, source2, t))
SELECT e.date, e.source1, e.source2, '{observable}' AS observable, {w} AS window_size,
  'dcorr' AS corr_type,
  CASE WHEN c.n IS NULL THEN NULL WHEN z.vx > 0 AND z.vy > 0
    THEN round(sqrt(greatest(cv, 0) / sqrt(vx * vy)) + 1e-9, 4) + 0.0 ELSE 0.0 END AS "Correlation"
FROM e LEFT JOIN c USING (source1, source2, t) LEFT JOIN z USING (source1, source2, t)"""


def long_dcorr_sql(panel: str, observable: str, w: int) -> str:
    """As :func:`dcorr_sql` with running sums: what a date adds when it comes and takes when it goes."""
    return f"""
WITH {panel}, {_grid_sql(observable)},
v AS (SELECT source1, source2, i, x, y FROM g WHERE x IS NOT NULL),
d AS (SELECT a.source1, a.source2, a.i AS hi, b.i AS lo, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy
      FROM v a JOIN v b ON b.source1 = a.source1 AND b.source2 = a.source2 AND b.i < a.i AND b.i > a.i - {w}),
ab AS (SELECT source1, source2, t, sum(ab) OVER o AS ab, sum(aa) OVER o AS aa, sum(bb) OVER o AS bb, sum(n) OVER o AS n
      FROM (SELECT source1, source2, t, sum(ab) AS ab, sum(aa) AS aa, sum(bb) AS bb, sum(n) AS n FROM (
              SELECT source1, source2, hi AS t, 2 * sum(dx * dy) AS ab, 2 * sum(dx * dx) AS aa, 2 * sum(dy * dy) AS bb, 0 AS n
              FROM d GROUP BY ALL UNION ALL
              SELECT source1, source2, lo + {w}, -2 * sum(dx * dy), -2 * sum(dx * dx), -2 * sum(dy * dy), 0 FROM d GROUP BY ALL
              UNION ALL SELECT source1, source2, i, 0, 0, 0, 1 FROM v
              UNION ALL SELECT source1, source2, i + {w}, 0, 0, 0, -1 FROM v
              UNION ALL SELECT source1, source2, i, 0, 0, 0, 0 FROM g) GROUP BY ALL)
      WINDOW o AS (PARTITION BY source1, source2 ORDER BY t ROWS UNBOUNDED PRECEDING)),
r AS (SELECT source1, source2, p, t, sum(dx) OVER o AS rx, sum(dy) OVER o AS ry
      FROM (SELECT source1, source2, p, t, sum(dx) AS dx, sum(dy) AS dy FROM (
              SELECT source1, source2, hi AS p, hi AS t, sum(dx) AS dx, sum(dy) AS dy FROM d GROUP BY ALL UNION ALL
              SELECT source1, source2, lo, hi, dx, dy FROM d UNION ALL
              SELECT source1, source2, hi, lo + {w}, -dx, -dy FROM d UNION ALL
              SELECT source1, source2, i, unnest(range(i, i + {w})), 0, 0 FROM v) GROUP BY ALL)
      WINDOW o AS (PARTITION BY source1, source2, p ORDER BY t ROWS UNBOUNDED PRECEDING)),
h AS (SELECT source1, source2, t, sum(rx) AS a, sum(ry) AS b, sum(rx * ry) AS xy, sum(rx * rx) AS xx, sum(ry * ry) AS yy
      FROM r GROUP BY ALL),
z AS (SELECT source1, source2, t, n,
        ab / n ** 2 + a * b / n ** 4 - 2 * xy / n ** 3 AS cv,
        aa / n ** 2 + a * a / n ** 4 - 2 * xx / n ** 3 AS vx,
        bb / n ** 2 + b * b / n ** 4 - 2 * yy / n ** 3 AS vy
      FROM ab JOIN h USING (source1, source2, t))
SELECT g.date, g.source1, g.source2, '{observable}' AS observable, {w} AS window_size, 'dcorr' AS corr_type,
  CASE WHEN z.n IS NULL OR z.n = 0 THEN NULL WHEN z.vx > 0 AND z.vy > 0
    THEN round(sqrt(greatest(cv, 0) / sqrt(vx * vy)) + 1e-9, 4) + 0.0 ELSE 0.0 END AS "Correlation"
FROM g LEFT JOIN z ON z.source1 = g.source1 AND z.source2 = g.source2 AND z.t = g.i WHERE g.i >= {w}"""


@query(pearson_sql(ORDERS_PANEL, "price", [20]))
def rolling_pearson(spark, sf_dir):
    return rounded(window_correlations(orders_panel(spark, sf_dir), ["price"], [20], [PEARSON]))


@query(dcorr_sql(ORDERS_PANEL, "price", 20))
def rolling_dcorr(spark, sf_dir):
    return rounded(window_correlations(orders_panel(spark, sf_dir), ["price"], [20], [DCORR]))


@query(long_dcorr_sql(ORDERS_PANEL, "price", 520))
def dcorr_long_window(spark, sf_dir):
    """Windows of two years of trading days, for which no table of distances is kept."""
    return rounded(window_correlations(orders_panel(spark, sf_dir), ["price"], [520], [DCORR]))


@query(
    pearson_sql(ORDERS_PANEL, "price", [20, 40, 60, 90])
    + " UNION ALL SELECT * FROM ("
    + pearson_sql(ORDERS_PANEL, "n", [20, 40, 60, 90])
    + ")"
)
def window_corr_grid(spark, sf_dir):
    """All default windows of two observables."""
    panel = orders_panel(spark, sf_dir)
    return rounded(window_correlations(panel, ["price", "n"], methods=[PEARSON]))


@query(
    " UNION ALL ".join(
        f"SELECT * FROM ({part})"
        for observable in ("price", "n")
        for part in [
            pearson_sql(ORDERS_PANEL, observable, [20, 40, 60, 90]),
            *[dcorr_sql(ORDERS_PANEL, observable, w) for w in (20, 40, 60, 90)],
        ]
    )
)
def window_corr_full(spark, sf_dir):
    """Every default window and method."""
    return rounded(window_correlations(orders_panel(spark, sf_dir), ["price", "n"]))


@query(
    "SELECT date, source1, source2, observable, \"Correlation\" FROM ("
    + dcorr_sql(ORDERS_PANEL, "n", 30)
    + ")"
)
def corr_matrix_dcorr(spark, sf_dir):
    return rounded(correlation_matrix(orders_panel(spark, sf_dir), 30, ["n"]))


@query(
    f"""{pearson_sql(ORDERS_PANEL, "price", [20, 40])}
UNION ALL SELECT * FROM ({dcorr_sql(ORDERS_PANEL, "price", 20)})
UNION ALL SELECT * FROM ({dcorr_sql(ORDERS_PANEL, "price", 40)})"""
)
def window_corr_both_methods(spark, sf_dir):
    """Both methods and two windows out of one pass over the blocks."""
    return rounded(window_correlations(orders_panel(spark, sf_dir), ["price"], [20, 40]))


NATIONS_PANEL = """
o AS (SELECT CAST(o_orderdate AS DATE) AS date, n_name AS source, sum(o_totalprice) AS price
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


@query(pearson_sql(NATIONS_PANEL, "price", [60]))
def nations_pearson(spark, sf_dir):
    """300 pairs: daily order value by customer nation."""
    panel = (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.to_date("o_orderdate").alias("date"), F.col("n_name").alias("source"))
        .agg(F.sum("o_totalprice").alias("price"))
    )
    return rounded(window_correlations(panel, ["price"], [60], [PEARSON]))


SEGMENTS_PANEL = """
o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, n_name || c_mktsegment AS source,
        sum(o_totalprice) AS price
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


@query(pearson_sql(SEGMENTS_PANEL, "price", [12]))
def segments_pearson(spark, sf_dir):
    """7,750 pairs in several tiles: monthly order value by customer nation and segment."""
    panel = (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.trunc("o_orderdate", "month").alias("date"), F.concat("n_name", "c_mktsegment").alias("source")
        )
        .agg(F.sum("o_totalprice").alias("price"))
    )
    return rounded(window_correlations(panel, ["price"], [12], [PEARSON]))


@query(
    f"""
WITH zero AS ({pearson_sql(ORDERS_PANEL, "price", [20])}),
par AS ({pearson_sql(ORDERS_PANEL.replace("sum(o_totalprice)", "max(o_totalprice)"), "price", [20])})
SELECT * FROM par UNION ALL
SELECT * FROM zero WHERE NOT EXISTS (
  SELECT 1 FROM par WHERE par.date = zero.date AND par.source1 = zero.source1
    AND par.source2 = zero.source2)"""
)
def window_corr_upsert(spark, sf_dir):
    """Two batches of correlations on one key; the later batch wins."""
    orders = read(spark, sf_dir, "orders")
    batches = [
        window_correlations(
            orders.groupBy(
                F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("source")
            ).agg(F.expr(f"{pick}(o_totalprice)").alias("price")),
            ["price"], [20], [PEARSON],
        )
        for pick in ("sum", "max")
    ]
    key = ["date", "observable", "source1", "source2", "window_size", "corr_type"]
    return rounded(keyed.upsert(batches[0], batches[1], key))


@query(
    f"""{pearson_sql(ORDERS_PANEL, "price", [20])}
UNION ALL SELECT * FROM ({dcorr_sql(ORDERS_PANEL, "price", 20)})"""
)
def correlation_artefacts(spark, sf_dir):
    """Correlations written once and read back from their artefacts."""
    panel = orders_panel(spark, sf_dir)
    start = dt.date(1990, 1, 1)
    work = Workspace(spark)
    artefacts = CorrelationArtefacts(spark, work.folder("corr"))
    artefacts.write(panel, "zero_rates", tenors=["price"], windows=[20], start=start)
    rows = artefacts.read(panel, "zero_rates", windows=[20], start=start)
    return work.result(rounded(rows.drop("rate_table")))


@query(
    f"""{pearson_sql(ORDERS_PANEL, "price", [20])}
UNION ALL SELECT * FROM ({pearson_sql(ORDERS_PANEL, "n", [20])})"""
)
def artefact_tenors(spark, sf_dir):
    """Artefacts asked for one observable, then for two: the second call adds to the first."""
    panel, start, work = orders_panel(spark, sf_dir), dt.date(1990, 1, 1), Workspace(spark)
    artefacts = CorrelationArtefacts(spark, work.folder("corr"))
    for tenors in (["price"], ["price", "n"]):
        artefacts.write(panel, "zero_rates", tenors=tenors, windows=[20], start=start)
    rows = artefacts.read(panel, "zero_rates", windows=[20], start=start)
    return work.result(rounded(rows.where("corr_type = 'pearson'").drop("rate_table")))


MAX_PANEL = ORDERS_PANEL.replace("sum(o_totalprice)", "max(o_totalprice)")


def _curve_sql(panel: str, table: str) -> str:
    return f"""
SELECT *, '{table}' AS rate_table FROM ({pearson_sql(panel, "price", [20])}) UNION ALL
SELECT *, '{table}' AS rate_table FROM ({dcorr_sql(panel, "price", 20)})"""


@query(
    f"""
SELECT date, "Correlation", 'Y001p0' AS observable, source1, source2, window_size, corr_type,
  rate_table
FROM ({_curve_sql(ORDERS_PANEL, "zero_rates")} UNION ALL {_curve_sql(MAX_PANEL, "par_rates")})"""
)
def rates_job(spark, sf_dir):
    """The rates job over its tables: artefacts, then the window_corr table, twice."""
    orders = read(spark, sf_dir, "orders")
    store, work = TableStore(spark), Workspace(spark)
    with work.database("job") as database:
        for table, pick in (("zero_rates", "sum"), ("par_rates", "max"), ("spotfx", "min")):
            curve = orders.groupBy(
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.col("o_orderpriority").alias("source"),
            ).agg(F.expr(f"{pick}(o_totalprice)").alias("Y001p0"))
            store.create_table_from(table, curve)
        folder = work.folder("rates-job")
        for _ in range(2):  # the second run reuses the artefacts and changes nothing
            run_rates(
                spark, folder=folder, create_corr_files=True, populate_from_files=True,
                tenors=["Y001p0"], windows=[20], start=dt.date(1990, 1, 1),
            )
    return work.result(rounded(spark.table(f"{database}.window_corr").drop("year")))


@query(
    f"""
SELECT date, "Correlation", 'Y001p0' AS observable, source1, source2, window_size, corr_type,
  rate_table
FROM ({_curve_sql(ORDERS_PANEL, "zero_rates")} UNION ALL {_curve_sql(MAX_PANEL, "par_rates")})"""
)
def rates_extended(spark, sf_dir):
    """Correlations of the first dates, brought up to date twice as the rate tables grow."""
    orders = read(spark, sf_dir, "orders")
    store, work = TableStore(spark), Workspace(spark)
    days = orders.agg(F.expr("percentile_approx(o_orderdate, array(0.9, 0.99))")).first()[0]
    with work.database("extend") as database:
        for low, high in zip([None, *days], [*days, None]):
            for table, pick in (("zero_rates", "sum"), ("par_rates", "max"), ("spotfx", "min")):
                curve = orders.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("source"))
                curve = curve.agg(F.expr(f"{pick}(o_totalprice)").alias("Y001p0"))
                if low is not None:
                    curve = curve.where(F.col("date") > F.to_date(F.lit(low)))
                if high is not None:
                    curve = curve.where(F.col("date") <= F.to_date(F.lit(high)))
                if not store.create_table_from(table, curve):
                    store.append_to_table(table, curve)
            extend_window_corr(spark, tenors=["Y001p0"], windows=[20], start=dt.date(1990, 1, 1))
    return work.result(rounded(spark.table(f"{database}.window_corr").drop("year")))


@query(
    """
SELECT CAST(o_orderdate AS DATE) AS date, 'part' AS source, sum(o_totalprice) AS "Y000p5",
  CAST(count(*) AS DOUBLE) AS "Y010p0" FROM orders GROUP BY 1"""
)
def curve_load(spark, sf_dir):
    """Curve files as they arrive, one folder per table, loaded by the rates job."""
    work = Workspace(spark)
    root = work.folder("curves")
    curve = read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    curve = curve.agg(F.sum("o_totalprice").alias("0.5"), F.count(F.lit(1)).cast("double").alias("10"))
    for folder in RATE_FOLDERS.values():
        curve.write.parquet(f"{root}/{folder}")
    with work.database("curves") as database:
        run_rates(spark, root=root, load_from_files=True)
        zero = spark.table(f"{database}.zero_rates")
        return work.result(zero.withColumn("source", F.regexp_extract("source", "^[a-z]+", 0)))


@query(
    """
SELECT source, strftime(max(date), '%Y%m%d') AS last_date, count(*) AS days FROM (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS source FROM orders)
WHERE date >= DATE '1998-01-01' GROUP BY source"""
)
def date_floor(spark, sf_dir):
    """Panel dates from a start date on, and the last of them by source."""
    panel = since(orders_panel(spark, sf_dir), dt.date(1998, 1, 1))
    return panel.groupBy("source").agg(
        F.date_format(F.max("date"), "yyyyMMdd").alias("last_date"),
        F.count(F.lit(1)).alias("days"),
    )


@query(
    """
WITH u AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS source, 'orders' AS type FROM orders
  UNION ALL SELECT CAST(l_shipdate AS DATE), l_returnflag, 'lineitem' FROM lineitem
  UNION ALL SELECT CAST(ts AS DATE), CASE event_type WHEN 'view' THEN 'fx' ELSE event_type END,
    'events' FROM events)
SELECT min(date) AS start_date, max(date) AS end_date, source, type,
  CAST(date_diff('day', min(date), max(date)) AS INTEGER) AS coverage_days
FROM u GROUP BY source, type"""
)
def coverage(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    renamed = F.when(F.col("event_type") == "view", "spot_fx_rates").otherwise(F.col("event_type"))
    return coverage_report(
        {
            "orders": read(spark, sf_dir, "orders").selectExpr(
                "o_orderdate AS date", "o_orderpriority AS source"
            ),
            "lineitem": read(spark, sf_dir, "lineitem").selectExpr(
                "l_shipdate AS date", "l_returnflag AS source"
            ),
            "events": events.select(F.col("ts").alias("date"), renamed.alias("source")),
        }
    )


# -- transforms ----------------------------------------------------------------


@query(
    """
SELECT l_orderkey, l_linenumber, variable, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)"""
)
def melt(spark, sf_dir):
    wide = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return Melt(["l_orderkey", "l_linenumber"]).apply(wide)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day, columns such as ``click.n`` and ``click.value``."""
    kind = F.col("event_type")
    columns = []
    for name in EVENT_TYPES:
        columns += [
            F.count(F.when(kind == name, 1)).alias(f"{name}.n"),
            F.round(F.sum(F.when(kind == name, F.col("value"))), 2).alias(f"{name}.value"),
        ]
    return read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("Index")).agg(*columns)


DAILY_LONG = """
SELECT d AS "Index", t AS "Stock", count(value) AS n, round(sum(value), 2) AS value
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
CROSS JOIN (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS t)
LEFT JOIN events ON CAST(ts AS DATE) = d AND event_type = t GROUP BY d, t"""


@query(DAILY_LONG)
def prefixed_melt(spark, sf_dir):
    return PrefixedMelt(".", "Stock", exclude=["Index"]).apply(daily_wide(spark, sf_dir))


@query(
    """
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 10.0::DOUBLE AS price,
  TRY_CAST(o_orderpriority AS DOUBLE) AS priority, o_orderstatus FROM orders"""
)
def cast_numeric(spark, sf_dir):
    texts = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.floor("o_totalprice").cast("string"), F.lit("e+01")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderstatus",
    )
    return CastNumericStrings(exclude=["o_orderstatus"]).apply(texts)


@query(
    """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F'
    THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS text FROM orders)
SELECT o_orderkey, CAST(try_strptime(text, '%Y-%m-%d %H:%M:%S') AS DATE) AS stamped,
  CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS plain FROM t"""
)
def cast_date(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    short = F.date_format("o_orderdate", "yyyy-MM-dd")
    full = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("o_orderstatus") == "F", short).otherwise(full)
    df = orders.select("o_orderkey", text.alias("stamped"), text.alias("plain"))
    return apply_transforms(df, [CastDate("stamped", "YYYY-mm-dd HH:MM:SS"), CastDate("plain")])


@query(
    """
WITH t AS (SELECT o_orderkey, o_orderdate AS d, CASE WHEN o_orderkey % 2 = 0 THEN '-02:00' ELSE '+05:30' END AS z
           FROM orders)
SELECT o_orderkey, CAST(try_strptime(strftime(d, '%d/%m/%y'), '%d/%m/%y') AS DATE) AS short,
  CAST(try_strptime(strftime(d, '%m/%d/%y'), '%m/%d/%y') AS DATE) AS american,
  CAST(try_strptime(strftime(d, '%Y-%m-%d %H:%M:%S.%f'), '%Y-%m-%d %H:%M:%S.%f') AS DATE) AS fraction,
  CAST(timezone('UTC', try_strptime(strftime(d, '%Y-%m-%dT%H:%M:%S') || z, '%Y-%m-%dT%H:%M:%S%z')) AS DATE) AS shifted,
  CAST(try_strptime(strftime(d, '%a %d %b %Y'), '%a %d %b %Y') AS DATE) AS weekday FROM t"""
)
def cast_date_formats(spark, sf_dir):
    """Two-digit years, fractions of seconds, offsets and names of weekdays."""
    day = F.col("o_orderdate")
    offset = F.when(F.col("o_orderkey") % 2 == 0, "-02:00").otherwise("+05:30")
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(day, "dd/MM/yy").alias("short"),
        F.date_format(day, "MM/dd/yy").alias("american"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fraction"),
        F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("shifted"),
        F.date_format(day, "EEE dd MMM yyyy").alias("weekday"),
    )
    formats = {"short": "%d/%m/%y", "american": "%D", "fraction": "%Y-%m-%d %H:%M:%S.%f",
               "shifted": "%Y-%m-%dT%H:%M:%S%z", "weekday": "%a %d %b %Y"}
    return apply_transforms(df, [CastDate(name, form) for name, form in formats.items()])


@query(
    """
WITH t AS (SELECT o_orderkey, o_orderdate AS d FROM orders)
SELECT o_orderkey, CAST(d AS DATE) AS seconds,
  CAST(try_strptime(strftime(d, '%G-W%V-%u'), '%G-W%V-%u') AS DATE) AS iso_week,
  CAST(try_strptime(strftime(d, '%Y %W %w'), '%Y %W %w') AS DATE) AS week FROM t"""
)
def cast_date_counted(spark, sf_dir):
    """Dates from seconds since 1970, and from year, week and weekday."""
    day, monday = F.to_date("o_orderdate"), F.weekday("o_orderdate")
    two = lambda number: F.lpad(F.floor(number).cast("string"), 2, "0")
    seconds = F.datediff(day, F.lit("1970-01-01").cast("date")) * 86400 + F.col("o_orderkey") % 24 * 3600
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        seconds.cast("string").alias("seconds"),
        F.concat(F.year(F.date_add(day, 3 - monday)), F.lit("-W"), two(F.weekofyear(day)), F.lit("-"), monday + 1).alias("iso_week"),
        F.concat_ws(" ", F.year(day), two((F.dayofyear(day) + 6 - monday) / 7), (monday + 1) % 7).alias("week"),
    )
    formats = {"seconds": "%s", "iso_week": "%G-W%V-%u", "week": "%Y %W %w"}
    return apply_transforms(df, [CastDate(name, form) for name, form in formats.items()])


@query(
    """
SELECT c_custkey, 'EMEA' AS region, upper(c_mktsegment) AS segment,
  lower(c_mktsegment) || '_segment' AS label, c_acctbal * 2 AS doubled FROM customer"""
)
def lit_and_map(spark, sf_dir):
    df = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    steps = [
        LitColumn("region", "EMEA"),
        MapColumn("c_mktsegment", "segment", F.upper, native=True),
        MapColumn("c_mktsegment", "label", lambda text: f"{str.lower(text)}_segment", "string"),
        MapColumn("c_acctbal", "doubled", lambda value: value * 2, "double"),
    ]
    return apply_transforms(df, steps).drop("c_mktsegment", "c_acctbal")


@query(
    """
SELECT o_orderkey, substr(o_orderpriority, 2, 2) AS piece,
  ((7 - o_orderkey) % 3 + 3) % 3 AS rest, o_orderpriority || '!' AS longer,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey ELSE o_orderkey / 2.0 END::DOUBLE AS widened
FROM orders"""
)
def map_python(spark, sf_dir):
    """Mappers that mean something else on a Spark column, and one that returns two types."""
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("text"), (7 - F.col("o_orderkey")).alias("number")
    )
    steps = [
        MapColumn("text", "piece", lambda value: value[1:3]),
        MapColumn("number", "rest", lambda value: value % 3),
        MapColumn("text", "longer", lambda value: value + "!"),
        MapColumn("o_orderkey", "widened", lambda value: value if value % 5 == 0 else value / 2),
    ]
    return apply_transforms(df, steps).drop("text", "number")


@query(
    """
SELECT o_orderkey, 'orders' AS source, 'ord' AS part, TRUE AS absolute FROM orders"""
)
def file_lineage(spark, sf_dir):
    steps = [SourceFromFilename(), FilenamePart("part", "ers"), FileSource()]
    tagged = apply_transforms(spark.read.parquet(f"{sf_dir}/orders.parquet"), steps)
    return tagged.select(
        "o_orderkey", "source", "part",
        F.col("file_source").rlike("^(/|[a-z0-9]+:).*/orders[.]parquet$").alias("absolute"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_quantity AS "Y000p5", l_discount AS "Y001p0", l_tax AS "Y010p0"
FROM lineitem"""
)
def tenor_rename(spark, sf_dir):
    raw = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity AS `0.5`", "l_discount AS `1.0`", "l_tax AS `10`"
    )
    return RenameTenors().apply(raw)


@query(
    """
SELECT o_orderkey AS id, o_totalprice AS amount, 'order' AS kind FROM orders
UNION ALL SELECT c_custkey, c_acctbal, 'customer' FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier"""
)
def concat(spark, sf_dir):
    return strict_concat(
        [
            read(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount", "'order' AS kind"),
            read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS amount", "'customer' AS kind"),
            read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS amount", "'supplier' AS kind"),
        ]
    )


@query(
    """
SELECT o_orderkey, 'o_totalprice' AS metric, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS amount,
  CAST(o_orderdate AS DATE) AS day, 'checked' AS status FROM orders"""
)
def step_definitions(spark, sf_dir):
    """Transforms built from plain step definitions."""
    steps = build_transforms(
        [
            {"type": "cast_numeric_string_columns", "exclude": ["day"]},
            {"type": "melt", "index": ["o_orderkey", "day"], "variable_name": "metric", "value_name": "amount"},
            {"type": "cast_date_column", "column": "day", "format": "%Y/%m/%d"},
            {"type": "lit_column", "column": "status", "value": "checked"},
        ]
    )
    texts = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("day"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
    )
    return apply_transforms(texts, steps)


# -- files ---------------------------------------------------------------------


@query(DAILY_LONG.replace('d AS "Index"', 'd AS "Index", \'part\' AS "EqIndex"'))
def wide_csv_job(spark, sf_dir):
    """CSV files with different columns in one folder, melted into one table."""
    work = Workspace(spark)
    folder = work.folder("wide-csv")
    wide = daily_wide(spark, sf_dir).withColumn("Index", F.date_format("Index", "yyyy-MM-dd HH:mm:ss"))
    for names in (EVENT_TYPES[:2], EVENT_TYPES[2:]):
        columns = [f"`{name}.{metric}`" for name in names for metric in ("n", "value")]
        wide.select("Index", *columns).write.mode("append").csv(folder, header=True)
    steps = build_transforms(preset="equity")
    steps[2] = FilenamePart("EqIndex", "-")  # Spark names its files part-...
    df = load_directory(
        spark, folder, extensions={".csv"}, transforms=steps, csv_infer_schema_length=0
    )
    return work.result(df.drop("file_source").withColumn("n", F.col("n").cast("bigint")))


@query(
    """
SELECT o_orderkey, o_orderpriority, o_totalprice, 'part' AS origin FROM orders
UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, 'part' FROM orders"""
)
def mixed_directory(spark, sf_dir):
    """One folder holding parquet and CSV files; CSV types are inferred."""
    work = Workspace(spark)
    folder = work.folder("mixed")
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    df.write.mode("append").parquet(folder)
    df.write.mode("append").csv(folder, header=True)
    return work.result(load_directory(spark, folder, transforms=[FilenamePart("origin", "-")]))


def _write_ipc(df: DataFrame, folder: str) -> None:
    """One Arrow IPC file per task, named by partition so that a retry replaces it."""

    uri = hadoop.resolved(folder)

    def write(batches):
        system, inner = opened(uri)
        system.create_dir(inner, recursive=True)
        part = TaskContext.get().partitionId()
        out = None
        with contextlib.ExitStack() as stack:
            for batch in batches:
                if out is None:
                    sink = stack.enter_context(
                        system.open_output_stream(f"{inner}/part-{part:05d}.feather")
                    )
                    out = stack.enter_context(pa.ipc.new_file(sink, batch.schema))
                out.write_batch(batch)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

    df.mapInArrow(write, "part int").count()


@query(
    """
SELECT l_orderkey, l_shipdate, l_returnflag, l_tax, 'part' AS origin FROM lineitem"""
)
def feather_directory(spark, sf_dir):
    """A folder of Arrow IPC files, read by ranges of record batches."""
    work = Workspace(spark)
    folder = work.folder("feather")
    columns = ["l_orderkey", "l_shipdate", "l_returnflag", "l_tax"]
    _write_ipc(read(spark, sf_dir, "lineitem").select(*columns), folder)
    df = load_directory(spark, folder, extensions={".feather"}, transforms=[FilenamePart("origin", "-")])
    return work.result(df)


@query(
    """
SELECT 'par_rates' AS dataset, o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'zero_rates', l_returnflag, count(*) FROM lineitem GROUP BY 2"""
)
def snapshot_read(spark, sf_dir):
    """Datasets of one dated snapshot folder, subfolders included."""
    work = Workspace(spark)
    root = work.folder("snapshots")
    friday = last_friday(dt.date(2024, 5, 1))
    par = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"))
    zero = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"))
    par.write.parquet(snapshot_path(root, "curves", friday, "par") + "/eur")
    zero.write.parquet(snapshot_path(root, "curves", friday, "zero_coupon"))
    found = read_snapshot(spark, root, "curves", friday)
    counts = [
        df.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("dataset", F.lit(name))
        for name, df in found.items()
    ]
    return work.result(strict_concat(counts))


@query(
    """
WITH o AS (SELECT o_orderstatus AS source, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_totalprice FROM orders),
days AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS d FROM lineitem WHERE l_quantity = 50 AND l_discount = 0)
SELECT source, d - CAST((dayofweek(d) + 2) % 7 AS INT) AS date, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM o WHERE d IN (SELECT d FROM days) GROUP BY ALL"""
)
def snapshot_range(spark, sf_dir):
    """Snapshots by source and month, taken on Fridays; those of some days are read at once."""
    work = Workspace(spark)
    root, name = work.folder("range"), work.table("snapshots")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("kind"), snapshot_friday(F.trunc("o_orderdate", "month")).alias("friday"), "o_totalprice"
    )
    staged = work.folder("staged")
    orders.repartition("kind", "friday").write.partitionBy("kind", "friday").parquet(staged)
    for kind in hadoop.list_folders(staged):
        source = kind.partition("=")[2]
        for friday in hadoop.list_folders(f"{staged}/{kind}"):
            day = friday.partition("=")[2]
            hadoop.move(f"{staged}/{kind}/{friday}", snapshot_path(root, source, day, "par"))
    days = read(spark, sf_dir, "lineitem").where("l_quantity = 50 AND l_discount = 0")
    days = days.select(F.trunc("l_shipdate", "month").alias("day"))
    found = snapshots_of_fridays(register_snapshots(spark, name, root, "par"), days)
    totals = found.groupBy("source", "date").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return work.result(totals)


@query(
    """
SELECT count(*) AS row_count, 5 AS column_count, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns
FROM customer"""
)
def preview(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    looked = preview_frame(customer, 5)
    return customer.agg(
        F.max(F.lit(looked.row_count)).cast("bigint").alias("row_count"),
        F.max(F.lit(looked.column_count)).alias("column_count"),
        F.max(F.lit(",".join(looked.columns))).alias("columns"),
    )


@query(
    """
SELECT DISTINCT d AS day, CAST(d - CAST((dayofweek(d) + 2) % 7 AS INTEGER) AS DATE) AS friday,
  CAST(d - CAST((dayofweek(d) + 2) % 7 AS INTEGER) - 14 AS DATE) AS two_before
FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""
)
def snapshot_dates(spark, sf_dir):
    days = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return days.select(
        "day",
        snapshot_friday(F.col("day")).alias("friday"),
        snapshot_friday(F.col("day"), -2).alias("two_before"),
    )


# -- tables --------------------------------------------------------------------


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""
)
def select_where(spark, sf_dir):
    where = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    return keyed.select_rows(read(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], where)


@query(
    """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount > 0.05 GROUP BY l_returnflag"""
)
def param_sql(spark, sf_dir):
    view = f"panelspark_lineitem_{uuid.uuid4().hex}"
    read(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    return TableStore(spark).execute(
        f"""SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
        FROM {view} WHERE l_shipdate >= ? AND l_discount > ? GROUP BY l_returnflag""",
        [dt.datetime(1998, 1, 1), 0.05],
    )


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def read_query(spark, sf_dir):
    view = f"panelspark_orders_{uuid.uuid4().hex}"
    read(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return TableStore(spark).run_query(
        f"WITH t AS (SELECT * FROM {view}) SELECT o_orderstatus, count(*) AS n FROM t GROUP BY 1;"
    )


@query(
    """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer"""
)
def append_by_name(spark, sf_dir):
    """New rows in another column order and case, one column short."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = read(spark, sf_dir, "customer").selectExpr("c_acctbal AS O_TOTALPRICE", "c_custkey AS o_orderkey")
    return orders.unionByName(align_to(new, orders.schema))


@query(
    """
WITH new AS (SELECT CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS k, l_extendedprice AS v FROM lineitem),
old AS (SELECT s_suppkey AS k FROM supplier WHERE s_acctbal > 0)
SELECT k, v FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.k = new.k)"""
)
def append_skip_existing(spark, sf_dir):
    """Rows whose key is unknown; null keys and repetitions stay."""
    new = read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("k"),
        F.col("l_extendedprice").alias("v"),
    )
    old = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("k"))
    return keyed.rows_with_new_keys(new, old, ["k"])


def _dedup_sql(direction: str) -> str:
    return f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey {direction}) AS r FROM orders)
WHERE r = 1"""


def _dedup(spark, sf_dir, keep):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    return keyed.deduplicate(orders, ["O_CUSTKEY"], keep, ["o_orderkey"])


@query(_dedup_sql("ASC"))
def dedup_keep_first(spark, sf_dir):
    return _dedup(spark, sf_dir, "first")


@query(_dedup_sql("DESC"))
def dedup_keep_last(spark, sf_dir):
    return _dedup(spark, sf_dir, "last")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_whole_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return keyed.deduplicate(rows)


@query(
    """
WITH old AS (SELECT o_custkey AS k, max(o_orderkey) AS seq, 'orders' AS origin FROM orders GROUP BY 1),
new AS (SELECT c_custkey AS k, 0 AS seq, 'customer' AS origin FROM customer WHERE c_acctbal > 0)
SELECT * FROM new UNION ALL
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.k = old.k)"""
)
def upsert_keep_last(spark, sf_dir):
    old = read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS k", "o_orderkey AS seq", "'orders' AS origin"
    )
    new = read(spark, sf_dir, "customer").where("c_acctbal > 0").selectExpr(
        "c_custkey AS k", "0L AS seq", "'customer' AS origin"
    )
    return keyed.upsert(old, new, ["k"], ["seq"])


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 0.0
  ELSE o_totalprice END AS o_totalprice, o_orderstatus, o_orderpriority FROM orders"""
)
def update_where(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    where = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}
    return keyed.update_rows(orders, {"O_TotalPrice": 0}, where)


@query(
    """
SELECT o_orderkey, CASE WHEN o_custkey = 11 THEN 0.5 ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"""
)
def update_partitioned(spark, sf_dir):
    """Update and delete on a partitioned table."""
    store, work = TableStore(spark), Workspace(spark)
    name = work.table("parts")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    store.create_table_from(name, orders, partition_by=["o_orderstatus"])
    store.update(name, {"o_totalprice": 0.5}, {"o_custkey": 11})
    store.delete(name, {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"})
    return work.result(store.select(name, ["o_orderkey", "o_totalprice", "o_orderstatus"]))


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')"""
)
def delete_where(spark, sf_dir):
    where = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}
    return keyed.delete_rows(read(spark, sf_dir, "orders"), where).select("o_orderkey", "o_totalprice")


@query(
    """
WITH t AS (SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
  UNION ALL SELECT c_custkey, c_name, NULL FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)),
u AS (SELECT id, name, CASE WHEN id = 7 THEN 1.5 ELSE balance END AS balance FROM t WHERE id <> 3)
SELECT * FROM u UNION ALL SELECT -1, 'extra', 0.0"""
)
def table_lifecycle(spark, sf_dir):
    """Create, append, skip known keys, insert, update, delete, drop duplicates."""
    store, work = TableStore(spark), Workspace(spark)
    name = work.table("lifecycle")
    suppliers = read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_acctbal AS balance"
    )
    customers = read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    store.create_table(name, {"id": "bigint", "name": "TEXT", "balance": "REAL"})
    store.append_to_table(name, suppliers)
    store.append_to_table(name, customers, ["id"])
    store.insert(name, [{"id": -1, "name": "extra", "balance": 0.0}] * 2)
    store.remove_duplicates(name)
    store.update(name, {"balance": 1.5}, {"id": 7})
    store.delete(name, {"id": 3})
    return work.result(store.select(name))


@query(
    """
SELECT o_orderkey, o_totalprice, 'part' AS origin FROM orders"""
)
def directory_to_table(spark, sf_dir):
    """The directory job: scan, transform, create the table, read it."""
    work = Workspace(spark)
    folder = work.folder("to-table")
    read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").write.parquet(folder)
    name = work.table("rates")
    load_directories_into_tables(
        spark,
        {name: folder, f"{name}_absent": f"{folder}-absent"},
        extensions={".parquet"},
        transforms=[FilenamePart("origin", "-")],
    )
    return work.result(TableStore(spark).select(name))


# -- jobs ------------------------------------------------------------------------


@query(DAILY_LONG.replace('d AS "Index"', 'd AS "Index", \'part\' AS "EqIndex", TRUE AS traced'))
def equity_job(spark, sf_dir):
    """The equity job with its preset as it is; Spark's file names are cut to their first word after it."""
    work = Workspace(spark)
    folder, table = work.folder("equity"), work.table("equity")
    wide = daily_wide(spark, sf_dir).withColumn("Index", F.date_format("Index", "yyyy-MM-dd HH:mm:ss"))
    for names in (EVENT_TYPES[:2], EVENT_TYPES[2:]):
        columns = [f"`{name}.{metric}`" for name in names for metric in ("n", "value")]
        wide.select("Index", *columns).write.mode("append").csv(folder, header=True)
    load_equity_eod(spark, folder, table)
    rows = spark.table(table)
    return work.result(
        rows.select(
            "Index", "Stock", F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"), F.round("value", 2).alias("value"),
            F.regexp_extract("EqIndex", "^[a-z]+", 0).alias("EqIndex"),
            F.endswith("file_source", F.concat("EqIndex", F.lit(".csv"))).alias("traced"),
        )
    )


def _one_file(df: DataFrame, folder: str, form: str) -> str:
    """The path of the single file that a table was written to."""
    df.coalesce(1).write.format(form).option("header", True).save(folder)
    [path] = list_data_files(folder)
    return path


@query(
    """
SELECT c_custkey AS "key", c_name AS name, 'customers' AS "table" FROM customer
UNION ALL SELECT s_suppkey, s_name, 'suppliers' FROM supplier"""
)
def files_to_tables(spark, sf_dir):
    """One file per table; a file that is not there is skipped."""
    work = Workspace(spark)
    names = {kind: work.table(kind) for kind in ("customers", "suppliers", "nothing")}
    customers = read(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name")
    suppliers = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    paths = {
        names["customers"]: _one_file(customers, work.folder("customers"), "csv"),
        names["suppliers"]: _one_file(suppliers, work.folder("suppliers"), "parquet"),
        names["nothing"]: work.folder("nothing") + "/none.csv",
    }
    done = load_files_into_tables(spark, paths)
    loaded = [kind for kind, name in names.items() if done[name]]
    return work.result(strict_concat([spark.table(names[k]).withColumn("table", F.lit(k)) for k in loaded]))


@query(
    """
SELECT n_name AS country, o_orderpriority AS series, year(o_orderdate) AS "year",
  CAST(count(*) AS DOUBLE) / 2 AS value, substr(o_orderpriority, 1, 1) AS topic
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3, 5"""
)
def world_bank_job(spark, sf_dir):
    """Indicator values and their topics from two CSV files into tables, joined again."""
    work, orders = Workspace(spark), read(spark, sf_dir, "orders")
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    values = (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("Country Name"), F.col("o_orderpriority").alias("Series Code"), F.year("o_orderdate").alias("Year"))
        .agg((F.count(F.lit(1)) / 2).alias("Value"))
    )
    topics = orders.select(F.col("o_orderpriority").alias("id"), F.substring("o_orderpriority", 1, 1).alias("topic")).distinct()
    with work.database("bank") as database:
        load_world_bank(
            spark,
            _one_file(topics, work.folder("topics"), "csv"),
            _one_file(values, work.folder("values"), "csv"),
        )
        indicators, mapping = spark.table(f"{database}.indicators"), spark.table(f"{database}.topic_mapping")
        joined = indicators.join(mapping, indicators["Series Code"] == mapping["id"])
        return work.result(
            joined.select(
                F.col("Country Name").alias("country"), F.col("Series Code").alias("series"),
                F.col("Year").alias("year"), F.col("Value").alias("value"), F.col("topic").cast("string").alias("topic"),
            )
        )


@query("SELECT o_orderkey, o_orderstatus, FALSE AS before, TRUE AS after FROM orders")
def gated_run(spark, sf_dir):
    """A directory job that is switched off does nothing; switched on it loads."""
    work = Workspace(spark)
    folder, name = work.folder("gated"), work.table("gated")
    read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.parquet(folder)
    seen = []
    for should_load in (False, True):
        load_directories_into_tables(spark, {name: folder}, should_load=should_load)
        seen.append(TableStore(spark).exists(name))
    return work.result(spark.table(name).withColumns({"before": F.lit(seen[0]), "after": F.lit(seen[1])}))


@query(
    """
WITH f AS (SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 50),
n AS (SELECT count(*) AS n FROM customer)
SELECT c_custkey, 'before' AS side, c_name AS name, c_acctbal AS value, n AS row_count FROM f, n
UNION ALL SELECT c_custkey, 'after', 'c_acctbal', c_acctbal, n FROM f, n"""
)
def preview_sides(spark, sf_dir):
    """The first rows of a file and of what its transforms make of it."""
    work = Workspace(spark)
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy("c_custkey")
    steps = [{"type": "melt", "index": ["c_custkey", "c_name"], "variable_name": "name"}]
    before, after = preview_file(spark, _one_file(rows, work.folder("preview"), "csv"), 50, transforms=steps)
    sides = [
        before.sample.selectExpr("c_custkey", "'before' AS side", "c_name AS name", "c_acctbal AS value"),
        after.sample.selectExpr("c_custkey", "'after' AS side", "name", "value"),
    ]
    counts = [F.lit(side.row_count).cast("bigint") for side in (before, after)]
    return work.result(strict_concat([df.withColumn("row_count", n) for df, n in zip(sides, counts)]))


@query(
    """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, 'parquet' AS kind FROM orders GROUP BY 1
UNION ALL SELECT o_orderpriority, count(*), round(sum(o_totalprice), 2), 'csv' FROM orders GROUP BY 1"""
)
def whole_frame(spark, sf_dir):
    """A function of the whole frame runs on each group of files, where it finds their paths."""
    work = Workspace(spark)
    folder = work.folder("whole-frame")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.write.mode("append").parquet(folder)
    orders.write.mode("append").csv(folder, header=True)

    def summed(df: DataFrame) -> DataFrame:
        kind = F.substring_index(PATH_COL, ".", -1).alias("kind")
        return df.groupBy("o_orderpriority", kind).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )

    return work.result(load_directory(spark, folder, transform=summed))


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
  o_orderstatus || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '-open' END AS state FROM orders"""
)
def csv_late_types(spark, sf_dir):
    """CSV files of one header whose first rows, or all rows, look like integers."""
    work = Workspace(spark)
    folder = work.folder("late")
    done = F.col("o_orderstatus") == "F"
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(done, F.floor("o_totalprice").cast("string")).otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(done, F.col("o_orderstatus")).otherwise(F.concat("o_orderstatus", F.lit("-open"))).alias("state"),
    )
    first = F.col("state") == "F"
    orders.where("o_orderkey % 3 = 0").coalesce(1).sortWithinPartitions(~first).write.mode("append").csv(folder, header=True)
    orders.where("o_orderkey % 3 > 0").where(first).write.mode("append").csv(folder, header=True)
    orders.where("o_orderkey % 3 > 0").where(~first).write.mode("append").csv(folder, header=True)
    return work.result(load_directory(spark, folder))


@query(
    """
SELECT o_orderkey + 1234567890000000000 AS id, '9' || CAST(o_orderkey AS VARCHAR) || '00000000000000000001' AS big,
  CASE WHEN o_orderkey % 7 = 0 THEN '9' || CAST(o_orderkey AS VARCHAR) || '00000000000000000000' ELSE CAST(o_orderkey AS VARCHAR) END AS mixed,
  CAST(o_totalprice AS DOUBLE) AS price FROM orders"""
)
def csv_long_ids(spark, sf_dir):
    """Keys of 19 digits, of more digits than 64 bits hold, and a few such among short ones."""
    work = Workspace(spark)
    folder = work.folder("ids")
    key = F.col("o_orderkey").cast("string")
    orders = read(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + F.lit(1234567890000000000)).alias("id"),
        F.concat(F.lit("9"), key, F.lit("00000000000000000001")).alias("big"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("9"), key, F.lit("0" * 20))).otherwise(key).alias("mixed"),
        F.col("o_totalprice").alias("price"),
    )
    for rest in (0, 1):
        orders.where(F.col("id") % 2 == rest).write.mode("append").csv(folder, header=True)
    ids = load_directory(spark, folder)
    return work.result(ids.select("id", F.col("big").cast("string"), F.col("mixed").cast("string"), "price"))


@query(
    """
SELECT 'appended' AS step, count(*) AS n FROM supplier
UNION ALL SELECT 'new keys', count(*) FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'inserted', 2
UNION ALL SELECT 'updated', count(*) FROM supplier WHERE s_nationkey = 3
UNION ALL SELECT 'deleted', count(*) FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND c_nationkey = 4"""
)
def changed_rows(spark, sf_dir):
    """The numbers of rows that table operations report."""
    store, work = TableStore(spark), Workspace(spark)
    name = work.table("counts")
    suppliers = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS a", "-1L AS b")
    customers = read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "-1L AS a", "CAST(c_nationkey AS BIGINT) AS b")
    store.create_table(name, {"id": "bigint", "a": "bigint", "b": "bigint"})
    counts = {
        "appended": store.append_to_table(name, suppliers),
        "new keys": store.append_to_table(name, customers, ["id"]),
        "inserted": store.insert(name, [{"id": -1, "a": 3}, {"id": -2, "a": 5}]),
        "updated": store.update(name, {"b": 9}, {"a": 3}) - 1,  # one of them was inserted
        "deleted": store.delete(name, {"b": 4}),
    }
    return work.result(spark.createDataFrame(list(counts.items()), "step string, n bigint"))
