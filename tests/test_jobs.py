import datetime as dt
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators.coverage import coverage
from panelspark.operators.tables import TableStore
from panelspark.plans.ingest import (
    load_directories_into_tables, load_equity_eod, load_files_into_tables, load_world_bank,
)
from panelspark.plans.rates import (
    CorrelationArtefacts, create_correlation_files, rate_tables, rates_coverage, run_rates, save_window_corr,
    extend_window_corr, new_correlations, since, watermarks, window_corr_strict,
)
from panelspark.sources.snapshots import (
    last_friday, read_snapshot, register_snapshots, snapshot_friday, snapshot_path, snapshots_of_fridays,
)


@pytest.fixture(autouse=True)
def database(spark):
    """Each job test has a database of its own, as jobs use fixed table names."""
    name = f"job_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    spark.catalog.setCurrentDatabase(name)
    yield
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_files_into_tables(spark, tmp_path, rows):
    (tmp_path / "topics.csv").write_text("id,name,topic\nRAIN,Yearly rain,Climate\nROAD,Paved roads,Transport\n")
    (tmp_path / "long.csv").write_text(
        "Country Name,Country Code,Series Code,Year,Value,Topic\nChad,TCD,RAIN,1998,312.25,Climate\n"
    )
    done = load_world_bank(spark, str(tmp_path / "topics.csv"), str(tmp_path / "long.csv"))
    assert done == {"topic_mapping": True, "indicators": True}
    store = TableStore(spark)
    assert rows(store.table("topic_mapping"))[0] == ("RAIN", "Yearly rain", "Climate")
    assert rows(store.table("indicators")) == [("Chad", "TCD", "RAIN", 1998, 312.25, "Climate")]
    assert load_files_into_tables(spark, {"x": str(tmp_path / "none.csv")}) == {"x": False}
    with pytest.raises(FileNotFoundError):
        load_files_into_tables(spark, {"x": str(tmp_path / "none.csv")}, skip_missing=False)


def test_directories_into_tables(spark, tmp_path):
    for folder, days in (("dry", 2), ("wet", 3)):
        (tmp_path / folder).mkdir()
        frame = pd.DataFrame({"day": [f"2020-02-{d:02d}" for d in range(1, days + 1)], "mm": [d * 1.75 for d in range(days)]})
        frame.to_parquet(tmp_path / folder / "station.parquet")
    where = {"d": str(tmp_path / "dry"), "w": str(tmp_path / "wet"), "q": str(tmp_path / "none")}
    assert load_directories_into_tables(spark, where, should_load=False) == {}
    assert load_directories_into_tables(spark, where) == {"d": True, "w": True, "q": False}
    assert (spark.table("d").count(), spark.table("w").count()) == (2, 3)
    assert load_directories_into_tables(spark, where, overwrite=False) == {"d": False, "w": False, "q": False}


def test_equity(spark, tmp_path, rows):
    (tmp_path / "OSE_2019.csv").write_text("Index,EQN.OL.Low,EQN.OL.Trades\n2019-08-05 12:30:00,88.5,6e+02\n")
    assert load_equity_eod(spark, str(tmp_path)) == {"equity_eod": True}
    assert rows(spark.table("equity_eod"), "Index", "Stock", "Low", "Trades", "EqIndex") == [
        (dt.date(2019, 8, 5), "EQN.OL", 88.5, 600.0, "OSE")
    ]


@pytest.fixture()
def curves(tmp_path):
    """Curve files as they arrive: one per source, tenors as column names."""
    root = tmp_path / "curves"
    for folder, scale in (("zero_coupon", 1.0), ("par", -1.0), ("spot_fx_rates", 1.0)):
        (root / folder).mkdir(parents=True)
        for k, source in enumerate(("eur", "usd", "gbp")):
            days = [f"2024-01-{d:02d}" for d in range(1, 13)]
            values = [float((d * (k + 3)) % 7) + (scale * d if k else d) for d in range(12)]
            pd.DataFrame({"date": days, "1.0": values, "2.0": values[::-1]}).to_parquet(
                root / folder / f"{source}.parquet"
            )
    return str(root)


SMALL = {"tenors": ["Y001p0", "Y002p0"], "windows": [3, 5]}


def test_no_flags_do_nothing(spark):
    assert run_rates(spark) == {"zero_rates_rows": 0, "directories_loaded": {}}
    assert spark.catalog.listTables() == []


def test_missing_tables_are_all_named(spark, tmp_path):
    with pytest.raises(LookupError, match="Missing rate tables: zero_rates, par_rates, spotfx"):
        run_rates(spark, folder=str(tmp_path), create_corr_files=True)


def test_failed_load_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="did not create"):
        run_rates(spark, root=str(tmp_path), folder=str(tmp_path), load_from_files=True, create_corr_files=True)


def test_full_run_twice(spark, tmp_path, curves, rows):
    folder = str(tmp_path / "corr")
    options = dict(root=curves, folder=folder, load_from_files=True, create_corr_files=True,
                   populate_from_files=True, **SMALL)
    summary = run_rates(spark, **options)
    assert summary["zero_rates_rows"] == 36
    assert spark.table("zero_rates").columns == ["date", "Y001p0", "Y002p0", "source"]
    table = spark.table("window_corr")
    # pearson: 12 dates; dcorr: 10 and 8 full windows; 3 pairs, 2 tenors, 2 curves
    assert table.count() == (2 * 12 + 10 + 8) * 3 * 2 * 2
    first = rows(table.select(sorted(table.columns)))
    assert run_rates(spark, **options)["zero_rates_rows"] == 36
    table = spark.table("window_corr")
    assert rows(table.select(sorted(table.columns))) == first
    strict = window_corr_strict(spark)
    assert strict.count() == (2 * 12 + 10 + 8) * 3 * 2
    par = table.where("rate_table = 'par_rates'").select(strict.columns)
    assert rows(strict) == rows(par)


def test_artefacts_are_reused(spark, tmp_path, curves):
    run_rates(spark, root=curves, load_from_files=True)
    folder = str(tmp_path / "corr")
    paths = create_correlation_files(spark, folder, **SMALL)
    assert len(paths) == 8
    assert paths[0] == f"{folder}/corr_dfs_melted_zero_rates_20070101_20240112/window_size=3"
    stamps = {p: os.stat(p).st_mtime_ns for p in paths}
    create_correlation_files(spark, folder, **SMALL, overwrite=False)
    assert stamps == {p: os.stat(p).st_mtime_ns for p in paths}
    create_correlation_files(spark, folder, tenors=["Y001p0"], windows=[4], overwrite=False)
    assert stamps == {p: os.stat(p).st_mtime_ns for p in paths}


def test_artefacts_grow_by_tenors_and_a_half_written_one_is_computed_again(spark, tmp_path, curves):
    run_rates(spark, root=curves, load_from_files=True)
    zero, start = spark.table("zero_rates"), dt.date(2020, 1, 1)
    kept = CorrelationArtefacts(spark, str(tmp_path / "corr"))
    one = dict(tenors=["Y001p0"], windows=[3], start=start)
    kept.write(zero, "zero_rates", **one)
    paths = kept.write(zero, "zero_rates", tenors=["Y002p0"], windows=[3], start=start)
    rows = kept.read(zero, "zero_rates", windows=[3], start=start)
    assert {r[0] for r in rows.select("observable").distinct().collect()} == {"Y001p0", "Y002p0"}
    assert {r[0] for r in rows.select("corr_type").distinct().collect()} == {"pearson", "dcorr"}
    only = kept.read(zero, "zero_rates", tenors=["Y001p0"], windows=[3], start=start)
    assert only.count() * 2 == rows.count()
    before = rows.count()
    for path in paths:  # as if the run had ended between its folders
        os.remove(f"{os.path.dirname(path)}/_complete")
        for part in os.listdir(path):
            os.remove(f"{path}/{part}")
    assert kept.read(zero, "zero_rates", windows=[3], start=start) is None
    kept.write(zero, "zero_rates", tenors=["Y001p0", "Y002p0"], windows=[3], start=start)
    assert kept.read(zero, "zero_rates", windows=[3], start=start).count() == before
    assert [n for n in os.listdir(tmp_path / "corr") if n.startswith("_staged")] == []


def test_nothing_to_populate_from(spark, tmp_path, curves):
    run_rates(spark, root=curves, load_from_files=True)
    with pytest.raises(LookupError, match="zero_rates"):
        run_rates(spark, folder=str(tmp_path / "none"), populate_from_files=True, **SMALL)


def test_first_day_is_a_filter_of_the_scan(spark, curves, plan):
    run_rates(spark, root=curves, load_from_files=True)
    frames = rate_tables(spark)
    assert dict(frames["zero_rates"].dtypes)["date"] == "date"
    assert "GreaterThanOrEqual(date," in plan(since(frames["zero_rates"], dt.date(2024, 1, 5)))


def test_unchanged_partitions_are_not_written(spark, tmp_path, curves):
    options = dict(root=curves, folder=str(tmp_path / "corr"), load_from_files=True, create_corr_files=True,
                   populate_from_files=True, **SMALL)
    run_rates(spark, **options)
    files = {r[0] for r in spark.table("window_corr").select("_metadata.file_path").distinct().collect()}
    run_rates(spark, **options)
    assert files == {r[0] for r in spark.table("window_corr").select("_metadata.file_path").distinct().collect()}


def test_coverage(spark, curves, rows):
    run_rates(spark, root=curves, load_from_files=True)
    got = rates_coverage(spark).collect()
    assert [tuple(r) for r in got][:2] == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 12), "eur", "par_rates", 11),
        (dt.date(2024, 1, 1), dt.date(2024, 1, 12), "eur", "spotfx", 11),
    ]
    fx = spark.sql("SELECT DATE'2024-01-01' AS date, 'spot_fx_rates' AS source")
    assert rows(coverage({"spotfx": fx}), "source", "coverage_days") == [("fx", 0)]


def test_snapshots(spark, tmp_path, rows):
    day = dt.date(2024, 5, 1)  # a Wednesday
    assert [last_friday(day + dt.timedelta(n)).isoformat()[5:] for n in range(7)] == [
        "04-26", "04-26", "05-03", "05-03", "05-03", "05-03", "05-03"
    ]
    assert last_friday(day, -1) == dt.date(2024, 4, 19)
    days = spark.sql("SELECT explode(sequence(DATE'2024-05-01', DATE'2024-05-14')) AS d")
    for d, friday, later in days.select("d", snapshot_friday(days.d), snapshot_friday(days.d, 2)).collect():
        assert friday == last_friday(d) and later == last_friday(d, 2)
    deep = tmp_path / "curves/2024-04-26/transformed/par/more"
    deep.mkdir(parents=True)
    pd.DataFrame({"v": [1]}).to_parquet(deep.parent / "eur.parquet")
    pd.DataFrame({"v": [2]}).to_parquet(deep / "usd.parquet")
    found = read_snapshot(spark, str(tmp_path), "curves", last_friday(day))
    assert list(found) == ["par_rates"] and rows(found["par_rates"]) == [(1,), (2,)]
    assert snapshot_path("s3a://b/", "x", "2024-04-26", "par") == "s3a://b/x/2024-04-26/transformed/par"


def test_strict_save_keeps_par_and_other_partitions(spark, rows):
    columns = ("date date, Correlation double, observable string, source1 string, source2 string, "
               "window_size int, corr_type string, rate_table string")
    day = dt.date(2024, 1, 1)

    def batch(*values):
        return spark.createDataFrame(
            [(day, v, "Y001p0", "a", "b", w, "pearson", curve) for v, w, curve in values], columns
        )

    save_window_corr(spark, batch((0.9, 20, "zero_rates"), (0.1, 20, "par_rates"), (0.5, 40, "zero_rates")), strict=True)
    table = spark.table("window_corr")
    assert "rate_table" not in table.columns
    assert rows(table, "Correlation", "window_size") == [(0.1, 20), (0.5, 40)]
    save_window_corr(spark, batch((0.7, 20, "zero_rates")), strict=True)
    assert rows(spark.table("window_corr"), "Correlation", "window_size") == [(0.5, 40), (0.7, 20)]


def test_new_days_come_from_the_days_before_them(spark, rows, plan):
    data = [
        (dt.date(2024, 1, 1) + dt.timedelta(d), source, float((d * 7 + len(source) * d * d) % 11), float(d % 5))
        for d in range(60) for source in ("a", "bb", "ccc") if not (source == "ccc" and d > 20)
    ]
    panel = spark.createDataFrame(data, "date date, source string, Y001p0 double, Y002p0 double")
    last = dt.date(2024, 2, 27)
    whole = new_correlations(panel, None, ["Y001p0", "Y002p0"], [3, 5])
    got = new_correlations(panel, last, ["Y001p0", "Y002p0"], [3, 5])
    # two new days, pearson and dcorr, two windows, three pairs (one of them of a quiet source), two tenors
    assert got.count() == 2 * 2 * 2 * 3 * 2
    same = lambda df: rows(df.withColumn("Correlation", F.round("Correlation", 9) + F.lit(0.0)))
    assert same(got) == same(whole.where(F.col("date") > last))
    spark.createDataFrame(data, panel.schema).where("date < '2024-02-20'").write.saveAsTable("zero_rates")
    for name in ("par_rates", "spotfx"):
        spark.table("zero_rates").write.saveAsTable(name)
    options = dict(tenors=["Y001p0"], windows=[3, 5])
    assert extend_window_corr(spark, **options) == {"zero_rates": 50, "par_rates": 50}
    files = {r[0] for r in spark.table("window_corr").select("_metadata.file_path").distinct().collect()}
    assert extend_window_corr(spark, **options) == {"zero_rates": 0, "par_rates": 0}
    panel.where("date >= '2024-02-20'").write.insertInto("zero_rates")
    assert extend_window_corr(spark, **options) == {"zero_rates": 10, "par_rates": 0}
    after = {r[0] for r in spark.table("window_corr").select("_metadata.file_path").distinct().collect()}
    assert {f for f in files if "zero_rates" not in f} <= after  # the other curve is left alone
    assert {str(r["last"]) for r in watermarks(spark).where("rate_table = 'zero_rates'").collect()} == {"2024-02-29"}
    kept = spark.table("window_corr").where("rate_table = 'zero_rates'").drop("rate_table", "year")
    want = whole.where("observable = 'Y001p0'")
    assert same(kept.select(want.columns)) == same(want)


def test_many_snapshots_are_pruned_by_a_table_of_days(spark, tmp_path, rows, plan):
    root = str(tmp_path / "snaps")

    def put(source, day, value):
        spark.sql(f"SELECT {value} AS v").write.parquet(snapshot_path(root, source, day, "par"))

    for number, day in enumerate(["2024-04-19", "2024-04-26", "2024-05-03"]):
        put("eur x", day, number)
        put("usd", day, 10 + number)
    (tmp_path / "snaps" / "usd" / "notes").mkdir()
    days = spark.sql("SELECT explode(sequence(DATE'2024-05-01', DATE'2024-05-02')) AS day")
    found = register_snapshots(spark, "snaps", root, "par")
    assert found.columns == ["v", "source", "date"] and found.count() == 6
    df = snapshots_of_fridays(found, days)
    assert "dynamicpruning" in plan(df)
    assert rows(df, "source", "v") == [("eur x", 1), ("usd", 11)]
    put("usd", "2024-05-10", 13)
    assert register_snapshots(spark, "snaps", root, "par").where("date = '2024-05-10'").count() == 1
    with pytest.raises(FileNotFoundError):
        register_snapshots(spark, "none", root, "spot")
