import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUICK = ["rolling_pearson", "coverage", "prefixed_melt", "append_skip_existing", "upsert_keep_last"]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_row_counts(spark, name):
    con = duckdb.connect()
    for table in ("orders", "lineitem", "events", "customer", "supplier"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = contract.queries()[name](spark, SF)
    result = con.execute(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(c[0] for c in result.description)
    assert df.count() == len(result.fetchall())
