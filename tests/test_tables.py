import uuid

import pytest

from panelspark.operators import keyed
from panelspark.operators.tables import TableStore


@pytest.fixture()
def store(spark):
    return TableStore(spark)


@pytest.fixture()
def name():
    return f"t_{uuid.uuid4().hex}"


def frame(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_create(spark, store, name, rows):
    assert store.create_table(name, {"Index": "DATE", "Country Name": "TEXT", "v": "REAL"})
    assert not store.create_table(name, {"x": "INTEGER"})
    assert store.table(name).columns == ["Index", "Country Name", "v"]
    assert store.create_table(name, {"x": "INTEGER"}, overwrite=True)
    assert store.table(name).dtypes == [("x", "bigint")]


def test_create_from_frame(spark, store, name, rows):
    assert store.create_table_from(name, frame(spark, [(1, "a")]))
    assert not store.create_table_from(name, frame(spark, [(2, "b")]))
    assert rows(store.table(name)) == [(1, "a")]
    # replacing a table by something read from it
    assert store.create_table_from(name, store.table(name).selectExpr("k + 1 AS k", "v"), overwrite=True)
    assert rows(store.table(name)) == [(2, "a")]


def test_append_by_name(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, "a")], "k bigint, V string"))
    assert store.append_to_table(name, frame(spark, [("b", 2)], "v string, K int")) == 1
    assert store.append_to_table(name, frame(spark, [(3,)], "k bigint")) == 1
    assert store.append_to_table(name, frame(spark, [], "k bigint")) == 0
    assert rows(store.table(name)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="no column 'z'"):
        store.append_to_table(name, frame(spark, [(1,)], "z int"))
    with pytest.raises(ValueError, match="string does not fit"):
        store.append_to_table(name, frame(spark, [("1",)], "k string"))
    with pytest.raises(ValueError, match="Duplicate check"):
        store.append_to_table(name, frame(spark, [(1,)], "k int"), ["v"])


def test_append_skips_known_keys(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, "a"), (None, "n")]))
    added = store.append_to_table(
        name, frame(spark, [(1, "x"), (2, "b"), (2, "b"), (None, "m")]), ["K"]
    )
    assert added == 3
    assert rows(store.table(name)) == [(None, "m"), (None, "n"), (1, "a"), (2, "b"), (2, "b")]


def test_new_keys_read_the_batch_once(spark, plan, rows):
    new = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN 8 WHEN id % 11 = 0 THEN NULL ELSE id END AS k",
        "id AS v",
    )
    old = spark.range(0, 3000, 2).selectExpr("id AS k").union(spark.sql("SELECT 8L AS k"))
    df = keyed.rows_with_new_keys(new, old, ["k"])
    assert plan(df).count("Range (0, 3000, step=1") == 1
    known = {r[0] for r in old.collect()}
    assert rows(df) == rows(spark.createDataFrame([r for r in new.collect() if r["k"] not in known], new.schema))


def test_insert_select_update_delete(spark, store, name, rows):
    store.create_table(name, {"k": "bigint", "v": "string"})
    assert store.insert(name, []) == 0
    assert store.insert(name, {"k": 1, "v": "a"}) == 1
    assert store.insert(name, [{"k": 2}, {"k": 3}]) == 2
    assert rows(store.select(name, ["V"], {"k": 1})) == [("a",)]
    assert store.select(name, where={"v": None}).count() == 0
    assert store.update(name, {"v": "z"}, {"k": 2}) == 1
    assert store.update(name, {"v": "z"}, {"v": None}) == 0
    assert store.delete(name, {"v": None}) == 0
    assert store.delete(name, {"k": 1}) == 1
    assert rows(store.table(name)) == [(2, "z"), (3, None)]
    with pytest.raises(ValueError, match="do not exist"):
        store.insert(name, {"nope": 1})
    with pytest.raises(ValueError, match="first one lacks"):
        store.insert(name, [{"k": 5}, {"k": 6, "v": "lost"}])
    for change in (lambda: store.delete(name, {}), lambda: store.update(name, {"v": "z"}, {})):
        with pytest.raises(ValueError, match="No condition"):
            change()
    assert store.table(name).count() == 2


def test_remove_duplicates(spark, store, name, rows):
    data = [(1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", 4), (2, None, 5)]
    store.create_table_from(name, frame(spark, data, "k int, v string, seq int"))
    assert store.remove_duplicates(name, ["K"], "last", ["seq"]) == 2
    assert rows(store.table(name), "k", "v") == [(None, "d"), (1, "b"), (2, None)]
    with pytest.raises(ValueError, match="order"):
        store.remove_duplicates(name, ["k"])
    with pytest.raises(ValueError, match="keep"):
        store.remove_duplicates(name, ["k"], "any", ["seq"])
    with pytest.raises(ValueError, match="does not exist"):
        store.remove_duplicates(name, ["z"], "first", ["seq"])
    with pytest.raises(LookupError, match="Missing"):
        store.remove_duplicates("no_such_table")


def test_identical_rows_and_nulls_keep_one(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, None)] * 3 + [(None, None)] * 2 + [(2, "b")]))
    assert store.remove_duplicates(name) == 3
    assert rows(store.table(name)) == [(None, None), (1, None), (2, "b")]


def test_upsert(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, "a"), (None, "n"), (2, "b")]))
    assert store.upsert(name, frame(spark, [(1, "x"), (None, "m"), (3, "c")]), ["k"]) == 4
    assert rows(store.table(name)) == [(None, "m"), (1, "x"), (2, "b"), (3, "c")]


def test_upsert_leaves_the_old_rows_in_place(spark, store, name, rows, plan):
    old = spark.range(20_000).selectExpr("id AS k", "'old' AS v")
    store.create_table_from(name, old)
    batch = [(5, "x"), (5, "y"), (30_000, "z"), (None, "n"), (None, "m")]
    store.create_table_from(f"{name}_new", frame(spark, batch, "k bigint, v string"))
    df = keyed.upsert(store.table(name), store.table(f"{name}_new"), ["k"])
    text = plan(df)
    [join] = [line for line in text.splitlines() if "Join" in line]
    assert "BroadcastHashJoin" in join and "LeftAnti" in join
    old_side = text[text.index(join) : text.index("BroadcastExchange")]
    assert "FileScan" in old_side and "Exchange" not in old_side and "Sort" not in old_side
    got = {r["k"]: r["v"] for r in df.collect()}
    assert len(got) == df.count() == 20_002 and (got[5], got[30_000], got[None], got[6]) == ("y", "z", "n", "old")


def test_deduplicate_combines_before_the_shuffle(spark, plan):
    df = keyed.deduplicate(frame(spark, [(1, "a")]).repartition(3), ["k"], "last", ["v"])
    text = plan(df)
    assert "partial_max" in text and "Window" not in text


def test_queries(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, "a"), (2, "b")]))
    assert rows(store.execute(f"SELECT v FROM `{name}` WHERE k = ?", [2])) == [("b",)]
    assert rows(store.execute(f"SELECT v FROM `{name}` WHERE k = :k", {"k": 1})) == [("a",)]
    assert rows(store.run_query(f"WITH t AS (SELECT * FROM `{name}`) SELECT count(*) FROM t;")) == [(2,)]
    assert store.run_query(f"SELECT * FROM `{name}` WHERE k > 5").columns == ["k", "v"]
    for bad in (f"DROP TABLE `{name}`", f"SELECT 1; DROP TABLE `{name}`"):
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            store.run_query(bad)


def test_recover(spark, store, name, rows):
    store.create_table_from(f"{name}__staging", frame(spark, [(1, "a")]))
    assert store.recover(name) and not store.recover(name)
    assert rows(store.table(name)) == [(1, "a")]


def test_recover_keeps_partitions(spark, store, name, rows):
    data = frame(spark, [(1, "a"), (2, "b")])
    store.create_table_from(f"{name}__staging", data, partition_by=["k"])
    assert store.recover(name)
    assert rows(store.table(name), "k", "v") == [(1, "a"), (2, "b")]


def test_partitioned_tables_stay_partitioned(spark, store, name, rows):
    store.create_table_from(name, frame(spark, [(1, "a"), (2, "b")]), partition_by=["k"])
    assert store.delete(name, {"k": 1}) == 1
    assert store.append_to_table(name, frame(spark, [("c", 3)], "v string, k int")) == 1
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    assert parts == ["k"] and rows(store.table(name), "k", "v") == [(2, "b"), (3, "c")]


def test_changes_rewrite_only_partitions_with_matches(spark, store, name, rows):
    import glob
    import os

    data = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e f'g")], "k int, v string")
    store.create_table_from(name, data.selectExpr("v", "k"), partition_by=["k"])
    folder = spark.sql(f"DESCRIBE EXTENDED `{name}`")
    folder = folder.where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    before = {p: os.stat(p).st_ino for p in glob.glob(f"{folder}/*/part-*")}
    assert store.update(name, {"v": "z"}, {"v": "b"}) == 1
    after = {p: os.stat(p).st_ino for p in glob.glob(f"{folder}/*/part-*")}
    assert {p for p in before if "k=1" not in p} <= after.keys() and not {p for p in before if "k=1" in p} & after.keys()
    assert rows(store.table(name), "k", "v") == [(None, "d"), (1, "a"), (1, "z"), (2, "c"), (3, "e f'g")]
    assert store.update(name, {"v": "null"}, {"v": "d"}) == 1
    assert store.delete(name, {"k": 2}) == 1 and store.delete(name, {"v": "a"}) == 1
    assert store.update(name, {"k": 9}, {"k": 3}) == 1
    assert rows(store.table(name), "k", "v") == [(None, "null"), (1, "z"), (9, "e f'g")]


class Cut(Exception):
    pass


STEPS = ("SET LOCATION", "ADD PARTITION", "DROP IF EXISTS PARTITION", "SET TBLPROPERTIES", "UNSET TBLPROPERTIES", "delete")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("parts", [[], ["k"]])
def test_a_change_cut_off_anywhere_leaves_a_whole_table(spark, store, name, rows, monkeypatch, step, parts):
    data = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e f'g%/=")], "k int, v string")
    store.create_table_from(name, data.selectExpr("v", "k"), partition_by=parts)
    before, after = rows(store.table(name), "k", "v"), [(None, "z"), (1, "z"), (1, "z"), (3, "e f'g%/="), (4, "n")]
    batch = frame(spark, [(1, "z"), (None, "z"), (4, "n")], "k int, v string")

    def change():
        old = TableStore(spark).table(name)
        new = old.where("NOT k <=> 2").selectExpr("CASE WHEN k = 3 THEN v ELSE 'z' END AS v", "k").union(batch.where("k = 4").select("v", "k"))
        return TableStore(spark)._switch(name, new)

    def cut(*_):
        raise Cut

    with monkeypatch.context() as patched:
        if step == "delete":
            patched.setattr("panelspark.operators.tables.hadoop.delete", cut)
        else:
            sql = type(spark).sql
            patched.setattr(type(spark), "sql", lambda self, text, *a, **k: cut() if step in text else sql(self, text, *a, **k))
        try:
            change()
        except Cut:
            pass
    assert spark.catalog.tableExists(name)
    now = rows(TableStore(spark).table(name), "k", "v")
    assert now in (before, after)
    if now == before:
        change()
    assert rows(TableStore(spark).table(name), "k", "v") == after == rows(spark.table(name), "k", "v")
    assert not TableStore(spark).recover(name)
    store.append_to_table(name, batch)
    assert store.table(name).count() == len(after) + 3 and store.delete(name, {"v": "z"}) == 5


def test_partitions_of_several_columns_and_types_are_replaced_in_one_job(spark, store, name, rows):
    data = spark.sql("SELECT CAST(id AS STRING) AS v, DATE'2024-01-01' + CAST(id % 3 AS INT) AS d, concat('x y/', id % 2) AS s FROM range(12)")
    store.create_table_from(name, data, partition_by=["d", "s"])
    group = spark.sparkContext.statusTracker()
    assert store.update(name, {"v": "new"}, {"s": "x y/1"}) == 6
    assert store.delete(name, {"v": "0"}) == 1
    want = [("new" if i % 2 else str(i), i % 3, i % 2) for i in range(1, 12)]
    got = store.table(name).selectExpr("v", "datediff(d, DATE'2024-01-01')", "CAST(right(s, 1) AS INT)")
    assert rows(got) == sorted(want) and group is not None
    assert store.upsert(name, data.where("v = '5'").selectExpr("'five' AS v", "d", "s"), ["d", "s"]) == 10


def test_decimal_places_are_not_lost_without_a_word(spark, store, name, rows):
    store.create_table(name, {"v": "decimal(10,2)"})
    assert store.append_to_table(name, frame(spark, [(1.24,), (0.1,), (None,), (-3.0,)], "v double")) == 4
    for value in (1.239, 0.001, 1e-9):
        with pytest.raises(Exception, match="does not fit"):
            store.append_to_table(name, frame(spark, [(value,)], "v double"))
    assert store.append_to_table(name, spark.sql("SELECT CAST(7.50 AS DECIMAL(12,4)) AS v UNION ALL SELECT NULL")) == 2
    with pytest.raises(Exception, match="does not fit"):
        store.append_to_table(name, spark.sql("SELECT CAST(7.505 AS DECIMAL(12,4)) AS v"))
    assert [str(r[0]) for r in rows(store.table(name))][2:] == ["-3.00", "0.10", "1.24", "7.50"]
