import pandas as pd
import pyarrow as pa
import pyarrow.feather
import pytest

from panelspark.operators.concat import strict_concat
from panelspark.operators.steps import build_transforms
from panelspark.operators.transforms import FilenamePart, FileSource, LitColumn, Melt, SourceFromFilename
from panelspark.session import scratch_dir
from panelspark.sources import files
from panelspark.sources.preview import preview_file
from panelspark.sources.readers import load_directory, read_file


@pytest.fixture()
def data_dir(tmp_path):
    """Tide levels of three harbours, one format each."""
    pd.DataFrame({"date": ["2021-06-01", "2021-06-02", "2021-06-03"], "level": [0.25, -1.5, 3.0]}).to_parquet(
        tmp_path / "hull.parquet"
    )
    (tmp_path / "cork.csv").write_text("date,level\n2021-06-01,2.75\n2021-06-04,-0.5\n")
    pyarrow.feather.write_feather(
        pa.table({"date": ["2021-06-05"], "level": [9.125]}), str(tmp_path / "oban.feather")
    )
    return tmp_path


def test_each_format(spark, data_dir):
    counts = {f.name: read_file(spark, f).count() for f in data_dir.iterdir()}
    assert counts == {"hull.parquet": 3, "cork.csv": 2, "oban.feather": 1}
    assert read_file(spark, data_dir / "cork.csv").dtypes == [("date", "string"), ("level", "double")]


def test_some_columns(spark, data_dir, rows):
    for name, want in (("hull.parquet", -1.5), ("cork.csv", -0.5), ("oban.feather", 9.125)):
        df = read_file(spark, data_dir / name, columns=["level"])
        assert df.columns == ["level"] and rows(df)[0] == (want,)
    df = load_directory(spark, data_dir, columns=["level"], transforms=[SourceFromFilename()])
    assert rows(df, "source", "level")[0] == ("cork", -0.5)
    with pytest.raises(Exception, match="nope"):
        read_file(spark, data_dir / "oban.feather", columns=["nope"]).count()


def test_mixed_directory(spark, data_dir, rows):
    df = load_directory(spark, data_dir, transforms=[SourceFromFilename()])
    assert df.columns == ["date", "level", "source"]
    assert {r[0] for r in rows(df, "source")} == {"hull", "cork", "oban"}
    assert df.count() == 6


def test_extensions_and_subdirectories(spark, data_dir):
    (data_dir / "sub").mkdir()
    (data_dir / "sub" / "deal.CSV").write_text("date,level\n2021-06-09,9.0\n")
    assert load_directory(spark, data_dir, extensions={".csv"}).count() == 2
    assert load_directory(spark, data_dir, extensions={".csv"}, recursive=True).count() == 3
    with pytest.raises(FileNotFoundError, match=".ipc"):
        load_directory(spark, data_dir, extensions={".ipc"})


def test_unsupported_and_hidden(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    with pytest.raises(ValueError, match="'.txt'"):
        read_file(spark, tmp_path / "a.txt")
    (tmp_path / "_h.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="_h.csv"):
        load_directory(spark, tmp_path)


def test_csv_files_with_other_columns_are_not_mixed_up(spark, tmp_path, rows):
    """Columns are matched by name even though the files differ."""
    (tmp_path / "north_hourly.csv").write_text(
        "Index,N.1.Rain,N.1.Gusts\n2022-03-04 06:00:00,0.25,3e+01\n2022-03-05 06:00:00,,12\n"
    )
    (tmp_path / "south_hourly.csv").write_text("Index,S.Rain,S.Gusts\n2022-03-04 00:00:00,7,40\nnever,1.75,calm\n")
    df = load_directory(
        spark, tmp_path, extensions={".csv"}, transforms=build_transforms(preset="equity"),
        csv_infer_schema_length=0,
    )
    assert df.columns == ["Index", "Stock", "Rain", "Gusts", "EqIndex", "file_source"]
    assert df.dtypes[0] == ("Index", "date")
    got = [tuple(str(v) for v in r) for r in rows(df, "Index", "Stock", "Rain", "Gusts", "EqIndex")]
    assert got == [
        ("None", "S", "1.75", "None", "south"),
        ("2022-03-04", "N.1", "0.25", "30.0", "north"),
        ("2022-03-04", "S", "7.0", "40.0", "south"),
        ("2022-03-05", "N.1", "None", "12.0", "north"),
    ]
    assert {r[0] for r in rows(df, "file_source")} == {
        str(tmp_path / "north_hourly.csv"), str(tmp_path / "south_hourly.csv")
    }


def test_csv_types_come_from_all_rows_of_all_files(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("n,t,b,x\n" + "1,2,true,\n" * 300 + "2.5,word,false,\n")
    (tmp_path / "b.csv").write_text("n,t,b,x\n7,8,TRUE,\n")
    df = load_directory(spark, tmp_path)
    assert df.dtypes == [("n", "double"), ("t", "string"), ("b", "boolean"), ("x", "string")]
    assert rows(df, "n", "t")[-2:] == [(2.5, "word"), (7.0, "8")]


def test_csv_types_from_a_number_of_rows(spark, tmp_path):
    (tmp_path / "long.csv").write_text("v,w\n" + f"1,{'x' * 100}\n" * 20_000 + "1.5,y\n")
    kinds = [dict(read_file(spark, tmp_path / "long.csv", csv_infer_schema_length=n).dtypes)["v"] for n in (20_000, 20_001)]
    assert kinds == ["bigint", "double"]


def test_csv_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'i,f,b,s,d,e\n1,1,true,"x, ""y""",2024-01-01,\n-2,2.5e3,FALSE,2,2024-01-02,\n'
    )
    df = read_file(spark, tmp_path / "t.csv")
    assert dict(df.dtypes) == {
        "i": "bigint", "f": "double", "b": "boolean", "s": "string", "d": "string", "e": "string"
    }
    assert df.first()["s"] == 'x, "y"' and df.first()["e"] is None
    assert {kind for _, kind in read_file(spark, tmp_path / "t.csv", csv_infer_schema_length=0).dtypes} == {"string"}
    # a value that does not fit the type seen in the first rows fails loudly
    assert dict(read_file(spark, tmp_path / "t.csv", csv_infer_schema_length=1).dtypes)["f"] == "bigint"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_file(spark, tmp_path / "t.csv", csv_infer_schema_length=1).collect()


def test_odd_paths(spark, tmp_path, rows):
    folder = tmp_path / "a b+c%20[x]"
    folder.mkdir()
    (folder / "e+u r.v1.csv").write_text("v\n1\n")
    pd.DataFrame({"v": [2]}).to_parquet(folder / "u%sd{1}.parquet")
    df = load_directory(spark, folder, transforms=[SourceFromFilename(), FileSource()])
    assert rows(df) == [
        (1, "e+u r.v1", str(folder / "e+u r.v1.csv")),
        (2, "u%sd{1}", str(folder / "u%sd{1}.parquet")),
    ]


def test_filename_part_is_checked_before_reading(spark, data_dir):
    with pytest.raises(ValueError, match="no part 1"):
        load_directory(spark, data_dir, transforms=[FilenamePart("x", "_", 1)])


def test_strict_concat(spark):
    a, b = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 'a' AS x")
    with pytest.raises(ValueError, match="Cannot concatenate"):
        strict_concat([a, b])
    assert strict_concat([a, a]).count() == 2


def test_transforms_only_when_given(spark, tmp_path, rows):
    pd.DataFrame({"date": ["2024-01-01"], "1.0": [1.1], "2.0": [2.1]}).to_parquet(tmp_path / "eur.parquet")
    assert load_directory(spark, tmp_path).columns == ["date", "1.0", "2.0"]
    df = load_directory(spark, tmp_path, transforms=[Melt(["date"]), LitColumn("dataset", "curves")])
    assert rows(df) == [("2024-01-01", "1.0", 1.1, "curves"), ("2024-01-01", "2.0", 2.1, "curves")]
    tagged = load_directory(spark, tmp_path, transform=lambda d: d.withColumn("n", d["`1.0`"] * 2))
    assert tagged.first()["n"] == 2.2


def test_large_feather_is_split(spark, tmp_path, rows):
    table = pa.table({"k": pa.array(range(1000), pa.uint16()), "c": pa.array(["x", "y"] * 500).dictionary_encode()})
    with pa.ipc.new_file(str(tmp_path / "big.ipc"), table.schema) as out:
        for batch in table.to_batches(max_chunksize=20):
            out.write_batch(batch)
    df = read_file(spark, tmp_path / "big.ipc")
    assert dict(df.dtypes) == {"k": "int", "c": "string"}
    assert df.rdd.getNumPartitions() == 4  # 50 batches, 16 a task
    assert df.selectExpr("sum(k)", "count(distinct c)").first()[:] == (499500, 2)


def test_layouts_come_once(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"s{n}.csv").write_text(f"a,b{n % 2}\n{n},x\n")
    found = files.inspect_files(spark, files.list_data_files(str(tmp_path)))
    assert [f.path[-6:] for f in found] == ["s0.csv", "s1.csv", "s2.csv", "s3.csv", "s4.csv"]
    assert len({f.columns for f in found}) == 2


def test_preview(spark, data_dir):
    before, after = preview_file(
        spark, str(data_dir / "cork.csv"), 1, transforms=[{"type": "melt", "index": ["date"]}]
    )
    assert (before.row_count, before.column_count, before.columns) == (2, 2, ["date", "level"])
    assert (after.row_count, after.columns) == (2, ["date", "variable", "value"])
    assert before.sample.count() == 1
    with pytest.raises(ValueError, match="between 1 and 100"):
        preview_file(spark, str(data_dir / "cork.csv"), 0)
    with pytest.raises(FileNotFoundError):
        preview_file(spark, str(data_dir / "none.csv"))


def test_parquet_folder_as_file(spark, tmp_path):
    path = str(tmp_path / "big.parquet")
    spark.range(10).repartition(3).write.parquet(path)
    assert read_file(spark, path).count() == 10


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Session:
        def __init__(self, master, folder):
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})
            self.sparkContext = type("Context", (), {"master": master})

    assert scratch_dir(Session("yarn", "hdfs://x/tmp/"), "a").startswith("hdfs://x/tmp/a-")
    for master in ("local", "local[4]"):
        assert "/panelspark-scratch/a-" in scratch_dir(Session(master, None), "a")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_dir(Session(master, None), "a")


@pytest.mark.parametrize("look", [None, 100])
def test_csv_integers_of_any_length_stay_exact(spark, tmp_path, look):
    columns = {
        "id": ["1234567890123456789", "1234567890123456788", "-9223372036854775808"],
        "big": ["9223372036854775808", "1", "-99999999999999999999999999999999999999"],
        "text": ["9" * 39, "1", "2"],
        "zeros": ["0000000000000000000000000000000000000000012", "+5", "7"],
        "real": ["12345678901234567890", "0.5", "1"],
        "flag": ["true", "9223372036854775808", ""],
    }
    lines = [",".join(columns), *map(",".join, zip(*columns.values()))]
    (tmp_path / "ids.csv").write_text("\n".join(lines) + "\n")
    df = read_file(spark, tmp_path / "ids.csv", csv_infer_schema_length=look)
    assert dict(df.dtypes) == {
        "id": "bigint", "big": "decimal(38,0)", "text": "string", "zeros": "bigint", "real": "double", "flag": "string"
    }
    got = df.collect()
    assert [str(r["big"]) for r in got] == columns["big"] and [r["id"] for r in got] == [int(x) for x in columns["id"]]
    assert [r["zeros"] for r in got] == [12, 5, 7] and got[0]["text"] == "9" * 39
