"""Files behind a mount table: what is looked up agrees with what Spark reads and writes."""

import subprocess
import sys
import textwrap
from pathlib import Path

SCRIPT = """
import datetime as dt, sys
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.hadoop.fs.defaultFS", "viewfs://c/")
    .config("spark.hadoop.fs.viewfs.mounttable.c.link./data", f"file://{sys.argv[1]}/data")
    .config("spark.sql.warehouse.dir", f"file://{sys.argv[1]}/warehouse")
    .config("spark.checkpoint.dir", f"file://{sys.argv[1]}/scratch")
    .getOrCreate()
)
from panelspark.plans.rates import CorrelationArtefacts
from panelspark.operators.transforms import FileSource
from panelspark.sources.files import list_data_files
from panelspark.sources.hadoop import exists, is_file
from panelspark.sources.readers import load_directory, read_file
from panelspark.sources.snapshots import read_snapshot

spark.range(4).selectExpr("id AS v").coalesce(1).write.parquet("/data/x")
assert exists("/data/x") and not exists("/data/y") and not is_file("/data/x")
[name] = list_data_files("/data/x")
assert name.startswith("viewfs://c/data/x/part-"), name
assert read_file(spark, name).count() == 4 and load_directory(spark, "/data/x").count() == 4
seen = load_directory(spark, "/data/x", transforms=[FileSource()]).first()["file_source"]
assert seen == name, seen
spark.sql("SELECT 1 AS a, 2.5D AS b").coalesce(1).write.csv("/data/c", header=True)
assert load_directory(spark, "/data/c").dtypes == [("a", "bigint"), ("b", "double")]
spark.range(3).write.parquet("/data/snap/curves/2024-04-26/transformed/par")
assert read_snapshot(spark, "/data/snap", "curves", "2024-04-26")["par_rates"].count() == 3
panel = spark.range(12).selectExpr(
    "date_add(DATE'2024-01-01', CAST(id DIV 2 AS INT)) AS date", "IF(id % 2 = 0, 'a', 'b') AS source",
    "CAST(id * id % 7 AS DOUBLE) AS p")
kept = CorrelationArtefacts(spark, "/data/corr")
kept.write(panel, "zero_rates", tenors=["p"], windows=[3])
assert kept.read(panel, "zero_rates", windows=[3]).count() == 6 + 4
print("all agree")
"""


def test_default_file_system_is_a_mount_table(tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "run.py").write_text(textwrap.dedent(SCRIPT))
    done = subprocess.run(
        [sys.executable, str(tmp_path / "run.py"), str(tmp_path)],
        capture_output=True, text=True, timeout=300, cwd=tmp_path,
        env={**__import__("os").environ, "PYTHONPATH": str(Path(__file__).resolve().parents[1])},
    )
    assert done.returncode == 0 and "all agree" in done.stdout, done.stderr[-3000:]
