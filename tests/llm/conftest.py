import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def docs(spark):
    """A documents table from (doc_id, text) or longer rows; further columns with clashing names on demand."""

    def make(rows, clash=False, parts=3):
        full = [(*r, *([None] * (4 - len(r))), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        if clash:
            names = ("component", "digest", "chunk", "size", "taken", "key", "label", "bucket", "node", "rep", "_l", "code")
            for name in names:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture()
def found():
    """Rows of a result as a sorted list of tuples of some columns."""

    def collect(df, *columns):
        rows = [tuple(r) for r in df.select(*columns).collect()]
        return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))

    return collect
