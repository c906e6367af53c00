"""Date coverage of dated tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """First date, last date and days between, per source and table.

    Each table has ``date`` and ``source``; its name becomes ``type``. Columns:
    ``start_date, end_date, source, type, coverage_days``, sorted.
    """
    parts = [
        df.groupBy("source")
        .agg(
            F.min(F.col("date").cast("date")).alias("start_date"),
            F.max(F.col("date").cast("date")).alias("end_date"),
        )
        .select(
            "start_date",
            "end_date",
            F.when(F.col("source") == "spot_fx_rates", "fx").otherwise(F.col("source")).alias("source"),
            F.lit(name).alias("type"),
        )
        for name, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("coverage_days", F.datediff("end_date", "start_date"))
        .orderBy("source", "type", "start_date", "end_date")
    )
