"""Session set-up shared by scripts, tests and the benchmark."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "panelspark",
    *,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    warehouse: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    configuration and AQE decide. Local runs pass both.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate files that every executor can reach.

    Lies in the shared folder named by ``spark.checkpoint.dir``. Where that is unset, a local
    session (one process) uses a temporary folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "panelspark-scratch")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
