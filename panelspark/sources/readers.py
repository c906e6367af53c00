"""Scans: single files, groups of files with equal layout, whole directories."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.names import PATH_COL, c, check_case_collisions, q
from panelspark.operators.concat import strict_concat
from panelspark.operators.transforms import Transform, apply_transforms
from panelspark.sources.arrow_ipc import FORMAT, ArrowIpcSource
from panelspark.sources.files import (
    FileLayout,
    column_type,
    inspect_files,
    kinds_of_all,
    list_data_files,
)
from panelspark.sources.hadoop import is_file


def source_path() -> Column:
    """Decoded path of the file each row was read from.

    ``_metadata.file_path`` is a percent-encoded URI in which ``+`` stands for
    itself; the scheme is removed for local files only.
    """
    path = F.col("_metadata.file_path")
    local = (
        F.when(path.startswith("file:///"), F.substr(path, F.lit(8)))
        .when(path.startswith("file:/"), F.substr(path, F.lit(6)))
        .otherwise(path)
    )
    return F.url_decode(F.replace(local, F.lit("+"), F.lit("%2B")))


def with_source_path(df: DataFrame) -> DataFrame:
    """Keep the path of the scanned file alongside the data."""
    return df if PATH_COL in df.columns else df.withColumn(PATH_COL, source_path())


def _literal_path(path: str) -> str:
    """Spark expands patterns in paths; names holding such characters are escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _csv_types(spark: SparkSession, files: Sequence[FileLayout], infer_rows: int | None, read) -> list[str]:
    """Types of CSV columns: text for 0 rows, by the rows looked at, or else by all rows of all files."""
    names = json.loads(files[0].columns)
    if infer_rows == 0:
        return ["string"] * len(names)
    if infer_rows is None:
        return list(map(column_type, kinds_of_all(read(["string"] * len(names)))))
    return list(map(column_type, json.loads(files[0].kinds or "[]") or [[]] * len(names)))


def scan_group(
    spark: SparkSession,
    files: Sequence[FileLayout],
    multiline: bool = False,
    infer_rows: int | None = None,
    columns: Sequence[str] | None = None,
    with_path: bool = True,
) -> DataFrame:
    """One scan over files of equal layout, of some or all columns, with :data:`PATH_COL` if asked for."""
    kind, paths = files[0].kind, [_literal_path(layout.path) for layout in files]
    if kind == "ipc":
        spark.dataSource.register(ArrowIpcSource)
        listed = json.dumps([[layout.uri, layout.batches, layout.path] for layout in files])
        reader = spark.read.format(FORMAT).option("files", listed).option("path_column", str(with_path))
        if columns is not None:
            reader = reader.option("columns", json.dumps(list(columns)))
        df = reader.load()
        check_case_collisions(df.columns)
        return df
    if kind == "parquet":
        df = spark.read.parquet(*paths)
    else:
        names = json.loads(files[0].columns)
        check_case_collisions(names)

        def read(kinds: Sequence[str]) -> DataFrame:
            return (
                spark.read.schema(", ".join(f"{q(name)} {kind}" for name, kind in zip(names, kinds)))
                .option("header", True)
                # a file whose header differs, or a value that does not fit, must fail
                .option("enforceSchema", False)
                .option("mode", "FAILFAST")
                .option("escape", '"')
                .option("multiLine", multiline)
                .csv(paths)
            )

        df = read(_csv_types(spark, files, infer_rows, read))
    check_case_collisions(df.columns)
    if columns is not None:
        df = df.select(*map(c, columns))
    return with_source_path(df) if with_path else df


def scan_files(
    spark: SparkSession,
    paths: Iterable[str],
    *,
    csv_infer_schema_length: int | None = None,
    csv_multiline: bool = False,
    columns: Sequence[str] | None = None,
    with_path: bool = True,
) -> list[tuple[DataFrame, list[str]]]:
    """Scans of ``paths``, one per distinct layout, each with the paths it covers."""
    groups: dict[tuple[str, str], list[FileLayout]] = defaultdict(list)
    for layout in inspect_files(spark, paths, csv_infer_schema_length):
        groups[layout.kind, layout.columns].append(layout)
    return [
        (
            scan_group(spark, files, csv_multiline, csv_infer_schema_length, columns, with_path),
            [layout.path for layout in files],
        )
        for files in groups.values()
    ]


def read_file(
    spark: SparkSession,
    path: str,
    *,
    csv_infer_schema_length: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A parquet, CSV, Feather or Arrow IPC file, or some of its columns.

    CSV columns are typed by all rows, in a pass of its own; with
    ``csv_infer_schema_length`` by that many rows of each file, 0 leaving every column a
    string. Dates stay strings.
    """
    [(df, _)] = scan_files(
        spark,
        [str(path)],
        csv_infer_schema_length=csv_infer_schema_length,
        columns=columns,
        with_path=False,
    )
    return df


def load_files(
    spark: SparkSession,
    paths: Iterable[str],
    *,
    transforms: Sequence[Transform] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    csv_infer_schema_length: int | None = None,
    csv_multiline: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scan, transform and concatenate files; layouts must agree *after* the transforms."""
    scans = scan_files(
        spark,
        paths,
        csv_infer_schema_length=csv_infer_schema_length,
        csv_multiline=csv_multiline,
        columns=columns,
        with_path=transform is not None or any(step.needs_path for step in transforms or ()),
    )
    parts = []
    for df, files in scans:
        df = apply_transforms(df, transforms or (), files=files)
        if transform is not None:
            df = transform(df)
        parts.append(df.drop(PATH_COL))
    return strict_concat(parts)


def load_directory(
    spark: SparkSession,
    directory: str,
    *,
    extensions: Collection[str] | None = None,
    transforms: Sequence[Transform] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    csv_infer_schema_length: int | None = None,
    csv_multiline: bool = False,
    columns: Sequence[str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """All matching files of a directory as one DataFrame.

    ``transforms`` run on each group of equal layout, then ``transform``, a function
    ``DataFrame -> DataFrame`` that finds the file path in ``PATH_COL``.
    """
    return load_files(
        spark,
        list_data_files(str(directory), extensions, recursive=recursive),
        transforms=transforms,
        transform=transform,
        csv_infer_schema_length=csv_infer_schema_length,
        csv_multiline=csv_multiline,
        columns=columns,
    )


def require_file(path: str) -> str:
    if not is_file(str(path)):
        raise FileNotFoundError(f"There is no file {path}")
    return str(path)
