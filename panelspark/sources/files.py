"""Finding data files and learning their column layout.

Files of one directory may differ in format and columns. Spark reads such a set
wrongly if it is handed over as one scan (CSV columns are matched by position), so
files are first sorted into groups of equal layout. Spark tasks read the headers and
footers for this; the driver gets each distinct layout once.
"""

from __future__ import annotations

import csv
import io
import json
import os
import re
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.ipc
import pyarrow.parquet
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.names import c
from panelspark.sources import hadoop
from panelspark.sources.hadoop import exists, qualified

# File suffixes by kind of file.
KINDS = {".csv": "csv", ".feather": "ipc", ".ipc": "ipc", ".parquet": "parquet"}
SUPPORTED_EXTENSIONS = frozenset(KINDS)

# Integers beyond 64 bits, up to 38 digits; longer ones stay text.
_LONG_INTEGER = "decimal(38,0)"
# What texts of a CSV column look like, for Python and Java alike.
_INTEGER = r"[+-]?[0-9]+"
_FLOAT = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|-?Inf|NaN"
_BOOLEAN = r"[Tt][Rr][Uu][Ee]|[Ff][Aa][Ll][Ss][Ee]"


@dataclass(frozen=True)
class FileLayout:
    """What decides which scan a file belongs to."""

    path: str
    kind: str
    # CSV: JSON list of names; others: text of the stored schema
    columns: str
    # Arrow IPC: number of record batches
    batches: int = 0
    # the path without mount tables, for readers other than Spark's
    uri: str = ""
    # CSV: JSON list of the kinds of text seen in each column, if rows were looked at
    kinds: str | None = None


def suffix_of(path: str) -> str:
    return os.path.splitext(path)[1].lower()


def kind_of(path: str) -> str:
    kind = KINDS.get(suffix_of(path))
    if kind is None:
        supported = ", ".join(sorted(SUPPORTED_EXTENSIONS))
        raise ValueError(
            f"Unsupported file type {suffix_of(path)!r} for {path}. Supported: {supported}"
        )
    return kind


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system and inner path of a full URI (or a plain local path)."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)


def list_data_files(
    directory: str,
    extensions: Collection[str] | None = None,
    *,
    recursive: bool = False,
) -> list[str]:
    """Sorted paths of the data files in a directory, which must hold at least one.

    Suffixes are compared in lower case. Subdirectories are skipped unless
    ``recursive``. Names Spark would silently ignore raise instead.
    """
    wanted = SUPPORTED_EXTENSIONS if extensions is None else frozenset(extensions)
    root, found, hidden = qualified(directory).rstrip("/"), [], []
    full = re.sub(r"^file:/+", "/", hadoop.resolved(directory) if root.startswith("/") else root).rstrip("/")
    for path in hadoop.list_files(directory, recursive) if exists(directory) else ():
        relative = re.sub(r"^file:/+", "/", path).removeprefix(re.sub(r"^file:/+", "/", full)).lstrip("/")
        if suffix_of(relative) in wanted:
            is_hidden = any(part[0] in "._" for part in relative.split("/"))
            (hidden if is_hidden else found).append(f"{root}/{relative}")
    if hidden:
        raise ValueError(f"Spark does not read names starting with '_' or '.': {sorted(hidden)}")
    if not found:
        raise FileNotFoundError(f"{directory} holds no file ending in {', '.join(sorted(wanted))}")
    return sorted(found)


def inspect_file(path: str, infer_rows: int | None = None) -> FileLayout:
    """Layout of one file (a full URI), from its header or footer, and of a CSV file the kinds of
    text in its first ``infer_rows`` rows if a number is given."""
    kind = kind_of(path)
    system, inner = opened(path)
    if kind == "parquet" and system.get_file_info(inner).type == fs.FileType.Directory:
        return FileLayout(path, kind, f"dataset {path}")  # a folder of parts, one scan
    if kind == "parquet":
        with system.open_input_file(inner) as handle:
            schema = pyarrow.parquet.read_schema(handle)
        return FileLayout(path, kind, schema.remove_metadata().to_string())
    if kind == "ipc":
        with system.open_input_file(inner) as handle, pa.ipc.open_file(handle) as reader:
            schema = reader.schema.remove_metadata().to_string()
            return FileLayout(path, kind, schema, reader.num_record_batches)
    with system.open_input_stream(inner, compression=None) as handle:
        lines = io.TextIOWrapper(io.BufferedReader(handle, 1 << 16), "utf-8-sig", newline="")
        header, kinds = _csv_head(path, csv.reader(lines), infer_rows)
    return FileLayout(path, kind, json.dumps(header), kinds=kinds and json.dumps(kinds))


def _csv_head(path: str, rows: Iterator[list[str]], infer_rows: int | None):
    header = next(rows, None)
    if not header:
        raise ValueError(f"CSV file {path} has no header")
    if len(set(header)) != len(header):
        raise ValueError(f"CSV file {path} repeats column names: {header}")
    if not infer_rows:
        return header, None
    seen: list[set[str]] = [set() for _ in header]
    for _, row in zip(range(infer_rows), rows):
        for kinds, text in zip(seen, row):
            if text:
                kinds.add(_type_of(text))
    return header, [sorted(kinds) for kinds in seen]


def _type_of(text: str) -> str:
    if re.fullmatch(_INTEGER, text):
        if -(1 << 63) <= int(text) < 1 << 63:
            return "bigint"
        return _LONG_INTEGER if len(text.lstrip("+-")) <= 38 else "string"
    if re.fullmatch(_FLOAT, text):
        return "double"
    return "boolean" if re.fullmatch(_BOOLEAN, text) else "string"


def column_type(kinds: Collection[str]) -> str:
    """One type for the texts of a column; dates stay text, mixed columns too.

    Integers of any length stay exact; only fractions among them make a column double."""
    kinds = set(kinds)
    if len(kinds) == 1:
        return kinds.pop()
    if kinds == {"bigint", _LONG_INTEGER}:
        return _LONG_INTEGER
    return "double" if "double" in kinds and kinds <= {"bigint", _LONG_INTEGER, "double"} else "string"


def kinds_of_all(texts: DataFrame) -> list[list[str]]:
    """The kinds of text in each column over all rows, in one aggregate."""

    def kinds(name: str) -> Column:
        text, looks = c(name), lambda pattern: c(name).rlike(rf"^(?:{pattern})\z")
        digits = F.length(F.regexp_replace(text, "^[+-]", ""))
        integer = F.when(text.try_cast("bigint").isNotNull(), "bigint").when(digits <= 38, _LONG_INTEGER).otherwise("string")
        kind = F.when(looks(_INTEGER), integer).when(looks(_FLOAT), "double").when(looks(_BOOLEAN), "boolean")
        return F.collect_set(F.when(text.isNotNull(), kind.otherwise("string")))  # five values at most

    names = texts.columns
    if not names:
        return []
    found = texts.agg(*[kinds(name).alias(f"c{i}") for i, name in enumerate(names)]).first()
    return [sorted(found[f"c{i}"]) for i in range(len(names))]


def inspect_files(
    spark: SparkSession, paths: Iterable[str], infer_rows: int | None = None
) -> list[FileLayout]:
    """Layouts of files; a distinct layout comes to the driver once, a file as a few numbers."""
    paths = [qualified(path) for path in paths]
    for path in paths:
        kind_of(path)  # unsupported suffixes fail before anything is read
    folders = {folder: hadoop.resolved(folder) for folder in {os.path.dirname(p) for p in paths}}
    uris = [f"{folders[os.path.dirname(p)].rstrip('/')}/{os.path.basename(p)}" for p in paths]

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("number", pa.int64()), ("kind", pa.string()), ("columns", pa.string())]
        fields += [("batches", pa.int64()), ("kinds", pa.string())]
        for batch in batches:
            found = [vars(inspect_file(uri, infer_rows)) for uri in batch.column(1).to_pylist()]
            rows = [{"number": n} | layout for n, layout in zip(batch.column(0).to_pylist(), found)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    rows = (
        spark.createDataFrame(list(enumerate(uris)), "number bigint, uri string")
        .repartition(tasks)
        .mapInArrow(inspect, "number bigint, kind string, columns string, batches bigint, kinds string")
        .withColumn("layout", F.xxhash64("kind", "columns"))
        .persist()
    )
    try:
        layouts = {
            row["layout"]: row
            for row in rows.groupBy("layout", "kind", "columns").agg(F.collect_set("kinds").alias("kinds")).collect()
        }
        files = rows.select("number", "layout", "batches").collect()
    finally:
        rows.unpersist()
    out = []
    for row in sorted(files, key=lambda row: paths[row["number"]]):
        layout = layouts[row["layout"]]
        merged = [sorted(set().union(*column)) for column in zip(*map(json.loads, layout["kinds"]))]
        made = FileLayout(paths[row["number"]], layout["kind"], layout["columns"], row["batches"])
        out.append(replace(made, uri=uris[row["number"]], kinds=json.dumps(merged) if merged else None))
    return out
