"""Arrow IPC (Feather) files as a Spark data source.

A file is split by ranges of record batches, so a large file is read by many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.ipc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

from panelspark.names import PATH_COL
from panelspark.sources.files import inspect_file, opened

FORMAT = "panelspark_ipc"
# Record batches per task; writers commonly put 64k rows or more in one.
_BATCHES_PER_TASK = 16

# Arrow types Spark has no counterpart for, and the type that holds their values.
_WIDER = {
    pa.uint8(): pa.int16(),
    pa.uint16(): pa.int32(),
    pa.uint32(): pa.int64(),
    pa.uint64(): pa.decimal128(20, 0),
    pa.large_string(): pa.string(),
    pa.string_view(): pa.string(),
    pa.large_binary(): pa.binary(),
    pa.binary_view(): pa.binary(),
    pa.date64(): pa.date32(),
    pa.float16(): pa.float32(),
}


def readable_type(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_dictionary(kind):
        return readable_type(kind.value_type)
    if pa.types.is_timestamp(kind):
        return pa.timestamp("us", kind.tz)
    if pa.types.is_large_list(kind) or pa.types.is_list(kind):
        return pa.list_(readable_type(kind.value_type))
    if pa.types.is_null(kind):
        return pa.string()
    return _WIDER.get(kind, kind)


def readable_schema(schema: pa.Schema) -> pa.Schema:
    return pa.schema([pa.field(f.name, readable_type(f.type), f.nullable) for f in schema])


@dataclass
class BatchRange(InputPartition):
    uri: str
    path: str
    start: int
    stop: int


class ArrowIpcSource(DataSource):
    """Options: ``files``, a JSON list of [URI, number of record batches or null, path to show];
    ``columns``, a JSON list of the columns to read; ``path_column``, whether rows carry their path."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _files(self) -> list[tuple[str, int | None, str]]:
        if "files" in self.options:
            return [tuple(entry) for entry in json.loads(self.options["files"])]
        return [(self.options["path"], None, self.options["path"])]

    def _columns(self) -> pa.Schema:
        system, inner = opened(self._files()[0][0])
        with system.open_input_file(inner) as handle, pa.ipc.open_file(handle) as reader:
            schema = readable_schema(reader.schema)
        wanted = self.options.get("columns")
        if wanted is None:
            return schema
        missing = [name for name in json.loads(wanted) if name not in schema.names]
        if missing:
            raise ValueError(f"No columns {missing} in {self._files()[0][2]}; it has {schema.names}")
        return pa.schema([schema.field(name) for name in json.loads(wanted)])

    def _with_path(self) -> bool:
        return self.options.get("path_column", "True") == "True"

    def schema(self):
        columns = self._columns()
        if self._with_path():
            columns = columns.append(pa.field(PATH_COL, pa.string()))
        return from_arrow_schema(columns, prefer_timestamp_ntz=True)

    def reader(self, schema):
        return _Reader(self._files(), self._columns(), self._with_path())


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int | None, str]], columns: pa.Schema, with_path: bool):
        self._files = files
        self._columns = columns
        self._with_path = with_path

    def partitions(self) -> list[BatchRange]:
        ranges = []
        for uri, batches, path in self._files:
            if batches is None:
                batches = inspect_file(uri).batches
            for start in range(0, batches, _BATCHES_PER_TASK):
                ranges.append(BatchRange(uri, path, start, min(start + _BATCHES_PER_TASK, batches)))
        return ranges or [BatchRange(self._files[0][0], self._files[0][2], 0, 0)]

    def read(self, partition: BatchRange) -> Iterator[pa.RecordBatch]:
        system, inner = opened(partition.uri)
        with system.open_input_file(inner) as handle:
            with pa.ipc.open_file(handle) as reader:
                names = reader.schema.names
            # a file stores its columns apart: those not named are not read
            chosen = pa.ipc.IpcReadOptions(included_fields=[names.index(n) for n in self._columns.names])
            with pa.ipc.open_file(handle, options=chosen) as reader:
                for number in range(partition.start, partition.stop):
                    yield self._shaped(reader.get_batch(number), partition.path)

    def _shaped(self, batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
        columns = [batch.column(field.name).cast(field.type) for field in self._columns]
        schema = self._columns
        if self._with_path:
            columns.append(pa.repeat(path, batch.num_rows))
            schema = schema.append(pa.field(PATH_COL, pa.string()))
        return pa.RecordBatch.from_arrays(columns, schema=schema)
