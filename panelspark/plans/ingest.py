"""Jobs that load files or directories into tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from panelspark.operators.tables import TableStore
from panelspark.operators.transforms import Transform
from panelspark.sources.hadoop import exists, is_file
from panelspark.sources.readers import load_directory, load_files

log = logging.getLogger(__name__)


def _present(found: bool, what: str, table: str, path: str, skip_missing: bool) -> bool:
    if found:
        return True
    if not skip_missing:
        raise FileNotFoundError(f"Nothing to fill {table} from: no {what.lower()} {path}")
    log.warning("%s stays as it is: no %s %s", table, what.lower(), path)
    return False


def load_files_into_tables(
    spark: SparkSession,
    table_files: Mapping[str, str],
    *,
    transforms: Sequence[Transform] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    overwrite: bool = True,
    skip_missing: bool = True,
    csv_infer_schema_length: int | None = None,
) -> dict[str, bool]:
    """One file per table; True where the table was written."""
    store, results = TableStore(spark), {}
    for table, path in table_files.items():
        path = str(path)
        results[table] = _present(is_file(path), "File", table, path, skip_missing) and (
            store.create_table_from(
                table,
                load_files(
                    spark,
                    [path],
                    transforms=transforms,
                    transform=transform,
                    csv_infer_schema_length=csv_infer_schema_length,
                ),
                overwrite,
            )
        )
    return results


def load_directories_into_tables(
    spark: SparkSession,
    table_directories: Mapping[str, str],
    *,
    extensions: Collection[str] | None = None,
    transforms: Sequence[Transform] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    overwrite: bool = True,
    skip_missing: bool = True,
    csv_infer_schema_length: int | None = None,
    should_load: bool = True,
) -> dict[str, bool]:
    """One directory per table; nothing at all is done unless ``should_load``."""
    if not should_load:
        return {}
    store, results = TableStore(spark), {}
    for table, directory in table_directories.items():
        directory = str(directory)
        results[table] = _present(
            exists(directory), "Directory", table, directory, skip_missing
        ) and store.create_table_from(
            table,
            load_directory(
                spark,
                directory,
                extensions=extensions,
                transforms=transforms,
                transform=transform,
                csv_infer_schema_length=csv_infer_schema_length,
            ),
            overwrite,
        )
    return results


def load_equity_eod(spark: SparkSession, csv_dir: str, table: str = "equity_eod") -> dict[str, bool]:
    """End-of-day stock prices: wide CSVs, one per index, to one long table."""
    from panelspark.operators.steps import build_transforms

    return load_directories_into_tables(
        spark,
        {table: csv_dir},
        extensions={".csv"},
        transforms=build_transforms(preset="equity"),
        csv_infer_schema_length=0,
    )


def load_world_bank(spark: SparkSession, topic_csv: str, indicators_csv: str) -> dict[str, bool]:
    """World Bank indicator values and their topics."""
    return load_files_into_tables(
        spark, {"topic_mapping": topic_csv, "indicators": indicators_csv}
    )
