import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        shuffle_partitions=4,
        driver_memory="4g",
        warehouse=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(map(tuple, picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


@pytest.fixture()
def plan():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
