import datetime as dt
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from panelspark.functions import rolling
from panelspark.functions.rolling import rolling_distance_correlation, rolling_pearson
from panelspark.operators.correlation import (
    correlation_matrix, rolling_correlation, tasks_for, window_correlations,
)


def brute_dcor(x, y):
    n = len(x)
    if n == 0:
        return np.nan
    if np.ptp(x) == 0 or np.ptp(y) == 0:
        return 0.0
    a, b = abs(x[:, None] - x), abs(y[:, None] - y)
    a = a - a.mean(0) - a.mean(1)[:, None] + a.mean()
    b = b - b.mean(0) - b.mean(1)[:, None] + b.mean()
    return np.sqrt(max((a * b).mean(), 0) / np.sqrt((a * a).mean() * (b * b).mean()))


def brute_pearson(x, y, window):
    if len(x) < max(window // 3, 2) or np.ptp(x) == 0 or np.ptp(y) == 0:
        return np.nan
    return np.corrcoef(x, y)[0, 1]


@pytest.mark.parametrize("first", [0, 25])
def test_kernels(first):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(9, 70)), rng.normal(size=(9, 70))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[0] = rng.integers(0, 2, 70)
    y[1] = 3.3
    y[2, 20:] = y[2, 20:] * 1e-9 + 5
    y[3] = np.nan
    x[4, 30:50] = 0.1
    windows = [1, 2, 3, 10, 26]
    pearson = rolling_pearson(x, y, windows, first)
    dcor = rolling_distance_correlation(x, y, windows, first)
    for w in windows:
        for p in range(9):
            for t in range(first, 70):
                a, b = x[p, max(0, t - w + 1) : t + 1], y[p, max(0, t - w + 1) : t + 1]
                ok = ~(np.isnan(a) | np.isnan(b))
                expected = brute_pearson(a[ok], b[ok], w)
                np.testing.assert_allclose(pearson[w][p, t - first], expected, atol=1e-6)
                expected = brute_dcor(a[ok], b[ok]) if t >= w - 1 else np.nan
                np.testing.assert_allclose(dcor[w][p, t - first], expected, atol=1e-6)


@pytest.fixture(scope="module")
def wide():
    """40 dates x 7 sources x 2 tenors with gaps, a constant and a silent source."""
    rng = np.random.default_rng(3)
    dates = pd.date_range("2019-12-20", periods=90)[rng.permutation(90)[:40]].sort_values()
    frame = pd.DataFrame(
        [(d.date(), f"s{k}", *rng.normal(size=2)) for d in dates for k in range(7)],
        columns=["date", "source", "a", "b"],
    )
    frame.loc[frame.source == "s1", "a"] = 2.5
    frame.loc[frame.source == "s2", ["a", "b"]] = np.nan
    frame.loc[rng.random(len(frame)) < 0.15, "b"] = np.nan
    gone = (rng.random(len(frame)) < 0.2) & (frame.source != "s0")
    lone = frame.date == dates[5].date()  # only one source reports that day
    return frame[~gone & (~lone | (frame.source == "s0"))].reset_index(drop=True)


@pytest.fixture(scope="module")
def expected(wide):
    out = {}
    for tenor in ("a", "b"):
        table = wide.pivot(index="date", columns="source", values=tenor).sort_index()
        for w in (5, 12):
            for i, left in enumerate(table.columns):
                for right in table.columns[i + 1 :]:
                    for t, day in enumerate(table.index):
                        cut = table[[left, right]].iloc[max(0, t - w + 1) : t + 1].dropna().to_numpy()
                        key = (day, tenor, left, right, w)
                        out[(*key, "pearson")] = brute_pearson(cut[:, 0], cut[:, 1], w)
                        if t >= w - 1:
                            out[(*key, "dcorr")] = brute_dcor(cut[:, 0], cut[:, 1])
    return out


@pytest.mark.parametrize("block,tile", [(None, 64), (11, 2), (16, 1)])
def test_against_brute_force(spark, wide, expected, block, tile):
    panel = spark.createDataFrame(wide, "date date, source string, a double, b double")
    df = window_correlations(panel, ["a", "b"], [5, 12], block=block, tile=tile)
    assert df.columns == [
        "date", "Correlation", "observable", "source1", "source2", "window_size", "corr_type"
    ]
    found = df.collect()
    got = {
        (r.date, r.observable, r.source1, r.source2, r.window_size, r.corr_type): r.Correlation
        for r in found
    }
    assert len(got) == len(found) and got.keys() == expected.keys()
    for key, value in expected.items():
        if np.isnan(value):
            assert got[key] is None, key
        else:
            assert got[key] == pytest.approx(value, abs=1e-8), key


def test_shorthands(spark, wide):
    panel = spark.createDataFrame(wide, "date date, source string, a double, b double")
    assert rolling_correlation(panel, 12, ["a"]).columns == [
        "date", "observable", "source1", "source2", "Correlation"
    ]
    # 40 dates: no full window of 65, so no distance correlation at all
    assert correlation_matrix(panel, tenors=["a"]).count() == 0
    assert correlation_matrix(panel, 40, ["a"]).count() == 21


def test_errors(spark):
    day = dt.date(2024, 1, 1)
    panel = spark.createDataFrame([(day, "x", 1.0), (day, "x", 2.0), (day, "y", 1.0)], "date date, source string, a double")
    with pytest.raises(Exception, match="duplicate .date, source"):
        rolling_correlation(panel, 3, ["a"]).collect()
    with pytest.raises(ValueError, match="positive"):
        window_correlations(panel, ["a"], [0])
    with pytest.raises(ValueError, match="methods"):
        window_correlations(panel, ["a"], [3], ["kendall"])
    assert rolling_correlation(panel.where("a > 9"), 3, ["a"]).count() == 0
    assert rolling_correlation(panel.where("source = 'y'"), 3, ["a"]).count() == 0


def test_two_shuffles_of_values(spark, wide, plan):
    """The values are shuffled once to pack them and once as packed arrays."""
    panel = spark.createDataFrame(wide, "date date, source string, a double, b double")
    text = plan(window_correlations(panel, ["a", "b"], [5, 12]))
    assert text.count("REPARTITION_BY_NUM") == 1 and text.count("REPARTITION_BY_COL") == 1
    assert "Cartesian" not in text and "NestedLoop" not in text and "Join" not in text
    assert text.count("ArrowEvalPython") == 1


def test_panel_is_read_twice(spark, wide, plan, tmp_path):
    panel = spark.createDataFrame(wide, "date date, source string, a double, b double")
    panel.write.parquet(str(tmp_path / "panel"))
    df = window_correlations(spark.read.parquet(str(tmp_path / "panel")), ["a", "b"], [5])
    text = df._jdf.queryExecution().executedPlan().toString()
    scans = {line.split("FileScan")[1].split("]")[0] for line in text.splitlines() if "FileScan" in line}
    assert len(scans) == 2 and "subquery" in text.lower()
    subqueries = {part.split()[0] for part in text.split("subquery#")[1:]}
    assert len({name.rstrip(",") for name in subqueries}) <= 8


def test_tasks_follow_the_work():
    assert tasks_for(100, 3, 1, [20]) == 1
    assert tasks_for(5000, 10_000, 13, [20, 90]) == -(-40 * 157 * 158 // 2 * 13 // 8)


def test_long_windows_by_sorting_and_carrying():
    rng = np.random.default_rng(3)
    for width in (3, 17, 64, 300):
        x = rng.standard_normal((6, width))
        y = np.where(rng.random(x.shape) < 0.5, x, rng.standard_normal(x.shape))
        x[rng.random(x.shape) < 0.2] = np.nan
        y[1], x[2] = 2.0, np.nan
        x[3], y[3] = np.round(x[3]), np.round(y[3])
        np.testing.assert_allclose(rolling._by_sorting(x, y), rolling._direct(x, y), atol=1e-7)
    x = rng.standard_normal((4, 400))
    y = x**2 + 0.3 * rng.standard_normal(x.shape)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[1, 50:200] = 3.0
    y[2] *= np.where(np.arange(400) < 200, 1e6, 1e-6)
    for first in (0, 90, 250):
        for windows in ([1, 2, 20], [100, 300], [399, 400, 401]):
            want = rolling._dcor_batch(x, y, windows, first)
            got = rolling._dcor_carried(x, y, windows, first)
            for w in windows:
                np.testing.assert_allclose(got[w], want[w], atol=1e-7)


def test_a_pair_at_a_window_of_ten_years_takes_little_memory():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1, 2700))
    y = x + rng.standard_normal(x.shape)
    tracemalloc.start()
    got = rolling.rolling_distance_correlation(x, y, [2520], 2519)[2520]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    want = rolling.distance_correlation_windows(x[:, -2520:], y[:, -2520:])
    np.testing.assert_allclose(got[:, -1], want, atol=1e-9)
