"""Rolling pairwise correlation over (date x source) panels."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.config import DEFAULT_TENORS, DEFAULT_WINDOWS
from panelspark.functions.rolling import rolling_distance_correlation, rolling_pearson
from panelspark.names import c
from panelspark.operators.panel import Layout, PanelIndex, packed_series, source_pairs

PEARSON = "pearson"
DCORR = "dcorr"

# Dates owned by one block. Blocks overlap by the longest window, so a block is
# never shorter than that and a date is copied into two blocks at most.
BLOCK_DATES = 128
# Sources per tile of the pair join.
TILE_SOURCES = 64


def _as_matrix(lists: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    """Rows of a list<double> column, all ``length`` long, as a matrix; null -> NaN."""
    flat = lists.take(pa.array(rows)).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), length)


# The rolling function of each method; both cover the dates after an overlap.
_KERNELS = {PEARSON: rolling_pearson, DCORR: rolling_distance_correlation}


def _rolling_udf(methods: Sequence[str], windows: Sequence[int]):
    """Arrow function: (x, y, overlap) -> a list of values per method and window size.

    Built-in sliding frames would do for Pearson, but they walk each frame anew for
    every row: 50 microseconds per date and pair with the default windows, against
    well under one here.
    """
    names = {(method, w): f"{method}_{w}" for method in methods for w in windows}
    schema = T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in names.values()])
    kernels = {method: _KERNELS[method] for method in methods}
    windows = tuple(windows)

    @F.arrow_udf(schema)
    def rolling(x: pa.Array, y: pa.Array, overlap: pa.Array) -> pa.Array:
        lengths, skip = np.asarray(x.value_lengths()), np.asarray(overlap)
        sizes = lengths - skip
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = {key: np.full(offsets[-1], np.nan) for key in names}
        # the blocks of a batch share one shape, but for the ends of the calendar
        for length, first in {*zip(lengths.tolist(), skip.tolist())}:
            rows = np.flatnonzero((lengths == length) & (skip == first))
            spots = offsets[rows][:, None] + np.arange(length - first)[None, :]
            a, b = _as_matrix(x, rows, length), _as_matrix(y, rows, length)
            for method, kernel in kernels.items():
                for w, values in kernel(a, b, windows, first).items():
                    flat[method, w][spots] = values
        bounds = pa.array(offsets.astype(np.int32))
        columns = [
            pa.ListArray.from_arrays(bounds, pa.array(values, mask=np.isnan(values)))
            for values in flat.values()
        ]
        return pa.StructArray.from_arrays(columns, names=list(names.values()))

    return rolling


def window_correlations(
    panel: DataFrame,
    observables: Sequence[str] = DEFAULT_TENORS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    methods: Sequence[str] = (PEARSON, DCORR),
    *,
    block: int | None = None,
    tile: int = TILE_SOURCES,
    tasks: int | None = None,
) -> DataFrame:
    """Rolling correlations of every source pair, all windows and methods at once.

    ``panel`` has ``date``, ``source`` and one numeric column per observable. Rows
    without a date are left out; NaN and infinite values count as missing.
    Result: ``date, Correlation, observable, source1, source2, window_size,
    corr_type`` with ``source1 < source2``. ``tasks`` divides the work over more tasks than
    there are shuffle partitions; :func:`tasks_for` tells how many it is worth.

    * ``pearson``: a row for every calendar date and pair; partial frames count,
      null below ``window // 3`` complete observations.
    * ``dcorr``: a row for every full window and pair; null without any overlap.
    """
    unknown = [m for m in methods if m not in (PEARSON, DCORR)]
    if unknown or not methods:
        raise ValueError(f"methods must be from {(PEARSON, DCORR)}, got {list(methods)}")
    windows, observables = list(dict.fromkeys(windows)), list(dict.fromkeys(observables))
    if not windows or min(windows) < 1:
        raise ValueError(f"window sizes must be positive, got {list(windows)}")
    reach = max(windows) - 1
    layout = Layout(block=max(block or BLOCK_DATES, reach, 1), reach=reach, tile=tile)
    panel = panel.select(
        F.col("date").cast("date").alias("date"),
        # a missing source is a source of its own
        F.coalesce(F.col("source").cast("string"), F.lit("null")).alias("source"),
        *[c(name).cast("double").alias(name) for name in observables],
    )
    index = PanelIndex(panel, layout.tile)
    pairs = source_pairs(packed_series(panel, observables, index, layout), tasks)
    lists = [f"{method}_{w}" for method in methods for w in windows]
    results = [
        f"struct({w} AS window_size, '{method}' AS corr_type, cell.{method}_{w} AS Correlation)"
        for method in methods
        for w in windows
    ]
    return (
        pairs.select(
            "observable", "source1", "source2", "block",
            _rolling_udf(methods, windows)("x", "y", F.expr(f"int({layout.overlap})")).alias("r"),
        )
        .select("observable", "source1", "source2", "block", "r.*")
        .selectExpr(
            "observable", "source1", "source2", "block",
            f"posexplode(arrays_zip({', '.join(lists)})) AS (pos, cell)",
        )
        .selectExpr(
            "observable", "source1", "source2",
            f"int(block * {layout.block} + pos) AS d_idx",
            f"inline(array({', '.join(results)}))",
        )
        # distance correlation is reported for full windows only
        .where(f"corr_type = '{PEARSON}' OR d_idx >= window_size - 1")
        .select(
            index.date_at(F.col("d_idx")).alias("date"),
            "Correlation", "observable", "source1", "source2", "window_size", "corr_type",
        )
    )


# Pair blocks (two tiles of sources over one block of dates, one observable) per task.
_PAIR_BLOCKS = 8


def tasks_for(
    dates: int, sources: int, observables: int, windows: Sequence[int], tile: int = TILE_SOURCES
) -> int:
    """Tasks that a panel of this size is worth."""
    block = max(BLOCK_DATES, max(windows) - 1)
    tiles = -(-max(sources, 1) // tile)
    return -(-(-(-dates // block) * tiles * (tiles + 1) // 2 * observables) // _PAIR_BLOCKS)


def rolling_correlation(
    panel: DataFrame,
    window: int = 252,
    tenors: Sequence[str] = DEFAULT_TENORS,
    use_dcor: bool = False,
    **layout,
) -> DataFrame:
    """One window size, one method: ``date, observable, source1, source2, Correlation``."""
    method = DCORR if use_dcor else PEARSON
    return window_correlations(panel, tenors, [window], [method], **layout).select(
        "date", "observable", "source1", "source2", "Correlation"
    )


def correlation_matrix(
    panel: DataFrame,
    window: int = 65,
    tenors: Sequence[str] = DEFAULT_TENORS,
    use_dcor: bool = True,
    **layout,
) -> DataFrame:
    """:func:`rolling_correlation` with the defaults of a correlation-matrix request."""
    return rolling_correlation(panel, window, tenors, use_dcor, **layout)
