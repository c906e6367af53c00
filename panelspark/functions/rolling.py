"""Rolling Pearson and distance correlation of aligned series.

Both take (pairs, T) arrays with NaN for missing and read every window of every size
off prefix sums, so the cost hardly depends on the window sizes. For distance
correlation (Szekely, Rizzo, Bakirov 2007) the distances |x_i - x_j| of a block are
formed once; then

* the row sums a_i. over a window are differences of a prefix sum along rows,
* the sum of a_ij * b_ij over a window changes by one row entering and one leaving,
  each again a difference of such a prefix sum,

which is O(T^2 + T * W) per pair and block instead of O(T * W^2) per window size. In a block
of many dates no distance is kept: the row sums of the current window and its sum of
a_ij * b_ij are carried along, O(T * W) steps and O(T) numbers per pair. A single long window
takes O(W log W) by sorting and sums over the values that are smaller on both sides.

Prefix sums lose digits when a window is much quieter than the block around it, so
such windows (and constant ones) are recomputed from their own values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from numpy.lib.stride_tricks import as_strided

# Upper bound on the float64 cells of one work array, small enough for the cache.
_BATCH_CELLS = 1 << 16
# Windows recomputed at a time.
_REDO_ROWS = 4096
# Longer windows are computed by sorting, longer blocks without a table of distances.
_LONG_WINDOW, _LONG_BLOCK = 256, 512
# A window whose spread is below this share of the block's is recomputed.
_QUIET_SHARE = 1e-7
# Below this squared correlation the rounding of the numerator matters.
_SMALL_SQUARE = 1e-6


def distance_correlation_windows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance correlation of each row of two (k, W) arrays, NaN = missing.

    NaN where no position has both values, 0 where either side is constant.
    """
    k, width = x.shape
    out = np.full(k, np.nan)
    single, cells = (_direct, width * width) if width <= _LONG_WINDOW else (_by_sorting, width)
    step = max(1, _BATCH_CELLS // max(1, cells))
    for lo in range(0, k, step):
        out[lo : lo + step] = single(x[lo : lo + step], y[lo : lo + step])
    return out


def _by_sorting(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As :func:`_direct`, in O(W log W) time and O(W) numbers for each row."""
    ok = np.isfinite(x) & np.isfinite(y)
    n = ok.sum(axis=1)
    m = np.maximum(n, 1)

    def centred(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.where(ok, v, np.inf).min(axis=1), np.where(ok, v, -np.inf).max(axis=1)
        v = np.where(ok, v, 0.0)
        return np.where(ok, v - v.sum(axis=1, keepdims=True) / m[:, None], 0.0), low < high

    (x, varies_x), (y, varies_y) = centred(x), centred(y)
    a, b = _distance_sums(x, ok, n), _distance_sums(y, ok, n)

    def moment(product, total, rows):
        return product / m**2 + total / m**4 - 2.0 * rows / m**3

    def square(v, rows):
        product = 2.0 * (n * (v * v).sum(axis=1) - v.sum(axis=1) ** 2)
        return moment(product, rows.sum(axis=1) ** 2, (rows * rows).sum(axis=1))

    cov = moment(_product_sum(x, y, ok), a.sum(axis=1) * b.sum(axis=1), (a * b).sum(axis=1))
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.sqrt(np.clip(cov / np.sqrt(square(x, a) * square(y, b)), 0.0, None))
    value = np.where(varies_x & varies_y, value, 0.0)
    return np.where(n == 0, np.nan, value)


def _distance_sums(v: np.ndarray, ok: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of the distances of each value to all others of its row; 0 where missing."""
    order = np.argsort(np.where(ok, v, np.inf), axis=1)
    ranked = np.take_along_axis(v, order, 1)  # missing values are 0 and come last
    upto, rank = np.cumsum(ranked, axis=1), np.arange(v.shape[1])
    sums = ranked * (2 * rank + 2 - n[:, None]) - 2.0 * upto + upto[:, -1:]
    out = np.zeros_like(v)
    np.put_along_axis(out, order, sums, 1)
    return np.where(ok, out, 0.0)


def _product_sum(x: np.ndarray, y: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Sum over all i, j of |x_i - x_j| * |y_i - y_j| in each row.

    With i after j in the order of x, a product is (x_i - x_j)(y_i - y_j), negated unless y_j is
    smaller, too. Sums over the j that are smaller on both sides come from one pass for every
    power of two: the left half of each stretch of the order of x counts for its right half.
    """
    rows, width = x.shape
    order = np.argsort(np.where(ok, x, np.inf), axis=1)
    x, y, w = (np.take_along_axis(v, order, 1) for v in (x, y, ok.astype(float)))
    terms = np.stack([w, w * x, w * y, w * x * y])
    before = np.cumsum(terms, axis=2) - terms
    smaller = np.zeros_like(terms)
    by_y = np.argsort(y, axis=1, kind="stable")
    half = 1
    while half < width:
        stretch = np.argsort((by_y // (2 * half)).astype(np.int32), axis=1, kind="stable")
        place = np.take_along_axis(by_y, stretch, 1)  # stretch after stretch, each by rising y
        left = (place // half) % 2 == 0
        sums = np.cumsum(np.where(left, np.take_along_axis(terms, place[None], 2), 0.0), axis=2)
        sums = np.concatenate([np.zeros((4, rows, 1)), sums], axis=2)
        base = np.arange(width) // (2 * half) * (2 * half)
        found = np.zeros_like(terms)
        np.put_along_axis(found, np.broadcast_to(place, terms.shape), np.where(left, 0.0, sums[:, :, :-1] - sums[:, :, base]), 2)
        smaller += found
        half *= 2
    count, sum_x, sum_y, sum_xy = 2.0 * smaller - before
    return 2.0 * (w * (x * y * count - x * sum_y - y * sum_x + sum_xy)).sum(axis=1)


def _direct(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    ok = np.isfinite(x) & np.isfinite(y)
    n = ok.sum(axis=1)
    safe_n = np.maximum(n, 1)
    both = ok[:, :, None] & ok[:, None, :]

    def centred(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = np.where(ok, v, 0.0)
        d = np.abs(v[:, :, None] - v[:, None, :])
        d[~both] = 0.0
        row = d.sum(axis=2) / safe_n[:, None]
        total = row.sum(axis=1) / safe_n
        d = d - row[:, :, None] - row[:, None, :] + total[:, None, None]
        d[~both] = 0.0
        return d, total

    a, spread_x = centred(x)
    b, spread_y = centred(y)
    cov = np.einsum("kij,kij->k", a, b)
    var = np.sqrt(np.einsum("kij,kij->k", a, a)) * np.sqrt(np.einsum("kij,kij->k", b, b))
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.sqrt(np.clip(cov / var, 0.0, None))
    # mean distance 0 <=> every value equal: exact, unlike a variance threshold
    value = np.where((spread_x == 0.0) | (spread_y == 0.0) | (var == 0.0), 0.0, value)
    return np.where(n == 0, np.nan, value)


def rolling_distance_correlation(
    x: np.ndarray, y: np.ndarray, windows: Sequence[int], first: int = 0
) -> dict[int, np.ndarray]:
    """Rolling values at positions ``first`` .. ``T - 1`` of (pairs, T) arrays.

    NaN where the window is not full yet or has no position with both values.
    """
    length = x.shape[1]
    if length > _LONG_BLOCK:
        return _in_batches(_dcor_carried, x, y, windows, first, length)
    return _in_batches(_dcor_batch, x, y, windows, first, length**2)


def rolling_pearson(
    x: np.ndarray, y: np.ndarray, windows: Sequence[int], first: int = 0
) -> dict[int, np.ndarray]:
    """Rolling values at positions ``first`` .. ``T - 1`` of (pairs, T) arrays.

    Frames are shorter at the start. NaN below ``W // 3`` positions with both values
    and where a side is constant.
    """
    return _in_batches(_pearson_batch, x, y, windows, first, x.shape[1])


def _in_batches(kernel, x, y, windows, first: int, cells: int) -> dict[int, np.ndarray]:
    """Run a kernel on as many pairs at a time as its work arrays allow."""
    pairs, length = x.shape
    out = {w: np.full((pairs, length - first), np.nan) for w in windows}
    step = max(1, _BATCH_CELLS // max(1, cells))
    for lo in range(0, pairs, step):
        part = slice(lo, lo + step)
        for w, values in kernel(x[part], y[part], windows, first).items():
            out[w][part] = values
    return out


def _prefix(values: np.ndarray, axis: int) -> np.ndarray:
    """Prefix sums along ``axis`` with a leading zero."""
    shape = list(values.shape)
    shape[axis] += 1
    out = np.zeros(shape)
    tail = [slice(None)] * values.ndim
    tail[axis] = slice(1, None)
    np.cumsum(values, axis=axis, out=out[tuple(tail)])
    return out


def _column_prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of (pairs, T, T) along axis 1, row by row: faster than cumsum here."""
    pairs, length, width = values.shape
    out = np.empty((pairs, length + 1, width))
    out[:, 0] = 0.0
    for row in range(length):
        np.add(out[:, row], values[:, row], out=out[:, row + 1])
    return out


def _diagonal_bands(table: np.ndarray, row: int, start: int, count: int, width: int):
    """View whose entry (p, t, k) is ``table[p, row + t, start + t + k]``."""
    s0, s1, s2 = table.strides
    return as_strided(
        table[:, row:, start:],
        shape=(table.shape[0], count, width),
        strides=(s0, s1 + s2, s2),
        writeable=False,
    )


def _dcor_batch(
    x: np.ndarray, y: np.ndarray, windows: Sequence[int], first: int
) -> dict[int, np.ndarray]:
    pairs, length = x.shape
    ok = np.isfinite(x) & np.isfinite(y)
    seen = np.maximum(ok.sum(axis=1, keepdims=True), 1)
    weight = ok.astype(float)
    both = None if ok.all() else weight[:, :, None] * weight[:, None, :]

    def prepare(v: np.ndarray):
        v = np.where(ok, v, 0.0)
        v = np.where(ok, v - v.sum(axis=1, keepdims=True) / seen, 0.0)
        dist = v[:, :, None] - v[:, None, :]
        np.abs(dist, out=dist)
        if both is not None:
            dist *= both
        return dist, _column_prefix(dist), _prefix(v, 1), _prefix(v * v, 1)

    dist_x, rows_x, sum_x, sq_x = prepare(x)
    dist_y, rows_y, sum_y, sq_y = prepare(y)
    dist_x *= dist_y
    products = _column_prefix(dist_x)
    count = _prefix(weight, 1)
    row = np.arange(length)
    scale_x = length * sq_x[:, -1:]
    scale_y = length * sq_y[:, -1:]

    out: dict[int, np.ndarray] = {}
    for w in windows:
        result = np.full((pairs, length - first), np.nan)
        lowest = max(w, first + 1)
        if lowest <= length:
            end = np.arange(lowest, length + 1)  # exclusive
            start = end - w
            spots, begin = len(end), int(start[0])
            n = count[:, end] - count[:, start]
            m = np.maximum(n, 1.0)
            ax = _diagonal_bands(rows_x, lowest, begin, spots, w) - _diagonal_bands(
                rows_x, begin, begin, spots, w
            )
            ay = _diagonal_bands(rows_y, lowest, begin, spots, w) - _diagonal_bands(
                rows_y, begin, begin, spots, w
            )
            total_x, total_y = ax.sum(axis=2), ay.sum(axis=2)

            def moment(product, rows, total):
                return product / m**2 + total / m**4 - 2.0 * rows / m**3

            def squares(sq, sm):
                return 2.0 * (
                    n * (sq[:, end] - sq[:, start]) - (sm[:, end] - sm[:, start]) ** 2
                )

            # row t against the window before it comes in, row t - w goes out
            tail = np.maximum(row - w + 1, 0)
            change = products[:, row, row] - products[:, tail, row]
            old = row[w:] - w
            change[:, w:] -= products[:, old + w, old] - products[:, old + 1, old]
            cross = 2.0 * np.cumsum(change, axis=1)[:, end - 1]
            cov = moment(cross, np.einsum("ptw,ptw->pt", ax, ay), total_x * total_y)
            var_x = moment(squares(sq_x, sum_x), np.einsum("ptw,ptw->pt", ax, ax), total_x**2)
            var_y = moment(squares(sq_y, sum_y), np.einsum("ptw,ptw->pt", ay, ay), total_y**2)
            with np.errstate(invalid="ignore", divide="ignore"):
                square = cov / np.sqrt(var_x * var_y)
                trusted = (
                    (var_x * n**2 > _QUIET_SHARE * scale_x)
                    & (var_y * n**2 > _QUIET_SHARE * scale_y)
                    & (square > _SMALL_SQUARE)
                )
                value = np.sqrt(square)
            value[n == 1] = 0.0
            redo = np.argwhere(~trusted & (n > 1))
            if len(redo):
                p, t = redo[:, 0], redo[:, 1]
                take = start[t][:, None] + np.arange(w)[None, :]
                value[p, t] = distance_correlation_windows(
                    x[p[:, None], take], y[p[:, None], take]
                )
            value[n == 0] = np.nan
            result[:, lowest - 1 - first :] = value
        out[w] = result
    return out


def _dcor_carried(
    x: np.ndarray, y: np.ndarray, windows: Sequence[int], first: int
) -> dict[int, np.ndarray]:
    """As :func:`_dcor_batch` with what one window needs carried to the next."""
    pairs, length = x.shape
    ok = np.isfinite(x) & np.isfinite(y)
    weight = ok.astype(float)
    seen = np.maximum(ok.sum(axis=1, keepdims=True), 1)

    def prepare(v: np.ndarray):
        v = np.where(ok, v, 0.0)
        v = np.where(ok, v - v.sum(axis=1, keepdims=True) / seen, 0.0)
        return v, _prefix(v, 1), _prefix(v * v, 1)

    (vx, sum_x, sq_x), (vy, sum_y, sq_y) = prepare(x), prepare(y)
    count = _prefix(weight, 1)
    scale_x, scale_y = length * sq_x[:, -1], length * sq_y[:, -1]
    out: dict[int, np.ndarray] = {}
    for w in windows:
        result = np.full((pairs, length - first), np.nan)
        lowest = max(w, first + 1)
        rows_x, rows_y, cross = np.zeros_like(vx), np.zeros_like(vy), np.zeros(pairs)

        def distances(t: int, span: slice):
            both = weight[:, span] * weight[:, t, None]
            return both * np.abs(vx[:, span] - vx[:, t, None]), both * np.abs(vy[:, span] - vy[:, t, None])

        begin = max(0, lowest - w)  # the first window that is reported starts here
        for t in range(begin, length if lowest <= length else begin):
            start = max(begin, t + 1 - w)
            if t - w >= begin:  # the oldest value leaves
                dx, dy = distances(t - w, slice(start, t))
                rows_x[:, start:t] -= dx
                rows_y[:, start:t] -= dy
                cross -= 2.0 * np.einsum("pt,pt->p", dx, dy)
            dx, dy = distances(t, slice(start, t))
            rows_x[:, start:t] += dx
            rows_y[:, start:t] += dy
            rows_x[:, t], rows_y[:, t] = dx.sum(axis=1), dy.sum(axis=1)
            cross += 2.0 * np.einsum("pt,pt->p", dx, dy)
            if t + 1 < lowest:
                continue
            end, ax, ay = t + 1, rows_x[:, start : t + 1], rows_y[:, start : t + 1]
            n = count[:, end] - count[:, start]
            m = np.maximum(n, 1.0)
            total_x, total_y = ax.sum(axis=1), ay.sum(axis=1)

            def squares(sq, sm, rows, total):
                product = 2.0 * (n * (sq[:, end] - sq[:, start]) - (sm[:, end] - sm[:, start]) ** 2)
                return product / m**2 + total**2 / m**4 - 2.0 * np.einsum("pt,pt->p", rows, rows) / m**3

            cov = cross / m**2 + total_x * total_y / m**4 - 2.0 * np.einsum("pt,pt->p", ax, ay) / m**3
            var_x, var_y = squares(sq_x, sum_x, ax, total_x), squares(sq_y, sum_y, ay, total_y)
            with np.errstate(invalid="ignore", divide="ignore"):
                square = cov / np.sqrt(var_x * var_y)
                value = np.sqrt(square)
                trusted = (
                    (var_x * n**2 > _QUIET_SHARE * scale_x)
                    & (var_y * n**2 > _QUIET_SHARE * scale_y)
                    & (square > _SMALL_SQUARE)
                )
            value[n == 1] = 0.0
            redo = np.flatnonzero(~trusted & (n > 1))
            if len(redo):
                value[redo] = distance_correlation_windows(x[redo, start:end], y[redo, start:end])
            value[n == 0] = np.nan
            result[:, t - first] = value
        out[w] = result
    return out


def pearson_windows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pearson correlation of each row of two (k, W) arrays; NaN if a side is constant."""
    ok = np.isfinite(x) & np.isfinite(y)
    n = np.maximum(ok.sum(axis=1, keepdims=True), 1)

    def centred(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.where(ok, v, np.inf).min(axis=1)
        varies = np.where(ok, v, -np.inf).max(axis=1) > low
        v = np.where(ok, v, 0.0)
        return np.where(ok, v - v.sum(axis=1, keepdims=True) / n, 0.0), varies

    a, varies_a = centred(x)
    b, varies_b = centred(y)
    with np.errstate(invalid="ignore", divide="ignore"):
        norm = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
        value = np.clip((a * b).sum(axis=1) / norm, -1.0, 1.0)
    return np.where(varies_a & varies_b, value, np.nan)


def _pearson_batch(
    x: np.ndarray, y: np.ndarray, windows: Sequence[int], first: int
) -> dict[int, np.ndarray]:
    length = x.shape[1]
    ok = np.isfinite(x) & np.isfinite(y)
    seen = np.maximum(ok.sum(axis=1, keepdims=True), 1)

    def prepare(v: np.ndarray) -> np.ndarray:
        v = np.where(ok, v, 0.0)
        return np.where(ok, v - v.sum(axis=1, keepdims=True) / seen, 0.0)

    dx, dy = prepare(x), prepare(y)
    sums = [_prefix(v, 1) for v in (ok.astype(float), dx, dy, dx * dx, dy * dy, dx * dy)]
    end = np.arange(first + 1, length + 1)
    out: dict[int, np.ndarray] = {}
    for w in windows:
        start = np.maximum(end - w, 0)
        n, sx, sy, sxx, syy, sxy = (table[:, end] - table[:, start] for table in sums)
        m = np.maximum(n, 1.0)
        var_x, var_y = sxx - sx * sx / m, syy - sy * sy / m
        enough = (n >= w // 3) & (n >= 2)
        with np.errstate(invalid="ignore", divide="ignore"):
            value = np.clip((sxy - sx * sy / m) / np.sqrt(var_x * var_y), -1.0, 1.0)
        value[~enough] = np.nan
        trusted = (var_x > _QUIET_SHARE * sums[3][:, -1:]) & (
            var_y > _QUIET_SHARE * sums[4][:, -1:]
        )
        redo = np.argwhere(enough & ~trusted)
        for lo in range(0, len(redo), _REDO_ROWS):
            p, t = redo[lo : lo + _REDO_ROWS].T
            # frames cut off by the start of the block are filled up with missing
            take = end[t][:, None] - w + np.arange(w)[None, :]
            inside = take >= 0
            value[p, t] = pearson_windows(
                np.where(inside, x[p[:, None], take], np.nan),
                np.where(inside, y[p[:, None], take], np.nan),
            )
        out[w] = value
    return out
