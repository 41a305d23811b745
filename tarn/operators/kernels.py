"""Dense raster kernels on stacks (n, height, width), applied to flat array columns in Arrow batches.

Arithmetic is in double. Edges are replicated. Scenes of one size in a batch go through a kernel together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.functions.physics import FLOOR, INCIDENCE, inverse_array

NO_LAND_KM = 1000.0


def _to_linear(db: np.ndarray) -> np.ndarray:
    return 10.0 ** (db / 10.0)


def _to_db(linear: np.ndarray) -> np.ndarray:
    return 10.0 * np.log10(np.maximum(linear, FLOOR))


def incidence_ramp(n: int, height: int, width: int, near: float = INCIDENCE[0], far: float = INCIDENCE[1], axis: int = 1) -> np.ndarray:
    """Linear from near to far range along columns (1) or rows (0)."""
    line = np.linspace(near, far, width if axis == 1 else height)
    return np.broadcast_to(line[None, None, :] if axis == 1 else line[None, :, None], (n, height, width))


def box_mean(x: np.ndarray, size: int) -> np.ndarray:
    """Mean of a size x size window, two separable passes."""
    if size <= 1:
        return x.astype(float)
    before, after = size // 2, size - 1 - size // 2
    _, h, w = x.shape
    rows = np.pad(x.astype(float), ((0, 0), (before, after), (0, 0)), mode="edge")
    acc = sum(rows[:, k : k + h] for k in range(size))
    cols = np.pad(acc, ((0, 0), (0, 0), (before, after)), mode="edge")
    return sum(cols[:, :, k : k + w] for k in range(size)) / (size * size)


def block_mean(x: np.ndarray, block: int) -> np.ndarray:
    n, h, w = x.shape
    x = np.pad(x.astype(float), ((0, 0), (0, -h % block), (0, -w % block)), mode="edge")
    return x.reshape(n, x.shape[1] // block, block, x.shape[2] // block, block).mean(axis=(2, 4))


def rank_filter(x: np.ndarray, size: int, percentile: float) -> np.ndarray:
    """Order statistic of the window at rank int(size^2 * percentile / 100), without interpolation; an even window reaches one further back."""
    before, after = size // 2, size - 1 - size // 2
    _, h, w = x.shape
    padded = np.pad(x, ((0, 0), (before, after), (before, after)), mode="edge")
    stack = np.stack([padded[:, i : i + h, j : j + w] for i in range(size) for j in range(size)])
    rank = min(int(size * size * percentile / 100), size * size - 1)
    return np.partition(stack, rank, axis=0)[rank]


def upsample(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, corners on corners."""
    _, ny, nx = x.shape

    def axis(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(size) * ((n - 1) / (size - 1) if size > 1 else 0.0)
        low = np.minimum(at.astype(int), max(n - 2, 0))
        return low, np.minimum(low + 1, n - 1), at - low

    r0, r1, fr = axis(ny, height)
    c0, c1, fc = axis(nx, width)
    rows = x[:, r0] * (1 - fr)[None, :, None] + x[:, r1] * fr[None, :, None]
    return rows[:, :, c0] * (1 - fc) + rows[:, :, c1] * fc


def background_sigma0(linear: np.ndarray, block: int = 64, percentile: float = 85.0, neighbourhood: int = 5) -> np.ndarray:
    """Background level: block means, a rank filter over blocks, bilinear upsampling."""
    _, h, w = linear.shape
    means = block_mean(linear, block)
    if means.shape[1] * means.shape[2] > 1:
        means = rank_filter(means, min(neighbourhood, max(means.shape[1:])), percentile)
        return upsample(means, h, w)
    return np.broadcast_to(means, linear.shape).copy()


def damping_db(vv_db: np.ndarray, block: int = 64, percentile: float = 85.0, looks: int = 5, neighbourhood: int = 5) -> np.ndarray:
    linear = _to_linear(vv_db)
    return _to_db(background_sigma0(linear, block, percentile, neighbourhood)) - _to_db(box_mean(linear, looks))


def local_variance_db(vv_db: np.ndarray, size: int = 7) -> np.ndarray:
    return np.maximum(box_mean(vv_db * vv_db, size) - box_mean(vv_db, size) ** 2, 0.0)


def wind_ms(vv_db: np.ndarray, incidence: np.ndarray | None = None, phi: float = 45.0, block: int = 64, percentile: float = 85.0) -> np.ndarray:
    angle = incidence_ramp(*vv_db.shape) if incidence is None else incidence
    return inverse_array(background_sigma0(_to_linear(vv_db), block, percentile), np.clip(angle, *INCIDENCE), phi)


def _lower_envelope(f: np.ndarray) -> np.ndarray:
    """min over k of f[:, k] + (x - k)^2 for every x: of each line the parabolas that are lowest somewhere, all lines at a time.

    A line takes a parabola in and out once, so the work grows with the number of pixels."""
    lines, w = f.shape
    each = np.arange(lines)
    lowest = np.zeros((lines, w), dtype=np.int64)
    since = np.full((lines, w + 1), np.inf)
    since[:, 0] = -np.inf
    top = np.zeros(lines, dtype=np.int64)
    height = f + np.arange(w) ** 2
    for q in range(1, w):
        rows, cross = each, np.empty(lines)
        while len(rows):
            v = lowest[rows, top[rows]]
            cross[rows] = (height[rows, q] - height[rows, v]) / (2 * (q - v))
            rows = rows[cross[rows] <= since[rows, top[rows]]]
            top[rows] -= 1
        top += 1
        lowest[each, top], since[each, top] = q, cross
    since[each, top + 1] = np.inf
    out, at = np.empty_like(f), np.zeros(lines, dtype=np.int64)
    for x in range(w):
        rows = each
        while len(rows):
            rows = rows[since[rows, at[rows] + 1] < x]
            at[rows] += 1
        v = lowest[each, at]
        out[:, x] = f[each, v] + (x - v) ** 2
    return out


def distance_to_land_km(land: np.ndarray, pixel_metres: float = 10.0) -> np.ndarray:
    """Exact Euclidean distance to the nearest land pixel: column distances, then the lower envelope of each row's parabolas."""
    n, h, w = land.shape
    far = float(h + w) * 2
    down = np.where(land, 0.0, far)
    for r in range(1, h):
        down[:, r] = np.minimum(down[:, r], down[:, r - 1] + 1)
    for r in range(h - 2, -1, -1):
        down[:, r] = np.minimum(down[:, r], down[:, r + 1] + 1)
    best = _lower_envelope((down * down).reshape(n * h, w)).reshape(n, h, w)
    return np.where(land.any(axis=(1, 2))[:, None, None], np.sqrt(best) * pixel_metres / 1000.0, NO_LAND_KM)


def polygon_mask(rings: list[list[tuple[float, float]]], height: int, width: int) -> np.ndarray:
    """Pixels whose centre (x column, y row) lies inside any ring by the even-odd rule.

    Of each edge only the rows that it crosses are looked at: what lies before the crossing changes sides."""
    out = np.zeros((height, width), dtype=bool)
    for ring in rings:
        if not ring:
            continue
        ends = np.array([[*a, *b] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)], dtype=float)
        low = np.clip(np.ceil(np.minimum(ends[:, 1], ends[:, 3])), 0, height).astype(np.int64)
        high = np.clip(np.ceil(np.maximum(ends[:, 1], ends[:, 3])), 0, height).astype(np.int64)
        if not (high > low).any():
            continue
        many = high - low
        ax, ay, bx, by = np.repeat(ends, many, axis=0).T
        y = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        before = np.clip(np.ceil((bx - ax) * (y - ay) / (by - ay) + ax), 0, width).astype(np.int64)
        top, bottom = int(low[many > 0].min()), int(high.max())
        turns = np.zeros((bottom - top, width + 1), dtype=np.int64)
        np.add.at(turns, (y - top, before), 1)
        # A pixel is inside if an odd number of crossings lies after it.
        out[top:bottom] |= (turns[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] & 1).astype(bool)
    return out


def adaptive_block(height: int, width: int) -> int:
    return min(64, max(8, min(height, width) // 4))


def on_arrays(kernel: Callable[..., np.ndarray], pixels: Column, height: Column | int, width: Column | int) -> Column:
    """Apply a stack kernel to a flat row-major array column; null arrays stay null."""

    @F.pandas_udf("array<double>")
    def run(values: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        return _by_shape(lambda stack, rows: kernel(stack), values, h, w)

    of = lambda c: c if isinstance(c, Column) else F.lit(c)
    return run(pixels, of(height), of(width))


def on_scenes(kernel: Callable[[np.ndarray, np.ndarray], np.ndarray], pixels: Column, incidence: Column, height: Column | int, width: Column | int) -> Column:
    """The same for kernels that take each pixel's incidence: the scene's own (one value, or one for each pixel), or the ramp where it has none."""

    @F.pandas_udf("array<double>")
    def run(values: pd.Series, angles: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        def with_angles(stack: np.ndarray, rows: pd.Index) -> np.ndarray:
            own = incidence_ramp(*stack.shape).copy()
            for k, i in enumerate(rows):
                if angles.loc[i] is not None:
                    own[k] = np.asarray(angles.loc[i], dtype=float).reshape(stack.shape[1:] if len(angles.loc[i]) > 1 else (1, 1))
            return kernel(stack, own)

        return _by_shape(with_angles, values, h, w)

    of = lambda c: c if isinstance(c, Column) else F.lit(c)
    return run(pixels, incidence, of(height), of(width))


def _by_shape(kernel: Callable[[np.ndarray, pd.Index], np.ndarray], values: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
    """Rows of one size go through the kernel as one stack; null arrays stay null."""
    out: list = [None] * len(values)
    shape = pd.DataFrame({"h": h, "w": w})[values.notna()]
    for (hh, ww), rows in shape.groupby(["h", "w"]).groups.items():
        stack = np.stack([np.asarray(values.loc[i], dtype=float) for i in rows]).reshape(-1, int(hh), int(ww))
        for i, r in zip(rows, kernel(stack, rows).reshape(len(rows), -1), strict=True):
            out[i] = r
    return pd.Series(out)
