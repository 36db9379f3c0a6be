"""Dense motion between frames: each neighbourhood as a quadratic, its shift from the change of the coefficients, coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The size frames are compared at, halving of scales, half width and deviation of a neighbourhood, averaging window, rounds.
WIDTH, HEIGHT, LEVELS, REACH, SIGMA, AVERAGE, ROUNDS = 160, 120, 2, 2, 1.1, 15, 2


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the area of each new pixel, exact for any ratio, from the integral of the image."""
    whole = np.pad(image.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def at(values: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, values.shape[0] - 1, n + 1)
        low = np.minimum(edge.astype(int), values.shape[0] - 2)
        return values[low] + (edge - low)[:, None] * (values[low + 1] - values[low])

    cells = np.diff(np.diff(at(at(whole, height).T, width).T, axis=0), axis=1)
    return cells * (height * width / image.size)


def _along(image: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """Weighted sums over a line of neighbours; the border repeats."""
    reach = len(weights) // 2
    pad = [(reach, reach) if a == axis else (0, 0) for a in range(image.ndim)]
    wide, n = np.pad(image, pad, mode="edge"), image.shape[axis]
    return sum(w * wide.take(range(k, k + n), axis=axis) for k, w in enumerate(weights))


def quadratic(image: np.ndarray) -> np.ndarray:
    """Per pixel the weighted least-squares coefficients of x, y, x^2, y^2, x y around it."""
    t = np.arange(-REACH, REACH + 1)
    w = np.exp(-(t**2) / (2 * SIGMA**2))
    powers = [(0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1)]
    x, y = np.meshgrid(t, t)
    basis = np.stack([(x**p * y**q).ravel() for p, q in powers])
    solve = np.linalg.inv((basis * np.outer(w, w).ravel()) @ basis.T)
    moments = np.stack([_along(_along(image, w * t**p, 1), w * t**q, 0) for p, q in powers])
    return np.tensordot(solve, moments, 1)[1:]


def _shifted(fields: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Fields read at every pixel plus d, between the four nearest, within the border."""
    h, w = d.shape[1:]
    x = np.clip(np.arange(w)[None, :] + d[0], 0, w - 1)
    y = np.clip(np.arange(h)[:, None] + d[1], 0, h - 1)
    i, j = np.minimum(x.astype(int), w - 2), np.minimum(y.astype(int), h - 2)
    a, b = x - i, y - j
    return (1 - b) * ((1 - a) * fields[:, j, i] + a * fields[:, j, i + 1]) + b * ((1 - a) * fields[:, j + 1, i] + a * fields[:, j + 1, i + 1])


def flow(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """(2, height, width): the shift along x and y that takes each pixel of before to its place in after."""
    scales = [(before, after)]
    for _ in range(LEVELS):
        h, w = (n // 2 for n in scales[-1][0].shape)
        if min(h, w) < AVERAGE:
            break
        scales.append(tuple(resized(g, h, w) for g in scales[-1]))
    d = np.zeros((2, *scales[-1][0].shape))
    mean = np.full(AVERAGE, 1 / AVERAGE)
    for one, two in reversed(scales):
        if d.shape[1:] != one.shape:
            ratio = np.array([one.shape[1] / d.shape[2], one.shape[0] / d.shape[1]])[:, None, None]
            rows, cols = (np.minimum((np.arange(n) * m) // n, m - 1) for n, m in zip(one.shape, d.shape[1:], strict=True))
            d = d[:, rows][:, :, cols] * ratio
        p, q = quadratic(one), quadratic(two)
        for _ in range(ROUNDS):
            s = _shifted(q, d)
            xx, yy, xy = ((p[k] + s[k]) / 2 for k in (2, 3, 4))
            xy = xy / 2
            bx, by = (p[0] - s[0]) / 2 + xx * d[0] + xy * d[1], (p[1] - s[1]) / 2 + xy * d[0] + yy * d[1]
            sums = np.stack([xx * xx + xy * xy, xy * (xx + yy), yy * yy + xy * xy, xx * bx + xy * by, xy * bx + yy * by])
            a, b, c, u, v = _along(_along(sums, mean, 1), mean, 2)
            least = 1e-9 + 1e-6 * (a + c)
            det = (a + least) * (c + least) - b * b
            d = np.stack([((c + least) * u - b * v) / det, ((a + least) * v - b * u) / det])
    return d


def magnitude(before: np.ndarray, after: np.ndarray) -> float:
    one, two = (resized(np.asarray(g, float), HEIGHT, WIDTH) for g in (before, after))
    return float(np.hypot(*flow(one, two)).mean())


def optical_flow(frames: DataFrame, key: list[str], frame: str, pixels: str = "gray", width: str = "width") -> DataFrame:
    """Adds optical_flow_magnitude, the mean length of the shifts from the frame before at 160 x 120 pixels, and flow_status:
    ok, first_frame, or unavailable where either frame has no pixels, isn't a rectangle of 2 x 2 or more, or differs in shape."""
    w = Window.partitionBy(*key).orderBy(frame)
    before = F.when(F.row_number().over(w) > 1, F.struct(F.lag(pixels).over(w).alias("pixels"), F.lag(width).over(w).alias("width")))
    pairs = frames.withColumn("__before", before)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema) + ", optical_flow_magnitude double, flow_status string"

    def rectangle(v, w) -> np.ndarray | None:
        if v is None or w is None or w != w or w < 2 or len(v) % int(w) or len(v) // int(w) < 2:
            return None
        g = np.asarray(v, float).reshape(-1, int(w))
        return g if np.isfinite(g).all() else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v, w, prior in zip(pdf[pixels], pdf[width], pdf["__before"], strict=True):
                if prior is None:
                    out.append((None, "first_frame"))
                    continue
                one, two = rectangle(prior["pixels"], prior["width"]), rectangle(v, w)
                ok = one is not None and two is not None and one.shape == two.shape
                out.append((magnitude(one, two), "ok") if ok else (None, "unavailable"))
            made = pd.DataFrame(out, columns=["optical_flow_magnitude", "flow_status"], index=pdf.index)
            yield pd.concat([pdf.drop(columns="__before"), made.astype({"optical_flow_magnitude": float})], axis=1)

    return pairs.mapInPandas(run, schema)
