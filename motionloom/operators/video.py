"""Quality of decoded video: gray frames as arrays. Decoding needs libraries that may be absent, so frames come decoded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def frame_quality(frames: DataFrame, pixels: str = "gray", width: str = "width") -> DataFrame:
    """Adds blur (variance of the Laplacian), brightness, contrast, over and under exposure to rows with flat gray pixels."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema) + ", blur double, brightness double, contrast double, over double, under double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for v, w in zip(pdf[pixels], pdf[width], strict=True):
                g = np.asarray(v, float).reshape(-1, int(w))
                lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
                rows.append((float(lap.var()) if lap.size else np.nan, g.mean(), g.std(), (g >= 245).mean(), (g <= 10).mean()))
            yield pdf.assign(**dict(zip(("blur", "brightness", "contrast", "over", "under"), zip(*rows, strict=True), strict=True)) if rows else dict.fromkeys(("blur", "brightness", "contrast", "over", "under"), pd.Series(dtype=float)))

    return frames.mapInPandas(run, schema)


def consecutive_difference(frames: DataFrame, key: list[str], frame: str, pixels: str = "gray") -> DataFrame:
    """Adds diff: the mean absolute difference of gray values from the frame before."""
    before = F.lag(pixels).over(Window.partitionBy(*key).orderBy(frame))
    total = F.aggregate(F.zip_with(pixels, before, lambda a, b: F.abs(a - b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return frames.withColumn("diff", F.when(before.isNotNull(), total / F.size(pixels)))


def detector(frames: DataFrame, find: Callable, pixels: str = "gray") -> DataFrame:
    """Adds visibility by a plug-in: a number, or a dict with object_visibility_ratio, visibility or score; else null."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        def one(v):
            x = find(np.asarray(v))
            if isinstance(x, dict):
                x = next((x[k] for k in ("object_visibility_ratio", "visibility", "score") if k in x), None)
            return float(x) if x is not None and np.isfinite(x) else None

        return values.map(one)

    return frames.withColumn("visibility", run(pixels))
