"""Sequential smoothing of an episode: Hampel, Savitzky-Golay, rotations by their logarithms. Each episode is one group."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from motionloom.operators.mapping import rot6d_matrices
from motionloom.operators.sequences import savgol_rows


@dataclass(frozen=True)
class Smoothing:
    hampel_window: int = 7
    hampel_limit: float = 3.0
    savgol_window: int = 7
    degree: int = 2


def hampel(x: np.ndarray, window: int, limit: float) -> tuple[np.ndarray, int]:
    """Outliers become the median of their window. Left neighbours are the filtered ones, so this goes from left to right."""
    out, half, changed = x.astype(float).copy(), window // 2, 0
    for i in range(len(out)):
        near = out[max(0, i - half) : i + half + 1]
        mid = np.median(near)
        mad = np.median(np.abs(near - mid))
        if mad > 1e-12 and abs(out[i] - mid) > limit * 1.4826 * mad:
            out[i] = mid
            changed += 1
    return out, changed


def savgol(x: np.ndarray, window: int, degree: int = 2) -> np.ndarray:
    w = min(window, len(x))
    w -= w % 2 == 0
    if w <= degree:
        return x
    rows, half = np.array(savgol_rows(w, degree)), w // 2
    out = np.empty(len(x))
    out[half : len(x) - half] = np.lib.stride_tricks.sliding_window_view(x, w) @ rows[half]
    out[:half] = rows[:half] @ x[:w]
    out[len(x) - half :] = rows[half + 1 :] @ x[-w:]
    return out


def log_rotation(r: np.ndarray) -> np.ndarray:
    """Rotation matrices -> rotation vectors, through quaternions (stable near 0 and near half a turn)."""
    out = np.zeros((len(r), 3))
    for i, m in enumerate(r):
        k = np.array([[m[0, 0] - m[1, 1] - m[2, 2], m[0, 1] + m[1, 0], m[0, 2] + m[2, 0], m[2, 1] - m[1, 2]], [m[0, 1] + m[1, 0], m[1, 1] - m[0, 0] - m[2, 2], m[1, 2] + m[2, 1], m[0, 2] - m[2, 0]], [m[0, 2] + m[2, 0], m[1, 2] + m[2, 1], m[2, 2] - m[0, 0] - m[1, 1], m[1, 0] - m[0, 1]], [m[2, 1] - m[1, 2], m[0, 2] - m[2, 0], m[1, 0] - m[0, 1], np.trace(m)]]) / 3
        q = np.linalg.eigh(k)[1][:, -1]
        q = q if q[3] >= 0 else -q
        n = np.linalg.norm(q[:3])
        out[i] = q[:3] * (2 * np.arctan2(n, q[3]) / n if n > 1e-12 else 2.0)
    return out


def exp_rotation(v: np.ndarray) -> np.ndarray:
    angle = np.linalg.norm(v, axis=1)
    axis = v / np.maximum(angle, 1e-12)[:, None]
    k = np.zeros((len(v), 3, 3))
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 0], k[:, 1, 2], k[:, 2, 0], k[:, 2, 1] = -axis[:, 2], axis[:, 1], axis[:, 2], -axis[:, 0], -axis[:, 1], axis[:, 0]
    return np.eye(3) + np.sin(angle)[:, None, None] * k + (1 - np.cos(angle))[:, None, None] * (k @ k)


def smooth_channels(m: np.ndarray, how: Smoothing) -> tuple[np.ndarray, int]:
    out, changed = np.empty(m.shape), 0
    for d in range(m.shape[1]):
        x, n = hampel(m[:, d], how.hampel_window, how.hampel_limit)
        out[:, d], changed = savgol(x, how.savgol_window, how.degree), changed + n
    return out, changed


def smooth_rotations(r6: np.ndarray, how: Smoothing) -> tuple[np.ndarray, int]:
    """Rotations relative to the first frame as vectors, smoothed, and back."""
    r = rot6d_matrices(r6)
    vec, changed = smooth_channels(log_rotation(r[0].T[None] @ r), how)
    return (r[0][None] @ exp_rotation(vec))[:, :2, :].reshape(-1, 6), changed


def smooth_episodes(frames: DataFrame, columns: dict[str, dict[str, tuple[int, int]]], how: Smoothing = Smoothing(), key: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """frames with the given vector columns smoothed. columns: column -> {group: (start, end)}; a group whose name has
    "rot6d" is smoothed as rotations, the others channel by channel; dimensions in no group stay. Adds hampel_replaced."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(frame).copy()
        replaced = 0
        for column, groups in columns.items():
            m = np.stack([np.asarray(v, float) for v in pdf[column]])
            for name, (a, b) in groups.items():
                m[:, a:b], n = (smooth_rotations if "rot6d" in name else smooth_channels)(m[:, a:b], how)
                replaced += n
            pdf[column] = list(m)
        pdf["hampel_replaced"] = replaced
        return pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema) + ", hampel_replaced bigint"
    return frames.groupBy(key).applyInPandas(run, schema)
