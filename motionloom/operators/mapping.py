"""Best axis mappings: positions from moments (no candidate re-reads a frame), rotations per episode."""

from __future__ import annotations

import functools
import itertools
import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite


def signed_permutations() -> list[tuple[tuple[int, int, int], tuple[int, int, int]]]:
    """The 48 ways to permute three axes and flip signs: permutations in order, signs from all minus to all plus."""
    return [(p, s) for p in itertools.permutations(range(3)) for s in itertools.product((-1, 1), repeat=3)]


def best_axis_permutation(frames: DataFrame, state: str, action: str, key: str = "episode_index", offset: bool = True) -> DataFrame:
    """Key, candidate (its number), perm, signs, rmse: state_i ~ sign_i * action_perm(i) (+ a constant). The error of a
    candidate follows from 3 + 3 + 9 moments, so frames are read once; the smallest number wins ties."""
    s, a = [F.col(state)[i] for i in range(3)], [F.col(action)[i] for i in range(3)]
    # frames with a value that is not finite take no part
    whole = functools.reduce(operator.and_, [finite(x).isNotNull() for x in (*s, *a)])
    flat = frames.select(key, *[F.when(whole, x).alias(f"{c}{i}") for c, v in (("s", s), ("a", a)) for i, x in enumerate(v)])
    var = (lambda x: F.var_pop(x)) if offset else (lambda x: F.avg(F.col(x) * F.col(x)))
    cov = (lambda x, y: F.covar_pop(x, y)) if offset else (lambda x, y: F.avg(F.col(x) * F.col(y)))
    m = flat.groupBy(key).agg(*[var(f"{c}{i}").alias(f"v{c}{i}") for c in "sa" for i in range(3)], *[cov(f"s{i}", f"a{j}").alias(f"c{i}{j}") for i in range(3) for j in range(3)])
    errs = []
    for n, (p, sg) in enumerate(signed_permutations()):
        sq = sum((F.col(f"vs{i}") + F.col(f"va{p[i]}") - 2 * sg[i] * F.col(f"c{i}{p[i]}") for i in range(3)), F.lit(0.0)) / 3
        errs.append(F.struct(F.round(F.sqrt(F.greatest(sq, F.lit(0.0))), 9).alias("rmse"), F.lit(n).alias("candidate"), F.lit("".join(map(str, p))).alias("perm"), F.lit("".join("+" if x > 0 else "-" for x in sg)).alias("signs")))
    best = F.array_min(F.array(*errs))
    return m.select(key, best.alias("b")).select(key, "b.candidate", "b.perm", "b.signs", "b.rmse")


def signed_axis_matrices() -> np.ndarray:
    out = np.zeros((48, 3, 3))
    for n, (p, s) in enumerate(signed_permutations()):
        for i in range(3):
            out[n, i, p[i]] = s[i]
    return out


def rot6d_matrices(r: np.ndarray) -> np.ndarray:
    a, b = r[:, :3], r[:, 3:]
    a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    b = b - (a * b).sum(axis=1, keepdims=True) * a
    b = b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    return np.stack([a, b, np.cross(a, b)], axis=1)


def best_rotation_map(frames: DataFrame, state: str, action: str, key: str = "episode_index", most: int = 0, chunk: int = 2048) -> DataFrame:
    """Key, transpose, left, right, degrees, p50, p95, largest, rot6d_rmse: the map L A R (or of A transposed) with the smallest mean
    angle to the state, and the angles' median, 95th percentile and maximum and the error of six numbers under it.
    (L, R) and (-L, -R) are the same map; the pair with the smaller numbers is given. Frames with values that are not finite
    are left out; an episode of no others has no row. most: frames per episode, spaced evenly; 0 takes every frame. chunk:
    frames whose angles are held at a time.
    The trace of each candidate is a signed sum of nine products out of 81, so no candidate multiplies matrices."""
    axes = signed_axis_matrices()
    # of L and -L, the one with the smaller number
    lefts = [n for n in range(48) if n % 8 < 4]
    # trace = sum of s[i, j] b[m, k] L[i, m] R[k, j]
    weights = np.einsum("lim,rkj->ijmklr", axes[lefts], axes).reshape(81, -1)
    names = [key, "transpose", "left", "right", "degrees", "p50", "p95", "largest", "rot6d_rmse"]

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_index")
        flat = np.stack([np.concatenate([np.asarray(s, float), np.asarray(a, float)]) for s, a in zip(pdf[state], pdf[action], strict=True)])
        flat = flat[np.isfinite(flat).all(axis=1)]
        if not len(flat):
            return pd.DataFrame({n: [] for n in names})
        pick = np.unique(np.linspace(0, len(flat) - 1, min(most or len(flat), len(flat))).astype(int))
        pieces = [pick[at : at + chunk] for at in range(0, len(pick), chunk)]
        turned = lambda a, flip: a.transpose(0, 2, 1) if flip else a
        total = np.zeros((2, weights.shape[1]))
        for piece in pieces:
            s, a = rot6d_matrices(flat[piece, :6]), rot6d_matrices(flat[piece, 6:])
            for flip in (0, 1):
                traces = np.einsum("nij,nmk->nijmk", s, turned(a, flip)).reshape(-1, 81) @ weights
                total[flip] += np.degrees(np.arccos(np.clip((traces - 1) / 2, -1, 1))).sum(axis=0)
        best = None
        for flip, degs in enumerate((total / len(pick)).reshape(2, len(lefts), 48)):
            for left, deg in zip(lefts, degs, strict=True):
                r = int(np.argmin(np.round(deg, 9)))
                if best is None or deg[r] < best[3] - 1e-9:
                    best = (bool(flip), left, r, float(deg[r]))
        angles, squares = [], 0.0
        for piece in pieces:
            s, a = rot6d_matrices(flat[piece, :6]), rot6d_matrices(flat[piece, 6:])
            made = axes[best[1]] @ turned(a, best[0]) @ axes[best[2]]
            angles.append(np.degrees(np.arccos(np.clip(((s * made).sum(axis=(1, 2)) - 1) / 2, -1, 1))))
            squares += float(((s - made)[:, :2] ** 2).sum())
        angles = np.concatenate(angles)
        row = [pdf[key].iloc[0], *best, *map(float, np.percentile(angles, [50, 95])), float(angles.max()), float(np.sqrt(squares / (6 * len(angles))))]
        return pd.DataFrame([row], columns=names)

    return frames.select(key, "frame_index", state, action).groupBy(key).applyInPandas(search, f"{key} bigint, transpose boolean, left int, right int, degrees double, p50 double, p95 double, largest double, rot6d_rmse double")
