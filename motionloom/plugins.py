"""Plug-ins by dotted name: embedding and detector backends, exporters."""

from __future__ import annotations

import importlib
import importlib.util
import json
from collections.abc import Callable
from typing import Protocol, runtime_checkable

import pandas as pd
from pyspark.sql import DataFrame

KINDS = ("video", "state_action", "language")


def load(spec: str) -> Callable:
    """`package.module:function`."""
    module, _, name = spec.partition(":")
    found = getattr(importlib.import_module(module), name or "", None)
    if not callable(found):
        raise ValueError(f"{spec} names no function")
    return found


def embed(episodes: DataFrame, backend: Callable, key: str = "episode_index") -> DataFrame:
    """Key, status and a JSON vector per kind; a backend that gives no dict, or raises, gives status error for that episode."""

    def run(batches):
        for pdf in batches:
            rows = []
            for context in pdf.to_dict("records"):
                try:
                    got = backend(context)
                    ok = isinstance(got, dict)
                except Exception:
                    got, ok = None, False
                pick = lambda k: next((json.dumps(list(map(float, got[n]))) for n in (f"{k}_embedding", k) if ok and n in got), None)  # noqa: E731,B023
                rows.append((context[key], "ok" if ok else "error", *[pick(k) for k in KINDS]))
            yield pd.DataFrame(rows, columns=[key, "status", *[f"{k}_embedding" for k in KINDS]])

    return episodes.mapInPandas(run, f"{key} bigint, status string, " + ", ".join(f"{k}_embedding string" for k in KINDS))


def reduce_status(method: str) -> str:
    """What became of an optional reduction: its library may be absent."""
    name = {"tsne": "sklearn", "umap": "umap"}.get(method, method)
    return "available" if importlib.util.find_spec(name) else f"skipped:{name}_not_installed"


@runtime_checkable
class Exporter(Protocol):
    def export_capture(self, raw_capture_dir: str, output_dir: str): ...
