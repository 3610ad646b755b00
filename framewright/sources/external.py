"""Batch boundaries to code that is not Spark: model inference and media tools.

Both are iterators over Arrow batches.  Models load once per worker process; a failing row
becomes a status value and never fails its task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

_loaded: dict[str, object] = {}


def infer(rows: DataFrame, name: str, load: Callable[[], object], predict: Callable[[object, pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Batches through a model: ``load()`` once per process, ``predict(model, batch)`` for each batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _loaded:
            _loaded[name] = load()
        for pdf in batches:
            yield predict(_loaded[name], pdf)

    return rows.mapInPandas(run, schema)


def process_each(rows: DataFrame, action: Callable[[dict], dict], key: str, retries: int = 1, retry: Callable[[dict], dict] | None = None) -> DataFrame:
    """(key, status, error, elapsed_s) of ``action`` over each row.

    action returns {"status": ..., "error": ...}; an exception is status ``failed``.  A
    status other than ok is tried again up to ``retries`` times, with ``retry`` turning the
    row into what the next attempt gets.
    """

    def attempt(row: dict) -> dict:
        try:
            return action(row)
        except Exception as e:  # the boundary: any failure is data
            return {"status": "failed", "error": f"{type(e).__name__}: {e}"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                began = time.monotonic()
                result = attempt(row)
                for _ in range(retries):
                    if result.get("status") == "ok":
                        break
                    row = retry(row) if retry else row
                    result = attempt(row)
                out.append((str(row[key]), result.get("status", "ok"), result.get("error"), time.monotonic() - began))
            yield pd.DataFrame(out, columns=[key, "status", "error", "elapsed_s"])

    return rows.mapInPandas(run, f"{key} string, status string, error string, elapsed_s double")
