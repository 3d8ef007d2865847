"""Name -> query function, name -> check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.plans import adapters

QUERIES: dict[str, Callable] = {}
CHECKS: dict[str, str] = {}
BODIES: dict[str, str] = {}

VIEWS = {
    "telemetry": adapters.TELEMETRY_SQL,
    "raw_text": adapters.RAW_SQL,
    "model_results_raw": adapters.RESULTS_SQL,
    "cluster_trials": adapters.TRIALS_SQL,
}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), ctes: dict[str, str] | None = None, recursive: bool = False):
    """Register a query; ``views`` and ``ctes`` are put before ``sql`` as common table expressions."""

    def keep(function: Callable) -> Callable:
        assert name not in QUERIES, name
        QUERIES[name] = function
        if sql:
            parts = {v: VIEWS[v] for v in views} | (ctes or {})
            head = ", ".join(f"{n} AS ({body})" for n, body in parts.items())
            BODIES[name] = sql
            CHECKS[name] = f"WITH {'RECURSIVE ' if recursive else ''}{head} {sql}" if head else sql
        return function

    return keep


# Averages of grid values can end exactly half-way between two sixth decimals, where the last bit of a sum decides.
# Both sides of a comparison may add this before they round.
NUDGE = 3e-9


def r6(df: DataFrame, *columns: str, places: int = 6, nudge: float = 0.0) -> DataFrame:
    """Round doubles for comparison across engines; all double columns when none are named."""
    chosen = columns or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(c) + nudge if nudge else F.col(c), places) for c in chosen})
