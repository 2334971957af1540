"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry runs a library operator over the canonical views of the driver
tables (whole tables, no subsets) and rounds doubles for a stable comparison
with the SQL oracle in ``turnstile.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules fills QUERIES
    from turnstile.plans import (  # noqa: F401
        q_anomaly, q_cdc, q_drift, q_extra, q_gold, q_misc, q_ml, q_patterns, q_silver, q_store, q_stream,
        q_survival)
    return dict(QUERIES)
