"""Registry of named query plans and their DuckDB oracle SQL.

Each plan is a function ``(spark, sf_dir) -> DataFrame`` over the driver's
tables (``<sf_dir>/<table>.parquet``); the oracle, when one exists, is SQL
that DuckDB runs on the same tables (registered as views) and must give the
same rows. Floating point columns are rounded to 6 places on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plan(name: str, oracle: str | None = None):
    """Register a plan under ``name`` (and its oracle SQL, if any)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate plan {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), 6)


def load_all() -> None:
    """Import every plan module so its ``@plan`` registrations run."""
    from textflow.plans import (  # noqa: F401
        metric_plans,
        registry_plans,
        serving_plans,
        text_plans,
        training_plans,
    )
