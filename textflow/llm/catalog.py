"""Registry of the subpackage's queries and their DuckDB oracle SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` (and its oracle SQL, if any)."""

    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


from textflow.llm import (  # noqa: E402,F401  -- the modules register themselves
    chat_format,
    conversation_repair,
    decontaminate,
    fill_middle,
    imatch,
    knn_join,
    license_scan,
    line_dedup,
    mixing,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
)
