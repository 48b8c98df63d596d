"""Registry of named queries: a Spark builder plus, where SQL can express it, an oracle.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the input
tables. The oracle is DuckDB SQL over the same tables (views ``orders``, ``lineitem``,
...) and must produce the same column names and values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that their ``register`` calls run."""
    from omnitally.plans import (  # noqa: F401
        q_core, q_period, q_rank, q_quality, q_audit, q_normalize, q_upsert, q_events, q_stream, q_dispatch, q_recon)
