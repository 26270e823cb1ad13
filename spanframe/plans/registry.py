"""Query registry: key -> (Spark builder, optional DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  Oracle SQL is DuckDB text over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Bindings as Fixtures


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(fx: Fixtures) -> DataFrame`` under ``key``."""

    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")

        def build(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return _fn(Fixtures(spark, sf_dir))

        REGISTRY[key] = Query(key, build, oracle)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    from . import catalog  # noqa: F401  (registers everything)

    return REGISTRY
