"""Registry of queries: name -> (Spark job, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .fixtures import oracle_text, table


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


class Source:
    """Tables and fixtures of one data folder, opened by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None):
    """Register a job; its SQL may use the fixtures by name."""

    def register(job: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(lambda spark, sf_dir: job(Source(spark, sf_dir)),
                              oracle_text(oracle) if oracle else None)
        return job

    return register


def load_all() -> dict[str, Query]:
    from . import (detection_queries, document_queries, file_queries,  # noqa: F401
                   mapping_queries, streaming_queries, validation_queries,
                   verification_queries)
    return QUERIES
