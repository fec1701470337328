"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Views by name, for one session and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(oracle: str | None = None):
    """Register a function of the inputs under its name, with its DuckDB counterpart."""

    def register(fn):
        name = fn.__name__
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return register
