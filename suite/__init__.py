"""Registered queries over the given tables, each with the DuckDB query it is checked against."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Importing the modules registers their queries.
from suite import job_queries, response_queries, rows, sampling_queries, schema_queries, store_queries  # noqa: E402, F401
from suite.registry import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
