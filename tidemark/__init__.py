"""tidemark: hourly incremental aggregation and data validation on PySpark."""

from tidemark.operators.aggregate import hourly_aggregate
from tidemark.operators.expectations import Expectation
from tidemark.operators.suite import Suite, build_suite, validate
from tidemark.operators.upsert import upsert
from tidemark.version import __version__


__all__ = [
    "__version__",
    "Expectation",
    "Suite",
    "build_suite",
    "hourly_aggregate",
    "upsert",
    "validate",
]
