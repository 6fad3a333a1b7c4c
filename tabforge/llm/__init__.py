"""Operators of a training-data pipeline: dedup, filters, scoring, mixing and packing."""

import sys

from pyspark import cloudpickle

from tabforge.llm.queries import ORACLE_SQL, QUERIES

# Functions that run in tasks travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLE_SQL", "QUERIES"]
