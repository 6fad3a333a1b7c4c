"""Rows from in-memory records (request bodies, run metadata)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def records_frame(spark: SparkSession, records: Iterable[Mapping], schema: T.StructType | str) -> DataFrame:
    """DataFrame of small driver-side records with an explicit schema.

    Only for bounded metadata (one request, one run's parameters); bulk data is
    always read from storage.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    rows = [tuple(r.get(n) for n in names) for r in records]
    return spark.createDataFrame(rows, schema)
