"""tabforge: clean all-text records into typed Parquet tables and train,
select and serve classifiers, expressed as Spark DataFrame, Spark ML and
Structured Streaming operations.

Layout
------
``sources``    scans (all-string text tables, Parquet, config → schema, records, models)
``functions``  pure ``Column -> Column`` scalar functions (text, coercion, mappings)
``operators``  ``DataFrame -> DataFrame`` building blocks (projections, filters,
               aggregates, feature stages, training, metrics, run tables, scoring)
``plans``      multi-step jobs composed from operators (clean, snapshot, prepare, job)
``streaming``  Structured Streaming scoring
"""

__version__ = "0.1.0"
