"""Scans: all-string text tables, Parquet, schema configs, in-memory records."""

from tabforge.sources.files import (  # noqa: F401
    dataset_name,
    read_parquet,
    read_text_table,
    to_hadoop_uri,
)
from tabforge.sources.records import records_frame  # noqa: F401
from tabforge.sources.schema import (  # noqa: F401
    declared_constraints,
    load_json_config,
    table_struct,
    typed_struct,
)
