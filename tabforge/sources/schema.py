"""Config → Spark schema."""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS
from tabforge.functions.coerce import spark_type_of

_SPARK_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def load_json_config(path: str) -> dict:
    """Read a JSON config file on the driver (column types, tables, grids)."""
    with open(path, encoding="utf-8") as fh:
        return json.load(fh)


def typed_struct(column_types: dict[str, str] = COLUMN_TYPES) -> T.StructType:
    """Effective schema of the typed wide frame."""
    return T.StructType([T.StructField(c, _SPARK_TYPES[spark_type_of(d)]) for c, d in column_types.items()])


def table_struct(
    table: str,
    table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS,
    column_types: dict[str, str] = COLUMN_TYPES,
) -> T.StructType:
    """Schema of one output table: its columns in config order, effective types."""
    wide = {f.name: f for f in typed_struct(column_types).fields}
    return T.StructType([wide[c] for c in table_schemas[table]])


_VARCHAR = re.compile(r"VARCHAR\((\d+)\)", re.IGNORECASE)


def declared_constraints(table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS) -> list[dict]:
    """Constraints stated in the DDL strings: not-null, primary key, max length."""
    out = []
    for table, cols in table_schemas.items():
        for col, ddl in cols.items():
            up = ddl.upper()
            m = _VARCHAR.search(up)
            out.append({
                "table": table,
                "column": col,
                "not_null": "NOT NULL" in up,
                "primary_key": "PRIMARY KEY" in up,
                "max_length": int(m.group(1)) if m else None,
            })
    return out
