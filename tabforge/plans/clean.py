"""From all-text records to the typed wide frame.

Order of steps (each one sees the previous one's output):

1. drop blank-header columns        6. drop non-ASCII characters, then symbols
2. normalise headers                   (every text column)
3. drop rows null in a required col 7. drop rows with an invalid text cell
4. id → bigint, drop unparsable     8. whitelist (e.g. gender M/F, else null)
5. drop the sentinel value          9. derive the label text (R → yes, else no)
                                   10. coerce every configured column to its type

All of it is narrow: Catalyst collapses the projections and filters into one
whole-stage-codegen span per scan partition, with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.config import (
    COLUMN_TYPES,
    ID_COLUMN,
    LABEL_COLUMN,
    LABEL_SOURCE_COLUMN,
    REQUIRED_COLUMNS,
    SENTINEL_COLUMN,
    SENTINEL_VALUE,
    SYMBOLS,
    WHITELIST,
)
from tabforge.config.defaults import POSITIVE_CODE
from tabforge.functions.coerce import coerce_frame
from tabforge.functions.mapping import map_with_default, whitelist
from tabforge.functions.text import ascii_fold, strip_symbols
from tabforge.operators import columns as cols
from tabforge.operators import filters as flt


@dataclass
class CleanSpec:
    """Column roles and rules of the cleaning; defaults are the source's."""

    column_types: dict[str, str] = field(default_factory=lambda: dict(COLUMN_TYPES))
    required: list[str] = field(default_factory=lambda: list(REQUIRED_COLUMNS))
    id_column: str = ID_COLUMN
    sentinel_column: str | None = SENTINEL_COLUMN
    sentinel_value: str = SENTINEL_VALUE
    symbols: str = SYMBOLS
    whitelist: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in WHITELIST.items()})
    label_source: str | None = LABEL_SOURCE_COLUMN
    label_column: str = LABEL_COLUMN
    positive_code: str = POSITIVE_CODE


def normalize_text_columns(df: DataFrame, id_column: str, symbols: str) -> DataFrame:
    """Non-ASCII characters, then ``symbols``, removed from every text column."""
    text = set(cols.string_columns(df)) - {id_column}
    return df.select(*[
        strip_symbols(ascii_fold(F.col(f"`{c}`")), symbols).alias(c) if c in text else F.col(f"`{c}`")
        for c in df.columns
    ])


def coerce_columns(df: DataFrame, column_types: dict[str, str]) -> DataFrame:
    """Every configured column that is present → its configured type."""
    return coerce_frame(df, column_types)


def clean(raw: DataFrame, spec: CleanSpec | None = None) -> DataFrame:
    """All-text frame → typed wide frame (see module doc for the steps).

    Row counts after the id parse, the text normalisation and at the end are
    observed (metrics ``tabforge.<step>.*``,
    no extra pass); the observation nodes also keep filters on parsed values
    from being pushed below their projections
    (:func:`tabforge.operators.filters.fence`).
    """
    s = spec or CleanSpec()
    df = cols.normalize_headers(cols.drop_unnamed(raw))
    df = flt.require_columns(df, s.required)
    df = flt.numeric_id(df, s.id_column)
    if s.sentinel_column:
        df = flt.exclude_value(df, s.sentinel_column, s.sentinel_value)
    df = normalize_text_columns(df, s.id_column, s.symbols)
    df = flt.fence(df, "normalized")
    df = flt.valid_rows(df)
    if s.whitelist:
        df = df.withColumns({c: whitelist(c, allowed) for c, allowed in s.whitelist.items()})
    if s.label_source:
        df = df.withColumn(s.label_column, map_with_default(s.label_source, {s.positive_code: "yes"}, "no"))
    return flt.fence(coerce_columns(df, s.column_types), "cleaned")
