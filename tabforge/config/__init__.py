"""Configuration: fixed values of the record layout and the training setup."""

from tabforge.config.defaults import (  # noqa: F401
    ALLOWED_CATEGORIES,
    ALPHA_DESC_COLUMN,
    CATEGORY_COLUMN,
    COLUMN_TYPES,
    FEATURE_COLUMNS,
    GROUP_MIN_COUNT,
    ID_COLUMN,
    IQR_FACTOR,
    LABEL_COLUMN,
    LABEL_SOURCE_COLUMN,
    MODEL_ARTIFACT,
    NA_TOKENS,
    NUMERIC_FEATURES,
    OUTLIER_COLUMNS,
    QUANTILE_REL_ERROR,
    REQUIRED_COLUMNS,
    SENTINEL_COLUMN,
    SENTINEL_VALUE,
    SYMBOLS,
    TABLE_SCHEMAS,
    TUNING,
    WHITELIST,
)
