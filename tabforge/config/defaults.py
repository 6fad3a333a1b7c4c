"""Defaults of the record layout, cleaning rules and training grid.

Every public function takes these as keyword arguments, so other layouts
(such as the bindings over the driver's tables) pass their own.
"""

from __future__ import annotations

# --- Fixed values (must equal the source application's configuration) -------

# Column -> pandas dtype name of the typed wide frame, in configuration order.
COLUMN_TYPES: dict[str, str] = {
    "patient_id": "Int64",
    "age": "float64",
    "gender": "object",
    "responder": "object",
    "ms_type": "object",
    "current_treat": "object",
    "report": "object",
    "wb_new": "float64",
    "lesion_new": "float64",
    "dob": "datetime64[ns]",
    "diagnosis_date": "datetime64[ns]",
    "start": "datetime64[ns]",
    "date_new": "datetime64[ns]",
    "date_prev": "datetime64[ns]",
    "date_old": "datetime64[ns]",
    "new_nfl_date": "datetime64[ns]",
    "old_nfl_date": "datetime64[ns]",
    "neuro_trax_date": "datetime64[ns]",
    "neuro_trax_global": "float64",
    "neuro_trax_memory": "float64",
    "neuro_trax_info_speed": "float64",
    "edss_prev_treatment": "float64",
    "current_edss": "float64",
    "type": "object",
    "lesion_old": "float64",
    "wb_old": "float64",
    "new_vol_chang": "float64",
    "new_new": "float64",
    "new_enlarg": "float64",
    "new_shrink_ing": "float64",
    "new_a_ann_vol_chane": "float64",
    "prev_whbr_vol_change": "float64",
    "b_annual_lesion_vol_change_ib": "float64",
    "d_annual_new_change_ib": "float64",
    "c_annual_enlar_change_ib": "float64",
    "new_nfl": "float64",
    "new_pg_ml": "float64",
    "new_nfl_z": "float64",
    "old_nfl_pg_ml": "float64",
    "old_nfl_z": "float64",
    "dz": "float64",
    "sdmt_date": "datetime64[ns]",
    "sdmt_raw": "float64",
    "sdmt_z": "float64",
    "ravlt_cvlt_raw": "float64",
    "ravlt_cvlt_z": "float64",
    "cowat": "float64",
    "cowat_z": "float64",
    "response": "object",
}

# Table -> column -> declared DDL, in configuration order. The declared types
# are documentation: effective types come from COLUMN_TYPES.
TABLE_SCHEMAS: dict[str, dict[str, str]] = {
    "cognitive": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "neuro_trax_date": "DATE NULL",
        "neuro_trax_global": "FLOAT NULL",
        "neuro_trax_memory": "FLOAT NULL",
        "neuro_trax_info_speed": "FLOAT NULL",
    },
    "patients": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "dob": "DATE NULL",
        "age": "FLOAT NULL",
        "gender": "VARCHAR(10) NULL",
        "diagnosis_date": "DATE NULL",
        "ms_type": "VARCHAR(50) NULL",
        "start": "DATE NULL",
        "current_treat": "VARCHAR(255) NULL",
        "report": "VARCHAR(1000) NULL",
        "date_new": "DATE NULL",
        "date_old": "DATE NULL",
        "date_prev": "DATE NULL",
    },
    "edss": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "edss_prev_treatment": "FLOAT NULL",
        "current_edss": "FLOAT NULL",
        "date_new": "DATE NULL",
        "date_prev": "DATE NULL",
        "date_old": "DATE NULL",
    },
    "mri_measurements": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "type": "VARCHAR(50) NULL",
        "lesion_new": "FLOAT NULL",
        "lesion_old": "FLOAT NULL",
        "wb_new": "FLOAT NULL",
        "wb_old": "FLOAT NULL",
        "new_vol_chang": "FLOAT NULL",
        "new_new": "FLOAT NULL",
        "new_enlarg": "FLOAT NULL",
        "new_shrink_ing": "FLOAT NULL",
        "new_a_ann_vol_chane": "FLOAT NULL",
        "prev_whbr_vol_change": "FLOAT NULL",
        "b_annual_lesion_vol_change_ib": "FLOAT NULL",
        "d_annual_new_change_ib": "FLOAT NULL",
        "c_annual_enlar_change_ib": "FLOAT NULL",
        "new_nfl": "FLOAT NULL",
        "new_nfl_date": "DATE NULL",
        "new_pg_ml": "FLOAT NULL",
        "new_nfl_z": "FLOAT NULL",
        "old_nfl_date": "DATE NULL",
        "old_nfl_pg_ml": "FLOAT NULL",
        "old_nfl_z": "FLOAT NULL",
        "dz": "FLOAT NULL",
        "sdmt_date": "DATE NULL",
        "sdmt_raw": "FLOAT NULL",
        "sdmt_z": "FLOAT NULL",
        "ravlt_cvlt_raw": "FLOAT NULL",
        "ravlt_cvlt_z": "FLOAT NULL",
        "cowat": "FLOAT NULL",
        "cowat_z": "FLOAT NULL",
    },
    "mri_nfl": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "type": "VARCHAR(50) NULL",
        "new_nfl": "FLOAT NULL",
        "new_nfl_date": "DATE NULL",
        "new_pg_ml": "FLOAT NULL",
        "new_nfl_z": "FLOAT NULL",
        "old_nfl_date": "DATE NULL",
        "old_nfl_pg_ml": "FLOAT NULL",
        "old_nfl_z": "FLOAT NULL",
    },
    "mri_simple": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "lesion_new": "FLOAT NULL",
        "lesion_old": "FLOAT NULL",
        "wb_new": "FLOAT NULL",
        "wb_old": "FLOAT NULL",
    },
    "treatment": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "response": "VARCHAR(50) NULL",
        "responder": "BOOLEAN NULL",
        "current_treat": "VARCHAR(255) NULL",
        "start": "DATE NULL",
        "date_new": "DATE NULL",
        "date_old": "DATE NULL",
    },
    "ml_ready": {
        "patient_id": "INTEGER NOT NULL PRIMARY KEY",
        "age": "FLOAT",
        "gender": "VARCHAR(10) NOT NULL",
        "ms_type": "VARCHAR(50) NOT NULL",
        "lesion_new": "FLOAT NOT NULL",
        "wb_new": "FLOAT NOT NULL",
        "current_edss": "FLOAT NOT NULL",
        "response": "VARCHAR(50) NOT NULL",
    },
}

# Cleaning rules.
ID_COLUMN = "patient_id"
REQUIRED_COLUMNS = [
    "patient_id", "age", "gender", "responder", "ms_type",
    "current_edss", "current_treat", "report", "wb_new", "lesion_new",
]
SENTINEL_COLUMN = "current_treat"
SENTINEL_VALUE = "0"
SYMBOLS = ";,@"
WHITELIST = {"gender": ["M", "F"]}
LABEL_SOURCE_COLUMN = "responder"   # 'R' -> 'yes', anything else -> 'no'
LABEL_COLUMN = "response"
POSITIVE_CODE = "R"

# Text cells read as null: the NA tokens of the pandas readers.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Feature preparation.
CATEGORY_COLUMN = "ms_type"
ALLOWED_CATEGORIES = ["RR", "APMS", "PPMS"]
GROUP_MIN_COUNT = 10                 # a category needs strictly more rows
OUTLIER_COLUMNS = ["age", "lesion_new", "wb_new"]
IQR_FACTOR = 1.5
QUANTILE_REL_ERROR = 0.05
ALPHA_DESC_COLUMN = "gender"         # indexed in reverse alphabetical order
NUMERIC_FEATURES = ["age", "lesion_new", "wb_new", "current_edss"]
FEATURE_COLUMNS = ["age", "gender", "current_edss", "lesion_new", "wb_new", "ms_type"]
MODEL_ARTIFACT = "Best_response_model"

# Classifiers and their hyper-parameter grids (3 x 3 each).
TUNING: dict = {
    "classification_models": [
        "DecisionTreeClassifier",
        "RandomForestClassifier",
        "LogisticRegression",
        "GBTClassifier",
    ],
    "hyperparameters": {
        "DecisionTreeClassifier": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4]},
        "RandomForestClassifier": {"numTrees": [10, 20, 30], "maxDepth": [5, 10, 15]},
        "LogisticRegression": {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
        "GBTClassifier": {"maxIter": [10, 20, 50], "maxDepth": [3, 5, 7]},
    },
}
CV_FOLDS = 5

# --- End of fixed values ----------------------------------------------------
