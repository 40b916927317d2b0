"""Values the results depend on, kept in one place."""

# ---------------------------------------------------------------------------
# Names, domains, thresholds and formats of the data model.
# ---------------------------------------------------------------------------

RAW_COLUMNS = (
    "inspection_id", "dba_name", "aka_name", "license_number",
    "facility_type", "risk", "address", "city", "state", "zip",
    "inspection_date", "inspection_type", "results", "violations",
    "latitude", "longitude", "location",
)

RAW_TYPES = {"inspection_id": "bigint", "latitude": "double", "longitude": "double"}

# Texts a CSV field may hold for "no value" (the default list of pandas.read_csv).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

JURISDICTION_CITY = "CHICAGO"
DATE_FORMAT = "M/d/yyyy"
VIOLATION_SEPARATOR = "|"
UNKNOWN = "UNKNOWN"
OTHER = "OTHER"
RARE_TYPE_MIN_ROWS = 10

# Digit looked for in the risk text, level name, rank; the first match wins.
RISK_LEVELS = (("1", "HIGH", 1), ("2", "MEDIUM", 2), ("3", "LOW", 3))
RISK_LEVEL_DOMAIN = ("HIGH", "MEDIUM", "LOW", "UNKNOWN")

RESULT_DOMAIN = (
    "Pass", "Fail", "Pass w/ Conditions", "Out of Business",
    "No Entry", "Not Ready", "Business Not Located",
)
PASS_RESULTS = ("Pass", "Pass w/ Conditions")
FAIL_RESULT = "Fail"
EVALUATED_RESULTS = ("Pass", "Pass w/ Conditions", "Fail")

MART_COLUMNS = (
    "inspection_id", "license_number", "dba_name", "aka_name",
    "facility_type_grouped", "facility_type_original",
    "risk_level", "risk_rank",
    "address", "city", "zip", "latitude", "longitude",
    "inspection_date", "inspection_year", "inspection_month",
    "inspection_quarter", "inspection_year_month",
    "inspection_type", "results", "pass_flag", "fail_flag",
    "violation_count", "violations_raw",
    "license_total_inspections", "license_total_fails", "license_total_passes",
    "repeat_fail_flag", "days_since_previous_inspection",
    "flag_fail_without_violations", "flag_invalid_risk", "flag_missing_license",
    "ingested_at",
)

EXPLORE_COLUMNS = (
    "inspection_id", "facility_type_grouped", "risk_level", "risk_rank",
    "inspection_type", "results", "pass_flag", "fail_flag", "violation_count",
    "inspection_year", "inspection_month", "inspection_quarter", "zip",
    "license_total_inspections", "license_total_fails", "repeat_fail_flag",
    "days_since_previous_inspection", "flag_fail_without_violations",
    "flag_missing_license",
)

MODEL_COLUMNS = (
    "facility_type_grouped", "risk_level", "risk_rank", "inspection_type",
    "results", "violation_count", "inspection_year", "inspection_month",
    "inspection_quarter", "license_total_inspections", "license_total_fails",
    "repeat_fail_flag", "days_since_previous_inspection",
)

FIRST_YEAR = 2015
LAST_TRAINING_YEAR = 2023
TOP_TYPES = 10
CV_FOLDS = 5

# Encoded column -> the column holding its code.
LABEL_COLUMNS = {
    "facility_type_grouped": "facility_type_enc",
    "risk_level": "risk_level_enc",
    "inspection_type": "inspection_type_enc",
}

FEATURES = (
    "facility_type_enc", "risk_rank", "risk_level_enc", "inspection_type_enc",
    "violation_count", "inspection_year", "inspection_month",
    "inspection_quarter", "license_total_inspections", "license_total_fails",
    "repeat_fail_flag", "days_since_previous_inspection",
)

TREES = 300
TREE_DEPTH = 6
LEARNING_RATE = 0.05
SEED = 42
SPLIT_BINS = 256  # split candidates per feature

JDBC_BATCH_ROWS = 5000

STAGING_TESTS = {
    "unique": ("inspection_id",),
    "not_null": (
        "inspection_id", "inspection_date", "results", "violation_count",
        "flag_out_of_jurisdiction", "flag_fail_without_violations",
        "flag_invalid_risk", "flag_missing_license",
    ),
    "accepted_values": {
        "results": RESULT_DOMAIN,
        "risk_level": RISK_LEVEL_DOMAIN,
    },
}

MART_TESTS = {
    "unique": ("inspection_id",),
    "not_null": (
        "inspection_id", "inspection_date", "results", "pass_flag", "fail_flag",
        "violation_count", "repeat_fail_flag", "inspection_year",
        "facility_type_grouped",
    ),
    "accepted_values": {
        "pass_flag": (0, 1),
        "fail_flag": (0, 1),
        "risk_level": RISK_LEVEL_DOMAIN,
    },
}
