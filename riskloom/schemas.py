"""Layouts, table schemas, defaults and rating thresholds (literal values only)."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Horizon columns
# --------------------------------------------------------------------------
N_PD_HORIZONS = 60
N_AS_HORIZONS = 5

PD_COLS = [f"PD_{i}" for i in range(1, N_PD_HORIZONS + 1)]
AS_COLS = [f"cdsvalue{i}" for i in range(1, N_AS_HORIZONS + 1)]
AS_CSV_COLS = [f"Y{i}" for i in range(1, N_AS_HORIZONS + 1)]

# --------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# --------------------------------------------------------------------------

# PD-implied rating thresholds, descending; a mean PD_12 at or above the
# k-th threshold (first match) gets level 22 - k.  Levels run 22 down to 1.
RATING_THRESHOLDS = [
    1.00000000e00, 2.36429705e-01, 1.84359218e-01, 1.24100491e-01, 8.68296884e-02,
    5.56660292e-02, 3.77365625e-02, 2.38300479e-02, 1.57466890e-02, 1.03831160e-02,
    6.67894949e-03, 4.23448222e-03, 2.79851727e-03, 1.78383466e-03, 1.15980161e-03,
    7.47792278e-04, 4.80311462e-04, 3.06114740e-04, 2.08283436e-04, 1.24841915e-04,
    9.05170934e-05, 0.0,
]
RATING_LEVELS = list(range(22, 0, -1))
RATING_DEFAULT = 1
ROLLING_ROWS = 10  # the mean covers the current row and the 9 before it

# Horizons served on the website table, in output order DFT1..DFT7.
WEBSITE_HORIZONS = [1, 3, 6, 12, 24, 36, 60]

# Horizons kept by the simple daily test table (matrix columns 5..12).
SIMPLE_HORIZONS = [1, 3, 6, 12, 24, 36, 48, 60]

# Sentinels.
ALL_SENTINEL = -99
EXCLUSION_FILL = "-1"
OPEN_END_TEXT = "9999-12-31 00:00:00"

# Text cells treated as missing (compared after trim, case-insensitive).
NULL_LIKE_TEXT = ["nan", "nat", ""]

# Column defaults of the company mapping table.
COMPANY_DEFAULTS = {
    "exchange_id": 99999,
    "country_exchange": "Unknown Exchange",
    "domicile_id": 99999,
    "country_domicile": "Unknown Domicile",
    "region_id": 99999,
    "region": "Unknown Region",
    "industry_sector_id": 99,
    "industry_sector": "Unclassifiable",
    "industry_group_id": 9910,
    "industry_group": "Unclassifiable",
    "industry_subgroup_id": 991010,
    "industry_subgroup": "Unclassifiable",
}

# Column defaults of the user table.
USER_DEFAULTS = {
    "type": "REGULAR",
    "status": "UNACTIVATED",
}

# Operation-log actions.
ACTION_DAILY = "daily_insertion"
ACTION_REVISION = "revision"

# Default day offsets for relative target dates.
OFFSET_DAILY = 2
OFFSET_REVISION = 6
OFFSET_UPLOAD = 1
REVISION_GUARD_DAYS = 15
FILL_LOOKBACK_DAYS = 10

# Economies expected in a complete daily delivery.
DAILY_ECONOMIES = sorted([
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 17, 18, 19, 20, 22, 15, 16, 26,
    75, 84, 23, 24, 25, 31, 33, 34, 35, 36, 37, 38, 40, 43, 45, 46, 47, 48,
    49, 51, 55, 56, 58, 61, 64, 65, 66, 67, 70, 74, 76, 77, 78, 79, 81, 82,
    88, 89, 29, 30, 32, 42, 52, 54, 69, 72, 85, 59, 27, 39, 50, 57, 63,
    83, 86, 71, 92, 95, 96, 97, 100, 102, 103, 107,
])

# --------------------------------------------------------------------------
# Positional column names of the unnamed source matrices and
# sheets (they must match the order in which the source writes them).
# --------------------------------------------------------------------------
LAYOUTS = {
    "simple_pd": ["comp_id", "yyyy", "mm", "dd",
                  "pd_1", "pd_3", "pd_6", "pd_12", "pd_24", "pd_36", "pd_48", "pd_60"],
    "pd_daily": ["company_id", "yyyy", "mm", "dd"] + PD_COLS,
    "pd_revision": ["company_id", "data_date"] + PD_COLS,
    "as_daily": ["company_id", "yyyy", "mm", "dd"] + AS_COLS,
    "pdir_daily": ["company_id", "yyyy", "mm", "dd", "pdir"],
    "credit_events_hist": ["CompanyID", "DateStr", "EventID", "DefaultType", "DateStr2", "EventID2"],
    "credit_events_daily": ["CompanyID", "DateStr", "EventID", "ColExtra", "DefaultType",
                            "DateStr2", "EventID2"],
    "exclusion_registry": ["Region", "CompanyNumber", "Country", "Ticker", "CompanyName", "Reason",
                           "Remark", "StartDate", "EndDate", "ErrorFoundDate", "SQLQuery",
                           "StopReason", "InternalRemarks", "No."],
}

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------
def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


PD_TABLE = T.StructType(
    [_f("data_date", T.DateType(), False), _f("company_id", T.LongType(), False),
     _f("calibration_date", T.DateType()), _f("operation_time", T.TimestampNTZType()),
     _f("PDIR", T.DoubleType())]
    + [_f(c, T.DoubleType()) for c in PD_COLS]
)
PD_KEYS = ["data_date", "company_id", "operation_time"]

AS_TABLE = T.StructType(
    [_f("data_date", T.DateType(), False), _f("econ_id", T.IntegerType()),
     _f("company_id", T.LongType(), False), _f("calibration_date", T.DateType()),
     _f("operation_time", T.TimestampNTZType())]
    + [_f(c, T.DoubleType()) for c in AS_COLS]
)

PDIR_TABLE = T.StructType([
    _f("data_date", T.DateType(), False), _f("econ_id", T.IntegerType()),
    _f("company_id", T.LongType(), False), _f("calibration_date", T.DateType()),
    _f("operation_time", T.TimestampNTZType()), _f("pdir", T.DoubleType()),
])

OPERATION_LOG = T.StructType([
    _f("data_start_date", T.DateType()), _f("data_end_date", T.DateType()),
    _f("econ_id", T.IntegerType()), _f("company_id", T.LongType()),
    _f("calibration_date", T.DateType()), _f("operation_time", T.TimestampNTZType()),
    _f("operation_action", T.StringType()),
])

COMPANY_MAPPING = T.StructType([
    _f("company_id", T.LongType(), False), _f("company_name", T.StringType()),
    _f("ticker", T.StringType()), _f("exchange_id", T.LongType()),
    _f("country_exchange", T.StringType()), _f("domicile_id", T.LongType()),
    _f("country_domicile", T.StringType()), _f("region_id", T.LongType()),
    _f("region", T.StringType()), _f("industry_sector_id", T.LongType()),
    _f("industry_sector", T.StringType()), _f("industry_group_id", T.LongType()),
    _f("industry_group", T.StringType()), _f("industry_subgroup_id", T.LongType()),
    _f("industry_subgroup", T.StringType()), _f("remark", T.StringType()),
])

EXCLUDED_COMPANIES = T.StructType([
    _f("region", T.StringType()), _f("company_id", T.LongType()), _f("country_id", T.LongType()),
    _f("ticker", T.StringType()), _f("company_name", T.StringType()), _f("reason", T.StringType()),
    _f("remark", T.StringType()), _f("start_date", T.DateType()), _f("end_date", T.DateType()),
    _f("error_found_date", T.DateType()), _f("sql_query", T.StringType()),
    _f("stop_reason", T.StringType()), _f("internal_remarks", T.StringType()),
])

CREDIT_EVENTS = T.StructType([
    _f("default_date", T.DateType(), False), _f("company_id", T.LongType()),
    _f("default_type", T.LongType()), _f("event_id", T.LongType()),
    _f("col_extra", T.LongType()), _f("additional_comments", T.StringType()),
    _f("updated", T.TimestampNTZType()),
])
CREDIT_EVENT_KEYS = ["company_id", "default_date", "default_type", "event_id"]

EVENT_CODES = T.StructType([
    _f("id", T.LongType()), _f("action_name", T.StringType()), _f("subcategory", T.StringType()),
])

USER_TABLE = T.StructType([
    _f("id", T.StringType(), False), _f("email", T.StringType()), _f("first_name", T.StringType()),
    _f("last_name", T.StringType()), _f("company", T.StringType()), _f("designation", T.StringType()),
    _f("department", T.StringType()), _f("industry", T.StringType()), _f("phone", T.StringType()),
    _f("type", T.StringType()), _f("status", T.StringType()), _f("activation_code", T.StringType()),
    _f("additional_comments", T.StringType()), _f("global_company_access", T.BooleanType()),
    _f("clients_access", T.StringType()), _f("second_level_agreement", T.BooleanType()),
    _f("hash_password", T.StringType()), _f("hash_token", T.StringType()),
    _f("created", T.TimestampNTZType()), _f("updated", T.TimestampNTZType()),
    _f("receive_occasional", T.BooleanType()), _f("receive_periodic", T.BooleanType()),
    _f("dashboard_access", T.BooleanType()), _f("buda_access", T.BooleanType()),
    _f("special_remarks", T.StringType()), _f("expiry_date", T.TimestampNTZType()),
    _f("buda_popup_disable", T.BooleanType()), _f("last_login", T.TimestampNTZType()),
])

# The source's JSON keys of a user record (they must match the
# input files), mapped to table columns.
USER_JSON_FIELDS = {
    "Email": "email", "FirstName": "first_name", "LastName": "last_name", "Company": "company",
    "Designation": "designation", "Department": "department", "Industry": "industry",
    "Phone": "phone", "Type": "type", "Status": "status", "ActivationCode": "activation_code",
    "AdditionalComments": "additional_comments", "GlobalCompanyAccess": "global_company_access",
    "ClientAccess": "clients_access", "SecondLevelAgreement": "second_level_agreement",
    "Hashpassword": "hash_password", "Hashtoken": "hash_token", "Created": "created",
    "Updated": "updated", "receive_occasional": "receive_occasional",
    "receive_periodic": "receive_periodic", "BudaAccess": "buda_access",
    "SpecialRemarks": "special_remarks", "ExpiryDate": "expiry_date",
    "BuDAPopUpDisable": "buda_popup_disable",
}
USER_BOOL_FIELDS = ["GlobalCompanyAccess", "SecondLevelAgreement", "receive_occasional",
                    "receive_periodic", "BudaAccess", "BuDAPopUpDisable"]
USER_TIME_FIELDS = ["Created", "Updated", "ExpiryDate"]
