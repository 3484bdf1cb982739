"""Declared schemas.

Fixed values: table and column names are the interface existing inputs and consumers use.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DATE, _TS, _INT = T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType()


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


DIM_WORKFORCE = _struct(
    worker_id=_STR,
    business_title=_STR,
    okta_department=_STR,
    hire_date=_DATE,
    first_name=_STR,
    last_name=_STR,
    email_address=_STR,
    company=_STR,
    manager=_STR,
    active=_STR,
    original_hire_date=_DATE,
    termination_date=_DATE,
    lst_updt_ts=_TS,
)
OKTA_USER = _struct(
    id=_STR, employee_number=_STR, lastupdated=_TS, display_name=_STR, status=_STR
)
DIM_SCHOOL = _struct(esd_school_name=_STR, school_type_abbrev=_STR, dwh_school_year_id=_INT)
LOOKER_USER_GROUP = _struct(business_titles=_STR, department_okta=_STR, network_groups=_STR)

TABLES: dict[str, T.StructType] = {
    "dim_workforce": DIM_WORKFORCE,
    "okta_user": OKTA_USER,
    "dim_school": DIM_SCHOOL,
    "looker_user_group": LOOKER_USER_GROUP,
}

# Columns of an assignment relation (older, current and reconciled sides alike).
ASSIGNMENT_COLUMNS = (
    "okta_users_id",
    "workday_employee_number",
    "looker_user_group",
    "okta_title",
    "okta_department_original",
    "esd_isactive",
    "esd_dateofhire",
    "exitdate",
    "lst_updt_ts",
    "okta_status",
    "okta_email",
    "okta_department",
    "dept_source",
    "company",
    "okta_manager",
    "first_name",
    "last_name",
    "display_name",
    "school_type_abbrev",
    "school_model",
    "user_group_status",
    "okta_hire_date",
    "okta_lastupdated",
)

# The older side lists the same columns with these three in front.
PREVIOUS_COLUMNS = ("workday_employee_number", "okta_users_id", "looker_user_group") + tuple(
    c
    for c in ASSIGNMENT_COLUMNS
    if c not in ("workday_employee_number", "okta_users_id", "looker_user_group")
)

MART_COLUMNS = (
    "dwh_workforce_id",
    "okta_users_id",
    *ASSIGNMENT_COLUMNS[2:],
    "user_group_type",
    "rnk",
)
