"""Row predicates used by the reports.

Optional filters are added to the plan only when the parameter is given,
so a set filter reaches the parquet scan / join build side and an unset
one costs nothing.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def opt_eq(df: DataFrame, col: str, value) -> DataFrame:
    """``@p IS NULL OR col = @p``: unset keeps every row, NULL columns too."""
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def opt_eq_strict(df: DataFrame, col: str, value) -> DataFrame:
    """``col = COALESCE(@p, col)``: unset still drops rows whose col IS NULL."""
    if value is None:
        return df.filter(F.col(col).isNotNull())
    return df.filter(F.col(col) == F.lit(value))


def lender_ci(df: DataFrame, value: str | None, col: str = "facility_lender") -> DataFrame:
    """Case-insensitive lender match; unset keeps all rows."""
    if value is None:
        return df
    return df.filter(F.upper(F.col(col)) == F.upper(F.lit(value)))


def any_positive(cols: list[str]) -> Column:
    """``COALESCE(c1,0) > 0 OR COALESCE(c2,0) > 0 OR ...``"""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) > 0 for c in cols])


def drop_empty(df: DataFrame, measures: list[str]) -> DataFrame:
    """Keep rows where any measure is positive (NULL counts as 0)."""
    return df.filter(any_positive(measures))


def overdue(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Open CRM activities past their scheduled end, with a type and a
    non-empty 'regarding'."""
    return df.filter((F.col("scheduled_end") < F.lit(now).cast("timestamp_ntz"))
                     & F.col("actual_end").isNull()
                     & F.col("activity_type").isNotNull()
                     & F.col("regarding").isNotNull()
                     & (F.col("regarding") != ""))


def not_cash(df: DataFrame, col: str = "selected_funding_option") -> DataFrame:
    """``col <> 'cash'``: NULL options are dropped as well."""
    return df.filter(F.col(col) != "cash")


def zero_if_null(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0))


# Labels of CRM activity codes (fixed values of the notification report).
ACTIVITY_LABELS = {
    "cal_internalactions": "Internal Actions",
    "cal_externalactions": "External Actions",
    "cal_action": "Action",
    "phonecall": "Phone Call",
    "appointment": "Appointment",
    "email": "Email",
    "cal_documentactivity": "Document Activity",
    "task": "Task",
}
NOT_FOUND_LABEL = "Not Found"


def activity_label(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in ACTIVITY_LABELS.items() for x in kv])
    return F.coalesce(F.element_at(m, c), F.lit(NOT_FOUND_LABEL))
