"""Overdue CRM notifications (list and has-any flag)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.filters import activity_label, overdue


def notifications(notif: DataFrame, users: DataFrame, now: dt.datetime,
                  email: str | None = None) -> DataFrame:
    """Open, overdue activities with label and dd/mm/yyyy date, sorted by
    scheduled end. With an email the user join becomes an inner join."""
    n = overdue(notif, now)
    u = users
    how = "left"
    if email is not None:
        u = u.filter(F.col("email") == email)
        how = "inner"
    j = n.join(u, "crm_user_id", how)
    return j.select("scheduled_end",
                    F.date_format("scheduled_end", "dd/MM/yyyy").alias("scheduled_end_date"),
                    activity_label("activity_type").alias("activity_type"),
                    "subject", "regarding", "link", "initials", "name").orderBy("scheduled_end")


def has_notifications(notif: DataFrame, users: DataFrame, now: dt.datetime,
                      email: str | None) -> DataFrame:
    """One row ``flag``: 1 when the user has any overdue item, else 0
    (a NULL email matches nobody)."""
    n = overdue(notif, now)
    u = users.filter(F.col("email") == F.lit(email).cast("string"))
    c = n.join(u, "crm_user_id").agg(F.count(F.lit(1)).alias("c"))
    return c.select(F.when(F.col("c") > 0, 1).otherwise(0).alias("flag"))
