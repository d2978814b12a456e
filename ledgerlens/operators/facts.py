"""Fact views: applications, paid deals, budget, eCOF quotes.

Each view joins a fact table to the ``account`` dimension. Where the view is
an aggregate, the fact rows are first reduced to (facility_code, year, month)
so that the join with ``account`` and everything after it sees one row per
facility code and month instead of one per deal; Spark's partial aggregation
makes that reduction map-side, so a hot facility code never reaches a single
reducer as raw rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.filters import not_cash
from ledgerlens.sources.domain import year_month_of

ACCOUNT_KEYS = ["account_id", "facility_used_by_id", "facility_used_by_business_manager_initials",
                "facility_used_by_report_group_id", "facility_used_by_report_group",
                "facility_used_by_legal_name", "facility_used_by_trading_style",
                "facility_lender", "facility_code"]


def business_month() -> Column:
    """``YYYY-MM`` of a fact's own year and month."""
    return year_month_of(F.col("year"), F.col("month"))


OUTSIDE = "facts outside of the calendar: "


def on_calendar(facts: DataFrame, days: DataFrame, every_day: bool = False) -> DataFrame:
    """Facts joined to the calendar on (year, month): to each month's first
    day, or to every day of it (``every_day``: the fan-out of defect D2). A fact whose month
    the calendar does not have is an error, not a row less."""
    d = days if every_day else days.filter(F.col("day") == 1)
    j = facts.join(d.select("year", "month", F.col("date").alias("calendar_date")), ["year", "month"], "left")
    lost = F.raise_error(F.concat(F.lit(OUTSIDE), F.coalesce(F.col("year").cast("string"), F.lit("?")), F.lit("-"),
                                  F.coalesce(F.col("month").cast("string"), F.lit("?")))).cast("date")
    return j.withColumn("calendar_date", F.coalesce("calendar_date", lost))


def application_facts(account: DataFrame, application_mth: DataFrame, as_of: dt.date) -> DataFrame:
    """Applications with account keys, last four years (incl. current year).

    ``year_month`` is the business month, not the upload month.
    """
    a = application_mth.filter(F.col("year") >= as_of.year - 3).select(
        "facility_code", "accept", "accept_val", "decline", "decline_val",
        "pending", "pending_val", "month", "year")
    j = account.select(*ACCOUNT_KEYS).join(a, "facility_code")
    return j.select(*ACCOUNT_KEYS, "accept", "accept_val", "decline", "decline_val",
                    "pending", "pending_val", "month", "year", business_month().alias("year_month"))


def paid_facts(account: DataFrame, paid_mth: DataFrame, as_of: dt.date) -> DataFrame:
    """Paid deals per account keys x month: SUM(advance), COUNT(advance),
    SUM(commission); last four years.

    Deals are one row per facility code and month before the join, and account rows that are
    equal are one row with their number, so joined rows need no second grouping: a task
    holds no table of all account columns by month."""
    # the date range (not year(date)) reaches the parquet scan as a pushed filter
    since = dt.datetime(as_of.year - 3, 1, 1)
    p = (paid_mth.filter(F.col("date") >= F.lit(since).cast("timestamp_ntz"))
         .groupBy("facility_code", "year", "month")
         .agg(F.sum("advance").alias("advance"), F.count("advance").alias("advance_count"),
              F.sum("commission").alias("commission")))
    # dealt out by the join's key: counting equal rows then needs no shuffle of its own
    own = account.select(*ACCOUNT_KEYS).repartition("facility_code").groupBy(*ACCOUNT_KEYS).agg(F.count(F.lit(1)).alias("times"))
    # the account's rows of a task are its hash table: the many deals need no sort
    g = own.hint("shuffle_hash").join(p, "facility_code").withColumn("year_month", business_month()).select(
        *ACCOUNT_KEYS, "month", "year", "year_month",
        (F.col("advance") * F.col("times")).cast("decimal(18,2)").alias("advance"),
        (F.col("advance_count") * F.col("times")).alias("advance_count"),
        (F.col("commission") * F.col("times")).cast("decimal(18,2)").alias("commission"))
    return g.select(*ACCOUNT_KEYS, "advance", "advance_count", "commission",
                    "month", "year", "year_month")


def budget_facts(account: DataFrame, paid_budget: DataFrame,
                 facility: str | None = None) -> DataFrame:
    """Quarterly budget spread evenly over the quarter's three months.

    The reference joins every account row (one per facility code) to the
    budget and takes MAX per facility to undo that fan-out; we take the
    distinct facility keys first, so the join is one-to-one. Months come
    from a 12-element generator instead of a cross join.
    """
    acc = account.select("facility_used_by_id", "facility_used_by_report_group_id")
    b = paid_budget
    if facility is not None:
        acc = acc.filter(F.col("facility_used_by_id") == facility)
        b = b.filter(F.col("account_id") == facility)
    acc = acc.distinct()
    j = acc.join(b, acc.facility_used_by_id == b.account_id)
    g = j.groupBy("facility_used_by_id", "facility_used_by_report_group_id", "year",
                  F.col("lender").alias("facility_lender")).agg(
        *[F.max(q).alias(q) for q in ("q1", "q2", "q3", "q4")])
    m = g.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    qtr = F.floor((F.col("month") - 1) / 3).cast("int") + 1
    qval = (F.when(qtr == 1, F.col("q1")).when(qtr == 2, F.col("q2"))
             .when(qtr == 3, F.col("q3")).otherwise(F.col("q4")))
    return m.select(
        "facility_used_by_report_group_id", "facility_used_by_id", "facility_lender",
        business_month().alias("year_month"),
        "year", "month", qtr.alias("quarter"),
        F.concat(F.col("year").cast("string"), F.lit("-"), qtr.cast("string")).alias("year_quarter"),
        (qval / F.lit(3)).cast("decimal(18,6)").alias("budget"))


def ecof_facts(account: DataFrame, vw_ecof_all: DataFrame, account_ecof: DataFrame) -> DataFrame:
    """Non-cash quote documents per facility x lender x month.

    ``selected_funding_option <> 'cash'`` drops NULL options too (SQL
    three-valued logic), as in the reference.
    """
    v = (not_cash(vw_ecof_all)
         .groupBy("company_key", "selected_lender", "year", "month")
         .agg(F.count("doc_type").alias("n"), F.sum("selected_balance").alias("bal")))
    acc = account.select("account_id", "facility_used_by_report_group_id",
                         "facility_used_by_report_group", "facility_used_by_id",
                         "facility_used_by_legal_name").distinct()
    j = (v.join(account_ecof, v.company_key == account_ecof.ecof_key)
          .join(acc, "account_id"))
    g = j.groupBy(business_month().alias("year_month"), "facility_used_by_id", "facility_used_by_legal_name",
                  "facility_used_by_report_group_id", "facility_used_by_report_group",
                  "selected_lender").agg(
        F.sum("n").cast("bigint").alias("ecof_count"),
        F.sum("bal").cast("decimal(18,2)").alias("ecof_advance"))
    return g.select(F.col("facility_used_by_report_group_id").alias("report_group_id"),
                    "facility_used_by_report_group", "facility_used_by_id",
                    "facility_used_by_legal_name",
                    F.col("selected_lender").alias("facility_lender"),
                    "ecof_count", "ecof_advance", "year_month")
