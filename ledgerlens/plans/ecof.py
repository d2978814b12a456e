"""Period reports with quotes (eCOF) beside applications and paid deals.

* ``ecof_period``       every month of a period, with text columns; the accept
                        rate is a truncated whole percentage
* ``ecof_period_text``  the same at a chosen grain's label (months only: one row a month)
* ``funnel_mapped``     months are mapped to the grain first, facts are summed
                        per grain value

The lender filter applies to applications and paid deals, not to quotes. Facts
are summed to one row per month before they meet.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import calendar as cal_fn
from ledgerlens.functions.measures import int_pct_text, money_text, pct2_text, pct_int, ratio
from ledgerlens.operators.facts import on_calendar
from ledgerlens.plans.funnel import FunnelInputs, FunnelParams, filtered_moments, monthly_result, report_inputs, report_months
from ledgerlens.plans.monthly import report_name_any

MONTH_SUMS = ["ecof_count", "ecof_advance", "accept_val", "accept", "decline", "pending", "proposed",
              "advance", "advance_count", "commission"]


def _quotient(num: str, den: str):
    return F.when(F.col(den) > 0, F.col(num).cast("decimal(28,8)") / F.col(den).cast("decimal(28,8)"))


def _plain(p: FunnelParams) -> FunnelParams:
    return dataclasses.replace(p.validate(), per_facility=False, include_budget=False, lender_on_ecof=False)


def _by_month(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    rows = report_months(p)
    return monthly_result(inp, p, None if rows is None else [r[0] for r in rows]).select("year_month", *MONTH_SUMS)


def ecof_period(inp: FunnelInputs, p: FunnelParams, label: str = "year_month") -> DataFrame:
    """One row per month of the period, applications or not."""
    p = _plain(p)
    months = filtered_moments(inp, p).select("year_month")
    name = report_name_any(inp, p.facility, p.group, p.lender).scalar()
    r = months.join(_by_month(report_inputs(inp, p), p), "year_month", "left")
    r = r.withColumn("commission_rate_avg", ratio("commission", "advance", "decimal(18,4)"))
    return r.select(
        name.alias("report_name"), F.col("year_month").alias(label),
        F.col("ecof_count").cast("bigint").alias("ecof_count"), F.col("ecof_advance").cast("decimal(18,2)").alias("ecof_advance"),
        money_text("ecof_advance").alias("ecof_advance_text"),
        F.col("proposed").cast("bigint").alias("proposed_count"), F.col("accept").cast("bigint").alias("accept_count"),
        F.col("accept_val").cast("decimal(18,2)").alias("accept_val"), money_text("accept_val").alias("accept_text"),
        money_text(_quotient("accept_val", "accept")).alias("accept_avg_text"),
        int_pct_text(pct_int("accept", F.col("accept") + F.col("decline"))).alias("accept_rate_text"),
        F.col("decline").cast("bigint").alias("decline_count"), F.col("pending").cast("bigint").alias("pending_count"),
        F.col("advance_count").cast("bigint").alias("advance_count"), F.col("advance").cast("decimal(18,2)").alias("advance_val"),
        money_text("advance").alias("advance_text"), money_text(_quotient("advance", "advance_count")).alias("advance_avg_text"),
        F.col("commission").cast("decimal(18,2)").alias("commission_val"), money_text("commission").alias("commission_text"),
        "commission_rate_avg", pct2_text("commission_rate_avg").alias("commission_rate_avg_text"),
    ).orderBy(label)


def ecof_period_text(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """``ecof_period`` with its month under the name ``group_by``. Other
    grains never worked in this version (defect D14) and are refused."""
    if p.group_by != "year_month":
        raise ValueError("this report has the month grain only")
    return ecof_period(inp, p, label="group_by")


def funnel_mapped(inp: FunnelInputs, p: FunnelParams, compat_days: tuple[dt.date, dt.date] | None = None,
                  compat_widen: bool = False) -> DataFrame:
    """Facts summed per grain value of the period.

    ``compat_widen``: facts are chosen by grain value, not by month, so those
    of other years count too (defect D19). ``compat_days`` (a daily calendar's
    bounds): every month is mapped once a day, so sums multiply (defect D2)."""
    p = _plain(p)
    wide = dataclasses.replace(p, period=None) if compat_widen else p
    months = _by_month(report_inputs(inp, wide), wide)
    grain = lambda df: df.select("*", *cal_fn.month_fields(F.col("year_month"))[1:])
    if compat_days is not None:
        days = cal_fn.calendar_days(inp.spark, *compat_days)
        months = on_calendar(grain(months), days, every_day=True).select("year_month", *MONTH_SUMS)
    facts = grain(months).groupBy(cal_fn.grain_value(p.group_by).alias("group_by")).agg(*(F.sum(c).alias(c) for c in MONTH_SUMS))
    values = filtered_moments(inp, p).select(cal_fn.grain_value(p.group_by).alias("group_by")).distinct()
    name = report_name_any(inp, p.facility, p.group, p.lender).scalar()
    r = values.join(facts, "group_by", "left")
    return r.select(
        name.alias("report_name"), "group_by",
        F.col("ecof_count").cast("bigint").alias("ecof_count"), F.col("ecof_advance").cast("decimal(18,2)").alias("ecof_advance"),
        F.col("proposed").cast("bigint").alias("proposed_count"), F.col("accept").cast("bigint").alias("accept_count"),
        F.col("accept_val").cast("decimal(18,2)").alias("accept_val"), ratio("accept_val", "accept", "decimal(18,6)").alias("accept_avg"),
        ratio("accept", F.col("accept") + F.col("decline"), "decimal(18,4)").alias("accept_rate"),
        F.col("decline").cast("bigint").alias("decline_count"), F.col("pending").cast("bigint").alias("pending_count"),
        F.col("advance_count").cast("bigint").alias("advance_count"), F.col("advance").cast("decimal(18,2)").alias("advance_val"),
        ratio("advance", "advance_count", "decimal(18,6)").alias("advance_avg"),
        F.col("commission").cast("decimal(18,2)").alias("commission_val"),
        ratio("commission", "advance", "decimal(18,4)").alias("commission_rate_avg"),
    ).orderBy(cal_fn.grain_sort_key(p.group_by, "group_by"))
