"""Monthly account reports (earlier report family).

* ``rolling_12m``           per month of the rolling window (or last four
                            years) plus an optional TOTAL row;
* ``monthly_applications``  months present in both applications and paid
                            deals (inner join), optionally limited to L12M;
* ``monthly_period``        every month of a period (left join), adding
                            commission and the average of monthly rates.

All facts are aggregated to one row per month before they meet, so every
join here is between month-sized frames.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import calendar as cal_fn
from ledgerlens.functions.filters import opt_eq, opt_eq_strict
from ledgerlens.functions.measures import int_div_pct, int_pct_text, money_text, pct2_text, pct_int, ratio
from ledgerlens.plans.funnel import ALL_LENDERS, DEFAULT_COMPANY, FunnelInputs

TOTAL_LABEL = "TOTAL"


def report_name_any(inp: FunnelInputs, facility: str | None, group: str | None,
                    lender: str | None) -> DataFrame:
    """One-row frame ``report_name``: group name when a group is given, else
    the facility's legal name, else the default company label; then
    ``' : '`` and the lender or ``All``."""
    a = inp.account
    cond = F.lit(False)
    if facility is not None:
        cond = cond | (F.col("facility_used_by_id") == facility)
    if group is not None:
        cond = cond | (F.col("facility_used_by_report_group_id") == group)
    if group is not None:
        name = F.col("facility_used_by_report_group")
    elif facility is not None:
        name = F.col("facility_used_by_legal_name")
    else:
        name = F.lit(DEFAULT_COMPANY)
    n = a.filter(cond).agg(F.min(name).alias("n"))
    suffix = F.lit(" : " + (lender if lender is not None else ALL_LENDERS))
    return n.select(F.concat(F.coalesce(F.col("n"), F.lit(DEFAULT_COMPANY)), suffix).alias("report_name"))


def _strict_scope(df: DataFrame, facility, group, lender, lender_strict: bool) -> DataFrame:
    df = opt_eq_strict(df, "facility_used_by_id", facility)
    df = opt_eq_strict(df, "facility_used_by_report_group_id", group)
    if lender_strict:
        df = opt_eq_strict(df, "facility_lender", lender)
    elif lender is not None:
        df = df.filter(F.col("facility_lender") == lender)
    return df


def _apps_by_month(inp, facility, group, lender, lender_strict=False, loose=False) -> DataFrame:
    a = inp.applications
    if loose:
        a = opt_eq(opt_eq(opt_eq(a, "facility_used_by_id", facility),
                          "facility_used_by_report_group_id", group), "facility_lender", lender)
    else:
        a = _strict_scope(a, facility, group, lender, lender_strict)
    return a.groupBy("year_month").agg(
        F.sum("accept_val").cast("decimal(18,2)").alias("accept_val"),
        F.sum("accept").cast("bigint").alias("accept"),
        F.sum("decline").cast("bigint").alias("decline"),
        F.sum("pending").cast("bigint").alias("pending"))


def _paids_by_month(inp, facility, group, lender, lender_strict=False, loose=False) -> DataFrame:
    p = inp.paids
    if loose:
        p = opt_eq(opt_eq(opt_eq(p, "facility_used_by_id", facility),
                          "facility_used_by_report_group_id", group), "facility_lender", lender)
    else:
        p = _strict_scope(p, facility, group, lender, lender_strict)
    g = p.groupBy("year_month").agg(
        F.sum("advance").cast("decimal(18,2)").alias("advance"),
        F.sum("advance_count").cast("bigint").alias("advance_count"),
        F.sum("commission").cast("decimal(18,2)").alias("commission"))
    return g.withColumn("commission_rate_avg", ratio("commission", "advance", "decimal(18,4)"))


def rolling_12m(inp: FunnelInputs, as_of: dt.date, facility=None, group=None, lender=None,
                rolling: bool = True, totals: bool = True, until: dt.date | None = None,
                compat_totals: bool = False) -> DataFrame:
    """Rolling 12 months (or last four years) with a TOTAL row.

    The TOTAL row is a grouping set of the month-sized frame, so months and
    total come of one pass. ``compat_totals``: without totals, the row is
    there all the same, all NULL but its label (defect D9)."""
    lo, hi = cal_fn.period_bounds("ROLLING" if rolling else "LAST4Y", as_of, until)
    months = cal_fn.months_frame(inp.spark, lo, hi).select("year_month")
    inp = inp.windowed(lo, hi)
    a = _apps_by_month(inp, facility, group, lender)
    p = _paids_by_month(inp, facility, group, lender)
    r = months.join(a, "year_month", "left").join(p.drop("commission", "commission_rate_avg"),
                                                   "year_month", "left")
    r = r.withColumn("proposed", F.col("accept") + F.col("decline"))
    sums = [F.sum(c).cast(r.schema[c].dataType).alias(c) for c in ("proposed", "accept", "accept_val", "advance_count", "advance")]
    grouped = r.rollup("year_month").agg(F.grouping("year_month").alias("is_total"), *sums)
    total = F.col("is_total") == 1
    if not totals:
        grouped = grouped.filter(~total)

    def average(value: str, count: str) -> Column:
        of_sums = F.when(F.col(count) != 0, F.col(value).cast("decimal(28,8)") / F.col(count).cast("decimal(28,8)"))
        return F.when(total, money_text(of_sums)).otherwise(money_text(ratio(value, count, "decimal(18,2)")))

    # one-row global aggregate used as a scalar subquery (computed once)
    name = report_name_any(inp, facility, group, lender).scalar()
    out = grouped.select(
        name.alias("report_name"), F.when(total, F.lit(TOTAL_LABEL)).otherwise(F.col("year_month")).alias("year_month"),
        "proposed", "accept",
        money_text("accept_val").alias("accept_val"),
        average("accept_val", "accept").alias("accept_average"),
        F.when(total, int_pct_text(int_div_pct("accept", "proposed")))
         .otherwise(int_pct_text(pct_int("accept", F.col("proposed")))).alias("accept_rate"),
        "advance_count",
        money_text("advance").alias("advance"),
        average("advance", "advance_count").alias("advance_average"))
    if not totals and compat_totals:
        empty = inp.spark.range(1).select(*(
            (F.lit(TOTAL_LABEL) if f.name == "year_month" else F.lit(None)).cast(f.dataType).alias(f.name) for f in out.schema))
        out = out.unionByName(empty)
    return out.orderBy("year_month")


def monthly_applications(inp: FunnelInputs, as_of: dt.date, facility=None, group=None, lender=None,
                         l12m: bool = False) -> DataFrame:
    """Months present in both applications and paid deals."""
    if l12m:  # whole months, so the window is the filter
        inp = inp.windowed(*cal_fn.period_bounds("L12M", as_of))
    a = _apps_by_month(inp, facility, group, lender)
    p = _paids_by_month(inp, facility, group, lender, lender_strict=True)
    j = a.join(p, "year_month")
    name = report_name_any(inp, facility, group, lender).scalar()
    return j.select(
        name.alias("report_name"), "year_month", "accept_val", "accept", "decline", "pending",
        (F.col("accept") + F.col("decline")).alias("proposed"),
        money_text("accept_val").alias("accept_val_text"),
        money_text(F.when(F.col("accept") > 0, F.col("accept_val").cast("decimal(28,8)")
                          / F.col("accept").cast("decimal(28,8)"))).alias("accept_average"),
        int_pct_text(pct_int("accept", F.col("accept") + F.col("decline"))).alias("accept_rate"),
        "advance_count",
        money_text("advance").alias("advance"),
        money_text(F.when(F.col("advance") > 0, F.col("advance").cast("decimal(28,8)")
                          / F.col("advance_count").cast("decimal(28,8)"))).alias("advance_average"),
    ).orderBy("year_month")


def monthly_period(inp: FunnelInputs, as_of: dt.date, period: str | None = "L12M",
                   facility=None, group=None, lender=None) -> DataFrame:
    """Every month of the period, with commission and the average of the
    monthly commission rates (rates are averaged, not recomputed)."""
    months = cal_fn.filtered_moments(inp.spark, as_of, period, inp.applications, inp.paids).select("year_month")
    if period is not None:
        inp = inp.windowed(*cal_fn.period_bounds(period, as_of))
    a = _apps_by_month(inp, facility, group, lender, loose=True).join(months, "year_month")
    p = _paids_by_month(inp, facility, group, lender, loose=True).join(months, "year_month")
    res = a.join(p, "year_month", "left").select(
        "year_month", "accept_val", "accept", "decline", "pending",
        (F.col("accept") + F.col("decline")).alias("proposed"),
        pct_int("accept", F.col("accept") + F.col("decline")).alias("accept_rate"),
        F.when(F.col("accept") > 0, F.col("accept_val").cast("decimal(28,8)")
               / F.col("accept").cast("decimal(28,8)")).alias("accept_average"),
        "advance_count", "advance",
        F.when(F.col("advance_count") > 0, F.col("advance").cast("decimal(28,8)")
               / F.col("advance_count").cast("decimal(28,8)")).alias("advance_average"),
        "commission", "commission_rate_avg")
    j = months.join(res, "year_month", "left")
    name = report_name_any(inp, facility, group, lender).scalar()
    return j.select(
        name.alias("report_name"), "year_month", "accept_val", "accept", "decline", "pending", "proposed",
        money_text("accept_val").alias("accept_val_text"),
        money_text("accept_average").alias("accept_average"),
        int_pct_text("accept_rate").alias("accept_rate"),
        "advance_count",
        money_text("advance").alias("advance"),
        money_text("advance_average").alias("advance_average"),
        "commission",
        money_text("commission").alias("commission_formatted"),
        "commission_rate_avg",
        pct2_text("commission_rate_avg").alias("commission_rate_avg_formatted"),
    ).orderBy("year_month")
