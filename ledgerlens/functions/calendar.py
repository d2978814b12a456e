"""Calendar ("moment") dimension and period selection.

Periods follow from the as-of date alone, so choosing them reads no fact table:

* ``C12M``  every month of the as-of year (future months included)
* ``L12M``  the 12 full months before the as-of month
* ``P12M``  the 12 months before those
* rolling   ``year_month`` from as-of minus 12 months to minus 1 month
* last 4 years: from January of ``year(as_of) - 3`` to the calendar's end

A period is a half-open range of month starts (``period_bounds``); its months are
available as a Python list (twelve entries) and as a DataFrame. The daily
calendar is generated between explicit dates, or over the years that the facts span. ``period=None`` takes the months
present in the facts, as a DataFrame (``months_from_data``).

``as_of`` is always an explicit argument: no operator reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIODS = ("L12M", "P12M", "C12M")
GRAINS = ("year_month", "year", "month", "quarter", "year_quarter")
MONTH_COLUMNS = ["year_month", "year", "month", "quarter", "year_quarter"]


def _quarter(month: Column) -> Column:
    """Integer-division quarter ``(month - 1) div 3 + 1``."""
    return F.floor((month - F.lit(1)) / F.lit(3)).cast("int") + F.lit(1)


def month_fields(ym: Column) -> list[Column]:
    """``'YYYY-MM'`` -> year_month, year, month, quarter, year_quarter."""
    y = F.substring(ym, 1, 4).cast("int")
    m = F.substring(ym, 6, 2).cast("int")
    return [ym.alias("year_month"), y.alias("year"), m.alias("month"),
            _quarter(m).alias("quarter"),
            F.concat(F.substring(ym, 1, 4), F.lit("-"), _quarter(m).cast("string")).alias("year_quarter")]


def parse_year_month(df: DataFrame, col: str = "year_month") -> DataFrame:
    """Add year, month, quarter, year_quarter parsed from a ``YYYY-MM`` column."""
    fields = month_fields(F.col(col))[1:]
    return df.select("*", *fields)


def month_start(d: dt.date, delta: int = 0) -> dt.date:
    """First day of the month ``delta`` months from ``d``'s month."""
    k = d.year * 12 + (d.month - 1) + delta
    return dt.date(k // 12, k % 12 + 1, 1)


def _day_fields() -> list[Column]:
    return ["date", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
            F.quarter("date").alias("quarter"), F.date_format("date", "yyyy-MM").alias("year_month"),
            F.concat(F.year("date").cast("string"), F.lit("-"), F.quarter("date").cast("string")).alias("year_quarter")]


def calendar_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Daily calendar from ``start`` to ``end``, both included: date, year,
    month, day, quarter, year_month, year_quarter."""
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return days.select(*_day_fields())


def calendar_over(bounds: DataFrame) -> DataFrame:
    """Daily calendar of the whole years from ``lo`` to ``hi`` of a one-row frame: it ends
    where the facts end, not at a constant. No bounds, no days."""
    day = lambda c, m, d: F.make_date(F.year(c), F.lit(m), F.lit(d))
    return bounds.select(F.explode(F.sequence(day("lo", 1, 1), day("hi", 12, 31))).alias("date")).select(*_day_fields())


def period_bounds(period: str, as_of: dt.date, until: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """[first month, first month after) of a period. ``until`` closes LAST4Y
    (default: the end of the as-of year)."""
    if period in ("L12M", "ROLLING"):
        return month_start(as_of, -12), month_start(as_of)
    if period == "P12M":
        return month_start(as_of, -24), month_start(as_of, -12)
    if period == "C12M":
        return dt.date(as_of.year, 1, 1), dt.date(as_of.year + 1, 1, 1)
    if period == "LAST4Y":
        last = until or dt.date(as_of.year, 12, 31)
        return dt.date(as_of.year - 3, 1, 1), month_start(last, 1)
    raise ValueError("Invalid period. Valid values are L12M, P12M, C12M, or None.")


def month_list(lo: dt.date, hi: dt.date) -> list[tuple]:
    """MONTH_COLUMNS of every month from ``lo`` up to ``hi``, excluded."""
    out = []
    while lo < hi:
        q = (lo.month - 1) // 3 + 1
        out.append((f"{lo:%Y-%m}", lo.year, lo.month, q, f"{lo.year}-{q}"))
        lo = month_start(lo, 1)
    return out


def months_frame(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """The same months as a DataFrame."""
    n = (hi.year - lo.year) * 12 + hi.month - lo.month
    first = F.add_months(F.lit(lo), F.col("id").cast("int"))
    return spark.range(max(n, 0)).select(*month_fields(F.date_format(first, "yyyy-MM")))


def previous_month_key(as_of: dt.date) -> str:
    """``FORMAT(DATEADD(MONTH,-1,now),'yyyy-MM')``."""
    return month_start(as_of, -1).strftime("%Y-%m")


def months_from_data(*facts: DataFrame) -> DataFrame:
    """Data-driven month set (period = None): distinct ``year_month`` of the
    given fact frames, union-distinct, with parsed calendar fields."""
    u = None
    for f in facts:
        m = f.select("year_month")
        u = m if u is None else u.unionByName(m)
    return u.distinct().select(*month_fields(F.col("year_month")))


def filtered_moments(spark: SparkSession, as_of: dt.date, period: str | None,
                     app_facts: DataFrame | None = None,
                     paid_facts: DataFrame | None = None) -> DataFrame:
    """Dispatcher: L12M / P12M / C12M / None (months present in the facts)."""
    if period is None:
        if app_facts is None or paid_facts is None:
            raise ValueError("period=None needs the application and paid facts")
        return months_from_data(app_facts, paid_facts)
    if period not in PERIODS:
        raise ValueError("Invalid period. Valid values are L12M, P12M, C12M, or None.")
    return months_frame(spark, *period_bounds(period, as_of))


def check_grain(group_by: str) -> str:
    if group_by not in GRAINS:
        raise ValueError("Invalid group_by. Valid values are year_month, year, month, quarter, year_quarter.")
    return group_by


def grain_value(group_by: str, prefix: str = "") -> Column:
    """Grain of a month row as text (the report's ``moment`` column)."""
    return F.col(prefix + check_grain(group_by)).cast("string")


def grain_sort_key(group_by: str, col: str = "moment") -> Column:
    """Numeric grains sort as numbers (1, 2, ..., 10), text grains as text."""
    if group_by in ("year", "month", "quarter"):
        return F.col(col).cast("int")
    return F.col(col)
