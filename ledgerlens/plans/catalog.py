"""Registry of named queries: Spark plan + check SQL.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, sql | None)``. Each
build reads the driver tables under ``sf_dir`` and derives everything else
with Spark, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans import funnel as fn
from ledgerlens.plans import oracle_sql as O
from ledgerlens.sources.tables import Tables

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# Report parameters of the registered queries (facility = nation 7, group =
# region 1, lender = segment BUILDING, also given in lower case).
FACILITY = "U7"
GROUP = "G1"
LENDER = "BUILDING"
LENDER_LC = "building"


def first_day(month: str):
    """First day of a ``YYYY-MM`` month."""
    import datetime as dt
    return dt.date(int(month[:4]), int(month[5:]), 1)


def register(name: str, sql: str | None):
    def deco(f):
        QUERIES[name] = (f, sql)
        return f
    return deco


def _funnel_query(name: str, **kw):
    @register(name, O.funnel_sql(**kw))
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
        return fn.funnel(inp, fn.FunnelParams(**kw))
    return q


# Numeric funnel, one row per moment, every grain
for _g in ("year_month", "year", "month", "quarter", "year_quarter"):
    _funnel_query(f"funnel_by_{_g}", group=GROUP, group_by=_g, per_facility=False, include_budget=False)
_funnel_query("funnel_by_year_compat", group=GROUP, group_by="year", per_facility=False,
              include_budget=False, compat_fanout=True)

# With budget (one row per moment)
_funnel_query("funnel_budget", facility=FACILITY, per_facility=False)
_funnel_query("funnel_budget_group", group=GROUP, per_facility=False)
_funnel_query("funnel_lender", facility=FACILITY, lender=LENDER_LC, per_facility=False)
_funnel_query("funnel_budget_max", group=GROUP, per_facility=False, budget_agg="max")
# Latest version, per facility in group mode
_funnel_query("funnel_facility", facility=FACILITY)
_funnel_query("funnel_group_facilities", group=GROUP)
_funnel_query("funnel_group_nonempty", group=GROUP, lender=LENDER)
_funnel_query("funnel_unknown_group", group="G99")
_funnel_query("funnel_global")
_funnel_query("funnel_p12m_quarter", group=GROUP, period="P12M", group_by="quarter")
_funnel_query("funnel_c12m", facility=FACILITY, period="C12M")
_funnel_query("funnel_all_months", group=GROUP, period=None)
# the placeholder of an unknown group, with its empty rows kept
_funnel_query("funnel_unknown_group_rows", group="G99", drop_empty=False)
_funnel_query("funnel_spine_union", group=GROUP, lender=LENDER, period=None, spine="union")


# Period reports with quotes; the lender filter does not apply to quotes
def _ecof_query(name, fn_name, sql, extra=None, **kw):
    @register(name, sql)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ledgerlens.plans import ecof
        return getattr(ecof, fn_name)(fn.FunnelInputs.from_tables(Tables(spark, sf_dir)), fn.FunnelParams(**kw), **(extra or {}))
    return q


_ecof_query("ecof_period", "ecof_period", O.ecof_period_sql(group=GROUP, lender=LENDER), group=GROUP, lender=LENDER)
_ecof_query("ecof_period_all", "ecof_period", O.ecof_period_sql(period=None, facility=FACILITY), period=None, facility=FACILITY)
_ecof_query("ecof_period_text", "ecof_period_text", O.ecof_period_sql("group_by", period="P12M", facility=FACILITY, lender=LENDER),
            period="P12M", facility=FACILITY, lender=LENDER)
_ecof_query("funnel_mapped", "funnel_mapped", O.funnel_mapped_sql("quarter", group=GROUP, lender=LENDER),
            group_by="quarter", group=GROUP, lender=LENDER)
_ecof_query("funnel_mapped_compat", "funnel_mapped",
            O.funnel_mapped_sql("year", group=GROUP, lender=LENDER, compat_days=True, compat_widen=True),
            extra={"compat_days": (O.D.CALENDAR_START, O.D.CALENDAR_END), "compat_widen": True},
            group_by="year", group=GROUP, lender=LENDER)


# --------------------------------------------------------------------------
# modular steps of the latest report (group mode)
# --------------------------------------------------------------------------

def _funnel_cte(select: str, **kw) -> str:
    """A query over the report's CTEs instead of its final SELECT."""
    return O.with_fixtures(select, O.funnel_parts(**kw)[0])


def _step(name: str, step, cols: dict[str, tuple[str, str]]):
    """cols: output column -> (metric of the check SQL, type)."""
    p = fn.FunnelParams(group=GROUP)

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ledgerlens.functions.calendar import month_fields
        from pyspark.sql import functions as F
        inp = fn.report_inputs(fn.FunnelInputs.from_tables(Tables(spark, sf_dir)), p)
        s = step(inp, p, [r[0] for r in fn.report_months(p)])
        return s.select(*month_fields(F.col("year_month")),
                        F.col("fkey").alias("facility_used_by_id"),
                        *[F.col(c).cast(t).alias(c) for c, (_, t) in cols.items()])

    metrics = [m for m, _ in cols.values()]
    register(name, _funnel_cte(
        f"SELECT months.*, k AS facility_used_by_id, {', '.join(f'CAST({m} AS {t}) AS {c}' for c, (m, t) in cols.items())} "
        f"FROM (SELECT k, ym, {O._turned(metrics)} FROM by_month WHERE metric IN ({', '.join(map(repr, metrics))}) GROUP BY k, ym) "
        f"JOIN months ON months.year_month = ym", group=GROUP))(q)


_step("step_applications", fn.step_applications,
      {"accept_val": ("accept_val", "decimal(18,2)"), "accept": ("accept", "bigint"), "decline": ("decline", "bigint"),
       "pending": ("pending", "bigint"), "proposed": ("proposed", "bigint")})
_step("step_paids", fn.step_paids, {"advance": ("advance", "decimal(18,2)"), "advance_count": ("advance_count", "bigint"),
                                    "commission": ("commission", "decimal(18,2)")})
_step("step_ecof", fn.step_ecof, {"ecof_count": ("ecof_count", "bigint"), "ecof_advance": ("ecof_advance", "decimal(18,2)")})
_step("step_budget", fn.step_budget, {"budget": ("budget", "decimal(18,2)")})


@register("step_facilities", _funnel_cte("SELECT id AS facility_used_by_id, name AS facility_used_by_name FROM places", group=GROUP))
def q_step_facilities(spark, sf_dir):
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
    return fn.facilities(inp, fn.FunnelParams(group=GROUP)).select("facility_used_by_id", "facility_used_by_name")


@register("report_name", _funnel_cte(f"SELECT name || ' : {LENDER}' AS report_name FROM places", facility=FACILITY, lender=LENDER))
def q_report_name(spark, sf_dir):
    from pyspark.sql import functions as F
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
    p = fn.FunnelParams(facility=FACILITY, lender=LENDER)
    return fn.report_name_frame(inp, p).select(fn.report_name(F.col("name"), LENDER).alias("report_name"))


# --------------------------------------------------------------------------
# calendar
# --------------------------------------------------------------------------

@register("moment_calendar", O.with_fixtures(
    "SELECT m.*, CAST(coalesce(n, 0) AS BIGINT) AS orders FROM moment m "
    "LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1) o USING (date)"))
def q_moment_calendar(spark, sf_dir):
    """Every day of the calendar with its orders."""
    from pyspark.sql import functions as F
    from ledgerlens.functions import calendar as C
    t = Tables(spark, sf_dir)
    o = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return (C.calendar_over(O.D.date_bounds(t)).join(o, "date", "left")
            .select("date", "year", "month", "day", "quarter", "year_month", "year_quarter", F.coalesce("n", F.lit(0)).alias("orders")))


def _period_query(name, period, as_of=O.AS_OF):
    """Every month of the period with its orders."""
    @register(name, O.with_fixtures(
        f"SELECT m.*, CAST(coalesce(n, 0) AS BIGINT) AS orders FROM ({O.period_sql(period, as_of)}) m LEFT JOIN "
        f"(SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS n FROM orders GROUP BY 1) o USING (year_month) "
        f"ORDER BY year_month"))
    def q(spark, sf_dir):
        from pyspark.sql import functions as F
        from ledgerlens.functions import calendar as C
        bounds = C.period_bounds(period, as_of, O.D.CALENDAR_END)
        o = O.D.in_window(Tables(spark, sf_dir).orders.select("o_orderdate"), "o_orderdate", bounds)
        o = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("year_month")).agg(F.count(F.lit(1)).alias("n"))
        return (C.months_frame(spark, *bounds).join(o, "year_month", "left")
                .select(*C.MONTH_COLUMNS, F.coalesce("n", F.lit(0)).alias("orders")).orderBy("year_month"))
    return q


_period_query("moment_c12m", "C12M")
_period_query("moment_l12m", "L12M")
_period_query("moment_p12m", "P12M")
_period_query("moment_rolling", "ROLLING")
_period_query("moment_last4y", "LAST4Y")
# after the data's end: the months are there all the same
_LATER = __import__("datetime").date(2002, 6, 15)
_period_query("moment_l12m_later", "L12M", _LATER)
_period_query("moment_c12m_later", "C12M", _LATER)


@register("moment_from_data", O.with_fixtures(O.period_sql(None) + " ORDER BY year_month"))
def q_moment_from_data(spark, sf_dir):
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
    return fn.filtered_moments(inp, fn.FunnelParams(period=None)).orderBy("year_month")


@register("parse_year_month", O.with_fixtures(
    "SELECT year_month, CAST(left(year_month, 4) AS INTEGER) AS year, CAST(right(year_month, 2) AS INTEGER) AS month, "
    "CAST((CAST(right(year_month, 2) AS INTEGER) - 1) // 3 + 1 AS INTEGER) AS quarter, "
    "left(year_month, 4) || '-' || CAST((CAST(right(year_month, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR) AS year_quarter "
    "FROM (SELECT DISTINCT year_month FROM paid_mth) p"))
def q_parse_year_month(spark, sf_dir):
    from ledgerlens.functions.calendar import parse_year_month
    from ledgerlens.sources import domain
    return parse_year_month(domain.paid_mth(Tables(spark, sf_dir)).select("year_month").distinct())


@register("grain_mapping", O.with_fixtures(
    "SELECT DISTINCT year_month, year_month[:4] || '-' || ((CAST(year_month[6:] AS INTEGER) + 2) // 3) AS group_value "
    "FROM application_facts"))
def q_grain_mapping(spark, sf_dir):
    """Grain value of every month that has applications."""
    from pyspark.sql import functions as F
    from ledgerlens.functions import calendar as C
    m = fn.FunnelInputs.from_tables(Tables(spark, sf_dir)).applications.select("year_month").distinct()
    return m.select(*C.month_fields(F.col("year_month"))).select("year_month", C.grain_value("year_quarter").alias("group_value"))


@register("join_calendar", O.with_fixtures(
    "SELECT f.facility_used_by_id, m.date AS calendar_date, CAST(sum(f.accept) AS BIGINT) AS accept "
    "FROM application_facts f JOIN moment m ON f.year = m.year AND f.month = m.month AND m.day = 1 GROUP BY ALL"))
def q_join_calendar(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions import calendar as C
    from ledgerlens.operators.facts import on_calendar
    t = Tables(spark, sf_dir)
    a = fn.FunnelInputs.from_tables(t).applications
    a = a.groupBy("facility_used_by_id", "year", "month").agg(F.sum("accept").cast("bigint").alias("accept"))
    return on_calendar(a, C.calendar_over(O.D.date_bounds(t))).select("facility_used_by_id", "calendar_date", "accept")


# --------------------------------------------------------------------------
# fact views
# --------------------------------------------------------------------------

@register("application_facts", O.with_fixtures("SELECT * FROM application_facts"))
def q_application_facts(spark, sf_dir):
    return fn.FunnelInputs.from_tables(Tables(spark, sf_dir)).applications


@register("paid_facts", O.with_fixtures("SELECT * FROM paid_facts"))
def q_paid_facts(spark, sf_dir):
    return fn.FunnelInputs.from_tables(Tables(spark, sf_dir)).paids


@register("budget_facts", O.with_fixtures("SELECT * FROM budget_facts"))
def q_budget_facts(spark, sf_dir):
    return fn.FunnelInputs.from_tables(Tables(spark, sf_dir)).budget


@register("ecof_facts", O.with_fixtures("SELECT * FROM ecof_facts"))
def q_ecof_facts(spark, sf_dir):
    return fn.FunnelInputs.from_tables(Tables(spark, sf_dir)).ecof


# --------------------------------------------------------------------------
# monthly report family
# --------------------------------------------------------------------------

def _monthly(name, fn_name, sql, **kw):
    @register(name, sql)
    def q(spark, sf_dir):
        from ledgerlens.plans import monthly
        inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
        return getattr(monthly, fn_name)(inp, O.AS_OF, **kw)
    return q


_monthly("rolling_12m", "rolling_12m", O.rolling_sql(facility=FACILITY, totals=False),
         facility=FACILITY, totals=False)
_monthly("rolling_12m_totals", "rolling_12m", O.rolling_sql(group=GROUP, lender=LENDER),
         group=GROUP, lender=LENDER)
_monthly("rolling_12m_compat_totals", "rolling_12m", O.rolling_sql(facility=FACILITY, totals=False, compat_totals=True),
         facility=FACILITY, totals=False, compat_totals=True)
_monthly("rolling_last4y", "rolling_12m", O.rolling_sql(group=GROUP, rolling=False),
         group=GROUP, rolling=False, until=O.D.CALENDAR_END)
_monthly("monthly_applications", "monthly_applications", O.monthly_applications_sql(group=GROUP),
         group=GROUP)
_monthly("monthly_applications_l12m", "monthly_applications",
         O.monthly_applications_sql(facility=FACILITY, lender=LENDER, l12m=True),
         facility=FACILITY, lender=LENDER, l12m=True)
for _p, _k in (("L12M", "l12m"), ("P12M", "p12m"), ("C12M", "c12m"), (None, "all")):
    _monthly(f"monthly_period_{_k}", "monthly_period",
             O.monthly_period_sql(period=_p, group=GROUP), period=_p, group=GROUP)


# --------------------------------------------------------------------------
# summaries, guards, job log
# --------------------------------------------------------------------------

def prev_month():
    from ledgerlens.functions.calendar import previous_month_key
    return previous_month_key(O.AS_OF)


@register("application_summary", O.with_fixtures(O.application_summary_sql(prev_month())))
def q_application_summary(spark, sf_dir):
    from ledgerlens.operators.summaries import application_summary
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    return application_summary(domain.account(t), domain.application_mth(t, window=domain.upload_window(prev_month())),
                               O.AS_OF, prev_month())


@register("application_summary_all", O.with_fixtures(O.application_summary_sql(None)))
def q_application_summary_all(spark, sf_dir):
    from ledgerlens.operators.summaries import application_summary
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    return application_summary(domain.account(t), domain.application_mth(t), O.AS_OF, None)


@register("application_summary_sums", O.with_fixtures(O.application_summary_sql(prev_month(), counts="SUM")))
def q_application_summary_sums(spark, sf_dir):
    from ledgerlens.operators.summaries import application_summary
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    return application_summary(domain.account(t), domain.application_mth(t, window=domain.upload_window(prev_month())),
                               O.AS_OF, prev_month(), counts="sum")


def _paid_summary(spark, sf_dir):
    from ledgerlens.operators.summaries import paid_summary
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    from ledgerlens.functions.calendar import month_start
    month = first_day(prev_month())
    return paid_summary(domain.account(t), domain.paid_mth(t, with_product=True, window=(month, month_start(month, 1))),
                        domain.lender_product_code(t), O.AS_OF, prev_month())


@register("paid_summary", O.with_fixtures(O.paid_summary_sql(prev_month()), O.PAID_WITH_PRODUCT))
def q_paid_summary(spark, sf_dir):
    return _paid_summary(spark, sf_dir)


def _phase_query(name, product):
    @register(name, O.paid_phase_sql(prev_month(), product))
    def q(spark, sf_dir):
        from ledgerlens.operators.summaries import paid_summary_phase
        return paid_summary_phase(_paid_summary(spark, sf_dir), prev_month(), product)
    return q


_phase_query("paid_summary_phase", "FPP")            # no such product here: second phase
_phase_query("paid_summary_phase_first", "Brand#13")


def _gate(kind, spark, sf_dir, month, truncate_first=False):
    """Gate of a loader whose summary holds the months of the earlier load."""
    from ledgerlens.functions.calendar import month_start
    from ledgerlens.operators.summaries import application_summary, paid_summary, summary_gate
    D, t, first = O.D, Tables(spark, sf_dir), first_day(month)
    acc = D.account(t)
    if kind == "apps":
        w = D.upload_window(month)
        source, earlier = D.application_mth(t, window=w), D.application_mth(t, D.FEED_CUTOFF, window=w)
        done = application_summary(acc, earlier, O.AS_OF, month)
    else:
        w = (first, month_start(first, 1))
        source = D.paid_mth(t, window=w)
        done = paid_summary(acc, D.paid_mth(t, D.FEED_CUTOFF, with_product=True, window=w), D.lender_product_code(t), O.AS_OF, month)
    return summary_gate(source, done, month, truncate_first)


def _gate_query(name, kind, month):
    @register(name, O.summary_gate_sql(kind, month, O.D.FEED_CUTOFF))
    def q(spark, sf_dir):
        return _gate(kind, spark, sf_dir, month)
    return q


_gate_query("summary_gate", "apps", prev_month())
_gate_query("summary_gate_done", "apps", "1998-06")
_gate_query("summary_gate_no_source", "apps", "2010-01")
_gate_query("paid_summary_gate", "paids", prev_month())
_gate_query("paid_summary_gate_done", "paids", "1998-06")

STARTED = __import__("datetime").datetime(1999, 7, 15, 2, 0, 0)
FINISHED = __import__("datetime").datetime(1999, 7, 15, 2, 3, 5)


def _log_query(name, kind, month, **kw):
    @register(name, O.job_log_sql(kind, month, STARTED, FINISHED, O.D.FEED_CUTOFF, **kw))
    def q(spark, sf_dir):
        from ledgerlens.operators import summaries as S
        from ledgerlens.sources import domain as D
        t = Tables(spark, sf_dir)
        gate = _gate(kind, spark, sf_dir, month, kw.get("truncate_first", False))
        if kind == "apps":
            s = S.application_summary(D.account(t), D.application_mth(t, window=D.upload_window(month)), O.AS_OF, month)
            return S.job_log(s, gate, "set_application_mth_summary", "application_mth_summary", month, STARTED, FINISHED, **kw)
        s = _paid_summary(spark, sf_dir)
        return S.job_log(s, gate, "set_paid_mth_summary", "paid_mth_summary", month, STARTED, FINISHED,
                         phase=S.paid_summary_phase(s, month), **kw)
    return q


_log_query("job_log", "apps", prev_month())
_log_query("job_log_done", "apps", "1998-06")
_log_query("job_log_no_source", "apps", "2010-01")
_log_query("job_log_truncate", "apps", "1998-06", truncate_first=True)
_log_query("job_log_error", "apps", prev_month(), error="deadlock")
_log_query("job_log_paid", "paids", prev_month())


# --------------------------------------------------------------------------
# notifications
# --------------------------------------------------------------------------

EMAIL = "user8@example.com"


def _crm(spark, sf_dir):
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    return domain.crm_user_notification(t), domain.crm_user(t)


@register("notifications_all", O.notifications_sql(O.D.NOTIFICATIONS_NOW))
def q_notifications_all(spark, sf_dir):
    from ledgerlens.plans.notifications import notifications
    n, u = _crm(spark, sf_dir)
    return notifications(n, u, O.D.NOTIFICATIONS_NOW)


@register("notifications_user", O.notifications_sql(O.D.NOTIFICATIONS_NOW, EMAIL))
def q_notifications_user(spark, sf_dir):
    from ledgerlens.plans.notifications import notifications
    n, u = _crm(spark, sf_dir)
    return notifications(n, u, O.D.NOTIFICATIONS_NOW, EMAIL)


@register("notifications_flag_none", O.notifications_flag_sql(O.D.NOTIFICATIONS_NOW, None))
def q_notifications_flag_none(spark, sf_dir):
    from ledgerlens.plans.notifications import has_notifications
    n, u = _crm(spark, sf_dir)
    return has_notifications(n, u, O.D.NOTIFICATIONS_NOW, None)


@register("notifications_flag", O.notifications_flag_sql(O.D.NOTIFICATIONS_NOW, EMAIL))
def q_notifications_flag(spark, sf_dir):
    from ledgerlens.plans.notifications import has_notifications
    n, u = _crm(spark, sf_dir)
    return has_notifications(n, u, O.D.NOTIFICATIONS_NOW, EMAIL)


# --------------------------------------------------------------------------
# loaders (A2-A11, A16)
# --------------------------------------------------------------------------

def _loaders():
    from ledgerlens.operators import loaders as L
    from ledgerlens.sources import domain
    return L, domain


@register("stage_applications", O.with_fixtures(f"SELECT {', '.join(O.APPS_COLS)} FROM application_mth"))
def q_stage_applications(spark, sf_dir):
    L, D = _loaders()
    return L.stage_applications(D.apps_feed(Tables(spark, sf_dir)))


@register("stage_paids", O.with_fixtures(f"SELECT {', '.join(O.PAIDS_COLS)} FROM paid_mth_p", O.PAID_WITH_PRODUCT))
def q_stage_paids(spark, sf_dir):
    L, D = _loaders()
    return L.stage_paids(D.tb_paids_feed(Tables(spark, sf_dir)))


def apps_pair(spark, sf_dir):
    L, D = _loaders()
    t = Tables(spark, sf_dir)
    target = D.application_mth(t, D.FEED_CUTOFF).select(*O.APPS_COLS)
    staged = L.stage_applications(D.apps_feed(t)).select(*O.APPS_COLS)
    return L, target, staged


def paids_pair(spark, sf_dir):
    L, D = _loaders()
    t = Tables(spark, sf_dir)
    target = D.paid_mth(t, D.FEED_CUTOFF, with_product=True).select(*O.PAIDS_COLS)
    staged = L.stage_paids(D.tb_paids_feed(t)).select(*O.PAIDS_COLS)
    return L, target, staged


def _upsert_queries(prefix, pair, kind, table):
    from ledgerlens.operators.loaders import APPS_CHANGE_COLS, PAIDS_CHANGE_COLS
    cols = APPS_CHANGE_COLS if kind == "apps" else PAIDS_CHANGE_COLS
    cut = O.D.FEED_CUTOFF

    @register(f"{prefix}_changed", O.upsert_sql(kind, "changed", cols, cut))
    def q_changed(spark, sf_dir):
        L, t, s = pair(spark, sf_dir)
        return L.upsert_changed(t, s, "id", cols)

    @register(f"{prefix}_new", O.upsert_sql(kind, "new", cols, cut))
    def q_new(spark, sf_dir):
        L, t, s = pair(spark, sf_dir)
        return L.upsert_new(t, s, "id")

    @register(prefix, O.upsert_sql(kind, "merged", cols, cut))
    def q_merged(spark, sf_dir):
        L, t, s = pair(spark, sf_dir)
        return L.upsert(t, s, "id", cols)

    @register(f"{prefix}_counts", O.upsert_sql(kind, table, cols, cut))
    def q_counts(spark, sf_dir):
        L, t, s = pair(spark, sf_dir)
        return L.upsert_counts(L.upsert(t, s, "id", cols), table)


_upsert_queries("upsert_applications", apps_pair, "apps", "application_mth")
_upsert_queries("upsert_paids", paids_pair, "paids", "paid_mth")


@register("json_applications", O.with_fixtures(O.json_rows_sql()))
def q_json_applications(spark, sf_dir):
    L, D = _loaders()
    return L.json_rows(D.application_month_json(Tables(spark, sf_dir)))


_OVERLAP = 90


def _slice_inputs(spark, sf_dir):
    """(loader functions, target, delivered payloads as a written table)"""
    import datetime as dt
    from ledgerlens.session import new_path
    L, D = _loaders()
    t = Tables(spark, sf_dir)
    docs, path = D.application_month_json(t, since=D.FEED_CUTOFF - dt.timedelta(days=_OVERLAP)), new_path(spark, "payloads")
    docs.write.parquet(path)
    return L, L.json_rows(D.application_month_json(t, until=D.FEED_CUTOFF)), spark.read.schema(docs.schema).parquet(path)


@register("replace_slice", O.replace_slice_sql(O.D.FEED_CUTOFF, _OVERLAP))
def q_replace_slice(spark, sf_dir):
    L, target, docs = _slice_inputs(spark, sf_dir)
    return L.replace_slice(target, L.json_rows(docs), ["date", "lender_id"])


@register("replace_slice_first", O.replace_slice_sql(O.D.FEED_CUTOFF, _OVERLAP, first_only=True))
def q_replace_slice_first(spark, sf_dir):
    """Only the slice that each payload's first element names is replaced."""
    L, target, docs = _slice_inputs(spark, sf_dir)
    return L.replace_slice(target, L.json_rows(docs), ["date", "lender_id"], named=L.json_header(docs))


@register("year_month_columns", O.with_fixtures(
    "SELECT id, year, month, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS business_year_month, "
    "year_month AS upload_year_month FROM application_mth"))
def q_year_month_columns(spark, sf_dir):
    from pyspark.sql import functions as F
    L, D = _loaders()
    a = D.application_mth(Tables(spark, sf_dir))
    b = L.with_business_month(a.drop("year_month"))
    return b.select("id", "year", "month", F.col("year_month").alias("business_year_month"),
                    F.date_format("upload_date", "yyyy-MM").alias("upload_year_month"))


# --------------------------------------------------------------------------
# lender conversion
# --------------------------------------------------------------------------

CONVERSION_MONTHS = ["1999-06", "1999-05"]


def _conversion(name, facility, compat):
    @register(name, O.lender_conversion_sql(CONVERSION_MONTHS, facility, compat))
    def q(spark, sf_dir):
        from ledgerlens.plans.conversion import lender_conversion
        from ledgerlens.sources import domain
        t = Tables(spark, sf_dir)
        from ledgerlens.functions.calendar import month_start
        window = (first_day(min(CONVERSION_MONTHS)), month_start(first_day(max(CONVERSION_MONTHS)), 1))
        return lender_conversion(domain.account(t), domain.application_mth(t, window=window), domain.paid_mth(t, window=window),
                                 CONVERSION_MONTHS, facility, compat)
    return q


_conversion("lender_conversion", FACILITY, False)
_conversion("lender_conversion_compat", FACILITY, True)
_conversion("lender_conversion_all", None, False)


# --------------------------------------------------------------------------
# reconcile two report versions (J20-J22): group-sum version vs per-facility
# version, on the reference's four test cases (group; facility; facility
# with each of two lenders given in lower case)
# --------------------------------------------------------------------------

RECON_CASES = {
    1: {"group": GROUP},
    2: {"facility": FACILITY},
    3: {"facility": FACILITY, "lender": "building"},
    4: {"facility": FACILITY, "lender": "machinery"},
}


def _versions(spark, sf_dir):
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))

    def older(**kw):
        return fn.funnel(inp, fn.FunnelParams(per_facility=False, **kw))

    def latest(**kw):
        return fn.funnel(inp, fn.FunnelParams(per_facility=True, **kw))
    return older, latest


def case_reports(spark, sf_dir, per_facility: bool, cases: dict[int, dict] = RECON_CASES):
    """All cases' reports of a version, from one pass over the facts."""
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
    return fn.funnel_cases(inp, {k: fn.FunnelParams(per_facility=per_facility, **c) for k, c in cases.items()})


def strip_order(sql: str) -> str:
    return sql[: sql.rindex("ORDER BY")]


def both_sql(**case) -> tuple[str, str]:
    return tuple(strip_order(O.funnel_sql(per_facility=x, **case)) for x in (False, True))


@register("reconcile_rows", O.reconcile_rows_sql(*both_sql(group=GROUP)))
def q_reconcile_rows(spark, sf_dir):
    from ledgerlens.operators.reconcile import reconcile_rows
    older, latest = _versions(spark, sf_dir)
    return reconcile_rows(older(group=GROUP), latest(group=GROUP))


@register("reconcile_except", O.reconcile_except_sql(
    *(strip_order(O.funnel_sql(group=GROUP, lender=LENDER, per_facility=False, lender_on_ecof=x)) for x in (True, False))))
def q_reconcile_except(spark, sf_dir):
    """Versions that differ in whether the lender filters quotes."""
    from ledgerlens.operators.reconcile import reconcile_except
    older, _ = _versions(spark, sf_dir)
    return reconcile_except(*(older(group=GROUP, lender=LENDER, lender_on_ecof=x) for x in (True, False)))


def both_versions(spark, sf_dir, cases: dict[int, dict] = RECON_CASES):
    """All cases of both versions from one pass over the facts; the latest one's ids are
    negative."""
    inp = fn.FunnelInputs.from_tables(Tables(spark, sf_dir))
    return fn.funnel_cases(inp, {k: fn.FunnelParams(per_facility=False, **c) for k, c in cases.items()}
                           | {-k: fn.FunnelParams(per_facility=True, **c) for k, c in cases.items()})


RECON_SQL = O.reconcile_summary_sql([(k, *both_sql(**c)) for k, c in RECON_CASES.items()])


@register("reconcile_summary", RECON_SQL)
def q_reconcile_summary(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.operators.reconcile import reconcile_tagged
    return reconcile_tagged(both_versions(spark, sf_dir).withColumnRenamed("case_id", "version"), F.col("version") < 0, F.abs("version").alias("test_id"))


# a baseline without quotes against a comparison without the average rate
_LESS, _MORE = ("ecof_count", "ecof_advance"), ("commission_rate_avg",)


@register("reconcile_columns", O.reconcile_summary_sql(
    [(1, *(f"SELECT * EXCLUDE ({', '.join(gone)}) FROM ({sql})" for sql, gone in zip(both_sql(group=GROUP), (_LESS, _MORE))))], unshared=_LESS + _MORE))
def q_reconcile_columns(spark, sf_dir):
    """Versions that do not have the same columns."""
    from pyspark.sql import functions as F
    from ledgerlens.operators.reconcile import reconcile_summary
    older, latest = _versions(spark, sf_dir)
    return reconcile_summary(older(group=GROUP).drop(*_LESS), latest(group=GROUP).drop(*_MORE)).select(F.lit(1).alias("test_id"), "*")


@register("run_cases", " UNION ALL ".join(f"SELECT {k} AS test_id, * FROM ({both_sql(**c)[1]}) r{k}" for k, c in RECON_CASES.items()))
def q_run_cases(spark, sf_dir):
    return case_reports(spark, sf_dir, True).withColumnRenamed("case_id", "test_id")


# --------------------------------------------------------------------------
# single operators of the inventory (filters, joins, aggregates, scalars)
# --------------------------------------------------------------------------

def _inp(spark, sf_dir):
    return fn.FunnelInputs.from_tables(Tables(spark, sf_dir))


_PF_AGG_SQL = ("CAST(count(*) AS BIGINT) AS rows, CAST(SUM(advance) AS DECIMAL(18,2)) AS advance, "
               "CAST(SUM(advance_count) AS BIGINT) AS advance_count")


def _pf_agg(df, key):
    from pyspark.sql import functions as F
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                               F.sum("advance").cast("decimal(18,2)").alias("advance"),
                               F.sum("advance_count").cast("bigint").alias("advance_count"))


@register("filter_optional_loose", O.with_fixtures(
    f"SELECT facility_used_by_id, {_PF_AGG_SQL} FROM paid_facts "
    f"WHERE ({O._lit(None)} IS NULL OR facility_lender = {O._lit(None)}) "
    f"AND facility_used_by_report_group_id = '{GROUP}' GROUP BY facility_used_by_id"))
def q_filter_optional_loose(spark, sf_dir):
    from ledgerlens.functions.filters import opt_eq
    p = opt_eq(opt_eq(_inp(spark, sf_dir).paids, "facility_lender", None),
               "facility_used_by_report_group_id", GROUP)
    return _pf_agg(p, "facility_used_by_id")


@register("filter_optional_strict", O.with_fixtures(
    f"SELECT facility_used_by_id, {_PF_AGG_SQL} FROM paid_facts "
    f"WHERE facility_lender = COALESCE(NULL, facility_lender) "
    f"AND facility_used_by_report_group_id = COALESCE('{GROUP}', facility_used_by_report_group_id) "
    f"GROUP BY facility_used_by_id"))
def q_filter_optional_strict(spark, sf_dir):
    from ledgerlens.functions.filters import opt_eq_strict
    p = opt_eq_strict(opt_eq_strict(_inp(spark, sf_dir).paids, "facility_lender", None),
                      "facility_used_by_report_group_id", GROUP)
    return _pf_agg(p, "facility_used_by_id")


@register("filter_lender_ci", O.with_fixtures(
    f"SELECT facility_lender, {_PF_AGG_SQL} FROM paid_facts WHERE upper(facility_lender) = upper('{LENDER_LC}') "
    f"GROUP BY facility_lender"))
def q_filter_lender_ci(spark, sf_dir):
    from ledgerlens.functions.filters import lender_ci
    return _pf_agg(lender_ci(_inp(spark, sf_dir).paids, LENDER_LC), "facility_lender")


@register("agg_by_facility_month", O.with_fixtures(
    "SELECT facility_used_by_id, year_month, CAST(SUM(advance) AS DECIMAL(18,2)) AS advance, "
    "CAST(SUM(advance_count) AS BIGINT) AS advance_count, CAST(SUM(commission) AS DECIMAL(18,2)) AS commission "
    "FROM paid_facts GROUP BY facility_used_by_id, year_month"))
def q_agg_by_facility_month(spark, sf_dir):
    from pyspark.sql import functions as F
    p = _inp(spark, sf_dir).paids
    return p.groupBy("facility_used_by_id", "year_month").agg(
        F.sum("advance").cast("decimal(18,2)").alias("advance"),
        F.sum("advance_count").cast("bigint").alias("advance_count"),
        F.sum("commission").cast("decimal(18,2)").alias("commission"))


@register("activity_labels", O.with_fixtures(
    f"SELECT {O._labelled('activity_type')} AS activity_label, CAST(count(*) AS BIGINT) AS activities "
    f"FROM crm_user_notification GROUP BY 1"))
def q_activity_labels(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions.filters import activity_label
    from ledgerlens.sources import domain
    n = domain.crm_user_notification(Tables(spark, sf_dir))
    return n.groupBy(activity_label("activity_type").alias("activity_label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("activities"))


@register("join_inner", O.with_fixtures(
    "SELECT lpc.funding_option_uc, CAST(count(*) AS BIGINT) AS deals, CAST(SUM(p.advance) AS DECIMAL(18,2)) AS advance "
    "FROM paid_mth_p p JOIN lender_product_code lpc ON p.product_code = lpc.product_code GROUP BY 1",
    O.PAID_WITH_PRODUCT))
def q_join_inner(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    j = domain.paid_mth(t, with_product=True).join(domain.lender_product_code(t), "product_code")
    return j.groupBy("funding_option_uc").agg(F.count(F.lit(1)).cast("bigint").alias("deals"),
                                              F.sum("advance").cast("decimal(18,2)").alias("advance"))


# lenders as a nullable key: one segment is treated as "no lender recorded"
_NULL_LENDER = "HOUSEHOLD"


@register("join_null_safe", O.with_fixtures(f"""
    SELECT a.year_month, a.lender_key, CAST(a.accept AS BIGINT) AS accept, CAST(p.advance AS DECIMAL(18,2)) AS advance
    FROM (SELECT year_month, CASE WHEN facility_lender = '{_NULL_LENDER}' THEN NULL ELSE facility_lender END AS lender_key,
                 SUM(accept) AS accept FROM application_facts GROUP BY 1, 2) a
    LEFT JOIN (SELECT year_month, CASE WHEN facility_lender = '{_NULL_LENDER}' THEN NULL ELSE facility_lender END AS lender_key,
                      SUM(advance) AS advance FROM paid_facts GROUP BY 1, 2) p
      ON a.year_month = p.year_month AND (a.lender_key = p.lender_key OR (a.lender_key IS NULL AND p.lender_key IS NULL))"""))
def q_join_null_safe(spark, sf_dir):
    from pyspark.sql import functions as F
    inp = _inp(spark, sf_dir)
    key = F.when(F.col("facility_lender") == _NULL_LENDER, F.lit(None)).otherwise(F.col("facility_lender"))
    a = inp.applications.groupBy("year_month", key.alias("lender_key")).agg(F.sum("accept").alias("accept"))
    p = inp.paids.groupBy("year_month", key.alias("lender_key")).agg(F.sum("advance").alias("advance"))
    j = a.alias("a").join(p.alias("p"), (F.col("a.year_month") == F.col("p.year_month"))
                          & F.col("a.lender_key").eqNullSafe(F.col("p.lender_key")), "left")
    return j.select(F.col("a.year_month").alias("year_month"), F.col("a.lender_key").alias("lender_key"),
                    F.col("a.accept").cast("bigint").alias("accept"),
                    F.col("p.advance").cast("decimal(18,2)").alias("advance"))


@register("join_spine", O.with_fixtures(f"""
    SELECT m.year_month, CAST(p.advance AS DECIMAL(18,2)) AS advance, CAST(p.advance_count AS BIGINT) AS advance_count
    FROM ({O.period_sql('LAST4Y')}) m
    LEFT JOIN (SELECT year_month, SUM(advance) AS advance, SUM(advance_count) AS advance_count FROM paid_facts
               WHERE facility_used_by_id = '{FACILITY}' GROUP BY year_month) p ON m.year_month = p.year_month"""))
def q_join_spine(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions import calendar as C
    inp = _inp(spark, sf_dir)
    m = C.months_frame(spark, *C.period_bounds("LAST4Y", O.AS_OF, O.D.CALENDAR_END)).select("year_month")
    p = (inp.paids.filter(F.col("facility_used_by_id") == FACILITY).groupBy("year_month")
         .agg(F.sum("advance").alias("advance"), F.sum("advance_count").alias("advance_count")))
    return m.join(p, "year_month", "left").select(
        "year_month", F.col("advance").cast("decimal(18,2)").alias("advance"),
        F.col("advance_count").cast("bigint").alias("advance_count"))


@register("cross_facility_moment", _funnel_cte(
    "SELECT id AS facility_used_by_id, name AS facility_used_by_name, g AS moment FROM places, shares", group=GROUP))
def q_cross_facility_moment(spark, sf_dir):
    from pyspark.sql import functions as F
    inp, p = _inp(spark, sf_dir), fn.FunnelParams(group=GROUP)
    return fn.facilities(inp, p).select("facility_used_by_id", "facility_used_by_name", F.explode(fn.spine_moments(inp, p)).alias("moment"))


_TWO_MONTHS = ["1999-05", "1999-06"]


@register("paid_by_lender_exists", O.with_fixtures(f"""
    SELECT facility_lender, facility_used_by_id, year_month, CAST(coalesce(total, 0) AS DECIMAL(18,2)) AS advance_total,
           CAST(coalesce(n, 0) AS BIGINT) AS advance_count
    FROM (SELECT DISTINCT facility_lender, facility_used_by_id, unnest({_TWO_MONTHS}) AS year_month FROM account
          WHERE facility_used_by_id = '{FACILITY}')
    LEFT JOIN (
      SELECT c.facility_lender, c.facility_used_by_id, p.year_month, sum(p.advance) AS total, count(DISTINCT p.id) AS n
      FROM (SELECT facility_code, facility_lender, facility_used_by_id FROM account GROUP BY ALL) c JOIN paid_mth p USING (facility_code)
      WHERE p.year_month IN ({', '.join(map(repr, _TWO_MONTHS))}) GROUP BY ALL) d USING (facility_lender, facility_used_by_id, year_month)"""))
def q_paid_by_lender_exists(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.sources import domain
    t = Tables(spark, sf_dir)
    acc = domain.account(t).filter(F.col("facility_used_by_id") == FACILITY)
    from ledgerlens.functions.calendar import month_start
    months = _TWO_MONTHS
    window = (first_day(months[0]), month_start(first_day(months[-1]), 1))
    cmap = acc.select("facility_code", "facility_lender", "facility_used_by_id").distinct()
    p = domain.paid_mth(t, window=window).filter(F.col("year_month").isin(months)).join(cmap, "facility_code")
    g = p.groupBy("facility_lender", "facility_used_by_id", "year_month").agg(
        F.sum("advance").alias("advance_total"), F.count_distinct("id").alias("advance_count"))
    spine = acc.select("facility_lender", "facility_used_by_id").distinct() \
        .select("*", F.explode(F.array(*[F.lit(m) for m in months])).alias("year_month"))
    return spine.join(g, ["facility_lender", "facility_used_by_id", "year_month"], "left").select(
        "facility_lender", "facility_used_by_id", "year_month",
        F.coalesce(F.col("advance_total"), F.lit(0)).cast("decimal(18,2)").alias("advance_total"),
        F.coalesce(F.col("advance_count"), F.lit(0)).cast("bigint").alias("advance_count"))


@register("distinct_aggs", O.with_fixtures(f"""
    SELECT p.year_month, CAST(SUM(p.advance) AS DECIMAL(18,2)) AS advance_sum,
           CAST(SUM(DISTINCT p.advance) AS DECIMAL(18,2)) AS advance_sum_distinct,
           CAST(COUNT(p.id) AS BIGINT) AS id_count, CAST(COUNT(DISTINCT p.id) AS BIGINT) AS id_count_distinct
    FROM paid_mth p JOIN ({O.period_sql('L12M')}) m ON p.year_month = m.year_month GROUP BY p.year_month"""))
def q_distinct_aggs(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions import calendar as C
    from ledgerlens.sources import domain
    p = domain.paid_mth(Tables(spark, sf_dir), window=C.period_bounds("L12M", O.AS_OF))
    return p.groupBy("year_month").agg(
        F.sum("advance").cast("decimal(18,2)").alias("advance_sum"),
        F.sum_distinct("advance").cast("decimal(18,2)").alias("advance_sum_distinct"),
        F.count("id").cast("bigint").alias("id_count"),
        F.count_distinct("id").cast("bigint").alias("id_count_distinct"))


@register("commission_avg_of_rates", O.with_fixtures(f"""
    SELECT year_month, CAST(AVG(rate) AS DECIMAL(18,6)) AS commission_rate_avg_of_rates,
           CAST(SUM(commission) / SUM(advance) AS DECIMAL(18,6)) AS commission_rate_of_sums
    FROM (SELECT year_month, facility_used_by_id, SUM(commission) AS commission, SUM(advance) AS advance,
                 CASE WHEN SUM(advance) > 0 THEN CAST(SUM(commission) / SUM(advance) AS DECIMAL(18,4)) END AS rate
          FROM paid_facts WHERE facility_used_by_report_group_id = '{GROUP}' GROUP BY 1, 2) f
    GROUP BY year_month"""))
def q_commission_avg_of_rates(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions.measures import ratio
    p = _inp(spark, sf_dir).paids.filter(F.col("facility_used_by_report_group_id") == GROUP)
    f = p.groupBy("year_month", "facility_used_by_id").agg(F.sum("commission").alias("commission"),
                                                          F.sum("advance").alias("advance"))
    f = f.withColumn("rate", ratio("commission", "advance", "decimal(18,4)"))
    return f.groupBy("year_month").agg(
        F.avg("rate").cast("decimal(18,6)").alias("commission_rate_avg_of_rates"),
        ratio(F.sum("commission"), F.sum("advance"), "decimal(18,6)").alias("commission_rate_of_sums"))


_ratio_cols = ["report_name", "moment", "accept_avg", "accept_rate", "advance_avg", "commission_rate_avg",
               "budget_rate"]


@register("ratio_measures", "SELECT " + ", ".join(_ratio_cols) + " FROM ("
          + strip_order(O.funnel_sql(group="G2", per_facility=False)) + ") r")
def q_ratio_measures(spark, sf_dir):
    return fn.funnel(_inp(spark, sf_dir), fn.FunnelParams(group="G2", per_facility=False)).select(*_ratio_cols)


# --------------------------------------------------------------------------
# scalar function families (strings, dates, formats)
# --------------------------------------------------------------------------

@register("scalar_strings", O.with_fixtures("""
    SELECT facility_code, left(upload_legal_name, 6) AS name_left, right(year_month, 2) AS ym_right,
           lpad(CAST(month AS VARCHAR), 2, '0') AS month_padded, upper(upload_legal_name) AS name_upper,
           CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS ym_concat,
           printf('%d rows updated', accept) AS message
    FROM application_mth"""))
def q_scalar_strings(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.sources import domain
    a = domain.application_mth(Tables(spark, sf_dir))
    return a.select("facility_code", F.left("upload_legal_name", F.lit(6)).alias("name_left"),
                    F.right("year_month", F.lit(2)).alias("ym_right"),
                    F.lpad(F.col("month").cast("string"), 2, "0").alias("month_padded"),
                    F.upper("upload_legal_name").alias("name_upper"),
                    F.concat(F.col("year").cast("string"), F.lit("-"),
                             F.lpad(F.col("month").cast("string"), 2, "0")).alias("ym_concat"),
                    F.format_string("%d rows updated", F.col("accept")).alias("message"))


@register("scalar_dates", O.with_fixtures("""
    SELECT crm_user_id, scheduled_end, CAST(year(scheduled_end) AS INTEGER) AS y,
           CAST(month(scheduled_end) AS INTEGER) AS m, CAST(dayofyear(scheduled_end) AS INTEGER) AS doy,
           CAST(date_trunc('month', scheduled_end) AS DATE) AS month_start,
           CAST(date_trunc('month', scheduled_end) - INTERVAL 12 MONTH AS DATE) AS minus_12m,
           strftime(scheduled_end, '%d/%m/%Y') AS dmy, strftime(scheduled_end, '%Y-%m-%d %H:%M:%S') AS iso120,
           strftime(scheduled_end, '%Y-%m') AS ym
    FROM crm_user_notification"""))
def q_scalar_dates(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.sources import domain
    n = domain.crm_user_notification(Tables(spark, sf_dir))
    ms = F.trunc(F.col("scheduled_end").cast("date"), "month")
    return n.select("crm_user_id", "scheduled_end", F.year("scheduled_end").alias("y"),
                    F.month("scheduled_end").alias("m"), F.dayofyear("scheduled_end").alias("doy"),
                    ms.alias("month_start"), F.add_months(ms, -12).alias("minus_12m"),
                    F.date_format("scheduled_end", "dd/MM/yyyy").alias("dmy"),
                    F.date_format("scheduled_end", "yyyy-MM-dd HH:mm:ss").alias("iso120"),
                    F.date_format("scheduled_end", "yyyy-MM").alias("ym"))


@register("scalar_formats", O.with_fixtures(f"""
    SELECT facility_used_by_id, year_month, {O.n0('advance')} AS advance_text,
           {O.pct2('CASE WHEN advance > 0 THEN CAST(commission / advance AS DECIMAL(18,4)) END')} AS rate_text,
           CAST((advance_count * 100) // NULLIF(advance_count + 1, 0) AS VARCHAR) || '%' AS int_pct_text,
           CAST(round(advance, 0) AS DECIMAL(18,0)) AS advance_rounded
    FROM paid_facts"""))
def q_scalar_formats(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlens.functions.measures import int_div_pct, int_pct_text, money_text, pct2_text, ratio
    p = _inp(spark, sf_dir).paids
    return p.select("facility_used_by_id", "year_month", money_text("advance").alias("advance_text"),
                    pct2_text(ratio("commission", "advance", "decimal(18,4)")).alias("rate_text"),
                    int_pct_text(int_div_pct("advance_count", F.col("advance_count") + 1)).alias("int_pct_text"),
                    F.round("advance", 0).cast("decimal(18,0)").alias("advance_rounded"))


# Funnel with text columns, by quarter and by month
def _funnel_text_query(name, **kw):
    @register(name, O.funnel_text_sql(**kw))
    def q(spark, sf_dir):
        return fn.funnel_text(_inp(spark, sf_dir), fn.FunnelParams(**kw))
    return q


_funnel_text_query("funnel_text", group=GROUP, per_facility=False, group_by="quarter")
_funnel_text_query("funnel_text_month", facility=FACILITY, lender=LENDER, per_facility=False)


from ledgerlens.plans import catalog_tables  # noqa: E402,F401  (registers its queries here)
