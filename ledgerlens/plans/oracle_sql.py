"""Check SQL (DuckDB dialect) for the registered queries.

The correctness gate runs every registered Spark query next to an
independent SQL formulation over the same parquet tables. The domain
derivation of ``ledgerlens.sources.domain`` is restated here as CTEs. Reports
are formulated in a form of their own: measures as long rows (facility key, month,
metric, value) that are summed once and turned by conditional aggregation, months
from generated series, budgets from unpivoted quarters.

Every output column is cast to the same type the Spark query returns.
"""

from __future__ import annotations

import datetime as dt

from ledgerlens.functions.calendar import period_bounds
from ledgerlens.plans.funnel import DEFAULT_COMPANY, UNKNOWN_GROUP
from ledgerlens.sources import domain as D

AS_OF = D.AS_OF
LAST4Y = AS_OF.year - 3


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _ts(x: dt.date | dt.datetime) -> str:
    if isinstance(x, dt.datetime):
        return f"TIMESTAMP '{x.isoformat(sep=' ')}'"
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


# ---------------------------------------------------------------------------
# domain inputs
# ---------------------------------------------------------------------------

def _orders_as_loaded(as_loaded: dt.date | None) -> str:
    if as_loaded is None:
        return "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
    recent = f"o_orderdate >= CAST({_d(as_loaded)} - INTERVAL {D.UNSETTLED_DAYS} DAY AS TIMESTAMP)"
    return (f"SELECT o_orderkey, o_custkey, CASE WHEN {recent} AND o_orderstatus = 'F' THEN 'P' "
            f"ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
            f"FROM orders WHERE o_orderdate < {_ts(as_loaded)}")


def application_mth_sql(as_loaded: dt.date | None = None) -> str:
    def cnt(s):
        return f"CAST(count(*) FILTER (WHERE o_orderstatus = '{s}') AS INTEGER)"

    def val(s):
        return (f"CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = '{s}'), 0) "
                f"AS DECIMAL(10,0))")

    return f"""
    SELECT o_custkey * 100000 + year * 12 + month AS id, lender_id,
           CAST(o_custkey AS VARCHAR) AS facility_code,
           'Branch ' || CAST(o_custkey AS VARCHAR) AS upload_legal_name,
           accept, accept_val, decline, decline_val, pending, pending_val, month, year,
           CAST(last_day(make_date(year, month, 1)) + INTERVAL 3 DAY AS TIMESTAMP) AS upload_date,
           strftime(last_day(make_date(year, month, 1)) + INTERVAL 3 DAY, '%Y-%m') AS year_month
    FROM (
      SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
             {cnt('F')} AS accept, {val('F')} AS accept_val,
             {cnt('O')} AS decline, {val('O')} AS decline_val,
             {cnt('P')} AS pending, {val('P')} AS pending_val,
             min(CAST(substr(o_orderpriority, 1, 1) AS SMALLINT)) AS lender_id
      FROM ({_orders_as_loaded(as_loaded)}) o
      GROUP BY o_custkey, year(o_orderdate), month(o_orderdate)
    ) g"""


def paid_mth_sql(as_loaded: dt.date | None = None, with_product: bool = False) -> str:
    adv = "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(10,0))"
    rate = "CAST(l.l_discount AS DECIMAL(10,4))"
    where = ""
    if as_loaded is not None:
        recent = f"l.l_shipdate >= CAST({_d(as_loaded)} - INTERVAL {D.UNSETTLED_DAYS} DAY AS TIMESTAMP)"
        adv = (f"CASE WHEN {recent} AND l.l_returnflag = 'R' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * "
               f"(1 + CAST(l.l_tax AS DECIMAL(18,2))) AS DECIMAL(10,0)) ELSE {adv} END")
        rate = f"CASE WHEN {rate} = 0 THEN NULL ELSE {rate} END"
        where = f"WHERE l.l_shipdate < {_ts(as_loaded)}"
    prod_col = ", pt.p_brand AS product_code" if with_product else ""
    prod_join = "JOIN part pt ON l.l_partkey = pt.p_partkey" if with_product else ""
    return f"""
    SELECT id, lender_id, facility_code, upload_legal_name{', product_code' if with_product else ''},
           defer_by, apr, term, advance, date, return_rate, month, year, upload_date, year_month,
           CAST(advance * COALESCE(return_rate, 0) AS DECIMAL(18,2)) AS commission
    FROM (
      SELECT CAST('0x' || left(md5(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                 CAST(l.l_quantity AS DECIMAL(18,2)), CAST(l.l_extendedprice AS DECIMAL(18,2)),
                 CAST(l.l_discount AS DECIMAL(18,2)), CAST(l.l_tax AS DECIMAL(18,2)), l.l_returnflag, l.l_linestatus,
                 strftime(l.l_shipdate, '%Y-%m-%d'))), 15) AS BIGINT) AS id,
             CAST(l.l_linenumber AS SMALLINT) AS lender_id,
             CAST(o.o_custkey AS VARCHAR) AS facility_code,
             'Branch ' || CAST(o.o_custkey AS VARCHAR) AS upload_legal_name{prod_col},
             CAST(l.l_quantity AS INTEGER) AS defer_by,
             CAST(l.l_tax AS DECIMAL(18,10)) AS apr,
             l.l_linenumber * 12 AS term,
             {adv} AS advance,
             l.l_shipdate AS date,
             {rate} AS return_rate,
             CAST(month(l.l_shipdate) AS INTEGER) AS month,
             CAST(year(l.l_shipdate) AS INTEGER) AS year,
             CAST(CAST(l.l_shipdate AS DATE) + INTERVAL 2 DAY AS TIMESTAMP) AS upload_date,
             strftime(l.l_shipdate, '%Y-%m') AS year_month
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey {prod_join}
      {where}
    ) x"""


FIXTURES: dict[str, str] = {
    "account": """
    SELECT 'A' || CAST(c.c_custkey AS VARCHAR) AS account_id,
           CAST(c.c_custkey AS VARCHAR) AS facility_code,
           c.c_mktsegment AS facility_lender,
           'U' || CAST(c.c_nationkey AS VARCHAR) AS facility_used_by_id,
           n.n_name AS facility_used_by_legal_name,
           n.n_name || ' T' AS facility_used_by_trading_style,
           'BM' || CAST(n.n_regionkey AS VARCHAR) AS facility_used_by_business_manager_initials,
           'bm' || CAST(n.n_regionkey AS VARCHAR) || '@example.com' AS facility_used_by_business_manager_email,
           'G' || CAST(n.n_regionkey AS VARCHAR) AS facility_used_by_report_group_id,
           r.r_name AS facility_used_by_report_group,
           r.r_name AS account_report_group,
           n.n_name AS legal_name,
           n.n_name || ' T' AS trading_style,
           n.n_regionkey <> 4 AS is_reporting
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "moment": """
    SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
           CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
           strftime(d, '%Y-%m') AS year_month,
           CAST(year(d) AS VARCHAR) || '-' || CAST(quarter(d) AS VARCHAR) AS year_quarter
    FROM (SELECT unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
          FROM (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)))""",
    "application_mth": application_mth_sql(),
    "paid_mth": paid_mth_sql(),
    "paid_budget": """
    SELECT 'U' || CAST(c.c_nationkey AS VARCHAR) AS account_id, c.c_mktsegment AS lender,
           CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) FILTER (WHERE quarter(o.o_orderdate) = 1), 0) AS DECIMAL(18,2)) AS q1,
           CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) FILTER (WHERE quarter(o.o_orderdate) = 2), 0) AS DECIMAL(18,2)) AS q2,
           CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) FILTER (WHERE quarter(o.o_orderdate) = 3), 0) AS DECIMAL(18,2)) AS q3,
           CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) FILTER (WHERE quarter(o.o_orderdate) = 4), 0) AS DECIMAL(18,2)) AS q4
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    GROUP BY 1, 2, 3""",
    "vw_ecof_all": """
    SELECT 'E' || CAST(o.o_custkey AS VARCHAR) AS company_key, o.o_orderpriority AS doc_type,
           c.c_mktsegment AS selected_lender, CAST(o.o_totalprice AS DECIMAL(18,2)) AS selected_balance,
           CASE WHEN o.o_orderpriority = '5-LOW' THEN 'cash'
                WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'finance' END AS selected_funding_option,
           CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "account_ecof": """
    SELECT 'E' || CAST(c_custkey AS VARCHAR) AS ecof_key, 'A' || CAST(c_custkey AS VARCHAR) AS account_id
    FROM customer""",
    "lender_product_code": """
    SELECT p_brand AS product_code,
           CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) <= 8 THEN 'HP'
                WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) <= 16 THEN 'FPP'
                ELSE 'LOAN' END AS funding_option_uc
    FROM (SELECT DISTINCT p_brand FROM part) b""",
    "crm_user_notification": f"""
    SELECT user_id AS crm_user_id, ts AS scheduled_end,
           CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 1 HOUR END AS actual_end,
           CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in D.EVENT_ACTIVITY.items())} END AS activity_type,
           event_type || ' follow-up' AS subject,
           CASE WHEN value < 5 THEN '' ELSE 'Case ' || CAST(event_id AS VARCHAR) END AS regarding,
           'crm://activity/' || CAST(event_id AS VARCHAR) AS link
    FROM events""",
    "crm_user": """
    SELECT user_id AS crm_user_id, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS email,
           'U' || CAST(user_id AS VARCHAR) AS initials, 'User ' || CAST(user_id AS VARCHAR) AS name
    FROM (SELECT DISTINCT user_id FROM events) u""",
    # ---- fact views ----
    "application_facts": f"""
    SELECT a.account_id, a.facility_used_by_id, a.facility_used_by_business_manager_initials,
           a.facility_used_by_report_group_id, a.facility_used_by_report_group,
           a.facility_used_by_legal_name, a.facility_used_by_trading_style, a.facility_lender,
           facility_code, accept, accept_val, decline, decline_val, pending, pending_val, month, year,
           printf('%04d-%02d', year, month) AS year_month
    FROM (SELECT * EXCLUDE (year_month) FROM application_mth WHERE year >= {LAST4Y}) am JOIN account a USING (facility_code)""",
    "paid_facts": f"""
    SELECT a.account_id, a.facility_used_by_id, a.facility_used_by_business_manager_initials,
           a.facility_used_by_report_group_id, a.facility_used_by_report_group,
           a.facility_used_by_legal_name, a.facility_used_by_trading_style, a.facility_lender,
           facility_code, CAST(p.advance AS DECIMAL(18,2)) AS advance, p.n AS advance_count,
           CAST(p.commission AS DECIMAL(18,2)) AS commission, p.month, p.year, printf('%04d-%02d', p.year, p.month) AS year_month
    FROM (SELECT facility_code, year, month, SUM(advance) AS advance, COUNT(advance) AS n, SUM(commission) AS commission
          FROM paid_mth WHERE year >= {LAST4Y} GROUP BY ALL) p JOIN account a USING (facility_code)""",
    # one row per quarter, then three months each
    "budget_facts": """
    SELECT g.grp AS facility_used_by_report_group_id, g.fid AS facility_used_by_id, lender AS facility_lender,
           printf('%04d-%02d', year, mon) AS year_month, year, CAST(mon AS INTEGER) AS month, qtr AS quarter,
           printf('%d-%d', year, qtr) AS year_quarter, CAST(amount / 3.0 AS DECIMAL(18,6)) AS budget
    FROM (SELECT *, unnest([3 * qtr - 2, 3 * qtr - 1, 3 * qtr]) AS mon
          FROM (SELECT account_id, lender, year, CAST(substr(slot, 2) AS INTEGER) AS qtr, amount
                FROM (UNPIVOT (SELECT * FROM paid_budget) ON q1, q2, q3, q4 INTO NAME slot VALUE amount))) q
    JOIN (SELECT facility_used_by_id AS fid, any_value(facility_used_by_report_group_id) AS grp FROM account GROUP BY 1) g
      ON g.fid = q.account_id""",
    # quotes summed by company key, then placed
    "ecof_facts": """
    SELECT grp AS report_group_id, facility_used_by_report_group, facility_used_by_id, facility_used_by_legal_name, facility_lender,
           CAST(sum(quotes) AS BIGINT) AS ecof_count, CAST(sum(worth) AS DECIMAL(18,2)) AS ecof_advance, year_month
    FROM (SELECT company_key AS ecof_key, selected_lender AS facility_lender, printf('%04d-%02d', year, month) AS year_month,
                 count(doc_type) AS quotes, sum(selected_balance) AS worth
          FROM vw_ecof_all WHERE coalesce(selected_funding_option, 'cash') != 'cash' GROUP BY ALL)
    JOIN (SELECT ecof_key, facility_used_by_report_group_id AS grp, facility_used_by_report_group, facility_used_by_id, facility_used_by_legal_name
          FROM account_ecof JOIN account USING (account_id) GROUP BY ALL) USING (ecof_key)
    GROUP BY ALL""",
}


def with_fixtures(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <fixtures>, <extra> <body>``."""
    ctes = dict(FIXTURES)
    ctes.update(extra or {})
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


# ---------------------------------------------------------------------------
# calendar periods
# ---------------------------------------------------------------------------

def period_sql(period: str | None, as_of: dt.date = AS_OF) -> str:
    """Month rows of a period."""
    if period is None:
        days = ("SELECT CAST(ym || '-01' AS DATE) AS d FROM (SELECT DISTINCT unnest([f.year_month, p.year_month]) AS ym "
                "FROM application_facts f FULL JOIN paid_facts p USING (year_month)) WHERE ym IS NOT NULL")
    else:
        lo, hi = period_bounds(period, as_of, D.CALENDAR_END)
        days = f"SELECT unnest(range({_ts(lo)}, {_ts(hi)}, INTERVAL 1 MONTH)) AS d"
    return (f"SELECT strftime(d, '%Y-%m') AS year_month, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, "
            f"CAST(quarter(d) AS INTEGER) AS quarter, printf('%d-%d', year(d), quarter(d)) AS year_quarter FROM ({days}) days")


# ---------------------------------------------------------------------------
# funnel
# ---------------------------------------------------------------------------

def _lit(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


GRAINS = {
    "year_month": "ym", "year": "left(ym, 4)", "month": "CAST(CAST(right(ym, 2) AS INTEGER) AS VARCHAR)",
    "quarter": "CAST((CAST(right(ym, 2) AS INTEGER) + 2) // 3 AS VARCHAR)",
    "year_quarter": "left(ym, 4) || '-' || CAST((CAST(right(ym, 2) AS INTEGER) + 2) // 3 AS VARCHAR)"}
#: metric -> (fact table, value)
METRICS = {
    "accept": ("application_facts", "accept"), "decline": ("application_facts", "decline"),
    "pending": ("application_facts", "pending"), "proposed": ("application_facts", "accept + decline"),
    "accept_val": ("application_facts", "accept_val"), "advance": ("paid_facts", "advance"),
    "advance_count": ("paid_facts", "advance_count"), "commission": ("paid_facts", "commission"),
    "ecof_count": ("ecof_facts", "ecof_count"), "ecof_advance": ("ecof_facts", "ecof_advance"),
    "budget": ("budget_facts", "budget")}


def cells_sql(key: str, scope: dict[str, str], metrics: list[str]) -> str:
    """Long rows k, ym, metric, v: one for every fact row and metric."""
    by_table: dict[str, list[str]] = {}
    for m in metrics:
        by_table.setdefault(METRICS[m][0], []).append(m)
    return " UNION ALL ".join(
        f"SELECT k, ym, unnest([{', '.join(repr(m) for m in own)}]) AS metric, "
        f"unnest([{', '.join(f'CAST({METRICS[m][1]} AS DECIMAL(28,6))' for m in own)}]) AS v "
        f"FROM (SELECT *, {key} AS k, year_month AS ym FROM {t} WHERE {scope[t]}) {t}" for t, own in by_table.items())


def _turned(metrics: list[str]) -> str:
    return ", ".join(f"any_value(v) FILTER (metric = '{m}') AS {m}" for m in metrics)


def facilities_sql(facility, group, per_facility: bool) -> str:
    """k, id, name of the report's rows."""
    if per_facility and group is not None:
        own = f"facility_used_by_report_group_id = {_lit(group)}" + (f" AND facility_used_by_id = {_lit(facility)}" if facility else "")
        return f"""
        SELECT coalesce(f.k, '*') AS k, f.k AS id, coalesce(f.name, '{UNKNOWN_GROUP}') AS name
        FROM (SELECT 1 AS one) LEFT JOIN (
          SELECT facility_used_by_id AS k, facility_used_by_trading_style AS name FROM account WHERE {own} GROUP BY ALL) f ON TRUE"""
    if group is not None and not per_facility:
        name, own = "facility_used_by_report_group", f"facility_used_by_report_group_id = {_lit(group)}"
    else:
        name, own = "facility_used_by_legal_name", f"facility_used_by_id = {_lit(facility)}"
    return (f"SELECT '*' AS k, CAST({_lit(facility)} AS VARCHAR) AS id, "
            f"coalesce(min({name}) FILTER ({own}), '{DEFAULT_COMPANY}') AS name FROM account")


def scopes(facility, group, lender, lender_on_ecof=True) -> dict[str, str]:
    """WHERE clause by fact table; a lender matches in any case."""
    out = {}
    for t in ("application_facts", "paid_facts", "ecof_facts", "budget_facts"):
        c = ["TRUE"]
        if group is not None:
            c.append(f"{'report_group_id' if t == 'ecof_facts' else 'facility_used_by_report_group_id'} = {_lit(group)}")
        if facility is not None:
            c.append(f"facility_used_by_id = {_lit(facility)}")
        if lender is not None and (lender_on_ecof or t != "ecof_facts"):
            c.append(f"lower(facility_lender) = lower({_lit(lender)})")
        out[t] = " AND ".join(c)
    return out


def funnel_sql(facility=None, group=None, lender=None, period="L12M", group_by="year_month",
               per_facility=True, include_budget=True, budget_agg="sum", compat_fanout=False,
               lender_on_ecof=True, drop_empty=None, as_of=AS_OF, spine="applications") -> str:
    ctes, body = funnel_parts(facility, group, lender, period, group_by, per_facility, include_budget, budget_agg,
                              compat_fanout, lender_on_ecof, drop_empty, as_of, spine)
    return with_fixtures(body, ctes)


def funnel_parts(facility=None, group=None, lender=None, period="L12M", group_by="year_month",
                 per_facility=True, include_budget=True, budget_agg="sum", compat_fanout=False,
                 lender_on_ecof=True, drop_empty=None, as_of=AS_OF, spine="applications") -> tuple[dict[str, str], str]:
    """CTEs and final SELECT of the funnel report."""
    split = per_facility and group is not None
    metrics = [m for m in METRICS if include_budget or m != "budget"]
    cells = cells_sql("facility_used_by_id" if split else "'*'", scopes(facility, group, lender, lender_on_ecof), metrics)
    money = ("accept_val", "advance", "commission", "ecof_advance", "budget")
    ctes = {
        "months": period_sql(period, as_of),
        "places": facilities_sql(facility, group, per_facility),
        "cells": cells,
        "by_month": f"""
        SELECT k, ym, metric, CASE WHEN metric = 'budget' THEN CAST({budget_agg}(v) AS DECIMAL(18,2)) ELSE sum(v) END AS v
        FROM cells WHERE ym IN (SELECT year_month FROM months) GROUP BY k, ym, metric""",
        # facts hang off applications; a grain value that n months of the period share counts n times in the fan-out
        "shares": f"SELECT {GRAINS[group_by]} AS g, count(*) AS n FROM (SELECT year_month AS ym FROM months) GROUP BY 1",
        "by_grain": f"""
        SELECT k, g, metric, sum(v){' * any_value(n)' if compat_fanout else ''} AS v
        FROM (SELECT *, {GRAINS[group_by]} AS g, bool_or(metric = 'accept') OVER (PARTITION BY k, ym) AS has FROM by_month)
        JOIN shares USING (g) WHERE {'has' if spine == 'applications' else 'TRUE'} GROUP BY k, g, metric""",
        "turned": f"SELECT k, g, {_turned(metrics)} FROM by_grain GROUP BY k, g"}
    per = lambda n, d, kind: f"CASE WHEN {d} > 0 THEN CAST({n} * 1.0 / {d} AS {kind}) END"
    cols = {
        "report_name": f"name || ' : {lender if lender is not None else 'All'}'", "moment": "s.g",
        "ecof_count": "CAST(ecof_count AS BIGINT)", "ecof_advance": "CAST(ecof_advance AS DECIMAL(18,2))",
        "proposed_count": "CAST(proposed AS BIGINT)", "accept_count": "CAST(accept AS BIGINT)",
        "accept_val": "CAST(accept_val AS DECIMAL(18,2))", "accept_avg": per("accept_val", "accept", "DECIMAL(18,2)"),
        "accept_rate": per("accept", "proposed", "DECIMAL(18,6)"), "decline_count": "CAST(decline AS BIGINT)",
        "pending_count": "CAST(pending AS BIGINT)", "advance_count": "CAST(advance_count AS BIGINT)",
        "advance_val": "CAST(advance AS DECIMAL(18,2))", "advance_avg": per("advance", "advance_count", "DECIMAL(18,2)"),
        "commission_val": "CAST(commission AS DECIMAL(18,2))", "commission_rate_avg": per("commission", "advance", "DECIMAL(18,4)")}
    if include_budget:
        cols |= {"budget": "CAST(budget AS DECIMAL(18,2))", "budget_rate": per("advance", "budget", "DECIMAL(18,6)")}
    where = ""
    if split if drop_empty is None else drop_empty:
        where = f"WHERE greatest({', '.join(f'coalesce({m}, 0)' for m in metrics)}) > 0"
    body = (f"SELECT {', '.join(f'{v} AS {c}' for c, v in cols.items())} FROM places CROSS JOIN shares s "
            f"LEFT JOIN turned USING (k, g) {where} ORDER BY report_name, moment")
    return ctes, body


# ---------------------------------------------------------------------------
# monthly report family
# ---------------------------------------------------------------------------

def n0(x: str) -> str:
    """``'£' + FORMAT(x, 'N0')``; NULL stays NULL."""
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE '£' || format('{{:,}}', CAST(round({x}, 0) AS BIGINT)) END)"


def pct2(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE format('{{:,.2f}}', round(({x}) * 100, 2)) || '%' END)"


def _name_sql(facility, group, lender) -> str:
    conds = ["FALSE"]
    if facility is not None:
        conds.append(f"facility_used_by_id = {_lit(facility)}")
    if group is not None:
        conds.append(f"facility_used_by_report_group_id = {_lit(group)}")
    col = ("facility_used_by_report_group" if group is not None else
           "facility_used_by_legal_name" if facility is not None else _lit(DEFAULT_COMPANY))
    return (f"SELECT COALESCE(min({col}), {_lit(DEFAULT_COMPANY)}) || ' : ' || "
            f"'{lender if lender is not None else 'All'}' AS report_name FROM account WHERE {' OR '.join(conds)}")


def _strict(facility, group, lender, lender_strict=False, loose=False) -> str:
    if loose:
        c = ["1 = 1"]
        if facility is not None:
            c.append(f"facility_used_by_id = {_lit(facility)}")
        if group is not None:
            c.append(f"facility_used_by_report_group_id = {_lit(group)}")
        if lender is not None:
            c.append(f"facility_lender = {_lit(lender)}")
        return " AND ".join(c)
    c = [f"facility_used_by_id = COALESCE({_lit(facility)}, facility_used_by_id)",
         f"facility_used_by_report_group_id = COALESCE({_lit(group)}, facility_used_by_report_group_id)"]
    if lender_strict:
        c.append(f"facility_lender = COALESCE({_lit(lender)}, facility_lender)")
    elif lender is not None:
        c.append(f"facility_lender = {_lit(lender)}")
    return " AND ".join(c)


def _apps_pays(facility, group, lender, lender_strict_paid=False, loose=False) -> dict[str, str]:
    return {
        "Apps": f"""SELECT year_month, SUM(accept_val) AS accept_val, SUM(accept) AS accept,
                    SUM(decline) AS decline, SUM(pending) AS pending FROM application_facts
                    WHERE {_strict(facility, group, lender, loose=loose)} GROUP BY year_month""",
        "Pays": f"""SELECT year_month, SUM(advance) AS advance, SUM(advance_count) AS advance_count,
                    SUM(commission) AS commission,
                    CASE WHEN SUM(advance) > 0 THEN CAST(SUM(commission) / SUM(advance) AS DECIMAL(18,4)) END
                      AS commission_rate_avg
                    FROM paid_facts WHERE {_strict(facility, group, lender, lender_strict_paid, loose)}
                    GROUP BY year_month""",
    }


def rolling_sql(facility=None, group=None, lender=None, rolling=True, totals=True, as_of=AS_OF, until=None,
                compat_totals=False) -> str:
    ctes = {"RN": _name_sql(facility, group, lender), **_apps_pays(facility, group, lender)}
    ctes["M"] = f"SELECT DISTINCT year_month FROM ({period_sql('ROLLING' if rolling else 'LAST4Y', as_of)}) x"
    ctes["R"] = """
        SELECT m.year_month, CAST(a.accept_val AS DECIMAL(18,2)) AS accept_val,
               CASE WHEN a.accept > 0 THEN CAST(a.accept_val / a.accept AS DECIMAL(18,2)) END AS accept_average,
               a.accept + a.decline AS proposed, a.accept,
               CASE WHEN a.accept + a.decline > 0 THEN (a.accept * 100) // (a.accept + a.decline) END AS accept_rate,
               CAST(p.advance AS DECIMAL(18,2)) AS advance, p.advance_count,
               CASE WHEN p.advance_count > 0 THEN CAST(p.advance / p.advance_count AS DECIMAL(18,2)) END
                 AS advance_average
        FROM M m LEFT JOIN Apps a ON m.year_month = a.year_month LEFT JOIN Pays p ON m.year_month = p.year_month"""
    detail = f"""
        SELECT (SELECT report_name FROM RN) AS report_name, year_month, CAST(proposed AS BIGINT) AS proposed,
               CAST(accept AS BIGINT) AS accept, {n0('accept_val')} AS accept_val,
               {n0('accept_average')} AS accept_average, CAST(accept_rate AS VARCHAR) || '%' AS accept_rate,
               CAST(advance_count AS BIGINT) AS advance_count, {n0('advance')} AS advance,
               {n0('advance_average')} AS advance_average
        FROM R"""
    total = f"""
        SELECT (SELECT report_name FROM RN), 'TOTAL', CAST(SUM(proposed) AS BIGINT), CAST(SUM(accept) AS BIGINT),
               {n0('SUM(accept_val)')}, {n0('SUM(accept_val) / NULLIF(SUM(accept), 0)')},
               CAST((SUM(accept) * 100) // NULLIF(SUM(proposed), 0) AS VARCHAR) || '%',
               CAST(SUM(advance_count) AS BIGINT), {n0('SUM(advance)')},
               {n0('SUM(advance) / NULLIF(SUM(advance_count), 0)')}
        FROM R"""
    if compat_totals:
        total = "SELECT NULL, 'TOTAL'" + ", NULL" * 8
    body = detail + ("\nUNION ALL\n" + total if totals or compat_totals else "") + "\nORDER BY year_month"
    return with_fixtures(body, ctes)


def monthly_applications_sql(facility=None, group=None, lender=None, l12m=False, as_of=AS_OF) -> str:
    ctes = {"RN": _name_sql(facility, group, lender),
            **_apps_pays(facility, group, lender, lender_strict_paid=True)}
    join_m = ""
    if l12m:
        ctes["M"] = f"SELECT DISTINCT year_month FROM ({period_sql('L12M', as_of)}) x"
        join_m = "JOIN M m ON a.year_month = m.year_month"
    body = f"""
    SELECT (SELECT report_name FROM RN) AS report_name, a.year_month,
           CAST(a.accept_val AS DECIMAL(18,2)) AS accept_val, CAST(a.accept AS BIGINT) AS accept,
           CAST(a.decline AS BIGINT) AS decline, CAST(a.pending AS BIGINT) AS pending,
           CAST(a.accept + a.decline AS BIGINT) AS proposed,
           {n0('a.accept_val')} AS accept_val_text,
           {n0('CASE WHEN a.accept > 0 THEN a.accept_val / a.accept END')} AS accept_average,
           CASE WHEN a.accept + a.decline > 0 THEN CAST((a.accept * 100) // (a.accept + a.decline) AS VARCHAR) || '%' END
             AS accept_rate,
           CAST(p.advance_count AS BIGINT) AS advance_count, {n0('p.advance')} AS advance,
           {n0('CASE WHEN p.advance > 0 THEN p.advance / p.advance_count END')} AS advance_average
    FROM Apps a JOIN Pays p ON a.year_month = p.year_month {join_m}
    ORDER BY a.year_month"""
    return with_fixtures(body, ctes)


def monthly_period_sql(period="L12M", facility=None, group=None, lender=None, as_of=AS_OF) -> str:
    metrics = ["accept", "decline", "pending", "proposed", "accept_val", "advance", "advance_count", "commission"]
    where = {t: _strict(facility, group, lender, loose=True) for t in ("application_facts", "paid_facts")}
    ctes = {
        "months": period_sql(period, as_of),
        "cells": cells_sql("'*'", where, metrics),
        "turned": f"""SELECT ym, {_turned(metrics)} FROM (SELECT ym, metric, sum(v) AS v FROM cells GROUP BY ALL)
                      GROUP BY ym HAVING count(*) FILTER (metric = 'accept') > 0""",
        "shown": """SELECT ym, CAST(accept_val AS DECIMAL(18,2)) AS accept_val, CAST(accept AS BIGINT) AS accept,
                    CAST(decline AS BIGINT) AS decline, CAST(pending AS BIGINT) AS pending, CAST(proposed AS BIGINT) AS proposed,
                    CAST(advance AS DECIMAL(18,2)) AS advance, CAST(advance_count AS BIGINT) AS advance_count,
                    CAST(commission AS DECIMAL(18,2)) AS commission,
                    CASE WHEN advance > 0 THEN CAST(commission / advance AS DECIMAL(18,4)) END AS rate FROM turned"""}
    body = f"""
    SELECT ({_name_sql(facility, group, lender)}) AS report_name, months.year_month, accept_val, accept, decline, pending, proposed,
           {n0('accept_val')} AS accept_val_text, {n0('CASE WHEN accept > 0 THEN accept_val / accept END')} AS accept_average,
           CASE WHEN proposed > 0 THEN CAST(accept * 100 // proposed AS VARCHAR) || '%' END AS accept_rate,
           advance_count, {n0('advance')} AS advance, {n0('CASE WHEN advance_count > 0 THEN advance / advance_count END')} AS advance_average,
           commission, {n0('commission')} AS commission_formatted,
           rate AS commission_rate_avg, {pct2('rate')} AS commission_rate_avg_formatted
    FROM months LEFT JOIN shown ON shown.ym = months.year_month
    ORDER BY 2"""
    return with_fixtures(body, ctes)


# ---------------------------------------------------------------------------
# summaries, job log, notifications
# ---------------------------------------------------------------------------

PLACE = ("facility_used_by_id, facility_used_by_legal_name, facility_used_by_trading_style, facility_used_by_report_group_id, "
         "account_report_group, facility_used_by_business_manager_email")


def _long_rows(measures: dict[str, str], keys: str, source: str, month: str | None) -> str:
    """One row per key and measure."""
    own = f"WHERE year_month = '{month}'" if month is not None else ""
    return (f"SELECT {keys}, year_month, unnest([{', '.join(map(_lit, measures))}]) AS measure, "
            f"unnest([{', '.join(f'CAST({v} AS DECIMAL(28,2))' for v in measures.values())}]) AS v FROM {source} {own}")


def _measure(name: str, kind: str) -> str:
    return f"CAST(sum(v) FILTER (measure = '{name}') AS {kind}) AS {name}"


def application_summary_sql(month: str | None, as_of=AS_OF, source: str = "application_mth", counts: str = "COUNT") -> str:
    n = (lambda c: f"{c} IS NOT NULL") if counts == "COUNT" else (lambda c: c)
    long = {"accept_count": "accept", "accept_total": "coalesce(accept_val, 0)", "decline_count": n("decline"),
            "decline_total": "coalesce(decline_val, 0)", "pending_count": n("pending"), "pending_total": "coalesce(pending_val, 0)"}
    turned = ", ".join(_measure(m, "BIGINT" if m.endswith("count") else "DECIMAL(18,2)") for m in long)
    return f"""
    SELECT {PLACE}, facility_code, {turned}, year_month, {_ts(as_of)} AS last_updated
    FROM ({_long_rows(long, 'facility_code', source, month)}) rows
    JOIN (SELECT facility_code, {PLACE} FROM account) USING (facility_code) GROUP BY ALL"""


def paid_summary_sql(month: str | None, as_of=AS_OF) -> str:
    long = {"advance_count": "advance IS NOT NULL", "advance_total": "advance"}
    return f"""
    SELECT {PLACE}, facility_code, product_code, funding_option_uc, {_measure('advance_count', 'BIGINT')},
           {_measure('advance_total', 'DECIMAL(18,2)')}, year_month, {_ts(as_of)} AS last_updated
    FROM ({_long_rows(long, 'facility_code, product_code', 'paid_mth_p', month)}) rows
    JOIN lender_product_code USING (product_code)
    JOIN (SELECT facility_code, {PLACE} FROM account) USING (facility_code) GROUP BY ALL"""


PAID_WITH_PRODUCT = {"paid_mth_p": paid_mth_sql(with_product=True)}


def _gate_ctes(kind: str, month: str, loaded: dt.date) -> dict[str, str]:
    """``gate``: the month, what source and summary have, the action."""
    earlier = application_mth_sql(loaded) if kind == "apps" else paid_mth_sql(loaded, True)
    source = "application_mth" if kind == "apps" else "paid_mth"
    known = "JOIN account USING (facility_code)" + (" JOIN lender_product_code USING (product_code)" if kind == "paids" else "")
    return {"gate": f"""
    SELECT '{month}' AS year_month, bool_or(src) AS source_has_month, bool_or(NOT src) AS summary_has_month
    FROM (SELECT TRUE AS src FROM {source} WHERE year_month = '{month}'
          UNION ALL SELECT FALSE FROM ({earlier}) e {known} WHERE e.year_month = '{month}')"""}


def _gate_action(truncate_first: bool = False) -> str:
    done = "" if truncate_first else "WHEN summary_has_month THEN 'skip: summary already has month'"
    return f"CASE WHEN NOT coalesce(source_has_month, FALSE) THEN 'skip: no source rows for month' {done} ELSE 'load' END"


def summary_gate_sql(kind: str, month: str, loaded: dt.date) -> str:
    return with_fixtures(
        f"SELECT year_month, coalesce(source_has_month, FALSE) AS source_has_month, coalesce(summary_has_month, FALSE) AS summary_has_month, "
        f"{_gate_action()} AS action FROM gate", _gate_ctes(kind, month, loaded))


def paid_phase_sql(month: str, product: str = "FPP", as_of=AS_OF) -> str:
    body = f"""
    SELECT '{month}' AS year_month,
           CASE WHEN COALESCE(max(CASE WHEN product_code = '{product}' THEN 1 ELSE 0 END), 0) = 1
                THEN 'first phase' ELSE 'second phase' END AS phase,
           CAST(count(1) AS BIGINT) AS rows_inserted
    FROM ({paid_summary_sql(month, as_of)}) s WHERE year_month = '{month}'"""
    return with_fixtures(body, PAID_WITH_PRODUCT)


def job_log_sql(kind: str, month: str, started: dt.datetime, finished: dt.datetime, loaded: dt.date,
                truncate_first: bool = False, error: str | None = None, as_of=AS_OF) -> str:
    """Candidate log lines with the action they belong to; those of the gate's
    action are shown."""
    proc, table = (("set_application_mth_summary", "application_mth_summary") if kind == "apps"
                   else ("set_paid_mth_summary", "paid_mth_summary"))
    rows = application_summary_sql(month, as_of) if kind == "apps" else paid_summary_sql(month, as_of)
    time = f"'. Execution time: {(finished - started).seconds} seconds'"
    end = (f"('load', 'Error', 'Error occurred: {error}', {_ts(finished)})" if error else
           f"('load', 'Success', concat('{proc} completed successfully. Rows inserted: ', (SELECT count(*) FROM made), {time}), {_ts(finished)})"
           if kind == "apps" else
           f"('load', 'Success', concat('{proc} ', (SELECT if(count(*) FILTER (product_code = 'FPP') > 0, 'first', 'second') FROM made), "
           f"' phase completed successfully. Rows inserted for {month}: ', (SELECT count(*) FROM made), {time}), {_ts(finished)})")
    change = f"Table [dbo].[{table}] truncated." if truncate_first else f"Deleted existing data for year_month: {month}"
    ctes = _gate_ctes(kind, month, loaded) | {"made": rows}
    body = f"""
    SELECT 'Database.StoredProcedure.{proc}' AS applicationName, kind AS logType, message, ts AS dateCreated,
           CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year
    FROM (VALUES ('', 'Information', 'Execution started at {started:%Y-%m-%d %H:%M:%S}', {_ts(started)}),
                 ('skip: no source rows for month', 'Warning', 'No source data found for previous month: {month}. Procedure execution canceled.', {_ts(finished)}),
                 ('skip: summary already has month', 'Information', 'Summary data already exists for previous month: {month}', {_ts(finished)}),
                 ('load', 'Information', 'Processing data for previous month: {month}', {_ts(finished)}),
                 ('load', 'Information', '{change}', {_ts(finished)}), {end}) lines(own, kind, message, ts), gate
    WHERE own IN ('', {_gate_action(truncate_first)})"""
    return with_fixtures(body, (PAID_WITH_PRODUCT if kind == "paids" else {}) | ctes)


def _overdue(now: dt.datetime) -> str:
    """What was due before ``now``, less what is done or cannot be shown."""
    return (f"SELECT * FROM crm_user_notification WHERE scheduled_end < {_ts(now)} EXCEPT ALL "
            f"SELECT * FROM crm_user_notification WHERE actual_end IS NOT NULL OR activity_type IS NULL OR coalesce(regarding, '') = ''")


def _labelled(col: str) -> str:
    from ledgerlens.functions.filters import ACTIVITY_LABELS, NOT_FOUND_LABEL
    known = ", ".join(f"{_lit(k)}: {_lit(v)}" for k, v in ACTIVITY_LABELS.items())
    return f"coalesce(MAP {{{known}}}[{col}], {_lit(NOT_FOUND_LABEL)})"


def notifications_sql(now: dt.datetime, email: str | None = None) -> str:
    whose = f"WHERE email = {_lit(email)}" if email is not None else ""
    body = f"""
    SELECT scheduled_end, strftime(scheduled_end, '%d/%m/%Y') AS scheduled_end_date, {_labelled('activity_type')} AS activity_type,
           subject, regarding, link, initials, name
    FROM ({_overdue(now)}) due LEFT JOIN crm_user USING (crm_user_id) {whose} ORDER BY scheduled_end"""
    return with_fixtures(body)


def notifications_flag_sql(now: dt.datetime, email: str | None) -> str:
    return with_fixtures(f"""
    SELECT CAST(EXISTS (FROM ({_overdue(now)}) due SEMI JOIN (SELECT crm_user_id FROM crm_user WHERE email = {_lit(email)}) who USING (crm_user_id))
                AS INTEGER) AS flag""")


# ---------------------------------------------------------------------------
# loaders
# ---------------------------------------------------------------------------

APPS_COLS = ["id", "lender_id", "facility_code", "upload_legal_name", "accept", "accept_val", "decline",
             "decline_val", "pending", "pending_val", "month", "year", "upload_date", "year_month"]
PAIDS_COLS = ["id", "lender_id", "facility_code", "upload_legal_name", "product_code", "defer_by", "apr",
              "term", "advance", "date", "return_rate", "month", "year", "upload_date", "year_month"]


def _changed_sql(cols: list[str]) -> str:
    return "(" + " OR ".join(f"COALESCE(t.{c} <> s.{c}, FALSE)" for c in cols) + ")"


def upsert_ctes(kind: str, loaded: dt.date) -> dict[str, str]:
    if kind == "apps":
        return {"T": f"SELECT {', '.join(APPS_COLS)} FROM ({application_mth_sql(loaded)}) a",
                "S": f"SELECT {', '.join(APPS_COLS)} FROM application_mth"}
    return {"T": f"SELECT {', '.join(PAIDS_COLS)} FROM ({paid_mth_sql(loaded, True)}) p",
            "S": f"SELECT {', '.join(PAIDS_COLS)} FROM paid_mth_p"}


def upsert_sql(kind: str, what: str, change_cols: list[str], loaded: dt.date) -> str:
    cols = APPS_COLS if kind == "apps" else PAIDS_COLS
    ctes = upsert_ctes(kind, loaded)
    ch = _changed_sql(change_cols)
    if what == "changed":
        body = f"SELECT {', '.join('s.' + c for c in cols)} FROM S s JOIN T t ON t.id = s.id WHERE {ch}"
    elif what == "new":
        body = f"SELECT s.* FROM S s WHERE NOT EXISTS (SELECT 1 FROM T t WHERE t.id = s.id)"
    else:
        merged = f"""
        SELECT {', '.join(f'CASE WHEN t.id IS NULL OR (s.id IS NOT NULL AND {ch}) THEN s.{c} ELSE t.{c} END AS {c}'
                          for c in cols)},
               CASE WHEN t.id IS NULL THEN 'inserted' WHEN s.id IS NOT NULL AND {ch} THEN 'updated'
                    ELSE 'kept' END AS _op
        FROM T t FULL OUTER JOIN S s ON t.id = s.id"""
        if what == "merged":
            body = merged
        else:
            body = f"""
            SELECT '{what}' AS table_name,
                   CAST(count(*) FILTER (WHERE _op = 'updated') AS BIGINT) AS rows_updated,
                   CAST(count(*) FILTER (WHERE _op = 'inserted') AS BIGINT) AS rows_inserted,
                   CAST(count(*) AS BIGINT) AS rows_total
            FROM ({merged}) m"""
    extra = dict(PAID_WITH_PRODUCT)
    extra.update(ctes)
    return with_fixtures(body, extra)


def json_rows_sql(since: dt.date | None = None, until: dt.date | None = None) -> str:
    conds = ["1 = 1"]
    if since is not None:
        conds.append(f"o.o_orderdate >= {_ts(since)}")
    if until is not None:
        conds.append(f"o.o_orderdate < {_ts(until)}")
    return f"""
    SELECT CAST(l.l_shipdate AS DATE) AS date, CAST(o.o_custkey AS VARCHAR) AS branch_id,
           'Branch ' || CAST(o.o_custkey AS VARCHAR) AS branch_upload_name,
           CAST(l.l_linenumber AS INTEGER) AS lender_id, CAST(l.l_quantity AS INTEGER) AS app,
           CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS accept,
           CASE WHEN l.l_returnflag <> 'N' THEN CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END END AS pending,
           CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS decline,
           CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(9,2)) AS advance
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE {' AND '.join(conds)}"""


def replace_slice_sql(cutoff: dt.date, overlap_days: int, first_only: bool = False) -> str:
    since = cutoff - dt.timedelta(days=overlap_days)
    ctes = {"Tgt": json_rows_sql(until=cutoff), "Pay": json_rows_sql(since=since)}
    named = "SELECT DISTINCT date, lender_id FROM Pay"
    if first_only:  # a payload is an order's lines, in order of all their fields as text
        elements = "struct_pack(date, branch_id, branch_upload_name, lender_id := lender_id::VARCHAR, app := app::VARCHAR, accept := accept::VARCHAR, pending := pending::VARCHAR, decline := decline::VARCHAR, advance := advance::VARCHAR)"
        keyed = json_rows_sql(since=since).replace("SELECT ", "SELECT o.o_orderkey AS k, ", 1)
        named = f"SELECT DISTINCT f.date, f.lender_id::INTEGER AS lender_id FROM (SELECT k, min({elements}) AS f FROM ({keyed}) GROUP BY k)"
    body = f"""
    SELECT t.* FROM Tgt t ANTI JOIN ({named}) n ON n.date = t.date AND n.lender_id = t.lender_id
    UNION ALL SELECT * FROM Pay"""
    return with_fixtures(body, ctes)


# ---------------------------------------------------------------------------
# lender conversion
# ---------------------------------------------------------------------------

def lender_conversion_sql(months: list[str], facility: str | None = None, compat: bool = False) -> str:
    """Base tables are aggregated once per place (lender, facility, names) and
    month; the report's rows are all places times the months."""
    own = f"WHERE facility_used_by_id = {_lit(facility)}" if facility is not None else ""
    wanted = f"printf('%04d-%02d', year, month) IN ({', '.join(map(_lit, months))})"
    place = "facility_lender, facility_used_by_id, legal_name, trading_style, is_reporting"
    tuples = "SELECT DISTINCT * EXCLUDE (facility_code)" if compat else "SELECT *"
    deals = ("SELECT facility_lender, facility_used_by_id, ym, sum(DISTINCT advance) AS total, count(DISTINCT id) AS n"
             if compat else "SELECT facility_lender, facility_used_by_id, ym, sum(advance) AS total, count(DISTINCT id) AS n")
    ctes = {
        "codes": f"SELECT facility_code, {place} FROM account {own}",
        "sums": f"""
        SELECT {place}, ym, sum(decline) AS decline, sum(accept) AS accept, sum(accept_val) AS accept_val, sum(pending) AS pending
        FROM ({tuples} FROM codes JOIN (
          SELECT facility_code, printf('%04d-%02d', year, month) AS ym, decline, accept, accept_val, pending
          FROM application_mth WHERE {wanted}) USING (facility_code)) GROUP BY ALL""",
        "deals": f"""
        {deals} FROM (SELECT DISTINCT facility_lender, facility_used_by_id, printf('%04d-%02d', year, month) AS ym, id, advance
          FROM paid_mth JOIN (SELECT DISTINCT facility_code, facility_lender, facility_used_by_id FROM codes) USING (facility_code)
          WHERE {wanted}) GROUP BY ALL""",
        "filled": f"""
        SELECT {place}, ym AS year_month, coalesce(decline, 0) AS d, coalesce(accept, 0) AS a, coalesce(accept_val, 0) AS v,
               coalesce(pending, 0) AS q, coalesce(total, 0) AS t, coalesce(n, 0) AS n
        FROM (SELECT DISTINCT {place}, unnest([{', '.join(map(_lit, months))}]) AS ym FROM codes)
        LEFT JOIN sums USING ({place}, ym) LEFT JOIN deals USING (facility_lender, facility_used_by_id, ym)"""}
    share = lambda x: f"round(CAST({x} AS DOUBLE) / CAST(a + d AS DOUBLE) * 100, 0)"
    body = f"""
    SELECT facility_lender, year_month, legal_name, trading_style, facility_used_by_id, is_reporting,
           CAST(d AS BIGINT) AS decline, CAST(a AS BIGINT) AS accept, CAST(v AS DECIMAL(18,2)) AS accept_val,
           CAST(q AS BIGINT) AS pending, CAST(a + d AS BIGINT) AS proposed,
           concat(a + d, CASE WHEN q > 0 THEN concat(' (+', q, ' Ref)') END) AS proposed_text,
           CASE a + d WHEN 0 THEN 'N/A' ELSE concat(CAST({share('a')} AS BIGINT), '%') END AS accept_rate,
           {n0('v')} AS accept_val_text, CAST(t AS DECIMAL(18,2)) AS advance_total, CAST(n AS BIGINT) AS advance_count,
           {n0('CAST(t AS DECIMAL(18,2))')} AS advance_text,
           CASE a + d WHEN 0 THEN 0.0 ELSE {share('n')} END AS conversion,
           CASE a + d WHEN 0 THEN 'N/A' ELSE concat(CAST({share('n')} AS BIGINT), '%') END AS conversion_text
    FROM filled ORDER BY year_month, facility_lender"""
    return with_fixtures(body, ctes)


# ---------------------------------------------------------------------------
# reconcile
# ---------------------------------------------------------------------------

RECON_METRICS = ["budget", "budget_rate", "advance_val", "accept_rate"]


def reconcile_rows_sql(a_sql: str, b_sql: str, metrics=RECON_METRICS) -> str:
    def side(sql, tag):
        cols = ", ".join(f"CAST({m} AS DECIMAL(38,6)) AS {tag}_{m}" for m in metrics)
        return f"SELECT report_name, moment, {cols}, TRUE AS _{tag} FROM ({sql}) s"
    cells = " UNION ALL ".join(
        f"SELECT report_name, moment, in_a, in_b, '{m}' AS metric, a_{m} AS baseline, b_{m} AS comparison FROM J"
        for m in metrics)
    return f"""
    WITH A AS ({side(a_sql, 'a')}), B AS ({side(b_sql, 'b')}),
    J AS (SELECT COALESCE(A.report_name, B.report_name) AS report_name, COALESCE(A.moment, B.moment) AS moment,
                 A._a IS NOT NULL AS in_a, B._b IS NOT NULL AS in_b, {', '.join(f'a_{m}, b_{m}' for m in metrics)}
          FROM A FULL OUTER JOIN B ON A.report_name = B.report_name AND A.moment = B.moment),
    X AS ({cells})
    SELECT report_name, moment, metric, baseline, comparison,
           CAST(round(comparison - baseline, 6) AS DECIMAL(38,6)) AS difference,
           CASE WHEN baseline IS NULL OR baseline = 0 THEN NULL
                ELSE CAST(round((comparison - baseline) / baseline * 100, 2) AS DECIMAL(38,2)) END AS percent_change,
           CASE WHEN in_a AND in_b THEN 'Present' WHEN in_a THEN 'Missing in comparison' ELSE 'Missing in baseline' END
             AS status
    FROM X
    WHERE NOT (in_a AND in_b) OR baseline IS DISTINCT FROM comparison"""


REPORT_COLS = ["report_name", "moment", "ecof_count", "ecof_advance", "proposed_count", "accept_count", "accept_val",
               "accept_avg", "accept_rate", "decline_count", "pending_count", "advance_count", "advance_val", "advance_avg",
               "commission_val", "commission_rate_avg", "budget", "budget_rate"]


def reconcile_except_sql(a_sql: str, b_sql: str) -> str:
    """Rows by how often either side has them; the difference is what remains."""
    cols = ", ".join(REPORT_COLS)
    return f"""
    SELECT {cols}, source FROM (
      SELECT {cols}, CASE WHEN balance > 0 THEN 'baseline' ELSE 'comparison' END AS source, unnest(range(abs(balance)))
      FROM (SELECT {cols}, CAST(sum(side) AS BIGINT) AS balance
            FROM (SELECT *, 1 AS side FROM ({a_sql}) a UNION ALL SELECT *, -1 FROM ({b_sql}) b) GROUP BY {cols}) WHERE balance <> 0)"""


def reconcile_summary_sql(cases: list[tuple[int, str, str]], metrics=RECON_METRICS, unshared: tuple[str, ...] = ()) -> str:
    """Counts over one cell per (case, side, key, column); ``unshared``: report columns
    that only one side has."""
    cols = [c for c in REPORT_COLS if c not in ("report_name", "moment", *unshared)]
    rows = " UNION ALL ".join(f"SELECT {tid} AS test_id, {k} AS side, {', '.join(['report_name', 'moment', *cols])} FROM ({sql}) r"
                              for tid, *both in cases for k, sql in enumerate(both))
    own = [f"SELECT column_name AS c FROM (DESCRIBE {sql})" for sql in cases[0][1:]]
    only = lambda a, b, name: f"(SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM ({a} EXCEPT {b})) AS {name}"
    cells = (f"SELECT test_id, side, report_name, moment, unnest({cols}) AS col, "
             f"unnest([{', '.join(f'CAST({c} AS DECIMAL(38,6))' for c in cols)}]) AS v FROM rows")
    named = f"col IN ({', '.join(map(repr, metrics))})"
    return f"""
    WITH rows AS ({rows}), cells AS ({cells}),
    met AS (SELECT test_id, report_name, moment, col, count(*) AS sides,
                   any_value(v) FILTER (side = 0) IS DISTINCT FROM any_value(v) FILTER (side = 1) AS differs
            FROM cells GROUP BY ALL),
    sums AS (SELECT test_id, count(*) FILTER (sides = 1) // {len(cols)} AS rows_missing,
                    count(*) FILTER (sides = 2 AND differs AND {named}) AS value_diffs,
                    count(*) FILTER (sides = 2 AND differs AND NOT {named}) AS other_diffs FROM met GROUP BY 1),
    sizes AS (SELECT test_id, count(*) FILTER (side = 0) AS baseline_rows, count(*) FILTER (side = 1) AS comparison_rows FROM rows GROUP BY 1),
    lists AS (SELECT {only(*own, 'missing_columns')}, {only(*own[::-1], 'extra_columns')})
    SELECT test_id, baseline_rows, comparison_rows, CAST(rows_missing AS BIGINT) AS rows_missing, value_diffs, other_diffs,
           missing_columns, extra_columns,
           CASE WHEN rows_missing + value_diffs + other_diffs = 0 AND baseline_rows = comparison_rows AND missing_columns = ''
                THEN 'MATCH' ELSE 'DIFF' END AS verdict
    FROM sums JOIN sizes USING (test_id), lists"""


def ecof_period_sql(label: str = "year_month", period="L12M", facility=None, group=None, lender=None, as_of=AS_OF) -> str:
    metrics = [m for m in METRICS if m != "budget"]
    ctes = {
        "months": period_sql(period, as_of),
        "cells": cells_sql("'*'", scopes(facility, group, lender, lender_on_ecof=False), metrics),
        "turned": f"""SELECT ym, {_turned(metrics)} FROM (SELECT ym, metric, sum(v) AS v FROM cells GROUP BY ALL)
                      GROUP BY ym HAVING count(*) FILTER (metric = 'accept') > 0"""}
    rate = "CASE WHEN advance > 0 THEN CAST(commission / advance AS DECIMAL(18,4)) END"
    body = f"""
    SELECT ({_name_sql(facility, group, lender)}) AS report_name, year_month AS {label}, CAST(ecof_count AS BIGINT) AS ecof_count,
           CAST(ecof_advance AS DECIMAL(18,2)) AS ecof_advance, {n0('ecof_advance')} AS ecof_advance_text,
           CAST(proposed AS BIGINT) AS proposed_count, CAST(accept AS BIGINT) AS accept_count,
           CAST(accept_val AS DECIMAL(18,2)) AS accept_val, {n0('accept_val')} AS accept_text,
           {n0('CASE WHEN accept > 0 THEN accept_val / accept END')} AS accept_avg_text,
           CASE WHEN proposed > 0 THEN concat(CAST(accept AS BIGINT) * 100 // CAST(proposed AS BIGINT), '%') END AS accept_rate_text,
           CAST(decline AS BIGINT) AS decline_count, CAST(pending AS BIGINT) AS pending_count,
           CAST(advance_count AS BIGINT) AS advance_count, CAST(advance AS DECIMAL(18,2)) AS advance_val, {n0('advance')} AS advance_text,
           {n0('CASE WHEN advance_count > 0 THEN advance / advance_count END')} AS advance_avg_text,
           CAST(commission AS DECIMAL(18,2)) AS commission_val, {n0('commission')} AS commission_text,
           {rate} AS commission_rate_avg, {pct2(rate)} AS commission_rate_avg_text
    FROM months LEFT JOIN turned ON ym = year_month ORDER BY 2"""
    return with_fixtures(body, ctes)


def funnel_mapped_sql(group_by="year_month", period="L12M", facility=None, group=None, lender=None, as_of=AS_OF,
                      compat_days=False, compat_widen=False) -> str:
    metrics = [m for m in METRICS if m != "budget"]
    chosen = "g IN (SELECT g FROM wanted)" if compat_widen else "ym IN (SELECT year_month FROM months)"
    times = "(SELECT count(*) FROM moment WHERE moment.year_month = ym)" if compat_days else "1"
    ctes = {
        "months": period_sql(period, as_of),
        "wanted": f"SELECT DISTINCT {GRAINS[group_by]} AS g FROM (SELECT year_month AS ym FROM months)",
        "cells": cells_sql("'*'", scopes(facility, group, lender, lender_on_ecof=False), metrics),
        "per_month": f"""
        SELECT *, {GRAINS[group_by]} AS g FROM (
          SELECT ym, metric, sum(v) * {times} AS v, bool_or(metric = 'accept') OVER (PARTITION BY ym) AS has FROM cells GROUP BY ym, metric)""",
        "turned": f"SELECT g, {_turned(metrics)} FROM (SELECT g, metric, sum(v) AS v FROM per_month WHERE has AND {chosen} GROUP BY ALL) GROUP BY g"}
    per = lambda n, d, kind: f"CASE WHEN {d} > 0 THEN CAST({n} / {d} AS {kind}) END"
    body = f"""
    SELECT ({_name_sql(facility, group, lender)}) AS report_name, g AS group_by, CAST(ecof_count AS BIGINT) AS ecof_count,
           CAST(ecof_advance AS DECIMAL(18,2)) AS ecof_advance, CAST(proposed AS BIGINT) AS proposed_count, CAST(accept AS BIGINT) AS accept_count,
           CAST(accept_val AS DECIMAL(18,2)) AS accept_val, {per('accept_val', 'accept', 'DECIMAL(18,6)')} AS accept_avg,
           {per('accept', 'proposed', 'DECIMAL(18,4)')} AS accept_rate, CAST(decline AS BIGINT) AS decline_count,
           CAST(pending AS BIGINT) AS pending_count, CAST(advance_count AS BIGINT) AS advance_count,
           CAST(advance AS DECIMAL(18,2)) AS advance_val, {per('advance', 'advance_count', 'DECIMAL(18,6)')} AS advance_avg,
           CAST(commission AS DECIMAL(18,2)) AS commission_val, {per('commission', 'advance', 'DECIMAL(18,4)')} AS commission_rate_avg
    FROM wanted LEFT JOIN turned USING (g) ORDER BY 2"""
    return with_fixtures(body, ctes)


def funnel_text_sql(**kw) -> str:
    base = funnel_sql(include_budget=False, lender_on_ecof=False, **kw)
    base = base[: base.rindex("ORDER BY")]
    return f"""
    SELECT report_name, moment AS group_by, ecof_count, ecof_advance, {n0('ecof_advance')} AS ecof_advance_text,
           proposed_count, accept_count, accept_val, {n0('accept_val')} AS accept_text,
           {n0('CASE WHEN accept_count > 0 THEN accept_val / accept_count END')} AS accept_avg_text,
           CASE WHEN proposed_count > 0 THEN
                CAST(CAST(accept_count * 100.0 / proposed_count AS DECIMAL(18,6)) AS VARCHAR) || '%' END AS accept_rate_text,
           decline_count, pending_count, advance_count, advance_val, {n0('advance_val')} AS advance_text,
           {n0('CASE WHEN advance_count > 0 THEN advance_val / advance_count END')} AS advance_avg_text,
           commission_val, {n0('commission_val')} AS commission_text, commission_rate_avg,
           {pct2('CASE WHEN advance_val > 0 THEN commission_val / advance_val END')} AS commission_rate_avg_text
    FROM ({base}) f"""
