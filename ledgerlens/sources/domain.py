"""Domain inputs of the lending-funnel model, derived from the driver tables.

The reference reads SQL Server tables (``account``, ``application_mth``,
``paid_mth``, ``paid_budget``, eCOF documents, CRM notifications, raw feeds).
We have TPC-H-like parquet instead, so each domain table is a deterministic
DataFrame derived from it; the SQL oracle derives the same rows with the
same rules (see ``ledgerlens.plans.oracle_sql``).

Mapping (one customer = one facility code, one nation = one facility,
one region = one report group, market segment = lender):

* ``account``            customer JOIN nation JOIN region
* ``application_mth``    orders per customer x order month; status F/O/P =
                         accepted / declined / pending
* ``paid_mth``           lineitem JOIN orders; one paid deal per line
* ``paid_budget``        quarterly order value per nation x segment x year
* ``vw_ecof_all``        one quote document per order
* ``crm_*``              events as CRM activities

``as_loaded`` gives the table as an earlier load saw it (rows up to the load
date, recent rows still unsettled); feeds and upserts compare it with the
current derivation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.tables import Tables

# Fixed parameters of the derived model (both engines use these).
AS_OF = dt.date(1999, 7, 15)          # "today" for every period computation
CALENDAR_START = dt.date(1995, 1, 1)   # bounds of the daily calendar
CALENDAR_END = dt.date(2001, 12, 31)
FEED_CUTOFF = dt.date(1999, 1, 1)      # date of the earlier load
UNSETTLED_DAYS = 90                    # rows this recent were unsettled at load
NOTIFICATIONS_NOW = dt.datetime(2024, 1, 15)


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c: str | Column, scale: int = 2) -> Column:
    """Exact money: doubles become ``decimal(18,scale)`` before any sum."""
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(18,{scale})")


def year_month_of(year: Column, month: Column) -> Column:
    """``YYYY-MM`` from integer year and month (persisted column of paid_mth). Usual ones are padded,
    which takes a fraction of the formatter's time a row; it takes all others, nulls too."""
    usual = year.between(0, 9999) & month.between(0, 99)
    padded = F.when(usual, F.concat(F.lpad(_s(year), 4, "0"), F.lit("-"), F.lpad(_s(month), 2, "0")))
    return F.coalesce(padded, F.format_string("%04d-%02d", year, month))     # never null: a table's write sorts it once


Window = tuple[dt.date | None, dt.date | None]


def in_window(df: DataFrame, c: str, window: Window | None) -> DataFrame:
    """Rows with ``lo <= c < hi`` of a raw date column (an open end is None),
    so the bounds reach the parquet scan."""
    lo, hi = window or (None, None)
    if lo is not None:
        df = df.filter(F.col(c) >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        df = df.filter(F.col(c) < F.lit(hi).cast("timestamp_ntz"))
    return df


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------

def account(t: Tables) -> DataFrame:
    """One row per facility code. nation/region are TPC-H fixed-size (25/5
    rows), so broadcasting them is size-safe at any scale factor."""
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
    return j.select(
        F.concat(F.lit("A"), _s("c_custkey")).alias("account_id"),
        _s("c_custkey").alias("facility_code"),
        F.col("c_mktsegment").alias("facility_lender"),
        F.concat(F.lit("U"), _s("c_nationkey")).alias("facility_used_by_id"),
        F.col("n_name").alias("facility_used_by_legal_name"),
        F.concat(F.col("n_name"), F.lit(" T")).alias("facility_used_by_trading_style"),
        F.concat(F.lit("BM"), _s("n_regionkey")).alias("facility_used_by_business_manager_initials"),
        F.concat(F.lit("bm"), _s("n_regionkey"), F.lit("@example.com"))
         .alias("facility_used_by_business_manager_email"),
        F.concat(F.lit("G"), _s("n_regionkey")).alias("facility_used_by_report_group_id"),
        F.col("r_name").alias("facility_used_by_report_group"),
        F.col("r_name").alias("account_report_group"),
        F.col("n_name").alias("legal_name"),
        F.concat(F.col("n_name"), F.lit(" T")).alias("trading_style"),
        (F.col("n_regionkey") != F.lit(4)).alias("is_reporting"),
    )


def lender_product_code(t: Tables) -> DataFrame:
    """Product (brand) -> funding option by brand number band."""
    n = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return (t.part.select("p_brand").distinct()
            .select(F.col("p_brand").alias("product_code"),
                    F.when(n <= 8, "HP").when(n <= 16, "FPP").otherwise("LOAN")
                     .alias("funding_option_uc")))


# --------------------------------------------------------------------------
# facts
# --------------------------------------------------------------------------

def date_bounds(t: Tables) -> DataFrame:
    """First and last date of the facts, one row (lo, hi)."""
    dates = t.orders.select(F.col("o_orderdate").alias("d")).unionByName(t.lineitem.select(F.col("l_shipdate").alias("d")))
    return dates.agg(F.min("d").cast("date").alias("lo"), F.max("d").cast("date").alias("hi"))


def _orders_as_loaded(t: Tables, as_loaded: dt.date | None) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    if as_loaded is None:
        return o
    load = F.lit(as_loaded).cast("timestamp_ntz")
    recent = F.col("o_orderdate") >= F.date_sub(F.lit(as_loaded), UNSETTLED_DAYS).cast("timestamp_ntz")
    return (o.filter(F.col("o_orderdate") < load)
             .withColumn("o_orderstatus",
                         F.when(recent & (F.col("o_orderstatus") == "F"), F.lit("P"))
                          .otherwise(F.col("o_orderstatus"))))


def upload_window(month: str) -> Window:
    """Order dates of the applications uploaded in ``month`` (``YYYY-MM``):
    those of the month before, as uploads follow a month's end by three days."""
    from ledgerlens.functions.calendar import month_start
    first = dt.date(int(month[:4]), int(month[5:]), 1)
    return month_start(first, -1), first


def application_mth(t: Tables, as_loaded: dt.date | None = None,
                    window: Window | None = None) -> DataFrame:
    """Applications per facility code x business month.

    ``upload_date`` is three days after the month end, so the computed
    ``year_month`` (upload month) is the month after the business month.
    """
    o = in_window(_orders_as_loaded(t, as_loaded), "o_orderdate", window)
    st = F.col("o_orderstatus")
    amt = money("o_totalprice")

    def cnt(s):
        return F.count(F.when(st == s, F.lit(1))).cast("int")

    def val(s):
        return F.coalesce(F.sum(F.when(st == s, amt)), F.lit(0).cast("decimal(18,2)")).cast("decimal(10,0)")

    g = o.groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("year"),
                  F.month("o_orderdate").alias("month"))
    a = g.agg(cnt("F").alias("accept"), val("F").alias("accept_val"),
              cnt("O").alias("decline"), val("O").alias("decline_val"),
              cnt("P").alias("pending"), val("P").alias("pending_val"),
              F.min(F.substring("o_orderpriority", 1, 1).cast("smallint")).alias("lender_id"))
    month_end = F.last_day(F.make_date("year", "month", F.lit(1)))
    upload = F.date_add(month_end, 3).cast("timestamp_ntz")
    return a.select(
        (F.col("o_custkey") * 100000 + F.col("year") * 12 + F.col("month")).alias("id"),
        F.col("lender_id"),
        _s("o_custkey").alias("facility_code"),
        F.concat(F.lit("Branch "), _s("o_custkey")).alias("upload_legal_name"),
        "accept", "accept_val", "decline", "decline_val", "pending", "pending_val",
        "month", "year",
        upload.alias("upload_date"),
        F.date_format(upload, "yyyy-MM").alias("year_month"),
    )


def paid_mth(t: Tables, as_loaded: dt.date | None = None,
             with_product: bool = False, window: Window | None = None) -> DataFrame:
    """One paid deal per line item. Order and line number are not unique in
    this data, so ``id`` is a digest of the whole row.

    ``commission`` is not in the reference's DDL; reports read it, so it is
    derived as ``advance * return_rate`` rounded to pence.
    """
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    li = in_window(t.lineitem.select(*cols), "l_shipdate", window)
    o = t.orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    advance = money("l_extendedprice").cast("decimal(10,0)")
    rate = F.col("l_discount").cast("decimal(10,4)")
    if as_loaded is not None:
        j = j.filter(F.col("l_shipdate") < F.lit(as_loaded).cast("timestamp_ntz"))
        recent = F.col("l_shipdate") >= F.date_sub(F.lit(as_loaded), UNSETTLED_DAYS).cast("timestamp_ntz")
        # returns not yet processed at load: pre-tax price; zero rate not yet keyed
        advance = F.when(recent & (F.col("l_returnflag") == "R"),
                         (money("l_extendedprice") * (F.lit(1) + money("l_tax"))).cast("decimal(10,0)")
                         ).otherwise(advance)
        rate = F.when(rate == 0, F.lit(None).cast("decimal(10,4)")).otherwise(rate)
    if with_product:
        p = t.part.select("p_partkey", "p_brand")
        j = j.join(p, F.col("l_partkey") == p.p_partkey)
    y = F.year("l_shipdate")
    m = F.month("l_shipdate")
    out = [
        F.conv(F.left(F.md5(F.concat_ws(
            "|", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"), _s(money("l_quantity")),
            _s(money("l_extendedprice")), _s(money("l_discount")), _s(money("l_tax")), "l_returnflag", "l_linestatus",
            F.date_format("l_shipdate", "yyyy-MM-dd")).cast("binary")), F.lit(15)), 16, 10).cast("bigint").alias("id"),
        F.col("l_linenumber").cast("smallint").alias("lender_id"),
        _s("o_custkey").alias("facility_code"),
        F.concat(F.lit("Branch "), _s("o_custkey")).alias("upload_legal_name"),
    ]
    if with_product:
        out.append(F.col("p_brand").alias("product_code"))
    out += [
        F.col("l_quantity").cast("int").alias("defer_by"),
        F.col("l_tax").cast("decimal(18,10)").alias("apr"),
        (F.col("l_linenumber") * 12).alias("term"),
        advance.alias("advance"),
        F.col("l_shipdate").alias("date"),
        rate.alias("return_rate"),
        m.alias("month"), y.alias("year"),
        F.date_add(F.col("l_shipdate").cast("date"), 2).cast("timestamp_ntz").alias("upload_date"),
        year_month_of(y, m).alias("year_month"),
    ]
    df = j.select(*out)
    return df.withColumn("commission",
                         (F.col("advance") * F.coalesce(F.col("return_rate"), F.lit(0))).cast("decimal(18,2)"))


def paid_budget(t: Tables) -> DataFrame:
    """Quarterly budget per facility (nation) x lender (segment) x year."""
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    q = F.quarter("o_orderdate")
    amt = money("o_totalprice")

    def qsum(n):
        return F.coalesce(F.sum(F.when(q == n, amt)), F.lit(0).cast("decimal(18,2)")).cast("decimal(18,2)")

    return (j.groupBy(F.concat(F.lit("U"), _s("c_nationkey")).alias("account_id"),
                      F.col("c_mktsegment").alias("lender"),
                      F.year("o_orderdate").alias("year"))
             .agg(qsum(1).alias("q1"), qsum(2).alias("q2"), qsum(3).alias("q3"), qsum(4).alias("q4")))


def vw_ecof_all(t: Tables, window: Window | None = None) -> DataFrame:
    """One quote (eCOF) document per order; '5-LOW' quotes are cash deals,
    '4-NOT SPECIFIED' have no funding option recorded."""
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = in_window(o, "o_orderdate", window)
    c = t.customer.select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    pr = F.col("o_orderpriority")
    return j.select(
        F.concat(F.lit("E"), _s("o_custkey")).alias("company_key"),
        pr.alias("doc_type"),
        F.col("c_mktsegment").alias("selected_lender"),
        money("o_totalprice").alias("selected_balance"),
        F.when(pr == "5-LOW", "cash").when(pr == "4-NOT SPECIFIED", F.lit(None).cast("string"))
         .otherwise("finance").alias("selected_funding_option"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


def account_ecof(t: Tables) -> DataFrame:
    return t.customer.select(F.concat(F.lit("E"), _s("c_custkey")).alias("ecof_key"),
                             F.concat(F.lit("A"), _s("c_custkey")).alias("account_id"))


# CRM activity codes assigned to event types (fixture rule). 'error' maps
# to a code the label table does not know, so it shows as 'Not Found'.
EVENT_ACTIVITY = {"view": "appointment", "signup": "task", "click": "phonecall",
                  "purchase": "email", "error": "cal_other"}


def crm_user_notification(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    code = F.lit(None).cast("string")
    for k, v in EVENT_ACTIVITY.items():
        code = F.when(F.col("event_type") == k, F.lit(v)).otherwise(code)
    return e.select(
        F.col("user_id").alias("crm_user_id"),
        F.col("ts").alias("scheduled_end"),
        F.when(F.col("event_type") == "purchase", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
         .alias("actual_end"),
        code.alias("activity_type"),
        F.concat(F.col("event_type"), F.lit(" follow-up")).alias("subject"),
        F.when(F.col("value") < 5, F.lit("")).otherwise(F.concat(F.lit("Case "), _s("event_id")))
         .alias("regarding"),
        F.concat(F.lit("crm://activity/"), _s("event_id")).alias("link"),
    )


def crm_user(t: Tables) -> DataFrame:
    u = t.events.select("user_id").distinct()
    return u.select(
        F.col("user_id").alias("crm_user_id"),
        F.concat(F.lit("user"), _s("user_id"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("U"), _s("user_id")).alias("initials"),
        F.concat(F.lit("User "), _s("user_id")).alias("name"),
    )


# --------------------------------------------------------------------------
# upstream feeds (other column names, text values)
# --------------------------------------------------------------------------

def apps_feed(t: Tables, as_loaded: dt.date | None = None) -> DataFrame:
    """Applications as the upstream system delivers them (all text)."""
    a = application_mth(t, as_loaded)
    return a.select(
        _s("id").alias("ID"), _s("lender_id").alias("lenderID"),
        F.col("facility_code").alias("branchNumber"), F.col("upload_legal_name").alias("branchName"),
        _s("accept").alias("Accepts"), _s("accept_val").alias("AcceptsVal"),
        _s("decline").alias("Declines"), _s("decline_val").alias("DeclinesVal"),
        _s("pending").alias("Pending"), _s("pending_val").alias("PendingVal"),
        _s("month").alias("month"), _s("year").alias("year"),
        F.date_format("upload_date", "yyyy-MM-dd HH:mm:ss").alias("importDate"),
    )


def tb_paids_feed(t: Tables, as_loaded: dt.date | None = None) -> DataFrame:
    """Paid deals as the upstream system delivers them (all text)."""
    p = paid_mth(t, as_loaded, with_product=True)
    return p.select(
        _s("id").alias("PK"), _s("lender_id").alias("lenderID"),
        F.col("facility_code").alias("branchNumber"), F.col("upload_legal_name").alias("branchName"),
        F.col("product_code").alias("product"), _s("defer_by").alias("defer"),
        _s("apr").alias("rate"), _s("term").alias("term"), _s("advance").alias("advance"),
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("decDate"),
        _s("return_rate").alias("commPercent"),
        _s("month").alias("month"), _s("year").alias("year"),
        F.date_format("upload_date", "yyyy-MM-dd HH:mm:ss").alias("importDate"),
    )


def application_month_json(t: Tables, since: dt.date | None = None,
                           until: dt.date | None = None) -> DataFrame:
    """JSON payloads for the older ``application_month`` loader.

    One document per order: a JSON array with one element per line item
    (TPC-H orders have at most seven lines, so every document is bounded).
    Lines with return flag 'N' omit the ``pending`` field.
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_returnflag", "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    elem = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        _s("o_custkey").alias("branch_id"),
        F.concat(F.lit("Branch "), _s("o_custkey")).alias("branch_upload_name"),
        _s("l_linenumber").alias("lender_id"),
        _s(F.col("l_quantity").cast("int")).alias("app"),
        _s(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("accept"),
        F.when(F.col("l_returnflag") != "N",
               _s(F.when(F.col("l_returnflag") == "A", 1).otherwise(0))).alias("pending"),
        _s(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("decline"),
        _s(money("l_extendedprice")).alias("advance"),
    )
    return (j.groupBy("o_orderkey")
             .agg(F.to_json(F.sort_array(F.collect_list(elem))).alias("payload")))
