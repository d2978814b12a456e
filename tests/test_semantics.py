"""Hand-built frames for the reference's numeric, null and defect rules."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledgerlens.functions import calendar as C
from ledgerlens.functions import filters as flt
from ledgerlens.functions import measures as M
from ledgerlens.operators import loaders as L
from ledgerlens.operators import reconcile as R


def test_optional_filters_null_handling(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    assert flt.opt_eq(df, "c", None).count() == 3          # keeps NULL
    assert flt.opt_eq_strict(df, "c", None).count() == 2   # COALESCE form drops NULL
    assert flt.opt_eq(df, "c", "a").count() == 1


def test_lender_case_insensitive(spark):
    df = spark.createDataFrame([("BUILDING",), ("building",), ("Auto",)], "facility_lender string")
    assert flt.lender_ci(df, "Building").count() == 2


def test_ratio_truncation_and_rounding(spark):
    df = spark.createDataFrame([(9099, 10000, Decimal("5.00"), 2)], "a int, b int, v decimal(18,2), n int")
    r = df.select(M.pct_int("a", "b").alias("p"), M.ratio("v", "n", "decimal(18,2)").alias("avg"),
                  M.int_div_pct("a", "b").alias("ip"), M.ratio("a", F.lit(0)).alias("z")).first()
    assert r.p == 90            # CAST(x*100.0/y AS INT) truncates: 90.99 -> 90
    assert r.avg == Decimal("2.50")
    assert r.ip == 90
    assert r.z is None          # zero denominator -> NULL, no ANSI error


def test_n0_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("1234567.5"),), (None,)], "x decimal(18,2)")
    got = [r.t for r in df.select(M.money_text("x").alias("t")).collect()]
    assert got == ["£3", "£1,234,568", None]   # '+' with NULL stays NULL


def test_pct2_text(spark):
    df = spark.createDataFrame([(Decimal("0.1235"),)], "x decimal(18,4)")
    assert df.select(M.pct2_text("x")).first()[0] == "12.35%"


def test_change_detection_null_is_not_change(spark):
    t = spark.createDataFrame([(1, None, 5), (2, 3, 5), (3, 1, 1)], "id int, a int, b int")
    s = spark.createDataFrame([(1, 7, 5), (2, 4, 5), (3, 1, 1), (4, 0, 0)], "id int, a int, b int")
    ch = L.upsert_changed(t, s, "id", ["a", "b"]).collect()
    assert [r.id for r in ch] == [2]                     # NULL -> 7 is not a change with <>
    ch2 = L.upsert_changed(t, s, "id", ["a", "b"], null_safe=True).collect()
    assert sorted(r.id for r in ch2) == [1, 2]
    m = L.upsert(t, s, "id", ["a", "b"])
    ops = {r.id: (r._op, r.a) for r in m.collect()}
    assert ops == {1: ("kept", None), 2: ("updated", 4), 3: ("kept", 1), 4: ("inserted", 0)}
    c = L.upsert_counts(m, "x").first()
    assert (c.rows_updated, c.rows_inserted, c.rows_total) == (1, 1, 4)


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, 1), (2, 2)], "id int, a int")
    s = spark.createDataFrame([(2, 5), (3, 3)], "id int, a int")
    once = L.upsert(t, s, "id", ["a"]).drop("_op")
    twice = L.upsert(once, s, "id", ["a"])
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r)[:2] for r in twice.collect())
    assert twice.filter("_op != 'kept'").count() == 0


def test_upsert_repeated_staged_key(spark):
    t = spark.createDataFrame([(1, 1, 0), (2, 2, 0)], "id int, a int, at int")
    s = spark.createDataFrame([(2, 5, 1), (2, 6, 2), (3, 3, 1), (3, 4, 2)], "id int, a int, at int")
    with pytest.raises(Exception, match="staged rows repeat id"):
        L.upsert(t, s, "id", ["a"]).collect()
    got = sorted((r.id, r.a, r._op) for r in L.upsert(t, s, "id", ["a"], latest=["at"]).collect())
    assert got == [(1, 1, "kept"), (2, 6, "updated"), (3, 4, "inserted")]


def test_json_rows_missing_field_and_header(spark):
    docs = spark.createDataFrame(
        [('[{"date":"2024-01-31","branch_id":"7","lender_id":"3","app":"2","accept":"1","decline":"0",'
          '"advance":"10.50"},{"date":"2024-02-29","lender_id":"3"}]',)], "payload string")
    rows = L.json_rows(docs).collect()
    assert len(rows) == 2 and rows[0].pending is None and rows[0].advance == Decimal("10.50")
    h = L.json_header(docs).first()
    assert h.date == dt.date(2024, 1, 31) and h.lender_id == 3


def test_json_bad_header_raises(spark):
    for text in ('[{"branch_id":"7","lender_id":"3"}]', '[{"date":"2024-01-31"}]', "[]"):
        docs = spark.createDataFrame([(text,)], "payload string")
        with pytest.raises(Exception, match="Invalid JSON format"):
            L.json_rows(docs).collect()


def test_replace_slice_named_only(spark):
    t = spark.createDataFrame([("d1", 1, 10), ("d2", 1, 30)], "date string, lender_id int, v int")
    p = spark.createDataFrame([("d1", 1, 99), ("d2", 1, 98)], "date string, lender_id int, v int")
    got = sorted(tuple(r) for r in L.replace_slice(t, p, ["date", "lender_id"], named=p.filter("date = 'd1'")).collect())
    assert got == [("d1", 1, 99), ("d2", 1, 30), ("d2", 1, 98)]


def test_replace_slice(spark):
    t = spark.createDataFrame([("d1", 1, 10), ("d1", 2, 20), ("d2", 1, 30)], "date string, lender_id int, v int")
    p = spark.createDataFrame([("d1", 1, 99)], "date string, lender_id int, v int")
    got = sorted(tuple(r) for r in L.replace_slice(t, p, ["date", "lender_id"]).collect())
    assert got == [("d1", 1, 99), ("d1", 2, 20), ("d2", 1, 30)]


def test_period_month_arithmetic():
    assert C.month_start(dt.date(1999, 7, 15), -12) == dt.date(1998, 7, 1)
    assert C.month_start(dt.date(1999, 1, 15), -1) == dt.date(1998, 12, 1)
    assert C.previous_month_key(dt.date(1999, 1, 3)) == "1998-12"


def test_grain_validation():
    import pytest
    with pytest.raises(ValueError):
        C.check_grain("week")
    from ledgerlens.plans.funnel import FunnelParams
    with pytest.raises(ValueError):
        FunnelParams(period="L6M").validate()


def test_reconcile_self_is_match(spark):
    df = spark.createDataFrame([("r", "2024-01", Decimal("1.5"), None, Decimal("2"), Decimal("0.5"))],
                               "report_name string, moment string, budget decimal(18,2), "
                               "budget_rate decimal(18,6), advance_val decimal(18,2), accept_rate decimal(18,6)")
    s = R.reconcile_summary(df, df).first()
    assert s.verdict == "MATCH" and s.value_diffs == 0
    other = df.withColumn("budget", F.lit(Decimal("3.0")).cast("decimal(18,2)"))
    assert R.reconcile_summary(df, other).first().verdict == "DIFF"
    rows = R.reconcile_rows(df, other).collect()
    assert len(rows) == 1 and rows[0].metric == "budget" and rows[0].percent_change == Decimal("100.00")


def test_activity_labels(spark):
    df = spark.createDataFrame([("phonecall",), ("zzz",)], "t string")
    assert [r[0] for r in df.select(flt.activity_label("t")).collect()] == ["Phone Call", "Not Found"]


def test_summary_sink_replaces_only_given_months(spark, tmp_path):
    from ledgerlens.operators.summaries import replace_months
    from ledgerlens.session import scratch_path
    path = scratch_path(spark, f"summary-{uuid.uuid4().hex}")
    a = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "year_month string, n int")
    replace_months(a, path)
    replace_months(spark.createDataFrame([("2024-02", 5)], "year_month string, n int"), path)
    got = sorted((r.year_month, r.n) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01", 1), ("2024-02", 5)]


def test_reconcile_sees_every_column(spark):
    cols = "report_name string, moment string, ecof_count bigint, budget decimal(18,2)"
    a = spark.createDataFrame([("r", "2024-01", 5, Decimal("1.00"))], cols)
    b = spark.createDataFrame([("r", "2024-01", 99, Decimal("1.00"))], cols)
    s = R.reconcile_summary(a, b).first()
    assert (s.verdict, s.value_diffs, s.other_diffs) == ("DIFF", 0, 1)
    s = R.reconcile_summary(a, a.drop("ecof_count").withColumn("more", F.lit(1))).first()
    assert (s.verdict, s.missing_columns, s.extra_columns) == ("DIFF", "ecof_count", "more")
    got = sorted((r.ecof_count, r.source) for r in R.reconcile_except(a, b).collect())
    assert got == [(5, "baseline"), (99, "comparison")]
    assert R.reconcile_except(a.union(a), a).count() == 1      # how often a row stands counts


def test_months_follow_from_the_as_of_date(spark):
    later = dt.date(2002, 6, 15)
    for period, first in (("L12M", "2001-06"), ("P12M", "2000-06"), ("C12M", "2002-01"), ("ROLLING", "2001-06")):
        months = C.month_list(*C.period_bounds(period, later))
        assert len(months) == 12 and months[0][0] == first
        frame = sorted(tuple(r) for r in C.months_frame(spark, *C.period_bounds(period, later)).collect())
        assert frame == months
    assert C.month_list(*C.period_bounds("LAST4Y", later))[0][0] == "1999-01"
    days = C.calendar_days(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).collect()
    assert [str(r.date) for r in days] == ["2024-02-28", "2024-02-29", "2024-03-01"] and days[0].year_quarter == "2024-1"


def _small_tables(spark, path, years):
    """Driver-shaped tables: two customers of one nation; an order with a line a year."""
    ts = lambda y, m=3: dt.datetime(y, m, 5)
    rows = {
        "region": ([(1, "R1")], "r_regionkey bigint, r_name string"),
        "nation": ([(7, "N7", 1)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "customer": ([(1, "C1", 7, "BUILDING"), (2, "C2", 7, "MACHINERY")],
                     "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string"),
        "orders": ([(10 * y + c, c, "F" if c == 1 else "O", 100.0 * c, ts(y), "1-URGENT") for y in years for c in (1, 2)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(10 * y + c, 5, 6, 1, 3.0, 50.0 * c, 0.1, 0.0, "N", "O", ts(y)) for y in years for c in (1, 2)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.mode("append" if name in ("orders", "lineitem") else "overwrite").parquet(f"{path}/{name}.parquet")


def test_months_that_arrive_later_are_seen(spark, tmp_path):
    from ledgerlens.plans import funnel as fn
    from ledgerlens.sources.tables import Tables
    p = fn.FunnelParams(group="G1", period=None, per_facility=False)
    run = lambda: [r.moment for r in fn.funnel(fn.FunnelInputs.from_tables(Tables(spark, str(tmp_path))), p).collect()]
    _small_tables(spark, str(tmp_path), [1997])
    assert run() == ["1997-03"]
    _small_tables(spark, str(tmp_path), [1998, 2004])
    assert run() == ["1997-03", "1998-03", "2004-03"]


def test_quotes_ignore_the_lender_in_text_and_period_reports(spark, tmp_path):
    from ledgerlens.plans import ecof, funnel as fn
    from ledgerlens.sources.tables import Tables
    _small_tables(spark, str(tmp_path), [1999])
    inp = fn.FunnelInputs.from_tables(Tables(spark, str(tmp_path)))
    p = fn.FunnelParams(facility="U7", lender="building", per_facility=False)
    pick = lambda df, key: {r[key]: r for r in df.collect()}["1999-03"]
    text, period = pick(fn.funnel_text(inp, p), "group_by"), pick(ecof.ecof_period(inp, p), "year_month")
    numeric = pick(fn.funnel(inp, p), "moment")
    assert (text.ecof_count, period.ecof_count, numeric.ecof_count) == (2, 2, 1)
    assert (text.accept_count, period.accept_rate_text, period.ecof_advance_text) == (1, "100%", "£300")
    mapped = {r.group_by: r for r in ecof.funnel_mapped(inp, fn.FunnelParams(group="G1", group_by="quarter")).collect()}
    assert mapped["1"].ecof_count == 2 and mapped["1"].accept_rate == Decimal("0.5000") and mapped["2"].ecof_count is None
    days = ecof.funnel_mapped(inp, fn.FunnelParams(group="G1", group_by="quarter"), compat_days=(dt.date(1999, 1, 1), dt.date(1999, 12, 31)))
    assert {r.group_by: r.ecof_count for r in days.collect()}["1"] == 2 * 31      # March has 31 days (D2)


def test_cases_at_once_equal_single_reports(spark, tmp_path):
    from ledgerlens.plans import funnel as fn
    from ledgerlens.sources.tables import Tables
    _small_tables(spark, str(tmp_path), [1998, 1999])
    inp = fn.FunnelInputs.from_tables(Tables(spark, str(tmp_path)))
    cases = {1: fn.FunnelParams(group="G1"), 2: fn.FunnelParams(facility="U7", lender="machinery", period="P12M", group_by="quarter"),
             3: fn.FunnelParams(group="G99", drop_empty=False), 4: fn.FunnelParams(budget_agg="max", lender_on_ecof=False, lender="building")}
    both = fn.funnel_cases(inp, cases)
    for k, p in cases.items():
        one = sorted(map(str, (tuple(r) for r in fn.funnel(inp, p).collect())))
        assert sorted(map(str, (tuple(r)[1:] for r in both.filter(F.col("case_id") == k).collect()))) == one and one
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("lineitem.parquet")
    assert both is not None and scans(both) == scans(fn.funnel_cases(inp, {1: cases[1]}))


def test_placeholder_of_an_unknown_group(spark, tmp_path):
    from ledgerlens.plans import funnel as fn
    from ledgerlens.sources.tables import Tables
    _small_tables(spark, str(tmp_path), [1999])
    inp = fn.FunnelInputs.from_tables(Tables(spark, str(tmp_path)))
    rows = fn.funnel(inp, fn.FunnelParams(group="G99", drop_empty=False)).collect()
    assert len(rows) == 12 and {r.report_name for r in rows} == {"Unknown Group : All"}
    assert fn.funnel(inp, fn.FunnelParams(group="G99")).count() == 0


def test_summary_sink_modes_and_log(spark, tmp_path):
    from ledgerlens.operators import summaries as S
    path, log = str(tmp_path / "summary"), str(tmp_path / "log")
    df = lambda *rows: spark.createDataFrame(rows, "year_month string, n int")
    read = lambda: sorted((r.year_month, r.n) for r in spark.read.parquet(path).collect())
    assert S.load_summary(df(("2024-01", 1), ("2024-02", 2)), path, "truncate_first") == 2
    S.load_summary(df(("2024-02", 5)), path)
    assert read() == [("2024-01", 1), ("2024-02", 5)]
    S.load_summary(df(("2024-02", 6)), path, "append")
    assert read() == [("2024-01", 1), ("2024-02", 5), ("2024-02", 6)]
    S.load_summary(df(("2024-03", 7)), path, "truncate_first")
    assert read() == [("2024-03", 7)]
    with pytest.raises(ValueError):
        S.load_summary(df(("2024-03", 7)), path, "other")
    now = dt.datetime(2024, 4, 1, 3)
    gate = S.summary_gate(df(("2024-03", 1)), df(("2024-02", 1)), "2024-03")
    rows = S.job_log(df(("2024-03", 1), ("2024-03", 2)), gate, "p", "t", "2024-03", now, now + dt.timedelta(seconds=61.5))
    S.append_log(rows, log)
    S.append_log(S.job_log(df(), gate, "p", "t", "2024-03", now, now, error="boom"), log)
    said = [r.message for r in spark.read.parquet(log).collect()]
    assert "p completed successfully. Rows inserted: 2. Execution time: 61 seconds" in said and "Error occurred: boom" in said


def test_month_windows_reach_the_scans(spark, sf_small):
    import re
    from ledgerlens.plans.catalog import QUERIES
    for name in ("funnel_group_facilities", "rolling_12m", "monthly_applications_l12m", "monthly_period_l12m", "application_summary",
                 "paid_summary", "lender_conversion", "distinct_aggs", "step_applications", "step_paids", "ecof_period", "moment_l12m"):
        plan = QUERIES[name][0](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet \[[^\]]*(?:o_orderdate|l_shipdate)[^\n]*", plan)
        assert scans, name
        for s in scans:
            if "o_totalprice" in s and name in ("funnel_group_facilities",) and "GreaterThanOrEqual" not in s:
                continue  # budgets are sums over whole years
            assert "LessThan(" in s and "GreaterThanOrEqual(" in s, (name, s[:300])


def test_paid_facts_count_equal_accounts_once_each_without_a_second_grouping(spark):
    """Equal account rows multiply a month's sums; deals are not grouped again by all account columns."""
    from ledgerlens.operators import facts as X
    D = Decimal
    acc = [("A1", "U1", "BM", "G1", "r", "n", None, "x", "1"), ("A1", "U1", "BM", "G1", "r", "n", None, "x", "1"),
           ("A1", "U2", "BM", "G1", "r", "n", "t", "x", "1"), ("A2", None, "BM", "G1", "r", "n", "t", "x", "2"), ("A3", "U3", "BM", "G1", "r", "n", "t", "x", None)]
    account = spark.createDataFrame(acc, ", ".join(f"{c} string" for c in X.ACCOUNT_KEYS))
    day = dt.datetime(1999, 2, 3)
    deals = [("1", day, 1999, 2, D(5), D("0.50")), ("1", day, 1999, 2, None, D("0.25")), ("2", day, 1999, 3, None, None), (None, day, 1999, 2, D(7), D(1)),
             ("1", dt.datetime(1995, 1, 1), 1995, 1, D(9), D(1))]
    paid = spark.createDataFrame(deals, "facility_code string, date timestamp_ntz, year int, month int, advance decimal(10,0), commission decimal(18,2)")
    got = X.paid_facts(account, paid, dt.date(1999, 7, 15))
    rows = sorted(tuple(r) for r in got.select("account_id", F.coalesce("facility_used_by_id", F.lit("")), "advance", "advance_count", "commission", "year_month").collect())
    assert rows == [("A1", "U1", D("10.00"), 2, D("1.50"), "1999-02"), ("A1", "U2", D("5.00"), 1, D("0.75"), "1999-02"), ("A2", "", None, 0, None, "1999-03")]
    assert [f.dataType.simpleString() for f in got.schema[9:12]] == ["decimal(18,2)", "bigint", "decimal(18,2)"]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Aggregate" in x and "account_id" in x and "year" in x]
