"""Documented defects and their switches, on hand-built facts with results
worked out by hand (no derived tables, no check SQL)."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerlens.plans import conversion, ecof, funnel as fn, monthly
from ledgerlens.operators import summaries as S

AS_OF = dt.date(2024, 4, 10)          # L12M: 2023-04 .. 2024-03
ACCOUNT = ("account_id string, facility_code string, facility_lender string, facility_used_by_id string, facility_used_by_legal_name string, "
           "facility_used_by_trading_style string, facility_used_by_report_group_id string, facility_used_by_report_group string, "
           "facility_used_by_business_manager_email string, account_report_group string, legal_name string, trading_style string, is_reporting boolean")


@pytest.fixture(scope="module")
def inp(spark):
    def acc(code, lender, facility, name, group):
        return (f"A{code}", code, lender, facility, name, f"{name} T", group, f"Group {group}", "bm@x", f"Group {group}", name, f"{name} T", True)

    account = spark.createDataFrame([acc("1", "ALPHA", "U1", "One", "G1"), acc("2", "Beta", "U1", "One", "G1"),
                                     acc("3", "ALPHA", "U2", "Two", "G1"), acc("4", "ALPHA", "U3", "Three", "G2")], ACCOUNT)
    place = {"1": ("U1", "G1", "ALPHA"), "2": ("U1", "G1", "Beta"), "3": ("U2", "G1", "ALPHA"), "4": ("U3", "G2", "ALPHA")}
    key = "facility_used_by_id string, facility_used_by_report_group_id string, facility_lender string, year_month string"
    apps = spark.createDataFrame([(*place[c], ym, a, d, p, D(v)) for c, ym, a, d, p, v in (
        ("1", "2023-05", 3, 1, 2, "300"), ("2", "2023-05", 1, 1, 0, "50"), ("3", "2023-05", 2, 0, 0, "80"), ("1", "2023-06", 4, 0, 0, "500"),
        ("1", "2023-12", 1, 0, 0, "10"), ("1", "2024-02", 5, 5, 0, "700"), ("4", "2024-02", 9, 0, 0, "900"), ("1", "2022-06", 7, 0, 0, "70"))],
        key + ", accept int, decline int, pending int, accept_val decimal(18,2)")
    paids = spark.createDataFrame([(*place[c], ym, D(a), n, D(k)) for c, ym, a, n, k in (
        ("1", "2023-05", "100", 2, "10"), ("1", "2023-06", "300", 3, "60"), ("3", "2023-05", "40", 1, "4"), ("1", "2023-07", "999", 9, "9"))],
        key + ", advance decimal(18,2), advance_count bigint, commission decimal(18,2)")
    quotes = spark.createDataFrame([(*place[c], ym, n, D(v)) for c, ym, n, v in (
        ("1", "2023-05", 5, "500"), ("2", "2023-05", 7, "70"), ("1", "2022-06", 2, "20"))],
        key.replace("facility_used_by_report_group_id", "report_group_id") + ", ecof_count bigint, ecof_advance decimal(18,2)")
    budget = spark.createDataFrame([(*place[c], ym, D(b)) for c, ym, b in (
        ("1", "2023-05", "200"), ("2", "2023-05", "50"), ("1", "2023-06", "400"))], key + ", budget decimal(18,6)")
    return fn.FunnelInputs(spark, account, apps, paids, quotes, budget, as_of=AS_OF)


def run(inp, **kw):
    rows = fn.funnel(inp, fn.FunnelParams(as_of=AS_OF, **kw)).collect()
    return {(r.report_name, r.moment): r for r in rows}


def one(inp, moment, **kw):
    return next(r for (_, m), r in run(inp, per_facility=False, **kw).items() if m == moment)


def test_d1_fanout(inp):
    assert one(inp, "2023", facility="U1", group_by="year").accept_count == 9             # May 4, June 4, December 1
    r = one(inp, "2023", facility="U1", group_by="year", compat_fanout=True)
    assert (r.accept_count, r.accept_rate) == (9 * 9, D("0.818182"))                       # nine months of 2023 share the year


def test_d2_d19_mapped(inp):
    p = fn.FunnelParams(facility="U1", group_by="month", as_of=AS_OF)
    pick = lambda **kw: {r.group_by: r for r in ecof.funnel_mapped(inp, p, **kw).collect()}
    assert pick()["6"].accept_count == 4 and pick()["5"].ecof_count == 12
    assert pick(compat_widen=True)["6"].accept_count == 11                                  # June 2022 comes in
    assert pick(compat_days=(dt.date(2023, 1, 1), dt.date(2024, 12, 31)))["5"].ecof_count == 12 * 31


def test_d6_no_facility_means_all(inp):
    r = one(inp, "2024-02")
    assert (r.report_name, r.accept_count, r.decline_count) == ("Consumer Credit Solutions : All", 14, 5)


def test_d7_spine(inp):
    assert one(inp, "2023-07", facility="U1").advance_val is None                           # paid deals, no applications
    assert one(inp, "2023-07", facility="U1", spine="union").advance_val == D("999.00")


def test_d8_counts(spark, inp):
    cols = "facility_code string, year_month string, accept int, accept_val int, decline int, decline_val int, pending int, pending_val int"
    apps = spark.createDataFrame([("1", "2024-03", 3, 30, 4, 40, None, None), ("1", "2024-03", 2, None, 6, 60, 5, 50)], cols)
    rows, sums = (S.application_summary(inp.account, apps, AS_OF, "2024-03", counts=c).first() for c in ("rows", "sum"))
    assert (rows.accept_count, rows.accept_total, rows.decline_count, rows.pending_count) == (5, D(30), 2, 1)
    assert (sums.decline_count, sums.decline_total, sums.pending_count) == (10, D(100), 5)


def test_d9_totals(inp):
    pick = lambda **kw: {r.year_month: r for r in monthly.rolling_12m(inp, AS_OF, facility="U1", **kw).collect()}
    total = pick()["TOTAL"]
    assert (total.accept, total.proposed, total.accept_rate, total.advance, total.advance_average) == (14, 21, "66%", "£1,399", "£100")
    assert pick()["2024-02"].accept_rate == "50%" and len(pick()) == 13
    assert "TOTAL" not in pick(totals=False)
    ghost = pick(totals=False, compat_totals=True)["TOTAL"]
    assert ghost.report_name is None and ghost.accept is None


def test_d13_budget(inp):
    assert one(inp, "2023-05", facility="U1").budget == D("250.00")
    assert one(inp, "2023-05", facility="U1", budget_agg="max").budget == D("200.00")


def test_d18_group_and_facility(inp):
    got = run(inp, group="G1")
    assert {n for n, _ in got} == {"One T : All", "Two T : All"} and len(got) == 5          # empty months are dropped
    assert got["Two T : All", "2023-05"].accept_count == 2
    assert {n for n, _ in run(inp, group="G1", facility="U2")} == {"Two T : All"}


def test_d20_numeric_order(inp):
    months = [r.moment for r in fn.funnel(inp, fn.FunnelParams(as_of=AS_OF, group_by="month", per_facility=False)).collect()]
    assert months == [str(m) for m in range(1, 13)]


def test_x3_quarter_labels_and_x11_lender_case(inp):
    r = one(inp, "2023-2", facility="U1", group_by="year_quarter", lender="beta")
    assert (r.accept_count, r.ecof_count, r.report_name) == (1, 7, "One : beta")
    assert one(inp, "2023-05", facility="U1", lender="BETA", lender_on_ecof=False).ecof_count == 12


def test_x6_x7_x8_ratios(inp):
    r = one(inp, "2023-05", facility="U1")
    assert (r.accept_avg, r.accept_rate, r.advance_avg, r.commission_rate_avg, r.budget_rate) == (
        D("87.50"), D("0.666667"), D("50.00"), D("0.1000"), D("0.400000"))
    assert one(inp, "2023-12", facility="U1").advance_avg is None


def test_d3_d4_conversion(spark, inp):
    apps = spark.createDataFrame([("1", 2024, 2, 1, 2, 5, 0), ("3", 2024, 2, 1, 2, 5, 3)],
                                 "facility_code string, year int, month int, decline int, accept int, accept_val int, pending int")
    more = inp.account.union(inp.account.filter("facility_code = '1'").withColumn("facility_code", inp.account.account_id))
    apps = apps.union(spark.createDataFrame([("A1", 2024, 2, 1, 2, 5, 0)], apps.schema))      # a code with the same numbers
    paid = spark.createDataFrame([("1", 2024, 2, 10, 70), ("1", 2024, 2, 11, 70), ("1", 2024, 2, 11, 70)],
                                 "facility_code string, year int, month int, id int, advance int")
    pick = lambda compat: next(r for r in conversion.lender_conversion(more, apps, paid, ["2024-02"], "U1", compat).collect()
                               if r.facility_lender == "ALPHA")
    r, c = pick(False), pick(True)
    assert (r.accept, r.advance_total, r.advance_count, r.conversion, r.conversion_text) == (4, D("140.00"), 2, 33.0, "33%")
    assert (c.accept, c.advance_total, c.advance_count, c.accept_rate) == (2, D("70.00"), 2, "67%")
    none = next(r for r in conversion.lender_conversion(more, apps, paid, ["2024-02"], "U1").collect() if r.facility_lender == "Beta")
    assert (none.proposed_text, none.conversion, none.conversion_text) == ("0", 0.0, "N/A")
    two = conversion.lender_conversion(more, apps, paid, ["2024-02"], "U2").first()
    assert two.proposed_text == "3 (+3 Ref)"
