"""Many cases in one pass against case by case; versions compared by digests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import reconcile as R
from ledgerlens.plans import funnel as fn
from ledgerlens.sources.tables import Tables

CASES = {
    1: dict(group="G1"), 2: dict(group="G1", per_facility=False), 3: dict(facility="U7"), 4: dict(facility="U7", group="G1"),
    5: dict(facility="U7", group="G3"), 6: dict(group="G99"), 7: dict(group="G99", drop_empty=False), 8: dict(),
    9: dict(facility="U99", per_facility=False), 10: dict(group="G1", period=None, group_by="year"),
    11: dict(group="G1", lender="building", period=None, spine="union"), 12: dict(group="G1", group_by="quarter", compat_fanout=True),
    13: dict(facility="U7", include_budget=False, period="P12M"), 14: dict(group="G1", per_facility=False, period="C12M", budget_agg="max"),
    15: dict(facility="U7", lender="machinery", lender_on_ecof=False, group_by="year_quarter"),
}


def _rows(df, drop=()):
    cols = [c for c in sorted(df.columns) if c not in drop]
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("ids", [list(CASES), [1, 3], [13], [8]])
def test_cases_equal_their_reports(spark, sf_small, ids):
    inp = lambda: fn.FunnelInputs.from_tables(Tables(spark, sf_small))
    cases = {k: fn.FunnelParams(**CASES[k]) for k in ids}
    got = fn.funnel_cases(inp(), cases).persist()
    for k, p in cases.items():
        mine, want = got.filter(F.col("case_id") == k).drop("case_id"), fn.funnel(inp(), p)
        if not p.include_budget:
            assert mine.filter("budget is not null or budget_rate is not null").count() == 0
        assert _rows(mine, () if p.include_budget else ("budget", "budget_rate")) == _rows(want), (k, CASES[k])
    got.unpersist()


def test_facts_are_scanned_once_whatever_the_number_of_cases(spark, sf_small):
    plans = []
    for n in (1, 6):
        cases = {k: fn.FunnelParams(group="G1" if k % 2 else None, facility=None if k % 2 else f"U{k}") for k in range(n)}
        df = fn.funnel_cases(fn.FunnelInputs.from_tables(Tables(spark, sf_small)), cases)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    assert [p.count("lineitem") for p in plans][0] == [p.count("lineitem") for p in plans][1]
    assert plans[0].count("Relation") == plans[1].count("Relation")


ROW = "case_id int, report_name string, moment string, a decimal(18,2), budget decimal(18,2)"


def _report(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(c, n, m, *(None if v is None else Decimal(v) for v in vs)) for c, n, m, *vs in rows], ROW)


BASE = [(c, f"n{n}", f"2024-{m:02d}", c + n + m, None if m == 3 else m) for c in (1, 2) for n in range(3) for m in range(1, 7)]


def test_stored_versions_by_digests(spark):
    old = _report(spark, BASE)
    new = [(*r[:3], 99, r[4]) if r[:3] == (1, "n0", "2024-02") else (*r[:4], 7) if r[:3] == (2, "n1", "2024-03") else r for r in BASE]
    new = _report(spark, [r for r in new if r[:3] != (2, "n2", "2024-05")])
    assert sorted(map(tuple, R.months_that_differ(old, new, ["case_id", "moment"]).collect())) == [(1, "2024-02"), (2, "2024-03"), (2, "2024-05")]
    for a, b in ((old, new), (new, old), (old, old), (old, new.drop("a")), (new.filter("false"), old)):
        assert _rows(R.reconcile_stored(a, b, ["moment"])) == _rows(R.reconcile_cases(a, b))


def test_equal_versions_are_not_compared_cell_by_cell(spark):
    plan = lambda a, b: R.reconcile_stored(a, b, ["moment"])._jdf.queryExecution().optimizedPlan().toString()
    old = _report(spark, BASE)
    assert "a_budget" not in plan(old, _report(spark, BASE[::-1])) and "a_budget" in plan(old, _report(spark, BASE[1:]))


def test_digests_see_order_of_columns_and_repeats(spark):
    one, two = spark.createDataFrame([("m", 1, 2)], "k string, a int, b int"), spark.createDataFrame([("m", 2, 1)], "k string, a int, b int")
    assert R.months_that_differ(one, two, ["k"]).count() == 1
    assert R.months_that_differ(one, one.union(one), ["k"]).count() == 1
    assert R.months_that_differ(one.union(two), two.union(one), ["k"]).count() == 0


def test_except_counts_repeats_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (3, "y")], "n int, s string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, None)], "n int, s string")
    got = sorted(map(tuple, R.reconcile_except(a, b).collect()), key=str)
    want = a.exceptAll(b).withColumn("source", F.lit("baseline")).union(b.exceptAll(a).withColumn("source", F.lit("comparison")))
    assert got == sorted(map(tuple, want.collect()), key=str)
    plan = R.reconcile_except(a, b)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2
