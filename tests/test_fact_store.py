"""Stored facts by month and bucket, months from manifests, the month cube."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import catalog_tables as C
from ledgerlens.plans import funnel as fn
from ledgerlens.plans.stored import StoredInputs
from ledgerlens.session import new_path
from ledgerlens.sources import domain as D
from ledgerlens.sources.fact_store import BucketedTable, MonthCube
from ledgerlens.sources.tables import Tables

P = fn.FunnelParams


@pytest.fixture(scope="module")
def stored(spark, sf_small):
    t, store = C._store(spark, sf_small)
    cube = MonthCube(spark, new_path(spark, "cube"))
    cube.refresh(store, D.account(t))
    return t, store, cube


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("kw", [dict(group="G1"), dict(facility="U7", period="C12M", lender="building"), dict(group="G1", period=None, spine="union"),
                                dict(per_facility=False, period="P12M", budget_agg="max", group_by="quarter")])
@pytest.mark.parametrize("use_cube", [False, True])
def test_stored_reports_equal_those_of_the_tables(spark, sf_small, stored, kw, use_cube):
    t, store, cube = stored
    inp = StoredInputs(store, D.account(t), D.AS_OF, cube if use_cube else None)
    assert (inp.cube is not None) == use_cube
    assert _rows(fn.funnel(inp, P(**kw))) == _rows(fn.funnel(fn.FunnelInputs.from_tables(Tables(spark, sf_small)), P(**kw)))


def test_a_window_reads_its_months_only(spark, stored):
    t, store, _ = stored
    inp = StoredInputs(store, D.account(t), D.AS_OF).windowed(dt.date(1998, 7, 1), dt.date(1998, 9, 1))
    files = inp.paids.inputFiles()
    months = {f.split("year_month=")[1].split("/")[0] for f in files if "year_month=" in f}
    assert months == {"1998-07", "1998-08"}
    plan = _plan(store.read("paids").filter("year_month = '1998-07'"))
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_all_months_plan_no_further_scan_of_the_facts(spark, sf_small, stored):
    t, store, _ = stored
    paths = lambda inp: fn.filtered_moments(inp, P(period=None))._jdf.queryExecution().optimizedPlan().toString()
    assert "advance" not in paths(StoredInputs(store, D.account(t), D.AS_OF))
    got = fn.filtered_moments(StoredInputs(store, D.account(t), D.AS_OF), P(period=None)).inputFiles()
    assert got and all("/manifests/" in f for f in got)
    assert _rows(fn.filtered_moments(StoredInputs(store, D.account(t), D.AS_OF), P(period=None))) == \
        _rows(fn.filtered_moments(fn.FunnelInputs.from_tables(Tables(spark, sf_small)), P(period=None)))


def test_cube_reports_read_the_cube_alone(spark, stored):
    t, store, cube = stored
    r = fn.funnel(StoredInputs(store, D.account(t), D.AS_OF, cube), P(group="G1"))
    assert not [f for f in r.inputFiles() if "/facts-" in f]


def test_an_upsert_makes_the_cube_stale_and_is_seen(spark, sf_small):
    t, store = C._store(spark, sf_small)
    acc, cube = D.account(t), MonthCube(spark, new_path(spark, "cube"))
    cube.refresh(store, acc)
    report = lambda: fn.funnel(StoredInputs(store, acc, D.AS_OF, cube), P(per_facility=False))
    before = {r.moment: r.accept_count for r in report().collect()}
    table = store.tables["applications"]
    some = table.read().filter("year_month = '1999-06' and accept is not null").limit(1)
    done = table.upsert(some.withColumn("accept", F.col("accept") + 1000), ["accept"])
    assert done.rows_updated == 1 and not cube.current(store)
    after = {r.moment: r.accept_count for r in report().collect()}
    assert after["1999-06"] == before["1999-06"] + 1000 and {m: v for m, v in after.items() if m != "1999-06"} == {m: v for m, v in before.items() if m != "1999-06"}
    cube.refresh(store, acc)
    assert cube.current(store) and {r.moment: r.accept_count for r in report().collect()} == after


def test_bucketed_join_needs_no_exchange(spark, sf_small):
    t = Tables(spark, sf_small)
    sides = []
    for name, rows in (("paids", D.paid_mth(t)), ("accounts", D.account(t))):
        path = new_path(spark, name)
        sides.append(BucketedTable(spark, os.path.basename(path).replace("-", "_"), path, buckets=4).write(rows))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = sides[0].read().filter("year_month = '1998-07'").join(sides[1].read(), "facility_code")
        plan = _plan(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "PartitionFilters: [isnotnull(year_month" in plan
        want = D.paid_mth(t).filter("year_month = '1998-07'").join(D.account(t), "facility_code")
        assert j.count() == want.count()
        # named anew, as by a later session
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sides[0].read().schema)
        again = BucketedTable(spark, sides[0].name + "_again", sides[0].path, buckets=4).open(schema)
        assert again.read().count() == D.paid_mth(t).count()
        assert "Exchange" not in _plan(again.read().join(sides[1].read(), "facility_code"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for s in sides:
            s.drop()


def test_tables_are_loaded_side_by_side(spark, monkeypatch):
    import threading
    from ledgerlens.sources.fact_store import NAMES, FactStore
    from ledgerlens.sources.snapshots import SnapshotTable
    replace, meet = SnapshotTable.replace, threading.Barrier(len(NAMES), timeout=60)
    monkeypatch.setattr(SnapshotTable, "replace", lambda self, rows: (meet.wait(), replace(self, rows))[1])
    rows = spark.createDataFrame([(1, 1999, 7), (2, 1999, None), (3, None, 2)], "id long, year int, month int")
    store = FactStore(spark, new_path(spark, "facts"), 1)
    store.load(**dict.fromkeys(NAMES, rows))
    assert store.versions() == dict.fromkeys(NAMES, 0)
    assert sorted(map(tuple, store.read("paids").collect()), key=str) == sorted(
        [(1, 1999, 7, "1999-07"), (2, 1999, None, "1999-null"), (3, None, 2, "null-02")], key=str)
    monkeypatch.undo()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        store.load(applications=rows, paids=rows.withColumn("id", F.expr("id div (id - 2)")))
    assert store.versions() == {"applications": 1, "paids": 0, "quotes": 0, "budgets": 0}


def test_months_are_padded_without_the_formatter(spark):
    rows = [(y, m) for y in (1999, 7, 0, -5, 9999, 12345, None) for m in (1, 12, 0, -3, 99, 100, None)]
    df = spark.createDataFrame(rows, "year int, month int")
    got = df.select(D.year_month_of(F.col("year"), F.col("month")).alias("a"), F.format_string("%04d-%02d", "year", "month").alias("b"))
    assert not got.schema["a"].nullable and got.filter("a <> b or a is null").count() == 0
    store_plan = _plan(df.select(D.year_month_of(F.col("year"), F.col("month"))))
    assert "lpad" in store_plan


def test_paid_deals_are_not_sorted_to_meet_their_accounts(spark, sf_small):
    from ledgerlens.operators import facts
    t, old = Tables(spark, sf_small), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = _rows(facts.paid_facts(D.account(t), D.paid_mth(t), D.AS_OF))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        deals = spark.createDataFrame(D.paid_mth(t).select("facility_code", "date", "advance", "commission", "year", "month").collect())
        got = facts.paid_facts(spark.createDataFrame(D.account(t).collect()), deals, D.AS_OF)
        plan = _plan(got)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert _rows(got) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
