"""The load procedure, summaries kept by deltas, and writes that run their plan once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import deltas
from ledgerlens.operators import procedures as P
from ledgerlens.operators import summaries as S
from ledgerlens.session import new_path
from ledgerlens.sources.snapshots import SnapshotTable

ROW = "product_code string, n int, year_month string"


def _clock(*seconds):
    times = iter(seconds)
    last = [0]

    def now():
        last[0] = next(times, last[0])
        return dt.datetime(2024, 2, 1, 2, 0, 0) + dt.timedelta(seconds=last[0])
    return now


def _counted(spark, rows):
    """A frame that counts how often its rows are made."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, ROW).mapInArrow(run, ROW), seen


def _job(spark, rows, held=(), product=None, clock=None):
    source = spark.createDataFrame(rows, ROW)
    target = SnapshotTable(spark, new_path(spark, "summary"), None, 2)
    target.replace(spark.createDataFrame(list(held), ROW))
    plan, seen = _counted(spark, rows)
    build = lambda m: plan if m is None else plan.filter(F.col("year_month") == m)
    log = P.JobLog(spark, new_path(spark, "log"), clock or _clock(0, 0, 0, 65))
    return P.SummaryLoad("set_x", "x_summary", source, build, target, log, product), seen


def _log(load):
    return [(r.logType, r.message) for r in load.log.read().orderBy("dateCreated").collect()]


ROWS = [("FPP", 1, "2024-01"), ("HP", 2, "2024-01"), ("HP", 3, "2023-12")]


def test_a_load_runs_its_plan_once_and_counts_its_rows(spark):
    load, seen = _job(spark, ROWS, [("HP", 9, "2023-12")], "FPP")
    done = P.run_summary_load(load, "2024-01")
    assert (done.action, done.rows, done.seconds) == (S.LOAD, 2, 65) and seen.value == len(ROWS)
    assert sorted(map(tuple, load.target.read().collect())) == [("FPP", 1, "2024-01"), ("HP", 2, "2024-01"), ("HP", 9, "2023-12")]
    texts = {t for _, t in _log(load)}
    assert "set_x first phase completed successfully. Rows inserted for 2024-01: 2. Execution time: 65 seconds" in texts
    assert "Deleted existing data for year_month: 2024-01" in texts


def test_gates(spark):
    load, seen = _job(spark, ROWS, [("HP", 9, "2024-01")])
    assert P.run_summary_load(load, "2024-01").action == S.DONE
    assert P.run_summary_load(load, "2020-01").action == S.NO_SOURCE
    assert seen.value == 0 and load.target.versions() == [0]
    assert P.run_summary_load(load, "2024-01", truncate_first=True).rows == 2
    assert load.target.rows_total() == 2
    empty, _ = _job(spark, [])
    assert P.run_summary_load(empty, None).action == S.NO_SOURCE
    assert ("Warning", "No source data found in x table. Procedure execution canceled.") in _log(empty)


def test_all_months_replace_themselves(spark):
    load, _ = _job(spark, ROWS, [("HP", 9, "2020-01")])
    for _ in range(2):
        assert P.run_summary_load(load, None).rows == 3
    assert load.target.rows_total() == 4
    assert ("Information", "Processing ALL available months.") in _log(load)


@pytest.mark.parametrize("truncate", [False, True])
def test_a_failed_load_leaves_the_summary_and_an_entry(spark, truncate):
    load, _ = _job(spark, ROWS, [("HP", 9, "2023-12")])
    broken = lambda m: load.source.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("deadlock")).cast("int")).otherwise(F.col("n")))
    load = P.SummaryLoad("set_x", "x_summary", load.source, broken, load.target, load.log)
    with pytest.raises(Exception, match="deadlock"):
        P.run_summary_load(load, "2024-01", truncate)
    assert [tuple(r) for r in load.target.read().collect()] == [("HP", 9, "2023-12")]
    error = load.log.read().filter("logType = 'Error'").first()
    assert error.message == "Error occurred: deadlock" and error.stackTrace
    # the next run goes through
    again = P.SummaryLoad("set_x", "x_summary", load.source, lambda m: load.source, load.target, load.log)
    assert P.run_summary_load(again, "2024-01", truncate).rows == 3


@pytest.mark.parametrize("mode", ["replace_months", "truncate_first", "append"])
def test_load_summary_runs_its_plan_once(spark, mode):
    plan, seen = _counted(spark, ROWS)
    assert S.load_summary(plan, new_path(spark, "s"), mode) == 3 and seen.value == 3


def test_an_upsert_runs_its_staged_plan_once(spark):
    t = SnapshotTable(spark, new_path(spark, "t"), "n", 2)
    t.replace(spark.createDataFrame(ROWS, ROW))
    plan, seen = _counted(spark, [("HP", 1, "2024-01"), ("HP", 7, "2024-01")])
    done = t.upsert(plan, ["product_code"])
    assert (done.rows_updated, done.rows_inserted, done.rows_total) == (1, 1, 4) and seen.value == 2


APP = "id long, facility_code string, accept int, accept_val int, decline int, decline_val int, pending int, pending_val int, year_month string"


def test_deltas_equal_the_whole_recomputation(spark):
    r = random.Random(3)
    some = lambda hi: r.choice([None, *range(hi)])
    row = lambda i: (i, f"c{r.randint(0, 2)}", some(3), some(9), some(3), some(9), some(3), some(9), r.choice(["2024-01", "2024-02", "2024-03", None]))
    cols = [c.split()[0] for c in APP.split(", ")[1:]]
    table = SnapshotTable(spark, new_path(spark, "apps"), "id", 2)
    table.replace(spark.createDataFrame([row(i) for i in range(25)], APP))
    stored = SnapshotTable(spark, new_path(spark, "sums"), None, 2)
    stored.replace(deltas.APPLICATIONS.of(table.read()))
    rows = lambda df: sorted(map(str, map(tuple, df.select("facility_code", "year_month", *deltas.APPLICATIONS.columns).collect())))
    for k in range(3):
        batch = [row(i) for i in r.sample(range(32), 12)]
        deltas.APPLICATIONS.apply(stored, table.upsert(spark.createDataFrame(batch, APP), cols, null_safe=True).changes)
        assert rows(stored.read()) == rows(deltas.APPLICATIONS.of(table.read()))


def test_a_moved_row_leaves_its_month(spark):
    table = SnapshotTable(spark, new_path(spark, "apps"), "id", 2)
    table.replace(spark.createDataFrame([(1, "c", 1, 10, 0, 0, 0, 0, "2024-01"), (2, "c", 1, 10, 0, 0, 0, 0, "2024-03")], APP))
    stored = SnapshotTable(spark, new_path(spark, "sums"), None, 2)
    stored.replace(deltas.APPLICATIONS.of(table.read()))
    before = {(p.year_month, p.batch) for p in stored.parts().collect()}
    done = table.upsert(spark.createDataFrame([(1, "c", 1, 10, 0, 0, 0, 0, "2024-02")], APP), ["year_month"])
    assert deltas.APPLICATIONS.apply(stored, done.changes) == 1
    after = {(p.year_month, p.batch) for p in stored.parts().collect()}
    assert {m for m, _ in after} == {"2024-02", "2024-03"} and {x for x in before if x[0] == "2024-03"} <= after


def test_a_feed_in_batches_is_derived_once(spark):
    from ledgerlens.plans.catalog_tables import _kept_by_deltas
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = [(i, f"c{i % 4}", 1, i, 0, 0, 0, 0, f"2024-0{1 + i % 3}") for i in range(30)]
    staged = spark.createDataFrame([(i, f, 2, v, *rest) for i, f, _, v, *rest in rows], APP).mapInArrow(through, APP)
    stored = _kept_by_deltas(spark, lambda *_: (None, spark.createDataFrame(rows[:20], APP), staged), None, deltas.APPLICATIONS, ["accept"], "feed")
    assert seen.value == 30
    want = deltas.APPLICATIONS.of(spark.createDataFrame([(i, f, 2, *rest) for i, f, _, *rest in rows], APP))
    assert sorted(map(str, map(tuple, stored.select(want.columns).collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_summaries_of_repeated_accounts_and_codes(spark):
    """Equal rows of accounts or product codes count as often as they are there, by one grouping of the accounts alone."""
    accounts = [("c1", "U1"), ("c1", "U1"), ("c1", "U2"), ("c2", "U1"), (None, "U3")]
    account = spark.createDataFrame([(c, u, "l", None, "G1", "r", "m") for c, u in accounts], ", ".join(f"{c} string" for c in ["facility_code", *S.SUMMARY_ACCOUNT_COLS]))
    codes = spark.createDataFrame([("A", "HP"), ("A", "HP"), ("A", "LOAN"), ("B", None)], "product_code string, funding_option_uc string")
    deals = [("c1", "A", 5, "2024-01"), ("c1", "A", 7, "2024-01"), ("c1", "B", None, None), ("c2", None, 9, "2024-01"), (None, "A", 9, "2024-01")]
    stored = deltas.PAIDS.of(spark.createDataFrame(deals, "facility_code string, product_code string, advance int, year_month string"))
    out = deltas.paid_summary(account, stored, codes, dt.date(2024, 2, 1))
    got = out.select("facility_used_by_id", "facility_code", "product_code", "funding_option_uc", "advance_count", F.col("advance_total").cast("int"), "year_month")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("U1", "c1", "A", "HP", 8, 48, "2024-01"), ("U1", "c1", "A", "LOAN", 4, 24, "2024-01"), ("U2", "c1", "A", "HP", 4, 24, "2024-01"),
        ("U2", "c1", "A", "LOAN", 2, 12, "2024-01"), ("U1", "c1", "B", None, 0, None, None), ("U2", "c1", "B", None, 0, None, None)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3           # stored sums, accounts, codes
