"""Registered queries that write tables and read them back: loads, upserts of touched
parts, summaries kept by deltas, report files. Each derives its tables from the driver
tables, keeps them under the shared folder, and has the check SQL of what they must hold."""

from __future__ import annotations

import datetime as dt

from ledgerlens.plans import funnel as fn
from ledgerlens.plans import oracle_sql as O
from ledgerlens.plans.catalog import (FACILITY, FINISHED, GROUP, LENDER, RECON_CASES, RECON_SQL, STARTED, apps_pair, both_sql, case_reports, paids_pair, prev_month,
                                      register, strip_order)
from ledgerlens.session import new_path, shuffles_removed
from ledgerlens.sources import domain as D
from ledgerlens.sources.snapshots import SnapshotTable
from ledgerlens.sources.tables import Tables

# --------------------------------------------------------------------------
# upserts of touched parts (A7-A11, E14, F10), slices
# --------------------------------------------------------------------------


def _loaded(spark, target, name: str, key: str | None = "id", buckets: int = 1) -> SnapshotTable:
    """A table that holds ``target``."""
    table = SnapshotTable(spark, new_path(spark, name), key, buckets)
    table.replace(target)
    return table


def _table_upsert(prefix, pair, kind, name):
    from ledgerlens.operators.loaders import APPS_CHANGE_COLS, PAIDS_CHANGE_COLS
    cols = APPS_CHANGE_COLS if kind == "apps" else PAIDS_CHANGE_COLS

    def done(spark, sf_dir):
        _, target, staged = pair(spark, sf_dir)
        table = _loaded(spark, target, name)
        return table, table.upsert(staged, cols)

    @register(f"table_{prefix}", f"SELECT * EXCLUDE (_op) FROM ({O.upsert_sql(kind, 'merged', cols, D.FEED_CUTOFF)}) merged")
    def q_rows(spark, sf_dir):
        """The table after the upsert, as a reader sees it."""
        table, _ = done(spark, sf_dir)
        return table.read()

    @register(f"table_{prefix}_counts", O.upsert_sql(kind, name, cols, D.FEED_CUTOFF))
    def q_counts(spark, sf_dir):
        """Counts observed on the upsert's own write; the total is the manifest's."""
        _, r = done(spark, sf_dir)
        return spark.createDataFrame([(name, r.rows_updated, r.rows_inserted, r.rows_total)],
                                     "table_name string, rows_updated bigint, rows_inserted bigint, rows_total bigint")


_table_upsert("upsert_applications", apps_pair, "apps", "application_mth")
_table_upsert("upsert_paids", paids_pair, "paids", "paid_mth")

_OVERLAP = 90


@register("table_replace_slice", O.replace_slice_sql(D.FEED_CUTOFF, _OVERLAP))
def q_table_replace_slice(spark, sf_dir):
    """Payloads are parsed once into a table; the months of their slices are rewritten."""
    from pyspark.sql import functions as F
    from ledgerlens.operators import loaders as L
    t = Tables(spark, sf_dir)
    month = F.date_format("date", "yyyy-MM")
    table = _loaded(spark, L.json_rows(D.application_month_json(t, until=D.FEED_CUTOFF)).withColumn("year_month", month), "application_month", None)
    path = new_path(spark, "payload")
    L.json_rows(D.application_month_json(t, since=D.FEED_CUTOFF - dt.timedelta(days=_OVERLAP))).withColumn("year_month", month).write.parquet(path)
    table.replace_slice(spark.read.parquet(path), ["date", "lender_id"])
    return table.read().drop("year_month")


@register("table_months", "SELECT DISTINCT year_month FROM (" + O.application_mth_sql() + ") a")
def q_table_months(spark, sf_dir):
    """Months of a stored fact table, from its manifest."""
    t = Tables(spark, sf_dir)
    return _loaded(spark, D.application_mth(t), "application_mth", None).months()


# --------------------------------------------------------------------------
# load procedures
# --------------------------------------------------------------------------

class LoadError(RuntimeError):
    """An error of the database that a load meets."""


def _clock():
    """Times of a load that starts at STARTED and ends at FINISHED."""
    first = iter([STARTED])
    return lambda: next(first, FINISHED)


def _load(spark, sf_dir, kind: str, month: str, error: str | None = None, truncate_first: bool = False):
    """Run a month's load into a summary that holds the months of the earlier load."""
    from ledgerlens.functions.calendar import month_start
    from ledgerlens.operators import procedures as P
    from ledgerlens.operators import summaries as S
    t, first = Tables(spark, sf_dir), dt.date(int(month[:4]), int(month[5:]), 1)
    acc = D.account(t)
    if kind == "apps":
        w = D.upload_window(month)
        source, earlier = D.application_mth(t, window=w), S.application_summary(acc, D.application_mth(t, D.FEED_CUTOFF), O.AS_OF, None)
        build, name, phase = lambda m: S.application_summary(acc, source, O.AS_OF, m), "application_mth_summary", None
    else:
        w, codes = (first, month_start(first, 1)), D.lender_product_code(t)
        source = D.paid_mth(t, with_product=True, window=w)
        earlier = S.paid_summary(acc, D.paid_mth(t, D.FEED_CUTOFF, with_product=True, window=w), codes, O.AS_OF, month)
        build, name, phase = lambda m: S.paid_summary(acc, source, codes, O.AS_OF, m), "paid_mth_summary", "FPP"
    target = _loaded(spark, earlier, name, None)
    if error is not None:
        def build(m):  # noqa: F811
            raise LoadError(error)
    log = P.JobLog(spark, new_path(spark, "log_global"), _clock())
    load = P.SummaryLoad(f"set_{name}", name, source, build, target, log, phase)
    try:
        P.run_summary_load(load, month, truncate_first)
    except LoadError:
        pass                                # it is in the log
    return load


def _load_log(name, kind, month, **kw):
    trace = "CASE WHEN logType = 'Error' THEN 'LoadError' END"

    @register(name, f"SELECT *, {trace} AS stackTrace FROM ({O.job_log_sql(kind, month, STARTED, FINISHED, D.FEED_CUTOFF, **kw)}) entries")
    def q(spark, sf_dir):
        return _load(spark, sf_dir, kind, month, **kw).log.read()
    return q


_load_log("load_log", "apps", prev_month())
_load_log("load_log_done", "apps", "1998-06")
_load_log("load_log_no_source", "apps", "2010-01")
_load_log("load_log_truncate", "apps", "1998-06", truncate_first=True)
_load_log("load_log_failed", "apps", prev_month(), error="deadlock")
_load_log("load_log_paid", "paids", prev_month())

_EARLIER = O.application_summary_sql(None, source=f"({O.application_mth_sql(D.FEED_CUTOFF)})")


def _load_rows(name, sql, **kw):
    @register(name, O.with_fixtures(sql))
    def q(spark, sf_dir):
        return _load(spark, sf_dir, "apps", **kw).target.read()
    return q


_load_rows("load_rows", f"{_EARLIER} UNION ALL {O.application_summary_sql(prev_month())}", month=prev_month())
_load_rows("load_rows_truncate", O.application_summary_sql("1998-06"), month="1998-06", truncate_first=True)
_load_rows("load_rows_failed", _EARLIER, month=prev_month(), error="deadlock")


@register("summary_sink_append", O.with_fixtures(
    f"{O.application_summary_sql(prev_month())} UNION ALL {O.application_summary_sql(prev_month())}"))
def q_summary_sink_append(spark, sf_dir):
    """The appending sink: a repeated load repeats its rows."""
    from ledgerlens.operators import summaries as S
    t, path = Tables(spark, sf_dir), new_path(spark, "summary")
    s = S.application_summary(D.account(t), D.application_mth(t, window=D.upload_window(prev_month())), O.AS_OF, prev_month())
    for _ in range(2):
        S.load_summary(s, path, "append")
    return spark.read.schema(s.schema).parquet(path)


# --------------------------------------------------------------------------
# summaries kept by deltas
# --------------------------------------------------------------------------

def _kept_by_deltas(spark, pair, sf_dir, sums, change_cols, name):
    """Stored sums after three batches of a feed, kept by the batches' deltas alone."""
    from pyspark.sql import functions as F
    _, target, staged = pair(spark, sf_dir)
    table = _loaded(spark, target, name)
    stored = _loaded(spark, sums.of(table.read()), f"{name}_sums", None)
    # the feed is derived once; its three batches together are the feed
    path, feed = new_path(spark, f"{name}_feed"), staged.withColumn("_batch", F.pmod(F.col("id"), F.lit(3)).cast("int"))
    with shuffles_removed(spark):
        feed.write.partitionBy("_batch").parquet(path)
    for k in range(3):
        batch = spark.read.schema(feed.schema).parquet(path).filter(F.col("_batch") == k).drop("_batch")
        sums.apply(stored, table.upsert(batch, change_cols, stored=True).changes)
    return stored.read()


@register("summary_incremental", O.with_fixtures(O.application_summary_sql(None)))
def q_summary_incremental(spark, sf_dir):
    """Equal to the summary made anew of all applications."""
    from ledgerlens.operators import deltas
    from ledgerlens.operators.loaders import APPS_CHANGE_COLS
    stored = _kept_by_deltas(spark, apps_pair, sf_dir, deltas.APPLICATIONS, [*APPS_CHANGE_COLS, "year_month"], "application_mth")
    return deltas.application_summary(D.account(Tables(spark, sf_dir)), stored, O.AS_OF)


@register("paid_summary_incremental", O.with_fixtures(O.paid_summary_sql(None), O.PAID_WITH_PRODUCT))
def q_paid_summary_incremental(spark, sf_dir):
    """Equal to the summary made anew of all paid deals."""
    from ledgerlens.operators import deltas
    from ledgerlens.operators.loaders import PAIDS_CHANGE_COLS
    stored, t = _kept_by_deltas(spark, paids_pair, sf_dir, deltas.PAIDS, [*PAIDS_CHANGE_COLS, "year_month"], "paid_mth"), Tables(spark, sf_dir)
    return deltas.paid_summary(D.account(t), stored, D.lender_product_code(t), O.AS_OF)


# --------------------------------------------------------------------------
# facts by month and bucket, month cube
# --------------------------------------------------------------------------

def _store(spark, sf_dir):
    """A store with all facts; quotes by account."""
    from pyspark.sql import functions as F
    from ledgerlens.sources.fact_store import FactStore
    t = Tables(spark, sf_dir)
    store = FactStore(spark, new_path(spark, "facts"), 1)
    quotes = D.vw_ecof_all(t).join(D.account_ecof(t), F.col("company_key") == F.col("ecof_key")).withColumn("company_key", F.col("account_id"))
    store.load(applications=D.application_mth(t), paids=D.paid_mth(t), quotes=quotes.drop("ecof_key", "account_id"), budgets=D.paid_budget(t))
    return t, store


def _stored_funnel(name, cube=False, **kw):
    @register(name, O.funnel_sql(**kw))
    def q(spark, sf_dir):
        from ledgerlens.plans.stored import StoredInputs
        from ledgerlens.sources.fact_store import MonthCube
        t, store = _store(spark, sf_dir)
        made = MonthCube(spark, new_path(spark, "cube")) if cube else None
        if cube:
            made.refresh(store, D.account(t))
        return fn.funnel(StoredInputs(store, D.account(t), O.AS_OF, made), fn.FunnelParams(**kw))
    return q


_stored_funnel("stored_funnel_group", group=GROUP)
_stored_funnel("stored_funnel_all_months", group=GROUP, period=None)
_stored_funnel("cube_funnel_group", cube=True, group=GROUP)
_stored_funnel("cube_funnel_lender", cube=True, facility=FACILITY, lender=LENDER, period=None, group_by="year")


@register("bucketed_paids", O.with_fixtures(
    "SELECT facility_used_by_id, year_month, CAST(sum(advance) AS DECIMAL(18,2)) AS advance, CAST(count(*) AS BIGINT) AS deals "
    "FROM paid_mth JOIN account USING (facility_code) GROUP BY ALL"))
def q_bucketed_paids(spark, sf_dir):
    """Paid deals joined to their accounts, both bucketed by facility code."""
    import os
    from pyspark.sql import functions as F
    from ledgerlens.sources.fact_store import BucketedTable
    t = Tables(spark, sf_dir)
    made = {}
    for name, rows in (("paids", D.paid_mth(t).select("facility_code", "advance", "year_month")), ("accounts", D.account(t).select("facility_code", "facility_used_by_id"))):
        path = new_path(spark, name)
        made[name] = BucketedTable(spark, os.path.basename(path).replace("-", "_"), path, buckets=4).write(rows).read()
    return made["paids"].join(made["accounts"], "facility_code").groupBy("facility_used_by_id", "year_month").agg(
        F.sum("advance").cast("decimal(18,2)").alias("advance"), F.count(F.lit(1)).alias("deals"))


# --------------------------------------------------------------------------
# stored versions of a report
# --------------------------------------------------------------------------

@register("reconcile_stored", RECON_SQL)
def q_reconcile_stored(spark, sf_dir):
    """Two stored versions, compared by digests first."""
    from ledgerlens.operators.reconcile import reconcile_stored
    paths = {x: new_path(spark, "version") for x in (False, True)}
    for x, path in paths.items():
        case_reports(spark, sf_dir, x).write.parquet(path)
    older, latest = (spark.read.parquet(p) for p in paths.values())
    return reconcile_stored(older, latest, ["moment"]).withColumnRenamed("case_id", "test_id")


# --------------------------------------------------------------------------
# report files
# --------------------------------------------------------------------------

@register("report_csv", strip_order(O.funnel_sql(group=GROUP)))
def q_report_csv(spark, sf_dir):
    """A report written as CSV and read again."""
    from ledgerlens.sources.files import read_report_csv, write_report_csv
    report, path = fn.funnel(fn.FunnelInputs.from_tables(Tables(spark, sf_dir)), fn.FunnelParams(group=GROUP)), new_path(spark, "report")
    write_report_csv(report, path)
    return read_report_csv(spark, path, report.schema)


@register("run_case_file", " UNION ALL ".join(f"SELECT {k} AS test_id, * FROM ({both_sql(**c)[1]}) r{k}" for k, c in RECON_CASES.items()))
def q_run_case_file(spark, sf_dir):
    """The cases that a parameter file lists, run in one pass over the facts."""
    from ledgerlens.sources.files import PARAMETER_SCHEMA, read_test_parameters
    names = [f.split()[0] for f in PARAMETER_SCHEMA.split(", ")]
    short = {"facility": "facility_used_by_id", "group": "report_group_id", "lender": "facility_lender"}
    rows = [dict.fromkeys(names) | {"test_id": k, "period": "L12M", "group_by": "year_month"} | {short[a]: v for a, v in c.items()}
            for k, c in RECON_CASES.items()]
    path = new_path(spark, "parameters")
    (spark.createDataFrame([tuple(r[n] for n in names) for r in rows], PARAMETER_SCHEMA)
          .write.option("header", True).option("nullValue", "NULL").csv(path))
    cases = fn.cases_of(read_test_parameters(spark, path))
    return fn.funnel_cases(fn.FunnelInputs.from_tables(Tables(spark, sf_dir)), cases).withColumnRenamed("case_id", "test_id")
