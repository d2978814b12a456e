"""Monthly summary rollups, their load guards, job log and phase flag.

The reference deletes and re-inserts summary months inside a transaction.
Here a summary is a DataFrame; ``load_summary`` writes it. Replacing months
(dynamic partition overwrite on ``year_month``) is the default: re-running a
month replaces just that month, and other months are untouched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SUMMARY_ACCOUNT_COLS = ["facility_used_by_id", "facility_used_by_legal_name",
                        "facility_used_by_trading_style", "facility_used_by_report_group_id",
                        "account_report_group", "facility_used_by_business_manager_email"]


def application_summary(account: DataFrame, application_mth: DataFrame, as_of: dt.date,
                        month: str | None, counts: str = "rows") -> DataFrame:
    """Per facility code x upload month (``month=None``: all months).

    ``accept_count`` is the sum of accepts (the reference selects a column
    outside its GROUP BY); decline/pending counts are ``COUNT(col)`` as
    written there (``counts="rows"``) or, as the names suggest, sums
    (``counts="sum"``).
    """
    counted = {"rows": F.count, "sum": F.sum}[counts]
    a = application_mth
    if month is not None:
        a = a.filter(F.col("year_month") == month)
    pre = a.groupBy("facility_code", "year_month").agg(
        F.sum("accept").alias("accept"),
        F.sum(F.coalesce("accept_val", F.lit(0))).alias("accept_val"),
        counted("decline").alias("decline_n"),
        F.sum(F.coalesce("decline_val", F.lit(0))).alias("decline_val"),
        counted("pending").alias("pending_n"),
        F.sum(F.coalesce("pending_val", F.lit(0))).alias("pending_val"))
    j = pre.join(account.select("facility_code", *SUMMARY_ACCOUNT_COLS), "facility_code")
    g = j.groupBy("facility_code", *SUMMARY_ACCOUNT_COLS, "year_month").agg(
        F.sum("accept").cast("bigint").alias("accept_count"),
        F.sum("accept_val").cast("decimal(18,2)").alias("accept_total"),
        F.sum("decline_n").cast("bigint").alias("decline_count"),
        F.sum("decline_val").cast("decimal(18,2)").alias("decline_total"),
        F.sum("pending_n").cast("bigint").alias("pending_count"),
        F.sum("pending_val").cast("decimal(18,2)").alias("pending_total"))
    return g.select(*SUMMARY_ACCOUNT_COLS, "facility_code", "accept_count", "accept_total",
                    "decline_count", "decline_total", "pending_count", "pending_total", "year_month",
                    F.lit(dt.datetime.combine(as_of, dt.time())).cast("timestamp_ntz").alias("last_updated"))


def paid_summary(account: DataFrame, paid_mth: DataFrame, lender_product_code: DataFrame,
                 as_of: dt.date, month: str) -> DataFrame:
    """Per facility code x product x month, with the product's funding option."""
    p = (paid_mth.filter(F.col("year_month") == month)
         .groupBy("facility_code", "product_code", "year_month")
         .agg(F.count("advance").alias("n"), F.sum("advance").alias("total")))
    j = (p.join(account.select("facility_code", *SUMMARY_ACCOUNT_COLS), "facility_code")
          .join(lender_product_code, "product_code"))
    g = j.groupBy("facility_code", "product_code", *SUMMARY_ACCOUNT_COLS, "funding_option_uc",
                  "year_month").agg(F.sum("n").cast("bigint").alias("advance_count"),
                                    F.sum("total").cast("decimal(18,2)").alias("advance_total"))
    return g.select(*SUMMARY_ACCOUNT_COLS, "facility_code", "product_code", "funding_option_uc",
                    "advance_count", "advance_total", "year_month",
                    F.lit(dt.datetime.combine(as_of, dt.time())).cast("timestamp_ntz").alias("last_updated"))


def _has_month(df: DataFrame, month: str) -> Column:
    """Whether a row of the month exists; reads one row at most."""
    return df.filter(F.col("year_month") == month).limit(1).agg(F.count(F.lit(1))).scalar() > 0


NO_SOURCE, DONE, LOAD = "skip: no source rows for month", "skip: summary already has month", "load"


def summary_gate(source: DataFrame, summary: DataFrame, month: str, truncate_first: bool = False) -> DataFrame:
    """One status row: does the source have the month, is it summarised
    already, and what the loader does (load / skip). A loader that truncates
    first loads whether the summary has the month or not."""
    row = source.sparkSession.range(1).select(
        F.lit(month).alias("year_month"), _has_month(source, month).alias("source_has_month"),
        _has_month(summary, month).alias("summary_has_month"))
    return row.withColumn("action", F.when(~F.col("source_has_month"), NO_SOURCE)
                                     .when(F.col("summary_has_month") & F.lit(not truncate_first), DONE).otherwise(LOAD))


def paid_summary_phase(summary: DataFrame, month: str, product: str = "FPP") -> DataFrame:
    """'first phase' when the month's summary holds the product, else 'second
    phase'; with the month's row count."""
    m = summary.filter(F.col("year_month") == month)
    g = m.agg(F.max(F.when(F.col("product_code") == product, 1).otherwise(0)).alias("has"),
              F.count(F.lit(1)).alias("rows"))
    return g.select(F.lit(month).alias("year_month"),
                    F.when(F.coalesce(F.col("has"), F.lit(0)) == 1, "first phase")
                     .otherwise("second phase").alias("phase"),
                    F.col("rows").cast("bigint").alias("rows_inserted"))


LOG_SCHEMA = ("applicationName string, logType string, message string, dateCreated timestamp_ntz, "
              "day int, month int, year int")


def _log(df: DataFrame, app: str, kind: str, message, now: dt.datetime, day_of_year: bool) -> DataFrame:
    day = now.timetuple().tm_yday if day_of_year else now.day
    return df.select(F.lit(app).alias("applicationName"), F.lit(kind).alias("logType"), message.alias("message"),
                     F.lit(now).cast("timestamp_ntz").alias("dateCreated"),
                     F.lit(day).alias("day"), F.lit(now.month).alias("month"), F.lit(now.year).alias("year"))


def job_log(summary: DataFrame, gate: DataFrame, procedure: str, table: str, month: str, started: dt.datetime,
            finished: dt.datetime, truncate_first: bool = False, phase: DataFrame | None = None,
            error: str | None = None, day_of_year: bool = False) -> DataFrame:
    """Log of a summary load: its start; then either why it skips, or what it
    does and how it ends (row count and whole seconds; with ``phase``, a
    frame from ``paid_summary_phase``, also its phase). With ``error`` the load
    ends with that message. Counts and decisions are Spark's; no row reaches the
    driver. Texts are the fixed wording of the job log."""
    app = f"Database.StoredProcedure.{procedure}"
    seconds = int(finished.replace(microsecond=0).timestamp()) - int(started.replace(microsecond=0).timestamp())
    act = lambda a: gate.filter(F.col("action") == a)
    row = lambda df, kind, text, when=finished: _log(df, app, kind, F.lit(text) if isinstance(text, str) else text, when, day_of_year)
    changed = (f"Table [dbo].[{table}] truncated." if truncate_first else f"Deleted existing data for year_month: {month}")
    parts = [
        row(gate, "Information", f"Execution started at {started:%Y-%m-%d %H:%M:%S}", started),
        row(act(NO_SOURCE), "Warning", f"No source data found for previous month: {month}. Procedure execution canceled."),
        row(act(DONE), "Information", f"Summary data already exists for previous month: {month}"),
        row(act(LOAD), "Information", f"Processing data for previous month: {month}"),
        row(act(LOAD), "Information", changed)]
    if error is not None:
        parts.append(row(act(LOAD), "Error", f"Error occurred: {error}"))
    else:
        done = act(LOAD).withColumn("n", summary.filter(F.col("year_month") == month).agg(F.count(F.lit(1))).scalar())
        tail = f"%d. Execution time: {seconds} seconds"
        if phase is None:
            text = F.format_string(f"{procedure} completed successfully. Rows inserted: {tail}", "n")
        else:
            done = done.withColumn("phase", phase.select("phase").scalar())
            text = F.format_string(f"{procedure} %s completed successfully. Rows inserted for {month}: {tail}", "phase", "n")
        parts.append(row(done, "Success", text))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_log(entries: DataFrame, path: str) -> None:
    """Append entries to the job log table."""
    entries.write.mode("append").parquet(path)


def load_summary(df: DataFrame, path: str, mode: str = "replace_months") -> int:
    """Write a summary and return its number of rows.

    ``replace_months``: the months of ``df`` are replaced, others stay;
    ``truncate_first``: the table holds ``df`` alone; ``append``: rows are added (a
    repeated load then repeats its rows, as in the reference). The count is observed
    on the write, so the plan runs once, and ``df`` may derive from the files replaced."""
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if mode == "replace_months":
        replace_months(df, path)
    elif mode == "truncate_first":
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year_month").parquet(path)
    elif mode == "append":
        df.write.mode("append").partitionBy("year_month").parquet(path)
    else:
        raise ValueError("mode must be replace_months, truncate_first or append")
    return seen.get["rows"]


def replace_months(df: DataFrame, path: str, month_col: str = "year_month") -> None:
    """Idempotent sink: overwrite only the months present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(month_col).parquet(path))
