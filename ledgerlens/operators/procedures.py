"""A summary load as one procedure: gate, write, count, log.

``run_summary_load`` takes the steps of the nightly job in order: it notes its start,
asks whether the source has the month and the summary has it already, then skips or
replaces the month (or the whole table), counts the rows as they are written, measures
the time and notes how it ended. A load that fails leaves the summary as it was, notes
the error and raises it again.

The summary is a ``SnapshotTable``: what it holds is known from its manifest, and a
write is seen whole or not at all. Log entries are appended before and after the write, so
a load that dies with its driver has left its start.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.summaries import DONE, LOAD, LOG_SCHEMA, NO_SOURCE
from ledgerlens.sources.snapshots import MONTH, SnapshotTable


class JobLog:
    """Append-only table of log entries. ``clock`` gives the time of an entry;
    ``day_of_year``: how the column ``day`` counts."""

    SCHEMA = LOG_SCHEMA + ", stackTrace string"

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], dt.datetime] = dt.datetime.now, day_of_year: bool = False):
        self.spark, self.path, self.clock, self.day_of_year = spark, path, clock, day_of_year

    def append(self, application: str, entries: list[tuple[str, str, dt.datetime, str | None]]) -> None:
        """Entries (kind, message, time, stack trace) of one application."""
        rows = [(application, kind, text, at, at.timetuple().tm_yday if self.day_of_year else at.day, at.month, at.year, trace)
                for kind, text, at, trace in entries]
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)


@dataclasses.dataclass(frozen=True)
class SummaryLoad:
    """What a procedure loads. ``build(month)`` plans the summary of a month (None: of all);
    ``source`` has a column ``year_month``; ``phase_product``: the product whose rows make it
    the first phase (None: the job has no phases)."""
    procedure: str
    table: str
    source: DataFrame
    build: Callable[[str | None], DataFrame]
    target: SnapshotTable
    log: JobLog
    phase_product: str | None = None


@dataclasses.dataclass(frozen=True)
class LoadResult:
    action: str
    rows: int
    seconds: int


def error_text(e: Exception) -> str:
    """An error's own words: the message that a plan raised, or the first line."""
    if isinstance(e, PySparkException):
        try:
            raised = (e.getMessageParameters() or {}).get("errorMessage")
        except Exception:  # a message without parameters
            raised = None
        if raised:
            return raised
    return (str(e).splitlines() or [type(e).__name__])[0]


def run_summary_load(load: SummaryLoad, month: str | None, truncate_first: bool = False) -> LoadResult:
    """Run the load of a month (``YYYY-MM``), or of all months (None). Texts are the
    fixed wording of the job log."""
    clock, started = load.log.clock, load.log.clock()
    app = f"Database.StoredProcedure.{load.procedure}"
    note = lambda kind, text, at=None, trace=None: (kind, text, at or clock(), trace)
    notes = [note("Information", f"Execution started at {started:%Y-%m-%d %H:%M:%S}", started)]
    own = load.source if month is None else load.source.filter(F.col(MONTH) == month)
    if own.limit(1).isEmpty():
        text = (f"No source data found in {load.table.removesuffix('_summary')} table. Procedure execution canceled." if month is None
                else f"No source data found for previous month: {month}. Procedure execution canceled.")
        load.log.append(app, [*notes, note("Warning", text)])
        return LoadResult(NO_SOURCE, 0, 0)
    if month is not None and not truncate_first and not load.target.months().filter(F.col(MONTH) == month).isEmpty():
        load.log.append(app, [*notes, note("Information", f"Summary data already exists for previous month: {month}")])
        return LoadResult(DONE, 0, 0)
    notes.append(note("Information", "Processing ALL available months." if month is None else f"Processing data for previous month: {month}"))
    if truncate_first:
        notes.append(note("Information", f"Table [dbo].[{load.table}] truncated."))
    elif month is not None:
        notes.append(note("Information", f"Deleted existing data for year_month: {month}"))
    load.log.append(app, notes)
    try:
        write = load.target.replace if truncate_first else load.target.replace_months
        phase = F.max(F.when(F.col("product_code") == load.phase_product, 1).otherwise(0)) if load.phase_product else None
        rows = write(load.build(month), {"by": load.procedure, "month": month}, {"phase": phase} if load.phase_product else None)
        ended = clock()
        seconds = int((ended.replace(microsecond=0) - started.replace(microsecond=0)).total_seconds())
        head, into = load.procedure, ""
        if load.phase_product:
            head += " first phase" if load.target.observed["phase"] else " second phase"
            into = f" for {month}"
        load.log.append(app, [note("Success", f"{head} completed successfully. Rows inserted{into}: {rows}. Execution time: {seconds} seconds", ended)])
        return LoadResult(LOAD, rows, seconds)
    except Exception as e:
        load.log.append(app, [note("Error", f"Error occurred: {error_text(e)}", None, type(e).__name__)])
        raise
