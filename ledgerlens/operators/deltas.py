"""Monthly sums kept up to date from an upsert's changes.

A changed row counts twice: its new values come in, its old ones go out, each in its own
month. ``apply`` adds these signed sums to the stored ones and rewrites the months that
they name; a group whose rows have all left a month leaves it. A report-ready summary
joins the stored sums to the accounts.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from functools import reduce
from operator import mul

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.summaries import SUMMARY_ACCOUNT_COLS
from ledgerlens.session import shuffles_removed
from ledgerlens.sources.snapshots import MONTH, SnapshotTable, of_months


@dataclasses.dataclass(frozen=True)
class Sums:
    """What is summed: ``values`` by ``keys`` and month. Stored are the rows of a group, of each
    value its sum, and how many rows have one (the sum of none is null)."""
    keys: tuple[str, ...]
    values: tuple[str, ...]

    @property
    def group(self) -> list[str]:
        return [*self.keys, MONTH]

    @property
    def columns(self) -> list[str]:
        return ["rows", *self.values, *(f"{v}_n" for v in self.values)]

    def signed(self, rows: DataFrame, sign: int) -> DataFrame:
        value = lambda c: (F.coalesce(F.col(c), F.lit(0)) * sign).cast("decimal(28,2)").alias(c)
        return rows.select(*self.group, F.lit(sign).cast("long").alias("rows"), *(value(c) for c in self.values),
                           *(F.when(F.col(c).isNotNull(), sign).otherwise(0).cast("long").alias(f"{c}_n") for c in self.values))

    def summed(self, rows: DataFrame) -> DataFrame:
        kind = lambda c: "long" if c == "rows" or c.endswith("_n") else "decimal(28,2)"
        return rows.groupBy(*self.group).agg(*(F.sum(c).cast(kind(c)).alias(c) for c in self.columns))

    def of(self, rows: DataFrame) -> DataFrame:
        """Stored sums of whole rows."""
        return self.summed(self.signed(rows, 1))

    def entries(self, changes: DataFrame) -> DataFrame:
        """An upsert's ``changes`` (see ``snapshots.Upsert``) as signed rows."""
        before = changes.filter("_op = 'updated'").select("_old.*")
        return self.signed(changes, 1).unionByName(self.signed(before, -1))

    def delta(self, changes: DataFrame) -> DataFrame:
        """Signed sums of an upsert's ``changes``."""
        return self.summed(self.entries(changes))

    def apply(self, stored: SnapshotTable, changes: DataFrame, made_by: dict | None = None) -> int:
        """Bring the stored sums up to date; returns the rows of the months written anew. Only
        those months are read. A delta's size follows the batch, not the table."""
        d, v = self.entries(changes), stored.version()
        with shuffles_removed(stored.spark):        # a few months; looked up once
            months = stored.spark.createDataFrame(d.select(MONTH).distinct().collect(), f"{MONTH} string")
        mine = stored.read(v, of_months(stored.parts(v), months)).select(*self.group, *self.columns)
        return stored.replace_months(self.summed(mine.unionByName(d)).filter("rows > 0"), made_by or {"by": "delta"}, months=months)


APPLICATIONS = Sums(("facility_code",), ("accept", "accept_val", "decline", "decline_val", "pending", "pending_val"))
PAIDS = Sums(("facility_code", "product_code"), ("advance",))


def _reported(stored: DataFrame, account: DataFrame, s: Sums, more: tuple[str, ...] = (), times: tuple[str, ...] = ("times",)) -> DataFrame:
    """Stored sums by account columns, each taken as often as ``times`` say; a sum of no value is null. A group is stored once and equal
    rows of the accounts are one row with their number, so joined rows need no second grouping."""
    value = lambda c: F.col(c) if c.endswith("_n") else F.when(F.col(f"{c}_n") > 0, F.col(c))
    rows = _counted(account.select("facility_code", *SUMMARY_ACCOUNT_COLS), "facility_code").hint("shuffle_hash").join(stored, "facility_code")
    return rows.select(*s.keys, *more, *SUMMARY_ACCOUNT_COLS, MONTH, *(reduce(mul, map(F.col, times), value(c)).alias(c) for c in s.columns[1:]))


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """Distinct rows and their number, dealt out by ``key``."""
    return rows.repartition(key).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times"))


def _total(c: str, name: str):
    return F.col(c).cast("decimal(18,2)").alias(name)


def _count(c: str, name: str):
    return F.col(c).cast("bigint").alias(name)


def _made(as_of: dt.date):
    return F.lit(dt.datetime.combine(as_of, dt.time())).cast("timestamp_ntz").alias("last_updated")


def application_summary(account: DataFrame, stored: DataFrame, as_of: dt.date) -> DataFrame:
    """The application summary of all stored months."""
    zero = lambda c, name: F.coalesce(F.col(c), F.lit(0)).cast("decimal(18,2)").alias(name)
    return _reported(stored, account, APPLICATIONS).select(
        *SUMMARY_ACCOUNT_COLS, "facility_code", _count("accept", "accept_count"), zero("accept_val", "accept_total"),
        _count("decline_n", "decline_count"), zero("decline_val", "decline_total"), _count("pending_n", "pending_count"),
        zero("pending_val", "pending_total"), MONTH, _made(as_of))


def paid_summary(account: DataFrame, stored: DataFrame, lender_product_code: DataFrame, as_of: dt.date) -> DataFrame:
    """The paid summary of all stored months."""
    codes = _counted(lender_product_code.select("product_code", "funding_option_uc"), "product_code").withColumnRenamed("times", "copies")
    rows = _reported(stored.join(codes, "product_code"), account, PAIDS, ("funding_option_uc",), ("times", "copies"))
    return rows.select(*SUMMARY_ACCOUNT_COLS, "facility_code", "product_code", "funding_option_uc", _count("advance_n", "advance_count"),
                       _total("advance", "advance_total"), MONTH, _made(as_of))
