"""Stored fact tables, and the month cube made of them.

``FactStore`` keeps applications, paid deals, quotes and budgets as ``SnapshotTable``s by business
month: a report's window prunes months, and the months there are come from the manifests,
so a report over all months needs no scan to learn them.

``MonthCube`` keeps the sums that every funnel report starts from, one row a month,
facility, group and lender. Its commit names the versions of the facts it was made of; reports
read it while those are the current ones, and the facts otherwise.

``BucketedTable`` keeps a table bucketed by facility code, so that it joins another one
bucketed alike without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import facts as facts_op
from ledgerlens.sources.domain import year_month_of
from ledgerlens.sources.snapshots import MONTH, SnapshotTable

NAMES = ("applications", "paids", "quotes", "budgets")
KEYS = {"applications": "id", "paids": "id", "quotes": None, "budgets": None}


def _month(name: str) -> Column:
    """Business month of a table's rows; a budget's year starts in January."""
    return year_month_of(F.col("year"), F.lit(1) if name == "budgets" else F.col("month"))


class FactStore:
    """The four fact tables under ``root``. ``buckets``: parts a month of each."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark, self.root = spark, root
        self.tables = {n: SnapshotTable(spark, f"{root}/{n}", KEYS[n], buckets) for n in NAMES}

    @staticmethod
    def by_month(name: str, rows: DataFrame) -> DataFrame:
        """Rows as stored: ``year_month`` is the business month."""
        return rows.drop(MONTH).withColumn(MONTH, _month(name))

    def load(self, **tables: DataFrame) -> None:
        """Replace tables by name. They are loaded side by side, so the last tasks of one leave no
        core idle; the first error is raised when all have ended."""
        with ThreadPoolExecutor(len(NAMES)) as pool:
            loads = [pool.submit(inheritable_thread_target(self.spark)(self.tables[n].replace), self.by_month(n, rows)) for n, rows in tables.items()]
        for load in loads:
            load.result()

    def versions(self) -> dict[str, int]:
        """Current version of each table."""
        return {n: v.number if (v := t.version()) else -1 for n, t in self.tables.items()}

    def read(self, name: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
        """Rows of the months from ``lo`` up to ``hi``, excluded. The files of other months
        are not even listed."""
        table = self.tables[name]
        v = table.version()
        parts = table.parts(v)
        for bound, keep in ((lo, lambda m, b: m >= b), (hi, lambda m, b: m < b)):
            if bound is not None:
                parts = parts.filter(keep(F.col(MONTH), f"{bound:%Y-%m}"))
        return table.read(v, parts)

    def months(self, since: dt.date) -> DataFrame:
        """Months with applications or paid deals, from the manifests."""
        both = self.tables["applications"].months().union(self.tables["paids"].months())
        return both.filter(F.col(MONTH) >= f"{since:%Y-%m}").distinct()


class BucketedTable:
    """A Parquet table in the session's catalog, bucketed and sorted by ``key`` and, if it has
    months, partitioned by ``year_month``."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: str = "facility_code", buckets: int = 8):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path, key, buckets

    def write(self, rows: DataFrame) -> "BucketedTable":
        month = [MONTH] if MONTH in rows.columns else []
        w = (rows.repartition(self.buckets, self.key).write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key)
             .option("path", self.path))
        (w.partitionBy(*month) if month else w).saveAsTable(self.name)
        return self

    def open(self, schema: str) -> "BucketedTable":
        """Name files that an earlier session has written."""
        month = f" PARTITIONED BY ({MONTH})" if MONTH in schema else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet{month} "
                       f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if month:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


#: Sums of the cube by the fact they come from.
CUBE = {"applications": ["accept", "accept_val", "decline", "decline_val", "pending", "pending_val"],
        "paids": ["advance", "advance_count", "commission"], "ecof": ["ecof_count", "ecof_advance"], "budget": ["budget"]}
PLACE = ["facility_used_by_report_group_id", "facility_used_by_id", "facility_lender", MONTH]


class MonthCube:
    """Sums by month, facility, group and lender under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, SnapshotTable(spark, root, None, 1)

    def refresh(self, store: FactStore, account: DataFrame) -> int:
        """Make the cube of the store's current versions; returns its rows."""
        made_of = store.versions()
        ever = dt.date(4, 1, 1)
        sources = {
            "applications": facts_op.application_facts(account, store.read("applications"), ever),
            "paids": facts_op.paid_facts(account, store.read("paids"), ever),
            "ecof": facts_op.ecof_facts(account, store.read("quotes"), own_keys(account)).withColumnRenamed("report_group_id", PLACE[0]),
            "budget": facts_op.budget_facts(account, store.read("budgets"))}
        rows = None
        for name, sums in CUBE.items():
            own = sources[name].groupBy(*PLACE).agg(*(F.sum(c).alias(c) for c in sums)).withColumn("fact", F.lit(name))
            rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
        return self.table.replace(rows, {"by": "cube", "sources": made_of})

    def current(self, store: FactStore) -> bool:
        v = self.table.version()
        return v is not None and v.made_by["sources"] == store.versions()

    def facts(self, name: str) -> DataFrame:
        place = [F.col(c).alias("report_group_id" if name == "ecof" and c == PLACE[0] else c) for c in PLACE]
        return self.table.read().filter(F.col("fact") == name).select(*place, *CUBE[name])


def own_keys(account: DataFrame) -> DataFrame:
    """Quotes are stored by account."""
    return account.select(F.col("account_id").alias("ecof_key"), "account_id").distinct()
