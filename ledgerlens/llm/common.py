"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return os.path.join(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts
    the lineage with files that survive a lost executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Tables written inside go to Python ``most`` rows at a time (fewer, if the session says so).
    A batch lies in memory twice, in the executor's JVM (outside of its heap) and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows that ``lookup`` broadcasts at most, and rows a key must have to be split off.
LOOKUP_ROWS = 1_000_000
HOT_ROWS = 100_000


def lookup(rows: DataFrame, table: DataFrame, key: str, held: str, limit: int = LOOKUP_ROWS, hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` left joined with ``table``, which is unique by ``key`` and says in ``held``
    how many of ``rows`` hold the key.

    A table of at most ``limit`` rows is broadcast. Beyond that only the keys of more
    than ``hot`` rows are (sum(held) / hot of them at most, and ``hot`` is raised until
    that is no more than ``limit``); the rows of all others meet by a shuffle, in which
    no key has more than ``hot`` rows. ``table`` should be written: it is read
    more than once. ``rows`` holds no null keys."""
    n, total = table.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    if n <= limit:
        return rows.join(F.broadcast(table), key, "left")
    hot = max(hot, -(-total // limit))
    many = F.broadcast(table.filter(F.col(held) > hot))
    rest = rows.join(many.select(key), key, "left_anti").join(table.filter(F.col(held) <= hot), key, "left")
    return rows.join(many, key).unionByName(rest)
