"""Driver tables (parquet) as lazily-read DataFrames.

A ``Tables`` object opens a table (one file listing, one footer) when it is first
asked for and keeps that reader; a report makes an object of its own, so nothing goes
stale between reports. Catalyst prunes columns and pushes filters into the scan, so
callers simply ``select`` what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """``Tables(spark, sf_dir).orders`` -> DataFrame of ``orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        self.__dict__[name] = df = read_table(self.spark, self.sf_dir, name)
        return df
