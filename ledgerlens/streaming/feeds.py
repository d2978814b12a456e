"""Re-delivered feeds as a stream: each micro-batch of newly arrived feed
files is staged and upserted into the current snapshot.

``upsert_stream_into`` upserts into a ``SnapshotTable``: a batch rewrites the parts it touches,
and the commit names the stream and the batch, so one that is run again after its commit
does nothing.

With ``upsert_stream`` every batch writes snapshot ``<root>/batch=<id>`` from snapshot ``id - 1``
(or the initial table). A batch that is re-run after a failure recomputes
the same input and overwrites the same path, so the sink is idempotent and
the checkpoint gives exactly-once snapshots.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.loaders import upsert
from ledgerlens.sources.snapshots import SnapshotTable


def snapshot_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch={batch_id:010d}")


def feed_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def last_batch(table: SnapshotTable, stream: str) -> int:
    """Highest batch of the stream that a version of the table names; -1: none."""
    made = (table.version(n).made_by for n in table.versions())
    return max((m["batch"] for m in made if m.get("stream") == stream), default=-1)


def upsert_stream_into(feed: DataFrame, stage: Callable[[DataFrame], DataFrame], table: SnapshotTable, change_cols: list[str],
                       checkpoint: str, stream: str, available_now: bool = True, latest: list[str] | None = None) -> StreamingQuery:
    """Upsert each micro-batch into ``table``; ``stream`` names the feed in the table's commits."""
    def batch(df: DataFrame, batch_id: int) -> None:
        if batch_id > last_batch(table, stream):
            table.upsert(stage(df), change_cols, latest=latest, made_by={"by": "stream", "stream": stream, "batch": batch_id})

    w = feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def upsert_stream(feed: DataFrame, stage: Callable[[DataFrame], DataFrame], key: str,
                  change_cols: list[str], initial_path: str, snapshots_root: str,
                  checkpoint: str, available_now: bool = True, latest: list[str] | None = None) -> StreamingQuery:
    spark = feed.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        prev = initial_path if batch_id == 0 else snapshot_path(snapshots_root, batch_id - 1)
        current = spark.read.parquet(prev)
        merged = upsert(current, stage(df).select(*current.columns), key, change_cols, latest=latest).drop("_op")
        merged.write.mode("overwrite").parquet(snapshot_path(snapshots_root, batch_id))

    w = feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
