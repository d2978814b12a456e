"""Spark session helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import threading
import uuid
import weakref

from pyspark.sql import SparkSession

# Settings every job here relies on: ANSI arithmetic (overflow and bad
# casts raise), AQE for runtime re-planning (broadcast of sides that are
# small at run time, skew-join splitting, partition coalescing), UTC so
# timestamps compare equal to the SQL oracle.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "ledgerlens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, for lineage cuts and tables:
    ``spark.checkpoint.dir`` (the cluster names it). Only a single-process ``local[...]``
    session may leave it unset; it gets a temporary folder of its own, removed at exit."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="ledgerlens-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], True)
    return _LOCAL["dir"]


#: Spark removes an action's shuffle files when it ends, not when the driver's JVM has collected its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_CLEANING_LOCK = threading.Lock()


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Actions started inside leave no shuffle files behind, which else fill the executors' disks
    in a job of many writes. May be nested, and entered by several threads; the setting is as before at the end."""
    with _CLEANING_LOCK:
        entered = _CLEANING.setdefault(spark, [0, None])
        if not entered[0]:
            entered[1] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        entered[0] += 1
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            entered[0] -= 1
            if not entered[0]:
                spark.conf.unset(CLEANUP) if entered[1] is None else spark.conf.set(CLEANUP, entered[1])


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder."""
    return os.path.join(shared_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A named path under the shared folder."""
    return os.path.join(shared_dir(spark), *parts)
