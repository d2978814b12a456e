"""Tables of immutable files with versions, for loads that touch few of them.

A table is split into *parts*: one per ``year_month`` and bucket of the key's hash.
A part's files are written once and never changed. A version is a manifest, the list of
its live parts; a commit writes a new manifest and then names it by one atomic
rename, so a reader sees a version whole or not at all, keeps the one it opened, and a
load that fails leaves the version before it in place::

    data/batch=<id>/year_month=<m>/bucket=<b>/*.parquet   rows
    index/<id>/parts/                                     rows of each part
    index/<id>/filters/                                   Bloom filters of each part's keys, by stripe
    manifests/<id>/                                       year_month, bucket, batch, rows
    commits/<version>.json                                manifest, columns, what made it

``upsert`` asks the Bloom filters which parts may hold a batch's keys, reads those
rows, and rewrites only the parts that a changed row leaves or enters. A part's filter is
cut into STRIPES by the key's hash: a key meets the stripes of its own number, one a month,
so keys and filters are dealt out over all tasks however few buckets there are. What it
writes follows the batch and the parts it touches, not the table.

Row counts come from observations on the writes; months and sizes from the manifest. Both
need no scan.
"""

from __future__ import annotations

import dataclasses
import json
import os
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators.loaders import changed, one_per_key
from ledgerlens.session import shuffles_removed

MONTH, BUCKET, BATCH = "year_month", "bucket", "batch"
#: Bloom filter: bits a key and hashes a key (about one false hit in 200).
BITS, HASHES = 12, 5
#: Stripes of a part's filter, each of the same number of words.
STRIPES = 1024
#: Stripes whose keys ask first: a part that they hit is known, so a large batch is soon done.
FIRST = 16
#: Keys that are broadcast; more meet their rows by a shuffle.
MAX_SENT = 1_000_000
#: Bits of a word's place in its part's filter; the part's number is above them.
PLACE_BITS = 40
PARTS = f"{MONTH} string, {BUCKET} int, {BATCH} string, rows long"


def month_key(column: str = MONTH) -> Column:
    """Month to join by: no month is ''."""
    return F.coalesce(F.col(column), F.lit(""))


def of_months(parts: DataFrame, months: DataFrame, how: str = "left_semi") -> DataFrame:
    """Parts of the listed months, or (left_anti) of all others."""
    listed = months.select(month_key().alias("_m")).distinct()
    return parts.withColumn("_m", month_key()).join(listed, "_m", how).drop("_m")


class CommitConflict(RuntimeError):
    """Another writer has committed the version this one was to become."""


class Files:
    """The few file operations a commit needs, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def fs(self, p: str):
        return self.path(p).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        fs, p = self.fs(folder), self.path(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def read(self, p: str) -> str:
        stream = self.fs(p).open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, p: str, text: str) -> bool:
        """Write a file under a name that must be free; readers see it whole. False: taken."""
        folder, name = os.path.split(p)
        temp = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
        fs = self.fs(p)
        stream = fs.create(self.path(temp), False)
        stream.write(text.encode())
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf)
        kinds = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(self.path(temp)), fs.makeQualified(self.path(p)), kinds)
            return True
        except Exception as e:
            fs.delete(self.path(temp), False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def delete(self, p: str) -> None:
        self.fs(p).delete(self.path(p), True)


@dataclasses.dataclass(frozen=True)
class Version:
    number: int
    manifest: str
    schema: str
    made_by: dict


@dataclasses.dataclass(frozen=True)
class Upsert:
    """What an upsert did. ``changes``: the rows that were inserted or updated, with ``_op`` and
    the row before as the struct ``_old`` (null if inserted)."""
    version: Version
    rows_updated: int
    rows_inserted: int
    rows_total: int
    changes: DataFrame


class SnapshotTable:
    """``root``: its folder, shared by driver and executors. ``key``: the column that
    ``upsert`` goes by (None: rows are spread over buckets by all of their columns).
    ``buckets``: parts a month; choose it so that a month's part is some hundred MB."""

    def __init__(self, spark: SparkSession, root: str, key: str | None = None, buckets: int = 8):
        self.spark, self.root, self.key, self.buckets = spark, root, key, buckets
        self.files = Files(spark)
        #: What the last write saw of its rows: ``rows``, and the measures it was given.
        self.observed: dict = {}

    # -- versions ------------------------------------------------------------

    def _at(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(self._at("commits")) if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version | None:
        """A version, or the current one; None if there is none yet."""
        if number is None:
            all_ = self.versions()
            if not all_:
                return None
            number = all_[-1]
        return Version(number, **json.loads(self.files.read(self._at("commits", f"{number:020d}.json"))))

    def parts(self, version: Version | None = None) -> DataFrame:
        """Live parts of a version (default: the current one): year_month, bucket, batch, rows."""
        v = version or self.version()
        if v is None:
            return self.spark.createDataFrame([], PARTS)
        return self.spark.read.schema(PARTS).parquet(self._at("manifests", v.manifest))

    def months(self, version: Version | None = None) -> DataFrame:
        """Months that have rows, from the manifest."""
        return self.parts(version).select(MONTH).distinct()

    def rows_total(self, version: Version | None = None) -> int:
        return self.parts(version).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _save(self, rows: DataFrame, path: str, *by: str) -> None:
        """Write files; the shuffles that made them are removed."""
        with shuffles_removed(self.spark):
            rows.write.partitionBy(*by).parquet(path)

    # -- reading -------------------------------------------------------------

    def read(self, version: Version | None = None, parts: DataFrame | None = None) -> DataFrame:
        """Rows of a version, or of some of its ``parts``. The frame stays with the files
        it was made of, whatever is committed later. Only paths reach the driver, one a part."""
        v = version or self.version()
        if v is None:
            raise ValueError("the table has no version yet")
        schema = StructType.fromJson(json.loads(v.schema))
        live = (self.parts(v) if parts is None else parts).select(BATCH, MONTH, BUCKET).collect()
        if not live:
            return self.spark.createDataFrame([], schema)
        paths = [self._at("data", f"{BATCH}={p[BATCH]}", f"{MONTH}={p[MONTH] or '__HIVE_DEFAULT_PARTITION__'}", f"{BUCKET}={p[BUCKET]}") for p in live]
        wide = schema.add(BATCH, "string").add(BUCKET, "integer")
        return self.spark.read.schema(wide).option("basePath", self._at("data")).parquet(*paths).select(*(f.name for f in schema if f.name not in (BATCH, BUCKET)))

    # -- writing -------------------------------------------------------------

    def _bucket(self, columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(*([self.key] if self.key else columns)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, measures: dict[str, Column] | None = None) -> tuple[str, int]:
        """Write a batch of whole parts and their filters; (batch, rows written). The count and
        the ``measures`` (aggregates) are observed on the write: the plan runs once."""
        batch, seen = uuid.uuid4().hex, Observation()
        rows_ = (rows.withColumn(BUCKET, self._bucket(rows.columns)).repartition(MONTH, BUCKET).sortWithinPartitions(MONTH, BUCKET)
                 .observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in (measures or {}).items())))
        self._save(rows_, self._at("data", f"{BATCH}={batch}"), MONTH, BUCKET)
        self.observed = dict(seen.get)
        n = self.observed["rows"]
        if n:
            self._write_index(batch, rows.schema)
        return batch, n

    def _write_index(self, batch: str, schema: StructType) -> None:
        """Rows of each part of a batch, and the Bloom filters of its keys, a stripe's as an array
        of 64-bit words. Reads the key column of what was written, no other."""
        known = StructType([f for f in schema if f.name in (MONTH, self.key)]).add(BUCKET, "integer")
        rows = self.spark.read.schema(known).parquet(self._at("data", f"{BATCH}={batch}")).select(
            MONTH, month_key().alias("_m"), BUCKET, (F.col(self.key) if self.key else F.lit(None)).alias("_key"))
        self._save(rows.groupBy(MONTH, BUCKET).agg(F.count(F.lit(1)).alias("rows")), self._at("index", batch, "parts"))
        if self.key is None:
            return
        sizes = self._index_parts(batch).select(month_key().alias("_m"), BUCKET, F.ceil(F.col("rows") * BITS / (64 * STRIPES)).cast("int").alias("n"))
        # parts are numbered, so a word goes by one number: its part's above its place in the part
        sizes = sizes.withColumn("part", F.row_number().over(Window.orderBy("_m", BUCKET)).cast("long"))
        first = F.col("part") * 2 ** PLACE_BITS + F.col("stripe") * F.col("n").cast("long")
        sized = rows.filter("_key is not null").join(sizes, ["_m", BUCKET]).withColumn("stripe", self._stripe(F.col("_key")))
        at = sized.select(first.alias("first"), F.explode(F.array(*self._places(F.col("_key"), F.col("n")))).alias("at"))
        bits = at.select(F.expr("first + at div 64").alias("place"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bits"))
        every = sizes.filter("n > 1").select("part", "n", F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))).alias("stripe"))
        zero = every.select(F.explode(F.sequence(first, first + F.col("n") - 1)).alias("place"), F.lit(0).cast("long").alias("bits"))
        placed = (bits.unionByName(zero).groupBy("place").agg(F.bit_or("bits").alias("bits"))
                  .select(F.shiftright("place", PLACE_BITS).alias("part"), (F.col("place") % 2 ** PLACE_BITS).alias("place"), "bits").join(sizes, "part"))
        words = (placed.groupBy("_m", BUCKET, F.expr("cast(place div n as int)").alias("stripe"))
                 .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "bits"))), lambda x: x.bits).alias("words")))
        self._save(words, self._at("index", batch, "filters"))

    def _index_parts(self, batch: str) -> DataFrame:
        """Rows of each part of a batch."""
        return self.spark.read.schema(f"{MONTH} string, {BUCKET} int, rows long").parquet(self._at("index", batch, "parts"))

    @staticmethod
    def _stripe(key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(HASHES)), F.lit(STRIPES)).cast("int")

    @staticmethod
    def _places(key: Column, words: Column) -> list[Column]:
        """Bits of a key in a stripe of so many words."""
        return [F.pmod(F.xxhash64(key, F.lit(i)), words.cast("long") * 64) for i in range(HASHES)]

    def _commit(self, before: Version | None, kept: DataFrame | None, batch: str | None, schema: StructType, made_by: dict) -> Version:
        """A version of the ``kept`` parts and those of ``batch``."""
        name = uuid.uuid4().hex
        parts = kept if kept is not None else self.spark.createDataFrame([], PARTS)
        if batch is not None:
            parts = parts.select(MONTH, BUCKET, BATCH, "rows").unionByName(self._index_parts(batch).select(MONTH, BUCKET, F.lit(batch).alias(BATCH), "rows"))
        self._save(parts, self._at("manifests", name))
        number = before.number + 1 if before else 0
        body = {"manifest": name, "schema": schema.json(), "made_by": made_by}
        if not self.files.put_new(self._at("commits", f"{number:020d}.json"), json.dumps(body)):
            raise CommitConflict(f"version {number} of {self.root} is there already")
        return Version(number, **body)

    def _checked(self, rows: DataFrame) -> DataFrame:
        if MONTH not in rows.columns or {BUCKET, BATCH} & set(rows.columns):
            raise ValueError(f"rows need a column {MONTH}, and none named {BUCKET} or {BATCH}")
        v = self.version()
        if v is not None:
            rows = rows.select(*StructType.fromJson(json.loads(v.schema)).names)
        return rows

    def replace(self, rows: DataFrame, made_by: dict | None = None, measures: dict[str, Column] | None = None) -> int:
        """The table holds ``rows`` alone. Returns their number, as all writers here do."""
        v, rows = self.version(), self._checked(rows)
        batch, n = self._write(rows, measures)
        self._commit(v, None, batch if n else None, rows.schema, made_by or {"by": "replace"})
        return n

    def append(self, rows: DataFrame, made_by: dict | None = None, measures: dict[str, Column] | None = None) -> int:
        """Rows are added; a part may then have files of several batches."""
        v, rows = self.version(), self._checked(rows)
        batch, n = self._write(rows, measures)
        self._commit(v, self.parts(v) if v else None, batch if n else None, rows.schema, made_by or {"by": "append"})
        return n

    def replace_months(self, rows: DataFrame, made_by: dict | None = None, measures: dict[str, Column] | None = None, months: DataFrame | None = None) -> int:
        """The months of ``rows``, and those listed in ``months``, are replaced; others stay as they
        are. Running a load again gives the same rows again."""
        v, rows = self.version(), self._checked(rows)
        batch, n = self._write(rows, measures)
        kept = self.parts(v) if v else None
        if v and n:
            kept = of_months(kept, self._index_parts(batch), "left_anti")
        if v and months is not None:
            kept = of_months(kept, months, "left_anti")
        self._commit(v, kept, batch if n else None, rows.schema, made_by or {"by": "replace_months"})
        return n

    def replace_slice(self, payload: DataFrame, keys: list[str], named: DataFrame | None = None, made_by: dict | None = None) -> int:
        """Rows whose ``keys`` appear in the payload (or in ``named``) go, the payload comes.
        ``year_month`` must follow from the keys: only the months of the slices and of the
        payload are read and rewritten. ``payload`` should be written: it is read more than once."""
        v, payload = self.version(), self._checked(payload)
        if v is None:
            return self.replace(payload, made_by)
        slices = (payload if named is None else named).select(*keys, MONTH).distinct()
        touched = slices.select(MONTH).union(payload.select(MONTH))
        live = self.parts(v)
        stay = self.read(v, of_months(live, touched, "left_semi")).join(slices.drop(MONTH).distinct(), keys, "left_anti").select(*payload.columns)
        batch, n = self._write(stay.unionByName(payload))
        self._commit(v, of_months(live, touched, "left_anti"), batch if n else None, payload.schema, made_by or {"by": "replace_slice"})
        return n

    # -- upsert --------------------------------------------------------------

    def may_hold(self, keys: DataFrame, version: Version) -> DataFrame:
        """Live parts whose filter has some of the ``keys`` (a column named as the key). The keys of the
        first stripes ask all parts, the others only those that are not hit yet."""
        live = self.parts(version)
        parts = live.collect()
        if not parts:
            return live
        batches = sorted({p[BATCH] for p in parts})
        index = self.spark.read.schema(f"_m string, {BUCKET} int, stripe int, words array<bigint>").parquet(*(self._at("index", b, "filters") for b in batches))
        index = index.withColumn(BATCH, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3))
        index = live.withColumn("_m", month_key()).join(index, ["_m", BUCKET, BATCH])
        asked = keys.select(F.col(self.key).alias("_k"), self._bucket([]).alias(BUCKET), self._stripe(F.col(self.key)).alias("stripe")).filter("_k is not null")
        with shuffles_removed(self.spark):
            known = self._hit(asked.filter(F.col("stripe") < FIRST), index.filter(F.col("stripe") < FIRST)).collect()
        if len(known) == len(parts):
            return live
        known = self.spark.createDataFrame(known, live.schema)
        there = known.select(month_key().alias("_m"), BUCKET, BATCH)
        return known.union(self._hit(asked.filter(F.col("stripe") >= FIRST), index.filter(F.col("stripe") >= FIRST).join(F.broadcast(there), ["_m", BUCKET, BATCH], "left_anti")))

    def _hit(self, asked: DataFrame, index: DataFrame) -> DataFrame:
        """Parts of the ``index`` whose filter has some of the keys that are ``asked`` for."""
        hit = reduce(lambda a, b: a & b, (F.expr(f"shiftright(element_at(words, cast(at{i} div 64 + 1 as int)), cast(at{i} % 64 as int)) & 1L") == 1 for i in range(HASHES)))
        pairs = asked.join(index, [BUCKET, "stripe"])       # a key's stripes, one a part, are the side that is held
        for i, at in enumerate(self._places(F.col("_k"), F.size("words"))):
            pairs = pairs.withColumn(f"at{i}", at)
        return pairs.filter(hit).select(MONTH, BUCKET, BATCH, "rows").distinct()

    def upsert(self, staged: DataFrame, change_cols: list[str], null_safe: bool = False, latest: list[str] | None = None,
               made_by: dict | None = None, stored: bool = False) -> Upsert:
        """Changed rows take the staged values, new keys are inserted, all other rows and
        their files stay. Change detection and repeated staged keys: as
        ``ledgerlens.operators.loaders.upsert``. If nothing changes, nothing is committed.
        Staged rows are read twice, so they are written first, unless ``stored`` says that they are read from files."""
        if self.key is None:
            raise ValueError("an upsert needs a key")
        v, staged = self.version(), self._checked(staged)
        columns, key = staged.columns, self.key
        if v is None:
            self.replace(self.spark.createDataFrame([], staged.schema), {"by": "create"})
            v = self.version()
        stage = uuid.uuid4().hex
        if not stored:
            self._save(staged, self._at("staging", stage, "rows"))
            staged = self.spark.read.schema(staged.schema).parquet(self._at("staging", stage, "rows"))
        with shuffles_removed(self.spark):
            old = self.read(v, self.may_hold(staged.select(key), v)).select(*columns)
        # rows are dealt out by key once: for the guard against repeated keys and the join
        s, t = one_per_key(staged, key, latest).alias("s"), old.alias("t")
        new = F.col(f"t.{key}").isNull()
        ops = (s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "left").filter(new | changed(change_cols, null_safe))
                .select("s.*", F.when(new, "inserted").otherwise("updated").alias("_op"),
                        F.when(~new, F.struct(*(F.col(f"t.{c}") for c in columns))).alias("_old")))
        seen = Observation()
        self._save(ops.observe(seen, F.count(F.when(F.col("_op") == "inserted", 1)).alias("inserted"), F.count(F.when(F.col("_op") == "updated", 1)).alias("updated")),
                   self._at("staging", stage, "changes"))
        changes = self.spark.read.schema(ops.schema).parquet(self._at("staging", stage, "changes"))
        inserted, updated = seen.get["inserted"], seen.get["updated"]
        if inserted + updated:
            left, entered = changes.filter("_op = 'updated'").select(month_key(f"_old.{MONTH}").alias("_m"), key), changes.select(month_key().alias("_m"), key)
            touched = left.union(entered).select("_m", self._bucket([]).alias(BUCKET)).distinct()
            self._save(touched, self._at("staging", stage, "touched"))
            touched = self.spark.read.schema(f"_m string, {BUCKET} int").parquet(self._at("staging", stage, "touched"))
            live = self.parts(v).withColumn("_m", month_key())
            gone = changes.filter("_op = 'updated'").select(key)        # no part holds an inserted key
            gone = F.broadcast(gone) if updated <= MAX_SENT else gone
            stay = self.read(v, live.join(touched, ["_m", BUCKET], "left_semi")).join(gone, key, "left_anti").select(*columns)
            batch, _ = self._write(stay.unionByName(changes.select(*columns)))
            v = self._commit(v, live.join(touched, ["_m", BUCKET], "left_anti"), batch, staged.schema, made_by or {"by": "upsert"})
        return Upsert(v, updated, inserted, self.rows_total(v), changes)

    # -- cleaning ------------------------------------------------------------

    def vacuum(self, keep: int = 1) -> int:
        """Delete what only versions before the last ``keep`` name, and what failed loads have
        left; returns the number of batches deleted. No load may run meanwhile."""
        numbers = self.versions()
        for n in numbers[:-keep]:
            self.files.delete(self._at("commits", f"{n:020d}.json"))
        kept = [self.version(n) for n in numbers[-keep:]]
        live = {r[0] for v in kept for r in self.parts(v).select(BATCH).distinct().collect()}
        for name in set(self.files.names(self._at("manifests"))) - {v.manifest for v in kept}:
            self.files.delete(self._at("manifests", name))
        dead = {n.split("=", 1)[1] for n in self.files.names(self._at("data")) if "=" in n} - live
        for b in dead:
            self.files.delete(self._at("data", f"{BATCH}={b}"))
            self.files.delete(self._at("index", b))
        self.files.delete(self._at("staging"))
        return len(dead)
