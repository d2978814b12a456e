"""Versioned tables: touched parts, counts of the write, commits, time travel."""

import glob
import os
import random
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerlens.operators import loaders as L
from ledgerlens.session import new_path, shuffles_removed
from ledgerlens.sources import snapshots
from ledgerlens.sources.snapshots import CommitConflict, SnapshotTable

SCHEMA = "id long, v int, year_month string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, rows=None, buckets=4):
    t = SnapshotTable(spark, new_path(spark, "t"), "id", buckets)
    if rows is not None:
        t.replace(_rows(spark, rows))
    return t


def _read(t, **kw):
    return sorted((tuple(r) for r in t.read(**kw).collect()), key=str)


def _files(t):
    """Live files by month."""
    out = {}
    for p in t.parts().collect():
        for f in glob.glob(f"{t.root}/data/batch={p.batch}/year_month={p.year_month}/bucket={p.bucket}/*.parquet"):
            out.setdefault(p.year_month, {})[f] = os.stat(f).st_mtime_ns
    return out


BASE = [(i, i % 5, f"1999-0{1 + i % 4}") for i in range(400)]


def test_a_batch_of_one_month_leaves_the_others_files(spark):
    t = _table(spark, BASE)
    before = _files(t)
    done = t.upsert(_rows(spark, [(4, 100, "1999-01"), (8, 200, "1999-01"), (1000, 1, "1999-01"), (12, 12 % 5, "1999-01")]), ["v", "year_month"])
    after = _files(t)
    assert (done.rows_updated, done.rows_inserted, done.rows_total) == (2, 1, 401)
    assert {m: after[m] for m in ("1999-02", "1999-03", "1999-04")} == {m: before[m] for m in ("1999-02", "1999-03", "1999-04")}
    assert set(after["1999-01"]) != set(before["1999-01"])
    # in the month, only the buckets of changed rows are written anew
    changed = {r[0] for r in _rows(spark, [(4, 0, ""), (8, 0, ""), (1000, 0, "")]).select(t._bucket([])).collect()}
    assert len(set(before["1999-01"]) - set(after["1999-01"])) == len(changed)
    want = {r[0]: r for r in BASE} | {4: (4, 100, "1999-01"), 8: (8, 200, "1999-01"), 1000: (1000, 1, "1999-01")}
    assert _read(t) == sorted(want.values(), key=str)


def test_a_row_that_moves_rewrites_two_parts(spark):
    t = _table(spark, BASE)
    before = _files(t)
    t.upsert(_rows(spark, [(4, 4, "1999-03")]), ["v", "year_month"])
    after = _files(t)
    gone = {m: set(before[m]) - set(after[m]) for m in before}
    assert {m: len(g) for m, g in gone.items()} == {"1999-01": 1, "1999-02": 0, "1999-03": 1, "1999-04": 0}
    assert [r for r in _read(t) if r[0] == 4] == [(4, 4, "1999-03")]


def test_nothing_changed_commits_nothing(spark):
    t = _table(spark, BASE)
    before = t.versions()
    done = t.upsert(_rows(spark, BASE[:50]), ["v", "year_month"])
    assert (done.rows_updated, done.rows_inserted, done.rows_total) == (0, 0, 400) and t.versions() == before


def test_filters_never_miss_and_seldom_err(spark):
    t = _table(spark, [(i * 7919, 0, f"1999-{1 + i % 9:02d}") for i in range(4000)])
    held = spark.range(40).select((F.col("id") * 100 * 7919).alias("id"))
    want = {(f"1999-{1 + i * 100 % 9:02d}", b) for i, b in ((r.id // 100 // 7919, r.b) for r in held.select("id", t._bucket([]).alias("b")).collect())}
    found = {(r.year_month, r.bucket) for r in t.may_hold(held, t.version()).collect()}
    assert want <= found
    absent = spark.range(200).select((F.col("id") * 7919 + 1).alias("id"))
    live = t.parts().count()
    asked = sum(t.may_hold(absent.filter(F.col("id") == i * 7919 + 1), t.version()).count() for i in range(0, 200, 20))
    assert asked <= 0.1 * 10 * live


def test_random_batches_equal_the_whole_table_upsert(spark):
    r = random.Random(7)
    t, rows = _table(spark, [(i, 0, "2000-01") for i in range(30)], buckets=3), {i: (i, 0, "2000-01") for i in range(30)}
    for n in range(6):
        batch = {i: (i, r.randint(0, 2), r.choice(["2000-01", "2000-02", "2000-03", None])) for i in r.sample(range(60), 15)}
        whole = L.upsert(_rows(spark, list(rows.values())), _rows(spark, list(batch.values())), "id", ["v", "year_month"])
        ops = whole.groupBy("_op").count().collect()
        counts = {o["_op"]: o["count"] for o in ops}
        done = t.upsert(_rows(spark, list(batch.values())), ["v", "year_month"])
        rows = {x[0]: tuple(x) for x in whole.drop("_op").collect()}
        assert _read(t) == sorted(rows.values(), key=str)
        assert (done.rows_updated, done.rows_inserted, done.rows_total) == (counts.get("updated", 0), counts.get("inserted", 0), len(rows))


def test_repeated_keys_raise_and_leave_the_table(spark):
    t = _table(spark, BASE)
    twice = _rows(spark, [(1, 7, "1999-02"), (1, 8, "1999-02")])
    with pytest.raises(Exception, match="staged rows repeat id"):
        t.upsert(twice, ["v"])
    assert _read(t) == sorted(BASE, key=str) and len(t.versions()) == 1
    assert t.upsert(twice, ["v"], latest=["v"]).rows_updated == 1


def test_a_failing_write_leaves_the_old_rows(spark):
    t = _table(spark, BASE)
    bad = _rows(spark, [(i, i, "1999-01") for i in range(50)]).withColumn(
        "v", F.when(F.col("id") == 49, F.raise_error(F.lit("broken feed")).cast("int")).otherwise(F.col("v")))
    for write in (t.replace, t.append, t.replace_months, lambda d: t.replace_slice(d, ["v"]), lambda d: t.upsert(d, ["v"])):
        with pytest.raises(Exception, match="broken feed"):
            write(bad)
        assert _read(t) == sorted(BASE, key=str) and t.versions() == [0]


def test_readers_keep_their_version(spark):
    t = _table(spark, BASE)
    old, first = t.read(), t.version()
    t.replace(_rows(spark, [(1, 1, "2001-01")]))
    assert old.count() == 400 and _read(t) == [(1, 1, "2001-01")]
    assert len(_read(t, version=first)) == 400
    assert t.vacuum() == 1 and _read(t) == [(1, 1, "2001-01")] and t.versions() == [1]


def test_two_writers_of_one_version(spark, monkeypatch):
    t = _table(spark, BASE)
    stale = t.version()
    t.append(_rows(spark, [(900, 1, "1999-09")]))
    with monkeypatch.context() as m:
        m.setattr(t, "version", lambda *a: stale)
        with pytest.raises(CommitConflict):
            t.append(_rows(spark, [(901, 1, "1999-09")]))
    assert len(_read(t)) == 401 and not [n for n in os.listdir(f"{t.root}/commits") if ".json." in n and not n.endswith(".crc")]


def test_months_counts_and_modes(spark):
    t = SnapshotTable(spark, new_path(spark, "t"), None, 2)
    assert t.version() is None and t.months().count() == 0
    assert t.replace(_rows(spark, [])) == 0 and _read(t) == []
    assert t.append(_rows(spark, [(1, 1, "2000-01"), (2, 2, "2000-02")])) == 2
    assert t.append(_rows(spark, [(1, 1, "2000-01")])) == 1
    assert t.rows_total() == 3 and sorted(r[0] for r in t.months().collect()) == ["2000-01", "2000-02"]
    assert t.replace_months(_rows(spark, [(5, 5, "2000-01"), (6, 6, None)])) == 2
    assert _read(t) == [(2, 2, "2000-02"), (5, 5, "2000-01"), (6, 6, None)]
    assert t.replace_months(_rows(spark, [])) == 0 and t.rows_total() == 3
    assert t.replace_slice(_rows(spark, [(9, 2, "2000-02")]), ["v"]) == 1       # (2, 2) went, (9, 2) came
    assert _read(t) == [(5, 5, "2000-01"), (6, 6, None), (9, 2, "2000-02")]


def test_month_filters_prune_parts(spark):
    t = _table(spark, BASE)
    plan = t.read().filter("year_month = '1999-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and plan.count("FileScan") == 1


def test_a_stream_upserts_once_a_batch(spark):
    from ledgerlens.streaming.feeds import feed_stream, last_batch, upsert_stream_into
    t, root = _table(spark, BASE), new_path(spark, "feed")
    stage = lambda df: df.select("id", "v", "year_month")
    for k in range(2):
        _rows(spark, [(4, 100 + k, "1999-01"), (2000 + k, 1, "1999-05")]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for _ in range(2):                  # the second run finds nothing new
        upsert_stream_into(feed_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1), stage, t, ["v"], f"{root}/checkpoint", "feed").awaitTermination()
    assert last_batch(t, "feed") == 1 and t.versions() == [0, 1, 2] and t.rows_total() == 402
    # a batch that has been committed is not run again, even if the stream forgets it
    upsert_stream_into(feed_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1), stage, t, ["v"], f"{root}/other", "feed").awaitTermination()
    assert t.versions() == [0, 1, 2]


def test_a_filter_is_dealt_out_over_stripes(spark):
    """However many keys a part has, a key meets one short array of it, and no task all keys."""
    t = _table(spark, [(0, 0, "1999-01")], buckets=1)
    rows = spark.range(1, 20000).select("id", F.lit(0).alias("v"), F.lit("1999-02").alias("year_month"))
    t.append(rows.unionByName(_rows(spark, [(None, 0, "1999-03")])))
    batch = t.parts().filter("year_month = '1999-02'").first().batch
    words = spark.read.parquet(f"{t.root}/index/{batch}/filters").selectExpr("count(*) AS rows", "min(size(words)) AS low", "max(size(words)) AS high").first()
    assert (words.rows, words.low, words.high) == (1024, 4, 4)
    held = spark.range(1, 20000, 37).unionByName(spark.createDataFrame([(None,)], "id long"))
    assert "1999-02" in {r.year_month for r in t.may_hold(held, t.version()).collect()}
    assert t.may_hold(spark.createDataFrame([(None,)], "id long"), t.version()).count() == 0
    assert t.rows_total() == 20001


def test_a_large_batch_asks_the_filters_with_its_first_keys(spark, monkeypatch):
    t, asked = _table(spark, [(i, 0, f"1999-0{1 + i % 3}") for i in range(9000)]), []
    hit = t._hit
    monkeypatch.setattr(t, "_hit", lambda keys, index: asked.append(keys) or hit(keys, index))
    assert t.may_hold(spark.range(9000).toDF("id"), t.version()).count() == t.parts().count() == 12
    assert len(asked) == 1 and asked[0].count() < 9000 / 20
    stripes = {r.id: r.s for r in spark.range(200).select("id", t._stripe(F.col("id")).alias("s")).collect()}
    early, late = (next(i for i, s in stripes.items() if (s < 16) == first) for first in (True, False))
    for keys in ([early], [late], [early, late]):
        want = {(f"1999-0{1 + i % 3}", r.b) for i in keys for r in spark.createDataFrame([(i,)], "id long").select(t._bucket([]).alias("b")).collect()}
        found = [(r.year_month, r.bucket) for r in t.may_hold(spark.createDataFrame([(i,) for i in keys], "id long"), t.version()).collect()]
        assert want <= set(found) and len(found) == len(set(found))


def test_an_upserts_writes_leave_no_shuffle_files(spark, monkeypatch):
    key, parquet, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **kw: seen.append(spark.conf.get(key, None)) or parquet(self, *a, **kw))
    before, t = spark.conf.get(key, None), _table(spark, BASE)
    done = t.upsert(_rows(spark, BASE[:50]).withColumn("v", F.lit(9)), ["v"])
    assert (done.rows_updated, done.rows_total) == (50, 400) and spark.conf.get(key, None) == before
    assert len(seen) > 8 and set(seen) == {"true"}


def test_shuffle_files_go_when_an_action_ends(spark):
    def blocks():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
        return {n for n in (found.apply(i).name() for i in range(found.size())) if n.startswith("shuffle_")}
    before, rows = blocks(), spark.range(3000).repartition(4, "id")
    with shuffles_removed(spark), shuffles_removed(spark):
        rows.write.parquet(new_path(spark, "rows"))
    for _ in range(50):                     # files are removed beside the next work
        if blocks() <= before:
            break
        time.sleep(0.2)
    assert blocks() <= before


@pytest.mark.parametrize("most", [0, 10 ** 6])
def test_changed_keys_by_broadcast_or_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(snapshots, "MAX_SENT", most)
    t = _table(spark, [*BASE, (None, 1, "1999-01")])
    done = t.upsert(_rows(spark, [(4, 9, "1999-02"), (1, 8, "1999-02"), (2, 2, "1999-03"), (5000, 1, "1999-02"), (None, 3, "1999-02")]), ["v", "year_month"])
    assert (done.rows_updated, done.rows_inserted, done.rows_total) == (2, 2, 403)
    want = {r[0]: r for r in BASE} | {4: (4, 9, "1999-02"), 1: (1, 8, "1999-02"), 5000: (5000, 1, "1999-02")}
    assert _read(t) == sorted([*want.values(), (None, 1, "1999-01"), (None, 3, "1999-02")], key=str)
