"""Sharding by a k-d tree over document metadata; law ``bytes``.

Every node is cut at the byte-weighted median along its widest dimension
until there are 2**DEPTH leaves of nearly equal bytes (``depth_for`` gives the
depth from a target size). Dimensions are normalised to [0, 1]: numbers
(logarithm) by their range, text values by a hash of the value. A place on a
dimension is one 62-bit key: coordinate, then a hash of the document id, then of
its row number, so that a cut can pass through a value that holds a third of
all rows. Nulls lie at coordinate 0.

DataFrame functions only. Texts are read once, for sizes and checksums; the
slim table is written. A level takes a few rounds of histograms: per open node
BUCKETS sums, counted before the shuffle, and from them the driver picks the bucket
that holds the median and narrows it to its least and greatest key. What the
driver gets depends on the number of shards alone.

Slots come from counts of (shard, part) with as many parts as keep a part
near PART_ROWS rows; no window spans a whole shard. Null text counts 1 byte
(its checksum is that of no bytes). Empty table: no rows. Rows that repeat,
also in doc_id, get a slot each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, written

DEPTH = 4
BUCKETS = 1024
PART_ROWS = 50_000
COORD_BITS, ID_BITS, ROW_BITS = 24, 26, 12
#: Dimensions of ``documents``: column -> kind.
DIMENSIONS = {"n_chars": "number", "source": "value", "lang": "value", "doc_id": "number"}
#: A cut is good enough within this share of the node's bytes.
CLOSE = 1e-4


def depth_for(total_bytes: int, target_bytes: int) -> int:
    """Levels after which a leaf holds at most about ``target_bytes``."""
    return max(0, math.ceil(math.log2(max(total_bytes, 1) / target_bytes)))


def _coordinates(slim: DataFrame, dims: dict[str, str]) -> DataFrame:
    """Add ``ks``: an array with a 62-bit key per dimension."""
    def raw(c: str, kind: str) -> Column:
        if kind == "number":
            return F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0)))
        return F.pmod(F.xxhash64(F.col(c)), F.lit(1 << 30)).cast("double") / float(1 << 30)

    names = list(dims)
    numbers = [c for c in names if dims[c] == "number"]
    span = slim.agg(*(f(raw(c, "number")).alias(f"{n}_{c}") for c in numbers for n, f in (("lo", F.min), ("hi", F.max)))).first() if numbers else {}
    tie = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << ID_BITS)) * (1 << ROW_BITS) + F.pmod(F.xxhash64("uid"), F.lit(1 << ROW_BITS)))
    keys = []
    for c in names:
        x = raw(c, dims[c])
        if dims[c] == "number":
            lo, hi = span[f"lo_{c}"] or 0.0, span[f"hi_{c}"] or 0.0
            x = (x - lo) / (hi - lo if hi > lo else 1.0)
        coord = F.coalesce(F.least(F.floor(x * ((1 << COORD_BITS) - 1)).cast("long"), F.lit((1 << COORD_BITS) - 1)), F.lit(0).cast("long"))
        keys.append(coord * (1 << (ID_BITS + ROW_BITS)) + tie)
    return slim.withColumn("ks", F.array(*keys))


def _table(values: dict[int, int], nodes: int) -> Column:
    """Literal array by node number; 2 * shards entries at most."""
    return F.array(*(F.lit(values.get(n)).cast("long") for n in range(nodes)))


def _node(cuts: dict[int, tuple[int, int]], depth: int) -> Column:
    """Node number (heap order: 1 is the root) at ``depth``, from the cuts:
    node -> (dimension, first key on the right)."""
    if not depth:
        return F.lit(1).cast("long")
    dim = _table({n: d for n, (d, _) in cuts.items()}, 1 << depth)
    key = _table({n: k for n, (_, k) in cuts.items()}, 1 << depth)
    step = lambda n, _: n * 2 + (F.get(F.col("ks"), F.get(dim, n).cast("int")) >= F.get(key, n)).cast("long")
    return F.aggregate(F.array(*(F.lit(i) for i in range(depth))), F.lit(1).cast("long"), step)


def tree(slim: DataFrame, n_dims: int, depth: int) -> dict[int, tuple[int, int]]:
    """Cuts of all levels: node -> (dimension, first key on the right)."""
    cuts: dict[int, tuple[int, int]] = {}
    shift = ID_BITS + ROW_BITS
    for level in range(depth):
        at = slim.withColumn("node", _node(cuts, level))
        stats = {r.node: r for r in at.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *(f(F.col("ks")[i]).alias(f"{n}{i}") for i in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max)))).collect()}
        todo: dict[int, dict] = {}
        for node in range(1 << level, 2 << level):
            r = stats.get(node)
            if r is None:  # nothing here: any cut will do
                cuts[node] = (0, 0)
                continue
            dim = max(range(n_dims), key=lambda i: ((r[f"hi{i}"] >> shift) - (r[f"lo{i}"] >> shift), -i))
            todo[node] = {"dim": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "before": 0, "bytes": r.bytes}
        while todo:
            of = lambda f: F.get(_table({n: f(t) for n, t in todo.items()}, 2 << level), F.col("node"))
            rows = (at.select("node", "size", F.get("ks", of(lambda t: t["dim"]).cast("int")).alias("key"), of(lambda t: t["lo"]).alias("from"),
                              of(lambda t: t["hi"]).alias("to"), of(lambda t: (t["hi"] - t["lo"]) // BUCKETS + 1).alias("step"))
                      .filter((F.col("key") >= F.col("from")) & (F.col("key") <= F.col("to")))
                      .groupBy("node", F.expr("(key - `from`) div step").alias("bucket"))
                      .agg(F.sum("size").alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
            for node, t in list(todo.items()):
                own = sorted((r for r in rows if r.node == node), key=lambda r: r.lo)
                before, half = t["before"], t["bytes"] / 2
                for k, r in enumerate(own):
                    if before + r.bytes >= half or k == len(own) - 1:
                        break
                    before += r.bytes
                if min(half - before, before + r.bytes - half) <= t["bytes"] * CLOSE or r.lo == r.hi:
                    left = before + r.bytes - half <= half - before  # the bucket goes to the nearer side
                    cuts[node] = (t["dim"], r.hi + 1 if left else r.lo)
                    del todo[node]
                else:
                    t.update(lo=r.lo, hi=r.hi, before=before)
    return cuts


def shard(docs: DataFrame, depth: int = DEPTH, dims: dict[str, str] = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard (0 to 2**depth - 1, leaves from left to
    right), slot (gapless from 0 in each shard), grown_shard (null)."""
    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *(F.col(c) for c in dims if c != id_col), F.monotonically_increasing_id().alias("uid"))
    if id_col in dims:
        dims = {("doc_id" if c == id_col else c): kind for c, kind in dims.items()}
    slim = _coordinates(written(slim, "shard_meta"), dims)
    cuts = tree(slim, len(dims), depth)
    placed = slim.select("doc_id", "size", "text_crc32", "uid", (_node(cuts, depth) - (1 << depth)).cast("int").alias("shard"))
    parts = max(1, -(-placed.count() // (PART_ROWS << depth)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "uid")) - 1
    return placed.withColumn("inside", inside).join(base, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_kdtree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in 16 shards of nearly equal bytes."""
    return shard(read_table(spark, sf_dir, "documents"))
