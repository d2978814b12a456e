"""Near-duplicate documents with HyperMinHash.

Words: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``. A document's set holds its
distinct ``size``-word shingles; with fewer words, the whole sequence as one;
without words or text it is empty and linked with nothing. Sets are of 64-bit hashes.

Steps:

1. Equal sets are one class (a 128-bit digest of the set, counted before
   the shuffle). Only classes go on, each by its smallest doc_id.
2. Sketch: REGISTERS buckets; a bucket keeps, of its smallest hash, the count
   of leading zeros and MANTISSA further bits, in 16 bits. Empty buckets borrow from a
   bucket of their own random sequence (densification), so that a short text
   fills all registers and no band is made of empty ones.
3. Bands of ROWS registers are hashed. In a band's bucket every class is paired with
   the bucket's smallest one (a star: as many pairs as members).
4. Pairs whose sizes allow the threshold and whose collision-corrected Jaccard
   estimate is not MARGIN below it are verified on the full sets.
5. Links found make components. Buckets whose members are not yet all in one
   component go on: there, all pairs across components are estimated inside of a
   task, in cells of CELL members at most, sketch by sketch, and those that pass are compared
   there as sets of 32-bit hashes (equal hashes can only raise the intersection). The best pair
   of each two components is verified; should one fail, all that pass are.
   So each pair that meets in a band is linked, joined by a path already, or refuted.

At similarity 0.8 a pair meets in no band with probability (1 - 0.8**6)**42 = 3e-6.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import arrow_rows, lookup, read_table, written
from .components import components

THRESHOLD = 0.8
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Six deviations of the estimate at the threshold.
MARGIN = 0.15
CELL = 1000
#: Sketches that a task makes at once.
SKETCH_ROWS = 2000
#: Rows of an Arrow batch: whole texts, or pairs with both sets.
BATCH_ROWS = 1000
#: Ids (8 bytes each) that are broadcast at most; more are joined by a shuffle.
MAX_IDS = 1_000_000

_U = np.uint64
_EMPTY = np.uint16(0xFFFF)


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, ascending; hashes before each text)."""
    words, first = tb.word_hashes(data, offs, tb.SPACED)
    n = np.diff(first)
    h = words
    for k in range(1, size):
        h = tb.pair_hash(h[:-1], words[k:]) if len(h) > 1 else h[:0]
    out, count = [], np.zeros(len(n), np.int64)
    for i, (a, m) in enumerate(zip(first[:-1].tolist(), n.tolist())):
        if m >= size:
            own = np.unique(h[a:a + m - size + 1])
        elif m:
            whole = words[a:a + 1]
            for k in range(1, m):
                whole = tb.pair_hash(whole, words[a + k:a + k + 1])
            own = tb.mix(whole + _U(m))  # a short text's only shingle is no part of a longer one's
        else:
            own = words[:0]
        count[i] = len(own)
        out.append(own)
    return (np.concatenate(out) if out else words[:0]), np.concatenate(([0], np.cumsum(count)))


def _probes() -> np.ndarray:
    """For each register, the buckets it borrows from, in order: independent
    random draws, then all buckets, so that the search always ends."""
    rng = np.random.default_rng(77)
    draws = rng.integers(0, REGISTERS, (REGISTERS, 3 * REGISTERS))
    return np.concatenate((np.arange(REGISTERS)[:, None], draws, np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1)), axis=1)


_PROBES: list[np.ndarray] = []


def sketch(sets: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Registers (u16) of each set, one row a set; an empty set's are all 0xFFFF."""
    if not _PROBES:
        _PROBES.append(_probes())
    n = len(before) - 1
    low = np.full((n, REGISTERS), np.iinfo(np.uint64).max, _U)
    row = np.repeat(np.arange(n), np.diff(before))
    h = tb.mix(sets ^ _U(0x5851F42D4C957F2D))
    bucket = ((h >> _U(32)) % _U(REGISTERS)).astype(np.int64)
    value = tb.mix(h + _U(0x14057B7EF767814F))
    at = row * REGISTERS + bucket
    order = np.argsort(at, kind="stable")
    at, value = at[order], value[order]
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    if len(cut):
        low.reshape(-1)[at[cut]] = np.minimum.reduceat(value, cut)
    full = low != np.iinfo(np.uint64).max
    # leading zeros, then MANTISSA bits after the first one
    top = (low >> _U(32)).astype(np.float64)
    bits = np.where(top > 0, np.frexp(top)[1] + 32, np.frexp((low & _U(0xFFFFFFFF)).astype(np.float64))[1])
    zeros = (64 - bits.astype(np.int64)).clip(0, 62)
    mantissa = (low << (zeros + 1).astype(_U)) >> _U(64 - MANTISSA)
    reg = (zeros << MANTISSA | mantissa.astype(np.int64)).astype(np.uint16)
    reg[~full] = _EMPTY
    some = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    probe = _PROBES[0]
    todo_r, todo_c = np.nonzero(~full[some])
    todo_r = some[todo_r]
    step = 1
    while len(todo_r):
        src = probe[todo_c, step]
        got = full[todo_r, src]
        reg[todo_r[got], todo_c[got]] = reg[todo_r[got], src[got]]
        todo_r, todo_c = todo_r[~got], todo_c[~got]
        step += 1
    return reg


def _chances() -> tuple[np.ndarray, np.ndarray]:
    """(log2 of the ratio of two sets' loads of a bucket, probability that a
    register of two disjoint such sets is equal): the same leading zeros, then
    the same mantissa. It depends on the ratio alone, but for a ripple that is averaged out."""
    z = 2.0 ** -np.arange(64)[:, None, None]
    ratio = np.linspace(0, 24, 97)
    load = 64 * 2.0 ** np.linspace(0, 1, 16, endpoint=False)[:, None]
    cell = lambda x: np.exp(-x * z / 2) - np.exp(-x * z)
    return ratio, (cell(load) * cell(load * 2.0 ** ratio)).sum(axis=0).mean(axis=0) * 2.0 ** -MANTISSA


_CHANCES = _chances()


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of n and m elements
    is equal by chance; a borrowed register counts as one of a full bucket."""
    a, b = np.maximum(n / REGISTERS, 1.0), np.maximum(m / REGISTERS, 1.0)
    return np.interp(np.abs(np.log2(a / b)), *_CHANCES)


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate of sketches (rows, or broadcast)."""
    e = chance(n, m)
    return ((x == y).mean(axis=-1) - e) / (1 - e)


def linked(inter: int, n: int, m: int, threshold: float) -> bool:
    """Jaccard of at least the threshold, in whole hundredths."""
    return 100 * inter >= round(100 * threshold) * (n + m - inter)


def _bands(reg: np.ndarray) -> np.ndarray:
    """64-bit hash of every band of each sketch."""
    r = reg.reshape(len(reg), BANDS, ROWS).astype(_U)
    h = np.broadcast_to(tb.mix(np.arange(BANDS, dtype=_U) + _U(1)), (len(reg), BANDS))
    for k in range(ROWS):
        h = tb.pair_hash(h, r[:, :, k])
    return h.view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, key (digest of the set, null if empty), reg (sketch)."""
    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text", most=SKETCH_ROWS):
                sets, before = shingle_sets(data, offs, size)
                n = np.diff(before)
                reg = sketch(sets, before).astype("<u2")
                raw, cuts = memoryview(sets.astype("<u8").tobytes()), (8 * before).tolist()
                keys = [hashlib.blake2b(raw[x:y], digest_size=16).digest() if y > x else None for x, y in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, b - a), "n_shingles": pa.array(n, pa.int64()),
                    "key": pa.array(keys, pa.binary()), "reg": pa.array([r.tobytes() for r in reg], pa.binary())})

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, key binary, reg binary")


def _among(rows: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``col`` is in ``ids`` (written, distinct, one column): no other text,
    set or sketch is shuffled or sorted after."""
    ids = ids.toDF(col)
    return rows.join(F.broadcast(ids) if ids.count() <= MAX_IDS else ids, col, "left_semi")


def _sets(ids: DataFrame, docs: DataFrame, size: int, short: bool = False) -> DataFrame:
    """doc_id, hashes (sorted, packed) of the documents in ``ids`` (as in ``_among``); ``short``:
    the upper 32 bits of the hashes only. doc_id is unique in ``docs``."""
    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                sets, before = shingle_sets(data, offs, size)
                if short:
                    sets = (sets >> _U(32)).astype("<u4")
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), "hashes": pa.array(
                    [sets[x:y].tobytes() for x, y in zip(before[:-1].tolist(), before[1:].tolist())], pa.binary())})

    return written(_among(docs, "doc_id", ids).mapInArrow(run, "doc_id long, hashes binary"), "shingle_sets")


def _ends(pairs: DataFrame, name: str) -> DataFrame:
    """The distinct ids of the pairs (a, b)."""
    return written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), name)


def _verify(pairs: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """Of the pairs (a, b: class ids), those whose full sets link. The sets are
    built again, for the documents that are in a pair."""
    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                at = np.minimum(np.searchsorted(p, q), max(len(p) - 1, 0))
                keep.append(bool(len(p)) and linked(int((p[at] == q).sum()), len(p), len(q), threshold))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(keep, pa.bool_()))

    sets = _sets(_ends(pairs, "set_ids"), docs, size)
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("sa")), "a")
                 .join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (written), those whose sizes and estimate allow the threshold."""
    classes = _among(classes, "cid", _ends(pairs, "estimated_ids"))
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("reg").alias(f"r{c}"))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
            n, m = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
            keep = estimate(x, y, n, m) >= threshold - MARGIN
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(keep))

    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * round(100 * threshold)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(fits).select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def _cells(open_rows: DataFrame, threshold: float, best: int | None) -> DataFrame:
    """Pairs across components, in the buckets that are still open: those whose
    estimate and whose sets of 32-bit hashes pass; all of them, or the ``best``
    of each two components that meet in a cell. Rows: band, cid, root, n, reg,
    hashes and m, the bucket's members. A bucket of more than CELL members is cut
    into chunks; each pair of chunks is a cell of its own."""
    rows = open_rows.withColumn("k", F.ceil(F.col("m") / CELL).cast("int")).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    key = ["band", "i", "j"]
    rows = rows.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "root", "n", "reg", "hashes")

    def cell(a: int, b: int, cols: dict) -> tuple[np.ndarray, np.ndarray]:
        cid, root, n, own = (cols[c][a:b] for c in ("cid", "root", "n", "own"))
        reg = np.frombuffer(b"".join(cols["reg"][a:b]), "<u2").reshape(-1, REGISTERS)
        inner, out = cols["i"][a] == cols["j"][a], []
        bands = _bands(reg)
        earlier = bands[:, :int(np.flatnonzero(bands[0] == cols["band"][a])[0])]  # a pair is judged where it first meets
        sizes = np.array([len(h) // 4 for h in cols["hashes"][a:b]])
        names, flat = np.unique(np.frombuffer(b"".join(cols["hashes"][a:b]), "<u4"), return_inverse=True)
        start, mark = np.cumsum(sizes) - sizes, np.zeros(len(names), bool)
        for x in range(b - a):
            y = np.flatnonzero((root != root[x]) & ((np.arange(b - a) > x) if inner else ((own[x] == cols["i"][a]) & (own == cols["j"][a]))))
            y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * round(100 * threshold)]
            y = y[~(earlier[y] == earlier[x]).any(axis=1)]
            if len(y):
                e = estimate(reg[y], reg[x], n[y].astype(np.float64), np.float64(n[x]))
                y = y[e >= threshold - MARGIN]
            if len(y):
                mine = flat[start[x]:start[x] + sizes[x]]
                mark[mine] = True
                both = np.add.reduceat(mark[flat[tb.ragged(start[y], sizes[y])]], np.cumsum(sizes[y]) - sizes[y], dtype=np.int64)
                mark[mine] = False
                union = n[y] + n[x] - both
                ok = 100 * both >= round(100 * threshold) * union
                out.append((np.full(int(ok.sum()), x), y[ok], both[ok] / np.maximum(union[ok], 1)))
        if not out:
            return cid[:0], cid[:0]
        x, y, e = (np.concatenate(v) for v in zip(*out))
        if best is not None:
            lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
            order = np.lexsort((-e, hi, lo))
            new = np.concatenate(([True], (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1])))
            place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            x, y = x[order][place < best], y[order][place < best]
        return np.minimum(cid[x], cid[y]), np.maximum(cid[x], cid[y])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def work(t: pa.Table, cuts: list[int]):
            cols = {c: t.column(c).to_numpy() for c in ("band", "cid", "root", "n", "own", "i", "j")} | {c: t.column(c).to_pylist() for c in ("reg", "hashes")}
            a, b = (np.concatenate(v) for v in zip(*(cell(x, y, cols) for x, y in zip(cuts[:-1], cuts[1:])))) if len(cuts) > 1 else ((), ())
            if len(a):
                both = np.unique(np.stack((a, b), axis=1), axis=0)
                yield pa.RecordBatch.from_pydict({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

        for batch in batches:  # a cell may go over several batches
            held.append(batch)
            t = pa.Table.from_batches(held)
            if not t.num_rows:
                continue
            cols = [t.column(c).to_numpy() for c in key]
            new = np.zeros(t.num_rows - 1, bool)
            for c in cols:
                new |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            yield from work(t, cuts)
            held = t.slice(cuts[-1]).to_batches()
        if held and (t := pa.Table.from_batches(held)).num_rows:
            yield from work(t, [0, t.num_rows])

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def identified(docs: DataFrame, id_col: str, taken: list[str]) -> tuple[DataFrame, str]:
    """(``docs``, a column that numbers their rows): ``id_col`` itself where no row repeats or lacks
    it, else a row number in a copy that is written once."""
    ids = docs.groupBy(F.col(id_col).cast("long").alias("id")).count().filter("count > 1 or id is null")
    if ids.isEmpty():
        return docs, id_col
    name = "row"
    while name in taken:
        name += "_"
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest
    doc_id that links reach, itself included), kept (doc_id = component_id).

    Null text and texts without words: 0 shingles, a component of their own.
    Rows with null doc_id cannot be named: component null, kept, no link. Rows that
    repeat a doc_id are compared each with its own text. An empty table gives no rows."""
    texts = _texts(docs, id_col, text_col)
    rows, number = identified(texts, "doc_id", texts.columns)
    if number == "doc_id":
        return _linked(texts, size, threshold)
    named, nameless = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    found = written(_linked(named.select(F.col(number).alias("doc_id"), "text"), size, threshold).join(
        named.select(F.col(number).alias("doc_id"), F.col("doc_id").alias("name")), "doc_id"), "row_components")
    least = found.groupBy("component_id").agg(F.min("name").alias("least"), F.count("*").alias("held"))
    out = lookup(found, written(least, "least_names"), "component_id", "held").select(
        F.col("name").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), (F.col("name") == F.col("least")).alias("kept"))
    none = signatures(nameless, size).select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(none)


def drop_near_duplicates(docs: DataFrame, size: int = 5, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, but for near copies: one row of each component stays, that
    of the smallest ``id_col`` (null last). Where rows repeat or lack it, each row is a document
    of its own; of a component's rows with the smallest id one stays. Rows without words stay."""
    rows, number = identified(docs, id_col, docs.columns)
    found = _linked(_texts(rows, number, text_col), size, threshold)
    if number == id_col:
        gone = found.filter("not kept").select(F.col("doc_id").alias("_gone"))
    else:
        named = written(found.select("component_id", F.col("doc_id").alias("row")).join(
            rows.select(F.col(number).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id")), "row"), "row_components")
        stays = named.groupBy("component_id").agg(F.min_by("row", "id").alias("stays"), F.count("*").alias("held")).filter("held > 1")
        gone = lookup(named, written(stays, "staying_rows"), "component_id", "held").filter("row <> stays").select(F.col("row").alias("_gone"))
    gone = written(gone, "near_copies")
    few = gone.count() <= MAX_IDS
    return rows.join(F.broadcast(gone) if few else gone, F.col(number).cast("long") == F.col("_gone"), "left_anti").select(*docs.columns)


def _linked(texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """``near_duplicates`` of texts whose doc_id is unique and never null."""
    with arrow_rows(texts.sparkSession, BATCH_ROWS):
        return _found(texts, size, threshold)


def _found(texts: DataFrame, size: int, threshold: float) -> DataFrame:
    sig = written(signatures(texts, size), "signatures")
    named = sig.filter("key is not null")
    classes = written(named.groupBy("key").agg(F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n"), F.first("reg").alias("reg"), F.count("*").alias("held")), "set_classes")

    def bands(batches):
        for batch in batches:
            reg = np.frombuffer(b"".join(batch.column("reg").to_pylist()), "<u2").reshape(-1, REGISTERS)
            h = _bands(reg)
            yield pa.RecordBatch.from_pydict({"cid": pa.array(np.repeat(batch.column("cid").to_numpy(), BANDS), pa.int64()), "band": pa.array(h.reshape(-1), pa.int64())})

    banded = classes.select("cid", "reg").mapInArrow(bands, "cid long, band long")
    hubs = written(banded.groupBy("band").agg(F.min("cid").alias("hub"), F.count("*").alias("m")).filter("m > 1"), "shared_buckets")
    met = written(lookup(banded, hubs, "band", "m").filter("hub is not null"), "met")  # members of shared buckets
    star = written(met.filter("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct(), "star")
    by_id = classes.select("cid", "n", "reg")
    links = written(_verify(written(_estimated(star, by_id, threshold), "star_pairs"), texts, size, threshold), "star_links")
    roots = components(links)

    # the best pairs of each two components; should one of them fail in full, all pairs that are left
    for best in (1, None):
        placed = met.filter("m > 2").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
            "band", "cid", "hub", F.coalesce("root", "cid").alias("root"))
        # a bucket's pairs with its smallest member are done; so is the bucket if the others are of one component
        rest = written(placed.filter("cid <> hub").drop("hub"), "placed")
        split = written(rest.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m")).filter("lo <> hi").select("band", "m"), "open_bands")
        still = written(lookup(rest, split.withColumn("held", F.col("m")), "band", "held").filter("m is not null").drop("held"), "open_buckets")
        ids = written(still.select("cid").distinct(), "set_ids")
        sets = _sets(ids, texts, size, short=True).withColumnRenamed("doc_id", "cid")
        more = written(_cells(still.join(_among(by_id, "cid", ids), "cid").join(sets, "cid"), threshold, best), "cross_pairs")
        found = written(_verify(more, texts, size, threshold), "cross_links")
        links = links.union(found)
        roots = components(links)
        if found.count() == more.count():
            break

    of_class = written(classes.select("key", "cid", "held").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", F.coalesce("root", "cid").alias("root"), "held"), "class_roots")
    slim = sig.select("doc_id", "n_shingles", "key")
    out = lookup(slim.filter("key is not null"), of_class, "key", "held").drop("held").unionByName(
        slim.filter("key is null").withColumn("root", F.col("doc_id")))
    return out.select("doc_id", "n_shingles", F.col("root").alias("component_id"), (F.col("doc_id") == F.col("root")).alias("kept"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, two-word shingles, similarity 0.8."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), size=2)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
                                      ELSE list_transform(range(1, len(w)), lambda i: w[i:i + 1]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
ids AS (SELECT g, row_number() OVER () AS k FROM (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
k AS (SELECT doc_id, k FROM s JOIN ids USING (g)),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM k a JOIN k b USING (k) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM root LEFT JOIN n USING (doc_id)
"""
