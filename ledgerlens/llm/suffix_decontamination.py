"""Benchmark decontamination with suffix arrays over the training documents.

Documents are taken a shard (slice of 2 MB of text) at a time. A shard's
suffix array covers every stretch of words that all occur in the benchmark; a
suffix that starts anywhere else cannot match. Every benchmark suffix that
holds a whole window is binary-searched in it; the range found gives all
verbatim occurrences. Each is then looked up among the block's suffixes that start with its
window, in their own suffix order: the longest match is with one of its two
neighbours there. Common prefixes are measured by names of stretches of 1, 2, 4, ... words, so neither a passage
that many items and documents share nor a long match costs more than its occurrences, but
for logarithms. No shuffle: a document is judged where it is read.

The benchmark is the query set. It is taken in blocks of about BLOCK_BYTES of text (items that repeat as a
whole count once), collected one at a time and broadcast; a worker searches them one after the other.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is
``window`` consecutive words of an item; an item of fewer words, but not none,
is one window. Null text has no words; a null item_id names no item (its
passages still count as hits); items that share an item_id count once. An empty
benchmark contaminates nothing; empty documents give no rows; rows that repeat
are judged each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import read_table

WINDOW = 10
BLOCK_BYTES = 2 << 20


class Block:
    """Searchable form of some benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        names = sorted({i for i, _ in items if i is not None})
        place = {n: k for k, n in enumerate(names)}
        self.names = names
        data, offs = tb.spans(pa.array([t for _, t in items], pa.string()))
        words, first = tb.word_hashes(data, offs, tb.ALNUM)
        self.vocab, seq = np.unique(words, return_inverse=True)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.vocab & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        length = np.diff(first)
        span = np.minimum(length, window)
        count = np.where(length > 0, length - span + 1, 0)
        self.window, self.least = window, int(span[span > 0].min()) if (span > 0).any() else 0
        at = tb.ragged(first[:-1], count)
        item = np.repeat(np.arange(len(items)), count)
        size = span[item]
        rows = np.concatenate((seq, np.full(window, -2)))[at[:, None] + np.arange(window)]
        rows[np.arange(window) >= size[:, None]] = -2
        self.rows, inverse = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        inverse = inverse.reshape(-1)
        self.size = (self.rows != -2).sum(axis=1)
        # names of all stretches of 1, 2, 4, ... words: equal names, equal words; -1 across an item's end
        n, item_of = len(seq), np.repeat(np.arange(len(items)), length)
        self.place = np.arange(n) + item_of                 # with a separator behind each item
        flat = np.full(n + len(items) + 1, -1, np.int64)
        flat[self.place] = seq
        self.names_at, self.keys, h = [flat.astype(np.int32)], [], 1
        while 2 * h <= int(length.max(initial=0)):
            key = _pairs(self.names_at[-1], h)
            self.keys.append(np.unique(key[key >= 0]))
            self.names_at.append(_name(self.keys[-1], key))
            h *= 2
        # suffixes and items of each distinct window, the suffixes in their own order
        rank = np.empty(len(flat), np.int64)
        rank[suffix_array(flat, int(length.max(initial=0)) + 1)] = np.arange(len(flat))
        order = np.lexsort((rank[self.place[at]], inverse)) if len(at) else np.zeros(0, np.int64)
        self.suffix_at = np.searchsorted(inverse[order], np.arange(len(self.rows) + 1))
        self.suffix = self.place[at[order]]
        self.item = np.array([place.get(items[k][0], -1) for k in item[order].tolist()], np.int64)


def _pairs(names: np.ndarray, h: int) -> np.ndarray:
    """Key of the names at each place and ``h`` places on; -1 where either is missing."""
    a, b = names.astype(np.int64), np.full(len(names), -1, np.int64)
    b[:max(len(names) - h, 0)] = names[h:]
    return np.where((a >= 0) & (b >= 0), a << 32 | np.maximum(b, 0), -1)


def _name(keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each key among ``keys``, -1 if absent."""
    if not len(keys):
        return np.full(len(key), -1, np.int32)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where((key >= 0) & (keys[at] == key), at, -1).astype(np.int32)


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``s`` in order of their first ``depth`` symbols at least
    (prefix doubling)."""
    n, h = len(s), 1
    order = np.argsort(s, kind="stable")
    while True:
        key = s if h == 1 else key
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if h >= depth or (n and rank[order[-1]] == n - 1):
            return order
        key = rank * (n + 1)
        key[:-h] += rank[h:] + 1
        order = np.argsort(key, kind="stable")
        h *= 2


def _bounds(s: np.ndarray, sa: np.ndarray, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[lo, hi) in ``sa`` of the suffixes that start with each row's words."""
    width = np.arange(rows.shape[1])
    head = s[sa]
    first = np.searchsorted(head, rows[:, 0]), np.searchsorted(head, rows[:, 0], "right")
    live = np.flatnonzero(first[0] < first[1])
    out = []
    for upper in (False, True):
        lo, hi = first[0].copy(), first[1].copy()
        act = live
        while len(act):
            mid = (lo[act] + hi[act]) // 2
            mine, theirs = s[sa[mid][:, None] + width], rows[act]
            differ = (mine != theirs) & (width < size[act][:, None])
            k = differ.argmax(axis=1)
            at = np.arange(len(act))
            less = mine[at, k] < theirs[at, k]
            less = np.where(differ[at, k], less, upper)
            lo[act] = np.where(less, mid + 1, lo[act])
            hi[act] = np.where(less, hi[act], mid)
            act = act[lo[act] < hi[act]]
        out.append(lo)
    lo, hi = out
    hi[first[0] >= first[1]] = lo[first[0] >= first[1]]
    return lo, hi


def _common(block: Block, text: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Words that the shard from place ``p`` and the block from place ``q`` have in common."""
    n = np.zeros(len(p), np.int64)
    for k in range(len(text) - 1, -1, -1):
        a = text[k][np.minimum(p + n, len(text[k]) - 1)]
        n += (1 << k) * ((a >= 0) & (a == block.names_at[k][np.minimum(q + n, len(block.names_at[k]) - 1)]))
    return n


def longest(block: Block, s: np.ndarray, p: np.ndarray, win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, suffix) of a longest match of each occurrence ``p`` of a window ``win`` in the shard ``s``."""
    text = [s.astype(np.int32)]
    for k, keys in enumerate(block.keys):
        text.append(_name(keys, _pairs(text[-1], 1 << k)))
    lo, hi = block.suffix_at[win].copy(), block.suffix_at[win + 1].copy()
    least, most = lo.copy(), hi - 1
    act = np.flatnonzero(lo < hi)
    while len(act):                                # first suffix of the group that is not below the text
        mid = (lo[act] + hi[act]) // 2
        q = block.suffix[mid]
        n = _common(block, text, p[act], q)
        below = block.names_at[0][q + n] < s[np.minimum(p[act] + n, len(s) - 1)]
        lo[act] = np.where(below, mid + 1, lo[act])
        hi[act] = np.where(below, hi[act], mid)
        act = act[lo[act] < hi[act]]
    one, two = np.maximum(lo - 1, least), np.minimum(lo, most)
    a, b = _common(block, text, p, block.suffix[one]), _common(block, text, p, block.suffix[two])
    return np.maximum(a, b), np.where(a > b, one, two)


def search(block: Block, data: np.ndarray, offs: np.ndarray, hits_only: bool = False) -> dict[str, np.ndarray]:
    """One shard against one block. ``words``: words before each text;
    ``hit``: the words inside of an occurrence; ``set_doc``, ``set_of``: the texts that hold windows, and
    which of ``sets`` (arrays of items) each has; ``long_doc``, ``long_n``, ``long_at``, ``long_item``: a
    longest match of each text that has one (at its earliest place). ``hits_only``: the first two."""
    words, first = tb.word_hashes(data, offs, tb.ALNUM)
    none = np.zeros(0, np.int64)
    out = {"words": first, "hit": np.zeros(len(words), bool), "set_doc": none, "set_of": none, "sets": [],
           "long_doc": none, "long_n": none, "long_at": none, "long_item": none}
    if not block.least or not len(words):
        return out
    ids = np.full(len(words), -1, np.int64)
    maybe = np.flatnonzero(block.bits[(words & np.uint64((1 << 20) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(block.vocab, words[maybe]), len(block.vocab) - 1)
    same = block.vocab[at] == words[maybe]
    ids[maybe[same]] = at[same]
    # stretches of benchmark words inside of one text
    inside = ids >= 0
    edge = np.zeros(len(words) + 1, bool)
    edge[first] = True
    start = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | edge[:-1]))
    end = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | edge[1:])) + 1
    use = end - start >= block.least
    start, end = start[use], end[use]
    if not len(start):
        return out
    size = end - start + 1  # with a separator
    place = tb.ragged(start, size)
    last = np.cumsum(size) - 1
    s = np.concatenate((ids[np.minimum(place, len(ids) - 1)], np.full(block.window, -1)))
    s[last] = -1
    sa = suffix_array(s[:len(place)], block.window)
    lo, hi = _bounds(s, sa, block.rows, block.size)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return out
    count = hi[found] - lo[found]
    pos = sa[tb.ragged(lo[found], count)]  # every occurrence of every window
    win = np.repeat(found, count)
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, pos, 1)
    np.add.at(cover, pos + block.size[win], -1)
    covered = np.cumsum(cover)[:len(place)] > 0
    out["hit"][place[covered]] = True
    if hits_only:
        return out
    # the windows of each document; documents with the same windows have the same items
    doc = np.searchsorted(first, place[pos], "right") - 1
    pairs = np.unique(np.stack((doc, win), axis=1), axis=0)
    cut = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] != pairs[:-1, 0])))
    known: dict[bytes, int] = {}
    of = []
    for own in np.split(pairs[:, 1], cut[1:]):
        key = own.tobytes()
        if key not in known:
            known[key] = len(known)
            items = block.item[tb.ragged(block.suffix_at[own], block.suffix_at[own + 1] - block.suffix_at[own])]
            out["sets"].append(np.unique(items[items >= 0]))
        of.append(known[key])
    out["set_doc"], out["set_of"] = pairs[cut, 0], np.array(of)
    n, suf = longest(block, s, pos, win)
    at = place[pos] - first[doc]
    order = np.lexsort((at, -n, doc))
    best = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))]
    out["long_doc"], out["long_n"], out["long_at"], out["long_item"] = doc[best], n[best], at[best], block.item[suf][best]
    return out


def blocks(benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES, id_col: str = "item_id", text_col: str = "text") -> list:
    """The benchmark as broadcast blocks, one collected at a time. Rows that repeat count once,
    so they cannot fill a block."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // limit)
    rows = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1))))
    out = []
    for k in range(n):
        block = Block([(r.i, r.t) for r in rows.filter(F.col("b") == k).toLocalIterator()], window)
        if block.least:
            out.append(spark.sparkContext.broadcast(block))
    return out


def judge(docs: DataFrame, parts: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated; longest, longest_at, longest_item: the longest verbatim
    match in words, the word it starts at and an item it is of (0 and nulls
    without a window's match)."""

    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                n = b - a
                hit, held = None, [()] * n                      # of each text: (block, item set)
                found: list[list[np.ndarray]] = []
                long = [(0, None, None)] * n
                first = None
                for b_at, part in enumerate(parts):
                    block = part.value
                    r = search(block, data, offs)
                    found.append(r["sets"])
                    first, hit = r["words"], r["hit"] if hit is None else hit | r["hit"]
                    for d, i in zip(r["set_doc"].tolist(), r["set_of"].tolist()):
                        held[d] += ((b_at, i),)
                    for d, m, at, i in zip(*(r[k].tolist() for k in ("long_doc", "long_n", "long_at", "long_item"))):
                        mine = (m, at, block.names[i] if i >= 0 else None)
                        if (-mine[0], mine[1], mine[2] or "") < (-long[d][0], long[d][1] or 0, long[d][2] or ""):
                            long[d] = mine
                if first is None:
                    first = tb.word_spans(data, offs, tb.ALNUM)[2]
                    hit = np.zeros(int(first[-1]), bool)
                before = np.concatenate(([0], np.cumsum(hit)))
                n_hit = np.diff(before[first])
                listed = {}                                     # items of texts with the same sets are hashed once
                for key in set(held):
                    names = sorted({parts[k].value.names[x] for k, i in key for x in found[k][i].tolist()})
                    listed[key] = len(names), hashlib.sha256(",".join(names).encode()).hexdigest()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, n), "n_words": pa.array(np.diff(first), pa.int64()),
                    "n_hit": pa.array(n_hit, pa.int64()), "n_items": pa.array([listed[k][0] for k in held], pa.int64()),
                    "items_sha256": pa.array([listed[k][1] for k in held], pa.string()), "contaminated": pa.array(n_hit > 0),
                    "longest": pa.array([x[0] for x in long], pa.int64()), "longest_at": pa.array([x[1] for x in long], pa.int64()),
                    "longest_item": pa.array([x[2] for x in long], pa.string())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
             "longest long, longest_at long, longest_item string")


def remove_contaminated(docs: DataFrame, parts: list, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window."""

    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, text_col):
                keep = np.ones(b - a, bool)
                for part in parts:
                    r = search(part.value, data, offs, hits_only=True)
                    keep &= np.diff(np.concatenate(([0], np.cumsum(r["hit"])))[r["words"]]) == 0
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema) if parts else docs


def op6_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against all of ``benchmark``, windows of 10 words."""
    return judge(read_table(spark, sf_dir, "documents"), blocks(read_table(spark, sf_dir, "benchmark"))).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
occ AS (
  SELECT x.doc_id, x.i, x.n, win.item_id
  FROM (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n) x
  JOIN win ON win.n = x.n AND win.g = x.w[x.i:x.i + x.n - 1]),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
