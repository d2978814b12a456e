"""Token-ID output in patched frame-of-reference (PFOR) blocks.

``encode_table`` tokenizes whole texts, appends the end id and writes *segments*: one
Parquet row each, whose ``payload`` is the binary format below. Segments of a
range of doc_id hold its documents in ascending doc_id order (null first; rows
that repeat a doc_id by text); ranges are numbered ascending. ``read_table``
reads the files back and gives each document's place and ids.

Segment payload, little-endian:

    magic "PFR1" | n_ids u32 | n_blocks u32
    index: n_blocks x (byte offset u32 of the block's words, first exception u32)
    head:  n_blocks x (minimum u32, width u8)
    words: per block, BLOCK values at ``width`` bits as u64 words
    exceptions: n_exceptions u32, then u32 position in the segment | u32 value

A block holds BLOCK ids (the last is padded with its minimum). Its width is
what the PERCENTILE of the block's offsets from its minimum needs; larger
offsets are exceptions: their low bits are zero in the words and the whole
offset stands in the exception list. A block's words and exceptions start where
its index says, so a reader can open any block alone (``read_block``).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import scratch

BLOCK = 128
PERCENTILE = 90
END_ID = 0
#: Rows of 12 bytes that are broadcast at most.
MAX_RANGES = 500_000
SPECIAL = b"<|endoftext|>"
_M = 0xFFFFFFFF


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """Rows of BLOCK values below 2**w -> rows of 2*w u64 words."""
    out = np.zeros((BLOCK * w // 64, len(v)), np.uint64)
    for i, col in enumerate(np.ascontiguousarray(v.T)):
        word, shift = divmod(i * w, 64)
        out[word] |= col << np.uint64(shift)
        if shift + w > 64:
            out[word + 1] |= col >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, w: int) -> np.ndarray:
    cols = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, len(words)), np.uint64)
    mask = np.uint64((1 << w) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * w, 64)
        col = cols[word] >> np.uint64(shift)
        if shift + w > 64:
            col |= cols[word + 1] << np.uint64(64 - shift)
        out[i] = col & mask
    return out.T


def encode_ids(ids: np.ndarray) -> bytes:
    """PFOR payload of a sequence of ids below 2**32."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    v = np.zeros(blocks * BLOCK, np.uint32)
    v[:n] = ids
    if n:
        v[n:] = v[(blocks - 1) * BLOCK:n].min()
    v = v.reshape(blocks, BLOCK)
    low = v.min(axis=1) if blocks else np.zeros(0, np.uint32)
    v = v - low[:, None]
    rank = (BLOCK * PERCENTILE + 99) // 100 - 1
    cut = np.partition(v, rank, axis=1)[:, rank] if blocks else low
    width = np.zeros(blocks, np.uint8)
    width[cut > 0] = np.floor(np.log2(cut[cut > 0].astype(np.float64))).astype(np.uint8) + 1
    over = v >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    row, col = np.nonzero(over)
    exc = np.empty((len(row), 2), "<u4")
    exc[:, 0] = row * BLOCK + col
    exc[:, 1] = v[row, col]
    v[row, col] = 0
    words = width.astype(np.int64) * (BLOCK // 64)
    at = np.cumsum(words) - words
    flat = np.zeros(int(words.sum()), "<u8")
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            flat[(at[own][:, None] + np.arange(w * BLOCK // 64)).ravel()] = _pack(v[own].astype(np.uint64), w).ravel()
    index = np.empty((blocks, 2), "<u4")
    index[:, 0] = at * 8
    index[:, 1] = np.searchsorted(row, np.arange(blocks))
    return b"".join((b"PFR1", struct.pack("<II", n, blocks), index.tobytes(), low.astype("<u4").tobytes(),
                     width.tobytes(), flat.tobytes(), struct.pack("<I", len(exc)), exc.tobytes()))


def _open(payload: bytes):
    if payload[:4] != b"PFR1":
        raise ValueError("not a PFOR segment")
    n, blocks = struct.unpack_from("<II", payload, 4)
    at = 12
    index = np.frombuffer(payload, "<u4", 2 * blocks, at).reshape(blocks, 2)
    low = np.frombuffer(payload, "<u4", blocks, at + 8 * blocks)
    width = np.frombuffer(payload, np.uint8, blocks, at + 12 * blocks)
    at += 13 * blocks
    words = int(width.astype(np.int64).sum()) * (BLOCK // 64)
    flat = np.frombuffer(payload, "<u8", words, at)
    at += 8 * words
    (k,) = struct.unpack_from("<I", payload, at)
    exc = np.frombuffer(payload, "<u4", 2 * k, at + 4).reshape(k, 2)
    return n, index, low, width, flat, exc


def decode_ids(payload: bytes) -> np.ndarray:
    """All ids (u32) of a payload."""
    n, index, low, width, flat, exc = _open(payload)
    v = np.zeros((len(low), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            words = flat[(index[own, 0].astype(np.int64)[:, None] // 8 + np.arange(w * BLOCK // 64))]
            v[own] = _unpack(words, w)
    v.reshape(-1)[exc[:, 0]] = exc[:, 1]
    return (v + low[:, None]).reshape(-1)[:n]


def read_block(payload: bytes, block: int) -> np.ndarray:
    """Ids of one block, found by the index."""
    n, index, low, width, flat, exc = _open(payload)
    w, at = int(width[block]), int(index[block, 0]) // 8
    v = _unpack(flat[None, at:at + w * BLOCK // 64], w)[0].astype(np.uint32) if w else np.zeros(BLOCK, np.uint32)
    end = int(index[block + 1, 1]) if block + 1 < len(low) else len(exc)
    own = exc[int(index[block, 1]):end]
    v[own[:, 0] - block * BLOCK] = own[:, 1]
    return (v + low[block])[:n - block * BLOCK]


_STATE: dict = {}


def _encoder(tokenizer: str):
    """(chunk pool, chunk encoder) of the tokenizer file, once a worker."""
    if tokenizer not in _STATE:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(tokenizer)
        t.no_truncation()
        t.no_padding()

        def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = [e.ids for e in t.encode_batch_fast(chunks, add_special_tokens=False)]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((x for i in ids for x in i), np.uint32, int(size.sum()))
            return size, flat.astype(np.uint16) if t.get_vocab_size() <= 1 << 16 else flat

        _STATE[tokenizer] = tb.ChunkPool(), encode
    return _STATE[tokenizer]


SEGMENT_SCHEMA = "part int, seq int, n_docs int, in_part long, n_ids long, ids_of binary, lens binary, payload binary"


def encode_table(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize ``docs`` and write the segments to ``path``.

    One range shuffle on the id; a range's rows are sorted and tokenized a
    slice (2 MB of text) at a time, each slice a segment. Null text: the end id
    alone. Empty table: no segments. Null ids come first."""

    def run(batches):
        from pyspark import TaskContext
        part, seq, in_part = TaskContext.get().partitionId(), 0, 0
        pool, encode = _encoder(tokenizer)
        for batch in batches:
            known, ids64 = batch.column(0).is_valid(), batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            known = known.to_numpy(zero_copy_only=False)
            for a, b, data, offs in tb.slices(batch, "text"):
                flat, before = tb.encode_slice(pool, encode, data, offs, SPECIAL)
                lens = np.diff(before)
                out = np.full(len(flat) + b - a, END_ID, np.uint32)
                out[np.arange(len(flat)) + np.repeat(np.arange(b - a), lens)] = flat
                # ids of the documents, with a flag byte for null
                who = known[a:b].astype(np.uint8).tobytes() + ids64[a:b].astype("<i8").tobytes()
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                    "n_docs": pa.array([b - a], pa.int32()), "in_part": pa.array([in_part], pa.int64()), "n_ids": pa.array([len(out)], pa.int64()),
                    "ids_of": pa.array([who], pa.binary()), "lens": pa.array([encode_ids(lens + 1)], pa.binary()),
                    "payload": pa.array([encode_ids(out)], pa.binary())})
                seq, in_part = seq + 1, in_part + len(out)

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
         .repartitionByRange(F.col("doc_id").asc_nulls_first())
         .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
         .mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``base``: the ids before the segment. A segment knows the
    ids before it in its range; the ranges' totals are one row per range, summed in
    one task and sent to the segments, which stay where they are (up to
    MAX_RANGES ranges; beyond that, an ordinary join)."""
    seg = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = seg.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    if parts.count() <= MAX_RANGES:
        bases = F.broadcast(bases)
    return seg.join(bases, "part").withColumn("base", F.col("part_base") + F.col("in_part"))


def digest(segments: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def run(batches):
        for batch in batches:
            for who, lens, payload, base in zip(*(batch.column(c).to_pylist() for c in ("ids_of", "lens", "payload", "base"))):
                n = len(who) // 9
                size = decode_ids(lens).astype(np.int64)
                end = np.cumsum(size)
                raw = memoryview(decode_ids(payload).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - s):4 * e]) & _M for s, e in zip(size.tolist(), end.tolist())]
                ids = np.frombuffer(who, "<i8", n, n)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64(), mask=np.frombuffer(who, np.uint8, n) == 0),
                    "start": pa.array(base + end - size, pa.int64()), "n_tokens": pa.array(size, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})

    return segments.select("ids_of", "lens", "payload", "base").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def documents_ids(segments: DataFrame) -> DataFrame:
    """doc_id, start and the ids themselves (array<long>)."""

    def run(frames):
        for f in frames:
            for who, lens, payload, base in zip(f.ids_of, f.lens, f.payload, f.base):
                n = len(who) // 9
                size = decode_ids(lens).astype(np.int64)
                at = np.cumsum(size)
                parts = np.split(decode_ids(payload).astype(np.int64), at[:-1])
                ids = pd.array(np.frombuffer(who, "<i8", n, n), "Int64")
                ids[np.frombuffer(who, np.uint8, n) == 0] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "start": base + at - size, "ids": parts})

    return segments.select("ids_of", "lens", "payload", "base").mapInPandas(run, "doc_id long, start long, ids array<long>")


def op1_pfor_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` written as PFOR segments and digested from them."""
    import public_tokenizers
    path = scratch(spark, "pfor")
    encode_table(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return digest(read_segments(spark, path))
