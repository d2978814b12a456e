"""Alignment of two tokenizers' tokens, by divide and conquer at shared cuts.

Space + text is encoded by a byte-level BPE (A) and the text by a piece BPE (B, which
adds the space itself). Byte offsets at which a token of either ends are shared cuts;
they split a text's tokens into groups. ``shared_cuts`` finds them by
dividing: in an interval of tokens it takes the A end in the middle, bisects B's ends
for it, and steps outward until an end is shared; the interval is cut there and both
halves are taken up again. An interval without a shared end inside is a leaf: a
group. All intervals of a slice are divided at the same time, one level after the other.

A group's last A and last B token end together: a link. How often an id pair is linked
is counted over the whole corpus, each text's distinct pairs being summed first.
``score_links`` brings the counts back to the texts: a broadcast if the table of
pairs is small, else pairs of many texts by broadcast (their number is
bounded by the number of links over HOT) and the rest by a shuffle.

Memory follows the slice (BLOCK_BYTES of text, or one longer text).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import lookup, read_table, written
from .pair_index_bpe import byte_letters

#: Tokens whose decimal ids are written out at once for a digest.
PIECE = 1 << 18
#: Bytes of text that are aligned at once (a longer text is taken whole).
BLOCK_BYTES = 512 << 10
#: Chunks that each side keeps encoded, in a Python worker.
POOL = 300_000
#: A tokens of an interval that is not divided any more.
SHORT = 16


@dataclass
class Side:
    """One tokenizer: chunk encoder, and the bytes of each id."""
    encode: object
    cut: object
    pool: tb.ChunkPool
    start: np.ndarray
    size: np.ndarray
    data: np.ndarray


def _side(encode, cut, pieces: list[bytes]) -> Side:
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return Side(encode, cut, tb.ChunkPool(most=POOL), np.cumsum(size) - size, size, np.frombuffer(b"".join(pieces), np.uint8))


def _flat(ids: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return size, np.fromiter((x for i in ids for x in i), np.uint16 if n <= 1 << 16 else np.uint32, int(size.sum()))


def byte_level(path: str) -> Side:
    """A: a byte-level BPE file. Special tokens' texts are ordinary text."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    n = max(t.get_vocab_size(), max(vocab.values()) + 1)
    pieces = [b""] * n
    for text, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
    return _side(lambda chunks: _flat([e.ids for e in t.encode_batch_fast(chunks, add_special_tokens=False)], n), None, pieces)


def _space_cut(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A chunk starts with each run of spaces and with each text."""
    start = np.zeros(len(data), bool)
    start[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    start[offs[offs < len(data)]] = True
    return np.flatnonzero(start)


def pieces(path: str) -> Side:
    """B: a piece BPE model that adds a space. No piece holds a space behind another
    character (checked), so no merge crosses from a word into the spaces
    after it, and words may be encoded apart."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    out = []
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(bytes([int(p[3:5], 16)]))
        else:
            out.append(p.replace("▁", " ").encode())
            if not sp.is_control(i) and not sp.is_unknown(i) and "▁" in p.lstrip("▁"):
                raise ValueError("a piece goes on after a space")
    space = sp.piece_to_id("▁")

    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the model adds the first space again, but not to an empty string
        return _flat([i if c != " " else [space] for c, i in zip(chunks, sp.encode([c[1:] for c in chunks], num_threads=1))], n)

    return _side(encode, _space_cut, out)


def shared_cuts(ea: np.ndarray, eb: np.ndarray, na: np.ndarray, nb: np.ndarray, short: int = SHORT) -> tuple[np.ndarray, np.ndarray]:
    """(A indices, B indices) of all tokens that end together, ascending.

    ``ea``, ``eb``: ends of all tokens, ascending over all texts; ``na``, ``nb``:
    tokens before each text. The last tokens of a text end together. Intervals of at most
    ``short`` A tokens are not divided: all of their ends are bisected."""
    some = np.flatnonzero(na[1:] > na[:-1])
    a0, a1, b0, b1 = na[some], na[some + 1], nb[some], nb[some + 1]
    cut_a, cut_b = [a1 - 1], [b1 - 1]

    def shared(probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(B index at or behind each A end, those that are equal)"""
        place = np.searchsorted(eb, ea[probe])
        return place, np.flatnonzero(eb[np.minimum(place, len(eb) - 1)] == ea[probe])

    while len(open_ := np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1))):
        a0, a1, b0, b1 = a0[open_], a1[open_], b0[open_], b1[open_]
        few = a1 - a0 <= short
        if few.any():
            probe = tb.ragged(a0[few], a1[few] - a0[few] - 1)
            place, hit = shared(probe)
            cut_a.append(probe[hit])
            cut_b.append(place[hit])
            a0, a1, b0, b1 = (x[~few] for x in (a0, a1, b0, b1))
        mid = (a0 + a1 - 2) >> 1
        at_a, at_b = np.full(len(mid), -1), np.full(len(mid), -1)
        look, near, far = np.arange(len(mid)), 0, 1
        while len(look):
            # the ends ``near`` to ``far`` - 1 tokens before and behind the middle
            m, low, high = mid[look], a0[look], a1[look] - 2
            left0, left1 = np.maximum(m - far + 1, low), np.maximum(m - near + 1, low)
            right0, right1 = np.minimum(m + max(near, 1), high + 1), np.minimum(m + far, high + 1)
            n_left, n_right = left1 - left0, np.maximum(right1 - right0, 0)
            who = np.concatenate((np.repeat(np.arange(len(look)), n_left), np.repeat(np.arange(len(look)), n_right)))
            probe = np.concatenate((tb.ragged(left0, n_left), tb.ragged(right0, n_right)))
            place, hit = shared(probe)
            if len(hit):
                hit = hit[np.lexsort((probe[hit], np.abs(probe[hit] - m[who[hit]]), who[hit]))]
                first = hit[np.concatenate(([True], who[hit][1:] != who[hit][:-1]))]
                at_a[look[who[first]]], at_b[look[who[first]]] = probe[first], place[first]
            look = look[(at_a[look] < 0) & ((m - far >= low) | (m + far <= high))]
            near, far = far, far * 4
        found = np.flatnonzero(at_a >= 0)          # the others are leaves
        a0, a1, b0, b1, at_a, at_b = (x[found] for x in (a0, a1, b0, b1, at_a, at_b))
        cut_a.append(at_a)
        cut_b.append(at_b)
        halves = lambda lo, cut, hi: (np.stack((lo, cut + 1), 1).ravel(), np.stack((cut + 1, hi), 1).ravel())
        a0, a1 = halves(a0, at_a, a1)              # in order, so that bisecting runs through B's ends once
        b0, b1 = halves(b0, at_b, b1)
    return np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))


def _tokens(side: Side, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ids before each text, texts whose tokens' bytes make up the text)."""
    ids, before = tb.encode_slice(side.pool, side.encode, data, offs, cut=side.cut)
    edge = np.concatenate(([0], np.cumsum(side.size[ids])))
    size = np.diff(offs)
    same = np.diff(edge[before]) == size
    own = np.flatnonzero(same)
    ids_in = ids[np.repeat(same, np.diff(before))]
    joined = side.data[tb.ragged(side.start[ids_in], side.size[ids_in])]
    unlike = np.flatnonzero(joined != data[tb.ragged(offs[own], size[own])])
    same[own[np.searchsorted(np.cumsum(size[own]), unlike, "right")]] = False
    return ids, before, same


def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, size and bytes of ``id,`` for each id."""
    text = [b"%d," % i for i in range(n)]
    size = np.fromiter(map(len, text), np.int64, n)
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(text), np.uint8)


def _digests(digits, seq: np.ndarray, mark: np.ndarray, before: np.ndarray) -> list[str]:
    """SHA-256 of each text's ids, written in decimal with ``mark`` behind each (but the last)."""
    start, size, data = digits
    out = [hashlib.sha256() for _ in range(len(before) - 1)]
    for x in range(0, len(seq), PIECE):
        y = min(x + PIECE, len(seq))
        own = seq[x:y]
        text = data[tb.ragged(start[own], size[own])]
        end = np.cumsum(size[own])
        text[end - 1] = mark[x:y]
        view, end = memoryview(text), np.concatenate(([0], end))
        first, last = int(np.searchsorted(before, x, "right")) - 1, int(np.searchsorted(before, y, "left"))
        for t in range(first, last):
            a, b = max(int(before[t]), x), min(int(before[t + 1]), y)
            if a < b:
                out[t].update(view[end[a - x]:end[b - x] - (b == before[t + 1])])
    return [h.hexdigest() if a < b else "" for h, a, b in zip(out, before[:-1].tolist(), before[1:].tolist())]


_STATE: dict = {}


def _state(path_a: str, path_b: str):
    if (path_a, path_b) not in _STATE:
        a, b = byte_level(path_a), pieces(path_b)
        _STATE[path_a, path_b] = a, b, _digits(max(len(a.size), len(b.size)))
    return _STATE[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, without a shuffle: doc_id, n_a, n_b, n_groups,
    groups_sha256 (of ``a1,a2|b1;a3|b2,b3``), and its links as ``pairs`` (distinct, ascending:
    A id * size of B's vocabulary + B id) with ``times``. With ``keep_groups`` also the
    ids (a_ids, b_ids) and the tokens before the end of each group (a_cuts, b_cuts).

    A text that is null, empty, or not equal to its joined tokens on either side has no
    tokens: zeros, an empty digest and empty arrays. Rows that repeat give rows that repeat, null
    ids and other columns do no harm, an empty table gives no rows."""

    def run(batches):
        a_side, b_side, digits = _state(path_a, path_b)
        n_b = len(b_side.size)
        for batch in batches:
            for x, y, text, offs in tb.slices(batch, "text", BLOCK_BYTES):
                n = y - x
                data = np.full(len(text) + n, 0x20, np.uint8)      # a space before each text
                doc = np.repeat(np.arange(n), np.diff(offs))
                data[np.arange(len(text)) + doc + 1] = text
                wide = offs + np.arange(n + 1)
                (ia, pa_, good), (ib, pb_, also) = _tokens(a_side, data, wide), _tokens(b_side, data, wide)
                good = good & also & (np.diff(offs) > 0)
                # tokens of good texts only, their ends as offsets in the slice
                counts, ids, ends = [], [], []
                for side, i, before in ((a_side, ia, pa_), (b_side, ib, pb_)):
                    per = np.where(good, np.diff(before), 0)
                    i = i[np.repeat(good, np.diff(before))]
                    first = np.concatenate(([0], np.cumsum(per)))
                    run_ = np.concatenate(([0], np.cumsum(side.size[i])))
                    ends.append(run_[1:] + np.repeat(wide[:-1] - run_[first[:-1]], per))
                    counts.append(first)
                    ids.append(i.astype(np.int64))
                na, nb = counts
                ca, cb = shared_cuts(*ends, na, nb)
                group = np.concatenate(([0], np.searchsorted(ca, na[1:])))   # groups before each text
                seq, mark = np.empty(na[-1] + nb[-1], np.int64), np.full(na[-1] + nb[-1], 0x2C, np.uint8)
                per_a, per_b = np.diff(ca, prepend=-1), np.diff(cb, prepend=-1)
                at_a = np.arange(na[-1]) + np.repeat(cb + 1 - per_b, per_a)
                at_b = np.arange(nb[-1]) + np.repeat(ca + 1, per_b)
                seq[at_a], seq[at_b] = ids[0], ids[1]
                mark[at_a[ca]], mark[at_b[cb]] = 0x7C, 0x3B
                sha = _digests(digits, seq, mark, na + nb)
                where = np.repeat(np.arange(n), np.diff(group))
                size = len(a_side.size) * n_b
                key, times = np.unique(where * size + ids[0][ca] * n_b + ids[1][cb], return_counts=True)
                edge = pa.array(np.searchsorted(key, np.arange(n + 1) * size), pa.int32())
                out = {"doc_id": batch.column(0).slice(x, n), "n_a": pa.array(np.diff(na), pa.int64()), "n_b": pa.array(np.diff(nb), pa.int64()),
                       "n_groups": pa.array(np.diff(group), pa.int64()), "groups_sha256": pa.array(sha, pa.string()),
                       "pairs": pa.ListArray.from_arrays(edge, pa.array(key % size, pa.int64())),
                       "times": pa.ListArray.from_arrays(edge, pa.array(times, pa.int32()))}
                if keep_groups:
                    for name, first, value in (("a_ids", na, ids[0]), ("b_ids", nb, ids[1]),
                                               ("a_cuts", group, ca + 1 - na[where]), ("b_cuts", group, cb + 1 - nb[where])):
                        out[name] = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(value, pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    schema = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
              + ", a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>" * keep_groups)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, count (links of the corpus that hold it), texts (that hold it) and best: no pair with
    the same B id has a higher count. A B id has at most as many pairs as A has ids."""
    by_b = Window.partitionBy(F.col("pair") % size_b)
    return (_links(aligned).groupBy("pair").agg(F.sum("times").alias("count"), F.count("*").alias("texts"))
            .withColumn("best", F.col("count") == F.max("count").over(by_b)))


def _links(aligned: DataFrame, *keep: str) -> DataFrame:
    return aligned.select(*keep, F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(*keep, F.col("link.pairs").alias("pair"), F.col("link.times"))


def score_links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``align`` with n_links, n_best (links whose count is the highest of their B id, ties
    included) and count_sum (over links) of each document; the aligned rows are written once."""
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = written(align(docs, path_a, path_b, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(rows, size_b), "pair_counts")
    per_row = (lookup(_links(rows, "row"), counts, "pair", "texts")
               .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return rows.join(per_row, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), *zero, "groups_sha256")


def op12_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, 50k byte-level BPE against the 32k piece BPE."""
    import public_tokenizers
    return score_links(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
