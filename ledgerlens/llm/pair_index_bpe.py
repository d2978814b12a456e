"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a slice are laid out as one array of symbols with
neighbour links. An index maps each mergeable pair (by its rank) to all its
positions. Active ranks are taken in ascending order; one step merges every
occurrence of the pair at once and adds the pairs that the merge has made to
their lists. Taking ranks in ascending order over all pre-tokens equals the
usual per-word loop because a merge only makes pairs of higher rank, which
``Vocabulary`` verifies.

Texts are cut into chunks without a regular expression (see ``textbytes``);
the pre-tokenizer's pattern runs over distinct chunks only. A pool of known
chunks, bounded in size, is kept by each Python worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import read_table

#: Fixed value: the public pre-tokenization pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file:
    printable Latin-1 bytes stand for themselves, the others, in order, for
    U+0100 onwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ids, merges and bytes of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.size = max(max(vocab.values()), max((t["id"] for t in spec["added_tokens"]), default=0)) + 1
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.pair, self.rank = key[order], order
        self.left, self.right, self.made = left, right, made
        first = np.full(self.size, -1)
        first[made[::-1]] = np.arange(len(made))[::-1]
        if not ((first[left] < np.arange(len(made))) & (first[right] < np.arange(len(made)))).all():
            raise ValueError("a merge's parts must come of merges of lower rank")
        pieces = [b""] * self.size
        for text, i in vocab.items():
            pieces[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            pieces[i] = text.encode()
        self.piece_size = np.array([len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        digits = [b"%d," % i for i in range(self.size)]
        self.digit_size = np.array([len(p) for p in digits], np.int64)
        self.digit_start = np.cumsum(self.digit_size) - self.digit_size
        self.digit_bytes = np.frombuffer(b"".join(digits), np.uint8)
        self.split = regex.compile(PATTERN).findall
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where they do not merge (or an id is -1)."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.pair[at] == key), self.rank[at], -1)


def merge_all(v: Vocabulary, sym: np.ndarray) -> np.ndarray:
    """Apply all merges to the ids ``sym`` (pre-tokens separated by -1);
    positions that a merge has swallowed become -2."""
    n = len(sym)
    if n < 2:
        return sym
    sym = sym.copy()
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[-1], prv[0] = n - 1, 0  # the ends are separators
    lists: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def index(pos: np.ndarray) -> None:
        """Add the pairs that start at ``pos`` to their ranks' lists."""
        rank = v.ranks(sym[pos], sym[nxt[pos]])
        pos, rank = pos[rank >= 0], rank[rank >= 0]
        if not len(pos):
            return
        order = np.argsort(rank, kind="stable")
        pos, rank = pos[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, own in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(pos, cuts)):
            if r not in lists:
                lists[r] = []
                heapq.heappush(heap, r)
            lists[r].append(own)

    index(np.arange(n - 1))
    while heap:
        r = heapq.heappop(heap)
        pos = np.unique(np.concatenate(own)) if len(own := lists.pop(r)) > 1 else own[0]
        a, b = v.left[r], v.right[r]
        right = nxt[pos]
        ok = (sym[pos] == a) & (sym[right] == b)
        pos, right = np.sort(pos[ok]), None
        if not len(pos):
            continue
        right = nxt[pos]
        if a == b and len(pos) > 1:  # a run of the same symbol merges from its left, every other pair
            linked = np.concatenate(([False], right[:-1] == pos[1:]))
            start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(pos))))
            keep = (np.arange(len(pos)) - start) % 2 == 0
            pos, right = pos[keep], right[keep]
        after = nxt[right]
        sym[pos], sym[right] = v.made[r], -2
        nxt[pos] = after
        prv[after] = pos
        index(np.unique(np.concatenate((pos, prv[pos]))))
    return sym


def encode_chunks(v: Vocabulary, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids per chunk, all ids) of chunk strings."""
    known: dict[str, int] = {}
    of_chunk, of_count = [], []
    special = v.special
    for c in chunks:
        if special and any(s in c for s in special):
            parts = []
            for k, piece in enumerate(v.special_split.split(c)):
                parts += [piece] if k % 2 else v.split(piece)
        else:
            parts = v.split(c)
        of_count.append(len(parts))
        of_chunk += [known.setdefault(p, len(known)) for p in parts]
    raw = [b"" if p in special else p.encode() for p in known]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    end = np.cumsum(size)
    sym = np.full(int(end[-1]) + 1 if len(end) else 1, -1, np.int64)  # -1 before each and at the end
    if len(raw):
        flat = v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        at = np.ones(len(sym), bool)
        at[end - size] = at[-1] = False
        sym[at] = flat
    sym = merge_all(v, sym)
    ids_at = np.flatnonzero(sym >= 0)
    counts = np.diff(np.searchsorted(ids_at, np.append(end - size, len(sym))))
    flat = sym[ids_at]
    if special and any(p in known for p in special):
        which = {known[p]: i for p, i in special.items() if p in known}
        pieces = np.split(flat, np.cumsum(counts)[:-1])
        for k, i in which.items():
            pieces[k] = np.array([i])
            counts[k] = 1
        flat = np.concatenate(pieces)
    start = np.cumsum(counts) - counts
    use = np.asarray(of_chunk, np.int64)
    per = counts[use]
    out = flat[tb.ragged(start[use], per)]
    before = np.concatenate(([0], np.cumsum(per)))
    edge = np.concatenate(([0], np.cumsum(of_count)))
    total = before[edge]
    return np.diff(total), out.astype(np.uint16 if v.size <= 1 << 16 else np.uint32)


_STATE: dict[str, tuple] = {}
#: Chunks that a Python worker keeps encoded.
POOL = 1_000_000


def state(path: str) -> tuple[Vocabulary, tb.ChunkPool, object, bytes]:
    """Vocabulary, chunk pool, chunk encoder and special text, once a worker."""
    if path not in _STATE:
        v = Vocabulary(path)
        if len(v.special) > 1:
            raise ValueError("one special token at most is supported")
        _STATE[path] = v, tb.ChunkPool(POOL), lambda chunks: encode_chunks(v, chunks), next(iter(v.special), "").encode()
    return _STATE[path]


def decode(v: Vocabulary, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bytes before each text) of the ids."""
    size = v.piece_size[ids]
    edge = np.concatenate(([0], np.cumsum(size)))
    return v.piece_bytes[tb.ragged(v.piece_start[ids], size)], edge[before]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again, without a shuffle.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the decoded text in UTF-8; invalid bytes of a cut
    character are replaced), and with ``keep_ids`` the ids themselves as
    array<int>. Null text counts as empty: no ids. Rows that repeat, null ids
    and other columns do no harm; an empty table gives no rows."""

    def run(batches):
        v, pool, encode, special = state(vocabulary)
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                ids, before = tb.encode_slice(pool, encode, data, offs, special)
                ids = ids.astype(np.int64)
                text, text_at = decode(v, ids, before)
                size = v.digit_size[ids]
                digit_at = np.concatenate(([0], np.cumsum(size)))[before]
                digits = memoryview(v.digit_bytes[tb.ragged(v.digit_start[ids], size)])
                text = memoryview(text)
                sha = [hashlib.sha256(digits[x:max(x, y - 1)]).hexdigest() for x, y in zip(digit_at[:-1].tolist(), digit_at[1:].tolist())]
                back = [_sha_text(text[x:y]) for x, y in zip(text_at[:-1].tolist(), text_at[1:].tolist())]
                out = {"doc_id": batch.column(0).slice(a, b - a), "n_tokens": pa.array(np.diff(before), pa.int64()),
                       "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
                if keep_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _sha_text(raw: memoryview) -> str:
    """SHA-256 of the bytes, with invalid UTF-8 replaced as a decoder does."""
    b = bytes(raw)
    try:
        b.decode("utf-8")
    except UnicodeDecodeError:
        b = b.decode("utf-8", "replace").encode()
    return hashlib.sha256(b).hexdigest()


def op9_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` encoded and decoded with the 50k byte-level vocabulary."""
    import public_tokenizers
    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
