"""Words, chunks and 64-bit hashes of many texts at once, in numpy.

All functions work on the UTF-8 bytes of a *slice*: consecutive texts of an
Arrow batch, about ``SLICE_BYTES`` long (a longer text is a slice of its
own). Every temporary array is proportional to the slice, so memory does not
follow the batch, the partition or the table. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair (a, b) of 64-bit hashes."""
    return mix(a * _U(0xD6E8FEB86659FD93) + mix(b + _U(0xA0761D6478BD642F)))


def spans(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "") if arr.null_count else arr
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of at most ``most`` consecutive rows."""
    data, offs = spans(batch.column(column))
    at, n = 0, len(offs) - 1
    while at < n:
        end = min(max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1), at + most)
        yield at, end, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every byte segment, its bytes put through ``table`` first.

    Groups of eight bytes are mixed one by one, each with its place in the
    segment, before they are summed, so no structure of a text makes segments
    collide; of segments of one length up to eight bytes none do. Equal hashes
    of longer ones stay a matter of chance (2**-64 a pair)."""
    size = ends - starts
    out = mix(size.astype(_U) + _U(0x9E3779B97F4A7C15))
    own = np.flatnonzero(size > 0)
    if not len(own):
        return out
    at = eight_bytes(data if table is None else table[data])
    groups = (size[own] + 7) >> 3
    first = np.cumsum(groups) - groups
    place = np.arange(int(groups.sum())) - np.repeat(first, groups)
    word = at[np.repeat(starts[own], groups) + 8 * place]
    last = first + groups - 1
    word[last] &= _U(0xFFFFFFFFFFFFFFFF) >> (_U(8) * (_U(8) - (size[own] - 8 * (groups - 1)).astype(_U)))
    out[own] = mix(out[own] + np.add.reduceat(mix(word ^ mix(place.astype(_U) + _U(1))), first))
    return out


#: Bytes with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Bytes of a word ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, bool)
SPACED[0x20] = False
SPACED[0x09:0x0E] = False
#: Bytes of a word ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = ALNUM[0x80:] = True


def word_spans(data: np.ndarray, offs: np.ndarray, kind: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of the maximal runs of word
    bytes; a run never crosses a text's end."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = kind[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, kind: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased), and words before each text."""
    starts, ends, first = word_spans(data, offs, kind)
    return segment_hashes(data, starts, ends, LOWER), first


# Chunks: stretches of text between which the byte-level pre-tokenizer always
# splits, found without a regular expression. A single space or line feed
# between two characters that surely are no white space ends a chunk: the
# space opens the next one, the line feed is one of its own. Between a letter
# a-z and an ASCII mark a chunk ends too. "Surely no white space" means ASCII
# 0x21-0x7E or U+00C0-U+07FF; around others the chunk just goes on.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LEAD2 = np.zeros(256, bool)
_LEAD2[0xC3:0xE0] = True
_TAIL = np.zeros(256, bool)
_TAIL[0x80:0xC0] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = _PLAIN & ~_LETTER
_MARK[0x30:0x3A] = False


def chunk_starts(data: np.ndarray, offs: np.ndarray, keep: bytes = b"") -> np.ndarray:
    """Start of every chunk, ascending. ``keep``: a special token's text; no
    chunk ends inside of it."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    plain, lead, tail = _PLAIN[data], _LEAD2[data], _TAIL[data]
    after = plain.copy()  # the character that ends here is no white space
    after[1:] |= tail[1:] & lead[:-1]
    sep = ((data == 0x20) | (data == 0x0A))
    sep[0] = sep[-1] = False
    sep[1:-1] &= after[:-2] & (plain | lead)[2:]
    inner = offs[(offs > 0) & (offs < n)]
    sep[inner] = False
    sep[inner - 1] = False
    start = sep.copy()
    start[1:] |= sep[:-1] & (data[:-1] == 0x0A)
    start[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    if keep:
        text = data.tobytes()
        at = text.find(keep)
        while at >= 0:
            start[at + 1:at + len(keep)] = False
            at = text.find(keep, at + 1)
    start[offs[offs < n]] = True
    return np.flatnonzero(start)


def ragged(pool_start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of every row, one after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.repeat(pool_start - before, length) + np.arange(total, dtype=np.int64)


class ChunkPool:
    """Values (small int arrays) of chunks, kept across the batches a Python
    worker sees, with the chunks' bytes. They are looked up by 64-bit hash; a
    hash never decides, ``find_chunks`` compares the bytes. It starts the pool anew
    beyond ``most`` entries or ``most_bytes`` of chunks, so its memory is bounded; a
    chunk that is gone is just encoded again.
    """

    def __init__(self, most: int = 2_000_000, most_bytes: int = 64 << 20):
        self.most, self.most_bytes = most, most_bytes
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, _U)       # ascending
        self.slot = np.zeros(0, np.int64)  # entry of each key
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)
        self.text_start = np.zeros(0, np.int64)
        self.text_size = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 if absent."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def add(self, text: list[bytes], size: np.ndarray, flat: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
        """New entries, which ``find`` sees if they have keys."""
        own = np.fromiter(map(len, text), np.int64, len(text))
        entry = len(self.start) + np.arange(len(text))
        self.start = np.concatenate((self.start, len(self.pool) + np.cumsum(size) - size))
        self.text_start = np.concatenate((self.text_start, len(self.text) + np.cumsum(own) - own))
        self.size, self.text_size = np.concatenate((self.size, size)), np.concatenate((self.text_size, own))
        self.pool = np.concatenate((self.pool, flat.astype(np.promote_types(self.pool.dtype, flat.dtype))))
        self.text = np.concatenate((self.text, np.frombuffer(b"".join(text), np.uint8)))
        if keys is not None:
            order = np.argsort(keys := np.concatenate((self.keys, keys)), kind="stable")
            self.keys, self.slot = keys[order], np.concatenate((self.slot, entry))[order]
        return entry

    def other(self, entry: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Segments (none empty) whose bytes differ from those of their entries: the first
        eight bytes, the last eight and, of longer ones, those between are compared."""
        size = ends - starts
        same = self.text_size[entry] == size
        k = np.flatnonzero(same)
        a, b, n = starts[k], self.text_start[entry[k]], size[k]
        mine, theirs = eight_bytes(data), eight_bytes(self.text)
        apart = mine[a] ^ theirs[b]
        few = np.flatnonzero(n < 8)
        apart[few] &= (_U(1) << (n[few] * 8).astype(_U)) - _U(1)
        ok = apart == 0
        more = np.flatnonzero(n > 8)
        ok[more] &= mine[a[more] + n[more] - 8] == theirs[b[more] + n[more] - 8]
        if len(more := np.flatnonzero(n > 16)):
            mid = n[more] - 16
            equal = data[ragged(a[more] + 8, mid)] == self.text[ragged(b[more] + 8, mid)]
            ok[more] &= np.logical_and.reduceat(equal, np.cumsum(mid) - mid)
        same[k] = ok
        return np.flatnonzero(~same)


def find_chunks(pool: ChunkPool, encode, data: np.ndarray, offs: np.ndarray, keep: bytes = b"", cut=None) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all chunks, their entries in the pool); chunks that are new to the
    pool are encoded. ``encode``: list of chunk strings -> (ids per chunk, all ids).
    ``cut``: (data, offs) -> starts of chunks, if not ``chunk_starts``."""
    starts = cut(data, offs) if cut else chunk_starts(data, offs, keep)
    if not len(starts):
        return starts, starts
    ends = np.append(starts[1:], len(data))
    keys, first, inverse = np.unique(segment_hashes(data, starts, ends), return_index=True, return_inverse=True)
    at = pool.find(keys)
    text = None
    if len(new := np.flatnonzero(at < 0)):
        if len(pool.start) > pool.most or len(pool.text) > pool.most_bytes:  # all of this slice must be there at once
            pool.clear()
            new = np.arange(len(keys))
        text = data.tobytes()
        own = [text[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
        at[new] = pool.add(own, *encode([t.decode("utf-8") for t in own]), keys[new])
    at = at[inverse]
    if len(odd := pool.other(at, data, starts, ends)):  # an equal hash of other bytes: encoded by itself
        text = text or data.tobytes()
        own = [text[a:b] for a, b in zip(starts[odd].tolist(), ends[odd].tolist())]
        each = list(dict.fromkeys(own))
        entries = dict(zip(each, pool.add(each, *encode([t.decode("utf-8") for t in each])).tolist()))
        at[odd] = [entries[t] for t in own]
    return starts, at


def encode_slice(pool: ChunkPool, encode, data: np.ndarray, offs: np.ndarray, keep: bytes = b"", cut=None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, ids before each text)."""
    starts, at = find_chunks(pool, encode, data, offs, keep, cut)
    if not len(starts):
        return pool.pool[:0], np.zeros(len(offs), np.int64)
    size = pool.size[at]
    ids = pool.pool[ragged(pool.start[at], size)]
    before = np.concatenate(([0], np.cumsum(size)))
    return ids, before[np.searchsorted(starts, offs)]
