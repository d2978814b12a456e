"""Token counts that follow edits.

A document that is edited is kept as a segment tree over its pre-token
groups: the leaves' runs hold up to RUN groups (stretches of text that the pre-
tokenizer never joins to their neighbours, see ``textbytes.chunk_starts``), each
node the sum of bytes and tokens below it. An edit descends to the bytes it touches,
takes the groups around them with CONTEXT bytes of unchanged text on either side, cuts
and encodes this stretch again, and adds the difference up along the paths to
the root. What lies beyond the context keeps its groups and counts: a boundary depends on four bytes
around it, or on a special token's text that it must not cut.

Documents without edits have no tree; their counts come of the same groups.

Edits of a document: (start, end, replacement) in bytes of the text as earlier
edits have left it. They come from a function of the text (``cleaning_edits``
in the query) and run where the document is read, without a shuffle.
Null text counts as empty. Rows that repeat are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pair_index_bpe
from . import textbytes as tb
from .common import read_table

RUN = 32
CONTEXT = 24

Edit = tuple[int, int, bytes]


class SegmentTree:
    """Groups of one text with sums of bytes and tokens; ``encode`` gives the
    groups' sizes and token counts of a stretch of bytes."""

    def __init__(self, text: bytes, sizes: list[int], counts: list[int], encode: Callable[[bytes], tuple[list[int], list[int]]]):
        self.encode, self.encoded = encode, 0
        self._build(text, sizes, counts)

    def _build(self, text: bytes, sizes: list[int], counts: list[int]) -> None:
        n = max(1, -(-len(sizes) // RUN))
        self.width = 1 << (n - 1).bit_length()
        self.runs = [(sizes[k * RUN:(k + 1) * RUN], counts[k * RUN:(k + 1) * RUN]) for k in range(self.width)]
        self.text, at = [], 0
        for s, _ in self.runs:
            self.text.append(text[at:at + sum(s)])
            at += sum(s)
        self.bytes = [0] * self.width + [sum(s) for s, _ in self.runs]
        self.tokens = [0] * self.width + [sum(c) for _, c in self.runs]
        for k in range(self.width - 1, 0, -1):
            self.bytes[k] = self.bytes[2 * k] + self.bytes[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def total(self) -> int:
        return self.tokens[1]

    def whole(self) -> bytes:
        return b"".join(self.text)

    def _find(self, at: int) -> tuple[int, int]:
        """(run, bytes before the run) of the byte ``at``."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at >= before + self.bytes[node] and self.bytes[node + 1]:
                before += self.bytes[node]
                node += 1
        return node - self.width, before

    def _set(self, run: int, text: bytes, sizes: list[int], counts: list[int]) -> None:
        self.text[run], self.runs[run] = text, (sizes, counts)
        node = run + self.width
        more, plus = len(text) - self.bytes[node], sum(counts) - self.tokens[node]
        while node:
            self.bytes[node] += more
            self.tokens[node] += plus
            node //= 2

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Replace the bytes [start, end) by ``new``."""
        size = self.bytes[1]
        if not 0 <= start <= end <= size:
            raise ValueError("edit outside of the text")
        (first, at), (last, before_last) = self._find(max(0, start - CONTEXT)), self._find(min(size, end + CONTEXT))
        sizes = [s for k in range(first, last + 1) for s in self.runs[k][0]]
        counts = [c for k in range(first, last + 1) for c in self.runs[k][1]]
        text = b"".join(self.text[first:last + 1])
        # groups [i, j) of these runs hold the edit and its context
        edge = np.concatenate(([0], np.cumsum(sizes))) + at
        i = max(int(np.searchsorted(edge, max(0, start - CONTEXT), "right")) - 1, 0)
        j = min(int(np.searchsorted(edge, end + CONTEXT, "left")), len(sizes))
        lo, hi = int(edge[i]) - at, int(edge[j]) - at
        part = text[lo:start - at] + new + text[end - at:hi]
        own_sizes, own_counts = self.encode(part)
        self.encoded += len(part)
        sizes[i:j], counts[i:j] = own_sizes, own_counts
        text = text[:lo] + part + text[hi:]
        if len(sizes) > 4 * RUN * (last - first + 1):  # grown out of its runs
            before = b"".join(self.text[:first])
            after = b"".join(self.text[last + 1:])
            flat = lambda k, a, b: [x for r in self.runs[a:b] for x in r[k]]
            self._build(before + text + after, flat(0, 0, first) + sizes + flat(0, last + 1, self.width),
                        flat(1, 0, first) + counts + flat(1, last + 1, self.width))
            return
        per = -(-len(sizes) // (last - first + 1)) if sizes else 0
        at = 0
        for k in range(first, last + 1):
            s, c = sizes[(k - first) * per:(k - first + 1) * per], counts[(k - first) * per:(k - first + 1) * per]
            self._set(k, text[at:at + sum(s)], s, c)
            at += sum(s)


_NUMBER = re.compile(rb"[0-9]{3,}")
MASK = b"<num>"


def cleaning_edits(text: bytes) -> Iterator[Edit]:
    """Edits of a cleaning step, from left to right: each run of three or more
    digits becomes ``<num>``; a line that equals an earlier one goes, with the
    line feed before it. An edit inside of a line that goes is left out."""
    gone: list[tuple[int, int]] = []
    seen, at = set(), 0
    for line in text.split(b"\n"):
        if at and line in seen:
            gone.append((at - 1, at + len(line)))
        seen.add(line)
        at += len(line) + 1
    edits = [(a, b, b"") for a, b in gone]
    k = 0
    for m in _NUMBER.finditer(text):
        while k < len(gone) and gone[k][1] <= m.start():
            k += 1
        if k == len(gone) or m.start() < gone[k][0]:
            edits.append((m.start(), m.end(), MASK))
    shift = 0
    for a, b, new in sorted(edits):
        yield a + shift, b + shift, new
        shift += len(new) - (b - a)


def _stretch_encoder(vocabulary: str) -> Callable[[bytes], tuple[list[int], list[int]]]:
    v, _, encode, special = pair_index_bpe.state(vocabulary)
    known: dict[bytes, int] = {}

    def run(part: bytes) -> tuple[list[int], list[int]]:
        data = np.frombuffer(part, np.uint8)
        edge = [*tb.chunk_starts(data, np.array([0, len(part)]), special).tolist(), len(part)] if part else [0]
        groups = [part[a:b] for a, b in zip(edge[:-1], edge[1:])]
        if new := [g for g in dict.fromkeys(groups) if g not in known]:
            if len(known) > 200_000:
                known.clear()
                new = list(dict.fromkeys(groups))
            known.update(zip(new, encode([g.decode("utf-8") for g in new])[0].tolist()))
        return [len(g) for g in groups], [known[g] for g in groups]

    return run


def count_with_edits(docs: DataFrame, vocabulary: str, edits: Callable[[bytes], Iterator[Edit]] = cleaning_edits,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens (before), n_edits, n_tokens_after,
    n_bytes_after, text_crc32_after (unsigned, of the edited text), encoded_bytes (encoded again for
    the edits)."""
    def run(batches):
        _, pool, encode, special = pair_index_bpe.state(vocabulary)
        again = _stretch_encoder(vocabulary)
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                starts, at = tb.find_chunks(pool, encode, data, offs, special)
                count = pool.size[at] if len(at) else np.zeros(0, np.int64)
                first = np.searchsorted(starts, offs)
                before = np.concatenate(([0], np.cumsum(count)))[first]
                rows = []
                for k, (x, y, n) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), np.diff(before).tolist())):
                    text, tree, m = data[x:y].tobytes(), None, 0
                    for start, end, new in edits(text):
                        if tree is None:
                            own = slice(int(first[k]), int(first[k + 1]))
                            tree = SegmentTree(text, np.diff(starts[own], append=y).tolist(), count[own].tolist(), again)
                        tree.replace(start, end, new)
                        m += 1
                    if tree is not None:
                        text = tree.whole()
                    rows.append((n, m, tree.total() if tree else n, len(text), zlib.crc32(text), tree.encoded if tree else 0))
                cols = list(zip(*rows))
                names = ("n_tokens", "n_edits", "n_tokens_after", "n_bytes_after", "text_crc32_after", "encoded_bytes")
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a)} | {c: pa.array(v, pa.int64()) for c, v in zip(names, cols)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_bytes_after long, text_crc32_after long, encoded_bytes long")


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all of ``documents`` before and after the cleaning edits."""
    import public_tokenizers
    return count_with_edits(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
