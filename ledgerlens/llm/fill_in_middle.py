"""Fill-in-middle transformation, cuts found through Fenwick trees.

A text's units are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: white space
with the word after it, or the white space at the end. Its UTF-8 bytes are split
into fixed blocks of BLOCK bytes. A Fenwick tree over the blocks of a text
stores two counts, the units that end in a block and the code points that start in
it. A cut after k units descends the tree by binary lifting: it takes a node as
long as fewer than k units end in it, adding up units and code points, and so
reaches the block in which unit k ends. Only that block is then read byte by byte.

The trees of all texts of a slice lie one after the other in flat arrays, and all
cuts descend at once. Memory follows the slice (2 MB, or one longer text); nothing is
shuffled, so hot sources or copies do no harm.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import read_table

BLOCK = 256
#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass
class Blocks:
    """Fenwick trees of the texts of a slice. Node k (from 1) of text t stands at
    ``base[t] + k`` of ``units`` and ``points``; ``count`` blocks a text."""
    data: np.ndarray
    offs: np.ndarray
    ends: np.ndarray      # bool: a unit ends with this byte
    count: np.ndarray
    base: np.ndarray
    units: np.ndarray
    points: np.ndarray
    n_units: np.ndarray
    n_points: np.ndarray


def build(data: np.ndarray, offs: np.ndarray, block: int = BLOCK) -> Blocks:
    size = np.diff(offs)
    word = tb.SPACED[data]
    ends = np.zeros(len(data), bool)
    if len(data):
        ends[:-1] = word[:-1] & ~word[1:]
        ends[offs[1:][size > 0] - 1] = True      # a word, or the white space at the end
    point = (data & 0xC0) != 0x80
    count = -(-size // block)
    base = np.cumsum(count) - count               # node 1 of text t stands at base + 1
    place = tb.ragged(np.ones(len(count), np.int64), count)
    at = np.repeat(offs[:-1], count) + (place - 1) * block
    # a node holds the sum of its low-bit many blocks: differences of running sums
    node = np.repeat(base, count) + place
    reach = node - (place & -place)
    trees, totals = [], []
    for flags in (ends, point):
        per = np.add.reduceat(flags, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
        run = np.concatenate(([0], np.cumsum(per)))
        trees.append(np.concatenate(([0], run[node] - run[reach])))
        totals.append(run[base + count] - run[base])
    return Blocks(data, offs, ends, count, base, *trees, *totals)


def cut(b: Blocks, text: np.ndarray, k: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(byte, code point) in its text at which each ``text`` is cut after ``k`` units."""
    node, left, points = np.zeros(len(text), np.int64), k.copy(), np.zeros(len(text), np.int64)
    count, base = b.count[text], b.base[text]
    step = 1 << int(count.max(initial=0)).bit_length()
    while step := step >> 1:
        to = node + step
        fits = to <= count
        at = np.where(fits, base + to, 0)
        fits &= b.units[at] < left
        node = np.where(fits, to, node)
        left = left - np.where(fits, b.units[at], 0)
        points = points + np.where(fits, b.points[at], 0)
    start = node * block
    byte = np.where(k > 0, start, 0)
    if len(own := np.flatnonzero(k > 0)):        # unit ``left`` of block ``node`` is the one; look for it there
        first = b.offs[text[own]] + start[own]
        end = np.minimum(first + block, b.offs[text[own] + 1])
        cols = np.arange(block)
        inside = cols < (end - first)[:, None]
        at = np.where(inside, first[:, None] + cols, 0)
        nth = np.cumsum(b.ends[at] & inside, axis=1)
        byte[own] += (nth < left[own][:, None]).sum(axis=1) + 1
        before = inside & (cols < (byte[own] - start[own])[:, None])
        points[own] += (((b.data[at] & 0xC0) != 0x80) & before).sum(axis=1)
    return byte, np.where(k > 0, points, 0)


def _draws(seed: str, who: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``seed:who``."""
    h = hashlib.sha256(f"{seed}:{who}".encode()).digest()
    return tuple(int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12))


SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output string")


def transform(docs: DataFrame, seed: str = "42", rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text in fill-in-middle form: doc_id, n (units), form, sizes of prefix
    and middle in code points and bytes (null if plain), output.

    A text's draws h1 to h4 come from the SHA-256 of ``seed:doc_id`` (null doc_id: of
    ``seed:``). The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units,
    the middle after the larger. ``plain`` (the text itself) if the text is empty or holds
    a marker or h3 % 100 >= ``rate``; else ``spm`` (<S>suffix<P>prefix<M>middle) if
    h4 % 100 < ``spm_rate``, else ``psm`` (<P>prefix<S>suffix<M>middle).

    Null text counts as empty. Rows that repeat a doc_id get the same draws, rows that
    repeat as a whole the same result; a very long text is a slice of its own; other
    columns do no harm; an empty table gives no rows."""

    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offs in tb.slices(batch, "text"):
                blocks = build(data, offs)
                n = blocks.n_units
                who = ids.slice(a, b - a).to_pylist()
                h = np.array([_draws(seed, "" if i is None else str(i)) for i in who], np.int64).reshape(-1, 4)
                raw = data.tobytes()
                held = np.zeros(b - a, bool)
                for mark in marks:
                    at = raw.find(mark)
                    while at >= 0:
                        t = int(np.searchsorted(offs, at, "right")) - 1
                        held[t] |= at + len(mark) <= offs[t + 1]
                        at = raw.find(mark, at + 1)
                plain = (n == 0) | held | (h[:, 2] % 100 >= rate)
                spm = ~plain & (h[:, 3] % 100 < spm_rate)
                draw = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                some = np.flatnonzero(~plain)
                byte, point = cut(blocks, np.repeat(some, 2), draw[some].ravel())
                byte, point = byte.reshape(-1, 2), point.reshape(-1, 2)
                cells = dict(zip(some.tolist(), byte.tolist()))
                out = []
                for t, (x, y) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                    if t not in cells:
                        out.append(raw[x:y])
                        continue
                    i, j = cells[t]
                    first, mid, last = raw[x:x + i], raw[x + i:x + j], raw[x + j:y]
                    out.append(s + last + p + first + m + mid if spm[t] else p + first + s + last + m + mid)
                sizes = np.zeros((4, b - a), np.int64)
                sizes[0, some], sizes[1, some] = point[:, 0], point[:, 1] - point[:, 0]
                sizes[2, some], sizes[3, some] = byte[:, 0], byte[:, 1] - byte[:, 0]
                form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
                     *(pa.array(v, pa.int64(), mask=plain) for v in sizes), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def restored(output: str = "output", form: str = "form"):
    """Column: the text, rebuilt from the output and its form alone. Markers cannot
    overlap one another or stand in a transformed text, so they split it in four."""
    part = F.split(F.col(output), "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    suffix_first = F.col(form) == "spm"
    first, last = F.when(suffix_first, part[2]).otherwise(part[1]), F.when(suffix_first, part[1]).otherwise(part[2])
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(first, part[3], last))


def op11_fenwick_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` transformed, digested, and restored from output and form."""
    return transform(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce("text", '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce("text", ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS unit
    FROM documents),
drawn AS (
    SELECT *, len(unit) AS n,
           ('0x' || h[1:8])::BIGINT % (len(unit) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(unit) + 1) AS c2,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                     OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut),
parts AS (
    SELECT *, array_to_string(unit[1:least(c1, c2)], '') AS a, array_to_string(unit[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(unit[greatest(c1, c2) + 1:], '') AS z
    FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
                        ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
