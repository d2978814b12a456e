"""Language-model scores from a weighted backoff automaton.

Tokens of a text: its words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``), then one
end. The model interpolates n-grams of orders 1 to ``order``:

    P1(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    Pk(w | h) = (1 - l_k) c(hw) / c(h) + l_k Pk-1(w | shorter h)     if c(h) > 0
              = Pk-1(w | shorter h)                                  otherwise

l_k is the Good-Turing mass of unseen events: of the training k-grams, the
share that occurs once. As an automaton (``Automaton``): a state is a context that
training has seen, of 0 to order - 1 words; an arc of a state is a k-gram that training has
seen, weighs log10 Pk and leads to the state of the longest context it ends with; a failure
arc leads to the shorter context and weighs log10 l_k. A text is walked once from left to right
with a state in hand: failure arcs are followed until the state has an arc for the
token. All texts of a block are walked side by side. Longer ones are cut every STRETCH tokens; a piece
starts in the state to which the order - 1 tokens before it lead, as no state knows more than these.

The automaton grows with the corpus and is never in one place. Texts are taken in *blocks*
(2 MB); a block asks for the counts of the distinct n-grams it holds, which
is the part of the automaton that its texts can reach:

1. Each block is written: document ids, distinct words, word numbers.
2. Each block sends its distinct words and bigrams (64-bit hashes, sorted, packed) with its own counts to the partitions of the hash space; a partition adds the blocks' counts up and
   answers each block with the totals. A hot n-gram is one entry a block.
3. Longer n-grams are asked for order by order. An answer also says whether all occurrences, held-out
   texts included, are the block's own. If those of a gram's context, or of the gram without its first word,
   are, so are the gram's: its total is the block's own count, and no block asks for it.
4. Each block builds its part of the automaton from the answers and walks its texts.

Null text counts as empty (the end alone). Null doc_id learns. Rows that repeat
learn and are scored each. An empty table gives no rows; without training rows
N, V and all counts are 0 and both scores are those of P1.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import read_table, written

ORDER = 3
BLOCK_BYTES = 2 << 20
#: Text bytes a partition of the hash space stands for.
PARTITION_BYTES = 8 << 20
FOLDS, HELD_FOLD = 5, 1
#: Tokens of a text that are walked in one piece.
STRETCH = 128
_U = np.uint64
START, END = _U(0x5354415254), _U(0x454E44)


def pack(a: np.ndarray, level: int = 1) -> bytes:
    """Integers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def unpack(raw: bytes, dtype) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).reshape(-1)


def _join(parts: list[bytes]) -> bytes:
    return struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def _split(raw: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<I", raw)
    sizes, at, out = struct.unpack_from(f"<{n}Q", raw, 4), 4 + 8 * n, []
    for s in sizes:
        out.append(raw[at:at + s])
        at += s
    return out


def _block(ids: list, known: list, held: list, words: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """Packed block: documents, distinct token hashes (ascending) with their frequencies, and
    every document's tokens as ranks by falling frequency: start, words, end."""
    n = np.concatenate(counts)
    seq = np.empty(int(n.sum()) + 2 * len(n), _U)
    first = np.cumsum(n + 2) - (n + 2)
    seq[first], seq[first + n + 1] = START, END
    inner = np.ones(len(seq), bool)
    inner[first] = inner[first + n + 1] = False
    seq[inner] = np.concatenate(words)
    names, number, freq = np.unique(seq, return_inverse=True, return_counts=True)
    order = np.argsort(-freq, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    return _join([np.concatenate(ids).astype("<i8").tobytes(), np.concatenate(known).tobytes(), np.concatenate(held).tobytes(),
                  pack((n + 2).astype(np.uint32)), pack(np.diff(names, prepend=_U(0))), pack(freq.astype(np.uint32)), pack(place[number], 6)])


class Grams:
    """N-grams of a block: for each order the number of the k-gram that ends at each
    token (-1: none), and of each distinct k-gram its hash, its context's number
    among the (k-1)-grams, that of its suffix (the gram without its first word) and its last word."""

    def __init__(self, raw: bytes, order: int):
        ids, known, held, n, names, freq, seq = _split(raw)
        self.ids, self.known, self.held = np.frombuffer(ids, "<i8"), np.frombuffer(known, bool), np.frombuffer(held, bool)
        self.n = unpack(n, np.uint32).astype(np.int64)
        names = np.cumsum(unpack(names, _U))[np.argsort(-unpack(freq, np.uint32).astype(np.int64), kind="stable")]
        seq = unpack(seq, np.uint32).astype(np.int64)
        self.end = np.cumsum(self.n)
        self.learn = np.repeat(~self.held, self.n)
        self.first = np.zeros(len(seq), bool)
        self.first[self.end - self.n] = True
        self.at, self.hash, self.context, self.suffix, self.word = [seq], [names], [None], [None], [np.arange(len(names))]
        for k in range(2, order + 1):
            prev = np.concatenate(([-1], self.at[-1][:-1]))
            prev[self.first] = -1
            some = np.flatnonzero(prev >= 0)
            key, number = np.unique(prev[some] * len(names) + seq[some], return_inverse=True)
            at = np.full(len(seq), -1)
            at[some] = number
            context, word = key // len(names), key % len(names)
            suffix = np.zeros(len(key), np.int64)
            suffix[number] = self.at[-1][some]
            self.suffix.append(suffix)
            self.at.append(at)
            self.hash.append(tb.pair_hash(self.hash[-1][context], names[word]) + _U(k))
            self.context.append(context)
            self.word.append(word)

    def training(self, k: int) -> np.ndarray:
        """Occurrences of each distinct k-gram in the block's training texts."""
        at = self.at[k - 1]
        return np.bincount(at[self.learn & (at >= 0)], minlength=len(self.hash[k - 1]))

    def everywhere(self, k: int) -> np.ndarray:
        """Occurrences of each distinct k-gram in all texts of the block."""
        at = self.at[k - 1]
        return np.bincount(at[at >= 0], minlength=len(self.hash[k - 1]))

    def inferred(self, k: int, alone: np.ndarray) -> np.ndarray:
        """The k-grams that no other block can hold; ``alone``: the (k-1)-grams that
        no other block holds."""
        return alone[self.context[k - 1]] | alone[self.suffix[k - 1]]

    def _asked(self, k: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(the k-grams that follow from ``before``, the others in the order of their questions)"""
        told = self.inferred(k, before) if before is not None else np.zeros(len(self.hash[k - 1]), bool)
        asked = np.flatnonzero(~told)
        return told, asked[np.argsort(self.hash[k - 1][asked], kind="stable")]

    def alone(self, k: int, flags: list[bytes], before: np.ndarray | None) -> np.ndarray:
        """The k-grams that no other block holds, from the answers' flags (their number, then bits), by partition;
        ``before``: those of order k - 1, if what follows from them has not been asked."""
        out, by = self._asked(k, before)
        if len(by):
            out[by] = np.concatenate([np.unpackbits(np.frombuffer(f[4:], np.uint8), count=int.from_bytes(f[:4], "little")) for f in flags])
        return out

    def totals(self, k: int, raws: list[bytes], before: np.ndarray | None) -> np.ndarray:
        """Training totals of the k-grams from the answers, by partition; ``before``: as for ``alone``."""
        out, by = self.training(k).astype(np.int64), self._asked(k, before)[1]
        if len(by):
            out[by] = np.concatenate([unpack(r, _U) for r in raws]).astype(np.int64)
        return out


def write_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Table of blocks: block (number), raw."""
    def run(batches):
        from pyspark import TaskContext
        part, seq, size, held = TaskContext.get().partitionId(), 0, 0, ([], [], [], [], [])

        def out():
            return pa.RecordBatch.from_pydict({"block": pa.array([part << 32 | seq], pa.int64()), "raw": pa.array([_block(*held)], pa.binary())})

        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            test = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, data, offs in tb.slices(batch, "text"):
                words, first = tb.word_hashes(data, offs, tb.SPACED)
                for q, x in zip(held, (ids[a:b], known[a:b], test[a:b], words, np.diff(first))):
                    q.append(x)
                size += len(data) + 16 * (b - a)
                if size >= BLOCK_BYTES:
                    yield out()
                    seq, size, held = seq + 1, 0, ([], [], [], [], [])
        if held[0]:
            yield out()

    test = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), test.alias("held"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "block long, raw binary"), "lm_blocks")


ANSWERED = "block long, k int, part int, raw binary, flags binary, tokens long, distinct long, once long"
ASKED = "block long, k int, part int, raw binary, tokens long, distinct long, once long"


def _ask(block: int, g: Grams, k: int, some: np.ndarray, partitions: int, last: bool) -> list[tuple]:
    """Questions (ASKED) for the k-grams ``some`` of a block, one a partition; of the ``last``
    order nobody needs to know who else holds them."""
    by = some[np.argsort(g.hash[k - 1][some], kind="stable")]
    if not len(by):
        return []
    keys, own, held = g.hash[k - 1][by], g.training(k)[by].astype(np.uint32), g.everywhere(k)[by].astype(np.uint32)
    part = _part(keys, partitions)
    cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
    return [(block, k, int(part[a]), _join([pack(np.diff(keys[a:b], prepend=_U(0))), pack(own[a:b]), *([] if last else [pack(held[a:b])])]), None, None, None) for a, b in zip(cuts[:-1], cuts[1:])]


def _answered(asked: DataFrame, partitions: int) -> DataFrame:
    """Questions answered: ``raw`` training totals, ``flags`` whether all occurrences are the
    asking block's own; rows of block -1 hold the sums of a partition."""
    def add_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        k, part = key
        told, rows = rows[rows.raw.isna()], rows[rows.raw.notna()]      # counted by a block itself
        sums = np.array([int(told[c].sum()) for c in ("tokens", "distinct", "once")])
        out, flags = [], []
        if len(rows):
            asked = [_split(r) for r in rows.raw]
            keys = [np.cumsum(unpack(q[0], _U)) for q in asked]
            names, number = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(number, np.concatenate([unpack(q[1], np.uint32) for q in asked]), len(names)).astype(np.int64)
            cuts = np.cumsum([len(x) for x in keys])[:-1]
            out, flags = [pack(total[x].astype(np.uint64)) for x in np.split(number, cuts)], [None] * len(asked)
            if len(asked[0]) > 2:
                held = np.concatenate([unpack(q[2], np.uint32) for q in asked])
                alone = held == np.bincount(number, held, len(names))[number]
                flags = [len(x).to_bytes(4, "little") + np.packbits(x).tobytes() for x in np.split(alone, cuts)]
            sums += _sums(total[names != START] if k == 1 else total)
        return pd.DataFrame({"block": [*rows.block, -1], "k": k, "part": part, "raw": [*out, None], "flags": [*flags, None], "tokens": [None] * len(out) + [sums[0]],
                             "distinct": [None] * len(out) + [sums[1]], "once": [None] * len(out) + [sums[2]]}).astype(
            {"tokens": "Int64", "distinct": "Int64", "once": "Int64"})

    return written(asked.repartition(partitions, "k", "part").groupBy("k", "part").applyInPandas(add_up, ANSWERED), "lm_answers")


def _sums(counts: np.ndarray) -> np.ndarray:
    """(tokens, distinct, that occur once)"""
    return np.array([int(counts.sum()), int((counts > 0).sum()), int((counts == 1).sum())])


def _gathered(blocks: DataFrame, got: DataFrame, partitions: int, totals: bool):
    """Each block's raw row (k = 0) and its answers, with or without the totals, grouped by block."""
    none = F.lit(None).cast("binary")
    rows = blocks.select("block", F.lit(0).alias("k"), F.lit(0).alias("part"), "raw", none.alias("flags")).union(
        got.filter("block <> -1").select("block", "k", "part", F.col("raw") if totals else none, "flags"))
    return rows.repartition(partitions, "block").groupBy("block")


def _opened(rows: pd.DataFrame, order: int) -> tuple[Grams, list[list[bytes]], list[list[bytes]]]:
    """A block's n-grams, and by order its answers (totals, flags) by partition."""
    by_order = [rows[rows.k == k].sort_values("part") for k in range(order + 1)]
    return Grams(by_order[0].raw.iloc[0], order), [r["raw"].tolist() for r in by_order], [r["flags"].tolist() for r in by_order]


def _further(k: int, partitions: int, last: bool):
    """Function of a block's group: its questions of order k, and the sums of what it need not ask."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, (g, _, flags), alone = int(key[0]), _opened(rows, k), None
        for j in range(2, k):
            alone = g.alone(j, flags[j], alone)
        told = g.inferred(k, alone)
        out = _ask(block, g, k, np.flatnonzero(~told), partitions, last)
        out.append((block, k, block % partitions, None, *_sums(g.training(k)[told]).tolist()))
        return pd.DataFrame(out, columns=["block", "k", "part", "raw", "tokens", "distinct", "once"]).astype(
            {"tokens": "Int64", "distinct": "Int64", "once": "Int64"})

    return run


def answers(blocks: DataFrame, order: int, partitions: int) -> tuple[DataFrame, dict[int, tuple[int, int, int]]]:
    """Totals of the n-grams that each block has asked for: a table of block, k, part, raw,
    and by order (training tokens, distinct in training, that occur once)."""
    def first(batches):
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("raw").to_pylist()):
                g = Grams(raw, min(order, 2))
                for k in range(1, min(order, 2) + 1):
                    if out := _ask(block, g, k, np.arange(len(g.hash[k - 1])), partitions, k == order):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                            names=["block", "k", "part", "raw", "tokens", "distinct", "once"])

    got = _answered(blocks.mapInArrow(first, ASKED), partitions)
    for k in range(3, order + 1):
        got = got.union(_answered(_gathered(blocks, got.filter("k > 1"), partitions, False).applyInPandas(_further(k, partitions, k == order), ASKED), partitions))
    sums = got.filter("block = -1").groupBy("k").agg(*(F.sum(c).alias(c) for c in ("tokens", "distinct", "once"))).collect()
    return got, {r.k: (r.tokens, r.distinct, r.once) for r in sums}


def _part(keys: np.ndarray, partitions: int) -> np.ndarray:
    """Partition of each hash: equal ranges of its upper 32 bits."""
    return ((keys >> _U(32)) * _U(partitions) >> _U(32)).astype(np.int32)


class Automaton:
    """A block's part of the automaton. State 0 is the empty context; ``fail_to`` and
    ``fail`` are each state's failure arc and its weight; arcs are sorted by ``keys``
    (state * words + word), with ``weight`` and ``target``."""

    def __init__(self, g: Grams, totals: list[np.ndarray], sums: dict[int, tuple[int, int, int]]):
        order, self.words = len(totals), len(g.hash[0])
        total, distinct, _ = sums.get(1, (0, 0, 0))
        self.low = np.log10((totals[0] + 0.5) / (total + 0.5 * (distinct + 1)))
        none = np.zeros(1, np.int64)
        state_of, n = [none], 1                        # of each j-gram: its state, -1 if training has not seen it
        fail_to, fail = [none], [np.zeros(1)]
        for j in range(1, order):
            seen = np.flatnonzero(totals[j - 1] > 0)
            state = np.full(len(totals[j - 1]), -1)
            state[seen] = n + np.arange(len(seen))
            n += len(seen)
            fail_to.append(state_of[-1][g.suffix[j - 1][seen]] if j > 1 else np.zeros(len(seen), np.int64))
            events, _, once = sums.get(j + 1, (0, 0, 0))
            fail.append(np.full(len(seen), np.log10(min(max(once / events, 1e-3), 0.999) if events else 0.5)))
            state_of.append(state)
        self.fail_to, self.fail = np.concatenate(fail_to), np.concatenate(fail)
        # the empty context has an arc for every word; a word that training has not seen leads back to it
        keys, weights = [np.arange(self.words)], [self.low]
        targets = [np.maximum(state_of[1], 0) if order > 1 else np.zeros(self.words, np.int64)]
        weight = self.low
        for k in range(2, order + 1):
            seen = np.flatnonzero(totals[k - 1] > 0)
            context, suffix = g.context[k - 1][seen], g.suffix[k - 1][seen]
            l_k = 10.0 ** fail[k - 1][0]
            own = np.zeros(len(totals[k - 1]))
            own[seen] = np.log10((1 - l_k) * totals[k - 1][seen] / totals[k - 2][context] + l_k * 10.0 ** weight[suffix])
            keys.append(state_of[k - 1][context] * self.words + g.word[k - 1][seen])
            weights.append(own[seen])
            targets.append(state_of[k][seen] if k < order else state_of[k - 1][suffix])
            weight = own
        key = np.concatenate(keys)
        by = np.argsort(key, kind="stable").astype(np.int32)
        self.keys, self.weight, self.target = key[by], np.concatenate(weights)[by], np.concatenate(targets).astype(np.int32)[by]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, log10 probability) of reading a word in each state."""
        state, at, logp = state.copy(), np.empty(len(state), np.int64), np.zeros(len(state))
        look = np.arange(len(state))
        while len(look):
            key = state[look] * self.words + word[look]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[place] == key
            at[look[found]] = place[found]
            look = look[~found]
            logp[look] += self.fail[state[look]]
            state[look] = self.fail_to[state[look]]
        return self.target[at], logp + self.weight[at]

    def walk(self, seq: np.ndarray, first: np.ndarray, end: np.ndarray, order: int, stretch: int = STRETCH) -> np.ndarray:
        """log10 probability of each text: tokens ``first`` + 1 to ``end`` - 1 of ``seq``, after
        the start at ``first``."""
        pieces = -(-(end - first - 1) // stretch)
        text = np.repeat(np.arange(len(first)), pieces)
        begin = first[text] + 1 + tb.ragged(np.zeros(len(first), np.int64), pieces) * stretch
        stop = np.minimum(begin + stretch, end[text])
        state, logp = np.zeros(len(text), np.int64), np.zeros(len(text))
        back = max(order - 1, 1)
        for t in range(-back, int((stop - begin).max(initial=0))):
            at = begin + t
            own = np.flatnonzero((at >= first[text]) & (at < stop))
            state[own], p = self.step(state[own], seq[at[own]])
            if t >= 0:
                logp[own] += p
        return np.bincount(text, logp, len(first))


def traverse(g: Grams, totals: list[np.ndarray], sums: dict[int, tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, score) of each text."""
    machine, start = Automaton(g, totals, sums), g.end - g.n
    add = lambda x: np.add.reduceat(np.where(g.first, 0, x), start)
    return add((totals[0][g.at[0]] > 0).astype(np.int64)), add(machine.low[g.at[0]]), machine.walk(g.at[0], start, g.end, len(totals))


def score(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n"), F.count("*").alias("d")).first()
    partitions = max(1, -(-((size.n or 0) + 16 * size.d) // PARTITION_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = write_blocks(docs, id_col, text_col)
    got, sums = answers(blocks, order, partitions)
    tokens = sums.get(1, (0, 0, 0))[0]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        (g, raws, flags), totals, alone = _opened(rows, order), [], None
        for k in range(1, order + 1):
            totals.append(g.totals(k, raws[k], alone))
            if 1 < k < order:
                alone = g.alone(k, flags[k], alone)
        known, base, full = traverse(g, totals, sums)
        return pd.DataFrame({"doc_id": pd.array(np.where(g.known, g.ids, 0), "Int64").copy(), "held_out": g.held, "n_tokens": g.n - 1, "n_known": known,
                             "train_tokens": tokens, "base_score": base, "score": full}).assign(
            doc_id=lambda f: f.doc_id.mask(~g.known))

    return _gathered(blocks, got, partitions, True).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, trigram automaton."""
    return score(read_table(spark, sf_dir, "documents"))
