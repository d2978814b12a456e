"""Cross-tokenizer alignment (op12) against a plain version on whole texts."""

import collections
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import common, cross_align as ca
from ledgerlens.llm.pair_index_bpe import byte_letters
from tests.llm import edge

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in enumerate(byte_letters())}

    def tokens(text):
        """(ids and ends of A, of B), or empty ones."""
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        pieces_a = [bytes(byte_of[c] for c in t.id_to_token(i)) for i in a]
        pieces_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode() if text else b""
        if b"".join(pieces_a) != whole or b"".join(pieces_b) != whole:
            return [], [], [], []
        return a, np.cumsum([len(p) for p in pieces_a]).tolist(), b, np.cumsum([len(p) for p in pieces_b]).tolist()

    def run(texts):
        found, count = [], collections.Counter()
        for text in texts:
            a, ea, b, eb = tokens(text or "")
            both = sorted(set(ea) & set(eb))
            groups, i, j, pairs = [], 0, 0, []
            for e in both:
                x, y = ea.index(e, i) + 1, eb.index(e, j) + 1
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                pairs.append((a[x - 1], b[y - 1]))
                i, j = x, y
            count.update(pairs)
            found.append((len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        best = {}
        for (_, b), n in count.items():
            best[b] = max(best.get(b, 0), n)
        return [(na, nb, ng, len(p), sum(count[x] == best[x[1]] for x in p), sum(count[x] for x in p), sha) for na, nb, ng, p, sha in found]

    return run


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("short", [1, 2, 16])
def test_shared_cuts_of_random_ends(short):
    r = random.Random(4)
    for _ in range(300):
        ea, eb, na, nb, want, at = [], [], [0], [0], [], 0
        for _ in range(r.randint(0, 5)):
            n = r.choice([0, 1, 2, 10, 200])
            dense = r.choice([0.05, 0.5, 0.95])
            a = sorted({i for i in range(1, n) if r.random() < dense} | ({n} if n else set()))
            b = sorted({i for i in range(1, n) if r.random() < r.choice([0.05, 0.5])} | ({n} if n else set()))
            want += sorted(at + e for e in set(a) & set(b))
            ea += [at + e for e in a]
            eb += [at + e for e in b]
            at += n
            na.append(len(ea))
            nb.append(len(eb))
        ea, eb = np.array(ea, np.int64), np.array(eb, np.int64)
        x, y = ca.shared_cuts(ea, eb, np.array(na), np.array(nb), short)
        assert ea[x].tolist() == want and eb[y].tolist() == want


def _odd():
    r = random.Random(8)
    al = [*"ab é中 \n\t.,'", "▁", "<|endoftext|>", "<s>", "<0x41>", "  ", "    ", "\x00", "naïve", " the", "ing", "　", "🙂"]
    return [(200 + i, "".join(r.choice(al) for _ in range(r.randint(1, 25)))) for i in range(150)]


def test_odd_documents(spark, plain, monkeypatch):
    rows = edge.texts() + _odd() + [(400, " "), (401, "  x"), (402, "x  "), (403, "▁"), (404, "\n")]
    want = sorted(((i is None, i or 0, *w) for (i, _), w in zip(rows, plain([t for _, t in rows]))))
    docs = edge.documents(spark, rows)
    read = lambda: sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in COLUMNS)) for r in ca.score_links(docs, A, B).collect())
    assert read() == want
    # the way beyond the broadcast: hot pairs apart, the rest by a shuffle
    monkeypatch.setattr(ca, "lookup", lambda *a: common.lookup(*a, limit=50, hot=3))
    assert read() == want
    assert ca.score_links(edge.empty(spark), A, B).count() == 0


@pytest.mark.parametrize("piece", [1, 2, 7, 1000])
def test_digests_do_not_depend_on_the_piece(monkeypatch, piece):
    monkeypatch.setattr(ca, "PIECE", piece)
    seq, before = np.arange(20) * 37 % 50, np.array([0, 0, 3, 3, 9, 20, 20])
    mark = np.where(np.arange(20) % 4, 0x2C, 0x7C).astype(np.uint8)
    want = []
    for a, b in zip(before[:-1], before[1:]):
        text = "".join(f"{i}{chr(m)}" for i, m in zip(seq[a:b], mark[a:b]))[:-1]
        want.append(hashlib.sha256(text.encode()).hexdigest() if b > a else "")
    assert ca._digests(ca._digits(50), seq, mark, before) == want


def test_groups_are_kept(spark):
    got = ca.align(edge.documents(spark, _odd()[:20], clash=False), A, B, keep_groups=True).collect()
    for r in got:
        parts = [(",".join(map(str, r.a_ids[i:x])), ",".join(map(str, r.b_ids[j:y])))
                 for i, x, j, y in zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts)]
        text = ";".join(map("|".join, parts))
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if parts else "") and len(parts) == r.n_groups


def test_query_on_whole_documents(spark, sf_small, plain):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: w for d, w in zip(docs, plain([d.text for d in docs]))}
    got = ca.op12_shared_cut_alignment(spark, sf_small).collect()
    assert len(got) == len(docs) and {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want
