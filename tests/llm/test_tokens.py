"""Chunks, PFOR blocks (op1), pair-index BPE (op9) and edit counts (op10)
against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from ledgerlens.llm import edit_counts, pair_index_bpe, textbytes as tb, token_blocks
from ledgerlens.llm.common import scratch
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def _odd_texts(n=1500):
    r = random.Random(1)
    al = [*"aé \n'st<|endoftext|>1,.  中\t\r\x1f\u00a0\u2003", "<|endoftext|>", "'s", "  ", " \n", "aaaa", "abab"]
    return ["".join(r.choice(al) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("high", [1, 2, 50257, 2 ** 32])
def test_pfor_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    ids[5::17] = high - 1
    payload = token_blocks.encode_ids(ids)
    assert (token_blocks.decode_ids(payload) == ids).all()
    for b in range(-(-n // token_blocks.BLOCK)):
        assert (token_blocks.read_block(payload, b) == ids[b * 128:(b + 1) * 128]).all()


def test_pfor_packs_outliers_apart():
    ids = np.full(128, 40, np.uint32)
    ids[:100] += np.arange(100, dtype=np.uint32) % 4
    ids[7] = 50_000
    _, _, low, width, _, exc = token_blocks._open(token_blocks.encode_ids(ids))
    assert low[0] == 40 and width[0] == 2 and exc.tolist() == [[7, 50_000 - 40]]


@pytest.mark.parametrize("state", [pair_index_bpe.state(PATH)[1:3], token_blocks._encoder(PATH)])
def test_chunks_encode_as_the_library(lib, state):
    texts = [*_odd_texts(), "", "x" * 20_000, "ab" * 3000, "aaa" * 1001]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for a, b, data, offs in tb.slices(batch, "text", limit=30_000):
        ids, at = tb.encode_slice(*state, data, offs, token_blocks.SPECIAL)
        for i in range(a, b):
            assert ids[at[i - a]:at[i - a + 1]].tolist() == lib(texts[i]), texts[i][:60]


def test_pool_starts_anew_and_stays_right(lib):
    encode = pair_index_bpe.state(PATH)[2]
    pool = tb.ChunkPool(most=50)
    texts = _odd_texts(400)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for a, b, data, offs in tb.slices(batch, "text", limit=500):
        ids, at = tb.encode_slice(pool, encode, data, offs, token_blocks.SPECIAL)
        assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [lib(t) for t in texts[a:b]]
    assert len(pool.keys) < 500


def _thue_morse(n: int = 1024) -> tuple[str, str]:
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_structured_words_have_hashes_of_their_own():
    texts = [*_thue_morse(), *_thue_morse(2048), "a" * 1024, "a" * 1023, "a" * 8 + "b" * 8, "b" * 8 + "a" * 8, "\x01", "\x01\x00"]
    data, offs = tb.spans(pa.array(texts))
    assert len(set(tb.segment_hashes(data, offs[:-1], offs[1:]).tolist())) == len(texts)
    assert len(set(tb.word_hashes(data, offs)[0].tolist())) == len(texts)


@pytest.mark.parametrize("state", [pair_index_bpe.state(PATH)[1:3], token_blocks._encoder(PATH)])
def test_equal_hashes_of_other_chunks_do_not_decide(lib, state, monkeypatch):
    texts = [*_thue_morse(), *_odd_texts(60)] * 2
    whole = tb.segment_hashes
    for bits in (64, 5, 0):
        monkeypatch.setattr(tb, "segment_hashes", lambda *a, **k: whole(*a, **k) & np.uint64(2 ** bits - 1))
        pool = tb.ChunkPool()
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
        for a, b, data, offs in tb.slices(batch, "text", limit=3000):
            ids, at = tb.encode_slice(pool, state[1], data, offs, token_blocks.SPECIAL)
            assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [lib(t) for t in texts[a:b]]


def test_words_as_the_patterns():
    texts = [*_odd_texts(300), "", "A", "zZ9 é-ü"]
    data, offs = tb.spans(pa.array(texts))
    raw = data.tobytes()
    for kind, pattern in ((tb.SPACED, edge.words), (tb.ALNUM, edge.alnum)):
        s, e, first = tb.word_spans(data, offs, kind)
        h, _ = tb.word_hashes(data, offs, kind)
        got = [[raw[x:y].decode().translate(edge.LOWER) for x, y in zip(s[a:b], e[a:b])] for a, b in zip(first[:-1], first[1:])]
        assert got == [pattern(t) for t in texts]
        assert len(set(h.tolist())) == len({w for t in got for w in t})


def test_op1_over_odd_documents(spark, lib):
    path = scratch(spark, "pfor")
    rows = edge.texts()
    token_blocks.encode_table(edge.documents(spark), path, PATH)
    segments = token_blocks.read_segments(spark, path)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_blocks.digest(segments).collect())
    order = sorted(rows, key=lambda x: (-1 if x[0] is None else x[0], x[1] is not None, (x[1] or "").encode()))
    at, want, all_ids = 0, [], []
    for i, t in order:
        ids = [*lib(t), 0]
        want.append((-1 if i is None else i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        all_ids += ids
        at += len(ids)
    assert got == sorted(want)
    docs = token_blocks.documents_ids(segments).filter("doc_id = 7").collect()
    assert all(list(d.ids) == all_ids[d.start:d.start + len(d.ids)] for d in docs) and len(docs) == 3


def test_op1_ranges_and_empty_table(spark, sf_small, lib):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # keeps several ranges
    try:
        got = {r.doc_id: r for r in token_blocks.op1_pfor_token_blocks(spark, sf_small).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    at = 0
    for d in docs:
        ids = [*lib(d.text), 0]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    path = scratch(spark, "pfor")
    token_blocks.encode_table(edge.empty(spark), path, PATH)
    assert token_blocks.digest(token_blocks.read_segments(spark, path)).count() == 0


def _digest(ids, text):
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op9_over_odd_documents(spark, sf_small, lib):
    t = Tokenizer.from_file(PATH)
    rows = edge.texts()
    got = pair_index_bpe.encode_documents(edge.documents(spark), PATH, keep_ids=True).collect()
    want = [(i, *_digest(lib(x), t.decode(lib(x), skip_special_tokens=False))) for i, x in rows]
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got))) == sorted(map(str, want))
    assert sorted(len(r.ids) for r in got) == sorted(w[1] for w in want)
    assert pair_index_bpe.encode_documents(edge.empty(spark), PATH).count() == 0
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in pair_index_bpe.op9_pair_index_bpe(spark, sf_small).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _digest(lib(docs[r.doc_id]), docs[r.doc_id])


def test_segment_tree_follows_random_edits(lib):
    again = edit_counts._stretch_encoder(PATH)
    r = random.Random(3)
    al = [*"abc xyz'st<|.,  \n\n12é中 ", "<|endoftext|>", "'s", " \n", "endoftext|>", "<|endof", "  "]
    for _ in range(60):
        text = "".join(r.choice(al) for _ in range(r.randint(0, r.choice([20, 400, 4000]))))
        tree = edit_counts.SegmentTree(text.encode(), *again(text.encode()), again)
        for _ in range(r.randint(1, 12)):
            i = r.randint(0, len(text))
            j = min(len(text), i + r.choice([0, 0, 1, 3, 20, 300]))
            new = "".join(r.choice(al) for _ in range(r.choice([0, 1, 3, 30, 200])))
            tree.replace(len(text[:i].encode()), len(text[:j].encode()), new.encode())
            text = text[:i] + new + text[j:]
            assert tree.whole() == text.encode() and tree.total() == len(lib(text))


def test_an_edit_encodes_its_surroundings_only(lib):
    again = edit_counts._stretch_encoder(PATH)
    text = ("some words here. " * 5000).encode()
    tree = edit_counts.SegmentTree(text, *again(text), again)
    tree.replace(40_000, 40_005, b"other")
    assert tree.encoded < 200 and tree.total() == len(lib(tree.whole().decode()))


def _edited(text: str | None) -> str:
    import re
    out, seen = [], set()
    for k, line in enumerate((text or "").split("\n")):
        if not (k and line in seen):
            out.append(line)
        seen.add(line)
    return re.sub(r"[0-9]{3,}", "<num>", "\n".join(out))


def test_op10_counts_equal_full_encoding(spark, sf_small, lib):
    for docs in (edge.documents(spark), spark.read.parquet(f"{sf_small}/documents.parquet")):
        rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect()))
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_tokens_after, r.text_crc32_after)
                      for r in edit_counts.count_with_edits(docs, PATH).collect()))
        want = sorted((a, i, len(lib(t)), len(lib(_edited(t))), zlib.crc32(_edited(t).encode())) for a, i, t in rows)
        assert got == want
    assert edit_counts.count_with_edits(edge.empty(spark), PATH).count() == 0
