"""Fill-in-middle (op11) against a plain version on code points, and its SQL."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import fill_in_middle as fim, textbytes as tb
from tests.llm import edge

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=50):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    i, j = sorted(x % (len(units) + 1) for x in h[:2])
    a, m, z = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}"
    return doc_id, len(units), "psm", len(a), len(m), f"<P>{a}<S>{z}<M>{m}"


@pytest.mark.parametrize("block", [1, 3, 16, 256])
def test_every_cut_of_odd_texts(block):
    r = random.Random(block)
    texts = ["", " ", "a", " a ", "é" * 40, "\t\n x\r", *("".join(r.choice("ab é中 \n\t\x1f ") for _ in range(r.randint(0, 90))) for _ in range(80))]
    data, offs = tb.spans(pa.array(texts))
    b = fim.build(data, offs, block)
    units = [UNIT.findall(t) for t in texts]
    assert b.n_units.tolist() == [len(u) for u in units] and b.n_points.tolist() == [len(t) for t in texts]
    which = np.array([t for t, u in enumerate(units) for _ in range(len(u) + 1)])
    k = np.array([i for u in units for i in range(len(u) + 1)])
    byte, point = fim.cut(b, which, k, block)
    want = ["".join(units[t][:i]) for t, i in zip(which, k)]
    assert byte.tolist() == [len(w.encode()) for w in want] and point.tolist() == [len(w) for w in want]


def test_trees_hold_low_bit_sums():
    data, offs = tb.spans(pa.array(["ab " * 40, "", "xyz"]))
    b = fim.build(data, offs, 8)
    for t in range(3):
        per = [int(b.ends[i:min(i + 8, offs[t + 1])].sum()) for i in range(offs[t], offs[t + 1], 8)]
        for k in range(1, len(per) + 1):
            assert b.units[b.base[t] + k] == sum(per[k - (k & -k):k])


@pytest.mark.parametrize("rate", [0, 50, 100])
def test_odd_documents(spark, rate):
    rows = edge.texts() + [(60, "a <P> b c"), (61, "cut <S"), (62, "> <P"), (63, "< M> x < P >"), (64, "<M>"), (65, "<S x <P y <M z")]
    rows += [(100 + i, "w é " * (i % 7) + "<" * (i % 3)) for i in range(80)]
    got = fim.transform(edge.documents(spark, rows), rate=rate).withColumn("text", fim.restored()).collect()
    key = lambda x: str((x[0] is None, x[0] or 0, *x[1:]))
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == \
        sorted((plain(i, t, rate) for i, t in rows), key=key)
    assert sorted(r.text for r in got) == sorted(t or "" for _, t in rows)
    if rate == 100:
        assert {r.form for r in got} == {"plain", "spm", "psm"}
    for r in got:
        if r.form != "plain":
            assert r.text.encode()[:r.prefix_bytes].decode() == r.text[:r.prefix_chars]
    assert fim.transform(edge.empty(spark)).count() == 0


def test_query_equals_its_sql(spark, sf_small):
    got = fim.op11_fenwick_fim(spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    want = con.execute(fim.OP11_SQL)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
    assert {f: c for f, c in got.groupBy("form").count().collect()}.keys() == {"plain", "spm", "psm"}
