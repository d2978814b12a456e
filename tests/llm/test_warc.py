"""WARC archives (op13): bytes on disk, round trip, assembly of transactions."""

import glob
import gzip
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import common, warc
from ledgerlens.llm.common import scratch, written
from tests.llm import edge

END = b"\r\n\r\n"
SCHEMA = "page_id long, url string, html string, " + ", ".join(f"{c} long" for c in edge.CLASH)


def _pages(spark, rows):
    return spark.createDataFrame([(*r, *([k] * len(edge.CLASH))) for k, r in enumerate(rows)], SCHEMA)


def _odd_rows():
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9999\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 3
    html = ["", None, "x", "a" * 99, "a" * 100, "é" * 50, "é" * 49, "\r\n" * 60, "\r" * 100, END.decode() * 40, inner, "x" * 120 + "\r\n", "x" * 120 + "\r",
            "\n" * 100, "\r\n\r" * 40, "long " * 300_000]
    r = random.Random(2)
    html += ["".join(r.choice("\r\na ") for _ in range(r.randint(80, 140))) for _ in range(30)]
    rows = [(i, r.choice([None, "http://a.example/x y", f"https://b.example/{i}?q=1#z", "not a url", "", "http://h/\r\nWARC-Type: x"]), h) for i, h in enumerate(html)]
    rows += [(100 + i, f"http://c.example/{i}", h) for i, (_, _, h) in enumerate(rows)]         # copies of all
    rows += [(50 + i, None, "same body " * 20) for i in range(9)] + [(None, "http://n", "same body " * 20), (None, None, None), (None, "http://u", "only null " * 30)]
    return rows + [rows[4], rows[4], rows[60], rows[2]]                                          # rows that repeat


def _plain(rows):
    first, out = {}, []
    body = [((h or "").encode(), i) for i, _, h in rows]
    for b, i in body:
        if len(b) >= 100:
            first[b] = min(first.get(b, (True, 0)), (i is None, i or 0))
    seen = set()
    for b, i in body:
        key = (b, i is None, i or 0)
        answer = len(b) < 100 or (first[b] == key[1:] and key not in seen)
        seen.add(key)
        to = None if answer or first[b][0] else first[b][1]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if answer else "revisit", to))
    return out


def _sorted(rows):
    return sorted(rows, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch(spark, "warc")
    warc.write_archives(spark, warc.spool(_pages(spark, _odd_rows())), path)
    return path


def test_files_are_warc(archive):
    """A plain parser of the format, over the bytes on disk."""
    kinds, ids, links = [], set(), []
    for name in glob.glob(f"{archive}/*.gz"):
        raw = gzip.open(name).read()
        at = 0
        while at < len(raw):
            end = raw.index(END, at)
            lines = raw[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            h = dict(x.split(": ", 1) for x in lines[1:])
            n = int(h["Content-Length"])
            assert raw[end + 4 + n:end + 8 + n] == END
            if h["WARC-Type"] == "response":
                payload = raw[end + 4:end + 4 + n].split(END, 1)[1]
                assert h["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            kinds.append(h["WARC-Type"])
            ids.add(h["WARC-Record-ID"])
            links += [h[k] for k in ("WARC-Concurrent-To", "WARC-Refers-To") if k in h]
            at = end + 8 + n
    n = len(_odd_rows())
    assert kinds.count("request") == kinds.count("metadata") == kinds.count("response") + kinds.count("revisit") == n
    assert len(ids) == 3 * n and set(links) <= ids and "revisit" in kinds


def test_round_trip_of_odd_pages(spark, archive, monkeypatch):
    got = warc.pages_of(spark, archive).collect()
    assert _sorted(tuple(r[c] for c in COLUMNS) for r in got) == _sorted(_plain(_odd_rows()))
    # beyond the broadcast: hot payloads apart, the rest by a shuffle
    monkeypatch.setattr(warc, "lookup", lambda *a: common.lookup(*a, limit=2, hot=4))
    path = scratch(spark, "warc")
    warc.write_archives(spark, warc.spool(_pages(spark, _odd_rows())), path)
    got = warc.pages_of(spark, path).collect()
    assert _sorted(tuple(r[c] for c in COLUMNS) for r in got) == _sorted(_plain(_odd_rows()))


def test_payloads_come_back(spark, archive):
    got = warc.read_records(spark, archive, keep_payload=True).filter("type = 'response'").collect()
    assert all(r.intact and hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got)
    assert {bytes(r.payload) for r in got} == {(h or "").encode() for _, _, h in _odd_rows()}


def test_empty_table(spark):
    path = scratch(spark, "warc")
    warc.write_archives(spark, warc.spool(_pages(spark, [])), path)
    assert warc.pages_of(spark, path).count() == 0


def _record(kind, rid, to=(), block=b"k: v\r\n", content="application/warc-fields", more=""):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n" + "".join(f"warc-concurrent-to: {t}\r\n" for t in to)
    return (head + more + f"Content-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + END


def _archive(spark, *files):
    path = scratch(spark, "foreign")
    for k, members in enumerate(files):
        spark.createDataFrame([("x",)], "value string").limit(0).write.mode("append").text(path)
        with open(f"{path}/{k}.warc.gz", "wb") as f:
            for m in members:          # a gzip member a record, as archives have them
                f.write(gzip.compress(m))
    return path


def test_transactions_through_all_ways_of_pointing(spark):
    http = "application/http; msgtype=response"
    body = b"HTTP/1.1 404 Not Found\r\nA: b\r\n\r\nbody"
    one = [_record("warcinfo", "<i>"), _record("request", "<q1>", ["<r1>"], b"GET / HTTP/1.1\r\n\r\n", "application/http; msgtype=request"),
           _record("response", "<r1>", (), body, http), _record("metadata", "<m1>", ["<q1>"])]     # metadata names the request
    two = [_record("request", "<q2>", (), b"GET / HTTP/1.1\r\n\r\n"), _record("metadata", "<m2>", ["<gone>"]),
           _record("response", "<r2>", ["<q2>"], b"", http),                                        # the response names the request
           _record("metadata", "<m3>", ["<q3>", "<r3>"]), _record("resource", "<r3>", (), b"file", "text/plain"),
           _record("request", "<q3>", ["<r3>"])] + [_record("metadata", f"<n{i}>", ["<r3>"]) for i in range(25)]
    records = written(warc.read_records(spark, _archive(spark, one, two)), "records")
    got = {(r.capture_id, r.part): r for r in warc.assemble(records, part=10).collect()}
    r1 = got["<r1>", 0]
    assert (r1.response.status, r1.response.payload_bytes) == (404, 4)
    assert [q.record_id for q in r1.requests] == ["<q1>"] and [m.record_id for m in r1.metadata] == ["<m1>"] and r1.metadata[0].fields == {"k": "v"}
    assert [q.record_id for q in got["<r2>", 0].requests] == ["<q2>"]
    assert got["<gone>", 0].response is None and got["<gone>", 0].metadata[0].record_id == "<m2>"
    assert got["<i>", 0].response is None
    big = [r for (c, _), r in got.items() if c == "<r3>"]
    assert sum(r.response is not None for r in big) == 1 and len(big) > 1
    assert sorted(m.record_id for r in big for m in r.metadata) == sorted(["<m3>", *(f"<n{i}>" for i in range(25))])
    assert sorted(q.record_id for r in big for q in r.requests) == ["<q3>"]


def test_damaged_archives_are_errors(spark):
    whole = _record("metadata", "<m>", ["<r>"], b"x" * 500)
    for bad in ([whole[:-100]], [b"noise" + whole], [whole, b"more"]):
        with pytest.raises(Exception, match="WARC record|inside a record"):
            warc.read_records(spark, _archive(spark, bad)).collect()


def test_query_equals_its_sql(spark, sf_small):
    got = warc.op13_warc_transactions(spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_small}/pages.parquet'")
    want = con.execute(warc.OP13_SQL)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = want.fetchall()
    assert _sorted(map(tuple, got.select(*names).collect())) == _sorted(rows)
