"""K-d tree shards (op2) and the URL filter (op8)."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import kdtree_shards as kd, url_markov as um
from tests.compare import compare, duck
from tests.llm import edge


def _check(rows, texts, shards):
    assert sorted(Counter((r.doc_id, r.size, r.text_crc32) for r in rows).items(), key=str) == sorted(Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts).items(), key=str)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {k: sum(r.size for r in v) for k, v in by.items()}


def test_op2_bytes_are_nearly_equal(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    sums = _check(kd.op2_kdtree_shards(spark, sf_small).collect(), docs, 16)
    most = max(len(t.encode()) for _, t in docs)
    assert len(sums) == 16 and max(sums.values()) - min(sums.values()) <= 4 * most


def test_op2_one_value_for_all_and_many_parts(spark, monkeypatch):
    monkeypatch.setattr(kd, "PART_ROWS", 8)
    rows = [(i, "same text") for i in range(1600)]
    sums = _check(kd.shard(edge.documents(spark, rows)).collect(), rows, 16)
    assert max(sums.values()) - min(sums.values()) <= 4 * 10


def test_op2_odd_documents(spark):
    _check(kd.shard(edge.documents(spark)).collect(), edge.texts(), 16)
    _check(kd.shard(edge.documents(spark, [(None, None)] * 50)).collect(), [(None, None)] * 50, 16)
    assert kd.shard(edge.empty(spark)).count() == 0
    assert kd.depth_for(1000, 100) == 4 and kd.depth_for(10, 100) == 0


def test_op2_cuts_the_widest_dimension_at_the_weighted_median(spark):
    rows = [(i, "x" * (1 if i < 900 else 500), None, None, 10) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = kd.shard(docs, depth=1, dims={"doc_id": "number"}).collect()
    left = {r.doc_id for r in got if r.shard == 0}
    edge_id = max(left)
    assert left == set(range(edge_id + 1)) and abs(sum(r.size for r in got if r.shard == 0) / sum(r.size for r in got) - 0.5) < 0.01


URLS = ["http://A.Example.ORG/en/12?x=1", "https://example.org/es/1", "http://example.org/en/2", "http://notorg/x", "ftp://org/", "http://org",
        "https://x.com/fr/1", "https://com/de/", "http://u@x.com/fr/", "http://x.com:80/fr/", "http://q.net/en/1#t", "no scheme", "", None,
        "a://b://c/d", "http://é.org/ü?y", "http://x.com/de/1/2#z", "http://example.org/en/1\nx", "http:///path", "x" * 3000 + "://net/" + "y" * 100_000]


def _plain(url):
    rest = (url or "").split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0] if rest[len(host):len(host) + 1] == "/" else ""
    host = host.translate(edge.LOWER)
    best = None
    for verdict, h, p in um.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best


def _pages(spark, urls):
    return spark.createDataFrame([(None if k % 6 == 0 else k // 2, u, "allow", 1.0, k) for k, u in enumerate(urls)],
                                 "page_id long, url string, verdict string, score double, uid long")


def test_op8_hosts_paths_and_rules(spark):
    got = um.judge(_pages(spark, URLS * 2)).collect()
    assert len(got) == 2 * len(URLS)
    want = Counter()
    for u in URLS * 2:
        host, path, best = _plain(u)
        want[host, path, best and best[0], best and best[1]] += 1
    assert Counter((r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == want
    assert all(r.verdict in ("allow", "block") for r in got)
    assert um.judge(_pages(spark, [])).count() == 0
    assert {r.verdict for r in um.judge(_pages(spark, ["http://a.net/", None, ""])).collect()} == {"allow"}     # nothing to learn from


def test_op8_matches_its_sql(spark, sf_small):
    ok, msg = compare(um.op8_url_markov_ratio(spark, sf_small), duck(sf_small), um.OP8_SQL)
    assert ok, msg


def test_op8_ratio_by_brute_force(spark):
    """Counts, Witten-Bell mixing and scores of a small set, in plain Python."""
    order, grams = 2, Counter()
    urls = {"aa/b": "allow", "ab/b": "allow", "ba/a": "block", "bb/ab": "block"}
    rows = []
    for u, kind in urls.items():
        s = um.OPEN * order + u + um.CLOSE
        rows += [(s[i:i + order + 1], int(kind == "allow"), int(kind == "block")) for i in range(len(u) + 1)]
    df = spark.createDataFrame(rows, "gram string, a long, r long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    got = {r.gram: r["diff"] for r in um.ratios(df, order).collect()}

    def p(kind, gram):
        if not gram:
            return 1 / um.ALPHABET
        pos = 1 if kind == "allow" else 2
        own = sum(r[pos] for r in rows if r[0].endswith(gram))
        follow = Counter()
        for r in rows:
            if r[0][:-1].endswith(gram[:-1]):
                follow[r[0][-1]] += r[pos]
        n, t = sum(follow.values()), sum(v > 0 for v in follow.values())
        low = p(kind, gram[1:])
        return (own + t * low) / (n + t) if n else low

    for gram, diff in got.items():
        assert math.isclose(diff, math.log(p("allow", gram)) - math.log(p("block", gram)), rel_tol=1e-9, abs_tol=1e-12)


def test_op8_separates_unseen_urls(spark):
    made = [f"http://shop{i}.org/garden/rose-{i}" for i in range(60)] + [f"http://c{i}.com/de/casino-win-{i}" for i in range(60)]
    new = [f"http://z{i}.net/garden/rose-{i}" for i in range(10)] + [f"http://z{i}.net/casino-win-{i}" for i in range(10)]
    got = um.judge(spark.createDataFrame([(k, u) for k, u in enumerate(made + new)], "page_id long, url string"))
    verdicts = [r.verdict for r in got.filter("page_id >= 120").orderBy("page_id").collect()]
    assert verdicts == ["allow"] * 10 + ["block"] * 10


def test_op8_and_op2_run_no_python(spark, sf_small):
    for df in (um.op8_url_markov_ratio(spark, sf_small), kd.op2_kdtree_shards(spark, sf_small)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("bad", [0.0])
def test_op8_threshold_without_examples(spark, bad):
    empty = spark.createDataFrame([], "score double, accepted boolean")
    assert um.calibrated(empty) == bad
