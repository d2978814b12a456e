"""Components, HyperMinHash near-dedup (op3) and spherical-cap filters (op7)."""

import random

import numpy as np
import pytest

from ledgerlens.llm import cap_filters as cf, common, hyperminhash as hm
from ledgerlens.llm.components import components
from tests.compare import compare, duck
from tests.llm import edge


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_random_graphs(spark):
    r = random.Random(2)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)]          # many components
    links += [(1000, 1000 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(40)] + [(5, 5), (7, 7)] + links[:9]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots({n for e in links for n in e}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, size):
    w = edge.words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, threshold=80):
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    root = roots(ids, links)
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in ids)


def near_copies(n, seed=0):
    """Families of texts with a word or more changed, from equal to unlike."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.choice([1, 2, 3, 5, 8, 20, 60, 200]))]
        for _ in range(r.randint(1, 12)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8, 16])):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy).upper() if r.random() < 0.3 else "\n ".join(copy))
    r.shuffle(out)
    return [(i, t) for i, t in enumerate(out[:n])]


@pytest.mark.parametrize("size", [2, 5])
def test_op3_against_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(hm, "CELL", 7)                   # buckets are cut into chunks
    rows = near_copies(400, size)
    got = sorted(tuple(r) for r in hm.near_duplicates(edge.documents(spark, rows), size).collect())
    assert got == brute(rows, size)


def test_op3_matches_its_sql(spark, sf_small):
    ok, msg = compare(hm.op3_hyperminhash(spark, sf_small), duck(sf_small), hm.OP3_SQL)
    assert ok, msg


def test_op3_large_group_of_near_copies(spark):
    """Each differs from the base in a place of its own; the hub of a bucket
    does not link with all of them."""
    r = random.Random(4)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(60)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5])):
            copy[r.randrange(60)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy)))
    got = sorted(tuple(x) for x in hm.near_duplicates(edge.documents(spark, rows), 2).collect())
    assert got == brute(rows, 2)


def test_op3_texts_of_one_doc_id(spark):
    """A doc_id that repeats links by each of its texts, and no text is lost."""
    r = random.Random(9)
    t = [" ".join(f"w{r.randrange(50)}" for _ in range(25)) for _ in range(4)]
    rows = [(5, t[0]), (5, t[1]), (9, t[0]), (4, t[1]), (6, t[2]), (6, t[2]), (None, t[3]), (7, t[3])]
    got = sorted(str(tuple(x)) for x in hm.near_duplicates(edge.documents(spark, rows), 2).collect())
    n = [len(shingles(x, 2)) for x in t]
    assert got == sorted(map(str, [(5, n[0], 5, True), (9, n[0], 5, False), (5, n[1], 4, False), (4, n[1], 4, True), (6, n[2], 6, True), (6, n[2], 6, True),
                                   (None, n[3], None, True), (7, n[3], 7, True)]))


def test_op3_batches_are_small(spark, monkeypatch):
    """Texts and sets go to Python BATCH_ROWS rows at a time; the session's own number is back after, also
    when a step fails, and a lower one holds."""
    key, rows, most = "spark.sql.execution.arrow.maxRecordsPerBatch", edge.documents(spark), []
    before, written = spark.conf.get(key), hm.written
    monkeypatch.setattr(hm, "written", lambda df, name: (most.append((name, int(spark.conf.get(key)))), written(df, name))[1])
    hm.near_duplicates(rows, 2)
    assert {n for name, n in most if name != "numbered" and not name.endswith(("_components", "_names"))} == {hm.BATCH_ROWS}
    assert spark.conf.get(key) == before
    monkeypatch.setattr(hm, "components", lambda links: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        hm.near_duplicates(rows, 2)
    assert spark.conf.get(key) == before
    with common.arrow_rows(spark, int(before) + 1):
        assert spark.conf.get(key) == before


def test_op3_moves_only_what_is_in_a_pair(spark, monkeypatch):
    """Sketches of classes without a partner are not shuffled, nor are sets grouped again by doc_id."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)]
    rows += [(100, " ".join(f"v{j}" for j in range(60))), (101, " ".join(f"v{j}" for j in range(59)))]
    plans, written = {}, hm.written
    monkeypatch.setattr(hm, "written", lambda df, name: (plans.setdefault(name, df), written(df, name))[1])
    got = sorted(tuple(x) for x in hm.near_duplicates(edge.documents(spark, rows), 2).collect())
    assert got == brute(rows, 2)
    assert [sorted(tuple(x) for x in plans[k].collect()) for k in ("star", "star_pairs")] == [[(100, 101)]] * 2
    text = plans["star_pairs"]._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == 2 and "reg" in text.split("LeftSemi")[0]
    assert "Aggregate" not in plans["shingle_sets"]._jdf.queryExecution().optimizedPlan().toString()


def test_op3_ids_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(hm, "MAX_IDS", 0)
    rows = [(i, " ".join(f"w{j % (25 + i // 3)}y{i // 9}" for j in range(60 - i % 3))) for i in range(45)]
    assert sorted(tuple(x) for x in hm.near_duplicates(edge.documents(spark, rows), 2).collect()) == brute(rows, 2)


def test_op3_words_with_structured_bytes(spark):
    """Words that a sum of byte powers would take for one."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, f"x {word}"), (4, "x " + word.translate(str.maketrans("ab", "ba")))]
    assert sorted(tuple(x) for x in hm.near_duplicates(edge.documents(spark, rows), 2).collect()) == brute(rows, 2)


def test_op3_odd_documents(spark):
    rows = edge.texts()
    got = hm.near_duplicates(edge.documents(spark), 2).collect()
    named = {r.doc_id: r for r in got if r.doc_id is not None}
    want = {i: (n, c, k) for i, n, c, k in brute([x for x in dict(rows).items() if x[0] is not None], 2)}
    assert len(got) == len(rows)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in named.items()} == want
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert named[40].n_shingles == 0 and named[40].kept and named[47].component_id == 46 and not named[44].kept
    assert hm.near_duplicates(edge.empty(spark)).count() == 0


def test_op3_estimate_is_close():
    r = np.random.default_rng(0)
    for n, share in ((2000, 0.5), (2000, 0.8), (300, 0.8), (40, 0.9)):
        common = r.integers(0, 2 ** 63, int(n * share), dtype=np.uint64)
        est = []
        for _ in range(20):
            a, b = (np.unique(np.concatenate((common, r.integers(0, 2 ** 63, n - len(common), dtype=np.uint64)))) for _ in range(2))
            reg = hm.sketch(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            est.append(float(hm.estimate(reg[:1], reg[1:], np.array([len(a)]), np.array([len(b)]))[0]))
        true = len(common) / (2 * n - len(common))
        assert abs(np.mean(est) - true) < 0.05


def vectors(n, dim, seed, labels=3):
    r = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = r.standard_normal(dim)
        for _ in range(r.integers(1, 9)):
            out.append((base + r.standard_normal(dim) * r.choice([0, 0.05, 0.12, 0.16, 0.25])).astype(np.float32) * r.choice([1, 3]))
    return [(i, [float(x) for x in v], int(r.integers(0, labels))) for i, v in enumerate(out[:n])]


def brute_vectors(rows, threshold=0.98):
    ok = {i: np.array(v, float) for i, v, l in rows
          if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: l for i, _, l in rows}
    links = {i: 0 for i, _, _ in rows}
    edges, ids = [], sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if label[a] == label[b] and len(ok[a]) == len(ok[b]):
                x, y = ok[a], ok[b]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    edges.append((a, b))
                    links[a] += 1
                    links[b] += 1
    root = roots(links, edges)
    return sorted((i, links[i], root[i], root[i] == i) for i in links)


@pytest.mark.parametrize("dim,kind", [(64, "float"), (7, "double"), (2, "double")])
def test_op7_against_brute_force(spark, dim, kind, monkeypatch):
    monkeypatch.setattr(cf, "CELL", 4)
    rows = vectors(300, dim, dim)
    df = spark.createDataFrame([(*x, 1) for x in rows], f"vec_id long, embedding array<{kind}>, label int, n int")
    assert sorted(tuple(r) for r in cf.near_duplicates(df).collect()) == brute_vectors(rows)


def test_op7_matches_its_sql(spark, sf_small):
    ok, msg = compare(cf.op7_cap_filters(spark, sf_small), duck(sf_small), cf.OP7_SQL)
    assert ok, msg


def test_op7_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1),
            (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1), (14, [5.0], 1), (15, [1.0], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    got = sorted(tuple(r) for r in cf.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == brute_vectors(rows)
    extra = cf.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0], 1), *rows[:2]], schema)).collect()
    assert sorted(map(str, map(tuple, extra))) == sorted(map(str, [(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)]))
    assert cf.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_op7_filters_that_pairs_share():
    r = np.random.default_rng(1)
    x = r.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    shared = [len(np.intersect1d(a, b)) for a, b in zip(cf.decode_list(x), cf.decode_list(y))]
    assert min(shared) >= 2 and 15 < np.mean(shared) < 18
    assert cf.code_size(64) == cf.CODE and cf.code_size(7) < 64 and cf.code_size(2) ** 2 <= cf.LIST
    a, b = cf._codes(64, cf.CODE)
    whole = ((x[:5, :32] @ a.T)[:, :, None] + (x[:5, 32:] @ b.T)[:, None, :]).reshape(5, -1)
    assert (np.sort(np.argsort(-whole, axis=1)[:, :cf.LIST], axis=1) == cf.decode_list(x[:5])).all()


def _pairs(dim, kind, n, seed, cosine=0.981):
    """Vectors whose weight lies in one half or in few dimensions: ``n`` pairs of that cosine."""
    r = np.random.default_rng(seed)
    x, z = r.standard_normal((2, n, dim))
    for k in range(n):
        at = np.arange(dim // 2) if kind == "first" else np.arange(dim // 2, dim) if kind == "last" else r.permutation(dim)[:8]
        off = np.ones(dim, bool)
        off[at] = False
        x[k, off] = z[k, off] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)


@pytest.mark.parametrize("kind", ["first", "last", "sparse"])
def test_op7_weight_in_few_dimensions(spark, kind):
    x, y = _pairs(64, kind, 400, 5)
    rows = [(i, [float(q) for q in v], 1) for i, v in enumerate(np.concatenate((x, y)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in cf.near_duplicates(df).collect()) == brute_vectors(rows)


def test_op7_ties_at_the_cap_height_are_decoded_in_full():
    x = np.random.default_rng(3).standard_normal((50, 64))
    x[:30, 32:] = 0
    a, b = cf._codes(64, cf.CODE)
    for v, f in zip(x, cf.decode_list(x)):
        whole = ((a @ v[:32])[:, None] + b @ v[32:]).ravel()
        assert set(f[f >= 0]) == set(np.flatnonzero(whole >= np.sort(whole)[-cf.LIST] - cf.TIE))


def _apart(n, seed, cosine=0.9801):
    """``n`` pairs of that cosine whose second vector lies away from the caps of the first one's list."""
    r, (a, b), q = np.random.default_rng(seed), cf._codes(64, cf.CODE), cf.rotation(64)
    x = r.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    f = cf.decode_list(x)
    caps = np.concatenate((a[f // cf.CODE].mean(1), b[f % cf.CODE].mean(1)), axis=1)
    z = (caps * x).sum(1, keepdims=True) * x - caps
    return x @ q.T, (cosine * x + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)) @ q.T


@pytest.mark.parametrize("cell", [cf.CELL, 20])
def test_op7_pairs_that_share_no_cap_are_linked(spark, cell, monkeypatch):
    monkeypatch.setattr(cf, "CELL", cell)
    x, y = _apart(200, 4)
    own, other = (cf.decode_list(cf._unit(v) @ cf.rotation(64)) for v in (x, y))
    assert sum(not len(np.intersect1d(a, b)) for a, b in zip(own, other)) > 5
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(np.concatenate((x, y, y * 3)))]
    got = cf.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(tuple(r) for r in got) == brute_vectors(rows)


@pytest.mark.parametrize("few", [1, 3, 32])
def test_op7_a_pair_counts_in_its_lowest_filter_only(few, monkeypatch):
    monkeypatch.setattr(cf, "FEW", few)
    monkeypatch.setattr(cf, "FILTERS", 2)
    r = np.random.default_rng(2)
    left, right = (np.sort(r.permuted(np.tile(np.arange(30), (n, 1)), axis=1)[:, :3], axis=1) for n in (40, 25))
    left[::5, 2] = -1
    link = np.ones((40, 25), bool)
    cf._drop_lower(link, left, right, 20)
    shared = [[len({*a.tolist()} & {*b.tolist()} & {*range(20)}) for b in right] for a in left]
    assert (link == (np.array(shared) == 0)).all() and 0 < link.sum() < 1000


def _at_the_threshold(n, seed):
    """Pairs of whole-number vectors of 64 dimensions whose cosine is 49/50, each under a label of its own."""
    r, h = np.random.default_rng(seed), np.ones((1, 1))
    while len(h) < 64:
        h = np.block([[h, h], [h, -h]])
    out = []
    for k in range(n):
        x, at = np.zeros((2, 64)), r.permutation(64)[:4]
        x[0, at[0]], x[1, at] = r.integers(1, 50), r.integers(1, 50) * np.array([49, 9, 3, 3])
        out += [(2 * k + i, v.tolist(), k) for i, v in enumerate(x @ h)]
    return out


def test_op7_pairs_at_exactly_the_threshold_are_linked(spark):
    rows = _at_the_threshold(40, 3)
    got = cf.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(tuple(r) for r in got) == [(i, 1, i - i % 2, i % 2 == 0) for i in range(80)]
    x = np.array([v for _, v, _ in rows[:2]])
    x[1, 0] -= 1e-9 * x[1, 0]
    assert cf._linked(x, 0.98)[0, 1] == (x[0] @ x[1] / np.sqrt((x[0] @ x[0]) * (x[1] @ x[1])) >= 0.98)


def test_op7_lengths_whose_squares_leave_the_doubles(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [3e-200, 1e-203], 1), (3, [1e250, 0.0], 1), (4, [0.0, 1e250], 1)]
    got = cf.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]
