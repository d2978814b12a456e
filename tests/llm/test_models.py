"""Backoff automaton (op4), toxicity classifier (op5), decontamination (op6)
and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerlens.llm import backoff_automaton as lm, hyperminhash as hm, suffix_decontamination as sd, toxicity_cnn as tox
from tests.compare import compare, duck
from tests.llm import edge
from tests.llm.test_dedup import brute


def plain_lm(rows, order):
    """doc_id -> (held out, tokens, known, N, base, score), row by row."""
    counts = [None] + [Counter() for _ in range(order)]
    seqs = [["\0S", *edge.words(t), "\0E"] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    for q, h in zip(seqs, held):
        for k in range(1, order + 1) if not h else ():
            counts[k].update(tuple(q[p:p + k]) for p in range(len(q) - k + 1))
    starts = counts[1].pop(("\0S",), 0)
    total, distinct = sum(counts[1].values()), len(counts[1])
    counts[1][("\0S",)] = starts
    fail = {k: min(max(sum(v == 1 for v in counts[k].values()) / sum(counts[k].values()), 1e-3), 0.999) if counts[k] else 0.5
            for k in range(2, order + 1)}

    def p(g):
        if len(g) == 1:
            return (counts[1][g] + 0.5) / (total + 0.5 * (distinct + 1))
        h, low = counts[len(g) - 1][g[:-1]], p(g[1:])
        return (1 - fail[len(g)]) * counts[len(g)][g] / h + fail[len(g)] * low if h else low

    out = []
    for (i, _), q, h in zip(rows, seqs, held):
        score = sum(math.log10(p(tuple(q[max(0, e - order + 1):e + 1]))) for e in range(1, len(q)))
        base = sum(math.log10(p((w,))) for w in q[1:])
        out.append((i, h, len(q) - 1, sum(counts[1][(w,)] > 0 for w in q[1:]), total, round(base, 6), round(score, 6)))
    return sorted(map(str, out))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_op4_against_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    rows = [x for x in edge.texts() if x[0] != 43]
    got = lm.score(edge.documents(spark, rows), order).collect()
    assert sorted(str((*r[:5], round(r.base_score, 6), round(r.score, 6))) for r in got) == plain_lm(rows, order)


def _automaton(texts, order=3):
    """Automaton of one block that holds all texts, and its n-grams."""
    import pyarrow as pa
    data, offs = lm.tb.spans(pa.array(texts))
    words, first = lm.tb.word_hashes(data, offs, lm.tb.SPACED)
    n = len(texts)
    g = lm.Grams(lm._block([np.arange(n)], [np.ones(n, bool)], [np.arange(n) % 4 == 3], [words], [np.diff(first)]), order)
    totals = [g.training(k) for k in range(1, order + 1)]
    sums = {k: tuple(lm._sums(t if k > 1 else t[g.hash[0] != lm.START]).tolist()) for k, t in enumerate(totals, 1)}
    return g, totals, lm.Automaton(g, totals, sums)


def test_op4_states_arcs_and_failures():
    g, totals, m = _automaton(["a b a b c", "a b d", "b c", "x y z a b"])
    seen = sum(int((t > 0).sum()) for t in totals[:-1])
    assert len(m.fail_to) == 1 + seen                       # a state for each seen context, and the empty one
    assert (np.diff(m.keys) > 0).all() and len(m.keys) == m.words + sum(int((t > 0).sum()) for t in totals[1:])
    assert (m.fail_to[1:] < np.arange(1, len(m.fail_to))).all()
    state, depth = np.arange(len(m.fail_to)), 0
    while state.any():
        state, depth = m.fail_to[state], depth + 1
    assert depth == 2                                       # two words, one word, none


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_op4_pieces_of_a_text_walk_as_the_whole(order):
    r = random.Random(order)
    g, _, m = _automaton([" ".join(r.choice("abcde") for _ in range(r.choice([0, 1, 5, 40, 300]))) for _ in range(40)], order)
    whole = m.walk(g.at[0], g.end - g.n, g.end, order, 10 ** 6)
    for stretch in (1, 2, 7, 128):
        assert np.allclose(m.walk(g.at[0], g.end - g.n, g.end, order, stretch), whole)


def test_op4_grams_of_one_block_are_not_asked_for():
    g, _, _ = _automaton(["a b c d", "a b e"])
    alone = np.ones(len(g.hash[1]), bool)
    assert g.inferred(3, alone).all() and not g.inferred(3, ~alone).any()
    alone[:] = False
    alone[g.at[1][2]] = True                                 # "a b" (the second word of the first text)
    tri = g.inferred(3, alone)
    assert tri[g.at[2][2]] and tri[g.at[2][3]] and not tri[g.at[2][4]]


def test_op4_words_with_structured_bytes(spark):
    """Words that a sum of byte powers would take for one."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(i, f"{word} x" if i % 2 else f"{other} y") for i in range(12)] + [(20, f"{word} {other}")]
    got = lm.score(edge.documents(spark, rows), 3).collect()
    assert sorted(str((*r[:5], round(r.base_score, 6), round(r.score, 6))) for r in got) == plain_lm(rows, 3)


def test_op4_long_text_and_empty_table(spark):
    rows = [(i, t) for i, t in edge.texts() if i in (40, 41, 43, 46)]
    got = {r.doc_id: r for r in lm.score(edge.documents(spark, rows)).collect()}
    assert got[43].n_tokens == 400_001 and got[40].n_tokens == 1 and got[40].score == got[41].score
    assert lm.score(edge.empty(spark)).count() == 0


def test_op4_beats_the_base(spark, sf_small):
    got = lm.op4_backoff_automaton(spark, sf_small).toPandas()
    held = got[got.held_out]
    assert len(held) and held.score.sum() > held.base_score.sum() and (got.n_known <= got.n_tokens).all()


def test_op4_query_uses_trigrams(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    key = lambda r: (r.doc_id, r.score)
    got = sorted(lm.op4_backoff_automaton(spark, sf_small).collect(), key=key)
    want = sorted(lm.score(edge.documents(spark, rows, clash=False), 3).collect(), key=key)
    assert [r.score for r in got] == pytest.approx([r.score for r in want])


def test_op5_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = tox.op5_toxicity_cnn(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").toPandas()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit / (held.toxic == 1).sum() > 0.8 and hit / (held.predicted == 1).sum() > 0.9
    rank = held.score.rank()
    pos = held.toxic == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.95


def _toxic_set(n=300):
    r = random.Random(7)
    clean = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(clean) for _ in range(r.randint(3, 40))]
        y = i % 3 == 0
        if y:
            w[r.randrange(len(w))] = r.choice(["grobian", "grobians", "Grobianx!"])
        rows.append((i, " ".join(w)))
        labels.append((i, None if i % 50 == 1 else 1, int(y)))
    return rows, labels


def test_op5_odd_documents_and_inputs_it_may_not_see(spark):
    rows, labels = _toxic_set()
    schema = "doc_id long, quality int, toxic int"
    labels += [(None, 1, 1), (2, 1, None), (4, None, 0), (4, 1, 0)]
    train = edge.documents(spark, rows)
    model = tox.fit(train, spark.createDataFrame(labels, schema))
    odd = [(i if i is None else 1000 + i, t) for i, t in edge.texts()] + [(2000, "you grobianish fellow " * 3), (2001, "word1 word2 word3")]
    got = tox.score(edge.documents(spark, odd), model).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[2000].predicted == 1 and by[2001].predicted == 0 and by[1040].score == by[1041].score
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    # the held-out fold's labels, and columns other than the text, change nothing
    flipped = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = tox.fit(train.drop("lang", "source"), spark.createDataFrame(flipped, schema))
    assert np.array_equal(again.emb, model.emb) and np.array_equal(again.limits, model.limits)
    assert tox.score(edge.empty(spark), model).count() == 0
    kept = tox.remove_toxic(edge.documents(spark, odd), model)
    assert kept.columns == edge.documents(spark, odd).columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_op5_without_both_classes(spark):
    rows = [(i, "a b") for i in range(10)]
    for labels, share in (([], 0.0), ([(i, 1, 1) for i in range(10)], 1.0)):
        model = tox.fit(edge.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert {r.score for r in tox.score(edge.documents(spark, rows), model).collect()} == {share}


def test_op5_thresholds_at_the_shares_of_the_labels(spark, monkeypatch):
    """5 % toxic; more labelled documents than the sample takes. A seventh of the clean
    ones hold a weak mark, which only pays as a rule where half are toxic."""
    monkeypatch.setattr(tox, "TRAIN_DOCS", 60)
    r, rows, labels = random.Random(3), [], []
    for i in range(2400):
        y = i % 20 == 0
        w = [f"word{r.randrange(40)}" for _ in range(12)]
        w += ["mildly"] if y or r.random() < 0.15 else []
        w += ["grobian"] if y and r.random() < 0.5 else []
        rows.append((i, " ".join(w) + (" word1" * 2000 if i % 7 == 0 else "")))        # some over TRAIN_BYTES
        labels.append((i, 1, int(y)))
    docs = edge.documents(spark, rows, clash=False)
    model = tox.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {x.doc_id: x.predicted for x in tox.score(docs, model).collect()}
    assert sum(p for i, p in got.items() if i % 20) < 0.05 * 2280
    assert all(got[i] for i, t in rows if "grobian" in t)


def test_op5_counts_every_other_labelled_row(spark):
    rows = [(i, f"word{i % 9} " * (3 if i % 4 else 2500)) for i in range(200)]       # every fourth is over TRAIN_BYTES
    model = tox.Model(tox.hash_words(["word1"]), np.random.default_rng(0), np.ones(1))
    docs, trained = edge.documents(spark, rows), np.array([3, 1, 12])
    marks = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, y int")
    got = tox.logit_bins(docs, marks, model, trained, "doc_id", "text").toPandas()
    own = [i for i in range(150) if zlib.crc32(str(i).encode()) % 5 and i not in (3, 1, 12)]
    assert got.n.sum() == len(own) and got[~got.short].n.sum() == sum(i % 4 == 0 for i in own)


def test_op5_a_class_of_long_texts_only(spark):
    """Toxic documents are all over TRAIN_BYTES: they teach all the same."""
    r, rows, labels = random.Random(4), [], []
    for i in range(160):
        y = i % 4 == 0
        w = [f"word{r.randrange(60)}" for _ in range(1500 if y else 30)]
        rows.append((i, " ".join(w + ["grobian"] * (40 if y else 0))))
        labels.append((i, 1, int(y)))
    assert min(len(t) for i, t in rows if i % 4 == 0) > tox.TRAIN_BYTES
    rows += [rows[0]] * 50                                   # a row that repeats
    docs = edge.documents(spark, rows, clash=False)
    model = tox.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert getattr(model, "constant", None) is None
    got = {x.doc_id: x.predicted for x in tox.score(docs, model).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(160))


def plain_logit(model, vectors):
    """Loops over filters, places and words; zeros stand before and after the text."""
    gap, dim = max(tox.WIDTHS) - 1, model.emb.shape[1]
    rows = [[0.0] * dim] * gap + [list(map(float, v)) for v in vectors] + [[0.0] * dim] * gap
    z = float(model.out_bias)
    for k, width in enumerate(tox.WIDTHS):
        for f in range(tox.FILTERS):
            best = max(float(model.bias[k][f]) + sum(rows[p - j][d] * float(model.filters[k][j][d][f]) for j in range(width) for d in range(dim))
                       for p in range(gap, len(rows)))
            z += max(best, 0.0) * float(model.out[k * tox.FILTERS + f])
    return z


def test_op5_thresholds_against_plain_counts():
    """The best F1 over all cuts between bins, counted example by example."""
    r = np.random.default_rng(5)
    n = 300
    y, lang = (r.random(n) < 0.3).astype(int), r.integers(0, 2, n)
    bins = np.floor((r.normal(size=n) + 1.5 * y) / tox.BIN).astype(int)
    model = tox.Model(np.array([1], np.uint64), r, np.zeros(1))
    model.calibrate(bins, y, lang, np.ones(n))
    for k in (0, 1):
        w = [1.0 if x == k else 0.05 for x in lang]
        f1 = lambda cut: 2 * sum(a for a, b, c in zip(w, bins, y) if b >= cut and c) / max(
            sum(a for a, b in zip(w, bins) if b >= cut) + sum(a for a, c in zip(w, y) if c), 1e-12)
        cuts = sorted(set(bins.tolist()))
        mine = f1(next(c for c in cuts if c * tox.BIN + tox.BIN / 2 >= model.limits[k]))
        assert abs(mine - max(map(f1, cuts))) < 1e-9


def test_op5_against_plain_loops():
    """Embedding, filters, pooling, logistic layer and threshold of a few texts, in plain Python."""
    r = np.random.default_rng(8)
    words = ["alpha", "betas", "the", "gammas", "und"]
    vocab = np.unique(np.concatenate([tox.word_features(*lm.tb.spans(lm.pa.array([w])))[0].ravel() for w in words]))
    model = tox.Model(vocab[vocab != 0], r, r.normal(size=(vocab != 0).sum()))
    texts = ["alpha betas the gammas", "und", "", "betas unknownword betas the alpha alpha gammas und", "the"]
    data, offs = lm.tb.spans(lm.pa.array(texts))
    features, first = tox.word_features(data, offs)
    got = model.logits(tox.word_ids(model.vocab, model.bits, features), first)
    row = {int(v): i + 1 for i, v in enumerate(model.vocab)}
    want = []
    for a, b in zip(first[:-1], first[1:]):
        vectors = [sum((model.emb[row.get(int(h), 0)] for h in features[p]), np.zeros(model.emb.shape[1])) for p in range(a, b)]
        want.append(plain_logit(model, vectors))
    assert np.allclose(got, want, atol=1e-4)


def test_op5_gradients():
    """Training lowers the loss on a task that needs two words in order."""
    r = np.random.default_rng(3)
    vocab = np.sort(r.integers(1, 2 ** 63, 30, dtype=np.uint64))
    texts, y = [], []
    for k in range(400):
        t = r.integers(1, 31, (12, 4))
        t[:, 1:] = 0
        if k % 2:
            t[5:7, 0] = (3, 4)
        else:
            t[5:7, 0] = (4, 3)
        texts.append(t)
        y.append(float(any(a == 3 and b == 4 for a, b in zip(t[:-1, 0], t[1:, 0]))))
    model = tox.Model(vocab, r, np.zeros(30))
    for _ in range(3):
        model.train(texts, np.array(y, np.float32), r)
    z = model.logits(np.concatenate(texts), np.arange(401) * 12)
    assert ((z > 0) == (np.array(y) > 0)).mean() > 0.95


def plain_leaks(docs, items, window=10):
    out = []
    grams = [(i, tuple(w[p:p + min(len(w), window)])) for i, t in items for w in [edge.alnum(t)] if w for p in range(max(1, len(w) - window + 1))]
    for d, t in docs:
        w, hit, names, longest = edge.alnum(t), set(), set(), 0
        for i, g in grams:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit.update(range(p, p + len(g)))
                    names |= {str(i)} if i is not None else set()
        for i, t2 in items:                       # longest match that holds a window
            q = edge.alnum(t2)
            for a in range(len(q)):
                for p in range(len(w)):
                    n = 0
                    while a + n < len(q) and p + n < len(w) and q[a + n] == w[p + n]:
                        n += 1
                    if n >= min(window, len(q)):
                        longest = max(longest, n)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit), longest))
    return sorted(map(str, out))


def leaks(seed=0):
    r = random.Random(seed)
    word = lambda: r.choice("alpha beta Gamma 12 é über x the".split())
    items = [(k // 2 if k % 5 else None, " ".join(word() for _ in range(r.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(25)]
    items += [(77, None), (78, "..."), (79, items[3][1]), (10, "ten ten ten"), (9, "nine, nine! nine")]
    items = [x for x in items if len(edge.alnum(x[1])) != 1]
    docs = []
    for d in range(60):
        w = [r.choice("foo bar the x alpha".split()) for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 2)):
            q = (r.choice(items)[1] or "").split(" ")
            a = r.randrange(len(q))
            w[len(w) // 2:len(w) // 2] = q[a:a + r.randint(1, 30)]
        docs.append((d, (", " if d % 2 else "\n").join(w).upper() if d % 3 else " ".join(w)))
    return docs + [(60, None), (61, ""), (None, docs[4][1]), docs[5], docs[5]], items


@pytest.mark.parametrize("limit", [8 << 20, 200])
def test_op6_against_brute_force(spark, limit):
    docs, items = leaks()
    bench = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(items)], "item_id long, text string, doc_id long")
    parts = sd.blocks(bench, limit=limit)
    assert (len(parts) > 1) == (limit == 200)
    frame = edge.documents(spark, docs)
    got = sd.judge(frame, parts).collect()
    assert sorted(str(tuple(r)[:7]) for r in got) == plain_leaks(docs, items)
    for r in got:                                  # the place of the longest match is what it says
        if r.longest and r.doc_id is not None and r.longest_item is not None:
            w = edge.alnum(dict((i, t) for i, t in docs if i is not None)[r.doc_id])[r.longest_at:r.longest_at + r.longest]
            assert any(str(i) == r.longest_item and w == edge.alnum(t)[a:a + r.longest] for i, t in items for a in range(len(edge.alnum(t))))
    kept = sd.remove_contaminated(frame, parts)
    assert kept.columns == frame.columns and kept.count() == sum(not r.contaminated for r in got)


def test_op6_matches_its_sql_and_empty_tables(spark, sf_small):
    ok, msg = compare(sd.op6_suffix_decontamination(spark, sf_small), duck(sf_small), sd.OP6_SQL)
    assert ok, msg
    none = sd.blocks(spark.createDataFrame([], "item_id long, text string"))
    assert none == [] and not sd.judge(edge.documents(spark), none).filter("contaminated or n_items > 0 or longest > 0").count()
    bench = sd.blocks(spark.createDataFrame([(1, "lorem ipsum lorem")], "item_id long, text string"))
    got = {r.doc_id: r for r in sd.judge(edge.documents(spark), bench).collect()}
    assert got[43].n_hit == 399_999 and got[43].longest == 3 and got[43].longest_at == 0
    assert sd.judge(edge.empty(spark), bench).count() == 0


def test_op6_longest_match_of_every_occurrence():
    r = random.Random(12)
    import pyarrow as pa
    for trial in range(40):
        word = lambda: r.choice(["a", "b", "c", "dd"][:r.choice([2, 4])])  # noqa: E731,B023
        items = [(str(k), " ".join(word() for _ in range(r.choice([2, 3, 5, 9, 30])))) for k in range(r.randint(1, 12))]
        texts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(6)] + [items[0][1] + " zz " + items[-1][1]]
        block = sd.Block(items, 3)
        got = sd.search(block, *lm.tb.spans(pa.array(texts)))
        found = dict(zip(got["long_doc"].tolist(), zip(got["long_n"].tolist(), got["long_at"].tolist())))
        for d, t in enumerate(texts):
            w, best = t.split(), (0, 0)
            for _, i in items:
                q = i.split()
                for a in range(len(w)):
                    for b in range(len(q)):
                        n = 0
                        while a + n < len(w) and b + n < len(q) and w[a + n] == q[b + n]:
                            n += 1
                        if n >= min(3, len(q)) and (-n, a) < (-best[0], best[1]):
                            best = (n, a)
            assert found.get(d, (0, 0)) == best, (trial, d)


def test_op6_a_passage_common_to_many_items_is_linear():
    """Work, counted in numpy elements that are compared, doubles with the occurrences."""
    import pyarrow as pa
    passage = " ".join(f"p{i}" for i in range(12))
    work = []
    for n in (200, 400, 800):
        block = sd.Block([(str(k), f"q{k} x{k} {passage} y{k}") for k in range(n)], 10)
        counted = [0]

        def common(b, text, p, q, counted=counted, real=sd._common):
            counted[0] += len(p)
            return real(b, text, p, q)
        old, sd._common = sd._common, common
        try:
            got = sd.search(block, *lm.tb.spans(pa.array([f"{passage} z{k}" for k in range(n)])))
        finally:
            sd._common = old
        assert len(got["sets"]) == 1 and len(got["sets"][0]) == n and len(got["set_doc"]) == n and (got["long_n"] == 12).all()
        work.append(counted[0])
    assert work[1] < 2.5 * work[0] and work[2] < 2.5 * work[1]


def test_op6_words_with_structured_bytes(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    docs, items = [(1, f"x {word} y"), (2, f"x {other} y")], [(7, f"{word} y")]
    got = sd.judge(edge.documents(spark, docs), sd.blocks(spark.createDataFrame(items, "item_id long, text string"))).collect()
    assert sorted(str(tuple(r)[:7]) for r in got) == plain_leaks(docs, items)


def test_suffix_array_is_sorted():
    r = np.random.default_rng(0)
    for n, high in ((1, 2), (50, 2), (400, 3), (300, 1000)):
        s = r.integers(-1, high, n)
        sa = sd.suffix_array(s, 16)
        heads = [s[a:a + 16].tolist() for a in sa]
        assert sorted(sa.tolist()) == list(range(n)) and heads == sorted(heads)


def test_pipeline_stages(spark, sf_small):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near dedup", "benchmark decontamination", "BPE"]
    rows, labels = _toxic_set(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    items = [(i, t) for i, t in leaks()[1] if len(edge.alnum(t)) >= 9]
    leak = next(t for _, t in items if len(edge.alnum(t)) > 11)
    rows += [(500, "filler " * 30 + leak), (501, rows[1][1]), (502, None), (503, None), (None, rows[1][1]), (504, "twice told tale of an id"), (504, "twice told tale of an id")]
    from ledgerlens.llm.common import scratch
    folder = scratch(spark, "tables")
    docs = edge.documents(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    marks.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = tox.fit(docs, marks)
    a = corpus_pipeline.toxicity(spark, docs, folder)
    left = {r.doc_id for r in tox.score(docs, model).filter("predicted = 0").collect()}
    assert a.columns == docs.columns and {r.doc_id for r in a.collect()} == left and left >= {500, 502, None}
    b = corpus_pipeline.near_dedup(spark, a, folder)
    mine = [(r.doc_id, r.text) for r in a.collect()]
    kept = {i for i, _, _, k in brute([x for x in dict(mine).items() if x[0] is not None], 5) if k}
    got = [r.doc_id for r in b.collect()]
    assert b.columns == docs.columns and sorted(i for i in got if i is not None) == sorted(kept) and got.count(None) == 0   # a copy of document 1
    c = corpus_pipeline.decontaminate(spark, b, folder)
    dirty = {r.doc_id for r in sd.judge(b, sd.blocks(spark.read.parquet(f"{folder}/benchmark.parquet"))).filter("contaminated").collect()}
    assert c.columns == docs.columns and 500 in dirty and {r.doc_id for r in c.collect()} == set(got) - dirty
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in c.collect()) and out[0].n_tokens is not None


def test_near_dedup_takes_rows_for_documents(spark):
    """Different texts under one doc_id, copies among them, rows without doc_id: one row of
    each group of copies stays, whatever their ids."""
    r = random.Random(6)
    texts = [" ".join(r.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(r.randrange(9)) for _ in range(30)) for _ in range(12)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[0]), (6, texts[1]), (7, texts[2]), (None, texts[2]), (None, texts[3]), (None, texts[3]),
            (8, texts[4]), (8, texts[5]), (9, None), (9, None), (None, ""), (3, texts[4].upper())]
    docs = edge.documents(spark, rows)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    words = lambda t: tuple(edge.words(t))
    left = [words(x.text) for x in got]
    for t in texts[:6]:
        assert left.count(words(t)) == 1
    assert left.count(()) == 3 and len(got) == 9
    ids = {words(x.text): x.doc_id for x in got}
    assert ids[words(texts[0])] == ids[words(texts[1])] == 5 and ids[words(texts[2])] == 7 and ids[words(texts[4])] == 3 and ids[words(texts[5])] == 8
    plain = [(i, t) for i, t in enumerate(texts)]           # ids that do not repeat take the short way
    assert corpus_pipeline.near_dedup(spark, edge.documents(spark, plain), "").count() == len(texts)


def test_pipeline_over_an_empty_table(spark):
    from ledgerlens.llm.common import scratch
    folder = scratch(spark, "tables")
    edge.empty(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert hm.REGISTERS == hm.BANDS * hm.ROWS
