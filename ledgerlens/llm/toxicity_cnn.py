"""Toxicity: a convolutional text classifier, trained and run in numpy.

Words (letters, digits and non-ASCII characters, A-Z lower-cased) are hashed
to 64 bits, and so are their first 4, 5 and 6 bytes, which inflected forms share. A
word's embedding is the sum of these hashes' rows. A hash has a row if it stands in
two training texts at least; all others share a row of zeros, so rare words
cannot collide with a learnt one. Filters of widths WIDTHS run over the whole text, each is max-
pooled, a logistic layer weighs them.

Only documents whose crc32(doc_id as text) mod 5 is not 0 teach. The weights come
from a sample: at most TRAIN_DOCS labelled documents of either class of at most
TRAIN_BYTES bytes each, lowest hashes of doc_id first, without a quarter of them; where a class has fewer
than LEAST_SHORT such documents, its next longer ones too, up to TRAIN_DOCS * TRAIN_BYTES bytes in all.
All other labelled documents, whole texts of any length, are scored where they are
read and calibrate by counts of logit bins; short ones are weighted by class for
those that the weights were learnt from, so that the classes keep the shares they
have in the labels. The threshold
is calibrated by language: a text's language is the one most of whose function words
it holds (the ``lang`` column is never read); the score is the logistic of the
logit's distance from that language's threshold, so 0.5 is the threshold everywhere.

Scoring has no shuffle: the model (its size is bounded by the sample) is
broadcast, each text is scored where it is read. Null and empty texts score as
no words. Rows with null doc_id are not held out; those and null labels teach nothing; a document with several
labels counts as toxic if one says so; without examples of both classes every score
is the share of toxic ones. Repeated rows are scored each; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import read_table

TRAIN_DOCS = 2000
TRAIN_BYTES = 8 << 10
LEAST_SHORT = 50
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)
DIM = 16
FILTERS = 12
EPOCHS = 8
BATCH = 64
FOLDS = 5
#: Calibration: bins of this width, up to LIMIT.
BIN, LIMIT = 0.02, 50.0
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as his they be at this have from or had by not but what all were we when".split(),
    "fr": "le la les de des et un une du que qui dans en est pour pas sur au par ce il ne se plus avec son sont ou mais nous vous".split(),
    "de": "der die das und ist nicht ein eine mit den von zu dem des sich auf für im auch es an werden aus er hat dass sie nach bei".split(),
    "es": "el los las de y que en un una por con no para es se del al lo como más su pero sus le ha me si sin sobre este ya".split(),
}
LANGS = [*FUNCTION_WORDS, "other"]


def word_ids(vocab: np.ndarray, bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Row of each hash in ``vocab`` plus 1; 0 if it has none."""
    out = np.zeros(words.size, np.int64)
    flat = words.reshape(-1)
    maybe = np.flatnonzero(bits[(flat >> np.uint64(44)).astype(np.int64)])
    if len(maybe) and len(vocab):
        at = np.minimum(np.searchsorted(vocab, flat[maybe]), len(vocab) - 1)
        same = vocab[at] == flat[maybe]
        out[maybe[same]] = at[same] + 1
    return out.reshape(words.shape)


def bit_filter(vocab: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[(vocab >> np.uint64(44)).astype(np.int64)] = True
    return bits


def word_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each word and of its prefixes; 0 for a prefix it is too
    short for, words before each text)."""
    starts, ends, first = tb.word_spans(data, offs, tb.ALNUM)
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = tb.segment_hashes(data, starts, ends, tb.LOWER)
    for k, n in enumerate(PREFIXES, 1):
        own = np.flatnonzero(ends - starts > n)
        out[own, k] = tb.mix(tb.segment_hashes(data, starts[own], starts[own] + n, tb.LOWER) + np.uint64(k))
    return out, first


def hash_words(words: list[str]) -> np.ndarray:
    data, offs = tb.spans(pa.array(words, pa.string()))
    return tb.word_hashes(data, offs, tb.ALNUM)[0]


def languages(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index in LANGS of each text: most hits, the first of equals; without hits "other"."""
    hits = np.zeros((len(LANGS), len(first) - 1), np.int64)
    for k, own in enumerate(FUNCTION_WORDS.values()):
        marks = np.sort(hash_words(own))
        at = np.minimum(np.searchsorted(marks, words), len(marks) - 1)
        hits[k] = np.diff(np.concatenate(([0], np.cumsum(marks[at] == words)))[first])
    return np.where(hits.max(axis=0) > 0, hits.argmax(axis=0), len(LANGS) - 1)


def _laid_out(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word rows with a gap of zeros before, between and after the texts, and the places of their
    first words: no filter that ends in a text, or in the gap behind it, reaches another text."""
    gap = max(WIDTHS) - 1
    n = np.diff(first)
    out = np.zeros((len(ids) + gap * (len(n) + 2), ids.shape[1]), np.int64)
    before = gap * (np.arange(len(n)) + 2)
    out[np.arange(len(ids)) + np.repeat(before, n)] = ids
    return out, first[:-1] + before


class Model:
    """Embeddings, filters, weights and thresholds; picklable."""

    def __init__(self, vocab: np.ndarray, rng: np.random.Generator, lean: np.ndarray):
        self.vocab, self.bits = vocab, bit_filter(vocab)
        self.emb = np.zeros((len(vocab) + 1, DIM), np.float32)
        self.emb[1:] = rng.standard_normal((len(vocab), DIM)) * 0.02
        self.emb[1:, 0] = lean  # how far the hash leans to a class: a start that finds rare signals
        self.filters = [rng.standard_normal((w, DIM, FILTERS)).astype(np.float32) * 0.15 for w in WIDTHS]
        for f in self.filters:
            f[:, 0, :FILTERS // 2] += 0.3
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = np.full(len(WIDTHS) * FILTERS, 0.05, np.float32)
        self.out_bias = np.float32(-1.0)
        self.limits = np.zeros(len(LANGS))
        self.constant: float | None = None

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.emb[rows[..., 0]]
        for k in range(1, rows.shape[-1]):
            x = x + self.emb[rows[..., k]]
        return x

    def convolve(self, x: np.ndarray, k: int) -> np.ndarray:
        """Outputs of the filters of width WIDTHS[k] over the embedded rows."""
        gap = max(WIDTHS) - 1
        out = np.repeat(self.bias[k][None], len(x) - gap, axis=0)
        for j, w in enumerate(self.filters[k]):
            out += x[gap - j:len(x) - j] @ w
        return out

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        rows, start = _laid_out(ids, first)
        gap = max(WIDTHS) - 1
        x = self.embed(rows)
        pooled = [np.maximum.reduceat(self.convolve(x, k), start - gap, axis=0) for k in range(len(WIDTHS))]
        return (np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.out_bias).astype(np.float64)

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Score of each text of a slice."""
        if self.constant is not None:
            return np.full(len(offs) - 1, self.constant)
        words, first = word_features(data, offs)
        z = self.logits(word_ids(self.vocab, self.bits, words), first) - self.limits[languages(words[:, 0], first)]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def train(self, texts: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam on the log-loss, embeddings by Adagrad."""
        gap = max(WIDTHS) - 1
        dense = [*self.filters, self.bias, self.out]
        m, v, step = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense], 0
        seen = np.full((len(self.emb), 1), 1e-3, np.float32)
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                own = order[at:at + BATCH]
                first = np.concatenate(([0], np.cumsum([len(texts[i]) for i in own])))
                rows, start = _laid_out(np.concatenate([texts[i] for i in own]), first)
                start = start - gap
                end = np.append(start[1:], len(rows) - gap)
                pooled, arg, x = [], [], self.embed(rows)
                for k in range(len(WIDTHS)):
                    c = self.convolve(x, k)
                    arg.append(np.array([a + c[a:b].argmax(axis=0) for a, b in zip(start, end)]))
                    pooled.append(np.take_along_axis(c, arg[-1], 0))
                h = np.maximum(np.concatenate(pooled, axis=1), 0)
                p = 1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias, -30, 30)))
                dz = ((p - y[own]) * weight[own] / len(own)).astype(np.float32)
                grads = [np.zeros_like(p) for p in dense]
                grads[-1] = h.T @ dz + 1e-4 * self.out
                dh = np.outer(dz, self.out) * (h > 0)
                touched, change = [], []
                for k in range(len(WIDTHS)):
                    d = dh[:, k * FILTERS:(k + 1) * FILTERS]
                    grads[-2][k] = d.sum(axis=0)
                    for j in range(WIDTHS[k]):
                        r = rows[arg[k] + gap - j]
                        grads[k][j] = np.einsum("nfd,nf->df", self.embed(r), d)
                        back = (d[:, :, None] * self.filters[k][j].T[None]).reshape(-1, DIM)
                        for q in range(r.shape[-1]):
                            touched.append(r[..., q].ravel())
                            change.append(back)
                touched, change = np.concatenate(touched), np.concatenate(change)
                hit, inverse = np.unique(touched, return_inverse=True)
                g = np.zeros((len(hit), DIM), np.float32)
                np.add.at(g, inverse, change)
                hit, g = hit[hit > 0], g[hit > 0]
                seen[hit, 0] += (g ** 2).mean(axis=1)
                self.emb[hit] -= 0.01 * g / np.sqrt(seen[hit])
                self.out_bias -= np.float32(0.05 * dz.sum())
                step += 1
                for q, gq, mq, vq in zip(dense, grads, m, v):
                    mq += 0.1 * (gq - mq)
                    vq += 0.01 * (gq * gq - vq)
                    q -= 0.01 * (mq / (1 - 0.9 ** step)) / (np.sqrt(vq / (1 - 0.99 ** step)) + 1e-7)

    def calibrate(self, bins: np.ndarray, y: np.ndarray, lang: np.ndarray, n: np.ndarray) -> None:
        """Threshold of each language: the middle of the best stretch of logit
        bins by F1 over that language's examples and, with the weight of few, over
        all; 0 without examples of both classes. ``n``: examples (weighted) of each
        (bin, class, language)."""
        if not n[y == 1].sum() or not n[y == 0].sum():
            return
        names, at = np.unique(bins, return_inverse=True)
        for k in range(len(LANGS)):
            w = n * np.where(lang == k, 1.0, 0.05)
            pos, neg = (np.bincount(at, w * (y == c), len(names)) for c in (1, 0))
            tp, fp = np.cumsum(pos[::-1])[::-1], np.cumsum(neg[::-1])[::-1]
            i = int((2 * tp / np.maximum(tp + fp + pos.sum(), 1e-12)).argmax())
            self.limits[k] = (names[i] + names[i - 1] + 1) / 2 * BIN if i else names[0] * BIN - 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Train and calibrate on labelled rows of the learning folds; only the sample's
    word hashes (2 * TRAIN_DOCS * TRAIN_BYTES bytes of text at most) and counts of
    logit bins reach the driver."""
    key = F.col(id_col).cast("string")
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (F.crc32(key.cast("binary")) % FOLDS != 0))
                   .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y")))
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).alias("size"))
    fit_rows = sizes.join(marks, "doc_id").groupBy("doc_id", "y").agg(F.min("size").alias("size"))
    chosen, longest = {}, TRAIN_BYTES
    for y in (0, 1):
        of_class = fit_rows.filter(F.col("y") == y)
        short = of_class.filter(F.col("size") <= TRAIN_BYTES).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).collect()
        chosen |= {r.doc_id: y for r in short}
        if len(short) < LEAST_SHORT:           # a class must not vanish because its texts are long
            left = TRAIN_DOCS * TRAIN_BYTES
            for r in of_class.filter(F.col("size") > TRAIN_BYTES).orderBy("size", F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).collect():
                if (left := left - r.size) < 0:
                    break
                chosen[r.doc_id], longest = y, max(longest, r.size)
            if y not in chosen.values() and not of_class.isEmpty():
                raise ValueError(f"every labelled text of class {y} is longer than {TRAIN_DOCS * TRAIN_BYTES} bytes")
    rng = np.random.default_rng(11)
    if len(set(chosen.values())) < 2:
        model = Model(np.zeros(0, np.uint64), rng, np.zeros(0))
        share = marks.agg(F.avg("y")).first()[0]
        model.constant = float(share or 0.0)
        return model

    def hashes(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                words, first = word_features(data, offs)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), "words": pa.array(
                    [words[x:y].tobytes() for x, y in zip(first[:-1].tolist(), first[1:].tolist())], pa.binary())})

    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .filter(F.col("doc_id").isin(list(chosen))).filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
                .mapInArrow(hashes, "doc_id long, words binary").groupBy("doc_id").agg(F.min("words").alias("words"))  # rows that repeat an id stay on Spark
                .toPandas().sort_values("doc_id"))
    texts = [np.frombuffer(w, np.uint64).reshape(-1, 1 + len(PREFIXES)) for w in rows.words]
    y = np.array([chosen[i] for i in rows.doc_id], np.float32)
    part = rng.permutation(len(texts)) % 4 == 0  # calibrates, with all documents outside of the sample
    learn = np.flatnonzero(~part)
    every, of = np.concatenate([np.unique(texts[i]) for i in learn]), np.repeat(y[learn], [len(np.unique(texts[i])) for i in learn])
    vocab, inverse, df = np.unique(every, return_inverse=True, return_counts=True)
    pos = np.bincount(inverse, of, len(vocab))
    rate = y[learn].mean()
    lean = np.clip((pos - df * rate) / np.sqrt(df * rate * (1 - rate) + 1) / 3, -1.5, 3)
    use = (df >= 2) & (vocab != 0)
    model = Model(vocab[use], rng, lean[use])
    ids = [word_ids(model.vocab, model.bits, t) for t in texts]
    model.train([ids[i] for i in learn], y[learn], rng)
    trained = rows.doc_id.to_numpy()[learn]
    taught = np.bincount(y[learn].astype(int), minlength=2)
    del rows, texts, ids, every, of, vocab, inverse
    counts = logit_bins(docs, marks, model, trained, id_col, text_col).toPandas()
    cls, n = counts.y.to_numpy(), counts.n.to_numpy(np.float64)
    for c in (0, 1):  # short texts stand for those that the weights were learnt from as well
        own = counts["short"].to_numpy(bool) & (cls == c)
        if own.any():
            n[own] *= 1 + taught[c] / n[own].sum()
    model.calibrate(counts.bin.to_numpy(), cls, counts.lang.to_numpy(), n)
    return model


def logit_bins(docs: DataFrame, marks: DataFrame, model: Model, trained: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """lang, bin, y, short, n: rows of the learning folds with a label (``marks``:
    doc_id, y) whose doc_id is not in ``trained``. Texts are scored before they meet
    their labels, so no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((model, np.sort(trained)))

    def run(batches):
        model, trained = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(trained[np.minimum(np.searchsorted(trained, ids), len(trained) - 1)] != ids))
            for a, b, data, offs in tb.slices(batch, "text"):
                words, first = word_features(data, offs)
                z = np.clip(model.logits(word_ids(model.vocab, model.bits, words), first), -LIMIT, LIMIT)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, b - a), "lang": pa.array(languages(words[:, 0], first), pa.int32()),
                    "bin": pa.array(np.floor(z / BIN), pa.int64()), "short": pa.array(np.diff(offs) <= TRAIN_BYTES)})

    key = F.col(id_col).cast("string").cast("binary")
    binned = (docs.filter(F.crc32(key) % FOLDS != 0)
                  .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .filter("doc_id is not null").mapInArrow(run, "doc_id long, lang int, bin long, short boolean"))
    return binned.join(marks, "doc_id").groupBy("lang", "bin", "y", "short").agg(F.count("*").alias("n"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, "text"):
                s = shared.value.scores(data, offs)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), "held_out": batch.column("held_out").slice(a, b - a),
                                                  "score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))})

    key = F.col(id_col).cast("string").cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.crc32(key) % FOLDS == 0, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a, b, data, offs in tb.slices(batch, text_col):
                yield batch.slice(a, b - a).filter(pa.array(shared.value.scores(data, offs) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, trained on ``labels``."""
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
