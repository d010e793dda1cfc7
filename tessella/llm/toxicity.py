"""Operator 3: toxicity by a convolutional text classifier trained in numpy.

A word, its first characters (``PREFIXES``) and its length with the longest of these prefixes are hashed to
buckets with an embedding each, and a word's vector is their sum, so that unseen inflections of a seen stem
are not unknown. The first dimension starts as the bucket's log odds of label 1 among the training texts, so
that little data goes far. Filters of widths 1 to 3 slide over the words, the
largest value of each filter in the whole text is kept, and a logistic layer turns them into a score. The
score is calibrated on labelled rows that training did not see, so that 0.3 is the dividing line; a
threshold for each language is fitted on the same rows and serves ``flagged`` only, never the score.

Training uses a bounded sample on the driver: ``PER_LABEL`` labelled ids of each label, chosen by hash from the
labels alone, and then their texts, whatever their length; no text is shuffled. Buckets in fewer than ``MIN_DOCS``
of its texts share the zero embedding, so what is sent to the executors is bounded by the sample. Scoring is one
map over whole texts without a shuffle.

Defined cases: null and empty texts have no words, so every filter is 0 and they get the score of that;
null labels, labels other than 0 and 1, and labels of null ids are not learned; an id that is labelled twice, or
stands in several rows, is learned with each label and each text; equal hashes are ordered by id; without both
labels every score is the share of label 1 (0 without labels); repeated rows give repeated rows; other columns
pass untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, lean, table
from .sampling import bounded_sample

BUCKETS = 1 << 22
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
#: Lengths of the prefixes; the last goes with the word's length (up to LONGEST) as well.
PREFIXES, LONGEST = (4, 6), 12
PARTS = 2 + len(PREFIXES)
PER_LABEL, MIN_DOCS = 1500, 3
EPOCHS, STEPS, BATCH, RATE, SEED = 8, 400, 32, 0.01, 5
LIMIT = 0.3
STEP_WORDS = 60_000
CACHE = 200_000
#: ASCII letters and digits stay, other ASCII bytes part words; bytes of longer characters stay.
_PARTS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


class Buckets(dict):
    """Word -> rows of the embedding table for the word and its parts, as bytes, remembering recent words."""

    def __init__(self, row_of_bucket: np.ndarray | None):
        super().__init__()
        self.row_of_bucket = row_of_bucket

    def _row(self, key: bytes) -> int:
        b = zlib.crc32(key) % BUCKETS
        return b if self.row_of_bucket is None else int(self.row_of_bucket[b])

    def __missing__(self, word: bytes) -> bytes:
        start = word[: 4 * LONGEST].decode("utf-8", "ignore")
        heads = [start[:n].encode("utf-8") for n in PREFIXES]
        keys = (word, *(b"^" + h for h in heads), b"%d^" % min(len(start), LONGEST) + heads[-1])
        rows = np.array([self._row(k) for k in keys], "<i4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        if len(word) < 64:
            self[word] = rows
        return rows

    def rows(self, text: str | None) -> np.ndarray:
        """An array with a line of PARTS rows for each word."""
        words = text.lower().encode("utf-8", "surrogatepass").translate(_PARTS).split() if text else []
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<i4").reshape(-1, PARTS)


class TextCNN:
    """Embedding rows, filters and the logistic layer; row 0 stays zero."""

    def __init__(self, buckets: np.ndarray, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.buckets = buckets
        self.e = np.vstack([np.zeros((1, DIM)), r.normal(0, 0.1, (len(buckets), DIM))]).astype(np.float32)
        self.w = [r.normal(0, 0.4, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.v = r.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.c = np.float32(0)
        self.scale, self.shift = 1.0, 0.0
        self.thresholds: dict[str, float] = {}

    def lookup(self) -> Buckets:
        row = np.zeros(BUCKETS, np.int32)
        row[self.buckets] = np.arange(1, len(self.buckets) + 1)
        return Buckets(row)

    def pooled(self, rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Largest value of each filter (0 at least) in each text; texts lie one after the other in rows."""
        out = np.zeros((len(sizes), FILTERS * len(WIDTHS)), np.float32)
        if not len(rows):
            return out
        tables = [self.e @ w for k in self.w for w in k]  # rows are few: filters are applied to the table, not to the words
        parts = iter(tables)
        for i, width in enumerate(WIDTHS):
            own = [next(parts) for _ in range(width)]
            m = len(rows) - width + 1
            if m < 1:
                continue
            conv = own[0][rows[:m, 0]]
            for j in range(width):
                for part in range(PARTS):
                    if j or part:
                        conv += own[j][rows[j : m + j, part]]
            conv += self.b[i]
            has = np.flatnonzero(sizes >= width)
            if not len(has):
                continue
            # reduceat over [start, last window] pairs; the windows that cross into the next text fall between
            bounds = np.empty(2 * len(has), np.int64)
            bounds[0::2], bounds[1::2] = starts[has], np.minimum(starts[has] + sizes[has] - width + 1, m)
            if bounds[-1] == m:
                bounds = bounds[:-1]
            top = np.maximum.reduceat(conv, bounds, axis=0)[0::2]
            out[has, i * FILTERS : (i + 1) * FILTERS] = np.maximum(top, 0)
        return out

    def margin(self, texts: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], np.int64)
        return self.pooled(np.concatenate(texts) if len(texts) else np.zeros((0, PARTS), np.int32), np.cumsum(sizes) - sizes, sizes) @ self.v + self.c

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(texts).astype(np.float64) + self.shift, -30, 30)))

    def start(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """The first dimension: shrunk log odds of each bucket; the first filter of width 1 looks at it."""
        n = np.zeros((2, len(self.e)))
        for t, label in zip(texts, y, strict=True):
            n[int(label), np.unique(t)] += 1
        share = n / np.array([[len(y) - y.sum()], [y.sum()]]).clip(1) + 8 / len(y)
        odds = np.log(share[1] / share[0])
        self.e[:, 0] = np.clip(odds, -2, 4) / 4
        self.e[0] = 0
        self.w[0][0, 0, :] = np.abs(self.w[0][0, 0, :])
        self.v[:FILTERS] = np.abs(self.v[:FILTERS])

    def train(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        params = [self.e, *self.w, *self.b, self.v]
        m1, m2, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        for _ in range(max(epochs, -(-STEPS * BATCH // max(1, len(texts))))):  # a small sample is gone through more often
            order = r.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                grads = [np.zeros_like(p) for p in params]
                g_c = 0.0
                for i in order[k : k + BATCH]:
                    ids = texts[i]
                    at, top = [], np.zeros(FILTERS * len(WIDTHS), np.float32)
                    x = self.e[ids].sum(1)
                    for a, width in enumerate(WIDTHS):
                        m = len(ids) - width + 1
                        if m < 1:
                            at.append(None)
                            continue
                        conv = sum(x[j : m + j] @ self.w[a][j] for j in range(width)) + self.b[a]
                        best = conv.argmax(0)
                        at.append(best)
                        top[a * FILTERS : (a + 1) * FILTERS] = np.maximum(conv[best, np.arange(FILTERS)], 0)
                    d = np.float32((1 / (1 + np.exp(-np.clip(top @ self.v + self.c, -30, 30))) - y[i]) * weight[i] / BATCH)
                    grads[-1] += d * top
                    g_c += d
                    for a, width in enumerate(WIDTHS):
                        if at[a] is None:
                            continue
                        for f in np.flatnonzero(top[a * FILTERS : (a + 1) * FILTERS] > 0):
                            g = d * self.v[a * FILTERS + f]
                            window = ids[at[a][f] : at[a][f] + width]
                            grads[1 + len(WIDTHS) + a][f] += g
                            grads[1 + a][:, :, f] += g * self.e[window].sum(1)
                            for part in range(PARTS):
                                np.add.at(grads[0], window[:, part], g * self.w[a][:, :, f])
                t += 1
                for p, g, a1, a2 in zip(params, grads, m1, m2, strict=True):
                    a1 *= 0.9
                    a1 += 0.1 * g
                    a2 *= 0.999
                    a2 += 0.001 * g * g
                    p -= RATE * (a1 / (1 - 0.9**t)) / (np.sqrt(a2 / (1 - 0.999**t)) + 1e-7)
                self.e[0] = 0
                self.c -= np.float32(RATE * 10 * g_c)

    def calibrate(self, texts: list[np.ndarray], y: np.ndarray, langs: list[str | None]) -> None:
        """Moves the score so that the margin which parts the unseen labelled rows best becomes LIMIT."""
        z = self.margin(texts).astype(np.float64)

        def best_cut(z: np.ndarray, y: np.ndarray) -> float:
            order = np.argsort(-z, kind="stable")
            hits, n = np.cumsum(y[order]), np.arange(1, len(y) + 1)
            f1 = 2 * hits / (n + max(1, y.sum()))
            at = int(np.argmax(f1))
            below = z[order][at + 1] if at + 1 < len(z) else z[order][at] - 2
            return float((z[order][at] + below) / 2)

        cut = best_cut(z, y)
        spread = max(0.5, float(np.median(np.abs(z - cut))))
        self.scale = 3.0 / spread
        self.shift = float(np.log(LIMIT / (1 - LIMIT)) - self.scale * cut)
        for lang in sorted({x for x in langs if x is not None}):
            own = np.array([x == lang for x in langs])
            if y[own].sum() >= 8:  # fewer tell nothing: such a language keeps LIMIT
                self.thresholds[lang] = float(1 / (1 + np.exp(-np.clip(self.scale * best_cut(z[own], y[own]) + self.shift, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame, text_col="text", label_col="toxic", lang_col="lang", id_col="doc_id", per_label: int = PER_LABEL) -> TextCNN:
    """A classifier fitted on the texts of a bounded sample of labels (id_col, label_col)."""
    slim = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    known: dict = {}
    for r in bounded_sample(slim, "_y", per_label, ("_id",)):
        known.setdefault(r["_id"], []).append(r["_y"])
    if not known:
        return fit_rows([], np.zeros(0), [])
    # 2 * per_label ids at most: a set in the scan's filter
    texts = docs.where(F.col(id_col).isin(list(known)) & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    found = texts.orderBy(F.xxhash64("_id", "_text"), "_id", "_text").limit(6 * per_label).collect()
    rows = [(r, y) for r in sorted(found, key=lambda r: (r["_id"], r["_text"])) for y in known[r["_id"]]]
    return fit_rows([r["_text"] for r, _ in rows], np.array([y for _, y in rows], float), [r["_lang"] for r, _ in rows])


def fit_rows(texts: list[str], labels: np.ndarray, langs: list[str | None]) -> TextCNN:
    """The classifier of labelled texts."""
    raw = Buckets(None)
    ids = [raw.rows(t) for t in texts]
    in_docs: dict[int, int] = {}
    for x in ids:
        for b in np.unique(x).tolist():
            in_docs[b] = in_docs.get(b, 0) + 1
    model = TextCNN(np.array(sorted(b for b, n in in_docs.items() if n >= MIN_DOCS), np.int64))
    if not len(labels) or labels.min() == labels.max():
        model.v[:] = 0
        model.shift = 30.0 if len(labels) and labels[0] == 1 else -30.0
        model.scale = 0.0
        return model
    known = model.lookup()
    rows = [known.row_of_bucket[x] for x in ids]
    unseen = np.arange(len(rows)) % 5 == 4
    if not 0 < labels[unseen].sum() < unseen.sum():
        unseen[:] = True
        trained = np.ones(len(rows), bool)
    else:
        trained = ~unseen
    pick = lambda m: [t for t, k in zip(rows, m, strict=True) if k]
    model.start(pick(trained), labels[trained])
    model.train(pick(trained), labels[trained])
    model.calibrate(pick(unseen), labels[unseen], [x for x, k in zip(langs, unseen, strict=True) if k])
    return model


def classify(docs: DataFrame, model: TextCNN, text_col: str = "text") -> DataFrame:
    """docs' columns with score (a column of that name is replaced)."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = m.lookup()
        for batch in batches:
            out, step, size = [], [], 0
            for text in batch.column(text_col).to_pylist():
                step.append(words.rows(text))
                size += len(step[-1])
                if size >= STEP_WORDS:
                    out.append(m.score(step))
                    step, size = [], 0
            out.append(m.score(step))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def flag(scored: DataFrame, model: TextCNN, lang_col: str, limit: float = LIMIT) -> DataFrame:
    """scored with lang_threshold and flagged, by the language's own threshold."""
    pairs = [F.lit(v) for x in model.thresholds.items() for v in x]
    own: Column = F.element_at(F.create_map(*pairs), F.col(lang_col)) if pairs else F.lit(None).cast("double")
    return scored.withColumn("lang_threshold", F.coalesce(own, F.lit(limit))).withColumn("flagged", (F.col("score") >= F.col("lang_threshold")).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = learn(docs.where(~held_out), labels.where(~held_out))
    scored = flag(classify(docs.select("doc_id", "text", "lang"), model), model, "lang")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"), "lang_threshold", "flagged")
