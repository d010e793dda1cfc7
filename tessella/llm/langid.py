"""Operator 10: language identification by bit-sliced Bloom filters of character n-grams.

One array of bit masks holds a Bloom filter for every language: bit l of slot s says that slot s is set in
the filter of language l. The masks of an n-gram's hashed slots, ANDed, name all languages whose filter
holds it. A text adds up, for each language, the n-grams that name it (those that name every language tell
nothing and are left out), takes off the false positives that the filter's fill predicts, and the language
with most remaining decides.

Fitting reads a bounded sample (``DOCS_PER_LANGUAGE`` whole texts of a language, chosen by hash). Predicting is one
map over whole texts without a shuffle; what is sent to the executors is ``SLOTS`` masks, whatever the input's size.

Defined cases: null or letterless texts are ``und`` with score 0; a text with letters but no known n-gram
gets the language with most texts in the sample (of equal ones the first by name) with an even score, and languages
that are named equally often are told apart in that order; without any labelled row every text is ``und``; null
languages are not learned; repeated rows give repeated rows; other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, lean, table
from .sampling import bounded_sample

N = 4
SLOTS = 1 << 19
HASHES = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
DOCS_PER_LANGUAGE = 400
MIN_SHARE = 2e-6
#: Texts handled at once, in characters.
STEP_CHARS = 2_000_000
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Of every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, the text it is in, whether each text has a letter)."""
    low = [t.lower() for t in texts]
    size = np.array([len(t) for t in low], np.int64)
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[code]
    owner = np.repeat(np.arange(len(low), dtype=np.int32), size)
    has = np.zeros(len(low), bool)
    has[owner[is_letter]] = True
    if len(code) < N:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32), has
    c = np.where(is_letter, code, np.uint32(32))
    m = len(c) - N + 1
    ok = is_letter[1 : m + 1] & is_letter[2 : m + 2] & (owner[:m] == owner[N - 1 :])
    h = c[:m].copy()
    for k in range(1, N):
        h *= np.uint32(0x01000193)
        h ^= c[k : m + k]
    h = h[ok]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h, owner[:m][ok], has


def slots(h: np.ndarray, k: int) -> np.ndarray:
    return (h * np.uint32(HASHES[k])) >> np.uint32(32 - SLOTS.bit_length() + 1)


class LanguageFilters:
    """Bloom filters of all languages, sliced by bit; languages are in order of their sample size, then name."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        bits = [(masks[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1) for i in range(len(languages))]
        self.false_rate = np.array([float(b.mean()) ** len(HASHES) for b in bits])

    @classmethod
    def fit(cls, texts_by_language: dict[str, list[str]]) -> LanguageFilters:
        names = sorted(texts_by_language, key=lambda x: (-len(texts_by_language[x]), x))
        masks = np.zeros((SLOTS, max(1, (len(names) + 7) // 8)), np.uint8)
        for i, name in enumerate(names):
            gram, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            for step in _in_steps(texts_by_language[name]):
                new, count = np.unique(ngrams(step)[0], return_counts=True)
                gram, at = np.unique(np.concatenate([gram, new]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([n, count]), minlength=len(gram)).astype(np.int64)
            if len(gram):
                keep = gram[n >= max(1, MIN_SHARE * n.sum())]
                for k in range(len(HASHES)):
                    masks[slots(keep, k), i // 8] |= np.uint8(1 << (i % 8))
        return cls(names, masks)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n-grams that name each language and not all, n-grams, whether there is a letter) of each text."""
        h, owner, has = ngrams(texts)
        n_lang = len(self.languages)
        out, n = np.zeros((len(texts), n_lang)), np.bincount(owner, minlength=len(texts))
        at = [slots(h, k) for k in range(len(HASHES))]
        found = [self.masks[at[0], b] & self.masks[at[1], b] & self.masks[at[2], b] for b in range(self.masks.shape[1])]
        full = np.ones(len(h), bool) if n_lang > 1 else np.zeros(len(h), bool)
        for b, f in enumerate(found):
            full &= f == (1 << min(8, n_lang - 8 * b)) - 1
        for b, f in enumerate(found):
            width = min(8, n_lang - 8 * b)
            by_mask = np.bincount(owner.astype(np.int64) * 256 + np.where(full, 0, f), minlength=256 * len(texts)).reshape(-1, 256)
            for i in range(width):
                named = np.flatnonzero((np.arange(256) >> i) & 1)
                out[:, 8 * b + i] = by_mask[:, named].sum(1)
        return out, n, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, share of the language among all named, share of n-grams that name a language) of each text."""
        if not self.languages or not texts:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        named, n, has = self.counts(texts)
        # of n n-grams outside a language's filter, n * false_rate name it all the same
        true = np.maximum(0, (named - self.false_rate * n[:, None]) / (1 - self.false_rate))
        total = true.sum(1)
        best = true.argmax(1)
        score = np.where(total > 0, true.max(1) / np.maximum(total, 1e-9), 1 / len(self.languages))
        known = np.minimum(1, total / np.maximum(n, 1))
        return [self.languages[b] if x else "und" for b, x in zip(best, has, strict=True)], np.where(has, score, 0.0), np.where(has, known, 0.0)


def learn(docs: DataFrame, text_col: str, lang_col: str, id_col: str, learnable: Column, per_language: int = DOCS_PER_LANGUAGE) -> LanguageFilters:
    rows = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    slim = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    texts: dict[str, list[str]] = {}
    for r in bounded_sample(slim, "_lang", per_language, ("_id", "_text")):
        texts.setdefault(r["_lang"], []).append(r["_text"])
    return LanguageFilters.fit({k: sorted(v) for k, v in texts.items()})


def _in_steps(texts: list[str | None]) -> Iterator[list[str]]:
    step, size = [], 0
    for t in texts:
        step.append(t or "")
        size += len(step[-1])
        if size >= STEP_CHARS:
            yield step
            step, size = [], 0
    if step:
        yield step


def identify(docs: DataFrame, model: LanguageFilters, text_col: str = "text") -> DataFrame:
    """docs' columns with lang_pred, score and known (names that docs has already are replaced)."""
    added = ("lang_pred", "score", "known")
    docs = docs.drop(*[c for c in added if c != text_col])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            parts = [m.predict(step) for step in _in_steps(batch.column(text_col).to_pylist())]
            langs = [x for p in parts for x in p[0]]
            score, known = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(known)], names=[*batch.schema.names, *added])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())])
    return docs.mapInArrow(lean(run), schema)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = learn(docs, "text", "lang", "doc_id", ~held_out)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
