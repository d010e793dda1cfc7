"""The costly text functions as Arrow UDFs: plain string methods and tables of code points instead of regular expressions.

Java's regular expressions take about a microsecond a character for these; here a batch is taken in slices of bounded
size, so that a worker holds a batch and its result and no more.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import FOLDS, STOPWORDS

#: Characters that are taken at once, and the rows of a slice at most.
SLICE_CHARS, SLICE_ROWS = 1 << 20, 512
_STOP = frozenset(STOPWORDS)


def slices(*columns: pa.Array) -> Iterator[list[list]]:
    """The columns' values, row by row in step, in slices of few characters (one row at least)."""
    n, at = len(columns[0]), 0
    size = np.zeros(n, np.int64)
    for c in columns:
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
            size += pc.binary_length(c.fill_null("")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    while at < n:
        before = ends[at - 1] if at else 0
        stop = min(n, at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right"))))
        yield [c.slice(at, stop - at).to_pylist() for c in columns]
        at = stop


def arrow(run: Callable[..., pa.Array], returns: str, kind: pa.DataType) -> Callable[..., Column]:
    """run over slices (lists of values) as a function of columns."""

    def whole(*columns: pa.Array) -> pa.Array:
        parts = [run(*part) for part in slices(*columns)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    def one(a: pa.Array) -> pa.Array:
        return whole(a)

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return whole(a, b)

    return lambda *columns: F.arrow_udf(one if len(columns) == 1 else two, returns)(*columns)


def each(f: Callable, kind: pa.DataType) -> Callable[[list], pa.Array]:
    return lambda values: pa.array([None if v is None else f(v) for v in values], kind)


# --- cleaning and comparing --------------------------------------------------------------------------------------


def clean(text: str) -> str:
    """Unix line ends, single blanks in lines, no blanks around lines, at most one empty line in a row."""
    if "\0" in text:
        text = text.replace("\0", "")
    if "\t" in text or "  " in text:
        text = re.sub("[ \t]+", " ", text)
    text = "\n".join([line.strip() for line in text.splitlines()])
    if "\n\n\n" in text:
        text = re.sub("\n{3,}", "\n\n", text)
    return text.strip()


def folded(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        for a, b in FOLDS:
            if a in text:
                text = text.replace(a, b)
    return text


def canonical(text: str) -> str:
    # the white space of collapse, and blanks alone at the ends: split() does both at once
    return folded(" ".join(text.split()))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def clean_column(c: Column) -> Column:
    return arrow(each(clean, pa.string()), "string", pa.string())(c)


def canonical_sha(c: Column) -> Column:
    """SHA-256 of the canonical text."""
    return arrow(each(lambda t: _sha(canonical(t)), pa.string()), "string", pa.string())(c)


# --- quality -----------------------------------------------------------------------------------------------------

PRINTABLE, LETTER, SPACE, BROKEN, CORE, LINK = 1, 2, 4, 8, 16, 32


@functools.cache
def code_points() -> np.ndarray:
    """What each code point is, one bit for each of the above."""
    kinds = [unicodedata.category(chr(i)) for i in range(0x110000)]
    first = np.array([ord(k[0]) for k in kinds], np.uint8)
    is_ = lambda *ks: np.isin(first, [ord(k) for k in ks])
    table = (~is_("C", "Z")) * PRINTABLE | is_("L") * LETTER | is_("L", "N") * CORE
    table[ord(" ")] |= PRINTABLE
    table[ord("_")] |= CORE
    table[[ord(c) for c in "×÷'-"]] |= LINK
    table[[*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] |= SPACE
    table[0xFFFD] |= BROKEN
    return table.astype(np.uint8)


def counts(texts: list[str]) -> dict[str, np.ndarray]:
    """Of each text its characters, those of each kind, and its words."""
    joined = "\n".join(texts) + "\n"
    flags = code_points()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    n = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(n + 1) - 1
    starts = ends - n

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[ends] - total[starts]

    # a word runs from the first to the last core character of a run of core and linking ones
    core = np.flatnonzero(flags & CORE)
    run = np.cumsum(flags & (CORE | LINK) == 0)[core]
    begins = np.zeros(len(flags), bool)
    begins[core[np.flatnonzero(np.diff(run, prepend=-1))]] = True
    return {"n": n, "printable": within(flags & PRINTABLE != 0), "letters": within(flags & LETTER != 0), "solid": within(flags & SPACE == 0), "broken": within(flags & BROKEN != 0), "words": within(begins)}


QUALITY = pa.struct([("keep", pa.bool_()), ("score", pa.float64()), ("words", pa.int32())])


def quality_of(texts: list[str | None], min_chars: int, min_words: int) -> pa.Array:
    c = counts([t or "" for t in texts])
    n, some = c["n"], np.maximum(c["n"], 1)
    printable, broken = c["printable"] / some, c["broken"] / some
    alpha = np.where(c["solid"] > 0, c["letters"] / np.maximum(c["solid"], 1), 0.0)
    score = np.maximum(0.0, np.minimum(1.0, 0.55 * alpha + 0.45 * printable - 5 * broken))
    short = (n < min_chars) | (c["words"] < min_words) | (n == 0)
    keep = ~short & (printable >= 0.96) & (alpha >= 0.45) & (broken <= 0.002)
    arrays = [pa.array(keep), pa.array(np.where(short, 0.0, score)), pa.array(c["words"].astype(np.int32))]
    return pa.StructArray.from_arrays(arrays, fields=list(QUALITY), mask=pa.array([t is None for t in texts]))


def quality_column(c: Column, min_chars: int, min_words: int) -> Column:
    return arrow(lambda texts: quality_of(texts, min_chars, min_words), "struct<keep:boolean,score:double,words:int>", QUALITY)(c)


# --- training texts ----------------------------------------------------------------------------------------------

WORDS = re.compile(r"\w(?:[\w×÷'-]*\w)?")
_search = {k: re.compile(getattr(P, k), re.IGNORECASE) for k in ("DOT_LEADER", "FRONT_MATTER", "SERIES_FRONT_MATTER", "COPYRIGHT_NOISE", "LICENSE_FRONT_MATTER", "INDEX_REFERENCE", "URL")}
_ALIKE = str.maketrans("ſıİK", "siik")


def count(text: str, name: str) -> int:
    return sum(1 for _ in _search[name].finditer(text))


def rejection(text: str, min_chars: int, min_words: int) -> str | None:
    """The first reason why a text is no training text, or None. Patterns run only where the words they need stand."""
    n = len(text)
    if n < min_chars:
        return "too_short"
    words = WORDS.findall(text)
    if len(words) < min_words:
        return "too_short"
    if n and text.count("�") / n > 0.001:
        return "replacement_characters"
    dots = text.count(".")
    if dots >= 32 and count(text, "DOT_LEADER") >= 4:
        return "dot_leaders"
    low = (text if text.isascii() else text.translate(_ALIKE)).lower()
    has = lambda *xs: any(x in low for x in xs)
    if has("http", "www.") and count(text, "URL") >= 12:
        return "url_list"
    if has("other titles in the", "library of congress catalog", "all rights reserved", "isbn"):
        front = count(text, "FRONT_MATTER")
        if front >= 2 or (front and _search["SERIES_FRONT_MATTER"].search(text)):
            return "publisher_front_matter"
    if has("copyright", "reproduction", "all rights reserved") and count(text, "COPYRIGHT_NOISE") >= 3:
        return "copyright_noise"
    if has("courseware license agreement", "read carefully", "complete and exclusive statement of agreement") and _search["LICENSE_FRONT_MATTER"].search(text):
        return "license_front_matter"
    if dots <= 3 and text.count(",") >= 12 and count(text, "INDEX_REFERENCE") >= 12:
        return "index_or_reference_list"
    if words and len({folded(w) for w in set(words)}) / len(words) < 0.12:
        return "low_vocabulary_diversity"
    return None


def rejection_column(c: Column, min_chars: int, min_words: int) -> Column:
    return arrow(each(lambda t: rejection(t, min_chars, min_words), pa.string()), "string", pa.string())(c)


def overlap(previous: str | None, current: str | None, anchor: int, tail: int) -> int:
    """How many characters at the start of current repeat the end of previous exactly; 0 below anchor characters."""
    if previous is None or current is None or min(tail, len(previous), len(current)) < anchor:
        return 0
    end = previous[-min(tail, len(previous), len(current)) :]
    at = end.rfind(current[:anchor])
    return len(end) - at if at >= 0 and current.startswith(end[at:]) else 0


TRIMMED = pa.struct([("n", pa.int32()), ("text", pa.string()), ("reason", pa.string()), ("key", pa.string())])


def trimmed_column(previous: Column, own: Column, anchor: int, tail: int, judge: tuple[int, int] | None = None) -> Column:
    """struct<n, text, reason, key>: the stripped text without what repeats its neighbour; with judge = (min_chars,
    min_words) also its reason and the hash of its canonical text."""

    def run(before: list, texts: list) -> pa.Array:
        rows = []
        for p, t in zip(before, texts, strict=True):
            t = None if t is None else t.strip()
            n = overlap(p, t, anchor, tail)
            t = t[n:].lstrip() if n else t
            told = (rejection(t, *judge), _sha(canonical(t))) if judge and t is not None else (None, None)
            rows.append((n, t, *told))
        return pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), TRIMMED, strict=True)], fields=list(TRIMMED))

    return arrow(run, "struct<n:int,text:string,reason:string,key:string>", TRIMMED)(previous, own)


# --- terms and runs of words -------------------------------------------------------------------------------------


def term_counts(accented: str, plain: str, most: int = 200_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (term, rows that have it, occurrences), told whenever `most` terms are held and at the end."""
    mapped = str.maketrans(accented, plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = Counter(), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([rows[t] for t in total], pa.int64()), pa.array(list(total.values()), pa.int64())], ["term", "chunks", "occurrences"])

        for batch in batches:
            for (texts,) in slices(batch.column(0)):
                for text in texts:
                    found = re.findall(r"[^\W_]+", text.lower().translate(mapped)) if text else []
                    total.update(found)
                    rows.update(set(found))
                if len(total) >= most:
                    yield told()
                    rows, total = Counter(), Counter()
        if total:
            yield told()

    return run


def grams(wanted, sizes: tuple[int, ...]) -> Callable[[list], pa.Array]:
    """Of each text the distinct runs of topic words that are wanted (a broadcast set)."""

    def of(text: str) -> list[str]:
        words = [w for w in re.findall("[a-z0-9]+", folded(text)) if w not in _STOP]
        return sorted({g for n in sizes for g in map(" ".join, zip(*[words[k:] for k in range(n)], strict=False)) if g in wanted.value})

    return each(of, pa.list_(pa.string()))
