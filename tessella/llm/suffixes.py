"""Operator 4: substring deduplication by prefix-partitioned suffix trees.

Every word starts a suffix. Suffixes are split into groups by variable-length prefixes: a suffix belongs to the group of
its shortest prefix that is not frequent, so that no group outgrows a task's memory. How many groups there are follows
from the size of all texts (``GROUP_CHARS``); which prefixes are frequent is estimated on a bounded sample, which moves
groups about but changes no result.

The tree of a group is cut off at ``WINDOW`` words and kept in sorted order: a suffix is the labels of its path, hashes of
its words 1-4, 5-8 and 9-13 (32, 24 and 24 bits), and suffixes are sorted by these labels, so that every node is a run of
neighbours. Runs that agree in all three labels are the nodes of depth ``WINDOW``. Two things depart from trees over
letters: labels are hashes, so that two different windows of one group meet with a probability of 2**-80 a pair (1e-7 of
one false match expected among 5e9 windows in 1000 groups), and longer repeats show as overlapping nodes of that depth,
which the documents join again to maximal repeats, instead of as deeper nodes.

Of a node only the earliest document matters. Documents are dealt into ranges of ids whose bounds come from a bounded
sample; an id (or no id) that many rows share gets several ranges of one class, and a range is told of those of its
windows that a range of an earlier class has as well. Before anything is sent, the windows of a range are reduced to
distinct ones, so a passage with any number of copies is one suffix for each range. The texts cross the network once:
both passes over them, and the answer, are grouped by the same exchange.

Defined cases: a null text has no words; a null id is after all others and as late as other nulls; rows that
repeat an id do not remove each other's windows; a text of fewer words than a window keeps all; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import even_keys, give_back, shuffle_partitions, table, words_of
from .sampling import few_texts

WINDOW = 13
#: Where the labels of a path end, and their bits.
LABELS = ((4, 32), (8, 24), (WINDOW, 24))
#: Most words of a variable-length prefix, and the texts (of at most so many characters) that are sampled to find the frequent ones.
DEPTH, SAMPLE_TEXTS, SAMPLE_CHARS = 4, 400, 20_000
#: Characters of text for each group and each range (about five million suffixes, 100 MB), and ids sampled for each range.
GROUP_CHARS, RANGE_IDS = 32_000_000, 64
CACHE = 300_000
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Hashes(dict):
    """Word -> 64-bit hash, remembering recent words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE:
            self.clear()
        if len(word) < 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h ^= h >> np.uint64(29)
    h *= _MUL
    return h ^ (h >> np.uint64(32))


def prefix_hashes(h: np.ndarray, length: int, last: int) -> np.ndarray:
    """Of the first `last` positions, the hash of `length` words from there on."""
    out = h[:last].copy()
    for k in range(1, length):
        out = out * _MUL + h[k : last + k]
    return mixed(out)


class Prefixes:
    """Frequent prefixes of 1 to DEPTH - 1 words; a suffix's group comes from its shortest prefix that is not among them."""

    def __init__(self, texts: list[str], groups: int):
        self.groups, self.frequent, self.keys = groups, [], even_keys(groups)
        hashes = Hashes()
        arrays = [hashes.of(words_of(t)) for t in texts]
        total = sum(map(len, arrays))
        for length in range(1, DEPTH):
            found = [prefix_hashes(a, length, len(a) - length + 1) for a in arrays if len(a) >= length]
            values, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0))
            self.frequent.append(values[n > max(1, total / (8 * groups))])  # at most 8 * groups of them

    def group(self, h: np.ndarray, last: int) -> np.ndarray:
        out = prefix_hashes(h, 1, last)
        for length, frequent in enumerate(self.frequent, 1):
            if not len(frequent):
                break
            at = np.minimum(np.searchsorted(frequent, out), len(frequent) - 1)
            more = np.flatnonzero(frequent[at] == out)
            if not len(more):
                break
            longer = h[more]
            for k in range(1, length + 1):
                longer = longer * _MUL + h[more + k]
            out[more] = mixed(longer)
        return self.keys[((out >> np.uint64(32)) % np.uint64(self.groups)).astype(np.int64)]


def labels(h: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Of every window, the labels of its path as 64 and 16 bits that sort like the labels; h are hashes of words."""
    last = len(h) - window + 1
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    ends = [(min(end, window), bits) for end, bits in LABELS]
    ends[-1] = (window, ends[-1][1])
    start, parts = 0, []
    for end, bits in ends:
        size = max(1, end - start)
        parts.append(prefix_hashes(h[min(start, window - 1) :], size, last) >> np.uint64(64 - bits))
        start = end
    high = (parts[0] << np.uint64(32)) | (parts[1] << np.uint64(8)) | (parts[2] >> np.uint64(16))
    return high, (parts[2] & np.uint64(0xFFFF)).astype(np.uint16)


def _pack(high: np.ndarray, low: np.ndarray) -> bytes:
    """Sorted labels: their first 16 bits as differences, the rest as it is."""
    top = (high >> np.uint64(48)).astype(np.int32)
    steps = zstandard.ZstdCompressor(level=1).compress(np.diff(top, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())
    rest = np.ascontiguousarray(high, "<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return len(high).to_bytes(8, "little") + len(steps).to_bytes(8, "little") + steps + rest.tobytes() + low.astype("<u2").tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[16 : 16 + size]), np.uint8).reshape(2, -1) if n else np.zeros((2, 0), np.uint8)
    top = np.cumsum(np.ascontiguousarray(steps.T).view("<u2").ravel().astype(np.int64)).astype(np.uint64)
    high = np.zeros((n, 8), np.uint8)
    high[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, 16 + size).reshape(-1, 6)
    return high.view("<u8").ravel() | (top << np.uint64(48)), np.frombuffer(raw, "<u2", n, 16 + size + 6 * n)


def _joined(arrays: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.uint64), *(a for a, _ in arrays)]), np.concatenate([np.zeros(0, np.uint16), *(b for _, b in arrays)])


def _sorted(high: np.ndarray, low: np.ndarray, stable: bool = True) -> np.ndarray:
    """The order of labels. Sorting by the first 64 bits is enough unless two different labels share them."""
    order = np.argsort(high, kind="stable" if stable else None)
    h, x = high[order], low[order]
    if ((h[1:] == h[:-1]) & (x[1:] != x[:-1])).any():
        return np.lexsort((low, high))
    return order


def _again(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Of sorted labels, whether each equals the one before."""
    return np.r_[False, (high[1:] == high[:-1]) & (low[1:] == low[:-1])] if len(high) else np.zeros(0, bool)


def _among(high: np.ndarray, low: np.ndarray, known_high: np.ndarray, known_low: np.ndarray) -> np.ndarray:
    """Whether each pair of labels is one of the known, which are sorted."""
    found = np.zeros(len(high), bool)
    if not len(known_high):
        return found
    at = np.searchsorted(known_high, high)
    steps = int(np.diff(np.flatnonzero(np.r_[True, known_high[1:] != known_high[:-1], True])).max())
    for k in range(steps):  # as many as there are equal first labels
        here = np.minimum(at + k, len(known_high) - 1)
        found |= (known_high[here] == high) & (known_low[here] == low)
    return found


def plan(docs: DataFrame, id_col: str, text_col: str) -> tuple[int, list[float], dict[float, int], int, int]:
    """(groups, bounds of id ranges, ids with several ranges -> how many, ranges of rows without id, rows), from sizes and a bounded sample of ids."""
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.count(id_col).alias("ids"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars")).first()
    n = max(shuffle_partitions(docs.sparkSession), -(-size["chars"] // GROUP_CHARS))
    if not size["ids"]:
        return n, [], {}, n, size["rows"]
    share = min(1.0, RANGE_IDS * n / size["ids"])
    some = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("double"))
    ids = sorted(r[0] for r in (some.sample(share, 7) if share < 1 else some).collect()) or [0.0]  # about RANGE_IDS * n numbers
    cuts = Counter(ids[len(ids) * i // n] for i in range(1, n))
    return n, sorted(cuts), {v: m for v, m in cuts.items() if m > 1}, 1 + n * (size["rows"] - size["ids"]) // size["rows"], size["rows"]


def dealt(docs: DataFrame, id_col: str, text_col: str, bounds: list[float], several: dict[float, int], without: int) -> tuple[DataFrame, np.ndarray]:
    """((_id, _text, _range), the keys of ranges, their classes). Keys and classes ascend with the id. One exchange, by range."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn("_key", F.col("_id").cast("double"))
    splits = [float("-inf"), *(bounds or [0.0]), float("inf")]
    # every bucket between two bounds is a range; the ranges of an id that has several come before that of its bucket
    classes, first, own = [], [], {}
    for i in range(len(splits) - 1):
        if splits[i] in several:
            own[splits[i]] = len(classes)
            classes += [len(classes)] * several[splits[i]]
        first.append(len(classes))
        classes.append(len(classes))
    rest = len(classes)
    classes += [rest] * without
    spread = F.pmod(F.xxhash64("_text"), F.lit(1 << 30))
    bucket = F.element_at(F.array(*map(F.lit, first)), F.col("_b").cast("int") + 1)
    number = bucket
    if own:
        start, many = (F.element_at(F.create_map(*[F.lit(x) for v, k in pairs.items() for x in (v, k)]), F.col("_key")) for pairs in (own, several))
        number = F.coalesce((start + spread % many).cast("int"), bucket)
    number = F.when(F.col("_key").isNull(), F.lit(rest) + spread % without).otherwise(number)
    bucketed = Bucketizer(splits=splits, inputCol="_key", outputCol="_b", handleInvalid="keep").transform(slim)
    keys = even_keys(len(classes))
    key = F.element_at(F.array(*[F.lit(int(k)) for k in keys]), number.cast("int") + 1)
    return bucketed.select("_id", "_text", key.alias("_range")).repartition(len(classes), "_range"), keys, np.array(classes, np.int64)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each document, with the kept words as text on demand."""
    spark = docs.sparkSession
    n, bounds, several, without, total = plan(docs, id_col, text_col)
    rows, keys, classes = dealt(docs, id_col, text_col, bounds, several, without)
    sample = few_texts(docs, id_col, text_col, total, SAMPLE_TEXTS, SAMPLE_CHARS)
    shared = spark.sparkContext.broadcast((Prefixes(sample, n), keys, classes))

    def suffixes(part: pa.Table) -> pa.Table:
        """The distinct suffixes of a range, by group."""
        split = shared.value[0]
        hashes, found, groups = Hashes(), [], []
        for t in part.column("_text"):
            h = hashes.of(words_of(t.as_py()))
            if len(h) >= window:
                found.append(labels(h, window))
                groups.append(split.group(h, len(h) - window + 1).astype(np.int64))
        out: dict[str, list] = {"_group": [], "_range": [], "suffixes": []}
        if found:
            (high, low), group = _joined(found), np.concatenate(groups)
            del found, groups
            order = _sorted(high, low, stable=False)
            place = np.searchsorted(split.keys, group).astype(np.uint16 if split.groups <= 1 << 16 else np.int64)
            order = order[np.argsort(place[order], kind="stable")]
            high, low, group = high[order], low[order], group[order]
            new = ~_again(high, low) | np.r_[True, group[1:] != group[:-1]]
            high, low, group = high[new], low[new], group[new]
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            own = part.column("_range")[0].as_py()
            for a, b in zip(cuts, [*cuts[1:], len(high)], strict=True):
                out["_group"].append(int(group[a]))
                out["_range"].append(own)
                out["suffixes"].append(_pack(high[a:b], low[a:b]))
        give_back()
        return pa.table(out, pa.schema([("_group", pa.int32()), ("_range", pa.int32()), ("suffixes", pa.binary())]))

    def nodes(part: pa.Table) -> pa.Table:
        """The tree of a group; to each range, those of its suffixes whose deepest node starts in a range of an earlier class."""
        _, keys, classes = shared.value
        part = part.sort_by("_range")  # suffixes of a range are sorted: of equal ones, a stable order has the earliest range first
        ranges, arrays = part.column("_range").to_pylist(), [_unpack(x.as_py()) for x in part.column("suffixes")]
        owner = np.repeat(np.array(ranges, np.int32), [len(a) for a, _ in arrays])
        high, low = _joined(arrays)
        del arrays
        order = _sorted(high, low)
        high, low, owner = high[order], low[order], owner[order]
        again = _again(high, low)
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(high))))  # of a node the suffix of the earliest range
        own_class = classes[np.searchsorted(keys, owner)]
        later = own_class > own_class[first]
        high, low, owner = high[later], low[later], owner[later]
        out: dict[str, list] = {"_range": [], "suffixes": []}
        for r in np.unique(owner):
            own = owner == r
            out["_range"].append(int(r))
            out["suffixes"].append(_pack(high[own], low[own]))
        give_back()
        return pa.table(out, pa.schema([("_range", pa.int32()), ("suffixes", pa.binary())]))

    names = [id_col, "n_words", "n_removed", "kept_sha256"]
    schema = pa.schema([(id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *([("kept_text", pa.string())] if keep_text else [])])

    def removed(part: pa.Table, told: pa.Table) -> pa.Table:
        ids = part.column("_id").to_pylist()
        known = _joined([_unpack(x.as_py()) for x in told.column("suffixes")])
        by = _sorted(*known)
        known = known[0][by], known[1][by]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        hashes, words, found = Hashes(), [], []
        for i in order:
            words.append(words_of(part.column("_text")[i].as_py()))
            found.append(labels(hashes.of(words[-1]), window))
        last = [len(a) for a, _ in found]
        high, low = _joined(found)
        del found
        rank = np.cumsum([0, *(ids[order[i]] != ids[order[i - 1]] for i in range(1, len(order)))]) if order else np.zeros(0, np.int64)
        owner = np.repeat(rank, last)
        gone = _among(high, low, *known)
        if len(high):
            by = _sorted(high, low)  # stable: within a window by rank
            again = _again(high[by], low[by])
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))
            gone[by] |= owner[by] > owner[by][first]
        out: list[list] = [[], [], [], [], []]
        at = 0
        for i, w, k in zip(order, words, last, strict=True):
            mark = np.zeros(len(w) + 1, np.int32)
            hit = np.flatnonzero(gone[at : at + k])
            at += k
            if len(hit):
                np.add.at(mark, hit, 1)
                np.add.at(mark, hit + window, -1)
            keep = np.cumsum(mark)[: len(w)] == 0
            kept = b" ".join([x for x, y in zip(w, keep, strict=True) if y]) if len(hit) else b" ".join(w)
            for column, value in zip(out, (ids[i], len(w), int(len(w) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if keep_text else None), strict=True):
                column.append(value)
        give_back()
        return pa.table(dict(zip(schema.names, out, strict=False)), schema)

    sent = rows.groupBy("_range").applyInArrow(suffixes, "_group int, _range int, suffixes binary")
    answers = sent.repartition(n, "_group").groupBy("_group").applyInArrow(nodes, "_range int, suffixes binary").repartition(len(classes), "_range")
    result = rows.groupBy("_range").cogroup(answers.groupBy("_range")).applyInArrow(removed, f"{id_col} long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else ""))
    return result if keep_text else result.select(*names)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
