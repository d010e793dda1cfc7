"""Operator 8: near duplicates by ProbMinHash, banding and verification.

A text is a set of word shingles (five words; a shorter text is one shingle), each weighted by how often the text has
it. Every shingle is a Poisson process whose rate is its weight; its arrivals fall on random registers, each register
keeps its first arrival, and a shingle is given up once its next arrival is later than all registers (early
termination). Two texts agree in a register with the probability Jaccard of their weights,
sum_i 1 / sum_j max(x_j / x_i, y_j / y_i), whatever their lengths. A text that has shingles more than once gets a second
signature with all weights one, whose agreement is the Jaccard of the sets, so that a copy which repeats a passage more
often than its original is not hidden. Both signatures are cut into the same bands; texts that agree in a band are
candidates. A link is a pair of different texts whose exact probability Jaccard, weighted by counts or evenly, is 0.8 or
more: both measures are banded, sketched and verified. Classes are the connected components of links.

Exact copies are one text from the start. No bucket is expanded into pairs: every text is first compared
with the centres of its buckets, and only buckets whose members still belong to different classes are looked into.
Their texts get longer signatures; each proposes its best partner in another class, and a last round proposes all
pairs across classes that remain. Pairs whose registers agree so little in both signatures that a link is out of
question (``FLOOR``, ``LONG_FLOOR``: five standard deviations below 0.8 at the width used) are not verified.

Links, classes and signatures stay in tables in the shared folder. The sets of shingles are made
again for the texts that share a bucket, only.

Defined cases: null and wordless texts have no shingles and are classes by themselves, row by row; repeated
rows belong to one class; class ids are the smallest document id in a class, null ids last; a class of rows
without any id has a null class id; different texts under one id are told apart by their keys (``class_key``); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, shuffle_partitions, stored, table, words_of
from .components import components
from .suffixes import Hashes, mixed, prefix_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS = 20, 4
REGISTERS = BANDS * BAND_ROWS
FLOOR = 0.55
#: Shingles handled at once, by width of signature.
STEP, LONG_STEP = 400_000, 50_000
#: Registers, and least share of equal ones, of the longer signatures of distinct shingles that are made of the
#: texts in buckets with several classes: five standard deviations below 0.8.
LONG, LONG_FLOOR = 512, 0.71


def shingles(words: list[bytes], hashes: Hashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted hashes of a text's distinct shingles, and how often it has each."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes.of(words)
    k = min(size, len(words))
    return np.unique(prefix_hashes(h, k, len(h) - k + 1) ^ np.uint64(k), return_counts=True)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def prob_minhash(ids: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (texts x registers) of weighted elements; owner says which text an element belongs to."""
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    alive, when, state = np.arange(len(ids)), np.zeros(len(ids)), ids
    while len(alive):
        state = mixed(state + np.uint64(0x9E3779B97F4A7C15))
        when = when - np.log(_uniform(state)) / weights[alive]
        at = owner[alive] * registers + (mixed(state ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(registers)).astype(np.int64)
        better = when < first[at]
        np.minimum.at(first, at[better], when[better])
        won = np.flatnonzero(better)
        won = won[first[at[won]] == when[won]]
        kept[at[won]] = ids[alive[won]]
        last = first.reshape(texts, registers).max(1)
        go = when < last[owner[alive]]  # later arrivals of an element are later still
        alive, when, state = alive[go], when[go], state[go]
    return mixed(kept).reshape(texts, registers)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("_key"))


def _signed(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets by weight, and by even weights; the two are one where a set has nothing twice."""
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    ids, counts = (np.concatenate([x[k] for x in sets]) for k in (0, 1))
    own = prob_minhash(ids, counts.astype(float), owner, len(sets), registers)
    even = own.copy()
    again = [i for i, (_, n) in enumerate(sets) if len(n) and n.max() > 1]
    if again:
        owner = np.repeat(np.arange(len(again)), [len(sets[i][0]) for i in again])
        even[again] = prob_minhash(np.concatenate([sets[i][0] for i in again]), np.ones(len(owner)), owner, len(again), registers)
    return own, even


def _low(own: np.ndarray, even: np.ndarray) -> list[bytes]:
    """A byte of each register of both signatures."""
    both = (np.concatenate([own, even], axis=1) & np.uint64(255)).astype(np.uint8)
    return [x.tobytes() for x in both]


def signatures(keyed: DataFrame) -> DataFrame:
    """(_id, _key, sig: a byte of each register, bands: a hash of each band), of both weightings; empty where a text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()

        def banded(sig: np.ndarray) -> np.ndarray:
            band = np.zeros((len(sig), BANDS), np.uint64)
            for r in range(BAND_ROWS):
                band = mixed(band * np.uint64(31) + sig[:, r::BAND_ROWS] + np.arange(BANDS, dtype=np.uint64))
            return band

        def signed(sets: list) -> tuple[list, list]:
            if not any(len(h) for h, _ in sets):
                return [b""] * len(sets), [[]] * len(sets)
            own, even = _signed(sets, REGISTERS)
            band, low = np.concatenate([banded(own), banded(even)], axis=1).view(np.int64), _low(own, even)
            return [x if len(h) else b"" for x, (h, _) in zip(low, sets, strict=True)], [x if len(h) else [] for x, (h, _) in zip(band, sets, strict=True)]

        for batch in batches:
            sig, bands, step, size = [], [], [], 0
            for t in batch.column("_text"):
                step.append(shingles(words_of(t.as_py()), hashes))
                size += len(step[-1][0])
                if size >= STEP:
                    for out, new in zip((sig, bands), signed(step), strict=True):
                        out.extend(new)
                    step, size = [], 0
            for out, new in zip((sig, bands), signed(step), strict=True):
                out.extend(new)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_key"), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["_id", "_key", "sig", "bands"])

    return keyed.mapInArrow(lean(run), "_id long, _key binary, sig binary, bands array<long>")


def agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Share of equal registers of two columns of signatures, of the weighting in which it is larger."""
    if not len(a):
        return np.zeros(0)
    x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(len(v), 2, -1) for v in (a, b))
    return (x == y).mean(2).max(1)


def _likely(pairs: DataFrame, floor: float) -> DataFrame:
    """pairs (a, b, sa, sb) -> (a, b) of those whose registers agree enough for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(agreement(batch.column("sa"), batch.column("sb")) >= floor)
            yield batch.select(["a", "b"]).filter(keep)

    return pairs.mapInArrow(lean(run), "a binary, b binary")


def _packed(h: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct hashes as their upper five bytes; two texts' sets meet by chance in less than one of 2**40 / (n * m) cases.

    A first byte says whether counts of four bytes follow; they are left out where all are one.
    """
    top = h >> np.uint64(24)
    if len(top) > 1 and (top[1:] == top[:-1]).any():
        top, at = np.unique(top, return_inverse=True)
        counts = np.bincount(at, weights=counts).astype(np.int64)
    raw = top.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    return b"\0" + raw if not len(counts) or counts.max() == 1 else b"\1" + raw + counts.clip(max=2**32 - 1).astype("<u4").tobytes()


def _unpacked(raw) -> tuple[np.ndarray, np.ndarray]:
    raw = memoryview(raw)
    width = 9 if raw[0] else 5
    n = (len(raw) - 1) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8, 5 * n, 1).reshape(-1, 5)
    return out.view("<u8").ravel(), np.frombuffer(raw, "<u4", n, 1 + 5 * n).astype(np.int64) if width == 9 else np.ones(n, np.int64)


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard of two sets (sorted hashes, counts), weighted by counts or evenly: the larger of the two."""
    (hx, nx), (hy, ny) = x, y
    if not len(hx) or not len(hy):
        return 0.0
    at = np.minimum(np.searchsorted(hy, hx), len(hy) - 1)
    both = hy[at] == hx
    even = both.sum() / (len(hx) + len(hy) - both.sum())
    if (nx.max() == 1 and ny.max() == 1) or not both.any():
        return float(even)
    a, b = nx[both].astype(float), ny[at[both]].astype(float)
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    # of the shared shingles with a ratio as large as this one's, or larger, x's weight counts; of the others y's
    tail_a, head_b = a[::-1].cumsum()[::-1], b.cumsum() - b
    return float(max(even, (1 / ((nx.sum() - a.sum() + tail_a) / a + (ny.sum() - b.sum() + head_b) / b)).sum()))


def shingle_sets(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_key, set) of the texts in wanted (_key, first). Of copies, the one with that id is read; the id spreads them."""
    mine = wanted.select(F.col("_key").alias("_k"), F.col("first").alias("_f"))
    one = keyed.join(mine, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_f"))).groupBy("_key").agg(F.first("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            sets = [_packed(*shingles(words_of(t.as_py()), hashes)) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(sets, pa.binary())], names=["_key", "set"])

    return one.mapInArrow(lean(run), "_key binary, set binary")


def long_signatures(sets: DataFrame, registers: int = LONG) -> DataFrame:
    """(_key, sig): longer signatures of both weightings, a byte of each register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, step, size = [], [], 0
            for x in batch.column("set"):
                ids, counts = _unpacked(x.as_buffer())
                step.append((mixed(ids), counts))
                size += len(ids)
                if size >= LONG_STEP:
                    sig.extend(_low(*_signed(step, registers)))
                    step, size = [], 0
            if step:
                sig.extend(_low(*_signed(step, registers)))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(sig, pa.binary())], names=["_key", "sig"])

    return sets.mapInArrow(lean(run), "_key binary, sig binary")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of texts whose similarity reaches the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(_unpacked(x.as_buffer()), _unpacked(y.as_buffer())) >= threshold - 1e-9 for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(sets.select(F.col("_key").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("_key").alias("b"), F.col("set").alias("sb")), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(lean(compare), "a binary, b binary")


def _across(part: pa.Table, floor: float, nearest: bool) -> pa.Table:
    """One bucket: likely pairs of different classes; each text's best one, or all that share no earlier bucket.

    An earlier bucket of a pair holds several classes as well, so that its task proposes the pair.
    """
    sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(part.num_rows, 2, -1)
    _, comp = np.unique(np.array(part.column("comp").to_pylist(), object), return_inverse=True)
    order = np.argsort(comp, kind="stable")
    sig, comp, keys = sig[order], comp[order], part.column("_key").combine_chunks().take(pa.array(order))
    n, band = len(keys), part.column("band")[0].as_py()
    bands = np.array(part.column("bands").to_pylist(), np.int64)[order]
    end = np.r_[np.flatnonzero(comp[1:] != comp[:-1]) + 1, n]
    two = bool((sig[:, 0] != sig[:, 1]).any())
    block = max(1, 16_000_000 // (sig.shape[2] * max(1, n)))
    top, to, found = np.zeros(n, np.float32), np.full(n, -1, np.int64), [np.zeros((2, 0), np.int64)]
    for at in range(0, n, block):
        rest = int(end[np.searchsorted(end, at, side="right")])  # later classes than that of the block's first text
        if rest >= n:
            break
        mine = slice(at, min(n, at + block))
        same = (sig[mine, None, 0] == sig[None, rest:, 0]).mean(2, dtype=np.float32)
        if two:
            same = np.maximum(same, (sig[mine, None, 1] == sig[None, rest:, 1]).mean(2, dtype=np.float32))
        same[comp[mine, None] >= comp[None, rest:]] = 0
        if not nearest:
            i, j = np.stack(np.nonzero(same >= floor)) + [[at], [rest]]
            earliest = (bands[i] == bands[j]).argmax(1)
            own = bands[i, earliest] == band
            found.append(np.stack([i[own], j[own]]))
            continue
        for own, best, other in ((mine, same.max(1), same.argmax(1) + rest), (slice(rest, n), same.max(0), same.argmax(0) + at)):
            better = best > top[own]
            top[own] = np.where(better, best, top[own])
            to[own] = np.where(better, other, to[own])
    i = np.flatnonzero(top >= floor) if nearest else np.zeros(0, np.int64)
    i, j = np.concatenate([*found, np.stack([i, to[i]])], axis=1)
    x, y = keys.take(pa.array(i)), keys.take(pa.array(j))
    turned = pa.compute.less(y, x)
    return pa.table({"a": pa.compute.if_else(turned, y, x), "b": pa.compute.if_else(turned, x, y)})


def _proposer(floor: float, nearest: bool):
    return lambda part: _across(part, floor, nearest)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, floor: float = FLOOR) -> tuple[DataFrame, DataFrame]:
    """(rows: _id, _key, class, comp, n_links of each document; links between different texts).

    comp is the least key of the class's texts and null for wordless rows; n_links counts the different texts that a text
    is linked to among the pairs that were verified, which connect each class but need not be all of its pairs.
    """
    n = shuffle_partitions(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    signed = stored(signatures(keyed))
    texts = signed.where(F.length("sig") > 0).groupBy("_key").agg(F.max("sig").alias("sig"), F.max("bands").alias("bands"), F.min("_id").alias("first"))
    each = texts.select("_key", "sig", F.explode(F.array_distinct("bands")).alias("band"))
    slim = each.select("_key", "band")
    # the centre of a bucket: its text with the smallest key, a hash
    buckets = slim.groupBy("band").agg(F.min("_key").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(slim.join(buckets, "band").select("_key", "band", "centre"))
    # first the pairs of a text and the centres of its buckets
    star = members.where("_key <> centre").select(F.col("centre").alias("a"), F.col("_key").alias("b")).distinct()
    sig_of = texts.select("_key", "sig")
    with_sig = star.join(sig_of.select(F.col("_key").alias("a"), F.col("sig").alias("sa")), "a").join(sig_of.select(F.col("_key").alias("b"), F.col("sig").alias("sb")), "b")
    tested = stored(_likely(with_sig.select("a", "b", "sa", "sb"), floor))
    # only texts that share a bucket can be linked: their sets are made once
    sets = stored(shingle_sets(keyed, texts.select("_key", "first").join(members.select("_key").distinct(), "_key", "left_semi")))
    links = stored(_verified(tested, sets, threshold))
    label, long = components(links), None
    for nearest in (True, False):
        labelled = members.select("_key", "band").join(label.withColumnRenamed("node", "_key"), "_key", "left").withColumn("comp", F.coalesce("comp", "_key"))
        several = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
        inside = labelled.join(several, "band")
        if long is None:  # classes only grow together: the last round needs no other texts
            long = stored(long_signatures(sets.join(inside.select("_key").distinct(), "_key", "left_semi")).join(texts.select("_key", "bands"), "_key"))
        inside = inside.join(long, "_key").select("band", "_key", "comp", "sig", "bands")
        proposed = inside.repartition(n, "band").groupBy("band").applyInArrow(_proposer(LONG_FLOOR, nearest), "a binary, b binary")
        pairs = stored(proposed.distinct().join(tested, ["a", "b"], "left_anti"))
        new = stored(_verified(pairs, sets, threshold))
        if not new.isEmpty():
            links = links.union(new)
            label = components(links)
        tested = tested.union(pairs)
    degree = links.select(F.explode(F.array("a", "b")).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("n_links"))
    by_text = texts.select("_key", "first").join(label.withColumnRenamed("node", "_key"), "_key", "left").join(degree, "_key", "left").withColumn("comp", F.coalesce("comp", "_key"))
    ids = by_text.groupBy("comp").agg(F.min("first").alias("class"))
    text_class = by_text.join(ids, "comp").select("_key", "class", "comp", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    has = F.length("sig") > 0
    alone = signed.where(~has).select("_id", "_key", F.col("_id").alias("class"), F.lit(None).cast("binary").alias("comp"), F.lit(0).cast("long").alias("n_links"))
    return signed.where(has).select("_id", "_key").join(text_class, "_key").unionByName(alone), links


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs with one row of each class; wordless rows all stay.

    The row that stays has the smallest id (null ids last), of texts under one id the one with the smallest key, and of
    repeated rows the first by its other columns. Repeated rows are one before anything is shuffled.
    """
    columns = docs.columns
    rows, _ = classes(docs, id_col, text_col, **kw)
    place = lambda i, key: F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("-")), F.hex(key)).cast("binary"))
    best = rows.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("key"))).alias("w"))
    winners = best.select(place(F.col("w.id"), F.col("w.key")).alias("_place"))
    wordless = ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    others = [F.col(f"`{c}`") for c in columns if c != text_col]
    row, order = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.to_json(F.struct(*others)) if others else F.lit("")
    key = F.unhex(F.md5(F.col(text_col).cast("binary")))
    once = docs.where(~wordless).select(place(F.col(id_col), key).alias("_place"), order.alias("_order"), row).groupBy("_place").agg(F.min_by("_row", "_order").alias("_row"))
    return once.join(winners, "_place", "left_semi").select("_row.*").unionByName(docs.where(wordless))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: doc_id, class_id (the smallest doc_id of its class), class_key and n_links."""
    rows, _ = classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("_id").alias("doc_id"), F.col("class").alias("class_id"), F.lower(F.hex("comp")).alias("class_key"), "n_links")
