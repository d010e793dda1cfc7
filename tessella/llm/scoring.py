"""Operator 1: language-model scores by a hierarchical Pitman-Yor process.

A text is a chain of words and an end. Each preceding word opens a restaurant whose customers are the words
that follow it; all these context restaurants share one parent, the root, whose base is uniform over the
training vocabulary and one unknown word. The tables at which a dish's customers sit are customers of the root.

The number of tables of every dish is drawn by Gibbs sampling, sweep by sweep. Given an auxiliary gamma variable for each
restaurant, its dishes do not depend on each other: c customers sit at t tables with weight S(c, t) * y**t, where
y = d * x * (the parent's probability of the dish) and S are the generalised Stirling numbers. The discount d is 1/2, at
which S(c, t) = Gamma(2c - t) / (Gamma(c - t + 1) * Gamma(t) * 4**(c - t)), so that dishes of any number of customers are
drawn by one and the same rule (:func:`seat`). Predictive probabilities are averaged over ``SAMPLES`` sweeps after
``BURN_IN``; those of a context add up to one in each sweep.

Two things are approximate. All restaurants of a sweep are drawn side by side, given the root's predictive probabilities
after the sweep before (not after each draw); and gamma variables are cubes of normal ones (Wilson and Hilferty). Random
numbers are hashes of what they are drawn for (sweep, context, word), so scores depend neither on the number of
partitions nor on the order of rows.

Words and restaurants are told apart by 64-bit hashes and are not bounded. Everything about a word - its counts, its
tables in all restaurants, all its occurrences - is dealt to one task by one exchange, which every sweep reads again.
Words so frequent that they would outgrow a task are dealt by word and context; which ones is estimated on a bounded
sample, which moves work about and changes no result. After every sweep each part sends the tables of its contexts (and
its share of the frequent words' root customers) to the tasks that own these keys and gets the sums back: keys cross the
network once, sums once a sweep. All of this is one plan of grouped maps, in which the exchanges of the events and of the
keys are made once and used by every sweep; lost tasks are made again from the same hashes.

Defined cases: a null text counts as empty and consists of an end; a null id counts as an empty text for the
split; repeated rows are scored and learned each; without training texts all probabilities are the base's; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_LOWER, even_keys, give_back, lean, table
from .sampling import few_texts
from .suffixes import Hashes, mixed

BURN_IN, SAMPLES, SEED = 1, 2, 17
SWEEPS = BURN_IN + SAMPLES
DISCOUNT, STRENGTH = 0.5, 1.0
BATCH_TOKENS, BATCH_TEXTS = 1_000_000, 60_000
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 20_000
#: Characters of text for each part: about two million events at 50 bytes, all at once; and the least number of parts.
PART_CHARS, LEAST_PARTS = 12_000_000, 8
END, START = np.uint64(1), np.uint64(2)
HELD_OUT = (7, 2)
#: Sums of logarithms are whole numbers of this fraction, so that they do not depend on the order of addition.
UNIT = 1e-9


def held_out(doc_id, modulus: int = HELD_OUT[0], rest: int = HELD_OUT[1]) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == rest


def tokens(text: str | None, hashes: Hashes) -> np.ndarray:
    """Hashes of a text's words and of its end."""
    words = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []
    return np.append(hashes.of(words), END)


class Layout:
    """Which of n parts a word belongs to, by the part's key; frequent words are dealt by context as well."""

    def __init__(self, n: int, frequent: np.ndarray):
        self.n, self.frequent, self.keys = n, np.sort(frequent), even_keys(n)

    def is_frequent(self, w: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(w), bool)
        return self.frequent[np.minimum(np.searchsorted(self.frequent, w), len(self.frequent) - 1)] == w

    def part(self, w: np.ndarray, u: np.ndarray) -> np.ndarray:
        key = mixed(w)
        often = self.is_frequent(w)
        key[often] = mixed(key[often] + mixed(u[often]))
        return self.keys[((key >> np.uint64(24)) % np.uint64(self.n)).astype(np.int64)]


def _dealt(docs: DataFrame, layout: Layout) -> DataFrame:
    """Rows (part, batch, blob): the events of a batch of texts, by part, and one heading for each batch."""
    shared = docs.sparkSession.sparkContext.broadcast(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay, hashes, number = shared.value, Hashes(), int(TaskContext.get().partitionId()) << 24
        zip_ = zstandard.ZstdCompressor(level=1).compress

        def sent(ids: list, arrays: list[np.ndarray], number: int) -> pa.RecordBatch:
            size = np.array([len(a) for a in arrays])
            w = np.concatenate(arrays)
            doc = np.repeat(np.arange(len(ids), dtype=np.uint16), size)
            before = np.empty_like(w)
            before[1:] = w[:-1]
            before[np.cumsum(size) - size] = START
            part = lay.part(w, before)
            order = np.lexsort((w, part))
            w, u, doc, part = w[order], before[order], doc[order], part[order]
            train = np.array([not held_out(i) for i in ids])
            flags = np.packbits(train).tobytes()
            out: tuple[list, list, list] = ([int(lay.keys[int(mixed(np.array([number], np.uint64))[0]) % lay.n])], [number], [b"H" + np.array([-1 if i is None else i for i in ids], "<i8").tobytes() + np.array([i is None for i in ids]).tobytes() + size.astype("<i8").tobytes() + train.tobytes()])
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            for a, b in zip(cuts, [*cuts[1:], len(w)], strict=True):
                new = np.flatnonzero(np.r_[True, w[a + 1 : b] != w[a : b - 1]])
                n = np.diff(np.r_[new, b - a]).astype("<u4")
                context, at = np.unique(u[a:b], return_inverse=True)
                head = np.array([len(ids), len(new), b - a, len(context)], "<u4").tobytes()
                raw = head + flags + w[a:b][new].tobytes() + n.tobytes() + context.tobytes() + at.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() + doc[a:b].tobytes()
                out[0].append(int(part[a]))
                out[1].append(number)
                out[2].append(b"E" + zip_(raw))
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["part", "batch", "blob"])

        ids, arrays, total = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                arrays.append(tokens(t.as_py(), hashes))
                total += len(arrays[-1])
                if total >= BATCH_TOKENS or len(ids) >= BATCH_TEXTS:
                    yield sent(ids, arrays, number)
                    ids, arrays, total, number = [], [], 0, number + 1
        if ids:
            yield sent(ids, arrays, number)

    return docs.mapInArrow(lean(run), "part int, batch long, blob binary").repartition(layout.n, "part")


class Part:
    """All events of a part: words, contexts, texts; and the training entries (word, context) with their customers."""

    def __init__(self, blobs: list[tuple[int, bytes]]):
        undo = zstandard.ZstdDecompressor().decompress
        words, contexts, w, u, doc, train, self.batches = [], [], [], [], [], [], []
        n_words = n_contexts = 0
        for number, blob in sorted(blobs):
            raw = undo(blob[1:])
            texts, distinct, n, some = (int(x) for x in np.frombuffer(raw, "<u4", 4))
            at = 16 + (texts + 7) // 8
            flags = np.unpackbits(np.frombuffer(raw, np.uint8, (texts + 7) // 8, 16))[:texts].astype(bool)
            words.append(np.frombuffer(raw, "<u8", distinct, at))
            count = np.frombuffer(raw, "<u4", distinct, at + 8 * distinct)
            at += 12 * distinct
            contexts.append(np.frombuffer(raw, "<u8", some, at))
            at += 8 * some
            which = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()
            own = np.frombuffer(raw, "<u2", n, at + 4 * n)
            self.batches.append((number, texts, n))
            w.append(np.repeat(np.arange(n_words, n_words + distinct, dtype=np.int32), count))
            u.append(which.astype(np.int32) + np.int32(n_contexts))
            doc.append(own)
            train.append(flags[own])
            n_words, n_contexts = n_words + distinct, n_contexts + some
        empty = np.zeros(0, np.int32)
        self.doc = np.concatenate([np.zeros(0, np.uint16), *doc])
        trained = np.concatenate([np.zeros(0, bool), *train])
        # of each batch the distinct ones: far fewer than events
        self.word, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_inverse=True)
        self.w = at.astype(np.int32)[np.concatenate([empty, *w])]
        self.context, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *contexts]), return_inverse=True)
        self.u = at.astype(np.int32)[np.concatenate([empty, *u])]
        del words, contexts, w, u, doc, train, at
        self.event = (self.w.astype(np.int64) << 32) | self.u
        self.key, self.c = np.unique(self.event[trained], return_counts=True)
        self.ew, self.eu = (self.key >> 32).astype(np.int32), (self.key & 0xFFFFFFFF).astype(np.int32)
        self.count = np.bincount(self.ew, weights=self.c, minlength=len(self.word)).astype(np.int64)

    def by_context(self, of_entries: np.ndarray) -> np.ndarray:
        return np.bincount(self.eu, weights=of_entries, minlength=len(self.context)).astype(np.int64)

    def by_word(self, of_entries: np.ndarray) -> np.ndarray:
        return np.bincount(self.ew, weights=of_entries, minlength=len(self.word)).astype(np.int64)


# --- random numbers that are hashes of what they are drawn for -------------------------------------------------


def uniform(h: np.ndarray) -> np.ndarray:
    return ((mixed(h) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def seeds(sweep: int, *keys: np.ndarray) -> np.ndarray:
    h = mixed(np.array([SEED * 1000 + sweep], np.uint64))
    for k in keys:
        h = mixed(h ^ k) * np.uint64(0x9E3779B97F4A7C15)
    return h


def gamma(shape: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Gamma variables (of shapes of 2 and more) out of hashes."""
    z = np.sqrt(-2 * np.log(uniform(h))) * np.cos(2 * np.pi * uniform(h ^ np.uint64(0x5851F42D4C957F2D)))
    return shape * (1 - 1 / (9 * shape) + z / (3 * np.sqrt(shape))) ** 3


def seat(c: np.ndarray, y: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Numbers of tables of dishes with c customers: t with weight S(c, t) * y**t, for any c.

    Neighbouring weights have the ratio 4 y (c - t) / ((2c - t - 1) t), which falls with t: weights rise to one peak and
    fall. Around it so many are added up that those left out are nothing in double precision.
    """
    t = np.minimum(c, 1).astype(np.int64)
    more = np.flatnonzero(c > 1)
    if not len(more):
        return t
    n, v = c[more].astype(float), y[more]
    b = 2 * n - 1 + 4 * v
    peak = np.clip(8 * v * n / (b + np.sqrt(np.maximum(b * b - 16 * v * n, 0))), 1, n)  # the smaller root of ratio = 1
    spread = np.sqrt(1 / np.maximum(1 / peak + 1 / (n - peak + 1) - 1 / (2 * n - peak), 1e-12))
    low = np.maximum(1, np.floor(peak - 12 * spread - 12))
    width = np.minimum(n, np.ceil(peak + 12 * spread + 12)) - low + 1
    level = np.ceil(np.log2(width)).astype(np.int64)
    draw = uniform(h[more])
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        size = 1 << int(k)
        for some in np.array_split(own, max(1, len(own) * size // 1_000_000)):
            at = low[some, None] + np.arange(size - 1)
            m, z = n[some, None], v[some, None]
            with np.errstate(divide="ignore"):
                ratio = np.log(np.where(at < m, 4 * z * (m - at) / np.maximum((2 * m - at - 1) * at, 1e-300), 0))
            weight = np.concatenate([np.zeros((len(some), 1)), np.cumsum(ratio, axis=1)], axis=1)
            weight = np.exp(weight - weight.max(1, keepdims=True)).cumsum(1)
            t[more[some]] = (low[some] + (weight < draw[some, None] * weight[:, -1:]).sum(1)).astype(np.int64)
    return t


# --- sums over parts --------------------------------------------------------------------------------------------


def _owner(keys: np.ndarray, n: int) -> np.ndarray:
    return ((mixed(keys) >> np.uint64(24)) % np.uint64(n)).astype(np.int64)


def packed(a: np.ndarray) -> bytes:
    """Whole numbers, their bytes by place: small ones cost about one byte."""
    a = np.ascontiguousarray(a, "<i8")
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def word_keys(words: np.ndarray) -> np.ndarray:
    """Keys of frequent words, apart from those of contexts."""
    return mixed(words ^ np.uint64(0xA0761D6478BD642F))


def root_draw(customers: np.ndarray, words: np.ndarray, sweep: int, tables_before: int, vocabulary: int) -> np.ndarray:
    """Tables of words in the root, given its tables after the sweep before."""
    x = gamma(np.array([STRENGTH / DISCOUNT + tables_before]), seeds(sweep))[0]
    return seat(customers, np.full(len(customers), DISCOUNT * x / (vocabulary + 1)), seeds(sweep, words, np.array([7], np.uint64)))


ASKED = pa.schema([("to", pa.int32()), ("kind", pa.string()), ("part", pa.int32()), ("keys", pa.binary()), ("a", pa.binary()), ("b", pa.binary()), ("few", pa.list_(pa.int64()))])
ANSWERS = pa.schema([("to", pa.int32()), ("kind", pa.string()), ("owner", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("few", pa.list_(pa.int64())), ("mine", pa.list_(pa.int64()))])
SCORED = pa.schema([("batch", pa.int64()), ("sums", pa.binary()), ("head", pa.binary())])
SQL_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {SQL_TYPES[f.type]}" for f in schema)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Asking:
    """The keys of a part, by the task that owns them: its contexts, and the frequent words it has a share of."""

    def __init__(self, part: Part, frequent: np.ndarray, owners: np.ndarray):
        at = np.minimum(np.searchsorted(frequent, part.word), max(0, len(frequent) - 1))
        self.mine = np.flatnonzero(frequent[at] == part.word) if len(frequent) else np.zeros(0, np.int64)
        self.rare = np.ones(len(part.word), bool)
        self.rare[self.mine] = False
        self.keys = np.concatenate([part.context, word_keys(part.word[self.mine])])
        owner = _owner(self.keys, len(owners))
        self.order = np.argsort(owner, kind="stable")
        self.cuts = np.searchsorted(owner[self.order], np.arange(len(owners) + 1))
        self.owners = owners.tolist()

    def rows(self, number: int, values: list[tuple[np.ndarray, np.ndarray]], few: list[int], with_keys: bool) -> list[tuple]:
        """A question to every owner: values of contexts and of frequent words, and the part's few numbers."""
        ordered = [np.concatenate(v)[self.order] for v in values]
        keys = self.keys[self.order]
        out = []
        for o, a, b in zip(self.owners, self.cuts, self.cuts[1:], strict=False):
            said = [packed(v[a:b]) for v in ordered] + [None] * (2 - len(ordered))
            out.append((o, "Q", number, keys[a:b].tobytes() if with_keys else None, *said, few))
        return out

    def sums(self, answers: list[dict]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(each value's sums in the order of keys, the numbers that all owners say alike, those added up over owners)."""
        answers = sorted(answers, key=lambda r: r["owner"])
        out = []
        for name in ("a", "b"):
            if answers[0][name] is not None:
                v = np.zeros(len(self.order), np.int64)
                v[self.order] = np.concatenate([unpacked(r[name]) for r in answers])
                out.append(v)
        return out, np.array(answers[0]["few"]), np.sum([r["mine"] for r in answers], axis=0)


def _answers(sweep: int, owner: int, first: pa.Table, now: pa.Table, frequent: np.ndarray) -> pa.Table:
    """The task of an owner: sums of what all parts say about its keys, and the root tables of its frequent words."""
    keyed = sorted((r for r in first.select(["kind", "part", "keys"]).to_pylist() if r["kind"] == "Q"), key=lambda r: r["part"])
    said = now.select(["kind", "part", "a", "b", "few"]).to_pylist()
    asked = sorted((r for r in said if r["kind"] == "Q"), key=lambda r: r["part"])
    out = [(r["part"], "S", owner, r["a"], None, None, None) for r in said if r["kind"] == "S"]
    if asked:
        sizes = [len(r["keys"]) // 8 for r in keyed]
        keys, at = np.unique(np.concatenate([np.frombuffer(r["keys"], "<u8") for r in keyed]), return_inverse=True)
        names = ["a"] if asked[0]["b"] is None else ["a", "b"]
        sums = [np.bincount(at, weights=np.concatenate([unpacked(r[i]) for r in asked]), minlength=len(keys)).astype(np.int64) for i in names]
        few = np.sum([r["few"][:4] for r in asked], axis=0).tolist()
        tables_before, vocabulary = asked[0]["few"][4:]
        own = frequent[np.isin(word_keys(frequent), keys)] if len(frequent) else frequent
        place = np.searchsorted(keys, word_keys(own))
        if sweep == 0:
            known = int((sums[0][place] > 0).sum())
            mine = [known, known]
        else:
            mine = [int(root_draw(sums[-1][place], own, sweep, tables_before, vocabulary).sum()), 0]
        start = 0
        for r, m in zip(asked, sizes, strict=True):
            told = [packed(v[at[start : start + m]]) for v in sums] + [None] * (2 - len(sums))
            out.append((r["part"], "A", owner, *told, few, mine))
            start += m
    give_back()
    return _arrow(out, ANSWERS)


class Sampler:
    """What a part does between two exchanges. State: numbers that all parts share, its own tables, the samples kept."""

    def __init__(self, layout: Layout):
        self.frequent, self.owners = layout.frequent, layout.keys

    def opened(self, events: pa.Table) -> tuple[Part | None, Asking | None, list[tuple[int, bytes]]]:
        rows = list(zip(events.column("batch").to_pylist(), events.column("blob").to_pylist(), strict=True))
        heads, blobs = [r for r in rows if r[1][:1] == b"H"], [r for r in rows if r[1][:1] == b"E"]
        part = Part(blobs) if blobs else None
        return part, part and Asking(part, self.frequent, self.owners), heads

    def first(self, number: int, events: pa.Table) -> pa.Table:
        """Every dish at one table: the state before the first sweep."""
        part, asking, _ = self.opened(events)
        if part is None:
            return _arrow([], ASKED)
        ones = np.ones(len(part.key), np.int64)
        entries = part.by_word(ones)
        v = int((part.count[asking.rare] > 0).sum())
        few = [len(part.key), v, int(part.c.sum()), v, 0, 0]
        out = asking.rows(number, [(part.by_context(part.c), part.count[asking.mine]), (part.by_context(ones), entries[asking.mine])], few, True)
        state = {"t": packed(ones), "t0": packed(np.minimum(part.count, 1)), "samples": []}
        return _arrow([*out, (number, "S", number, None, pickle.dumps(state), None, None)], ASKED)

    def taken(self, sweep: int, part: Part, asking: Asking, answers: list) -> dict:
        """The state after a sweep: its own tables and the sums over all parts."""
        state = pickle.loads(next(r["a"] for r in answers if r["kind"] == "S"))
        sums, few, mine = asking.sums([r for r in answers if r["kind"] == "A"])
        t, t0 = unpacked(state["t"]), unpacked(state["t0"]).copy()
        k = len(part.context)
        c0 = part.by_word(t)
        c0[asking.mine] = sums[-1][k:]
        if sweep == 0:
            state |= {"n": int(few[2]), "v": int(few[3] + mine[1]), "before": 0}
            state["count"] = packed(sums[0][k:])
            t0[asking.mine] = np.minimum(sums[0][k:], 1)
        else:
            t0[asking.mine] = root_draw(c0[asking.mine], part.word[asking.mine], sweep, state["before"], state["v"])
        state["now"] = {"t": t, "tables": sums[-1][:k], "c0": c0, "t0": t0, "C0": int(few[0]), "T0": int(few[1] + mine[0])}
        state["customers"] = sums[0][:k] if len(sums) > 1 else None
        return state

    @staticmethod
    def root(state: dict, now: dict) -> np.ndarray:
        """The root's predictive probability of each word."""
        base = (STRENGTH + DISCOUNT * now["T0"]) / (state["v"] + 1)
        return (now["c0"] - DISCOUNT * now["t0"] + base) / (STRENGTH + now["C0"])

    def sweep(self, number: int, own: int, events: pa.Table, answers: pa.Table) -> pa.Table:
        part, asking, _ = self.opened(events)
        if part is None:
            return _arrow([], ASKED)
        state = self.taken(number - 1, part, asking, answers.to_pylist())
        now = state.pop("now")
        state.pop("customers")
        if number - 1 > BURN_IN:
            state["samples"].append({k: packed(v) if isinstance(v, np.ndarray) else v for k, v in now.items()})
        p0 = self.root(state, now)
        x = gamma(STRENGTH / DISCOUNT + now["tables"], seeds(number, part.context))
        h = seeds(number, part.word[part.ew], part.context[part.eu])
        t = seat(part.c, DISCOUNT * x[part.eu] * p0[part.ew], h)
        c0 = part.by_word(t)
        alone = np.where(asking.rare, c0, 0)
        t0 = root_draw(alone, part.word, number, now["T0"], state["v"])
        few = [int(t.sum()), int(t0[asking.rare].sum()), 0, 0, now["T0"], state["v"]]
        values = [(part.by_context(t), c0[asking.mine])]
        if number == SWEEPS:  # the last answers also bring the customers, which no sweep needs
            values.insert(0, (part.by_context(part.c), part.count[asking.mine]))
        state |= {"t": packed(t), "t0": packed(t0), "before": now["T0"]}
        return _arrow([*asking.rows(own, values, few, False), (own, "S", own, None, pickle.dumps(state), None, None)], ASKED)

    def scores(self, events: pa.Table, answers: pa.Table) -> pa.Table:
        """(batch, the sums of its texts) for each batch of events, and (batch, heading)."""
        part, asking, heads = self.opened(events)
        out = [(batch, None, blob) for batch, blob in heads]
        if part is None:
            return _arrow(out, SCORED)
        state = self.taken(SWEEPS, part, asking, answers.to_pylist())
        samples = [{k: unpacked(v) if isinstance(v, bytes) else v for k, v in s.items()} for s in state["samples"]] + [state["now"]]
        count = part.count.copy()
        count[asking.mine] = unpacked(state["count"])
        entry = np.minimum(np.searchsorted(part.key, part.event), max(0, len(part.key) - 1))
        seen = part.key[entry] == part.event if len(part.key) else np.zeros(len(part.event), bool)
        below = STRENGTH + state["customers"][part.u]
        p = np.zeros(len(part.event))
        for s in samples:
            own = np.where(seen, part.c[entry] - DISCOUNT * s["t"][entry], 0) if len(part.key) else 0
            p += (own + (STRENGTH + DISCOUNT * s["tables"][part.u]) * self.root(state, s)[part.w]) / below
        whole = lambda logs: np.rint(logs / UNIT)
        values = (whole(np.log10(count + 1.0))[part.w], (count > 0).astype(float)[part.w], whole(np.log10(p / len(samples))))
        about = (state["n"], state["v"])
        start = 0
        for batch, texts, size in part.batches:
            own = part.doc[start : start + size]
            sums = [np.rint(np.bincount(own, weights=x[start : start + size], minlength=texts)).astype(np.int64) for x in values]
            out.append((batch, pickle.dumps(([packed(x) for x in sums], about)), None))
            start += size
        return _arrow(out, SCORED)


RESULT = pa.schema([("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _texts(rows: pa.Table, id_col: str) -> pa.Table:
    """The texts of a batch: its parts' sums added up."""
    head = next(x for x in rows.column("head").to_pylist() if x is not None)
    said = [pickle.loads(x) for x in rows.column("sums").to_pylist() if x is not None]
    n, v = said[0][1]
    logs, known, score = (np.sum([unpacked(sums[i]) for sums, _ in said], axis=0) for i in range(3))
    texts = (len(head) - 1) // 18
    ids, size = np.frombuffer(head, "<i8", texts, 1), np.frombuffer(head, "<i8", texts, 1 + 9 * texts)
    null, train = np.frombuffer(head, bool, texts, 1 + 8 * texts), np.frombuffer(head, bool, texts, 1 + 17 * texts)
    base = logs * UNIT - size * float(np.log10(n + v + 1))
    columns = [pa.array(ids, pa.int64(), mask=null), pa.array(~train), pa.array(size), pa.array(known), pa.array(np.full(texts, n)), pa.array(base), pa.array(score * UNIT)]
    return pa.table(columns, schema=pa.schema([(id_col, pa.int64()), *RESULT]))


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    slim = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    about = slim.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars")).first()
    n = max(LEAST_PARTS, -(-about["chars"] // PART_CHARS))
    hashes = Hashes()
    found = np.concatenate([np.array([END]), *(tokens(t, hashes) for t in few_texts(slim, id_col, text_col, about["rows"], SAMPLE_TEXTS, SAMPLE_CHARS))])
    words, counts = np.unique(found, return_counts=True)
    layout = Layout(n, words[counts > len(found) / (4 * n)])  # 4 * n words at most
    sampler, frequent = Sampler(layout), layout.frequent
    events = _dealt(slim, layout)

    def opening(key: tuple, rows: pa.Table) -> pa.Table:
        return sampler.first(key[0].as_py(), rows)

    def owning(sweep: int):
        return lambda key, first, now: _answers(sweep, key[0].as_py(), first, now, frequent)

    def sweeping(number: int):
        return lambda key, rows, answers: sampler.sweep(number, key[0].as_py(), rows, answers)

    def scoring(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return sampler.scores(rows, answers)

    def texts(rows: pa.Table) -> pa.Table:
        return _texts(rows, id_col)

    dealt = lambda df: df.repartition(n, "to")
    first = dealt(events.groupBy("part").applyInArrow(opening, _ddl(ASKED)))
    asked = first
    for number in range(SWEEPS + 1):
        if number:
            asked = dealt(events.groupBy("part").cogroup(answers.groupBy("to")).applyInArrow(sweeping(number), _ddl(ASKED)))
        answers = dealt(first.groupBy("to").cogroup(asked.groupBy("to")).applyInArrow(owning(number), _ddl(ANSWERS)))
    done = events.groupBy("part").cogroup(answers.groupBy("to")).applyInArrow(scoring, _ddl(SCORED))
    kinds = {pa.bool_(): "boolean", pa.float64(): "double", pa.int64(): "long"}
    schema = ", ".join([f"`{id_col}` long", *(f"{f.name} {kinds[f.type]}" for f in RESULT)])
    return done.repartition(n, "batch").groupBy("batch").applyInArrow(texts, schema)


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, tokens, base, model): perplexity per token of the texts learned from and of the others."""
    of = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), of("base_score").alias("base"), of("score").alias("model"))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_and_score(table(spark, sf_dir, "documents"))
