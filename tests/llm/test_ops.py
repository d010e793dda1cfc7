"""Every operator against brute force, held-out accuracy or an exact round trip, and on hostile tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import langid, mixing, neardup, packing, pii, quality, registry, scoring, search, suffixes, toxicity
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string, _text string"
LONG = " ".join(f"w{i % 3000}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))


@pytest.fixture(scope="module")
def hostile(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    near = [f"n{i}" for i in range(100)]
    texts = [None, "", " \t\n", LONG, LONG, f"start {PASSAGE} end", f"other {PASSAGE} tail words", " ".join(near), " ".join([*near[:98], "zz", "yy"]), "a" * 50_000, "ein kleiner Text", "über ß €uro 日本",
             "mail me@x.com_b@y.org now 1.2.3.4.5.6.7.8 or 4111 1111 1111 1111 call +49 (170) 123-4567", "line\nline\nline\nthe same words again the same words again the same words again", "ein kleiner Text"]
    rows = [(None if i == 9 else i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 3}", 0, 0.5, "r", "t") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], rows[9], rows[0]], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows_of(spark, sf_dir, name):
    return registry.QUERIES[name](spark, sf_dir).collect()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def check_lm(got, docs):
    want = sorted(brute.lm_base(docs), key=repr)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=repr)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-6) for x, y in zip(got, want))


def test_lm(spark, sf_dir, docs, hostile, empty):
    got = rows_of(spark, sf_dir, "op1_lm_score")
    check_lm(got, pairs_of(docs))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    found = scoring.fit_and_score(hostile).collect()
    check_lm(found, pairs_of(hostile))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert scoring.fit_and_score(empty).count() == 0


def lm_draws(kind, sweep, word, context, shape):
    """The operator's random numbers, one at a time."""
    h = lambda x, end: np.array([end if x in ("<s>", "</s>") else scoring.Hashes()[x.encode()]], np.uint64)
    w, u = (h(x, end) if x is not None else None for x, end in ((word, scoring.END), (context, scoring.START)))
    if kind == "gamma":
        return float(scoring.gamma(np.array([shape]), scoring.seeds(sweep, u) if u is not None else scoring.seeds(sweep))[0])
    return float(scoring.uniform(scoring.seeds(sweep, w, u if kind == "seat" else np.array([7], np.uint64)))[0])


def test_lm_against_one_customer_after_another(spark):
    """The whole sampler in plain Python; in every kept state the probabilities of a context add up to one."""
    r = np.random.default_rng(6)
    names = [f"w{k}" for k in range(30)]
    docs = [(i, " ".join(names[min(29, int(k))] for k in r.geometric(0.2, r.integers(0, 30)))) for i in range(70)] + [(None, "w1 w1 w1"), (3, None), (9, "Never W2")]
    want, sums = brute.lm_scores(docs, lm_draws, scoring.BURN_IN, scoring.SAMPLES)
    assert len(sums) > 5 and all(math.isclose(x, 1, rel_tol=1e-9) for x in sums)
    df = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string").repartition(3)
    found = sorted(((r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in scoring.fit_and_score(df).collect()), key=repr)
    assert found == sorted(((i, len(brute.words(t)) + 1, round(x, 6)) for (i, t), x in zip(docs, want)), key=repr)


def test_lm_seats():
    """Draws of few and of many customers follow the weights S(c, t) y^t."""
    h = np.arange(40_000, dtype=np.uint64) * np.uint64(77)
    for c, y in ((2, 0.3), (7, 2.0), (60, 0.05), (60, 40.0), (200, 5.0)):
        logs = [math.log(s) + t * math.log(y) if s > 0 else -math.inf for t, s in enumerate(brute.stirling(c), 1)]
        weights = np.exp(np.array(logs) - max(logs))
        mean = float((weights * np.arange(1, c + 1)).sum() / weights.sum())
        t = scoring.seat(np.full(len(h), c), np.full(len(h), y), h)
        assert t.min() >= 1 and t.max() <= c and abs(t.mean() - mean) < 0.03 * mean
    big = scoring.seat(np.full(200, 10**9), np.full(200, 0.4), h[:200])
    assert (big >= 1).all() and big.mean() < 50
    x = scoring.gamma(np.full(len(h), 3.5), h)
    assert abs(x.mean() - 3.5) < 0.05 and abs(x.var() - 3.5) < 0.15


def test_lm_does_not_depend_on_partitions(spark, docs):
    found = []
    for n in (4, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            found.append(sorted((r["doc_id"], r["score"]) for r in scoring.fit_and_score(docs.repartition(n)).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_lm_frequent_words_are_split_without_a_trace(spark, monkeypatch):
    """A word that is a third of all tokens is dealt by its contexts too; the scores are those of whole words."""
    rows = [(i, " ".join(f"hot c{(i * k) % 50}" for k in range(1, 30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    split = sorted((r["doc_id"], r["score"]) for r in scoring.fit_and_score(df).collect())
    monkeypatch.setattr(scoring, "SAMPLE_TEXTS", 0)  # nothing is found to be frequent
    assert sorted((r["doc_id"], r["score"]) for r in scoring.fit_and_score(df).collect()) == split


def test_lm_perplexity(spark, sf_dir):
    got = {r["held_out"]: r for r in scoring.perplexity(scoring.op1_lm_score(spark, sf_dir)).collect()}
    assert got[True]["model"] < 0.6 * got[True]["base"] and got[False]["model"] < got[True]["model"]


def test_lm_contexts_are_not_merged(spark):
    """Two words whose hashes share their upper 20 bits open two restaurants."""
    names, seen = [f"c{i}" for i in range(8000)], {}
    for name, h in zip(names, scoring.mixed(scoring.Hashes().of([x.encode() for x in names])) >> np.uint64(44)):
        if h in seen:
            break
        seen[h] = name
    a, b = seen[h], name
    train = [i for i in range(1000) if not scoring.held_out(i)][:400]
    test = [i for i in range(1000) if scoring.held_out(i)][:2]
    rows = [(i, f"{a} xx" if k % 2 else f"{b} yy") for k, i in enumerate(train)]
    df = spark.createDataFrame([*rows, (test[0], f"{a} xx"), (test[1], f"{a} yy")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in scoring.fit_and_score(df).collect()}
    assert score[test[0]] - score[test[1]] > 1


def test_even_keys(spark):
    from tessella.llm.common import even_keys

    for n in (1, 7, 51, 200):
        keys = even_keys(n)
        df = spark.createDataFrame([(int(k),) for k in keys], "k int").repartition(n, "k").withColumn("p", F.spark_partition_id())
        assert len(keys) == n == len({r["p"] for r in df.collect()}) and (np.diff(keys) > 0).all()


def test_top_k(spark, sf_dir):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = defaultdict(list)
    for r in sorted(rows_of(spark, sf_dir, "op2_topk"), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got == brute.top_k(vectors)


def test_top_k_hostile(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [-3.0, 0.1]), (None, [1.0, 1.0]), (6, [1.0, 2.0]), (7, []), (50, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"query_id": F.lit("clash"), "score": F.lit(1), "rank": F.lit(2), "_id": F.lit(3), "_vec": F.lit("x")})
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in search.top_k(df, F.col("vec_id") % 50 == 0, k=3, block=1).collect())
    assert got == [(0, 1, 50), (0, 2, 1), (0, 3, 6), (50, 1, 0), (50, 2, 1), (50, 3, 6)]
    assert search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_toxicity(spark, sf_dir):
    toxic = ["idiot", "clown", "trash", "moron"]
    rows = [(i, f"some plain words number{i % 17} and {toxic[i % 4] if i % 3 == 0 else 'calm'} again {'x y ' * (i % 9)}", "en", int(i % 3 == 0)) for i in range(400)]
    model = toxicity.fit_rows([r[1] for r in rows[:300]], np.array([r[3] for r in rows[:300]], float), ["en"] * 300)
    df = spark.createDataFrame(rows[300:], "doc_id long, text string, lang string, y int").withColumn("score", F.lit("clash"))
    got = toxicity.flag(toxicity.classify(df, model), model, "lang").collect()
    assert sum((r["score"] >= 0.3) == bool(r["y"]) for r in got) >= 95
    found = rows_of(spark, sf_dir, "op3_toxicity")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (brute.crc(r["doc_id"]) % 4 == 2) for r in found)


def test_convolution_word_by_word():
    """Scores against the network written as loops over words, parts, filters and widths."""
    r = np.random.default_rng(9)
    words = ["idiot", "calm", "über", "x", "number77", "trash", "wonderful"]
    texts = [" ".join(r.choice(words, r.integers(0, 12))) for _ in range(120)]
    y = np.array(["idiot" in t or "trash" in t for t in texts], float)
    m = toxicity.fit_rows(texts, y, ["en"] * len(texts))
    known = m.lookup()
    for text, got in zip(texts, m.score([known.rows(t) for t in texts])):
        vectors = [sum(m.e[row] for row in np.frombuffer(known[w.encode()], "<i4")) for w in text.lower().split()]
        top = []
        for width, w, b in zip(toxicity.WIDTHS, m.w, m.b):
            for f in range(toxicity.FILTERS):
                sums = [sum(float(vectors[i + j] @ w[j, :, f]) for j in range(width)) + float(b[f]) for i in range(len(vectors) - width + 1)]
                top.append(max([0.0, *sums]))
        z = m.scale * (sum(a * float(v) for a, v in zip(top, m.v)) + float(m.c)) + m.shift
        assert math.isclose(got, 1 / (1 + math.exp(-max(-30, min(30, z)))), abs_tol=1e-4)
    cut = np.array([s >= toxicity.LIMIT for s in m.score([known.rows(t) for t in texts])])
    assert (cut == y).mean() > 0.95


def test_labels_are_sampled_by_label(spark, empty):
    """An id labelled twice or standing in two rows is learned each time; null ids and other labels are not."""
    docs = spark.createDataFrame([(i, f"text {i} {'idiot' if i % 2 else 'calm'}", "en") for i in range(40)] + [(1, "second row idiot", "en"), (None, "no id", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (None, 1), (3, 7), (5, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, model).collect() if r["doc_id"] is not None}
    assert sum((got[i] >= toxicity.LIMIT) == bool(i % 2) for i in range(40)) >= 38
    assert toxicity.learn(empty, labels).scale == 0.0 and toxicity.learn(docs, labels.limit(0)).scale == 0.0


def test_toxicity_hostile(spark, hostile, empty):
    for labels in ([], [1.0, 1.0], [0.0]):
        model = toxicity.fit_rows(["a b"] * len(labels), np.array(labels), ["en"] * len(labels))
        assert all(0 <= r["score"] <= 1 for r in toxicity.classify(hostile, model).collect()) and toxicity.classify(empty, model).count() == 0


def test_substrings(spark, sf_dir, docs, hostile, empty):
    tuples = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert tuples(rows_of(spark, sf_dir, "op4_substrings")) == tuples(brute.substrings(pairs_of(docs)))
    assert tuples(suffixes.deduplicate(hostile).collect()) == tuples(brute.substrings(pairs_of(hostile)))
    assert suffixes.deduplicate(empty).count() == 0


def test_substrings_of_hot_ids(spark):
    """One id, or no id, for a third of all rows: several ranges of one class, which do not remove from each other."""
    r = np.random.default_rng(2)
    passages = [" ".join(f"p{k}w{i}" for i in range(20)) for k in range(12)]
    text = lambda i: f"start{i} {passages[r.integers(12)]} middle{i} {passages[r.integers(12)]} end{i}"
    rows = [(7, text(i)) for i in range(80)] + [(None, text(i)) for i in range(80)] + [(int(r.integers(100)), text(i)) for i in range(60)] + [(50, None), (51, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    n, bounds, several, without, total = suffixes.plan(df, "doc_id", "text")
    assert several.get(7.0, 0) > 1 and without > 1 and total == len(rows) and total == len(rows)
    tuples = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert tuples(suffixes.deduplicate(df).collect()) == tuples(brute.substrings(rows))


def test_labels_sort_like_their_path():
    r = np.random.default_rng(1)
    h = r.integers(0, 3, 5000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for window in (2, 5, 8, 13, 20):
        high, low = suffixes.labels(h, window)
        windows = [tuple(h[i : i + window]) for i in range(len(h) - window + 1)]
        pairs = list(zip(high.tolist(), low.tolist()))
        assert len(pairs) == len(windows) and len(set(pairs)) == len(set(windows)) == len(set(zip(pairs, windows)))
        order = np.lexsort((low, high))
        a, b = suffixes._unpack(suffixes._pack(high[order], low[order]))
        assert (a == high[order]).all() and (b == low[order]).all()
        assert suffixes._among(high, low, a[::2], b[::2]).sum() >= len(a) // 2


def check_mix(rows, docs):
    size = brute.mix(docs)
    taken = Counter()
    for (source, text), r in zip(docs, rows):
        assert r["size"] == len(brute.words(text)) and 0 <= r["taken"] <= 2 * r["size"] and (r["source_size"], round(r["target"], 6)) == (size[source][0], round(size[source][1], 6))
        taken[source] += r["taken"]
    assert all(abs(taken[s] - t) <= 1 for s, (_, t) in size.items())


def test_mix(spark, sf_dir, docs, hostile, empty):
    for df in (docs, hostile):
        rows = mixing.schedule(df.drop("size")).collect()
        texts = defaultdict(list)
        for r in df.collect():
            texts[r["doc_id"], r["source"]].append(r["text"])
        ordered = [(r["source"], max(texts[r["doc_id"], r["source"]], key=lambda t: len(brute.words(t)) == r["size"])) for r in rows]
        check_mix(rows, ordered)
        assert sorted(map(str, rows)) == sorted(map(str, mixing.schedule(df.repartition(5)).collect()))
    assert mixing.mix_documents(hostile).columns == hostile.columns and mixing.mix_documents(empty).count() == 0


def test_mix_like_a_queue(spark):
    """taken, against serving all copies word by word in the order of virtual finish times until the budget is used up."""
    r = np.random.default_rng(3)
    rows = [(int(i) if i % 9 else None, " ".join(["x"] * int(r.integers(0, 9))) + f" t{i % 40}", [None, "a", "b", "c"][min(3, int(r.geometric(0.4)) - 1)]) for i in range(120)] * 2 + [(7, None, "a"), (8, "", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("target", F.lit(0)).withColumn("taken", F.lit(0)).withColumn("weight", F.lit(9)).withColumn("_key", F.lit(1))
    got = mixing.schedule(df).collect()
    sizes = brute.mix([(s, t) for _, t, s in rows])
    budget = round(sum(t for _, t in sizes.values()))
    words = sorted((x["start_time"] + (k * x["source_size"] + w + 1) / x["weight"], n) for n, x in enumerate(got) for k in range(mixing.CAP) for w in range(x["size"]))
    served = Counter(n for _, n in words[:budget])
    assert len(got) == len(rows) and abs(sum(x["taken"] for x in got) - budget) <= len(sizes)
    assert sum(abs(served[n] - x["taken"]) for n, x in enumerate(got)) <= 2 * len(sizes)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    texts = Counter()
    for x in mixed.collect():
        texts[x["source"]] += len(brute.words(x["text"]))
    assert all(abs(texts[s] - t) <= 10 for s, (_, t) in sizes.items())
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix_documents(df.repartition(7)).collect()))


def test_pii(spark, sf_dir, docs, hostile, empty):
    for df in (docs, hostile):
        columns = pii.base_spans(F.coalesce("text", F.lit("")))
        for r in df.select("text", *[c.alias(k) for k, c in columns.items()]).collect():
            want = brute.pii_base(r["text"])[1]
            assert [f"{x['kind']}:{x['start']}:{x['end']}" for k in pii.KINDS for x in r[k]] == want
    text = dict(pairs_of(docs))
    for r in rows_of(spark, sf_dir, "op6_pii"):
        *want, spans = brute.pii_row(text[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == want
        found = [x.split(":") for x in r["spans"].split(",") if x]
        assert found == sorted(found, key=lambda x: (pii.ALL_KINDS.index(x[0]), int(x[1]))) and r["n_spans"] == len(found)
        assert {*spans} <= {":".join(x) for x in found} and all(text[r["doc_id"]][int(a) : int(b)] for _, a, b in found)
    clean = {r["doc_id"]: r for r in pii.redact(hostile.withColumn("_base", F.lit("kept")), "text", "n_chars").collect()}
    assert clean[12]["text"] == "mail [EMAIL]_b@y.org now [IP].[IP] or [CARD] call [PHONE]".replace("[EMAIL]_b@y.org", "[EMAIL][EMAIL]") and clean[12]["_base"] == "kept" and clean[0]["text"] is None
    assert pii.redact(empty).count() == 0


def test_long_secrets_go_as_a_whole(spark):
    r = np.random.default_rng(3)
    long = "".join("abcdef"[r.integers(6)] + str(r.integers(10)) for _ in range(300))
    df = spark.createDataFrame([(0, f"token: {long} end")], "doc_id long, text string")
    assert long[-40:] not in pii.redact(df).collect()[0]["text"]


def test_base_spans_of_made_up_texts(spark):
    """Zero octets, leading zeros, long runs and many spans, and the secrets that the keyword before them gives away."""
    r = np.random.default_rng(8)
    octet = lambda: ["0", "00", "000255", "256", "10", "192", "1", "255", "0000000000000000000000"][r.integers(9)]
    some = lambda: [".".join(octet() for _ in range(r.integers(3, 10))), f"u{r.integers(99)}.@x-{r.integers(9)}.de.", "".join(str(r.integers(10)) for _ in range(r.integers(8, 22))), f"+{r.integers(1, 99)} ({r.integers(999)}) {r.integers(10**7)}", "@", "+1", "x"][r.integers(7)]
    texts = [["", " ", "\n"][k % 3].join(some() for _ in range(40)) for k in range(120)]
    texts += [" ".join(f"10.0.{i % 256}.{i // 256}" for i in range(3000)), "7" * 30_000, "10.0.0.1", "a.b-" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = pii.base_spans(F.coalesce("text", F.lit("")))
    for row in df.select("text", *[c.alias(k) for k, c in columns.items()]).collect():
        assert [f"{x['kind']}:{x['start']}:{x['end']}" for k in pii.KINDS for x in row[k]] == brute.pii_base(row["text"])[1]
    key = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5P6q7R8s9T0u1"
    forms = [f"api_key={key} x", f"api_key: {key} x", f"token: {key * 8} x", f"token: {''.join(map(chr, 97 + r.integers(26, size=70)))}1bbbbefghijklmnopqr x", f'secret="{key}" x']
    for row in pii.redact(spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")).collect():
        assert "[SECRET]" in row["text"] and key[:12] not in row["text"] and "bbbb" not in row["text"]


def brute_redacted(text, spans):
    out, at = "", 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_redaction_replaces_the_spans(spark, docs):
    many = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6, " ".join(f"user{i}@x.com token={i}a1B2c3D4e5F6g7H8i9J0k1 10.0.0.{i % 256}" for i in range(500)))], "doc_id long, text string"))
    spans = {r["doc_id"]: [(x["start"], x["end"], x["kind"]) for k in pii.KINDS for x in r["_base"][k]] + [(x["start"], x["end"], x["kind"]) for x in r["_extra"]] for r in pii.detect(many).collect()}
    text = dict(pairs_of(many))
    assert len(spans[10**6]) >= 1500
    assert {r["doc_id"]: r["text"] for r in pii.redact(many).collect()} == {i: t and brute_redacted(t, spans[i]) for i, t in text.items()}


def test_pii_trees_agree_with_their_columns(spark):
    trees, _ = pii.fitted()
    x, y = pii.generated_sample(240, 99)
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], [*pii.FEATURES])
    got = [r[0] for r in df.select(trees.column(F.struct(*pii.FEATURES))).collect()]
    assert np.allclose(got, trees.score(x)) and ((trees.score(x) >= 0.5) == y).mean() > 0.9


def check_packing(got, texts, encode):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for i, text in texts.items():
        ids = [*encode(text or ""), 1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    real = pad = 0
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        real, pad = real + at, pad + (2048 - at if at & (at - 1) else 0)
    return pad / max(1, real)


def test_packing(spark, sf_dir, docs, hostile, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    assert check_packing(rows_of(spark, sf_dir, "op7_packing"), dict(pairs_of(docs)), encode) < 0.01
    distinct = hostile.dropDuplicates(["doc_id"]).union(spark.createDataFrame([(99, "a <|endoftext|> b  c", None, None, 0, 0.0, "", "")], DOCS))
    check_packing(packing.pack(distinct).collect(), dict(pairs_of(distinct)), encode)
    rows = packing.pack(hostile, with_ids=True).collect()  # repeated rows and rows without id are packed each
    assert sum(r["length"] for r in rows) == sum(len(encode(t or "")) + 1 for _, t in pairs_of(hostile))
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows) and all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack(empty).count() == 0


def test_loss_limit_of_instruction_data(spark):
    """Answers alone bear loss; their limit binds in every full sequence, and every token lies in one piece."""
    rows = [(i, "Explain the thing. " * (i % 7), "It is so. " * (i % 40) if i % 9 else None) for i in range(300)] + [(300, "", "long answer " * 3000), (301, "long prompt " * 3000, "yes")]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, reply string").repartition(2)
    got = packing.pack(df, text_col="prompt", answer_col="reply", loss=600, with_ids=True).collect()
    from tokenizers import Tokenizer

    encode = lambda t: Tokenizer.from_file(packing.tokenizer_path()).encode(t or "", add_special_tokens=False).ids
    tokens = {i: (encode(p), [*encode(a), 1]) for i, p, a in rows}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
        free = len(tokens[r["doc_id"]][0])
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], free))
    for i, (prompt, answer) in tokens.items():
        assert [x for r in sorted(pieces[i], key=lambda r: r["start"]) for x in r["ids"]] == prompt + answer
    loss = [sum(r["loss_tokens"] for r in own) for own in bins.values()]
    assert max(loss) == 600 and all(sum(r["length"] for r in own) <= 2048 for own in bins.values())


def test_packer_limits():
    packer = packing.Packer(length=64, segments=3, loss=40, waiting=8, cut=False)
    r = np.random.default_rng(1)
    out = [p for i in range(200) for p in packer.add(int(r.integers(1, 40)), int(r.integers(0, 2)) * 10, i)] + list(packer.finish())
    assert sorted(p[0] for p in out) == list(range(200))
    for b in {p[3] for p in out}:
        own = [p for p in out if p[3] == b]
        assert sum(p[2] for p in own) <= 64 and len(own) <= 3


def test_near_duplicates(spark, sf_dir, docs, hostile, empty):
    for df in (docs, hostile):
        rows, _ = neardup.classes(df)
        got = Counter((r["_id"], r["class"]) for r in rows.collect())
        texts = pairs_of(df)
        assert got == Counter((i, c) for (i, _), c in zip(texts, brute.near_classes(texts)))
    kept = neardup.keep_one(hostile)
    assert kept.columns == hostile.columns and Counter(r["doc_id"] for r in kept.collect())[5] == 1
    assert neardup.keep_one(empty).count() == 0 and neardup.classes(empty)[0].count() == 0


def test_chains_of_near_copies(spark):
    """Many versions, each near its neighbours only, are one class; just below the threshold is none."""
    base = [f"t{i}" for i in range(104)]
    chain = [" ".join([*(f"v{k}" for k in range(4 * s)), *base[4 * s :]]) for s in range(12)]
    apart = [" ".join(["far", *base[: k * 20], f"q{k}", *base[k * 20 :]]) for k in range(2)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*chain, *apart])], "doc_id long, text string")
    rows, _ = neardup.classes(df)
    texts = pairs_of(df)
    assert {r["_id"]: r["class"] for r in rows.collect()} == {i: c for (i, _), c in zip(texts, brute.near_classes(texts))}


def test_near_copies_that_repeat_a_passage(spark):
    """By even weights they are near: how often a copy repeats a passage does not hide it."""
    texts = []
    for k in range(12):
        base = [f"p{k}x{i}" for i in range(200)]
        texts += [" ".join(base), " ".join(base + [f"q{k}x{i}" for i in range(30)] * 20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: c for i, c in enumerate(brute.near_classes(list(enumerate(texts))))}
    assert set(want.values()) == set(range(0, 24, 2))
    assert {r["_id"]: r["class"] for r in neardup.classes(df)[0].collect()} == want


def test_probability_jaccard():
    """The verified similarity against its definition, and registers agree as often as it says."""
    r = np.random.default_rng(4)
    for _ in range(30):
        x, y = (Counter({int(k): int(n) for k, n in zip(r.choice(40, 25, replace=False), r.integers(1, 6, 25))}) for _ in range(2))
        sets = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], np.int64)) for c in (x, y)]
        assert math.isclose(neardup.similarity(*sets), brute.similar(x, y))
    hashed = [(h[np.argsort(h)], n[np.argsort(h)]) for h, n in ((neardup.mixed(h), n) for h, n in sets)]
    own, even = neardup._signed(hashed, 20_000)
    assert abs((own[0] == own[1]).mean() - brute.probability_jaccard(x, y)) < 0.02
    assert abs((even[0] == even[1]).mean() - len(x.keys() & y.keys()) / len(x.keys() | y.keys())) < 0.02


def test_weights_link_as_well(spark):
    """Texts that agree in what they repeat are near by their weights, though their sets differ."""
    texts = []
    for k in range(10):
        passage = " ".join(f"r{k}x{i}" for i in range(30))
        texts += [" ".join([passage] * 20 + [f"{side}{k}x{i}" for i in range(30)]) for side in "ab"]
    want = dict(enumerate(brute.near_classes(list(enumerate(texts)))))
    assert set(want.values()) == set(range(0, 20, 2))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["_id"]: r["class"] for r in neardup.classes(df)[0].collect()} == want


def test_keep_one_keeps_texts_apart_that_share_an_id(spark):
    a, c = " ".join(f"a{i}" for i in range(60)), " ".join(f"c{i}" for i in range(60))
    rows = [(5, a, "x"), (5, c, "y"), (3, c + " tail", "z"), (None, a + " more", "n"), (None, "alone without id", "n"), (None, "alone without id", "m"), (8, "", "e"), (8, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = sorted(((r["doc_id"], r["text"], r["source"]) for r in neardup.keep_one(df).collect()), key=repr)
    assert kept == sorted([(5, a, "x"), (3, c + " tail", "z"), (None, "alone without id", "m"), (8, "", "e"), (8, "", "e")], key=repr)


def test_quality(spark, sf_dir, docs, hostile, empty):
    for df in (docs, hostile):
        got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.judge(df).collect())
        assert got == Counter((i, *brute.quality(t)) for i, t in pairs_of(df))
    assert quality.judge(empty).count() == 0
    bad = spark.createDataFrame([(i, "few words" if i % 10 else " ".join(f"w{k}" for k in range(20)), "bad" if i < 50 else "good") for i in range(50)] + [(100 + i, " ".join(f"w{k}x{i}" for k in range(20)), "good") for i in range(50)], "doc_id long, text string, source string")
    assert {r["doc_id"] for r in quality.judge(bad).where("kept").collect()} == {100 + i for i in range(50)}


def test_language_filters_gram_by_gram():
    """Counts and verdicts against sets of slots and loops over characters."""
    r = np.random.default_rng(5)
    words = {"aa": ["house", "garden", "street", "ünder"], "bb": ["maison", "jardin", "rue", "sous"], "cc": ["casa", "jardín", "calle", "bajo"]}
    sample = {k: [" ".join(r.choice(v, 30)) for _ in range(20)] for k, v in words.items()}
    model = langid.LanguageFilters.fit(sample)

    def grams(text):
        text = "".join(c if c.isalpha() else " " for c in text.lower())
        for i in range(len(text) - 3):
            if text[i + 1] != " " and text[i + 2] != " ":
                h = ord(text[i])
                for c in text[i + 1 : i + 4]:
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ ord(c)
                h ^= h >> 15
                h = h * 0x2C1B3C6D & 0xFFFFFFFF
                yield h ^ h >> 12

    shift = 32 - (langid.SLOTS.bit_length() - 1)
    at = lambda h: [(h * k & 0xFFFFFFFF) >> shift for k in langid.HASHES]
    inside = {}
    for k, found in sample.items():
        counts = Counter(h for t in found for h in grams(t))
        inside[k] = {x for h, n in counts.items() if n >= max(1, langid.MIN_SHARE * sum(counts.values())) for x in at(h)}
    rate = {k: (len(v) / langid.SLOTS) ** len(langid.HASHES) for k, v in inside.items()}
    texts = [" ".join(r.choice([*words["aa"], *words["bb"], *words["cc"], "1234"], r.integers(0, 20))) for _ in range(80)] + ["house garden", "", "12 34"]
    langs, scores, _ = model.predict(texts)
    for text, lang, score in zip(texts, langs, scores):
        named, n = Counter(), 0
        for h in grams(text):
            n += 1
            own = [k for k in inside if all(x in inside[k] for x in at(h))]
            if len(own) < len(inside):
                named.update(own)
        true = {k: max(0.0, (named[k] - rate[k] * n) / (1 - rate[k])) for k in inside}
        if not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        assert true[lang] == pytest.approx(max(true.values())) and score == pytest.approx(max(true.values()) / sum(true.values()) if sum(true.values()) else 1 / 3)


def test_language(spark, sf_dir, docs, hostile, empty):
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows_of(spark, sf_dir, "op10_langid") if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    model = langid.learn(docs, "text", "lang", "doc_id", F.lit(True))
    found = langid.identify(hostile, model).collect()
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in found) and langid.identify(empty, model).count() == 0
    none = langid.learn(empty, "text", "lang", "doc_id", F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(hostile, none).collect()} == {"und"}
