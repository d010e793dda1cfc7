"""Queries that SQL cannot express, against plain loops over the same rows."""

import difflib
import html
import re
from collections import Counter, defaultdict

import pytest

from tessella.functions import patterns
from tessella.operators import dedup, gold
from tessella.plans import catalog


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def run(spark, sf_dir, name):
    return catalog.QUERIES[name](spark, sf_dir).collect()


def sha(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def clean(text):
    lines = "\n".join(re.sub(r"[ \t\f\v ]+", " ", x).strip() for x in text.replace("\0", "").replace("\r\n", "\n").replace("\r", "\n").splitlines())
    return re.sub(r"\n{3,}", "\n\n", lines).strip()


def test_html_text(spark, sf_dir):
    pages = {r["page_id"]: r["html"] or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in run(spark, sf_dir, "html_text"):
        page = re.sub(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "\0", pages[r["page_id"]])
        nodes = [html.unescape(x).strip() for x in re.split(r"(?s)<[^>]*>|\0", page)]
        assert r["text"] == "\n".join(x for x in nodes if x)
        heads = [html.unescape(m[1]).strip() for tag in ("h1", "h2", "h3", "title") for m in [re.search(rf"(?is)<{tag}\b[^>]*>\s*([^<]+)", page)] if m]
        assert r["heading"] == (heads[0] if heads else "")


def test_sections(spark, sf_dir, texts):
    got = defaultdict(list)
    for r in run(spark, sf_dir, "sections"):
        got[r["doc_id"]].append((r["pos"], r["section"], r["sha"]))
    for i, text in texts.items():
        lines = text.splitlines()
        starts = [0, *(k for k, x in enumerate(lines) if re.match(r"#{1,6}\s+.", x))]
        want = []
        for a, b in zip(starts, [*starts[1:], len(lines)]):
            body = clean("\n".join(lines[a:b]))
            if body:
                head = re.match(r"#{1,6}\s+(.+)", lines[a])
                want.append((head[1].strip() if head else "", sha(body)))
        assert [(s, h) for _, s, h in sorted(got[i])] == want


def test_blocks_hold_the_whole_text(spark, sf_dir, texts):
    got, tables = defaultdict(list), Counter()
    for r in run(spark, sf_dir, "blocks"):
        got[r["doc_id"]].append(r)
        tables[r["doc_id"]] += r["block_type"] == "table"
    squeeze = lambda t: "".join(t.split())
    for i, text in texts.items():
        rows = sorted(got[i], key=lambda r: r["pos"])
        assert [r["pos"] for r in rows] == list(range(len(rows))) and squeeze("".join(r["text"] for r in rows)) == squeeze(text)
        path = []
        for r in rows:
            if r["block_type"] == "section_header":
                level = len(r["text"]) - len(r["text"].lstrip("#"))
                path = [*path[: level - 1], r["text"].lstrip("#").strip()]
            assert r["heading_path"] == " > ".join(path)
            assert r["block_type"] != "table" or min(x.count("|") for x in r["text"].splitlines()[:3] if x.strip()) >= 2
    assert {r["doc_id"]: r["tables"] for r in run(spark, sf_dir, "table_blocks")} == {i: n for i, n in tables.items() if n}


def test_ir_chunks_are_packed_in_order(spark, sf_dir, texts):
    by_doc, block_count = defaultdict(list), Counter(r["doc_id"] for r in run(spark, sf_dir, "blocks"))
    for r in run(spark, sf_dir, "ir_chunks"):
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == {i for i in texts if texts[i].strip()}
    for i, rows in by_doc.items():
        rows.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in rows] == list(range(len(rows))) and len({r["id"] for r in rows}) == len(rows)
        # no two neighbours would fit into one chunk, and blocks that a cut parts are named on both sides
        assert all(a["char_count"] + b["char_count"] > 4500 for a, b in zip(rows, rows[1:])) and max(r["char_count"] for r in rows) <= 5000 + 300
        assert block_count[i] <= sum(r["n_blocks"] for r in rows) <= block_count[i] + 2 * len(rows)


def pairs_of_bands(texts):
    buckets = defaultdict(list)
    for p, t in sorted(texts.items()):
        for k, h in enumerate(dedup.band_hashes(dedup.minhash(dedup.shingle_set(t)))):
            buckets[k, h].append(p)
    return {(a, b) for own in buckets.values() for n, b in enumerate(own) for a in own[:n]}


def test_lsh(spark, sf_dir, texts):
    want = {i: ",".join(map(str, dedup.band_hashes(dedup.minhash(dedup.shingle_set(t))))) for i, t in texts.items()}
    assert {r["pos"]: r["bands"] for r in run(spark, sf_dir, "minhash_bands")} == want
    assert {r["pos"]: (r["class"], r["links"]) for r in run(spark, sf_dir, "lsh_candidates")} == classes_of(texts, pairs_of_bands(texts))


def classes_of(texts, pairs):
    own, near = {p: p for p in texts}, defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    for p in sorted(texts):
        reached = [p] if own[p] == p else []
        while reached:
            for q in near[reached.pop()]:
                if own[q] == q and q > p:
                    own[q] = p
                    reached.append(q)
    return {p: (own[p], len(near[p])) for p in texts}


def test_buckets_of_many_blocks(spark, monkeypatch):
    """Large buckets are dealt into blocks: every pair still meets once, copies count, and nothing lists all pairs."""
    words = ["alpha beta gamma delta", "alpha beta gamma delto", "alpha beta gamma", "omega", ""]
    texts = {k: words[k % 5] + (" x" if k % 7 == 0 else "") for k in range(60)}
    df = spark.createDataFrame(list(texts.items()), "pos long, text string")
    monkeypatch.setattr(dedup, "BLOCK", 4)
    got = dedup.links(df, "pos", "text").collect()
    assert {r["pos"]: (r["class"], r["links"]) for r in got} == classes_of(texts, pairs_of_bands(texts)) and len(got) == 60
    few = {k: t for k, t in texts.items() if k < 20}
    want = {(a, b) for a, b in pairs_of_bands(few) if difflib.SequenceMatcher(None, few[a], few[b]).ratio() > 0.85}
    edges = [tuple(r) for r in dedup.verified(df.where("pos < 20"), "pos", "text").collect()]
    assert sorted(edges) == sorted(want)


def test_common_length():
    assert dedup.common_length("", "ab") == 0 and dedup.common_length("abcde", "xacxe") == 3 and dedup.common_length("a" * 200, "a" * 150) == 150


def test_near_dedup(spark, sf_dir):
    turns = {r["conv_id"] * 1000 + r["turn"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role = 'user'").collect()}
    first = {}
    for p in sorted(turns):
        first.setdefault(turns[p].lower().strip(), p)
    own = {p: turns[p] for p in first.values()}
    pairs, kept = pairs_of_bands(own), []
    for p in sorted(own):
        if not any((q, p) in pairs and difflib.SequenceMatcher(None, own[q].lower(), own[p].lower()).ratio() > 0.85 for q in kept):
            kept.append(p)
    assert sorted(r["pos"] for r in run(spark, sf_dir, "near_dedup")) == kept


def test_gold_select(spark, sf_dir):
    from pyspark.sql import functions as F

    from tessella.functions import text as T

    names = F.array(*map(F.lit, patterns.FINANCE_CATEGORIES))
    rows = catalog._candidates(spark, sf_dir).withColumns({"category": F.element_at(names, (F.col("conv_id") % len(patterns.FINANCE_CATEGORIES) + 1).cast("int")), "source": F.concat(F.lit("source"), (F.col("conv_id") % 7).cast("string"), F.lit(".md")), "question": T.near_duplicate_key(F.col("instruction"))}).collect()
    target = gold.TARGETS["finance"]
    chosen, questions, answers, categories, sources = {}, set(), Counter(), Counter(), Counter()
    for limited in (True, False, False):
        for r in sorted(rows, key=lambda r: (-r["score"], r["stable_key"])):
            answer = " ".join(r["response"].split()).casefold()
            if len(chosen) >= target or r["stable_key"] in chosen or r["question"] in questions or answers[answer] >= 2 or sources[r["source"]] >= 300 or (limited and categories[r["category"]] >= max(1, target // len(patterns.FINANCE_CATEGORIES))):
                continue
            chosen[r["stable_key"]] = r
            questions.add(r["question"])
            for counter, key in ((answers, answer), (categories, r["category"]), (sources, r["source"])):
                counter[key] += 1
    got = sorted(run(spark, sf_dir, "gold_select"), key=lambda r: r["gold_line"])
    assert [r["stable_key"] for r in got] == sorted(chosen) and [r["gold_line"] for r in got] == list(range(1, len(got) + 1)) and len(got) > 20


def test_train_capped(spark, sf_dir):
    from tessella.operators import build, rag

    docs, judged = catalog.built(spark, sf_dir)
    rows = build.training_rows(rag.documents(docs, judged), rag.chunks(judged), catalog.DOMAIN, cap=5).collect()
    seen, used, want = set(), Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r["document_id"], r["chunk_index"])):
        reason = r["reason"]
        if reason in (None, "duplicate", "title_cap"):
            reason = "duplicate" if r["content_key"] in seen else "title_cap" if used[r["title_key"]] >= 5 else "written"
            if reason == "written":
                seen.add(r["content_key"])
                used[r["title_key"]] += 1
        want[r["title_key"], reason] += 1
    assert {(r["title_key"], r["reason"]): r["n"] for r in run(spark, sf_dir, "train_capped")} == dict(want)
    assert any(reason == "title_cap" for _, reason in want)


def test_every_query_has_sql_or_a_loop():
    here = {"html_text", "sections", "blocks", "table_blocks", "ir_chunks", "minhash_bands", "lsh_candidates", "near_dedup", "gold_select", "train_capped"}
    assert set(catalog.QUERIES) - set(catalog.SQL) == here
