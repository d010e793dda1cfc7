"""Operators on small tables, branch by branch."""

import difflib
import random

from pyspark.sql import functions as F

from tessella.functions import json_repair, patterns
from tessella.functions import rules as R
from tessella.operators import dedup, qa, rag, scoring, training


def codes(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


def test_reason_codes(spark):
    i, r = F.col("i"), F.col("r")
    got = lambda i_, r_, given=None, domain="finance": codes(spark, R.cleaning_reasons(i, F.col("g"), r, F.col("d")), i=i_, r=r_, g=F.lit(given).cast("string") if given is None else given, d=domain)
    assert got("What is a bond?", "A bond is a debt security.") == []
    assert got("What is a bond?", "A bond.", "x") == ["synthetic_input"]
    assert got("", "") == ["empty_instruction", "empty_response", "answer_echoes_question", "off_domain"]
    assert got("What is the current price of a bond?", "Unknown") == ["explicit_nonanswer", "unanchored_time_sensitive"]
    assert got("According to the text, what is a bond?", "A `loan.") == ["missing_source_context", "unbalanced_backticks"]
    assert got("Define yield of bonds", "Who asked about horses?") == ["likely_mismatched_answer"]
    assert got("How does class inheritance work?", "It works.", domain="cyber") == []


def test_cleaner_remembers_kept_rows_only(spark):
    row = lambda q, a: '{"text": "### Instruction:\\n%s\\n\\n### Response:\\n%s"}' % (q, a)
    values = ["nonsense", '{"a": 1}', '{"text": 3}', '{"text": "x"}', row("What is tax?", "N/A"), row("What is tax?", "A levy."), row("what is TAX", "A levy.")]
    lines = spark.createDataFrame(list(enumerate(values, 1)), "line int, value string")
    got = {r["line"]: r["reasons"] for r in qa.template_reasons(lines, "value", "line", F.lit("finance")).collect()}
    assert got == {1: ["invalid_json", "invalid_schema", "invalid_template"], 2: ["invalid_schema", "invalid_template"], 3: ["non_string_text", "invalid_template"], 4: ["invalid_template"], 5: ["explicit_nonanswer"], 6: [], 7: ["duplicate_instruction"]}
    assert qa.retention(qa.template_reasons(lines, "value", "line", F.lit("finance"))).first()["kept"] == 1


def test_chunk_quality_branches(spark):
    good = "plain words in a row " * 20
    texts = {good: True, good[:199]: False, good.replace(" ", "\n"): False, good + "�" * 10: False, "12345 " * 60: False}
    for text, keep in texts.items():
        assert codes(spark, R.chunk_quality(F.col("t")), t=text)["keep"] == keep


def test_training_rejections(spark):
    body = "A sentence with different words number {} follows here now. "
    long = "".join(body.format(chr(97 + k % 26) * (k % 7 + 1)) for k in range(12))
    cases = {long: None, "short": "too_short", long + "�" * 9: "replacement_characters", long + ("." * 9 + " a ") * 4: "dot_leaders", long + "http://x " * 12: "url_list",
             long + " ISBN isbn": "publisher_front_matter", long + " Copyright" * 3: "copyright_noise", long + " important - read carefully": "license_front_matter",
             long.replace(".", "") + "x, 12-13 " * 12: "index_or_reference_list", "same word " * 60: "low_vocabulary_diversity"}
    for text, reason in cases.items():
        assert codes(spark, R.training_rejection(F.col("t")), t=text) == reason, text[-30:]


def test_greedy_near_duplicates(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (5, 6), (5, 7), (6, 7)], "i long, j long")
    assert sorted(r[0] for r in dedup.greedy_removed(edges).collect()) == [2, 4, 6, 7]  # 3 survives as 2 is removed
    r = random.Random(1)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    got = sorted(x[0] for x in dedup.near_dedup(df, "pos", "text").select("pos").collect())
    pairs = {(x[0], x[1]) for x in dedup.candidates(df, "pos", "text").collect()}
    kept = []
    for j, t in enumerate(texts):
        if t not in texts[:j] and not any((i, j) in pairs and difflib.SequenceMatcher(None, texts[i], t).ratio() > 0.85 for i in kept):
            kept.append(j)
    assert got == kept
    assert dedup.minhash(set()).tolist() == [0] * 64 and dedup.band_hashes(dedup.minhash({"abc"})) == dedup.band_hashes(dedup.minhash({"abc"}))


def test_caps_and_duplicates_couple(spark):
    rows = [(1, 0, "k1", "a"), (1, 1, "k2", "a"), (1, 2, "k3", "a"), (2, 0, "k3", "b"), (2, 1, "k1", "b"), (3, 0, "k3", "c")]
    df = spark.createDataFrame(rows, "document_id long, chunk_index long, content_key string, title_key string").withColumn("reason", F.lit(None).cast("string"))
    got = {(r["document_id"], r["chunk_index"]): r["reason"] for r in training.decided(df, 2).collect()}
    assert got == {(1, 0): None, (1, 1): None, (1, 2): "title_cap", (2, 0): None, (2, 1): "duplicate", (3, 0): "duplicate"}


def test_evenly_spaced(spark):
    for n, limit in ((5, 3), (7, 4), (10, 1), (3, 5), (12, 5), (1, 2)):
        df = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("p"))
        want = set(range(n)) if n <= limit else {n // 2} if limit == 1 else {round(q * (n - 1) / (limit - 1)) for q in range(limit)}
        assert {r[0] for r in training.evenly_spaced(df, "g", "p", limit).select("p").collect()} == want


def test_overlap_and_split(spark):
    shared = "abcd" + "".join(f"{k}," for k in range(50))[:116]
    df = spark.createDataFrame([(1, 0, "x" * 300 + shared), (1, 1, shared + " rest"), (1, 3, shared)], "document_id int, chunk_index int, text string")
    assert [(r["overlap_removed"], r["trimmed"][:4]) for r in training.trimmed(df).orderBy("chunk_index").collect()] == [(0, "xxxx"), (120, "rest"), (0, "abcd")]
    text = "w" * 200 + ". " + "v" * 400
    assert codes(spark, training.split_point(F.col("t")), t=text) == 202
    assert codes(spark, training.split_point(F.col("t")), t="v" * 360) is None


def test_selection_limits(spark):
    rows = [(f"k{i:03d}", 100 - i, "portfolio_risk" if i % 2 else "economics", f"question number {'abcdefghij'[i % 10]}{i}", "same answer" if i < 4 else f"answer {i}", None, None) for i in range(40)]
    df = spark.createDataFrame(rows, "stable_key string, score int, category string, instruction string, response string, source_file string, source_family string")
    got = qa.select_diverse(df, 16, patterns.FINANCE_CATEGORIES, False).collect()
    assert len(got) == 16 and [r["gold_line"] for r in sorted(got, key=lambda r: r["stable_key"])] == list(range(1, 17))
    assert sum(r["response"] == "same answer" for r in got) == 2


def test_parser_scores(spark):
    df = spark.createDataFrame([("Alpha beta", ["alpha"], ["gamma"], 5, [1, 2], [1], ["Table"], ["table"], "alpha beta")], "text string, required_phrases array<string>, forbidden_phrases array<string>, min_chars int, expected_pages array<int>, pages array<int>, block_types array<string>, expected_block_types array<string>, reference_text string")
    row = scoring.scored(df).first()
    assert row["score"] == round((1 + 1 + 1 + 1 + 0.5 + 1 + 1) / 7, 6) and row["components"]["page_recall"] == 0.5


def test_injected_model(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, t string")

    def client():
        def ask(text):
            if text == "b":
                raise RuntimeError("no")
            return '[{"question": "What is %s?", "answer": "A letter."}]' % text

        return ask

    got = qa.answered(df, F.col("t"), client).orderBy("i").collect()
    assert [r["reply"] is None for r in got] == [False, True]
    pairs = qa.emitted(qa.answered(df, F.col("t"), client), json_repair.parsed_pairs(F.col("reply"))).collect()
    assert [(r["i"], r["question"]) for r in pairs] == [(1, "What is a?")]


def test_json_replies():
    assert json_repair.read_pairs('prefix [{"question": "Q?", "answer": "A]"}] leftover ]') == [{"question": "Q?", "answer": "A]"}]
    assert json_repair.read_pairs("no") is None and json_repair.read_enrichment("no") is None
    assert json_repair.read_enrichment('```json\n{"input": "a", "output": "b \\S"}\n```')["output"] == "b \\S"
    assert json_repair.read_enrichment('{"input": "i", "output": "cut off here. And mo')["output"] == "cut off here"


def test_search_ranks_rare_terms(spark):
    df = spark.createDataFrame([("a", "common words here"), ("b", "common rarity here"), ("c", "common Rarité rarite")], "chunk_uid string, text string")
    assert [r["id"] for r in rag.bm25_search(df, "rarité common").collect()][0] == "c"
