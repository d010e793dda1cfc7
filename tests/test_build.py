"""From files to records, the document model, engines, curated sets and generation around a model that is made up."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessella.functions import document as D
from tessella.operators import build, generation, gold, qa, shared, training
from tessella.sources import engines, files, formats, sinks
from tessella.streaming import incremental

TOPIC = "portfolio market risk bond yield equity option hedge futures credit bank rate asset index fund capital".split()


def prose(seed, sentences=40):
    r = random.Random(seed)
    return " ".join(" ".join([f"The {r.choice(TOPIC)}", *(r.choice(TOPIC) + r.choice(["", "s", "ing"]) for _ in range(11))]).capitalize() + "." for _ in range(sentences))


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for domain in ("cyber", "finance"):
        (root / domain / "sub").mkdir(parents=True)
        (root / domain / "sub" / "a.md").write_text(f"# Part one\n\n{prose(1)}\n\n# Part two\n\n{prose(2)}")
        (root / domain / "b.txt").write_bytes((prose(3) + " café").encode("cp1252"))
        (root / domain / "copy.txt").write_bytes((prose(3) + " café").encode("cp1252"))
        (root / domain / "empty.txt").write_text("  \n ")
        (root / domain / "broken.pptx").write_bytes(b"no archive")
        (root / domain / "skipped.png").write_bytes(b"x")
    return root


def test_model_data(spark, corpus, tmp_path):
    sources = {d: str(corpus / d) for d in ("cyber", "finance")}
    report = build.model_data(spark, sources, str(tmp_path), max_chars=800, overlap=80)
    assert set(report["domains"]) == {"cyber", "finance"} and report["policies"]["generated_qa"] == "excluded"
    got = {r["relative_path"]: r for r in spark.read.parquet(str(tmp_path / "cyber" / "documents")).collect()}
    assert [got[k]["document_id"] for k in ("b.txt", "broken.pptx", "copy.txt", "empty.txt", "sub/a.md")] == [1, 2, 3, 4, 5]
    assert [got[k]["extraction_status"] for k in sorted(got)] == ["indexed", "failed", "duplicate", "no_native_text", "indexed"]
    assert got["copy.txt"]["duplicate_of_document_id"] == 1 and got["copy.txt"]["parser"] is None and json.loads(got["broken.pptx"]["diagnostics_json"])[0].startswith("BadZipFile")
    assert got["sub/a.md"]["category"] == "SUB" and got["b.txt"]["category"] == "CYBER" and got["sub/a.md"]["title"] == "a" and got["b.txt"]["parser"] == "plain-text"
    chunks = sorted(spark.read.parquet(str(tmp_path / "cyber" / "chunks")).collect(), key=lambda r: r["id"])
    assert [r["id"] for r in chunks] == list(range(1, len(chunks) + 1)) and {r["section"] for r in chunks} == {"", "Part one", "Part two"}
    # the same result by the definition, one file after another
    want, seen = [], set()
    for number, name in ((1, "b.txt"), (5, "sub/a.md")):
        at = 0
        for unit in formats.extract(name[name.rindex(".") :], (corpus / "cyber" / name).read_bytes())[0]:
            for piece in pytext_windows(unit["text"]):
                sha = sha256(" ".join(piece.split()).casefold())
                if len(piece) >= 200 and sha not in seen:
                    seen.add(sha)
                    uid = "sha256:" + sha256(f"cyber:{sha256((corpus / 'cyber' / name).read_bytes())}:{at}:{sha}")
                    want.append((number, at, uid, unit["section"], piece))
                    at += 1
    assert [(r["document_id"], r["chunk_index"], r["chunk_uid"], r["section"], r["text"]) for r in chunks] == want
    records = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "cyber" / "model_enrichment")).collect()]
    chats = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "cyber" / "messages")).collect()]
    told = report["domains"]["cyber"]
    assert len(records) == len(chats) == told["training"]["records"] == told["chat"]["records"] > 5 and set(records[0]) == set(build.RECORD)
    assert {c["metadata"]["chunk_uid"] for c in chats} == {r["chunk_uid"] for r in records} and chats[0]["metadata"]["task"] == build.TASK
    assert told["rag"]["stats"]["chunks_indexed"] == len(chunks) and sum(told["rag"]["category_counts"].values()) == len(chunks)
    assert sum(told["training"]["rejections"].values()) + len(records) == len([r for r in chunks if r["quality_score"] >= 0.8])


def sha256(x):
    import hashlib

    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def pytext_windows(text):
    from tessella.functions.windows import chunk_windows

    return chunk_windows(text, 800, 80)


def test_document_cap_is_reported(spark, corpus, tmp_path):
    report = build.model_data(spark, {"finance": str(corpus / "finance")}, str(tmp_path), "finance", max_chars=800, overlap=80, cap=2)
    told = report["domains"]["finance"]["training"]
    assert told["rejections"]["document_cap"] > 0 and told["largest_source_records"] <= 2


def test_limits():
    assert build.check_limits() == ("cyber", "finance") and build.check_limits("cyber") == ("cyber",)
    for wrong in ({"domain": "x"}, {"max_chars": 100}, {"overlap": 3200}, {"min_quality": 2}, {"min_chars": 10}, {"min_words": 1}, {"cap": 0}):
        with pytest.raises(ValueError):
            build.check_limits(**wrong)
    assert [build.cleaned_name(x) for x in ("a.jsonl", "a.json", "a")] == ["a_cleaned.jsonl"] * 3
    assert build.first_folder(["x", "y"], lambda p: p == "y") == "y" and build.first_folder(["x", "y"], lambda p: False) == "x"
    assert build.qa_paths("data/source/", "data/export", "data/source", "data/export", "data/results") == ("data/export", "data/results")


def test_training_lines_and_domains(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"text": "x"}\n\n{broken\n')
    with pytest.raises(ValueError, match=":3: invalid JSON"):
        build.read_training_lines(spark, str(tmp_path / "bad.jsonl"))
    meta = spark.createDataFrame([("domain", "cyber")], "key string, value string")
    assert files.stored_domain(meta) == "cyber"
    with pytest.raises(ValueError):
        files.stored_domain(meta, "finance")


def test_numbers_are_dense_and_in_order(spark):
    df = spark.createDataFrame([(f"k{i * 7919 % 1000:04d}",) for i in range(1000)], "k string").repartition(5)
    got = sorted((r["k"], r["n"]) for r in shared.numbered(df, [F.col("k")], "n", 1).collect())
    assert [n for _, n in got] == list(range(1, 1001)) and shared.numbered(df.limit(0), [F.col("k")], "n").count() == 0


def test_caps_couple_like_one_by_one(spark):
    """title_cap and duplicate as a loop over the rows in order would give them."""
    r = random.Random(5)
    rows = [(f"c{r.randrange(60)}", f"t{min(r.randrange(6), r.randrange(6))}", d, i) for d in range(40) for i in range(6)]
    for cap in (3, 8, 100):
        want, seen, used = {}, set(), {}
        for content, title, d, i in rows:
            if content in seen:
                want[d, i] = "duplicate"
            elif used.get(title, 0) >= cap:
                want[d, i] = "title_cap"
            else:
                want[d, i] = None
                seen.add(content)
                used[title] = used.get(title, 0) + 1
        df = spark.createDataFrame(rows, "content_key string, title_key string, document_id int, chunk_index int").repartition(3)
        assert {(x["document_id"], x["chunk_index"]): x["reason"] for x in training.decided(df, cap).collect()} == want


# --- documents and engines ----------------------------------------------------------------------------------------


def test_pages_with_ocr():
    def ocr(i):
        if i == 3:
            raise RuntimeError("no")
        return "" if i == 2 else f"# Seen {i}\n\nby OCR"

    doc = D.paged_document("/x/a.pdf", "ff", "application/pdf", lambda: ["long " * 20, "short", "", ""], ocr)
    assert [(b["page"], b["extraction_method"]) for b in doc["blocks"]] == [(1, "native"), (2, "ocr"), (2, "ocr")] and doc["blocks"][1]["id"] == "sha256:ff/page/2/block/0"
    assert [(d["code"], d["page"]) for d in doc["diagnostics"]] == [("empty_page", 3), ("page_ocr_failed", 4)]
    assert doc["metadata"] == {"page_count": 4, "structured": False, "ocr_pages": 2, "extraction_methods": ["native", "ocr"]}
    assert D.paged_document("a.pdf", "ff", "x", lambda: ["", ""], lambda i: "t", most_ocr=1)["metadata"]["ocr_pages"] == 1

    def broken():
        raise OSError("damaged")

    damaged = D.paged_document("a.pdf", "ff", "x", broken, whole_ocr=lambda: "whole")
    assert damaged["diagnostics"][0]["code"] == "pdf_open_failed" and D.document_text(damaged) == "whole"
    assert D.whole_text(lambda: ["x" * 200, ""], lambda: "ocr") == "x" * 200 and D.whole_text(lambda: ["x", ""], lambda: "ocr") == "ocr" == D.whole_text(broken, lambda: "ocr")
    again = D.structured_document("a.pdf", "ff", "x", lambda: "", lambda: D.text_document("a.pdf", "ff", "x", "body"))
    assert again["diagnostics"][0]["code"] == "structured_parse_failed"
    assert D.structured_document("a.pdf", "ff", "x", lambda: "# H\n\nb", None)["metadata"]["structured"] is True
    assert json.loads(D.document_json(doc))["schema_version"] == 1


def test_documents_of_files(spark, corpus, tmp_path):
    found = build.parsed(files.scan(spark, str(corpus / "cyber"))).cache()
    rows = {r["source_id"]: r for r in found.collect()}
    assert rows["broken.pptx"]["status"] == "failed" and "BadZipFile" in rows["broken.pptx"]["error"] and rows["skipped.png"]["status"] == "failed"
    doc = json.loads(rows["sub/a.md"]["value"])
    assert doc["id"] == "sha256:" + sha256((corpus / "cyber" / "sub" / "a.md").read_bytes()) and doc["media_type"] == "text/markdown" and len({b["id"] for b in doc["blocks"]}) == len(doc["blocks"]) == rows["sub/a.md"]["block_count"]
    assert rows["sub/a.md"]["extraction_methods"] == ["plain-text"] and rows["sub/a.md"]["document"]["blocks"][0]["block_type"] == "section_header"
    lines = build.chunk_lines(found)
    sinks.write_json_lines(lines.where("source_id = 'sub/a.md'").drop("source_id", "pos"), str(tmp_path / "a.md.chunks.jsonl"))
    again = files.chunk_records(spark, str(tmp_path / "a.md.chunks.jsonl")).collect()
    assert len(again) == rows["sub/a.md"]["chunk_count"] and again[0]["source_path"] == "sub/a.md"
    report = sinks.run_report(found.drop("value", "document", "chunks"), {}, 0.0)
    assert report["summary"]["success"] == 4 and report["summary"]["failed"] == 2 and report["summary"]["total_chunks"] == sum(r["chunk_count"] for r in rows.values() if r["status"] == "success")
    layout = build.parsed(files.scan(spark, str(corpus / "cyber")), lambda path, suffix, sha, raw: engines.parsed_document(path, sha, "x", lambda: build.native_document(path, suffix, sha, raw), None, "auto"))
    assert {r["source_id"]: r["diagnostic_count"] for r in layout.where("status = 'success'").collect()} == {"b.txt": 0, "copy.txt": 0, "empty.txt": 0, "sub/a.md": 0}


def test_html_to_markdown():
    html = "<h2>Head</h2><p>Some <b>bold</b> and <a href='u'>link</a>.</p><ul><li>one</li><li>two</li></ul><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table><pre>x  y</pre><script>no</script>"
    assert D.html_to_markdown(html) == "## Head\n\nSome **bold** and [link](u).\n\n* one\n* two\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n```\nx  y\n```"
    assert D.html_to_markdown(None) == "" and D.heading_level("<H3 class=x>") == 3 and D.heading_level("<p>") is None


def test_layout_blocks():
    items = [
        {"id": "/page/0/S/0", "block_type": "SectionHeader", "html": "<h1>One</h1>", "page": 0, "bbox": [0, 1, 2, 3]},
        {"id": "/page/0/T/1", "block_type": "Text", "html": "<p>body</p>", "page": 0},
        {"id": "/page/1/S/2", "block_type": "SectionHeader", "html": "<h2>Two</h2>", "page": 1},
        {"id": "/page/1/L/3", "block_type": "ListGroup", "html": "<ul><li>x</li></ul>", "page": 1},
        {"id": "/page/1/T/4", "block_type": "Text", "html": "<p>named</p>", "page": 1, "section_hierarchy": {"2": "/page/1/S/2", "1": "/page/0/S/0", "3": "/gone"}},
        {"id": "/page/1/T/5", "block_type": "Text", "html": "", "page": 1},
    ]
    doc = D.layout_document("a.pdf", "ff", "application/pdf", {"blocks": items, "metadata": {"k": 1}}, "fast")
    assert [b["heading_path"] for b in doc["blocks"]] == [["One"], ["One"], ["One", "Two"], ["One", "Two"], ["One", "Two"]]
    assert [b["block_type"] for b in doc["blocks"]] == ["section_header", "text", "section_header", "list_group", "text"] and doc["blocks"][0]["page"] == 1 and doc["blocks"][0]["bbox"] == [0.0, 1.0, 2.0, 3.0]
    assert doc["blocks"][1]["id"] == "sha256:ff/marker/page/0/T/1" and doc["metadata"]["extraction_methods"] == ["marker-fast"]


def test_choice_of_parser():
    native = lambda: D.text_document("a.pdf", "ff", "x", "native text")
    layout = lambda path, settings: {"blocks": [{"id": "/1", "block_type": "Text", "html": f"<p>{settings['use_llm']}</p>"}]}

    def broken(path, settings):
        raise RuntimeError("no model")

    pick = lambda path, f, parser: engines.parsed_document(path, "ff", "x", native, f, parser)
    assert pick("a.pdf", layout, "native")["metadata"]["parser"] == "native" and D.document_text(pick("a.pdf", layout, "auto")) == "False"
    failed = pick("a.pdf", broken, "auto")
    assert failed["metadata"]["parser"] == "native-fallback" and failed["diagnostics"][0]["code"] == "marker_fallback"
    assert pick("a.pdf", None, "auto")["diagnostics"][0]["code"] == "marker_unavailable" and not pick("a.txt", None, "auto")["diagnostics"]
    for path, parser in (("a.txt", "marker"), ("a.pdf", "other")):
        with pytest.raises(ValueError):
            pick(path, layout, parser)
    with pytest.raises(ValueError):
        engines.layout_settings("slow")


def test_engines(tmp_path):
    made = []
    make = lambda *s: made.append(s) or s
    assert engines.engine(make, "cpu", "en") is engines.engine(make, "cpu", "en") and engines.engine(make, "gpu", "en") and len(made) == 2
    assert engines.Settings().ocr(dpi=10, max_pages=-1).as_dict()["ocr_dpi"] == 72 and engines.Settings().speech(model="tiny").whisper_model == "tiny"
    fails = lambda image: 1 / 0
    assert engines.read_image(b"", fails, lambda i: "other") == "other" and engines.read_image(b"", lambda i: " ", None) == ""
    assert engines.ocr_pages(b"", lambda raw, i, dpi: str((i, dpi)).encode(), bytes.decode, engines.Settings(ocr_max_pages=2), 5) == "(0, 200)\n(1, 200)"
    assert engines.joined_lines([" a ", "", "b"]) == "a\nb" and engines.duration_text(3671) == "01:01:11" and engines.duration_text(0) == "unknown"
    heard = engines.speech_decoder(lambda path, s: {"segments": [" hi ", "you"], "language": "en", "probability": 0.97, "seconds": 61}, engines.Settings(), ".mp3")(b"x")
    assert heard[0]["text"] == "<!-- Transcription: file.mp3 | Language: en (97%) | Duration: 01:01 | Model: whisper-base -->\n\nhi you"
    silent = engines.speech_decoder(None, engines.Settings(), ".mp4", True, lambda video, track: open(track, "wb").close())
    assert silent(b"x") == []
    shell = tmp_path / "tool"
    shell.write_text("#!/bin/sh\ncat \"$1\"\n")
    shell.chmod(0o755)
    registry = formats.with_decoder((".doc",), engines.legacy_doc((str(shell),)))
    assert formats.extract_document(".doc", "old", b"old text", registry)["units"] == [{"text": "old text", "page": None, "section": "", "method": "antiword"}]
    unpack = tmp_path / "unpack"
    unpack.write_text("#!/bin/sh\nd=${2#-o}\necho '<p>two</p>' > $d/b.html\necho '<p>one</p>' > $d/a.htm\n")
    unpack.chmod(0o755)
    assert engines.help_archive((str(unpack),))(b"x")[0]["text"] == "# a.htm\n\none\n\n# b.html\n\ntwo"
    assert engines.workbook(lambda raw: [("S", [["a", None], [1, 2.5]])])(b"")[0]["text"].split() == ["Sheet:", "S", "a", "1", "2.5"]
    comic = formats.images_in_archive(lambda b: b.decode(), lambda raw: {"b.png": lambda: b"two", "a.jpg": lambda: b"one", "x.txt": lambda: b"no"})
    assert [u["text"] for u in comic(b"")] == ["one", "two"]


def test_pdf_boilerplate():
    pages = [f"Book Title\nfact number {i}\nPAGE  footer" for i in range(5)]
    got = engines.pdf_units(b"", "stem", lambda raw: ("", [*pages, RuntimeError("torn")]))
    assert [u["text"] for u in got["units"]] == [f"fact number {i}" for i in range(5)] and got["title"] == "stem" and got["diagnostics"] == ["page_6: torn"] and got["page_count"] == 6
    whole = formats.extract_document(".pdf", "stem", b"", {".pdf": lambda raw: engines.pdf_units(raw, "stem", lambda r: ("Named", ["text"]))})
    assert whole["title"] == "Named" and whole["parser"] == "pdf-native"


# --- sources ------------------------------------------------------------------------------------------------------


def test_lines_are_numbered_by_file(spark, tmp_path):
    for name, n in (("a.jsonl", 5000), ("b.jsonl", 3)):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" if i % 3 else "\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = files.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5003 and all(r["value"] in ("", f"{r['source_id'][-7:]} {r['line']}") for r in got) and {r["line"] for r in got} == set(range(1, 5001))


def test_benchmark_manifest(spark, tmp_path):
    def cases(text):
        (tmp_path / "m.jsonl").write_text(text)
        return files.benchmark_cases(spark, str(tmp_path / "m.jsonl"), "/base").collect()

    got = cases('# comment\n\n{"path": "a.txt", "required_phrases": ["x"], "expected_block_types": ["Table"], "min_chars": 5}\n{"id": "two", "path": "/b.txt", "reference_text": "r.txt"}\n')
    assert [(r["id"], r["path"], r["reference_text"]) for r in got] == [("case-3", "/base/a.txt", None), ("two", "/b.txt", "/base/r.txt")] and got[0]["expected_block_types"] == ["table"] and got[0]["min_chars"] == 5
    for text, message in (("{bad", "invalid JSON"), ("{}", "missing"), ('{"path": "a", "min_chars": -1}', "non-negative"), ("# none", "no benchmark"), ('{"id": "a", "path": "x"}\n{"id": "a", "path": "y"}', "repeated")):
        with pytest.raises(ValueError, match=message):
            cases(text)
    assert files.parser_list("native, auto,native") == ["native", "auto"]
    with pytest.raises(ValueError):
        files.parser_list("other")


def test_input_formats(spark, tmp_path):
    assert files.input_format(["b.md", "a.chunks.jsonl"]) == ("chunks", ["a.chunks.jsonl"]) and files.input_format(["b.md", "a.md"]) == ("summaries", ["a.md", "b.md"])
    assert files.input_format(["b.md", "a.chunks.jsonl"], "summaries")[1] == ["b.md"]
    (tmp_path / "s.md").write_text("﻿one\n\ntwo")
    assert [r["text"] for r in files.summary_records(spark, str(tmp_path), 5).collect()] == ["one", "two"]


def test_sqlite_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, text string")
    sinks.export_sqlite({"chunks": df}, str(tmp_path / "t.sqlite"), None)
    assert sorted(map(tuple, files.sqlite_table(spark, str(tmp_path / "t.sqlite"), "chunks", "id long, text string").collect())) == [(1, "x"), (2, None)]


# --- curated sets -------------------------------------------------------------------------------------------------


def test_gold_set(spark, tmp_path):
    text = "A bond yield moves against its price because the fixed coupon becomes more or less attractive when market interest rates change over time for investors"
    sources = spark.createDataFrame([("investments", "/s/investments.pdf", "aa", text)], "stem string, source_path string, source_sha256 string, text string")
    good = ("Why does a bond yield move against its price?", text + ".")
    rows = spark.createDataFrame([(1, *good, "investments.md", 4), (2, *good, "blog.md", 1), (3, *good, "Macroéconomie.md", 1), (4, "What is it?", "Nothing at all.", "investments.md", 2)], "line long, question string, answer string, source_file string, chunk_index int")
    candidates, rejected = gold.finance_candidates(rows, sources)
    reasons = {(r["line"], r["reason"]) for r in rejected.collect()}
    assert (2, "source_outside_trusted_core") in reasons and (3, "source_file_missing") in reasons and any(x == 4 for x, _ in reasons)
    found = candidates.collect()
    assert [r["original_line"] for r in found] == [1] and found[0]["support_level"] == 3 and found[0]["support_coverage"] == 1.0
    chosen = qa.select_diverse(candidates, gold.TARGETS["finance"], {"a": "x", "b": "y"}, False)
    report = gold.write_set("finance", chosen, candidates, rejected, str(tmp_path))
    assert report["selected"] == 1 and report["top_sources"] == [["investments.md", 1]] and json.loads((tmp_path / "finance_gold.report.json").read_text()) == report
    where = json.loads(spark.read.text(str(tmp_path / "finance_gold.provenance")).first()["value"])
    assert where["source_status"] == "verified_local_document" and where["source_chunk_index"] == 4 and where["gold_line"] == 1


def test_top_sources(spark):
    df = spark.createDataFrame([(i, f"s{i % 30}" if i < 90 else "s7") for i in range(1, 100)], "gold_line int, source_file string")
    got = [tuple(r) for r in gold.top_sources(df).collect()]
    assert got[0] == ("s7", 13) and len(got) == 25 and [s for s, _ in got[1:4]] == ["s1", "s2", "s3"]


# --- generation ---------------------------------------------------------------------------------------------------


def test_patience():
    waits, calls = [], []

    def flaky(messages):
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "ok"

    assert generation.Patient(flaky, sleep=waits.append)([]) == "ok" and waits == [5, 10]

    def refused(messages):
        calls.append(1)
        raise generation.PermanentError("bad request", 400)

    calls.clear()
    with pytest.raises(generation.PermanentError):
        generation.Patient(refused, sleep=waits.append)([])
    assert len(calls) == 1
    limited = generation.PermanentError("slow down", 429)
    assert not generation.is_permanent(limited)
    with pytest.raises(ValueError):
        generation.Patient(lambda m: " ", sleep=lambda s: None)([])
    assert generation.generation_settings("vllm", "http://h/api/", 0.5)["endpoint"] == "http://h"
    for wrong in (("x", "h", 0.0), ("vllm", "h", 3.0)):
        with pytest.raises(ValueError):
            generation.generation_settings(*wrong)


def answers():
    def reply(messages):
        text = messages[-1]["content"]
        if "fail" in text:
            raise RuntimeError("down")
        if "Question:" in text:
            return '{"input": "given", "output": {"summary": "made"}}' if "odd" not in text else "no json"
        return 'Sure:\n[{"question": "Q one?", "answer": "A"}, {"question": "Q two?", "answer": "B"}]' if "fruitful" in text else "nothing"

    return reply


def test_generated_pairs(spark):
    chunks = spark.createDataFrame([("a", "fruitful text"), ("b", "fail"), ("c", "neither")], "source_id string, text string")
    good, lost = generation.generated_pairs(chunks, "text", answers)
    assert sorted((r["source_id"], r["question"]) for r in good.collect()) == [("a", "Q one?"), ("a", "Q two?")]
    letters = {r["source_id"]: r["message"] for r in lost.collect()}
    assert set(letters) == {"b", "c"} and letters["b"].startswith("RuntimeError") and "parse" in letters["c"]


def test_enrichment_resumes(spark, tmp_path):
    meta = "_meta struct<enriched:boolean,model:string,domain:string>"
    rows = spark.createDataFrame([(i, f"question {i}" + (" odd" if i % 2 else ""), "", f"answer {i}", None) for i in range(10)], f"idx long, instruction string, input string, output string, {meta}")
    out, lost = generation.enriched(rows, answers, "m", "finance", 1.0)
    got = {r["idx"]: r for r in out.collect()}
    assert len(got) == 10 and all((got[i]["input"] == "given") == (i % 2 == 0) for i in got) and json.loads(got[0]["output"]) == {"summary": "made"} and got[0]["_meta"]["domain"] == "finance" and lost.count() == 5
    again, _ = generation.enriched(rows, answers, "m", "finance", 0.5, earlier=out)
    assert sum(bool(r["_meta"] and r["_meta"]["enriched"]) for r in again.collect()) == 5
    assert generation.restored(rows.limit(3), out).where("_meta.enriched").count() == 0
    generation.log_errors(lost, str(tmp_path / "errors"))
    assert spark.read.parquet(str(tmp_path / "errors")).count() == 5


def test_summaries(spark):
    chunks = spark.createDataFrame([("a", "pair text"), ("b", " "), ("c", "fail")], "source_id string, text string")
    got = {r["source_id"]: r for r in generation.summarised(chunks, "text", lambda: lambda m: "# Facts\n\nbody" if "fail" not in m[-1]["content"] else 1 / 0, 7).collect()}
    assert got["a"]["summary"] == "# Facts\n\nbody" and got["a"]["error"] is None and got["b"]["error"] == "no text to summarise" and got["c"]["error"].startswith("ZeroDivision")


def test_batches_resume(spark, tmp_path):
    done = []

    def work(df):
        done.append(1)
        if len(done) == 3:
            raise RuntimeError("interrupted")
        return df.withColumn("made", F.lit(1))

    rows = spark.range(100)
    with pytest.raises(RuntimeError):
        incremental.in_batches(rows, "id", 4, work, str(tmp_path / "o"))
    assert incremental.in_batches(rows, "id", 4, work, str(tmp_path / "o")).count() == 100 and len(done) == 5
    assert incremental.nothing_to_do(rows.limit(0), ["x"], lambda p: True) and not incremental.nothing_to_do(rows, ["x"], lambda p: True)


def test_run_report_and_cleaning(spark, tmp_path):
    results = spark.createDataFrame([("a", "success", 10, 2, None), ("b", "failed", 7, 1, "x"), ("c", "skipped", None, None, None)], "source_id string, status string, char_count int, chunk_count int, error string")
    report = sinks.run_report(results, {"k": 1}, 1.5)
    assert report["summary"] == {"document_count": 3, "success": 1, "skipped": 1, "failed": 1, "total_characters": 10, "total_chunks": 2} and report["documents"][1]["error"] == "x"
    values = spark.createDataFrame([(1, "kept line"), (2, "bad")], "line int, value string")
    rows = spark.createDataFrame([(1, "i", []), (2, "", ["invalid_json"])], "line int, instruction string, reasons array<string>")
    sinks.write_cleaned(rows, values, str(tmp_path), "set", {"kept": 1})
    assert [r["value"] for r in spark.read.text(str(tmp_path / "set.clean.jsonl")).collect()] == ["kept line"] and json.loads(spark.read.text(str(tmp_path / "set.rejected.jsonl")).first()["value"])["reasons"] == ["invalid_json"]
