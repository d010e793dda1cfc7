"""Files in, files out, and incremental runs."""

import io
import json
import os
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from tessella.sources import files, formats, sinks
from tessella.streaming import incremental


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/"), text)
    return out.getvalue()


def test_decoding():
    assert [formats.decode(x) for x in ("﻿é".encode(), "café".encode("cp1252"), b"\x81")] == ["é", "café", "\x81"]


def test_formats():
    text, heading = formats.html_parts("<html><title>T</title><style>no</style><script>no</script><h2>H</h2><p>a &amp; b</p></html>")
    assert text == "T\nH\na & b" and heading == "H"
    slide = '<p xmlns:a="x"><a:t>{}</a:t></p>'
    deck = zipped(**{"ppt/slides/slide2.xml": slide.format("two"), "ppt/slides/slide10.xml": slide.format("ten")})
    assert [u["text"] for u in formats.extract(".pptx", deck)[0]] == ["ten", "two"]
    doc = zipped(**{"word/document.xml": '<w:document xmlns:w="x"><w:body><w:p><w:t>Hi</w:t></w:p><w:tbl><w:tr><w:tc><w:t>a</w:t></w:tc><w:tc><w:t>b</w:t></w:tc></w:tr></w:tbl></w:body></w:document>'})
    assert formats.extract(".docx", doc)[0][0]["text"] == "Hi\n\na | b"
    book = zipped(**{"META-INF/container.xml": '<c><rootfile full-path="o/p.opf"/></c>', "o/p.opf": '<p><item id="1" href="b.html"/><item id="2" href="a.html"/><itemref idref="1"/><itemref idref="2"/></p>', "o/a.html": "<h1>A</h1>", "o/b.html": "<p>B</p>"})
    assert [(u["text"], u["section"]) for u in formats.extract(".epub", book)[0]] == [("B", ""), ("A", "A")]
    sheet = zipped(**{"xl/workbook.xml": '<w><sheet name="S"/></w>', "xl/sharedStrings.xml": "<s><si><t>x</t></si></s>", "xl/worksheets/sheet1.xml": '<w><row><c t="s"><v>0</v></c><c><v>2</v></c></row></w>'})
    assert formats.extract(".xlsx", sheet)[0][0]["text"] == "Sheet: S\nx 2"
    assert formats.extract(".docx", b"broken")[1].startswith("BadZipFile") and formats.extract(".zzz", b"")[1] == "unsupported: .zzz"


def test_injected_decoders():
    def broken(raw):
        raise RuntimeError("no engine")

    registry = formats.with_decoder((".png",), broken, lambda raw: [{"text": "seen", "page": None, "section": ""}])
    assert formats.extract(".png", b"", registry)[0][0]["text"] == "seen"
    pages = formats.pages_decoder(lambda raw: ["x" * 60, "short"], lambda raw, i: f"ocr {i}")
    assert [u["text"] for u in pages(b"")] == ["x" * 60, "ocr 1"]


def test_scan_and_decode(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.md").write_text("# T\nbody")
    (tmp_path / "b.TXT").write_bytes("café".encode("cp1252"))
    (tmp_path / "c.bin").write_bytes(b"x")
    got = {r["source_id"]: r for r in files.decoded(files.scan(spark, str(tmp_path))).collect()}
    assert set(got) == {"one/a.md", "b.TXT"} and got["b.TXT"]["units"][0]["text"] == "café" and got["one/a.md"]["units"][0]["section"] == "T"
    assert {tuple(r) for r in files.stem_index(files.scan(spark, str(tmp_path))).collect()} == {("a", "one/a.md"), ("b", "b.TXT")}


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('﻿{"question":"ok","answer":"yes"}\n\n{not json\n[1]\n')
    good, bad = files.json_objects(files.lines(spark, str(p)))
    assert [r["line"] for r in good.collect()] == [1] and sorted(r["line"] for r in bad.collect()) == [3, 4]
    for name, text in (("a.json", '[{"instruction":"i","output":"o"}, 3]'), ("a.jsonl", '{"instruction":"i","output":"o"}\nbad\n')):
        (tmp_path / name).write_text(text)
        assert [(r["instruction"], r["output"]) for r in files.alpaca_records(spark, str(tmp_path / name)).collect()] == [("i", "o")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x")], "b int, a string, text string")
    sinks.write_json_lines(df, str(tmp_path / "o"), single=True, sort_keys=True)
    assert [r[0] for r in spark.read.text(str(tmp_path / "o")).collect()] == ['{"a":null,"b":1,"text":"x"}']
    assert sinks.write_report(df, str(tmp_path / "r.json")) == json.loads((tmp_path / "r.json").read_text())
    sinks.export_sqlite({"chunks": df}, str(tmp_path / "d.sqlite"))
    assert sqlite3.connect(tmp_path / "d.sqlite").execute("SELECT b FROM chunks").fetchall() == [(1,)]
    with pytest.raises(Exception):
        sinks.write_text_atomically(str(tmp_path / "bad"), 3)
    assert sorted(os.listdir(tmp_path)) == ["d.sqlite", "o", "r.json"]


def test_state(spark, tmp_path):
    place = str(tmp_path / "state")
    sources = spark.createDataFrame([("a", "1"), ("b", "2")], "source_id string, source_sha256 string")
    assert incremental.read_state(spark, place).count() == 0
    done = sources.where("source_id = 'a'").withColumns({"status": F.lit("success"), "fingerprint": F.lit("f"), "output_bytes": F.lit(5).cast("long")})
    incremental.record(done, place, 1)
    state = incremental.read_state(spark, place)
    assert [r[0] for r in incremental.pending(sources, state, "f").select("source_id").collect()] == ["b"]
    assert incremental.pending(sources, state, "g").count() == incremental.pending(sources, state, "f", force=True).count() == 2
    assert incremental.fingerprint({"a": 1, "api_key": "x"}) == incremental.fingerprint({"api_key": "y", "a": 1})


def test_stream_equals_full_run(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    one = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "source_id string, source_sha256 string, content string")
    one.write.parquet(source)

    def run():
        stream = spark.readStream.schema(one.schema).parquet(source)
        incremental.ingest(stream, str(tmp_path / "state"), out, "f", lambda d: d.select("source_id", F.upper("content").alias("t")), str(tmp_path / "ck")).awaitTermination()
        return sorted((r["source_id"], r["t"]) for r in spark.read.parquet(out).collect())

    assert run() == [("a", "X"), ("b", "Y")]
    spark.createDataFrame([("a", "1", "x"), ("c", "3", "z")], one.schema).write.mode("append").parquet(source)
    assert run() == [("a", "X"), ("b", "Y"), ("c", "Z")]
