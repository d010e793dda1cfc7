"""Cutting texts: bounds, coverage and every branch by hand."""

import random

import pytest
from pyspark.sql import functions as F

from tessella.functions import windows as C

MD = "# One\nintro\n\n### Three\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\n# no heading\ncode\n```\nend\n## Two\nlast"


def test_windows_by_hand():
    assert C.chunk_windows("abc", 3) == ["abc"]
    assert C.chunk_windows("a" * 10, 4, 1) == ["aaaa", "aaaa", "aaaa"]
    assert C.chunk_windows("aaaa. bbbb cc", 7, 0) == ["aaaa.", "bbbb cc"]
    assert C.chunk_windows("a\n\nbbbb cccc dd", 10, 0)[0] == "a\n\nbbbb cc"  # an early paragraph end hides the blank
    assert C.chunk_windows("aaaaaa\n\nbb cc dd", 10, 0) == ["aaaaaa", "bb cc dd"]
    assert C.chunk_windows("aaaaaa\nbb cc dd", 8, 0)[0] == "aaaaaa"


def test_windows_cover_the_text():
    r = random.Random(3)
    for _ in range(200):
        text = "".join(r.choice("ab. \n") for _ in range(r.randint(1, 400)))
        for piece in C.chunk_windows(text, 50, 10):
            assert len(piece) <= max(50, 50 if len(text) > 50 else len(text))
        assert "".join(text.split()) == "" or C.chunk_windows(text, 50, 10)


def test_summary_drops_a_character_at_a_hard_cut():
    assert C.summary_pieces("abcdefghij", 4) == ["abcd", "fghi"]
    assert C.summary_pieces("ab\n\ncd ef", 6) == ["ab", "cd ef"]


def test_split_large_guard():
    text = "aa " + "b" * 40
    assert len(C.split_large(text, 20, 10)) > len(C.split_large(text, 20, 10, guard=True))


def test_sections_and_blocks():
    assert [s["section"] for s in C.sections(MD)] == ["One", "Three", "no heading", "Two"]
    found = C.blocks(MD, "d")
    assert [b["block_type"] for b in found] == ["section_header", "text", "section_header", "table", "code", "text", "section_header", "text"]
    assert found[2]["heading_path"] == ["One", "Three"] and found[-1]["heading_path"] == ["One", "Two"]
    assert C.blocks("```\nopen", "d")[0]["block_type"] == "code" and C.blocks(" \n", "d") == []


def test_packed_chunks_keep_their_bound():
    chunks = C.packed_chunks(C.blocks("# h\n\n" + "A sentence of words. " * 80, "d"), "d", 300, 30)
    assert all(c["char_count"] <= 300 and c["heading_path"] == ["h"] for c in chunks) and len({c["id"] for c in chunks}) == len(chunks)
    with pytest.raises(ValueError):
        C.packed_chunks([], "d", 100, 10)


def test_columns_like_functions(spark):
    texts = [MD, "", "x" * 7000, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(C.windows_column(F.col("t"), 3200, 320), C.split_large_column(F.col("t")), C.summary_column(F.col("t")), C.blocks_column(F.col("t"), F.lit("d"))).collect()
    for t, row in zip(texts[:3], got):
        assert row[0] == C.chunk_windows(t) and row[1] == C.split_large(t) and row[2] == C.summary_pieces(t) and len(row[3]) == len(C.blocks(t, "d"))
