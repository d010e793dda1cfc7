"""Text functions against Python's own string methods."""

import pytest
from pyspark.sql import functions as F

from tessella.functions import pytext
from tessella.functions import text as T
from tessella.functions.windows import py_clean

TEXTS = ["", "  \u00a0x\u2028y \x85", "Straße ΣΑΣ ſ ﬁ", "a\r\nb\rc\n\n\n\n d\t\t e  ", "running boxes cats is the gas", "über café naïve", "a\x0bb\x1cc", "ab", "\u3000"]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")


def values(frame, column):
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("ours, theirs", [
    (T.strip, str.strip), (T.lstrip, str.lstrip), (T.casefold, str.casefold), (T.canonical_text, pytext.canonical), (T.clean_text, py_clean),
    (T.near_duplicate_key, pytext.topic_key), (T.alnum_count, lambda t: sum(c.isalnum() for c in t)),
])
def test_like_python(frame, ours, theirs):
    assert values(frame, ours(F.col("t"))) == [theirs(t) for t in TEXTS]


def test_trigrams_and_ngrams(frame):
    want = [sorted({s[i : i + 3] for i in range(len(s) - 2)} or {s}) for s in (t.lower().strip() for t in TEXTS)]
    assert [sorted(x) for x in values(frame, T.trigrams(F.col("t")))] == want
    assert values(frame, T.ngrams(F.array(*map(F.lit, "abcabc")), 3))[0] == ["a b c", "b c a", "c a b"]
    assert values(frame, T.ngrams(F.array(F.lit("a")), 3))[0] == []


def test_small_lookups(spark):
    row = spark.range(1).select(T.duration(F.lit(3723.9)), T.duration(F.lit(0.0)), T.duration(F.lit(61.2)), T.media_type(F.lit(".md")), T.media_type(F.lit(".x")), T.ocr_language(F.lit("de")), T.ocr_language(F.lit("xx")), T.camel_to_snake(F.lit("SectionHeader")), T.heading_level(F.lit("<H3>x</H3>")), T.detail_instruction(F.lit(99)), T.relative_path(F.lit("file:///a/b/c.txt"), "/a")).first()
    assert tuple(row) == ("01:02:03", "unknown", "01:01", "text/markdown", "application/octet-stream", "deu", "fra+eng", "section_header", 3, "exhaustive", "b/c.txt")


def test_summary_content(spark):
    text = "Sure, here you go:\n\nThe body.\n\n## References\nstuff\n\n**Would you like more**: yes"
    assert spark.range(1).select(T.summary_content(F.lit(text))).first()[0] == "The body."


def test_sql_functions(spark):
    from tessella.operators import rag

    rag.register(spark)
    assert spark.sql("SELECT clean_text('a  b'), canonical_text(' Ab  C '), near_dup_key('the running cats')").first()[:] == ("a b", "ab c", "cat runn")
    assert [r[1] for r in spark.sql("SELECT * FROM chunk_windows('aaaa bbbb cccc', 6, 0)").collect()] == ["aaaa", "bbbb", "cccc"]
    assert spark.sql("SELECT count(*) FROM blocks_from_text('# h\n\ntext', 'd')").first()[0] == 2
