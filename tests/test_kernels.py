"""Texts judged in slices against plain loops, and plans that leave no costly text function to Java's patterns."""

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from tessella.functions import kernels as K
from tessella.functions import rules as R
from tessella.functions import text as T

HOSTILE = ["", "a", "don't stop-'", "-- ' × a×b", "x\ty\x00z​　é_1²", "ſıİK ΑΣ ß", "�" * 3 + "abc", " a  \t b \n\n\n\n c\r\nd\x85"]


def test_counts():
    c = K.counts(HOSTILE)
    for k, t in enumerate(HOSTILE):
        of = [unicodedata.category(x) for x in t]
        assert c["n"][k] == len(t) and c["letters"][k] == sum(x[0] == "L" for x in of) and c["broken"][k] == t.count("�")
        assert c["printable"][k] == sum(x.isprintable() for x in t) and c["solid"][k] == sum(not x.isspace() for x in t)
        assert c["words"][k] == len(re.findall(r"\w(?:[\w×÷'-]*\w)?", t))


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "SLICE_CHARS", 10)
    rows = ["aaaa", None, "bbbb", "c" * 30, "d", ""]
    got = [part[0] for part in K.slices(pa.array(rows))]
    assert sum(got, []) == rows and all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in got)


def test_no_java_patterns(spark):
    df = spark.createDataFrame([(t * 200,) for t in HOSTILE] + [(None,)], "t string")
    t = F.col("t")
    told = df.select(T.clean_text(t), R.chunk_quality(t), R.training_rejection(t), K.canonical_sha(t))
    assert "regexp" not in told._jdf.queryExecution().optimizedPlan().toString()
    assert len(told.collect()) == len(HOSTILE) + 1


def test_terms_are_counted_where_they_are_read(spark):
    from tessella.operators import rag

    df = spark.createDataFrame([("a", "Été été x_y"), ("b", "ete 1"), ("c", None)], "chunk_uid string, text string")
    told = rag.term_counts(df)
    assert {tuple(r) for r in told.collect()} == {("ete", 2, 3), ("x", 1, 1), ("y", 1, 1), ("1", 1, 1)}
    assert told._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1  # none by chunk


def test_support_both_ways(spark, monkeypatch):
    from tessella.operators import qa

    answers = spark.createDataFrame([(1, "one two three four five six"), (2, "x y z"), (3, "red blue green pink")], "k long, t string")
    sources = spark.createDataFrame([("zero one two three four nine",), ("red blue green pink",), (None,)], "s string")
    few = {tuple(r) for r in qa.token_support(answers, "k", "t", sources, "s").collect()}
    monkeypatch.setattr(qa, "ASKED", 0)
    assert few == {tuple(r) for r in qa.token_support(answers, "k", "t", sources, "s").collect()}
    assert few == {(1, 2, 1 / 3), (2, 0, 0.0), (3, 2, 1.0)}


def test_pieces_leave_in_slices(spark, monkeypatch):
    """No worker turns a whole batch into pieces at once."""
    from tessella.functions import windows as C

    seen = []
    monkeypatch.setattr(K, "arrow", lambda run, *_: seen.append(run))
    C._udf(lambda t: [t], "array<string>")(1)
    assert len(seen) == 1 and seen[0](["a"]).to_pylist() == [["a"]]
