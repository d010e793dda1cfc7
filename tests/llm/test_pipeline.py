"""The corpus pipeline, stage by stage, against brute force."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessella.llm import registry
from tests.llm import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = dict(P.STAGES)
    assert list(steps) == ["language", "near_duplicates", "personal_data", "mixing", "packing"]
    one = steps["language"](spark, docs, sf_dir).cache()
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    two = steps["near_duplicates"](spark, one, sf_dir).cache()
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert two.columns == columns and sorted(r["doc_id"] for r in two.collect()) == sorted(set(brute.near_classes(rows)))
    three = steps["personal_data"](spark, two, sf_dir).cache()
    assert three.columns == columns and all(r["n_chars"] == len(r["text"]) for r in three.collect() if "[EMAIL]" in r["text"])
    assert not any(brute.pii_base(r["text"])[0]["email"] for r in three.collect())
    four = steps["mixing"](spark, three, sf_dir).cache()
    size = Counter()
    for r in four.collect():
        size[r["source"]] += len(brute.words(r["text"]))
    longest = max(len(brute.words(r["text"])) for r in three.collect())
    assert four.columns == columns and all(abs(size[s] - t) <= longest for s, (_, t) in brute.mix([(r["source"], r["text"]) for r in three.collect()]).items())
    five = steps["packing"](spark, four, sf_dir)
    assert sum(r["length"] for r in five.collect()) == sum(r["doc_tokens"] for r in five.collect() if r["start"] == 0)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, size string, _row string, weight int, comp string"


def hostile_rows():
    long = " ".join(f"word{i % 3000}x{i}" for i in range(30_000))
    near = [f"near{i}" for i in range(100)]
    texts = [None, "", " \t\n", "1234 5678", long, long, " ".join(near), " ".join([*near[:99], "other"]), "mail me@x.com from 10.0.0.1 please", "über ß €uro 日本 text", "the same text", "the same text"]
    rows = [(None if i in (4, 9) else i, t, ["en", None, "fr"][i % 3], None if i % 4 == 0 else f"s{i % 2}", 0, 0.5, "x", "y", "z", 3, "c") for i, t in enumerate(texts)]
    return [*rows, rows[10], rows[0], rows[4]]


def test_stages_on_hostile_and_empty_tables(spark, sf_dir):
    """Nulls in any column, empty and very long texts, ties, repeated rows, rows without id, clashing names; and no rows."""
    docs = spark.createDataFrame(hostile_rows(), DOCS).repartition(3)
    columns, steps = docs.columns, dict(P.STAGES)
    one = steps["language"](spark, docs, sf_dir).cache()
    want = [r for r in hostile_rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert one.columns == columns and sorted((r["doc_id"], r["text"]) for r in one.collect() if r["doc_id"] is not None) == sorted((r[0], r[1]) for r in want if r[0] is not None)
    assert one.count() == len(want) and all(r["lang"] for r in one.collect())
    unlabelled = steps["language"](spark, docs.withColumn("lang", F.lit(None).cast("string")), sf_dir)
    assert unlabelled.count() == len(want)
    two = steps["near_duplicates"](spark, one, sf_dir).cache()
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"][:9]) for r in two.collect())
    assert two.columns == columns and kept == [(False, 5, "word0x0 w"), (False, 6, "near0 nea"), (False, 8, "mail me@x"), (False, 10, "the same "), (True, 0, "über ß €u")]
    three = steps["personal_data"](spark, two, sf_dir).cache()
    texts = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == columns and texts[8]["text"] == "mail [EMAIL] from [IP] please" and texts[8]["n_chars"] == len(texts[8]["text"])
    four = steps["mixing"](spark, three, sf_dir).cache()
    assert four.columns == columns and {r["text"] for r in four.collect()} <= {r["text"] for r in three.collect()}
    five = steps["packing"](spark, four, sf_dir).collect()
    assert sum(r["length"] for r in five) == sum(r["doc_tokens"] for r in five if r["start"] == 0)
    for name, stage in P.STAGES:
        nothing = stage(spark, docs.limit(0), sf_dir)
        assert nothing.count() == 0 and (name == "packing" or nothing.columns == columns)
        again = stage(spark, docs, sf_dir)  # every stage takes the raw table as well
        assert again.count() > 0 and (name == "packing" or again.columns == columns)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_like_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, want = registry.QUERIES[name](spark, sf_dir), con.sql(registry.SQL[name])
    flat = lambda names, rows: sorted((tuple(round(r[names.index(c)], 6) if isinstance(r[names.index(c)], float) else r[names.index(c)] for c in sorted(names)) for r in rows), key=repr)
    assert flat(df.columns, [tuple(r) for r in df.collect()]) == flat(want.columns, want.fetchall())
