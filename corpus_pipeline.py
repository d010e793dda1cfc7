"""A corpus pipeline: language identification, near duplicates, redaction, mixing, packing.

Every stage takes all that its predecessor kept and returns the columns of ``documents``; packing, the last,
returns the pieces. ``run`` writes each stage's result as Parquet in the folder that driver and executors
share, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import langid, mixing, neardup, packing, pii
from tessella.llm.common import passing_place, table

#: SQL can express neither fitted models nor near-duplicate classes; tests hold the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no language (null, or without a letter); a lang that was missing is filled in.

    Without any labelled row no language is known, and texts with a letter stay; repeated rows stay; languages that a text is
    equally like are taken in the order of their sample's size, then name; other columns pass untouched.
    """
    model = langid.learn(docs, "text", "lang", "doc_id", F.lit(True))
    others = [c for c in docs.columns if c != "text"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    found = langid.identify(held, model)
    found = found.where(F.col("lang_pred") != "und" if model.languages else F.col("text").rlike(r"\p{L}"))
    named = {"text": F.col("text"), "lang": F.coalesce(F.col("row.lang"), F.nullif("lang_pred", F.lit("und")))}
    return found.select(*[named.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class.

    Texts without words all stay; of rows without id the class keeps one as well, after those with ids; different texts
    under one id are told apart; of repeated rows the first by its other columns stays.
    """
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the new text. Null texts stay null; no row goes."""
    return pii.redact(docs, "text", "n_chars")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, a row for each copy, in order of virtual finish time.

    Texts without words are never taken; rows without a source form one, last in order; repeated rows are each queued.
    """
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens. Null texts are an end alone; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing_sources),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    place = passing_place(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
    return docs
