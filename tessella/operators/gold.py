"""Curated sets: candidates grounded in trusted sources, their rejections, and the published files with provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import rules as R
from ..functions import text as T
from ..sources import sinks
from . import qa

# How many records a set has at most, and how many sources its report names.
TARGETS = {"cyber": 4000, "finance": 5000}
TOP_SOURCES = 25


def trusted(source_file: str = "source_file"):
    """Whether a finance source is one of the trusted core."""
    return F.coalesce(F.col(source_file), F.lit("")).rlike(f"(?iu){P.TRUSTED_FINANCE_SOURCE}")


def finance_candidates(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejected) of raw pairs against the texts they were made from.

    rows: line, question, answer, source_file, chunk_index. sources: stem (case-folded), source_path, source_sha256,
    text. A row of an untrusted or missing source has that reason alone; rejected has a row for each row and reason.
    A source's runs of words are made once and joined with those of its rows, whatever the number of either.
    """
    pairs = rows.withColumns({
        "instruction": T.strip(F.coalesce("question", F.lit(""))), "response": T.strip(F.coalesce("answer", F.lit(""))), "source_file": T.strip(F.coalesce("source_file", F.lit(""))),
    }).withColumn("stem", T.casefold(F.regexp_replace("source_file", r"\.md$", "")))
    known = pairs.where(trusted()).join(sources.select("stem", "source_path", "source_sha256"), "stem", "left")
    found = known.where("source_path is not null")
    support = qa.token_support(found, "line", "response", sources, "text", "stem")
    both = F.concat(F.col("instruction"), F.lit("\n"), F.col("response"))
    judged = found.join(support, "line").withColumn("reasons", R.finance_reasons(F.col("instruction"), F.col("response"), F.col("level"), F.col("coverage"))).withColumn("b", R.best_category(both, P.FINANCE_CATEGORIES))
    reasons = F.when(F.size("reasons") > 0, F.array_distinct("reasons")).when(F.col("b.name") == "other", F.array(F.lit("uncategorized"))).otherwise(F.array().cast("array<string>"))
    judged = judged.withColumn("reasons", reasons)
    good = judged.where(F.size("reasons") == 0).select(
        "instruction", "response", F.col("b.name").alias("category"), R.finance_score(F.col("instruction"), F.col("response"), F.col("b.hits"), F.col("coverage")).alias("score"),
        T.stable_hash(F.col("instruction"), F.col("response")).alias("stable_key"), F.col("line").alias("original_line"), "source_file", F.lit(None).cast("string").alias("source_family"), "source_sha256", "source_path",
        F.col("chunk_index").cast("long").alias("source_chunk_index"), F.col("level").alias("support_level"), F.col("coverage").alias("support_coverage"),
    )
    alone = lambda df, reason: df.select("line", F.lit(reason).alias("reason"))
    rejected = judged.select("line", F.explode("reasons").alias("reason"))
    return good, rejected.unionByName(alone(pairs.where(~trusted()), "source_outside_trusted_core")).unionByName(alone(known.where("source_path is null"), "source_file_missing"))


def provenance(selected: DataFrame) -> DataFrame:
    """Where each record of a set comes from, by its line in the set."""
    has_source = F.coalesce(F.col("source_file"), F.lit("")) != ""
    return selected.select(
        "gold_line", "category", F.col("score").alias("quality_score"), "original_line", "source_file", "source_family", "source_sha256", "source_path", "source_chunk_index",
        F.col("support_level").alias("textual_support_level"), F.col("support_coverage").alias("textual_support_coverage"), F.when(has_source, "verified_local_document").otherwise("unavailable").alias("source_status"),
    )


def dataset(selected: DataFrame) -> DataFrame:
    return selected.orderBy("gold_line").select(T.hf_text(F.col("instruction"), F.lit(""), F.col("response")).alias("text"))


def top_sources(selected: DataFrame, most: int = TOP_SOURCES) -> DataFrame:
    """(source_file, n): the sources with most records; of equal ones the one that comes first in the set."""
    counted = selected.where("source_file <> ''").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.min("gold_line").alias("_first"))
    return counted.orderBy(F.desc("n"), "_first").limit(most).select("source_file", "n")


def counts(selected: DataFrame, column: str) -> DataFrame:
    return selected.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def set_report(selected: DataFrame, candidates: DataFrame, rejected: DataFrame) -> dict:
    """Sizes, categories, families, top sources and rejections of a set."""
    as_dict = lambda df: {r[0]: r[1] for r in df.collect()}
    return {
        "selected": selected.count(), "eligible_candidates": candidates.count(), "categories": as_dict(counts(selected, "category")), "source_families": as_dict(counts(selected, "source_family")),
        "top_sources": [[r[0], r[1]] for r in top_sources(selected).collect()], "quality_rejections": as_dict(rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))), "provenance_warning": None,
    }


def write_set(name: str, selected: DataFrame, candidates: DataFrame, rejected: DataFrame, output: str) -> dict:
    """The data set, its provenance and its report below output."""
    sinks.write_json_lines(dataset(selected), f"{output}/{name}_gold")
    sinks.write_json_lines(provenance(selected).orderBy("gold_line"), f"{output}/{name}_gold.provenance")
    report = set_report(selected, candidates, rejected)
    sinks.write_json(report, f"{output}/{name}_gold.report.json")
    return report


def numbered_lines(selected: DataFrame) -> DataFrame:
    """gold_line in the order of the keys; a set has at most a few thousand records."""
    return selected.withColumn("gold_line", F.row_number().over(W.orderBy("stable_key")))
