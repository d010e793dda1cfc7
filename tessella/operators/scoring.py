"""Scores of parsers against expectations, and reports of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .dedup import similarity

COMPONENTS = ("non_empty", "required_phrase_recall", "forbidden_phrase_score", "minimum_length", "page_recall", "block_type_recall", "reference_similarity")


def _share(wanted: Column, found) -> Column:
    """Share of the wanted values that are found; null without wanted values."""
    return F.when(F.size(wanted) > 0, F.size(F.filter(wanted, found)) / F.size(wanted))


def scored(cases: DataFrame) -> DataFrame:
    """cases with components (struct) and score: the mean of those that are configured.

    Columns: text; required_phrases, forbidden_phrases, expected_pages, expected_block_types (arrays, empty or null:
    not configured), min_chars, reference_text (null: not configured), pages, block_types of the parsed document.
    """
    normal = T.canonical_text(F.coalesce(F.col("text"), F.lit("")))
    inside = lambda phrase: F.contains(F.col("_normal"), T.canonical_text(phrase))
    values = {
        "non_empty": F.when(F.col("_normal") != "", 1.0).otherwise(0.0),
        "required_phrase_recall": _share(F.col("required_phrases"), inside),
        "forbidden_phrase_score": 1.0 - _share(F.col("forbidden_phrases"), inside),
        "minimum_length": F.when(F.col("min_chars").isNotNull(), F.when(F.length(T.strip(F.col("text"))) >= F.col("min_chars"), 1.0).otherwise(0.0)),
        "page_recall": _share(F.col("expected_pages"), lambda p: F.array_contains(F.col("pages"), p)),
        "block_type_recall": _share(F.col("expected_block_types"), lambda b: F.array_contains(F.transform("block_types", F.lower), b)),
        "reference_similarity": F.when(F.col("reference_text").isNotNull(), similarity(T.canonical_text(F.coalesce("reference_text", F.lit(""))), F.col("_normal"))),
    }
    out = cases.withColumn("_normal", normal).withColumns(values)
    every = F.array_compact(F.array(*COMPONENTS))
    mean = F.aggregate(every, F.lit(0.0), lambda a, x: a + x) / F.size(every)
    return out.withColumn("score", F.bround(mean, 6)).withColumn("components", F.struct(*COMPONENTS)).drop("_normal", *COMPONENTS)


def on_every_parser(cases: DataFrame, parsers: DataFrame) -> DataFrame:
    """Every case with every parser; parsers is a short list of names."""
    return cases.crossJoin(F.broadcast(parsers))


def summary(results: DataFrame) -> DataFrame:
    """By parser: cases, successes, mean score and seconds."""
    return results.groupBy("parser").agg(
        F.count(F.lit(1)).alias("cases"), F.count_if(F.col("status") == "success").alias("successes"),
        F.bround(F.avg("score"), 6).alias("mean_score"), F.bround(F.avg("elapsed_seconds"), 6).alias("mean_seconds"),
    )


def passes(summaries: DataFrame, least: float) -> bool:
    """Whether every parser's mean score reaches the gate."""
    return summaries.where(F.coalesce(F.col("mean_score"), F.lit(0.0)) < least).isEmpty()


def run_summary(results: DataFrame) -> DataFrame:
    """Documents by status; characters and chunks of the successful ones only."""
    good = F.col("status") == "success"
    return results.agg(
        F.count(F.lit(1)).alias("documents_total"), *[F.count_if(F.col("status") == s).alias(f"documents_{s}") for s in ("success", "skipped", "failed")],
        F.coalesce(F.sum(F.when(good, F.col("char_count"))), F.lit(0)).alias("total_characters"), F.coalesce(F.sum(F.when(good, F.col("chunk_count"))), F.lit(0)).alias("total_chunks"),
    )
