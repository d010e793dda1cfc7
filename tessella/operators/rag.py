"""Retrieval tables: documents, chunks, statistics, and BM25 search over an inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import pytext
from ..functions import rules as R
from ..functions import text as T
from ..functions import windows as C
from .dedup import first_wins
from .shared import spread, stored

# Fixed value.
RIGHTS = "unknown_review_required"


def with_first_copy(docs: DataFrame, key: str, order: str) -> DataFrame:
    """duplicate_of: the earliest document with the same content, null for that one itself."""
    slim = docs.select(key, order)
    firsts = slim.groupBy(key).agg(F.min(order).alias("duplicate_of"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    later = slim.join(firsts, key).where(F.col(order) != F.col("duplicate_of")).select(order, "duplicate_of")
    return docs.join(later, order, "left")


def windows(docs: DataFrame, size: int = C.RAG_CHARS, overlap: int = C.RAG_OVERLAP) -> DataFrame:
    """docs (document_id, text, ...) -> a row for each window: win_pos, chunk_text."""
    return docs.select("*", F.posexplode(C.windows_column(F.col("text"), size, overlap)).alias("win_pos", "chunk_text"))


def judged_windows(wins: DataFrame, domain: str) -> DataFrame:
    """Windows with quality and status: indexed, rejected_quality, or rejected_duplicate.

    Quality comes first; among the good ones the first by document and window wins, over all documents of a domain.
    """
    # cut and judged once, in a table: firsts are then found on keys alone, and every later step reads the table
    scored = stored(wins.withColumn("quality", R.chunk_quality(F.col("chunk_text"))).withColumn("content_sha256", K.canonical_sha(F.col("chunk_text"))))
    place = F.struct("document_id", "win_pos")
    firsts = scored.where("quality.keep").groupBy("content_sha256").agg(F.min(place).alias("f"))
    # by document, so that windows numbered in their document later need no second shuffle of the texts
    of_document = firsts.groupBy(F.col("f.document_id").alias("document_id")).agg(F.collect_list("f.win_pos").alias("_firsts"))
    status = F.when(~F.col("quality.keep"), "rejected_quality").when(F.array_contains("_firsts", F.col("win_pos")), "indexed").otherwise("rejected_duplicate")
    return scored.join(of_document, "document_id", "left").withColumn("status", status).withColumn("domain", F.lit(domain)).drop("_firsts")


#: Where a chunk comes from, in builds from files.
PROVENANCE = ("section", "page_start", "page_end", "extraction_method", "source_sha256", "rights_status")


def chunks(judged: DataFrame) -> DataFrame:
    """The chunks table: indexed windows, numbered densely in their document."""
    w = W.partitionBy("document_id").orderBy("win_pos")
    kept = judged.where("status = 'indexed'").withColumn("chunk_index", F.row_number().over(w) - 1)
    text = F.col("chunk_text")
    return kept.select(
        F.concat(F.lit("sha256:"), F.sha2(F.concat_ws(":", "domain", "source_sha256", F.col("chunk_index").cast("string"), "content_sha256"), 256)).alias("chunk_uid"),
        "document_id", "chunk_index", "category", "title", text.alias("text"), "content_sha256",
        F.length(text).alias("char_count"), F.col("quality.words").alias("word_count"), T.token_estimate(text).alias("token_estimate"),
        F.bround(F.col("quality.score"), 4).alias("quality_score"), *[c for c in PROVENANCE if c in judged.columns and "section" in judged.columns],
    )


def prepared(docs: DataFrame, id_col: str, text_col: str, stem_col: str, domain: str) -> DataFrame:
    """Source rows as documents: cleaned text, content hash, category, first copy."""
    out = docs.select(
        F.col(id_col).alias("document_id"), F.col(stem_col).alias("title"), T.clean_text(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("source_sha256"), R.finance_category(F.coalesce(F.col(stem_col), F.lit(""))).alias("category"),
    )
    return with_first_copy(out, "source_sha256", "document_id").withColumn("domain", F.lit(domain))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stem_col: str = "source", domain: str = "finance", size: int = C.RAG_CHARS, overlap: int = C.RAG_OVERLAP) -> tuple[DataFrame, DataFrame]:
    """(documents, judged windows); copies of a document are listed but not cut."""
    ready = prepared(spread(docs.select(id_col, text_col, stem_col)), id_col, text_col, stem_col, domain)
    originals = ready.where(F.col("duplicate_of").isNull() & (F.col("text") != ""))
    return ready, judged_windows(windows(originals, size, overlap), domain)


def documents(ready: DataFrame, judged: DataFrame) -> DataFrame:
    """The documents table: status, sizes and counts of each source document."""
    counts = judged.groupBy("document_id").agg(F.count_if(F.col("status") == "indexed").alias("chunk_count"))
    status = F.when(F.col("duplicate_of").isNotNull(), "duplicate").when(F.col("text") == "", "no_native_text").otherwise("indexed")
    return ready.join(counts, "document_id", "left").select(
        "document_id", F.concat(F.lit("sha256:"), "source_sha256", F.lit(":"), F.substring(F.sha2(F.coalesce(F.col("title"), F.lit("")), 256), 1, 12)).alias("document_uid"),
        "domain", "category", "title", "source_sha256", status.alias("extraction_status"),
        F.when(status == "indexed", F.length("text")).otherwise(0).alias("extracted_char_count"), F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"),
        F.col("duplicate_of").alias("duplicate_of_document_id"), F.lit(RIGHTS).alias("rights_status"),
    )


def stats(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """One row of counts over a build; both sides are a single row."""
    a = docs.agg(
        F.count(F.lit(1)).alias("documents_total"), *[F.count_if(F.col("extraction_status") == s).alias(f"documents_{s}") for s in ("indexed", "duplicate", "no_native_text")],
        F.coalesce(F.sum("extracted_char_count"), F.lit(0)).alias("extracted_chars"),
    )
    b = judged.agg(*[F.count_if(F.col("status") == s).alias(f"chunks_{s}") for s in ("indexed", "rejected_quality", "rejected_duplicate")])
    return a.crossJoin(b)


def category_counts(chunk_table: DataFrame) -> DataFrame:
    return chunk_table.groupBy("category").agg(F.count(F.lit(1)).alias("chunks"))


# BM25 as published: saturation and length normalisation; idf = ln(1 + (N - df + 0.5) / (df + 0.5)), never negative.
K1, B = 1.2, 0.75
# Accented Latin letters and their plain forms.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def terms(c: Column) -> Column:
    """Letter and digit runs of the lower-cased text without Latin accents."""
    return F.regexp_extract_all(F.translate(F.lower(c), ACCENTED, PLAIN), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def inverted_index(chunk_table: DataFrame, id_col: str = "chunk_uid", text_col: str = "text") -> DataFrame:
    """(term, id, tf, length): one row for each term of each chunk."""
    tokens = chunk_table.select(F.col(id_col).alias("id"), terms(F.col(text_col)).alias("t"))
    return tokens.select("id", F.size("t").alias("length"), F.explode("t").alias("term")).groupBy("term", "id", "length").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(chunk_table: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, chunks, occurrences) of the inverted index: rows are counted where they are read, and terms alone are shuffled."""
    counted = chunk_table.select(F.col(text_col).alias("t")).mapInArrow(K.term_counts(ACCENTED, PLAIN), "term string, chunks long, occurrences long")
    return counted.groupBy("term").agg(F.sum("chunks").alias("chunks"), F.sum("occurrences").alias("occurrences"))


def bm25_search(chunk_table: DataFrame, query: str, k: int = 10, id_col: str = "chunk_uid", text_col: str = "text") -> DataFrame:
    """The k chunks that match the query best: (id, score), ties by id. Only the query's terms are indexed."""
    spark = chunk_table.sparkSession
    asked = [r[0] for r in spark.range(1).select(F.explode(F.array_distinct(terms(F.lit(query))))).collect()]
    tokens = chunk_table.select(F.col(id_col).alias("id"), terms(F.col(text_col)).alias("t")).select("id", F.size("t").alias("length"), "t")
    whole = tokens.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    hits = tokens.select("id", "length", F.explode(F.filter("t", lambda x: x.isin(*asked))).alias("term")).groupBy("term", "id", "length").agg(F.count(F.lit(1)).alias("tf"))
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return hits.join(F.broadcast(df), "term").crossJoin(F.broadcast(whole)).groupBy("id").agg(F.bround(F.sum(weight.cast("decimal(28,12)")), 6).cast("double").alias("score")).orderBy(F.desc("score"), "id").limit(k)


def register(spark: SparkSession) -> None:
    """SQL functions clean_text, canonical_text and near_dup_key, and the table functions of the windows module."""
    for name in ("clean_text", "canonical_text", "near_dup_key"):
        spark.udf.register(name, F.pandas_udf(getattr(pytext, f"{name}_series"), "string"))
    C.register(spark)


def repeated_lines(docs: DataFrame, group: str, text: str, share: float = 0.20, least: int = 3) -> DataFrame:
    """(group, line, pages): canonical lines of 3 to 120 characters on many of a group's pages."""
    pages = docs.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    line = F.explode(F.array_distinct(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), T.canonical_text)))
    counted = docs.select(group, line.alias("line")).where(F.length("line").between(3, 120)).groupBy(group, "line").agg(F.count(F.lit(1)).alias("pages"))
    return counted.join(pages, group).where(F.col("pages") >= F.greatest(F.lit(least), F.ceil(F.col("n") * share))).select(group, "line", "pages")


def first_copies(docs: DataFrame, key: str, order: str) -> DataFrame:
    return first_wins(docs, [key], [order])
