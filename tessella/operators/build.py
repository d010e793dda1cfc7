"""From files to retrieval tables, training records and chat records, by domain, without a model in between.

``build_tables`` turns decoded files into the documents, chunks and meta tables; ``training_records`` and
``chat_lines`` export what they hold; ``model_data`` runs all of it for the chosen domains and reports on each.
"""

from __future__ import annotations

import json
import mimetypes
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import document as D
from ..functions import rules as R
from ..functions import text as T
from ..functions import windows as C
from ..sources import files, formats, sinks
from . import rag, training
from .shared import numbered, stored

DOMAINS = ("cyber", "finance")
# The suffixes that are read without OCR, and what a build says about itself.
NATIVE_SUFFIXES = (".pdf", ".epub", ".md", ".rst", ".txt", ".doc", ".pptx")
POLICIES = {
    "source": "original_documents_only", "generated_summaries": "excluded", "generated_qa": "excluded", "ocr": "native_text_only", "document_deduplication": "sha256",
    "chunk_deduplication": "canonical_sha256", "rights_status": rag.RIGHTS,
}
TASK, FORMAT = "grounded_document_continuation", "messages[user, assistant]"


def check_limits(domain: str = "both", max_chars: int = C.RAG_CHARS, overlap: int = C.RAG_OVERLAP, min_quality: float = training.MIN_QUALITY, min_chars: int = training.MIN_CHARS, min_words: int = training.MIN_WORDS, cap: int = training.CAP) -> tuple[str, ...]:
    """The domains to build; ValueError for limits out of range."""
    for wrong, message in (
        (domain not in ("both", *DOMAINS), "domain must be one of: both, cyber, finance"), (max_chars < 200, "chunk_max_chars must be at least 200"),
        (not 0 <= overlap < max_chars, "chunk_overlap_chars must be non-negative and smaller than chunk_max_chars"), (not 0 <= min_quality <= 1, "min_quality must be between 0 and 1"),
        (min_chars < 400, "min_training_chars must be at least 400"), (min_words < 30, "min_training_words must be at least 30"), (cap < 1, "max_chunks_per_document must be positive"),
    ):
        if wrong:
            raise ValueError(message)
    return DOMAINS if domain == "both" else (domain,)


def category_of(domain: str, relative: Column) -> Column:
    return R.cyber_category(relative) if domain == "cyber" else R.finance_category(files.stem_of(relative))


def _listed(extracted: DataFrame, domain: str, root: str) -> DataFrame:
    """Decoded files as documents: numbered in path order, with the first copy of each content; units stay nested."""
    slim = numbered(extracted.select("source_id", "source_sha256"), [files.path_order(F.col("source_id")), F.col("source_id")], "document_id", 1)
    place = rag.with_first_copy(stored(slim), "source_sha256", "document_id").drop("source_sha256")
    path = F.col("source_id")
    first = F.col("duplicate_of").isNull()
    status = F.when(~first, "duplicate").when(F.col("error").isNotNull(), "failed").when(F.size("units") > 0, "indexed").otherwise("no_native_text")
    problems = F.concat(F.coalesce("diagnostics", F.array().cast("array<string>")), F.when(F.col("error").isNull(), F.array().cast("array<string>")).otherwise(F.array("error")))
    of_first = lambda c: F.when(first & F.col("error").isNull(), c)
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return extracted.join(place, "source_id").select(
        "document_id", F.concat(F.lit("sha256:"), "source_sha256", F.lit(":"), F.substring(F.sha2(path, 256), 1, 12)).alias("document_uid"), F.lit(domain).alias("domain"), category_of(domain, path).alias("category"),
        F.coalesce(of_first(F.col("title")), files.stem_of(path)).alias("title"), name.alias("source_name"), F.concat(F.lit(root.rstrip("/") + "/"), path).alias("source_path"), path.alias("relative_path"),
        F.col("suffix").alias("extension"), T.media_type(F.col("suffix")).alias("media_type"), "source_sha256", F.col("length").alias("source_size"), of_first(F.col("page_count")).alias("page_count"), of_first(F.col("parser")).alias("parser"),
        status.alias("extraction_status"), F.col("duplicate_of").alias("duplicate_of_document_id"), F.to_json(F.when(first, problems).otherwise(F.array().cast("array<string>"))).alias("diagnostics_json"), F.lit(rag.RIGHTS).alias("rights_status"),
        F.when(status == "indexed", F.col("units")).otherwise(F.array().cast("array<struct<text:string,page:int,section:string,method:string>>")).alias("units"),
    )


def build_tables(extracted: DataFrame, domain: str, root: str = "", size: int = C.RAG_CHARS, overlap: int = C.RAG_OVERLAP) -> dict[str, DataFrame]:
    """documents, chunks and meta of one domain, out of :func:`tessella.sources.files.extracted`.

    Files are decoded once, into a table; copies are found on hashes, and of every content the first chunk by document,
    unit and window stays. Numbers of documents and chunks are dense and in path order.
    """
    listed = stored(_listed(stored(extracted), domain, root))
    carried = ["document_id", "category", "title", "source_sha256", "rights_status"]
    units = listed.select(*carried, F.posexplode("units").alias("unit_pos", "u")).select(*carried, "unit_pos", F.col("u.text").alias("text"), F.col("u.section").alias("section"), F.col("u.page").alias("page_start"), F.col("u.page").alias("page_end"), F.col("u.method").alias("extraction_method"))
    wins = rag.windows(units, size, overlap)
    # one order of windows over all units of a document
    placed = wins.withColumn("win_pos", F.col("unit_pos").cast("long") * (1 << 32) + F.col("win_pos")).drop("unit_pos", "text")
    judged = rag.judged_windows(placed, domain)
    chunk_rows = rag.chunks(judged).drop("source_sha256", "rights_status").withColumn("domain", F.lit(domain))
    chunks = numbered(chunk_rows, [F.col("document_id"), F.col("chunk_index")], "id", 1)
    counts = judged.groupBy("document_id").agg(F.count_if(F.col("status") == "indexed").alias("chunk_count"))
    sizes = F.aggregate("units", F.lit(0).cast("long"), lambda n, u: n + F.length(u["text"]))
    documents = listed.withColumn("extracted_char_count", sizes).drop("units").join(counts, "document_id", "left").withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0)))
    return {"documents": documents, "chunks": chunks, "meta": meta(documents, judged, chunks, domain, root, size, overlap)}


def stats(documents: DataFrame, judged: DataFrame) -> DataFrame:
    """One row of counts: documents by status, chunks by status, characters."""
    kinds = ("indexed", "duplicate", "no_native_text", "failed")
    a = documents.agg(F.count(F.lit(1)).alias("documents_total"), *[F.count_if(F.col("extraction_status") == s).alias(f"documents_{s}") for s in kinds], F.coalesce(F.sum("extracted_char_count"), F.lit(0)).alias("extracted_chars"))
    b = judged.agg(*[F.count_if(F.col("status") == s).alias(f"chunks_{s}") for s in ("indexed", "rejected_quality", "rejected_duplicate")])
    return a.crossJoin(b)  # one row each


def meta(documents: DataFrame, judged: DataFrame, chunks: DataFrame, domain: str, root: str, size: int, overlap: int) -> DataFrame:
    """(key, value): what the build is, and its counts as JSON."""
    counted = stats(documents, judged).select(F.to_json(F.struct("*")).alias("v"))
    by_category = chunks.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    categories = by_category.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n"))))).alias("v"))
    plain = {
        "schema_version": "1", "domain": domain, "source_root": root, "chunk_max_chars": str(size), "chunk_overlap_chars": str(overlap), "extractor": "native-originals-no-ocr", "retrieval": "BM25", "rights_status": rag.RIGHTS,
    }
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in plain.items()], F.struct(F.lit("created_at_unix").alias("key"), F.unix_timestamp().cast("string").alias("value")))
    fixed = documents.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")
    named = lambda df, key: df.select(F.lit(key).alias("key"), F.col("v").alias("value"))
    return fixed.unionByName(named(counted, "stats_json")).unionByName(named(categories, "category_counts_json"))


# --- exports ------------------------------------------------------------------------------------------------------


RECORD = ("text", "domain", "category", "source_title", "section", "page_start", "page_end", "source_sha256", "rights_status", "chunk_uid", "quality_score", "extraction_method")


def training_rows(documents: DataFrame, chunks: DataFrame, domain: str, min_quality: float = training.MIN_QUALITY, min_chars: int = training.MIN_CHARS, min_words: int = training.MIN_WORDS, cap: int = training.CAP) -> DataFrame:
    """Chunks of sufficient quality, each with a reason or none, in the order of the export's decisions."""
    rows = files.indexed_chunks(documents, chunks.drop("title", "category"), min_quality).withColumn("domain", F.lit(domain))
    return training.judged(rows, min_quality=min_quality, min_chars=min_chars, min_words=min_words, cap=cap)


def training_records(rows: DataFrame) -> DataFrame:
    """The written records with all their fields, in document and chunk order."""
    named = {"text": F.col("trimmed"), "source_title": F.col("title")}
    written = rows.where("reason is null").orderBy("document_id", "chunk_index")
    return written.select(*[named.get(c, F.col(c)).alias(c) for c in RECORD])


def training_report(documents: DataFrame, chunks: DataFrame, rows: DataFrame, domain: str, limits: dict) -> dict:
    """What was written and why the rest was not; document_cap counts the chunks that an even choice left out."""
    good = files.indexed_chunks(documents, chunks.drop("title", "category"), limits["minimum_rag_quality"]).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    total = training.report(rows).first().asDict()
    reasons = {r["reason"]: r["n"] for r in rows.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    left_out = good - rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if left_out:
        reasons["document_cap"] = left_out
    categories = rows.where("reason is null").groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()
    return {
        "domain": domain, "records": total["records"], "characters": total["characters"], "sources_represented": total["sources"], "largest_source_records": total["largest_document_id"], "largest_title_records": total["largest_title_key"],
        "category_counts": {r["category"]: r["n"] for r in sorted(categories)}, "filters": limits, "rejections": dict(sorted(reasons.items())), "overlap_characters_removed": total["overlap_removed"],
    }


METADATA = ("domain", "category", "source_title", "section", "page_start", "page_end", "source_sha256", "rights_status", "chunk_uid", "quality_score")


def chat_lines(records: DataFrame, domain: str) -> DataFrame:
    """Training records as messages with a metadata struct; raises for another domain, short texts and repeats."""
    chat = training.chat_records(records.withColumn("trimmed", F.col("text")))
    training.check_chat(chat, domain)
    return chat.select("messages", F.struct(*METADATA, F.lit(TASK).alias("task")).alias("metadata"), "context", "answer")


def read_training_lines(spark: SparkSession, path: str) -> DataFrame:
    """Training records from JSON lines, empty ones left out; the first invalid line is an error that names it."""
    each = files.lines(spark, path).where(T.strip(F.col("value")) != "").withColumn("o", F.try_parse_json("value"))
    bad = each.where("o is null").agg(F.min("line").alias("line")).first()["line"]
    if bad is not None:
        raise ValueError(f"{path}:{bad}: invalid JSON")
    kinds = {"page_start": "int", "page_end": "int", "quality_score": "double"}
    return each.select("line", *[F.try_variant_get("o", f"$.{c}", kinds.get(c, "string")).alias(c) for c in RECORD])


def chat_report(chat: DataFrame, domain: str) -> dict:
    got = training.chat_report(chat).first()
    return {"domain": domain, "records": got["records"], "context_characters": got["context_chars"], "answer_characters": got["answer_chars"], "task": TASK, "format": FORMAT}


def model_data(spark: SparkSession, sources: dict[str, str], output: str, domain: str = "both", registry: dict | None = None, max_chars: int = C.RAG_CHARS, overlap: int = C.RAG_OVERLAP, min_quality: float = training.MIN_QUALITY, min_chars: int = training.MIN_CHARS, min_words: int = training.MIN_WORDS, cap: int = training.CAP) -> dict:
    """Builds and exports the domains in turn below output and returns the joint report.

    Tables are written by domain (documents, chunks, meta), records and chats as JSON lines.
    """
    wanted = check_limits(domain, max_chars, overlap, min_quality, min_chars, min_words, cap)
    report = {"schema_version": 1, "pipeline": "source-grounded-model-data", "policies": POLICIES, "domains": {}}
    limits = {"minimum_rag_quality": min_quality, "minimum_characters": min_chars, "minimum_words": min_words, "maximum_chunks_per_document": cap}
    for name in wanted:
        root = sources[name]
        found = files.extracted(files.scan(spark, root, NATIVE_SUFFIXES), registry)
        tables = build_tables(found, name, root, max_chars, overlap)
        place = f"{output}/{name}"
        for key, df in tables.items():
            df.write.mode("overwrite").parquet(f"{place}/{key}")
        documents, chunks, about = (spark.read.parquet(f"{place}/{k}") for k in ("documents", "chunks", "meta"))
        files.stored_domain(about, name)
        rows = stored(training_rows(documents, chunks, name, min_quality, min_chars, min_words, cap))
        records = training_records(rows)
        sinks.write_json_lines(records, f"{place}/model_enrichment")
        chat = stored(chat_lines(records, name))
        sinks.write_json_lines(chat.select("messages", "metadata"), f"{place}/messages")
        said = {r["key"]: r["value"] for r in about.where("key in ('stats_json', 'category_counts_json')").collect()}
        report["domains"][name] = {
            "rag": {"domain": name, "stats": json.loads(said["stats_json"]), "category_counts": json.loads(said["category_counts_json"])},
            "training": training_report(documents, chunks, rows, name, limits), "chat": chat_report(chat, name),
        }
    return report


# --- names and defaults -------------------------------------------------------------------------------------------


def cleaned_name(path: str) -> str:
    """Where the cleaned form of a data set goes."""
    for suffix in (".jsonl", ".json"):
        if path.endswith(suffix):
            return path[: -len(suffix)] + "_cleaned.jsonl"
    return f"{path}_cleaned.jsonl"


def first_folder(choices: list[str], exists: Callable[[str], bool]) -> str:
    """The first of the folders that exists; the first of all if none does."""
    return next((c for c in choices if exists(c)), choices[0])


def qa_paths(source: str, output: str, default_source: str, exports: str, results: str) -> tuple[str, str]:
    """Where questions are made from and go to: the default source means the exports, the exports mean the results."""
    plain = lambda p: p.rstrip("/")
    return (exports if plain(source) == plain(default_source) else source), (results if plain(output) == plain(exports) else output)


# --- one document.json, one chunk file and one report row for each source ---------------------------------------------

PARSED = (
    "status string, document_id string, parser_used string, extraction_methods array<string>, char_count int, block_count int, chunk_count int, diagnostic_count int, extraction_seconds double, error string, "
    f"value string, document {D.DOCUMENT}, chunks array<{C.CHUNK}>"
)


def native_document(path: str, suffix: str, sha256: str, raw: bytes, registry: dict | None = None) -> dict:
    """A document of a decoder's units: pages keep their numbers."""
    stem = path.rpartition("/")[2]
    found = formats.extract_document(suffix, stem, raw, registry)
    if found["error"]:
        raise ValueError(found["error"])
    document = D.new_document(path, sha256, mimetypes.guess_type(path)[0] or "application/octet-stream", metadata={"parser": "native"})
    for unit in found["units"]:
        start = document["id"] if unit["page"] is None else f"{document['id']}/page/{unit['page']}"
        document["blocks"] += D.blocks_of(C.blocks(unit["text"], start, unit["page"], unit["method"]), len(document["blocks"]) if unit["page"] is None else 0, start)
    document["metadata"]["extraction_methods"] = sorted({u["method"] for u in found["units"]})
    return document


def parsed(sources: DataFrame, parse: Callable[[str, str, str, bytes], dict] = native_document, size: int = C.IR_CHARS, overlap: int = C.IR_OVERLAP) -> DataFrame:
    """sources (source_id, suffix, source_sha256, content, ...) without content, with the columns of PARSED.

    parse gives one document of (path, suffix, hash, bytes): the native decoders', or any of the adapters of
    :mod:`tessella.sources.engines`. A file that cannot be parsed is a row with status failed and its error.
    """
    names = [c for c in sources.columns if c != "content"]
    fields = ("status", "document_id", "parser_used", "extraction_methods", "char_count", "block_count", "chunk_count", "diagnostic_count", "extraction_seconds", "error", "value", "document", "chunks")

    def one(path: str, suffix: str, sha256: str, raw: bytes) -> dict:
        began = time.perf_counter()
        row = dict.fromkeys(fields)
        try:
            document = parse(path, suffix, sha256, raw)
            found = C.packed_chunks(document["blocks"], document["id"], size, overlap)
            row |= {
                "status": "success", "document_id": document["id"], "parser_used": document["metadata"].get("parser", "native"), "extraction_methods": document["metadata"].get("extraction_methods", []), "char_count": len(D.document_text(document)),
                "block_count": len(document["blocks"]), "chunk_count": len(found), "diagnostic_count": len(document["diagnostics"]), "value": D.document_json(document), "document": D.as_row(document), "chunks": found,
            }
        except Exception as e:  # one bad file never stops a run
            row |= {"status": "failed", "error": f"{type(e).__name__}: {e}"}
        return row | {"extraction_seconds": round(time.perf_counter() - began, 6)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [one(*r) for r in zip(pdf["source_id"], pdf["suffix"], pdf["source_sha256"], map(bytes, pdf["content"]), strict=True)]
            out = pd.DataFrame({f: pd.Series([d[f] for d in found], dtype=object) for f in fields}, index=pdf.index)
            yield pd.concat([pdf[names], out], axis=1)

    return sources.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in sources.select(*names).schema), PARSED]))


def chunk_lines(rows: DataFrame) -> DataFrame:
    """The chunks of parsed documents as the columns of a chunk file, with the source's path."""
    each = rows.where("status = 'success'").select("source_id", F.posexplode("chunks").alias("pos", "c"))
    return each.select("source_id", "pos", "c.id", "c.document_id", F.col("source_id").alias("source_path"), "c.text", "c.pages", "c.block_ids", "c.block_types", "c.heading_path", "c.extraction_methods", "c.char_count")
