"""Files as DataFrames: recursive scans with content hashes, decoding, JSON lines, instruction records."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import text as T
from ..functions import windows as C
from . import formats

UNITS = "array<struct<text:string,page:int,section:string>>"
EXTRACTED = "title string, units array<struct<text:string,page:int,section:string,method:string>>, page_count int, parser string, diagnostics array<string>, error string"


def suffix_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def path_order(path: Column) -> Column:
    """Paths sort by their components, not as strings."""
    return F.split(path, "/")


def kind_of(suffix: Column) -> Column:
    return F.when(suffix.isin(*formats.DOCUMENT_SUFFIXES), "document").when(suffix.isin(*formats.AUDIO_SUFFIXES), "audio").when(suffix.isin(*formats.VIDEO_SUFFIXES), "video")


def scan(spark: SparkSession, root: str, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """source_id (path below root), suffix, content, sha256, length of every file of the wanted suffixes."""
    wanted = suffixes or (*formats.DOCUMENT_SUFFIXES, *formats.AUDIO_SUFFIXES, *formats.VIDEO_SUFFIXES)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    plain = root.split("://", 1)[-1].removeprefix("file:")
    return found.select(
        T.relative_path(F.regexp_replace("path", "^[a-z]+:/*", "/"), "/" + plain.strip("/")).alias("source_id"), suffix_of(F.col("path")).alias("suffix"), "content", F.sha2("content", 256).alias("source_sha256"), "length",
    ).where(F.col("suffix").isin(*wanted))


def decoded(files: DataFrame, registry: dict | None = None) -> DataFrame:
    """files without content, with units and error."""
    names = [c for c in files.columns if c != "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [formats.extract(s, bytes(raw), registry) for s, raw in zip(pdf["suffix"], pdf["content"], strict=True)]
            yield pdf[names].assign(units=[u for u, _ in found], error=[e for _, e in found])

    schema = files.select(*names, F.lit(None).cast(UNITS).alias("units"), F.lit(None).cast("string").alias("error")).schema
    return files.mapInPandas(run, schema)


def extracted(files: DataFrame, registry: dict | None = None) -> DataFrame:
    """files (source_id, suffix, content, ...) without content, with the columns of EXTRACTED. One pass, no shuffle of bytes."""
    names = [c for c in files.columns if c != "content"]
    fields = [f.split()[0] for f in EXTRACTED.replace("struct<text:string,page:int,section:string,method:string>", "x").split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            stems = (s.rpartition("/")[2] for s in pdf["source_id"])
            found = [formats.extract_document(x, s[: s.rindex(".")] if "." in s[1:] else s, bytes(raw), registry) for x, s, raw in zip(pdf["suffix"], stems, pdf["content"], strict=True)]
            out = pd.DataFrame({f: pd.Series([d[f] for d in found], dtype=object) for f in fields}, index=pdf.index)
            yield pd.concat([pdf[names], out], axis=1)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in files.select(*names).schema), EXTRACTED])
    return files.mapInPandas(run, schema)


_PARTS = pa.struct([("text", pa.string()), ("heading", pa.string())])


def _html_parts(html: list) -> pa.Array:
    return pa.array([dict(zip(("text", "heading"), formats.html_parts(h), strict=True)) for h in html], _PARTS)


def _decoded_bytes(content: pd.Series) -> pd.Series:
    return content.map(lambda raw: None if raw is None else formats.decode(bytes(raw)))


def html_parts(html: Column) -> Column:
    """struct<text, heading>: visible text and first heading of a page."""
    return K.arrow(_html_parts, "struct<text:string,heading:string>", _PARTS)(html)


def decode_bytes(content: Column) -> Column:
    return F.pandas_udf(_decoded_bytes, "string")(content)


def lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """source_id, line (from 1, empty ones counted), value. A byte order mark is dropped unless strict."""
    # lines are read as lines, so no file is one row; their numbers follow from where each part of a file starts
    each = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_id"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"), F.regexp_replace("value", "\r$", "").alias("value"),
    )
    parts = each.groupBy("source_id", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("source_id").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    known = parts.select("source_id", "_start", "_first", before.alias("_before"))
    out = each.join(known, ["source_id", "_start"]).withColumn("line", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int"))
    value = F.col("value") if strict else F.when(F.col("line") == 1, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return out.select("source_id", "line", value.alias("value"))


def json_objects(each: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects: with value as VARIANT; rejected: invalid JSON and what is no object). Empty lines are left out."""
    parsed = each.where(T.strip(F.col("value")) != "").withColumn("object", F.try_parse_json("value"))
    good = F.coalesce(F.schema_of_variant("object").startswith("OBJECT"), F.lit(False))
    return parsed.where(good).drop("value"), parsed.where(~good).drop("object")


ALPACA = "instruction string, input string, output string, _meta variant"


def alpaca_records(spark: SparkSession, path: str) -> DataFrame:
    """Instruction records from a JSON array or JSON lines, whichever the file's first character says."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_id"), F.regexp_replace("value", "^﻿", "").alias("value"))
    is_array = T.lstrip(F.col("value")).startswith("[")
    arrays = whole.where(is_array).select("source_id", F.posexplode(F.from_json("value", "array<variant>")).alias("at", "object"))
    rows = whole.where(~is_array).select("source_id", F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).select("source_id", "at", F.try_parse_json("line").alias("object"))
    both = arrays.unionByName(rows).where(F.coalesce(F.schema_of_variant("object").startswith("OBJECT"), F.lit(False)))
    return both.select("source_id", "at", *[F.try_variant_get("object", f"$.{c}", "string").alias(c) for c in ("instruction", "input", "output")], F.try_variant_get("object", "$._meta", "variant").alias("_meta"))


def chunk_records(spark: SparkSession, path: str) -> DataFrame:
    """Chunk lines with provenance; malformed lines are fatal, blank texts are left out."""
    schema = "id string, document_id string, source_path string, text string, pages array<int>, block_ids array<string>, heading_path array<string>"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).where(T.strip(F.coalesce(F.col("text"), F.lit(""))) != "")


def summary_records(spark: SparkSession, path: str, size: int = C.SUMMARY_CHARS) -> DataFrame:
    """Pieces of summaries, without provenance: source_id, pos, text."""
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("source_id"), F.regexp_replace("value", "^﻿", "").alias("value"))
    return C.exploded(whole, C.summary_column(F.col("value"), size), "pos", "text").drop("value")


def input_format(paths: list[str], wanted: str = "auto") -> tuple[str, list[str]]:
    """(format, its files in order): chunk lines if there are any, else summaries, unless one is asked for."""
    chunks = sorted(p for p in paths if p.lower().endswith(".chunks.jsonl"))
    summaries = sorted(p for p in paths if p.lower().endswith(".md"))
    if wanted not in ("auto", "chunks", "summaries"):
        raise ValueError("the format must be auto, chunks or summaries")
    kind = ("chunks" if chunks else "summaries") if wanted == "auto" else wanted
    return kind, chunks if kind == "chunks" else summaries


def sqlite_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A table of a SQLite file, read by one task on a node that sees the file: such files are small hand-overs.

    Builds of this engine keep the same tables as Parquet; those are read in parallel.
    """
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file in pdf["path"]:
                db = sqlite3.connect(f"file:{file}?mode=ro", uri=True)
                try:
                    for part in pd.read_sql_query(f"SELECT {', '.join(columns)} FROM {name}", db, chunksize=10_000, dtype=object):  # noqa: S608
                        yield part
                finally:
                    db.close()

    return spark.range(1, numPartitions=1).select(F.lit(path).alias("path")).mapInPandas(run, schema)


def stored_domain(meta: DataFrame, expected: str | None = None) -> str:
    """The domain a build says it has; an error if it has none, or not the one that is expected."""
    found = [r[0] for r in meta.where(F.col("key") == "domain").select("value").limit(2).collect()]
    if len(found) != 1 or found[0] not in ("cyber", "finance"):
        raise ValueError("the build has no valid domain")
    if expected is not None and found[0] != expected:
        raise ValueError(f"the build is of domain {found[0]!r}, not {expected!r}")
    return found[0]


def indexed_chunks(documents: DataFrame, chunks: DataFrame, min_quality: float) -> DataFrame:
    """Chunks of sufficient quality beside their documents' columns; documents that are not indexed have none."""
    docs = documents.where("extraction_status = 'indexed'").select("document_id", "document_uid", "title", "category", "source_sha256", "rights_status")
    own = [c for c in chunks.columns if c == "document_id" or c not in docs.columns]
    return chunks.where(F.col("quality_score") >= min_quality).select(*own).join(docs, "document_id")


CASE = (
    "id string, path string, required_phrases array<string>, forbidden_phrases array<string>, min_chars int, expected_pages array<int>, expected_block_types array<string>, reference_text string"
)


def benchmark_cases(spark: SparkSession, path: str, base: str) -> DataFrame:
    """The cases of a manifest of JSON lines, in order; # starts a comment. Paths are resolved against base.

    Invalid JSON, a missing path, a negative length, repeated ids and an empty manifest are errors.
    """
    each = lines(spark, path).withColumn("value", T.strip(F.col("value"))).where("value <> '' and not startswith(value, '#')")
    told = each.withColumn("o", F.try_parse_json("value"))
    text = lambda k: F.try_variant_get("o", f"$.{k}", "string")
    several = lambda k, kind: F.coalesce(F.try_variant_get("o", f"$.{k}", f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    resolved = lambda p: F.when(p.isNull() | p.startswith("/"), p).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), p))
    found = told.select(
        "line", F.col("o").isNull().alias("bad"), F.coalesce(F.when(text("id") != "", text("id")), F.concat(F.lit("case-"), F.col("line").cast("string"))).alias("id"), resolved(F.when(text("path") != "", text("path"))).alias("path"),
        several("required_phrases", "string").alias("required_phrases"), several("forbidden_phrases", "string").alias("forbidden_phrases"), F.try_variant_get("o", "$.min_chars", "int").alias("min_chars"),
        several("expected_pages", "int").alias("expected_pages"), F.transform(several("expected_block_types", "string"), F.lower).alias("expected_block_types"), resolved(text("reference_text")).alias("reference_text"),
    ).collect()
    # a manifest is a short list that somebody wrote
    for r in sorted(found, key=lambda r: r["line"]):
        if r["bad"]:
            raise ValueError(f"{path}:{r['line']}: invalid JSON")
        if r["path"] is None:
            raise ValueError(f"{path}:{r['line']}: missing 'path'")
        if r["min_chars"] is not None and r["min_chars"] < 0:
            raise ValueError(f"{r['id']}: min_chars must be non-negative")
    if not found:
        raise ValueError(f"no benchmark cases in {path}")
    if len({r["id"] for r in found}) < len(found):
        raise ValueError("repeated case ids")
    names = [c.split()[0] for c in CASE.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in sorted(found, key=lambda r: r["line"])], CASE)


def parser_list(value: str, known: tuple[str, ...] = ("native", "marker", "auto")) -> list[str]:
    """Comma-separated parser names, each once, in order."""
    names = list(dict.fromkeys(x.strip() for x in value.split(",") if x.strip()))
    if not names or not set(names) <= set(known):
        raise ValueError(f"parsers must be comma-separated values from {known}")
    return names


def stem_index(paths: DataFrame, path: str = "source_id") -> DataFrame:
    """(stem, path): of each case-folded stem the first path."""
    return paths.groupBy(T.casefold(stem_of(F.col(path))).alias("stem")).agg(F.min_by(path, path_order(F.col(path))).alias("path"))
