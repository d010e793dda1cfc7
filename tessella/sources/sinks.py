"""Published outputs: JSON lines, single files, tables, reports. Spark's committer makes each write all or nothing."""

from __future__ import annotations

import json
import os
import sqlite3
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def output_name(source_id: Column, kind: str) -> Column:
    """Side files keep the source's suffix, so that a.pdf and a.docx do not collide."""
    return F.concat(source_id, F.lit(f".{kind}"))


def as_json_lines(df: DataFrame, sort_keys: bool = False) -> DataFrame:
    """One JSON object a row, nulls kept."""
    columns = sorted(df.columns) if sort_keys else df.columns
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str, single: bool = False, sort_keys: bool = False) -> None:
    out = as_json_lines(df, sort_keys)
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)


def write_tables(tables: dict[str, DataFrame], root: str, partition: str | None = "domain") -> None:
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition) if partition in df.columns else writer).parquet(f"{root}/{name}")


def write_text_atomically(path: str, text: str) -> None:
    """A small driver-side file (reports, manifests): written beside its place, then moved there."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=folder, prefix=f".{os.path.basename(path)}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def write_json(found: dict, path: str, sort_keys: bool = False) -> None:
    write_text_atomically(path, json.dumps(found, ensure_ascii=False, indent=2, sort_keys=sort_keys) + "\n")


def write_report(row: DataFrame, path: str) -> dict:
    """A one-row report as JSON."""
    found = json.loads(row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])
    write_json(found, path)
    return found


def run_report(results: DataFrame, configuration: dict, elapsed_seconds: float) -> dict:
    """A run as one object: its settings, the summary, and a row for each document (status, counts, seconds, error).

    Characters and chunks are added up over successes only. The rows are the report itself, so it is for runs whose
    documents one file can list; the summary alone comes from :func:`tessella.operators.scoring.run_summary`.
    """
    rows = [json.loads(r[0]) for r in results.orderBy("source_id").select(F.to_json(F.struct("*"))).toLocalIterator()]
    good = [r for r in rows if r.get("status") == "success"]
    summary = {"document_count": len(rows), **{s: sum(r.get("status") == s for r in rows) for s in ("success", "skipped", "failed")}, "total_characters": sum(r.get("char_count") or 0 for r in good), "total_chunks": sum(r.get("chunk_count") or 0 for r in good)}
    return {"schema_version": 1, "configuration": configuration, "elapsed_seconds": round(elapsed_seconds, 6), "summary": summary, "documents": rows}


def write_cleaned(rows: DataFrame, values: DataFrame, output: str, stem: str, report: dict) -> dict:
    """Kept lines as they were, rejected lines with their reasons, and the report, of one cleaning run.

    rows: line, instruction, reasons; values: line, value.
    """
    kept = values.join(rows.where(F.size("reasons") == 0).select("line"), "line", "left_semi").orderBy("line")
    kept.select("value").write.mode("overwrite").text(f"{output}/{stem}.clean.jsonl")
    write_json_lines(rows.where(F.size("reasons") > 0).orderBy("line").select("line", "reasons", "instruction"), f"{output}/{stem}.rejected.jsonl")
    write_json(report, f"{output}/{stem}.cleaning-report.json")
    return report


def write_documents(documents: DataFrame, path: str) -> None:
    """document.json texts (source_id, value) as files' lines: one line a document, its source beside it."""
    documents.select("source_id", "value").write.mode("overwrite").json(path)


def qa_markdown(pairs: DataFrame, path: str, heading: str = "source_id") -> None:
    """Pairs as one Markdown file for each source, led by its name as a heading."""
    blocks = F.concat(F.lit("**Q: "), F.trim("question"), F.lit("**\n\n**A:** "), F.trim("answer"), F.lit("\n\n---\n"))
    by_file = pairs.select(heading, F.struct("pos", blocks.alias("b")).alias("s")).groupBy(heading).agg(F.array_sort(F.collect_list("s")).alias("s"))
    text = F.concat(F.lit("# "), F.col(heading), F.lit("\n\n"), F.array_join(F.transform("s", lambda x: x["b"]), "\n"))
    by_file.select(F.col(heading).alias("source_id"), text.alias("value")).write.mode("overwrite").partitionBy("source_id").text(path)


def export_sqlite(tables: dict[str, DataFrame], path: str, search: tuple[str, str] | None = ("chunks", "text")) -> None:
    """Tables as one SQLite file, streamed row by row through the driver; for hand-over of small builds."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, temporary = tempfile.mkstemp(dir=folder, prefix=f".{os.path.basename(path)}.")
    os.close(handle)
    try:
        db = sqlite3.connect(temporary)
        for name, df in tables.items():
            names = ", ".join(f'"{c}"' for c in df.columns)
            db.execute(f'CREATE TABLE "{name}" ({names})')
            rows: Iterable[tuple] = (tuple(r) for r in df.toLocalIterator())
            db.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(df.columns))})', rows)
        if search and search[0] in tables:
            table, column = search
            db.execute(f'CREATE VIRTUAL TABLE "{table}_fts" USING fts5("{column}", content="{table}", tokenize="unicode61 remove_diacritics 2")')
            db.execute(f'INSERT INTO "{table}_fts"("{table}_fts") VALUES (\'rebuild\')')
        db.commit()
        db.close()
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise
