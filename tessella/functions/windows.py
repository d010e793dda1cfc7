"""Cutting texts: overlapping windows, summary pieces, Markdown sections and blocks, packed chunks.

Each text is cut by one task, texts in parallel; the functions are wrapped as Arrow UDFs that return arrays, so
that ``posexplode`` numbers the pieces, and as table functions for SQL.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from . import kernels as K

# Sizes in characters.
RAG_CHARS, RAG_OVERLAP = 3200, 320
IR_CHARS, IR_OVERLAP = 5000, 300
SUMMARY_CHARS = 5000

HEADING = re.compile(r"^\s{0,3}(?:#{1,6}\s+|={2,}\s*)(.+?)\s*$")
BLOCK_HEADING = re.compile(r"^\s{0,3}(#{1,6})\s+(.+?)\s*$")


def py_clean(text: str) -> str:
    lines = (re.sub("[ \t]+", " ", line).strip() for line in text.replace("\0", "").replace("\r\n", "\n").replace("\r", "\n").splitlines())
    return re.sub("\n{3,}", "\n\n", "\n".join(lines)).strip()


def _window_end(text: str, start: int, size: int) -> int:
    """Where the window from start ends: after its last paragraph, sentence, line or word in the second half.

    A paragraph end in the first half hides the other marks, and the window is cut at its size.
    """
    end = min(len(text), start + size)
    if end == len(text):
        return end
    for mark in ("\n\n", ". ", "\n", " "):
        at = text.rfind(mark, start, end)
        if at > start:
            return (at + 2 if text.startswith(". ", at) else at) if at > start + size // 2 else end
    return end


def chunk_windows(text: str, size: int = RAG_CHARS, overlap: int = RAG_OVERLAP) -> list[str]:
    """The text itself if it fits; else cleaned windows that overlap."""
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while True:
        end = _window_end(text, start, size)
        if piece := py_clean(text[start:end]):
            out.append(piece)
        if end >= len(text):
            return out
        start = max(start + 1, end - overlap)


def split_large(text: str, size: int = IR_CHARS, overlap: int = IR_OVERLAP, guard: bool = False) -> list[str]:
    """Pieces of one block, cut at its last paragraph, line or word; guard ignores marks within the overlap."""
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + size)
        if end < len(text):
            least = start + overlap if guard else start
            end = next((at for mark in ("\n\n", "\n", " ") if (at := text.rfind(mark, start, end)) > least), end)
        if piece := text[start:end].strip():
            out.append(piece)
        if end >= len(text):
            break
        start = max(start + 1, end - overlap)
    return out


def summary_pieces(text: str, size: int = SUMMARY_CHARS) -> list[str]:
    """Pieces without overlap; the character at a cut is dropped even where it is no line end."""
    out, start = [], 0
    while len(text) - start > size:
        at = next((p for mark in ("\n\n", "\n") if (p := text.rfind(mark, start, start + size)) > start), start + size)
        out.append(text[start:at].strip())
        start = at + 1
    tail = text[start:].strip()
    return [*out, tail] if tail else out


def sections(text: str) -> list[dict]:
    """Parts that begin at each heading, with the heading's text; fences are not looked at."""
    parts: list[tuple[str, list[str]]] = [("", [])]
    for line in text.splitlines():
        if m := HEADING.match(line):
            parts.append((m[1].strip(), []))
        parts[-1][1].append(line)
    return [{"section": s, "text": t} for s, lines in parts if (t := py_clean("\n".join(lines)))]


def is_table(text: str) -> bool:
    lines = [x for x in text.splitlines() if x.strip()]
    return len(lines) > 1 and min(x.count("|") for x in lines[:3]) >= 2


def blocks(text: str, document_id: str, page: int | None = None, method: str = "text") -> list[dict]:
    """Headings, fenced code, tables and paragraphs, each with the headings that it stands under."""
    found: list[tuple[str, str, list[str]]] = []
    path: list[str] = []
    open_lines: list[str] = []
    fenced = False

    def close(kind: str | None = None) -> None:
        body = "\n".join(open_lines).strip()
        open_lines.clear()
        if body:
            found.append((kind or ("table" if is_table(body) else "text"), body, path[:]))

    for line in (text or "").splitlines():
        fence = line.lstrip().startswith("```")
        if fenced:
            open_lines.append(line)
            if fence:
                close("code")
                fenced = False
        elif fence:
            close()
            open_lines.append(line)
            fenced = True
        elif m := BLOCK_HEADING.match(line):
            close()
            path = [*path[: len(m[1]) - 1], m[2].strip()]
            found.append(("section_header", line.strip(), path))
        elif line.strip():
            open_lines.append(line)
        else:
            close()
    close("code" if fenced else None)
    return [
        {"id": f"{document_id}/block/{i}", "block_type": kind, "text": body, "page": page, "heading_path": at, "extraction_method": method}
        for i, (kind, body, at) in enumerate(found)
    ]


def packed_chunks(block_rows: list[dict], document_id: str, size: int = IR_CHARS, overlap: int = IR_OVERLAP) -> list[dict]:
    """Blocks cut to size and packed in order; a chunk closes when the next piece would take it over size."""
    if size < 200 or not 0 <= overlap < size:
        raise ValueError("size must be at least 200, and overlap from 0 to below size")
    groups: list[list[tuple[str, dict]]] = [[]]
    used = 0
    for block in block_rows:
        for piece in split_large(block["text"].strip(), size, overlap):
            if groups[-1] and used + len(piece) > size:
                groups.append([])
                used = 0
            groups[-1].append((piece, block))
            used += len(piece) + 2
    out = []
    for i, group in enumerate(g for g in groups if g):
        body = "\n\n".join(p for p, _ in group).strip()
        own = [b for _, b in group]
        once = lambda k: list(dict.fromkeys(b[k] for b in own))  # noqa: E731, B023
        out.append({
            "id": "sha256:" + hashlib.sha256(f"{document_id}:{i}:{body}".encode()).hexdigest(), "document_id": document_id, "text": body, "block_ids": once("id"), "block_types": once("block_type"),
            "pages": sorted({b["page"] for b in own if b["page"] is not None}), "heading_path": next((list(b["heading_path"]) for b in reversed(own) if len(b["heading_path"])), []),
            "extraction_methods": once("extraction_method"), "char_count": len(body),
        })
    return out


BLOCK = "struct<id:string,block_type:string,text:string,page:int,heading_path:array<string>,extraction_method:string>"
CHUNK = "struct<id:string,document_id:string,text:string,block_ids:array<string>,block_types:array<string>,pages:array<int>,heading_path:array<string>,extraction_methods:array<string>,char_count:int>"


def _udf(make: Callable, returns: str):
    """make over rows of one or two columns, in slices of few characters: a worker never holds a batch's pieces as objects."""
    kind = to_arrow_type(DataType.fromDDL(returns))

    def run(*columns: list) -> pa.Array:
        return pa.array([make(*row) for row in zip(*columns, strict=True)], kind)

    return lambda n: K.arrow(run, returns, kind)


def windows_column(c: Column, size: int = RAG_CHARS, overlap: int = RAG_OVERLAP) -> Column:
    """chunk_windows of a text as an array; texts that fit never leave the JVM."""
    cut = _udf(lambda t: chunk_windows(t, size, overlap) if t is not None and len(t) > size else None, "array<string>")(1)
    return F.when(F.length(c) <= size, F.array(c)).otherwise(cut(F.when(F.length(c) > size, c)))


def split_large_column(c: Column, size: int = IR_CHARS, overlap: int = IR_OVERLAP, guard: bool = False) -> Column:
    return _udf(lambda t: split_large(t or "", size, overlap, guard), "array<string>")(1)(c)


def summary_column(c: Column, size: int = SUMMARY_CHARS) -> Column:
    return _udf(lambda t: summary_pieces(t or "", size), "array<string>")(1)(c)


def sections_column(c: Column) -> Column:
    return _udf(lambda t: sections(t or ""), "array<struct<section:string,text:string>>")(1)(c)


def blocks_column(c: Column, document_id: Column) -> Column:
    return _udf(lambda t, i: blocks(t, i), f"array<{BLOCK}>")(2)(c, document_id)


def tables_column(c: Column) -> Column:
    """How many of a text's blocks are tables; the blocks themselves stay where they are cut."""
    return _udf(lambda t: sum(b["block_type"] == "table" for b in blocks(t, "")), "int")(1)(c)


def chunks_column(c: Column, document_id: Column, size: int = IR_CHARS, overlap: int = IR_OVERLAP) -> Column:
    """The packed chunks of a text's blocks."""
    return _udf(lambda t, i: packed_chunks(blocks(t, i), i, size, overlap), f"array<{CHUNK}>")(2)(c, document_id)


def exploded(df: DataFrame, pieces: Column, at: str, piece: str) -> DataFrame:
    return df.select("*", F.posexplode(pieces).alias(at, piece))


def register(spark: SparkSession) -> None:
    """SQL table functions: chunk_windows(text, size, overlap) and blocks_from_text(text, id)."""

    @F.udtf(returnType="pos int, text string")
    class ChunkWindows:
        def eval(self, text: str, size: int, overlap: int) -> Iterator[tuple[int, str]]:
            yield from enumerate(chunk_windows(text or "", size, overlap))

    @F.udtf(returnType="pos int, block_type string, text string, heading_path array<string>")
    class BlocksFromText:
        def eval(self, text: str, document_id: str) -> Iterator[tuple]:
            for i, b in enumerate(blocks(text, document_id)):
                yield i, b["block_type"], b["text"], b["heading_path"]

    spark.udtf.register("chunk_windows", ChunkWindows)
    spark.udtf.register("blocks_from_text", BlocksFromText)
