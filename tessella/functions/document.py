"""The document model: one source as blocks with provenance, metadata and diagnostics, and its JSON form."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.parser import HTMLParser

from .windows import blocks

SCHEMA_VERSION = 1
DOCUMENT = (
    "struct<schema_version:int,id:string,source_path:string,source_name:string,source_sha256:string,media_type:string,metadata:string,diagnostics:array<struct<level:string,code:string,page:int,message:string>>,"
    "blocks:array<struct<id:string,block_type:string,text:string,page:int,bbox:array<double>,heading_path:array<string>,extraction_method:string,confidence:double,metadata:string>>>"
)


def diagnostic(level: str, code: str, message: str, page: int | None = None) -> dict:
    return {"level": level, "code": code, "page": page, "message": message}


def new_document(path: str, sha256: str, media_type: str, found: list[dict] | None = None, metadata: dict | None = None, diagnostics: list[dict] | None = None) -> dict:
    """A document whose id is its content's hash."""
    return {
        "schema_version": SCHEMA_VERSION, "id": f"sha256:{sha256}", "source_path": path, "source_name": path.rstrip("/").rpartition("/")[2], "source_sha256": sha256, "media_type": media_type,
        "metadata": dict(metadata or {}), "diagnostics": list(diagnostics or []), "blocks": [_block(b) for b in found or []],
    }


def _block(b: dict) -> dict:
    return {
        "id": b["id"], "block_type": b["block_type"], "text": b["text"], "page": b.get("page"), "bbox": b.get("bbox"), "heading_path": list(b.get("heading_path") or []),
        "extraction_method": b.get("extraction_method", "unknown"), "confidence": b.get("confidence"), "metadata": dict(b.get("metadata") or {}),
    }


def blocks_of(found: list[dict], first: int, prefix: str) -> list[dict]:
    """Blocks with all fields; their ids go on from `first`."""
    return [_block({**b, "id": f"{prefix}/block/{first + i}"}) for i, b in enumerate(found)]


def document_text(document: dict) -> str:
    return "\n\n".join(t for b in document["blocks"] if (t := b["text"].strip()))


def document_json(document: dict) -> str:
    """The published form, indented by two."""
    plain = {**document, "diagnostics": [{k: v for k, v in d.items() if v is not None} for d in document["diagnostics"]]}
    return json.dumps(plain, ensure_ascii=False, indent=2) + "\n"


def as_row(document: dict) -> dict:
    """For a column of type DOCUMENT: free-form metadata become JSON texts."""
    flat = lambda m: json.dumps(m, ensure_ascii=False, sort_keys=True)
    return {**document, "metadata": flat(document["metadata"]), "blocks": [{**b, "metadata": flat(b["metadata"])} for b in document["blocks"]]}


def text_document(path: str, sha256: str, media_type: str, text: str, method: str = "text", **metadata) -> dict:
    found = blocks(text, f"sha256:{sha256}", None, method)
    return new_document(path, sha256, media_type, found, {"extraction_methods": [method] if found else [], **metadata})


# --- pages --------------------------------------------------------------------------------------------------------

SPARSE = 50


def paged_document(path: str, sha256: str, media_type: str, pages: Callable[[], list[str]], ocr: Callable[[int], str] | None = None, whole_ocr: Callable[[], str] | None = None, native: str = "native", ocr_method: str = "ocr", most_ocr: int = 0) -> dict:
    """A document page by page; each sparse page is read by OCR alone, most_ocr pages at most (0: all).

    A failed page is a diagnostic; a file that cannot be opened falls back to OCR of the whole.
    """
    document = new_document(path, sha256, media_type)
    done, methods = 0, set()

    def put(text: str, method: str, page: int | None) -> None:
        own = blocks(text, document["id"] if page is None else f"{document['id']}/page/{page}", page, method)
        document["blocks"] += [_block(b) for b in own]
        if own:
            methods.add(method)

    try:
        texts = pages()
    except Exception as e:
        document["diagnostics"].append(diagnostic("error", "pdf_open_failed", str(e)))
        put(whole_ocr() if whole_ocr else "", ocr_method, None)
    else:
        document["metadata"]["page_count"] = len(texts)
        for i, text in enumerate(texts):
            method = native
            if len(text.strip()) < SPARSE and ocr and (not most_ocr or done < most_ocr):
                try:
                    seen = ocr(i)
                    done += 1
                    if seen and seen.strip():
                        text, method = seen, ocr_method
                    elif not text.strip():
                        document["diagnostics"].append(diagnostic("warning", "empty_page", "Neither the page's text nor OCR gave any text.", i + 1))
                except Exception as e:
                    document["diagnostics"].append(diagnostic("warning", "page_ocr_failed", str(e), i + 1))
            put(text, method, i + 1)
    document["metadata"] |= {"structured": False, "ocr_pages": done, "extraction_methods": sorted(methods)}
    return document


def structured_document(path: str, sha256: str, media_type: str, parse: Callable[[], str], otherwise: Callable[[], dict], method: str = "structured") -> dict:
    """Blocks of a layout model's Markdown; the page-wise document, with a diagnostic, where it gives nothing."""
    try:
        text = parse()
    except Exception:
        text = ""
    if text:
        return text_document(path, sha256, media_type, text, method, structured=True, extraction_method=method)
    document = otherwise()
    document["diagnostics"].insert(0, diagnostic("warning", "structured_parse_failed", "The layout model failed; pages were read one by one."))
    return document


def whole_text(pages: Callable[[], list[str]], ocr: Callable[[], str]) -> str:
    """All pages as one text; OCR of the whole if there are fewer than SPARSE characters a page, or if it cannot be opened."""
    try:
        texts = pages()
    except Exception:
        return ocr()
    text = "".join(texts)
    return ocr() if len(text.strip()) < SPARSE * len(texts) else text


# --- output of a layout parser ------------------------------------------------------------------------------------


class _Markdown(HTMLParser):
    """HTML as Markdown: headings, emphasis, links, code, lists, tables and paragraphs."""

    BREAKS = frozenset(("p", "div", "section", "article", "blockquote", "table", "ul", "ol", "pre"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.links: list[str] = []
        self.cells: list[str] | None = None
        self.rows = 0
        self.verbatim = self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "a":
            self.links.append(dict(attrs).get("href") or "")
            self.out.append("[")
        elif tag == "pre":
            self.verbatim += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.verbatim:
            self.out.append("`")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n" if len(self.lists) > 1 else "\n\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * (len(self.lists) - 1) + ("* " if kind[0] == "ul" else f"{kind[1]}. "))
        elif tag == "table":
            self.rows = 0
            self.out.append("\n\n")
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.cells = [] if self.cells is None else self.cells
            self.cells.append("")
            self.out.append("\0")
        elif tag in self.BREAKS:
            self.out.append("\n\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a" and self.links:
            self.out.append(f"]({self.links.pop()})")
        elif tag == "pre":
            self.verbatim = max(0, self.verbatim - 1)
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.verbatim:
            self.out.append("`")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n" if self.lists else "\n\n")
        elif tag in ("td", "th"):
            start = len(self.out) - 1 - self.out[::-1].index("\0") if "\0" in self.out else len(self.out)
            said = " ".join("".join(self.out[start + 1 :]).split())
            del self.out[start:]
            if self.cells:
                self.cells[-1] = said
        elif tag == "tr" and self.cells is not None:
            self.out.append("| " + " | ".join(self.cells) + " |\n")
            if not self.rows:
                self.out.append("| " + " | ".join("---" for _ in self.cells) + " |\n")
            self.rows, self.cells = self.rows + 1, None
        elif tag in self.BREAKS or re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.out.append(data if self.verbatim else re.sub(r"\s+", " ", data))


def html_to_markdown(html: str | None) -> str:
    parser = _Markdown()
    parser.feed(html or "")
    parser.close()
    text = re.sub(r"[ \t]*\n[ \t]*(?=\n)", "\n", "".join(parser.out).replace("\0", ""))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?m)^ (?=\S)|[ \t]+$", "", text)).strip()


def heading_level(html: str | None) -> int | None:
    found = re.search(r"<h([1-6])(?:\s|>)", html or "", re.IGNORECASE)
    return int(found[1]) if found else None


def field(item, name: str, default=None):
    """A field of a mapping or an attribute of an object, whichever the parser gives."""
    return item.get(name, default) if isinstance(item, dict) else getattr(item, name, default)


def mapping(value) -> dict:
    if value is None or isinstance(value, dict):
        return value or {}
    return value.model_dump() if hasattr(value, "model_dump") else dict(value)


def snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def layout_document(path: str, sha256: str, media_type: str, rendered, mode: str, parser: str = "marker") -> dict:
    """The flat blocks of a layout parser as a document.

    The headings above a block come from its own hierarchy (level -> id of a heading block, looked up in the document);
    where that names none, from the headings read so far. Pages count from 1. The default of parser is the fixed name
    that ids and methods carry.
    """
    items = list(field(rendered, "blocks") or [])
    is_heading = lambda x: str(field(x, "block_type", "Text")).lower() == "sectionheader"
    plain = lambda text: text.lstrip("# ").strip()
    titles = {str(field(x, "id", "")): plain(html_to_markdown(str(field(x, "html") or ""))) for x in items if is_heading(x)}
    document, trail = new_document(path, sha256, media_type), []
    for i, item in enumerate(items):
        own, html = str(field(item, "id", f"/block/{i}")), str(field(item, "html") or "")
        text = html_to_markdown(html)
        if not text:
            continue
        levels = sorted(mapping(field(item, "section_hierarchy")).items(), key=lambda p: int(p[0]) if str(p[0]).isdigit() else 99)
        above = [t for _, k in levels if (t := titles.get(str(k)))]
        if is_heading(item):
            trail = [*trail[: (heading_level(html) or 1) - 1], titles.get(own) or plain(text)]
        page, box = field(item, "page"), field(item, "bbox")
        document["blocks"].append(_block({
            "id": f"{document['id']}/{parser}{own}", "block_type": snake(str(field(item, "block_type", "Text"))), "text": text, "page": None if page is None else int(page) + 1,
            "bbox": None if box is None else [float(v) for v in box], "heading_path": above or list(trail), "extraction_method": f"{parser}-{mode}", "metadata": {f"{parser}_id": own, "html": html},
        }))
    document["metadata"] |= {"parser": parser, f"{parser}_mode": mode, "extraction_methods": [f"{parser}-{mode}"] if document["blocks"] else [], f"{parser}_metadata": mapping(field(rendered, "metadata"))}
    return document
