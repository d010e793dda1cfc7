"""Decoders from bytes to text units, by file suffix, in plain Python on the standard library.

Formats that need a model or an external program (PDF, OCR, speech, legacy office files, archives of images) are
injected: ``DECODERS`` is a registry, and :func:`with_decoder` adds to a copy of it. A decoder maps bytes to units;
it may raise, which :func:`extract` turns into an error beside an empty text, so one bad file never stops a run.
"""

from __future__ import annotations

import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable
from html.parser import HTMLParser

from ..functions.windows import py_clean, sections

# Suffixes that are read, and how the method is labelled.
DOCUMENT_SUFFIXES = (
    ".txt", ".md", ".rst", ".docx", ".pdf", ".cbz", ".cbr", ".doc", ".pptx", ".xls", ".xlsx", ".html", ".htm", ".chm",
    ".epub", ".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tiff", ".tif",
)
AUDIO_SUFFIXES = (".mp3", ".wav", ".ogg", ".flac", ".m4a", ".wma", ".aac")
VIDEO_SUFFIXES = (".mp4", ".mkv", ".avi", ".mov", ".webm", ".flv", ".wmv")
HIDDEN_TAGS = ("script", "style", "noscript", "template")
TITLE_TAGS = ("h1", "h2", "h3", "title")

Unit = dict  # text, page (or None), section, and method where a decoder says it
METHODS = {
    **dict.fromkeys((".txt", ".md", ".rst"), "plain-text"), **dict.fromkeys((".html", ".htm"), "html-text"), ".epub": "epub-zip", ".pptx": "pptx-xml", ".docx": "docx-xml", ".xlsx": "xlsx-xml",
    ".doc": "antiword", ".pdf": "pdf-native",
}


def decode(raw: bytes) -> str:
    """UTF-8 with or without a mark, else Windows-1252, else Latin-1."""
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.hidden: list[str] = []
        self.heading: str | None = None
        self.headings: dict[str, str] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in HIDDEN_TAGS:
            self.hidden.append(tag)
        elif tag in TITLE_TAGS:
            self.heading = tag

    def handle_endtag(self, tag: str) -> None:
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass
        elif tag == self.heading:
            self.heading = None

    def handle_data(self, data: str) -> None:
        if self.hidden or not (piece := data.strip()):
            return
        self.texts.append(piece)
        if self.heading:
            self.headings.setdefault(self.heading, piece)


def html_parts(html: str) -> tuple[str, str]:
    """(visible text, a line for each text node; the first h1, h2, h3 or title, in this order)."""
    parser = _Visible()
    parser.feed(html or "")
    parser.close()
    return "\n".join(parser.texts), next((parser.headings[t] for t in TITLE_TAGS if t in parser.headings), "")


def _unit(text: str, page: int | None = None, section: str = "") -> list[Unit]:
    cleaned = py_clean(text)
    return [{"text": cleaned, "page": page, "section": section}] if cleaned else []


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def read_plain(raw: bytes) -> list[Unit]:
    return [{"text": s["text"], "page": None, "section": s["section"]} for s in sections(decode(raw))]


def read_html(raw: bytes) -> list[Unit]:
    text, heading = html_parts(decode(raw))
    return _unit(text, section=heading)


def _spine(archive: zipfile.ZipFile) -> list[str]:
    """The pages of an e-book in reading order; all HTML members by name if the order cannot be read."""
    try:
        package = next(e.attrib["full-path"] for e in ET.fromstring(archive.read("META-INF/container.xml")).iter() if _local(e.tag) == "rootfile")
        tree = ET.fromstring(archive.read(package))
        place = {e.attrib["id"]: posixpath.normpath(posixpath.join(posixpath.dirname(package), e.attrib["href"])) for e in tree.iter() if _local(e.tag) == "item"}
        names = [place[e.attrib["idref"]] for e in tree.iter() if _local(e.tag) == "itemref" and e.attrib["idref"] in place]
        if names:
            return [n for n in names if n in archive.namelist()]
    except (KeyError, StopIteration, ET.ParseError):
        pass
    return sorted(n for n in archive.namelist() if n.lower().endswith((".html", ".htm", ".xhtml")))


def read_epub(raw: bytes) -> list[Unit]:
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        pages = [html_parts(decode(archive.read(n))) for n in _spine(archive)]
    return [u for text, heading in pages for u in _unit(text, section=heading)]


def read_pptx(raw: bytes) -> list[Unit]:
    """A unit for each slide with text; slides in the order of their names as strings, so slide10 is before slide2."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        slides = sorted(n for n in archive.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n))
        texts = ["\n".join(e.text for e in ET.fromstring(archive.read(n)).iter() if e.tag.endswith("}t") and e.text) for n in slides]
    return [u for i, t in enumerate(texts, 1) for u in _unit(t, page=i, section=f"Slide {i}")]


def read_docx(raw: bytes) -> list[Unit]:
    """Paragraphs outside tables, then the tables, rows as cells joined by ' | ', parted by empty lines."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        root = ET.fromstring(archive.read("word/document.xml"))
    said = lambda e: "".join(t.text or "" for t in e.iter() if _local(t.tag) == "t")
    body = next(e for e in root.iter() if _local(e.tag) == "body")
    parts = [t for e in body if _local(e.tag) == "p" and (t := said(e)).strip()]
    for table in (e for e in body if _local(e.tag) == "tbl"):
        rows = [[said(c).strip() for c in r if _local(c.tag) == "tc"] for r in table.iter() if _local(r.tag) == "tr"]
        parts += [" | ".join(r) for r in rows if any(r)]
    return _unit("\n\n".join(parts))


def read_xlsx(raw: bytes) -> list[Unit]:
    """A unit for each sheet: cell values of a row parted by tabs."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        names = archive.namelist()
        shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in e.iter() if _local(t.tag) == "t") for e in ET.fromstring(archive.read("xl/sharedStrings.xml"))]
        titles = [e.attrib["name"] for e in ET.fromstring(archive.read("xl/workbook.xml")).iter() if _local(e.tag) == "sheet"] if "xl/workbook.xml" in names else []
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        trees = [ET.fromstring(archive.read(n)) for n in sheets]

    def value(cell: ET.Element) -> str:
        text = "".join(t.text or "" for t in cell.iter() if _local(t.tag) in ("v", "t"))
        return shared[int(text)] if cell.attrib.get("t") == "s" and text else text

    out = []
    for i, tree in enumerate(trees):
        title = titles[i] if i < len(titles) else f"Sheet{i + 1}"
        lines = ["\t".join(value(c) for c in row if _local(c.tag) == "c") for row in tree.iter() if _local(row.tag) == "row"]
        out += _unit("\n".join([f"Sheet: {title}", *lines]), section=title)
    return out


Decoder = Callable[[bytes], list[Unit]]
DECODERS: dict[str, Decoder] = {
    **dict.fromkeys((".txt", ".md", ".rst"), read_plain), **dict.fromkeys((".html", ".htm"), read_html),
    ".epub": read_epub, ".pptx": read_pptx, ".docx": read_docx, ".xlsx": read_xlsx,
}


def with_decoder(suffixes: tuple[str, ...], *choices: Decoder, base: dict[str, Decoder] | None = None) -> dict[str, Decoder]:
    """A registry with further decoders; of several, the first that finds text is taken (OCR engines, fallbacks)."""

    def first(raw: bytes) -> list[Unit]:
        error = None
        for choice in choices:
            try:
                if units := choice(raw):
                    return units
            except Exception as e:  # the next choice may do better
                error = e
        if error:
            raise error
        return []

    return {**(DECODERS if base is None else base), **dict.fromkeys(suffixes, first)}


def pages_decoder(page_texts: Callable[[bytes], list[str]], ocr_page: Callable[[bytes, int], str] | None = None, least: int = 50, most_pages: int = 0) -> Decoder:
    """Units by page from an injected reader; pages with few characters go to OCR, at most most_pages of them (0: all)."""

    def read(raw: bytes) -> list[Unit]:
        out, used = [], 0
        for i, text in enumerate(page_texts(raw)):
            if len(text.strip()) < least and ocr_page and (not most_pages or used < most_pages):
                used += 1
                text = ocr_page(raw, i) or text
            out += _unit(text, page=i + 1)
        return out

    return read


def zip_members(raw: bytes) -> dict[str, Callable[[], bytes]]:
    archive = zipfile.ZipFile(io.BytesIO(raw))
    return {n: lambda n=n: archive.read(n) for n in archive.namelist()}


def images_in_archive(ocr: Callable[[bytes], str], members: Callable[[bytes], dict[str, Callable[[], bytes]]] = zip_members) -> Decoder:
    """Comic archives: the images by name, each through an injected reader. members opens other archives than zip."""

    def read(raw: bytes) -> list[Unit]:
        found = members(raw)
        names = sorted(n for n in found if n.lower().endswith((".png", ".jpg", ".jpeg", ".webp", ".bmp", ".gif")))
        return [u for i, n in enumerate(names, 1) for u in _unit(ocr(found[n]()), page=i)]

    return read


def extract_document(suffix: str, stem: str, raw: bytes, registry: dict[str, Decoder] | None = None) -> dict:
    """{title, units (with method), page_count, parser, diagnostics, error}; a decoder may give all of these, or units alone."""
    whole = {"title": stem, "units": [], "page_count": None, "parser": None, "diagnostics": [], "error": None}
    reader = (DECODERS if registry is None else registry).get(suffix)
    if reader is None:
        return whole | {"error": f"ValueError: Unsupported extension: {suffix}"}
    try:
        found = reader(raw)
    except Exception as e:
        return whole | {"error": f"{type(e).__name__}: {e}"}
    method = METHODS.get(suffix, suffix.lstrip("."))
    whole |= {"parser": method} | (found if isinstance(found, dict) else {"units": found})
    if suffix == ".pptx" and whole["page_count"] is None:
        whole["page_count"] = len(whole["units"])
    whole["units"] = [{"text": u["text"], "page": u.get("page"), "section": u.get("section") or "", "method": u.get("method") or method} for u in whole["units"] if u["text"]]
    return whole


def extract(suffix: str, raw: bytes, registry: dict[str, Decoder] | None = None) -> tuple[list[Unit], str | None]:
    """(units, error)."""
    reader = (DECODERS if registry is None else registry).get(suffix)
    if reader is None:
        return [], f"unsupported: {suffix}"
    try:
        return reader(raw), None
    except Exception as e:
        return [], f"{type(e).__name__}: {e}"
