"""Adapters for what runs outside Spark: OCR, speech, layout parsers, external programs. Every engine is injected.

An engine is made once in each Python worker and again only when its settings change; a probe of what is installed is
asked once. Adapters turn engines into decoders (bytes -> units) or documents; failures become diagnostics or errors
beside an empty text, so that one bad file never stops a run.
"""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from functools import lru_cache

from ..functions import document as D
from ..functions.windows import py_clean
from . import formats

# Bounds and defaults of the settings.
DPI, PAGE_CHARS, PROGRAM_SECONDS, MEDIA_SECONDS, NO_TRACK_BYTES = (72, 600), 50, 120, 300, 1024
PARSERS, LAYOUT_MODES = ("native", "marker", "auto"), ("fast", "balanced")
LAYOUT_SUFFIXES = (".pdf", ".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tiff", ".tif", ".docx", ".pptx", ".xlsx", ".html", ".htm", ".epub")


@dataclass(frozen=True)
class Settings:
    """What bears on extracted text; :meth:`as_dict` goes into the fingerprint of incremental runs."""

    ocr_engine: str = "tesseract"
    ocr_device: str = "cpu"
    ocr_lang: str = "en"
    ocr_dpi: int = 200
    ocr_max_pages: int = 0
    whisper_model: str = "base"
    whisper_device: str = "cpu"
    whisper_lang: str | None = None

    def ocr(self, **values) -> Settings:
        """With other OCR settings; the resolution is held within DPI and the page limit at 0 or more."""
        new = replace(self, **{f"ocr_{k}": v for k, v in values.items()})
        return replace(new, ocr_dpi=max(DPI[0], min(DPI[1], new.ocr_dpi)), ocr_max_pages=max(0, new.ocr_max_pages))

    def speech(self, **values) -> Settings:
        return replace(self, **{f"whisper_{k}": v for k, v in values.items()})

    def as_dict(self) -> dict:
        return asdict(self)


@lru_cache(maxsize=16)
def engine(make: Callable, *settings):
    """make(*settings), once in each worker for these settings."""
    return make(*settings)


@lru_cache(maxsize=64)
def has_program(name: str) -> bool:
    return shutil.which(name) is not None


@lru_cache(maxsize=64)
def has_module(name: str) -> bool:
    from importlib.util import find_spec

    return find_spec(name) is not None


def run_program(argv: list[str], seconds: int = PROGRAM_SECONDS) -> str:
    done = subprocess.run(argv, capture_output=True, timeout=seconds, check=True)
    return formats.decode(done.stdout)


def file_decoder(read: Callable[[str], str], suffix: str) -> formats.Decoder:
    """A decoder from a function of a path: the bytes go to a file of this worker's own, which is removed again."""

    def decode(raw: bytes) -> list[dict]:
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, f"file{suffix}")
            with open(path, "wb") as f:
                f.write(raw)
            text = py_clean(read(path))
        return [{"text": text, "page": None, "section": ""}] if text else []

    return decode


def legacy_doc(program: tuple[str, ...] = ("antiword",), seconds: int = PROGRAM_SECONDS) -> formats.Decoder:
    """Old Word files by an external program that prints the text."""
    return file_decoder(lambda path: run_program([*program, path], seconds), ".doc")


def help_archive(program: tuple[str, ...] = ("7z", "x", "-y"), into: str = "-o", seconds: int = PROGRAM_SECONDS) -> formats.Decoder:
    """Compiled help: an external program unpacks it; its pages by name, each under a heading with its name."""

    def read(path: str) -> str:
        with tempfile.TemporaryDirectory() as folder:
            run_program([*program, path, f"{into}{folder}"], seconds)
            pages = sorted(os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.lower().endswith((".html", ".htm")))
            parts = []
            for page in pages:
                with open(page, "rb") as f:
                    text, _ = formats.html_parts(formats.decode(f.read()))
                if text:
                    parts.append(f"# {os.path.basename(page)}\n\n{text}")
        return "\n\n".join(parts)

    return file_decoder(read, ".chm")


def workbook(sheets: Callable[[bytes], list[tuple[str, list[list]]]]) -> formats.Decoder:
    """Workbooks of any format by a reader of (name, rows): a unit for each sheet, cells parted by tabs."""

    def decode(raw: bytes) -> list[dict]:
        out = []
        for name, rows in sheets(raw):
            text = py_clean("\n".join([f"Sheet: {name}", *("\t".join("" if v is None else str(v) for v in row) for row in rows)]))
            out.append({"text": text, "page": None, "section": name})
        return out

    return decode


# --- OCR ----------------------------------------------------------------------------------------------------------


def joined_lines(lines: list[str]) -> str:
    return "\n".join(s for x in lines if x and (s := x.strip()))


def read_image(image: bytes, primary: Callable[[bytes], str], other: Callable[[bytes], str] | None = None) -> str:
    """The first engine's text, or the other's if that is empty or fails; empty if both do."""
    for read in (primary, other):
        try:
            if read and (text := read(image)) and text.strip():
                return text
        except Exception:  # the other engine may do better
            continue
    return ""


def ocr_pages(raw: bytes, render: Callable[[bytes, int, int], bytes | None], read: Callable[[bytes], str], settings: Settings, count: int) -> str:
    """The pages of a scan, rendered and read one at a time, so that one image is held at once."""
    most = min(count, settings.ocr_max_pages or count)
    texts = []
    for i in range(most):
        try:
            image = render(raw, i, settings.ocr_dpi)
            texts.append(read(image) if image else "")
        except Exception:  # the other pages are still read
            texts.append("")
    return "\n".join(t for t in texts if t.strip())


# --- PDF ----------------------------------------------------------------------------------------------------------


def without_boilerplate(pages: list[str], share: float = 0.20, least: int = 3) -> list[str]:
    """Pages without the lines (of 3 to 120 characters, told apart by their canonical form) that many of them have."""
    canonical = lambda line: " ".join(line.split()).casefold()
    counts: dict[str, int] = {}
    for page in pages:
        for line in {c for x in page.splitlines() if 3 <= len(c := canonical(x)) <= 120}:
            counts[line] = counts.get(line, 0) + 1
    limit = max(least, -(-len(pages) * share // 1))
    common = {line for line, n in counts.items() if n >= limit}
    return ["\n".join(x for x in page.splitlines() if canonical(x) not in common) for page in pages]


def pdf_units(raw: bytes, stem: str, open_pages: Callable[[bytes], tuple[str | None, list]], method: str = "pdf-native") -> dict:
    """{title, units, page_count, parser, diagnostics}: sorted native text by page, without boilerplate.

    open_pages gives the title in the file's metadata and a text, or the exception that reading it raised, for each page.
    """
    title, found = open_pages(raw)
    diagnostics = [f"page_{i}: {p}" for i, p in enumerate(found, 1) if isinstance(p, Exception)]
    pages = without_boilerplate(["" if isinstance(p, Exception) else p for p in found])
    units = [{"text": t, "page": i, "section": "", "method": method} for i, p in enumerate(pages, 1) if (t := py_clean(p))]
    return {"title": py_clean(title or "") or stem, "units": units, "page_count": len(found), "parser": method, "diagnostics": diagnostics}


# --- speech -------------------------------------------------------------------------------------------------------


def duration_text(seconds: float | None) -> str:
    """HH:MM:SS, or MM:SS below an hour; unknown for null, negative or zero lengths."""
    if seconds is None or seconds <= 0:
        return "unknown"
    h, m, s = int(seconds // 3600), int(seconds % 3600 // 60), int(seconds % 60)
    return f"{h:02d}:{m:02d}:{s:02d}" if h else f"{m:02d}:{s:02d}"


def transcript(name: str, segments: list[str], language: str, probability: float, seconds: float | None, model: str) -> str:
    """The segments as one text under a comment that says what they come from; empty without any words."""
    text = " ".join(s.strip() for s in segments)
    if not text.strip():
        return ""
    return f"<!-- Transcription: {name} | Language: {language} ({probability:.0%}) | Duration: {duration_text(seconds)} | Model: whisper-{model} -->\n\n{text}"


def speech_decoder(listen: Callable[[str, Settings], dict], settings: Settings, suffix: str, video: bool = False, extract: Callable[[str, str], None] | None = None) -> formats.Decoder:
    """Audio by an injected model: listen(path, settings) gives segments, language, probability and seconds.

    Of a video the sound track is taken out first (mono, 16 kHz); a track of less than NO_TRACK_BYTES is none.
    """

    def read(path: str) -> str:
        if video:
            track = f"{path}.wav"
            (extract or sound_track)(path, track)
            if not os.path.exists(track) or os.path.getsize(track) < NO_TRACK_BYTES:
                return ""
            path = track
        said = listen(path, settings)
        return transcript(os.path.basename(path), said["segments"], said["language"], said["probability"], said.get("seconds"), settings.whisper_model)

    return file_decoder(read, suffix)


def sound_track(video: str, track: str, program: str = "ffmpeg", seconds: int = MEDIA_SECONDS) -> None:
    if not has_program(program):
        raise RuntimeError(f"{program} is not installed")
    run_program([program, "-y", "-i", video, "-vn", "-acodec", "pcm_s16le", "-ar", "16000", "-ac", "1", track], seconds)


# --- choice of parser ---------------------------------------------------------------------------------------------


def layout_settings(mode: str) -> dict:
    """What a layout parser is run with: flat blocks, and never a language model behind the caller's back."""
    if mode not in LAYOUT_MODES:
        raise ValueError(f"mode must be one of {LAYOUT_MODES}")
    return {"output_format": "chunks", "mode": mode, "use_llm": False}


def run_layout(path: str, sha256: str, media_type: str, convert: Callable[[str, dict], object] | None, mode: str = "fast") -> dict:
    settings = layout_settings(mode)
    if convert is None:
        raise RuntimeError("no layout parser is installed")
    return D.layout_document(path, sha256, media_type, convert(path, settings), mode)


def parsed_document(path: str, sha256: str, media_type: str, native: Callable[[], dict], layout: Callable[[str, dict], object] | None = None, parser: str = "native", mode: str = "fast") -> dict:
    """One document by the wanted parser. auto prefers the layout parser, and says so where it cannot be had."""
    if parser not in PARSERS:
        raise ValueError(f"parser must be one of {PARSERS}")
    fits = path.lower().endswith(LAYOUT_SUFFIXES)
    if parser == "marker":
        if not fits:
            raise ValueError(f"the layout parser does not read {os.path.splitext(path)[1].lower()!r}")
        return run_layout(path, sha256, media_type, layout, mode)
    failed = None
    if parser == "auto" and fits and layout is not None:
        try:
            return run_layout(path, sha256, media_type, layout, mode)
        except Exception as e:
            failed = e
    document = native()
    document["metadata"]["parser"] = "native" if failed is None else "native-fallback"
    if failed is not None:
        document["diagnostics"].append(D.diagnostic("warning", "marker_fallback", f"The layout parser failed; native parser used: {failed}"))
    elif parser == "auto" and fits:
        document["diagnostics"].append(D.diagnostic("info", "marker_unavailable", "No layout parser is installed; native parser used."))
    return document
