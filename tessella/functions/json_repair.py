"""Reading JSON out of model replies: fences, text around it, raw line breaks, bad escapes, replies cut short.

A reply yields candidate substrings, best first; each is loaded more and more leniently until one has the wanted shape.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_lenient = json.JSONDecoder(strict=False)  # raw control characters in strings are allowed
_STRING = r'"((?:[^"\\]|\\.)*)"'
_PAIR = re.compile(rf'\{{[^{{}}]*?"question"\s*:\s*{_STRING}\s*,\s*"answer"\s*:\s*{_STRING}\s*\}}', re.DOTALL)
_CUTS = "\n., "


def loads(text: str):
    """The value, or None; further tries double or drop backslashes that start no escape."""
    for attempt in (text, re.sub(r'\\(?!["\\bfnrtu])', r"\\\\", text), re.sub(r'\\(?!["\\bfnrtu/])', "", text)):
        try:
            return _lenient.decode(attempt.strip())
        except ValueError:
            continue
    return None


def balanced(text: str, opening: str, start: int = 0) -> str | None:
    """From the first opening bracket to its partner; brackets in strings do not count."""
    at = text.find(opening, start)
    if at < 0:
        return None
    closing, depth = {"[": "]", "{": "}"}[opening], 0
    for m in re.finditer(rf'"(?:[^"\\]|\\.)*"|[{re.escape(opening + closing)}]', text[at:], re.DOTALL):
        depth += (m[0] == opening) - (m[0] == closing)
        if depth == 0:
            return text[at : at + m.end()]
    return None


def _fenced(text: str, opening: str) -> str | None:
    m = re.search(rf"```(?:json)?\s*(\{opening}.*)", text, re.DOTALL)
    return m[1].partition("```")[0].strip() if m else None


def closed(text: str) -> Iterator[str]:
    """A cut-off object, shortened step by step (to half at most) and with all that is open closed."""
    for mark in _CUTS:
        at = text.rfind(mark)
        while at > len(text) // 2:
            head = text[:at]
            head += '"' * (head.count('"') % 2)
            yield head + "]" * max(0, head.count("[") - head.count("]")) + "}" * max(0, head.count("{") - head.count("}"))
            at = text.rfind(mark, 0, at)


def read_pairs(reply: str | None) -> list[dict] | None:
    """The question/answer objects of a reply; None if nothing in it can be read."""
    if reply is None:
        return None
    for candidate in (_fenced(reply, "["), balanced(reply, "["), reply):
        try:
            value = _lenient.decode(candidate.strip()) if candidate else None
        except ValueError:
            continue
        if value is not None:
            return value
    flat = lambda s: s.replace("\\n", " ").replace("\\t", " ").strip()
    found = [{"question": flat(m[1]), "answer": flat(m[2])} for m in _PAIR.finditer(reply)]
    return [p for p in found if p["question"] and p["answer"]] or None


def _both(value) -> dict | None:
    """The object itself or one that it holds, if it has input and output."""
    if not isinstance(value, dict):
        return None
    return next((v for v in (value, *value.values()) if isinstance(v, dict) and {"input", "output"} <= v.keys()), None)


def _field(reply: str, name: str):
    """The value of one field of a broken object: a string, or an object."""
    if m := re.search(rf'"{name}"\s*:\s*{_STRING}', reply, re.DOTALL):
        return m[1].replace("\\n", "\n").replace("\\t", " ")
    m = re.search(rf'"{name}"\s*:\s*(?=\{{)', reply)
    part = balanced(reply, "{", m.end()) if m else None
    return loads(part) if part else None


def read_enrichment(reply: str | None) -> dict | None:
    """{"input", "output"} of a reply, or None."""
    if not reply:
        return None
    start, end = reply.find("{"), reply.rfind("}")
    fenced = _fenced(reply, "{")
    for candidate in (fenced, balanced(reply, "{"), reply[start : end + 1] if 0 <= start <= end else None):
        if candidate and (found := _both(loads(candidate))):
            return found
    given, made = _field(reply, "input"), _field(reply, "output")
    if given and made and (not isinstance(given, str) or given.strip()) and (not isinstance(made, str) or made.strip()):
        return {"input": given, "output": made}
    for cut in closed(fenced or reply[start:] if start >= 0 else ""):
        if found := _both(loads(cut)):
            return found
    return None


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def pairs_of(value) -> list[dict]:
    return [{"question": _text(p["question"]), "answer": _text(p["answer"])} for p in value if isinstance(p, dict) and {"question", "answer"} <= p.keys()] if isinstance(value, list) else []


def _pairs(replies: pd.Series) -> pd.Series:
    return replies.map(lambda r: pairs_of(read_pairs(r)))


def _enrichment(replies: pd.Series) -> pd.DataFrame:
    found = [read_enrichment(r) or {} for r in replies]
    return pd.DataFrame({k: [_text(f.get(k)) for f in found] for k in ("input", "output")}, dtype=object)


def parsed_pairs(reply: Column) -> Column:
    return F.pandas_udf(_pairs, "array<struct<question:string,answer:string>>")(reply)


def parsed_enrichment(reply: Column) -> Column:
    """struct<input, output>, both null if nothing can be read."""
    return F.pandas_udf(_enrichment, "struct<input:string,output:string>")(reply)
