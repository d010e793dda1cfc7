"""Row functions for SQL registration, over batches of texts."""

from __future__ import annotations

import re

import pandas as pd

from .text import STOPWORDS
from .windows import py_clean


def canonical(text: str) -> str:
    return " ".join(text.split()).casefold()


def topic_key(text: str) -> str:
    def stem(w: str) -> str:
        for least, ending in ((5, "ing"), (4, "es"), (3, "s")):
            if len(w) > least and w.endswith(ending):
                return w[: -len(ending)]
        return w

    return " ".join(sorted(stem(w) for w in re.findall("[a-z0-9]+", text.casefold()) if w not in STOPWORDS))


def clean_text_series(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else py_clean(t))


def canonical_text_series(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else canonical(t))


def near_dup_key_series(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else topic_key(t))
