"""Text functions with Unicode-aware semantics, as Column -> Column expressions that stay in the JVM.

Spark's own trim, lower and ``\\s`` cover ASCII only; the functions here strip, fold and split the way Unicode
text processing expects, so that results do not depend on which engine computed them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 white-space characters of Unicode-aware strip and \s, and those that end a line.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
LINE_END = r"\n\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}"
IN_LINE = r"\t\x1f\x20\xa0\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
# What full case folding adds to lower-casing.
FOLDS = (("ß", "ss"), ("ς", "σ"), ("ſ", "s"), ("µ", "μ"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))
# Words that carry no topic.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "does", "for", "from", "how", "in", "is", "it", "its", "of", "on", "or",
    "that", "the", "their", "this", "to", "what", "when", "where", "which", "who", "why", "with",
)
WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_×÷'-]*[\p{L}\p{N}_])?"
LATIN_WORD = "[a-zà-ÿ0-9]+"
# Media types by extension, and OCR language codes.
MEDIA_TYPES = {
    ".pdf": "application/pdf", ".epub": "application/epub+zip", ".md": "text/markdown", ".rst": "text/x-rst", ".txt": "text/plain",
    ".doc": "application/msword", ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}
OCR_LANGUAGES = {"en": "eng", "fr": "fra", "ch": "chi_sim", "de": "deu", "es": "spa", "it": "ita", "pt": "por", "ja": "jpn", "ko": "kor", "ar": "ara", "ru": "rus"}


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def casefold(c: Column) -> Column:
    """Lower case and the common foldings beyond it; rare ones (mostly of Greek with marks and Cherokee) are left out: a
    look at every character for them costs several times as much as all the rest."""
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), FOLDS, F.lower(c))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"[{SPACE}]+", " ")


def canonical_text(c: Column) -> Column:
    """White space as single blanks, none at the ends, case folded: the form in which texts are compared."""
    return casefold(F.trim(collapse(c)))


def clean_text(c: Column) -> Column:
    """Unix line ends, single blanks in lines, no blanks around lines, at most one empty line in a row."""
    from .kernels import clean_column

    return clean_column(c)


def count_matching(c: Column, chars: str) -> Column:
    """Characters of a regex class body, counted."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{chars}]+", ""))


def alnum_count(c: Column) -> Column:
    return count_matching(c, r"\p{L}\p{N}")


def words(c: Column, drop_stopwords: bool = False) -> Column:
    """ASCII words and numbers of the case-folded text."""
    found = F.regexp_extract_all(casefold(c), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*STOPWORDS)) if drop_stopwords else found


def unicode_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def ngrams(tokens: Column, size: int) -> Column:
    """Distinct runs of `size` tokens, joined by a blank."""

    def made(t: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(t) - size), lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(size)]))
        return F.when(F.size(t) < size, F.array().cast("array<string>")).otherwise(F.array_distinct(each))

    return let(tokens, made)


def trigrams(c: Column) -> Column:
    """Distinct runs of three characters of the lower-cased, stripped text; a shorter text is its own only one."""

    def made(t: Column) -> Column:
        each = lambda s: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(s) - 3), lambda i: F.concat(F.get(s, i), F.get(s, i + 1), F.get(s, i + 2))))
        return F.when(F.length(t) < 3, F.array(t)).otherwise(let(F.split(t, ""), each))

    return let(strip(F.lower(c)), made)


def near_duplicate_key(c: Column) -> Column:
    """Topic words without plural and gerund endings, sorted."""

    def stem(w: Column) -> Column:
        n = F.length(w)
        return (
            F.when((n > 5) & w.endswith("ing"), F.substr(w, F.lit(1), n - 3))
            .when((n > 4) & w.endswith("es"), F.substr(w, F.lit(1), n - 2))
            .when((n > 3) & w.endswith("s"), F.substr(w, F.lit(1), n - 1))
            .otherwise(w)
        )

    return F.array_join(F.array_sort(F.transform(words(c, True), stem)), " ")


def alnum_key(c: Column) -> Column:
    """Latin words and numbers of the case-folded text, joined by blanks; texts in other scripts have an empty key."""
    return F.array_join(F.regexp_extract_all(casefold(c), F.lit(LATIN_WORD), F.lit(0)), " ")


def stable_hash(*parts: Column) -> Column:
    """SHA-256 of the parts, parted by NUL."""
    return F.sha2(F.concat_ws("\0", *parts), 256)


def token_estimate(c: Column) -> Column:
    return F.ceil(F.length(c) / 4).cast("int")


def _looked_up(key: Column, values: dict[str, str], default: str) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key), F.lit(default))


def media_type(extension: Column) -> Column:
    return _looked_up(extension, MEDIA_TYPES, "application/octet-stream")


def ocr_language(code: Column) -> Column:
    return _looked_up(code, OCR_LANGUAGES, "fra+eng")


def camel_to_snake(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "(?<!^)(?=[A-Z])", "_"))


def heading_level(html: Column) -> Column:
    """1 to 6 for a block that opens with a heading tag, else 1."""
    level = F.regexp_extract(html, r"(?i)<h([1-6])\b", 1)
    return F.when(level == "", F.lit(1)).otherwise(level.cast("int"))


def relative_path(path: Column, root: str) -> Column:
    """path below root, with forward slashes."""
    plain = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "^file:/+", "/")
    return F.when(plain.startswith(root.rstrip("/") + "/"), F.substr(plain, F.lit(len(root.rstrip("/")) + 2))).otherwise(plain)


def duration(seconds: Column) -> Column:
    """HH:MM:SS, or MM:SS below an hour; unknown for null, negative or zero lengths."""
    s = F.floor(seconds).cast("long")
    hms = F.when(s >= 3600, F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60))
    return F.when(seconds.isNull() | (seconds <= 0), F.lit("unknown")).otherwise(F.coalesce(hms, F.format_string("%02d:%02d", F.floor(s / 60), s % 60)))


def detail_instruction(level: Column) -> Column:
    """How exhaustive a summary of a detail level from 1 to 10 (clamped) is to be: one of four bands."""
    n = F.greatest(F.lit(1), F.least(F.lit(10), level))
    return F.when(n <= 2, F.lit("brief")).when(n <= 5, F.lit("balanced")).when(n <= 8, F.lit("detailed")).otherwise(F.lit("exhaustive"))


# What a generated summary may open with or end in, besides its content.
PREAMBLE = r"\A\s*(?:okay|alright|sure|here(?:'s| is)|let me|great|certainly|of course|i'll)[^\n]*\n+"
TRAILING_SECTIONS = (
    r"\n+(?:#{1,3}\s*|\*{2})(?:resources|references|sources|bibliography|links|contact|further (?:reading|learning)|next steps|to help me"
    r"|additional (?:resources|notes|considerations)|in summary|summary|conclusion|key takeaways)(?:\*{2})?[:\s].*"
)
TRAILING_QUESTIONS = r"\n+\*{2}(?:to help me|would you like|do you want|let me know|if you)[^\n]*\*{2}[:\s].*"


def summary_content(c: Column) -> Column:
    """A generated summary without its preamble, trailing reference sections and trailing questions."""
    for pattern in (PREAMBLE, TRAILING_SECTIONS, TRAILING_QUESTIONS):
        c = F.regexp_replace(c, f"(?isu){pattern}", "")
    return strip(c)


def messages_to_prompt(messages: Column) -> Column:
    """array<struct<role, content>> as paragraphs led by the role, ending in an open assistant turn."""
    known = F.filter(messages, lambda m: F.coalesce(m["role"], F.lit("user")).isin("system", "user", "assistant"))
    said = F.transform(known, lambda m: F.concat(F.initcap(F.coalesce(m["role"], F.lit("user"))), F.lit(": "), F.coalesce(m["content"], F.lit(""))))
    return F.concat_ws("\n\n", F.concat(said, F.array(F.lit("Assistant:"))))


HF_HEAD, HF_INPUT, HF_RESPONSE = "### Instruction:\n", "\n\n### Input:\n", "\n\n### Response:\n"


def hf_text(instruction: Column, input_text: Column, output: Column) -> Column:
    """One training text from an instruction, its input (left out if empty) and the response."""
    middle = F.when(F.coalesce(input_text, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(HF_INPUT), input_text))
    return F.concat(F.lit(HF_HEAD), instruction, middle, F.lit(HF_RESPONSE), output)
