"""Predicates, classifiers and reason codes over columns: ordered rules in, arrays of codes or a first code out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import kernels as K
from . import patterns as P
from . import text as T


def java(pattern: str, ignore_case: bool = True) -> str:
    """A pattern with Unicode white space and digits, for Spark's regular expressions."""
    inside = re.sub(r"\\s", lambda _: f"[{T.SPACE}]", pattern)
    return ("(?iu)" if ignore_case else "") + inside.replace(r"\d", r"\p{Nd}")


def matches(c: Column, pattern: str, ignore_case: bool = True) -> Column:
    return c.rlike(java(pattern, ignore_case))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(java(pattern)))


def reason_array(rules: list[tuple[str, Column]]) -> Column:
    """The codes of all rules that hold, in order. A rule that is null does not hold."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules]))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The code of the first rule that holds, or null."""
    return F.coalesce(*[F.when(rule, F.lit(code)) for code, rule in rules], F.lit(None).cast("string"))


def best_category(c: Column, categories: dict[str, str]) -> Column:
    """struct<name, hits> of the category with most matches; earlier ones win ties; other without a match."""
    tries = F.array(*[F.struct(count(c, p).alias("hits"), F.lit(-i).alias("rank"), F.lit(name).alias("name")) for i, (name, p) in enumerate(categories.items())])
    return T.let(F.array_max(tries), lambda b: F.struct(F.when(b["hits"] > 0, b["name"]).otherwise("other").alias("name"), b["hits"].alias("hits")))


def chunk_quality(c: Column, min_chars: int = 200, min_words: int = 30) -> Column:
    """struct<keep, score, words> of a chunk's structure: printable, alphabetic and replacement characters.

    Line feeds and tabs are not printable, so texts made of short lines fail. Short texts score 0.
    """
    return K.quality_column(c, min_chars, min_words)


def is_junk_chunk(c: Column, ratio: float = 0.30, least: int = 40, enough: int = 150) -> Column:
    """Mostly punctuation or white space; null is junk."""
    return T.let(T.alnum_count(c), lambda n: F.coalesce(F.when(T.strip(c) == "", True).when(n >= enough, False).when(n < least, True).otherwise(n / F.length(c) < ratio), F.lit(True)))


def is_junk_pair(question: Column, answer: Column, ratio: float = 0.40, shortest: int = 10, enough: int = 50) -> Column:
    """A question or an answer is very short, mostly punctuation, or made of three characters at most; null is junk."""

    def bad(t: Column) -> Column:
        n, size = T.alnum_count(t), F.length(t)
        kinds = F.size(F.array_distinct(F.split(F.replace(t, F.lit(" "), F.lit("")), "")))
        return (n < enough) & ((n / F.greatest(size, F.lit(1)) < ratio) | ((kinds <= 3) & (size > 20)))

    q, a = T.strip(question), T.strip(answer)
    return F.coalesce((F.length(q) < shortest) | (F.length(a) < shortest) | bad(q) | bad(a), F.lit(True))


def refers_to_source(question: Column, answer: Column) -> Column:
    return matches(F.concat(question, F.lit(" "), answer), P.SOURCE_REFERENCE)


def finance_category(stem: Column) -> Column:
    folded = T.casefold(stem)
    return F.coalesce(*[F.when(matches(folded, p, False), F.lit(name)) for name, p in P.FINANCE_STEMS], F.lit("FINANCE_GENERAL"))


def cyber_category(relative_path: Column) -> Column:
    """The first folder in capitals; CYBER for files without a folder."""
    return F.when(F.contains(relative_path, F.lit("/")), F.upper(F.split_part(relative_path, F.lit("/"), F.lit(1)))).otherwise("CYBER")


def infer_domain(name: Column) -> Column:
    folded = T.casefold(name)
    return F.when(F.contains(folded, F.lit("finance")), "finance").when(F.contains(folded, F.lit("cyber")), "cyber").otherwise("unknown")


def source_family(name: Column) -> Column:
    has = lambda x: F.contains(name, F.lit(x))
    return (
        F.when(name.rlike("ANSSI|anssi|guide_hygiene|back to basics"), "ANSSI")
        .when(name.startswith("NIST"), "NIST").when(name.startswith("CERTFR"), "CERTFR").when(has("OWASP"), "OWASP")
        .when(name.startswith("ISO_IEC"), "ISO").when(has("CIS_AWS_Storage"), "CIS_AWS_STORAGE").when(name.startswith("CIS_"), "CIS_OTHER")
    )


def document_rejection(domain: Column, title: Column) -> Column:
    """Why all of a document's chunks are left out of training data, judged by its title; null if they are not."""
    t, cyber = T.casefold(title), domain == "cyber"
    has = lambda *xs: F.lit(False) if not xs else [F.contains(t, F.lit(x)) for x in xs]
    some = lambda *xs: F.array_contains(F.array(*has(*xs)), True)
    return first_reason([
        ("presentation_layout", cyber & some("powerpoint", ".ppt")),
        ("catalog_or_poster", cyber & some("catalog", "poster")),
        ("lab_setup_or_reference_card", cyber & some("lab setup", "quick find chart")),
        ("off_domain", cyber & t.isin(*P.OFF_DOMAIN_TITLES)),
        ("untrusted_source", (domain == "finance") & some("creature from jekyll island")),
    ])


def training_rejection(c: Column, min_chars: int = 400, min_words: int = 50) -> Column:
    """The first reason why a text is no training text, or null."""
    return K.rejection_column(c, min_chars, min_words)


def _shared_rules(instruction: Column, response: Column) -> dict[str, Column]:
    same = T.canonical_text(instruction) == T.canonical_text(response)
    return {
        "corrupted_unicode": F.contains(F.concat(instruction, response), F.lit("�")),
        "known_bad_answer": T.canonical_text(instruction).isin(*P.KNOWN_BAD_INSTRUCTIONS),
        "explicit_nonanswer": matches(response, P.NONANSWER),
        "missing_source_context": matches(instruction, P.CONTEXT_DEPENDENT),
        "unanchored_time_sensitive": matches(instruction, P.UNANCHORED_CURRENT) & ~matches(instruction, P.DATE_ANCHOR),
        "answer_echoes_question": same,
        "unbalanced_backticks": F.length(F.regexp_replace(response, "[^`]+", "")) % 2 == 1,
        "asks_back": response.endswith("?") & ~matches(instruction, P.QUESTION_REQUEST),
    }


def cleaning_reasons(instruction: Column, input_text: Column, response: Column, domain: Column) -> Column:
    """Reasons against an instruction record, but for duplicate_instruction, which depends on other rows."""
    r = _shared_rules(instruction, response)
    q, a = (F.array_distinct(F.regexp_extract_all(T.casefold(x), F.lit(T.LATIN_WORD), F.lit(0))) for x in (instruction, response))
    overlap = F.size(F.array_intersect(q, a)) / F.greatest(F.lit(1), F.least(F.size(q), F.size(a)))
    both = F.concat(instruction, F.lit("\n"), response)
    return reason_array([
        ("synthetic_input", input_text.isNotNull()),
        ("empty_instruction", instruction == ""),
        ("empty_response", response == ""),
        *[(k, r[k]) for k in ("corrupted_unicode", "known_bad_answer", "explicit_nonanswer", "missing_source_context", "unanchored_time_sensitive", "answer_echoes_question")],
        ("likely_mismatched_answer", r["asks_back"] & ~r["answer_echoes_question"] & (overlap < 0.35)),
        ("unbalanced_backticks", r["unbalanced_backticks"]),
        ("off_domain", ((domain == "finance") & ~matches(both, P.FINANCE)) | ((domain == "cyber") & ~matches(both, P.CYBER))),
    ])


def common_reasons(instruction: Column, response: Column) -> Column:
    """Reasons against a candidate for the curated sets of either domain."""
    r = _shared_rules(instruction, response)
    return reason_array([
        ("instruction_length", ~F.length(instruction).between(20, 220)),
        ("response_length", ~F.length(response).between(35, 900)),
        ("response_too_short", F.size(T.words(response)) < 7),
        *[(k, r[k]) for k in ("corrupted_unicode", "missing_source_context", "unanchored_time_sensitive", "explicit_nonanswer")],
        ("meta_response", matches(response, P.META)),
        ("unbalanced_backticks", r["unbalanced_backticks"]),
        ("answer_echoes_question", r["answer_echoes_question"]),
        ("response_is_question", r["asks_back"]),
        ("known_bad_answer", r["known_bad_answer"]),
    ])


def finance_reasons(instruction: Column, response: Column, support: Column, coverage: Column) -> Column:
    both = F.concat(instruction, F.lit("\n"), response)
    return F.concat(common_reasons(instruction, response), reason_array([
        ("weak_domain_signal", ~matches(both, P.FINANCE)),
        ("biographical_or_historical_trivia", matches(instruction, P.TRIVIA)),
        ("not_conceptual", ~matches(instruction, P.CONCEPTUAL_QUESTION)),
        ("formula_or_calculation", matches(both, P.FORMULA_HEAVY)),
        ("precise_contextual_fact", matches(instruction, P.PRECISE_FACT)),
        ("numeric_specific_question", instruction.rlike(r"\p{Nd}")),
        ("case_specific_question", matches(instruction, P.CASE_SPECIFIC)),
        ("precise_numeric_answer", matches(response, P.PRECISE_NUMBER, False)),
        ("insufficient_textual_grounding", support < 2),
        ("low_textual_coverage", coverage < 0.70),
    ]))


def cyber_reasons(instruction: Column, response: Column, family: Column, has_source: Column, support: Column, coverage: Column) -> Column:
    """A source outside the allowed families is the only reason given; the other rules need a source."""
    both = F.concat(instruction, F.lit("\n"), response)
    closed = [k for k, v in P.SOURCE_FAMILY_LIMITS.items() if v == 0]
    others = F.concat(common_reasons(instruction, response), reason_array([
        ("weak_domain_signal", ~matches(both, P.CYBER)),
        ("source_file_missing", ~has_source),
        ("not_textually_grounded", has_source & (support == 0)),
        ("low_textual_coverage", has_source & (coverage < 0.30)),
    ]))
    return F.when(family.isNull(), F.array(F.lit("non_official_source"))).when(family.isin(*closed), F.array(F.lit("excluded_source_family"))).otherwise(others)


def _points(n: Column, low: int, high: int, points: int) -> Column:
    return F.when(n.between(low, high), points).otherwise(0)


def cyber_score(instruction: Column, response: Column, hits: Column, support: Column, coverage: Column) -> Column:
    return (
        support * 25 + F.least(hits, F.lit(5)) * 4 + F.when(matches(instruction, P.CONCEPTUAL_QUESTION), 10).otherwise(0)
        + _points(F.length(response), 70, 450, 10) + _points(F.length(instruction), 35, 140, 5) + F.bround(coverage * 20)
    ).cast("int")


def finance_score(instruction: Column, response: Column, hits: Column, coverage: Column) -> Column:
    shared = F.size(F.array_intersect(F.array_distinct(T.words(instruction, True)), T.words(response, True)))
    return (
        F.least(hits, F.lit(6)) * 8 + _points(F.length(response), 80, 450, 20) + _points(F.length(instruction), 35, 150, 10)
        + F.least(shared, F.lit(5)) * 3 + F.bround(coverage * 20)
    ).cast("int")


TEMPLATE = r"\A### Instruction:\n(.*?)(?:\n\n### Input:\n(.*?))?\n\n### Response:\n(.*)\z"


def parsed_template(c: Column) -> Column:
    """struct<instruction, input, response> of a training text, input null where it has no such section; null if it has another form."""

    def group(i: int) -> Column:
        return F.regexp_extract(c, f"(?s){TEMPLATE}", i)

    def made(q: Column) -> Column:
        has_input = F.startswith(c, F.concat(F.lit(T.HF_HEAD), q, F.lit(T.HF_INPUT)))
        return F.struct(T.strip(q).alias("instruction"), F.when(has_input, group(2)).alias("input"), T.strip(group(3)).alias("response"))

    return F.when(c.rlike(f"(?s){TEMPLATE}"), T.let(group(1), made))
