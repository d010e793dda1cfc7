"""The queries' results as DuckDB statements over the same tables, for checking; built from snippets."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import windows as C
from ..operators import rag, training

SEARCH = "the loser and the economic return of licensed license"
DOMAIN = "finance"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def nl(s: str) -> str:
    """A string literal with line ends."""
    return "concat(" + ", ".join("chr(10)" if x == "\n" else q(x) for x in _split(s)) + ")"


def _split(s: str) -> list[str]:
    out, cur = [], ""
    for ch in s:
        if ch == "\n":
            out += [cur] * bool(cur) + ["\n"]
            cur = ""
        else:
            cur += ch
    return out + [cur] * bool(cur) or [""]


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip(x: str) -> str:
    return sub(x, f"^[{T.SPACE}]+|[{T.SPACE}]+$", "")


def lstrip(x: str) -> str:
    return sub(x, f"^[{T.SPACE}]+", "")


def fold(x: str) -> str:
    x = f"lower({x})"
    for a, b in T.FOLDS:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def canon(x: str) -> str:
    return fold(f"trim({sub(x, f'[{T.SPACE}]+', ' ')})")


def clean(x: str) -> str:
    x = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    x = f"regexp_replace({x}, '[{T.LINE_END}]', chr(10), 'g')"
    x = sub(x, "[ \\t]+", " ")
    x = sub(sub(x, f"(^|\\n)[{T.IN_LINE}]+", "\\1"), f"[{T.IN_LINE}]+(\\n|$)", "\\1")
    return strip(f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def words(x: str, topic: bool = False) -> str:
    found = f"regexp_extract_all({fold(x)}, '[a-z0-9]+')"
    return f"list_filter({found}, lambda t: t NOT IN ({', '.join(map(q, T.STOPWORDS))}))" if topic else found


def uwords(x: str) -> str:
    return f"regexp_extract_all({x}, {q(T.WORD)})"


def grams(tokens: str, n: int) -> str:
    return f"list_distinct(list_transform(range(1, greatest(1, len({tokens}) - {n - 2})), lambda i: array_to_string({tokens}[i:i+{n - 1}], ' ')))"


def plain(x: str) -> str:
    """Letters beyond ASCII as underscores, so that word ends are where Unicode has them."""
    return sub(x, r"[ªµº²³¹¼-¾À-ÖØ-öø-ÿ]", "_")


def re2(pattern: str) -> str:
    return pattern.replace(r"\s", f"[{T.SPACE}]").replace(r"\d", r"\p{Nd}")


def has(x: str, pattern: str, case: bool = False) -> str:
    return f"regexp_matches({plain(x)}, {q(('' if case else '(?i)') + re2(pattern))})"


def n_of(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({plain(x)}, {q('(?i)' + re2(pattern))}))"


def chars(x: str, body: str) -> str:
    return f"(length({x}) - length({sub(x, f'[{body}]+', '')}))"


def first_of(rules: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {q(k)}" for k, c in rules) + f" ELSE {otherwise} END"


def reasons(rules: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {q(k)} END" for k, c in rules) + "], lambda r: r IS NOT NULL)"


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, ','), '')"


def rfind(text: str, mark: str, start: str, end: str) -> str:
    """Python's rfind with bounds, 0-based, -1 for none; mark is an SQL expression without patterns."""
    s = f"substr({text}, {start} + 1, {end} - {start})"
    return f"(CASE WHEN contains({s}, {mark}) THEN {start} + length({s}) - length({mark}) - (instr(reverse({s}), reverse({mark})) - 1) ELSE -1 END)"


DOCS = "d AS (SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents)"
TURNS = """p AS (SELECT conv_id, turn, text AS question, answer FROM (
  SELECT *, lead(role) OVER w AS r2, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND r2 = 'assistant')"""
BREAK = "chr(10) || chr(10)"


def cutter(source: str, key: str, text: str, size: int, overlap: int, kind: str) -> str:
    """CTEs ``cut``: key, pos, a, b (0-based start and end of each piece); kind: window, block or summary."""
    a, e = "a", f"least(n, a + {size})"
    if kind == "window":
        p1, p2, p3, p4 = (rfind("t", m, a, e) for m in (f"({BREAK})", "'. '", "chr(10)", "' '"))
        at = f"CASE WHEN {p1} > a THEN {p1} WHEN {p2} > a THEN {p2} WHEN {p3} > a THEN {p3} ELSE {p4} END"
        end = f"CASE WHEN {e} = n THEN n WHEN s > a + {size // 2} THEN s + CASE WHEN substr(t, s + 1, 2) = '. ' THEN 2 ELSE 0 END ELSE {e} END"
        following = f"greatest(a + 1, b - {overlap})"
    elif kind == "block":
        p1, p2, p3 = (rfind("t", m, a, e) for m in (f"({BREAK})", "chr(10)", "' '"))
        at = f"CASE WHEN {p1} > a THEN {p1} WHEN {p2} > a THEN {p2} ELSE {p3} END"
        end = f"CASE WHEN {e} = n THEN n WHEN s > a THEN s ELSE {e} END"
        following = f"greatest(a + 1, b - {overlap})"
    else:
        p1, p2 = (rfind("t", m, a, e) for m in (f"({BREAK})", "chr(10)"))
        at = f"CASE WHEN {p1} > a THEN {p1} ELSE {p2} END"
        end = f"CASE WHEN n - a <= {size} THEN n WHEN s > a THEN s ELSE {e} END"
        following = "b + 1"
    stop = "b < n"
    def step(frm: str, k: str, pos: str) -> str:
        return f"SELECT {key}, t, n, {pos} AS pos, a, {end} AS b FROM (SELECT *, {at} AS s FROM ({frm}))"
    return f"""
src AS (SELECT {key}, {text} AS t, length({text}) AS n FROM {source}),
cut AS ({step("SELECT *, 0 AS pos, 0 AS a FROM src", key, "pos")}
  UNION ALL {step(f"SELECT {key}, t, n, pos + 1 AS pos, {following} AS a FROM cut WHERE {stop}", key, "pos")})"""


def quality(x: str) -> dict[str, str]:
    """keep, score, words of a chunk."""
    n, w = f"length({x})", f"len({uwords(x)})"
    printable = f"(({n} - length({sub(x, '[^' + chr(92) + 'p{C}' + chr(92) + 'p{Z}]+| +', '')})) / {n}::DOUBLE)"
    solid = f"length({sub(x, f'[{T.SPACE}]+', '')})"
    alpha = f"(CASE WHEN {solid} > 0 THEN {chars(x, chr(92) + 'p{L}')} / {solid}::DOUBLE ELSE 0 END)"
    broken = f"({chars(x, '�')} / {n}::DOUBLE)"
    short = f"({n} < 200 OR {w} < 30)"
    return {
        "keep": f"(NOT {short} AND {printable} >= 0.96 AND {alpha} >= 0.45 AND {broken} <= 0.002)",
        "score": f"(CASE WHEN {short} THEN 0.0::DOUBLE ELSE greatest(0.0, least(1.0, 0.55::DOUBLE * {alpha} + 0.45::DOUBLE * {printable} - 5 * {broken})) END)",
        "words": f"CAST({w} AS INTEGER)",
    }


def finance_stem(x: str) -> str:
    return first_of([(k, f"regexp_matches({fold(x)}, {q(re2(p))})") for k, p in P.FINANCE_STEMS], "'FINANCE_GENERAL'")


_q = quality("piece")
RAG = f"""
r0 AS (SELECT doc_id AS document_id, source AS title, {clean("text")} AS text, sha256(text) AS source_sha256, {finance_stem("coalesce(source, '')")} AS category FROM d),
r AS (SELECT *, nullif(min(document_id) OVER (PARTITION BY source_sha256), document_id) AS duplicate_of FROM r0),
o AS (SELECT * FROM r WHERE duplicate_of IS NULL AND text <> ''),
{cutter("o", "document_id", "text", C.RAG_CHARS, C.RAG_OVERLAP, "window")},
w0 AS (SELECT document_id, pos, CASE WHEN n <= {C.RAG_CHARS} THEN t ELSE {clean("substr(t, a + 1, b - a)")} END AS piece FROM cut),
w1 AS (SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY pos) - 1 AS INTEGER) AS win_pos, piece FROM w0 WHERE piece <> ''),
w2 AS (SELECT *, {_q["keep"]} AS keep, {_q["score"]} AS score, {_q["words"]} AS words, sha256({canon("piece")}) AS content_sha256 FROM w1),
w AS (SELECT *, CASE WHEN NOT keep THEN 'rejected_quality' WHEN row_number() OVER (PARTITION BY content_sha256, keep ORDER BY document_id, win_pos) > 1 THEN 'rejected_duplicate' ELSE 'indexed' END AS status FROM w2),
c AS (SELECT w.document_id, o.category, o.title, o.source_sha256, piece AS text, content_sha256, words, round_even(score, 4) AS quality_score,
      CAST(row_number() OVER (PARTITION BY w.document_id ORDER BY win_pos) - 1 AS INTEGER) AS chunk_index FROM w JOIN o USING (document_id) WHERE status = 'indexed')"""
WITH_RAG = f"WITH RECURSIVE {DOCS}, {RAG}"
UID = f"'sha256:' || sha256({q(DOMAIN)} || ':' || source_sha256 || ':' || chunk_index || ':' || content_sha256)"

RDOCS = f"""rd AS (SELECT r.document_id, 'sha256:' || source_sha256 || ':' || substr(sha256(coalesce(title, '')), 1, 12) AS document_uid, {q(DOMAIN)} AS domain, category, title, source_sha256,
  CASE WHEN duplicate_of IS NOT NULL THEN 'duplicate' WHEN text = '' THEN 'no_native_text' ELSE 'indexed' END AS extraction_status,
  CAST(CASE WHEN duplicate_of IS NULL THEN length(text) ELSE 0 END AS INTEGER) AS extracted_char_count, CAST(coalesce(k.n, 0) AS BIGINT) AS chunk_count,
  duplicate_of AS duplicate_of_document_id, {q(rag.RIGHTS)} AS rights_status
  FROM r LEFT JOIN (SELECT document_id, count_if(status = 'indexed') AS n FROM w GROUP BY 1) k USING (document_id))"""

TERMS = f"regexp_extract_all(translate(lower(text), {q(rag.ACCENTED)}, {q(rag.PLAIN)}), '[\\p{{L}}\\p{{N}}]+')"


def training_reason(x: str) -> str:
    w = uwords(x)
    return first_of([
        ("too_short", f"length({x}) < {training.MIN_CHARS} OR len({w}) < {training.MIN_WORDS}"),
        ("replacement_characters", f"{chars(x, '�')} / length({x})::DOUBLE > 0.001"),
        ("dot_leaders", f"{n_of(x, P.DOT_LEADER)} >= 4"),
        ("url_list", f"{n_of(x, P.URL)} >= 12"),
        ("publisher_front_matter", f"{n_of(x, P.FRONT_MATTER)} >= 2 OR {has(x, P.SERIES_FRONT_MATTER)}"),
        ("copyright_noise", f"{n_of(x, P.COPYRIGHT_NOISE)} >= 3"),
        ("license_front_matter", has(x, P.LICENSE_FRONT_MATTER)),
        ("index_or_reference_list", f"{n_of(x, P.INDEX_REFERENCE)} >= 12 AND {chars(x, '.')} <= 3"),
        ("low_vocabulary_diversity", f"len(list_distinct(list_transform({w}, lambda v: {fold('v')}))) / len({w})::DOUBLE < 0.12"),
    ])


_tail = "substr(prev, length(prev) - most + 1, most)"
TRIM = f"""
t0 AS (SELECT *, {strip("text")} AS own, CASE WHEN lag(chunk_index) OVER x = chunk_index - 1 THEN lag(text) OVER x END AS prev FROM c WINDOW x AS (PARTITION BY document_id ORDER BY chunk_index)),
t1 AS (SELECT *, least({training.TAIL}, length(prev), length(own)) AS most FROM t0),
t2 AS (SELECT *, instr(reverse({_tail}), reverse(substr(own, 1, {training.ANCHOR}))) AS back FROM t1),
t3 AS (SELECT *, CAST(CASE WHEN prev IS NOT NULL AND most >= {training.ANCHOR} AND back > 0 AND starts_with(own, substr({_tail}, most - (back + {training.ANCHOR - 1}) + 1, back + {training.ANCHOR - 1})) THEN back + {training.ANCHOR - 1} ELSE 0 END AS INTEGER) AS overlap_removed FROM t2),
t AS (SELECT *, CASE WHEN overlap_removed > 0 THEN {lstrip("substr(own, overlap_removed + 1)")} ELSE own END AS trimmed FROM t3)"""
CT = "c0 AS (SELECT * FROM c WHERE quality_score >= 0.8)"
EXPORT = f"""{TRIM.replace("FROM c WINDOW", "FROM c0 WINDOW")},
e0 AS (SELECT *, {training_reason("trimmed")} AS own_reason, sha256({canon("trimmed")}) AS content_key FROM t),
e AS (SELECT *, CASE WHEN own_reason IS NOT NULL THEN own_reason WHEN row_number() OVER (PARTITION BY content_key, own_reason IS NULL ORDER BY document_id, chunk_index) > 1 THEN 'duplicate' END AS reason FROM e0)"""
_marks = [f"({BREAK})", "'. '", "'? '", "'! '", "': '"]
CHAT = f"""{EXPORT},
h0 AS (SELECT *, {strip("trimmed")} AS s FROM e WHERE reason IS NULL),
h1 AS (SELECT *, length(s) - {training.ANSWER} AS upper, least(length(s) - {training.ANSWER}, greatest({training.CONTEXT}, CAST(round_even(length(s) * 0.30::DOUBLE, 0) AS INTEGER))) AS target FROM h0),
h2 AS (SELECT *, list_concat({", ".join(f"list_transform(list_filter(range(greatest({training.CONTEXT}, target - {training.AROUND}), least(upper, target + {training.AROUND}) - 1), lambda i: substr(s, i + 1, 2) = {m}), lambda i: i + 2)" for m in _marks[:2])}) AS ends1,
       list_concat({", ".join(f"list_transform(list_filter(range(greatest({training.CONTEXT}, target - {training.AROUND}), least(upper, target + {training.AROUND}) - 1), lambda i: substr(s, i + 1, 2) = {m}), lambda i: i + 2)" for m in _marks[2:4])}) AS ends2,
       list_transform(list_filter(range(greatest({training.CONTEXT}, target - {training.AROUND}), least(upper, target + {training.AROUND}) - 1), lambda i: substr(s, i + 1, 2) = ': '), lambda i: i + 2) AS ends3 FROM h1),
h3 AS (SELECT *, CASE WHEN upper > {training.CONTEXT} THEN coalesce(list_min(list_transform(list_concat(list_concat(ends1, ends2), ends3), lambda v: {{'far': abs(v - target), 'at': v}})).at, target) END AS cut FROM h2),
h AS (SELECT *, {strip("substr(s, 1, cut)")} AS context, {strip("substr(s, cut + 1)")} AS answer FROM h3)"""


def shared(i: str, r: str) -> dict[str, str]:
    same = f"{canon(i)} = {canon(r)}"
    return {
        "corrupted_unicode": f"contains({i} || {r}, '�')",
        "known_bad_answer": f"{canon(i)} IN ({', '.join(map(q, P.KNOWN_BAD_INSTRUCTIONS))})",
        "explicit_nonanswer": has(r, P.NONANSWER), "missing_source_context": has(i, P.CONTEXT_DEPENDENT),
        "unanchored_time_sensitive": f"{has(i, P.UNANCHORED_CURRENT)} AND NOT {has(i, P.DATE_ANCHOR)}", "answer_echoes_question": same,
        "unbalanced_backticks": f"length({sub(r, '[^`]+', '')}) % 2 = 1", "asks_back": f"(ends_with({r}, '?') AND NOT {has(i, P.QUESTION_REQUEST)})",
    }


def cleaning(i: str, given: str, r: str) -> list[tuple[str, str]]:
    s = shared(i, r)
    qw, aw = (f"list_distinct(regexp_extract_all({fold(x)}, {q(T.LATIN_WORD)}))" for x in (i, r))
    overlap = f"len(list_intersect({qw}, {aw})) / greatest(1, least(len({qw}), len({aw})))::DOUBLE"
    names = ("corrupted_unicode", "known_bad_answer", "explicit_nonanswer", "missing_source_context", "unanchored_time_sensitive", "answer_echoes_question")
    return [
        ("synthetic_input", f"{given} IS NOT NULL"), ("empty_instruction", f"{i} = ''"), ("empty_response", f"{r} = ''"), *[(k, s[k]) for k in names],
        ("likely_mismatched_answer", f"{s['asks_back']} AND NOT ({s['answer_echoes_question']}) AND {overlap} < 0.35"), ("unbalanced_backticks", s["unbalanced_backticks"]),
    ]


def common(i: str, r: str) -> list[tuple[str, str]]:
    s = shared(i, r)
    return [
        ("instruction_length", f"length({i}) NOT BETWEEN 20 AND 220"), ("response_length", f"length({r}) NOT BETWEEN 35 AND 900"), ("response_too_short", f"len({words(r)}) < 7"),
        *[(k, s[k]) for k in ("corrupted_unicode", "missing_source_context", "unanchored_time_sensitive", "explicit_nonanswer")], ("meta_response", has(r, P.META)),
        *[(k, s[k]) for k in ("unbalanced_backticks", "answer_echoes_question")], ("response_is_question", s["asks_back"]), ("known_bad_answer", s["known_bad_answer"]),
    ]


def best(x: str, categories: dict[str, str]) -> tuple[str, str]:
    """(name, hits)"""
    tries = "list_max([" + ", ".join(f"{{'hits': {n_of(x, p)}, 'rank': {-k}, 'name': {q(name)}}}" for k, (name, p) in enumerate(categories.items())) + "])"
    return f"CASE WHEN {tries}.hits > 0 THEN {tries}.name ELSE 'other' END", f"CAST({tries}.hits AS BIGINT)"


LINES = f"""{TURNS},
l AS (SELECT conv_id * 1000 + turn AS line, {strip("question")} AS i0, CASE WHEN turn % 5 = 4 THEN 'given' END AS given, {strip("answer")} AS r0 FROM p)"""
# a text may hold the marks of the format itself: parse what was put together
PARSED = f"""{LINES},
lt AS (SELECT line, {nl(T.HF_HEAD)} || i0 || CASE WHEN given IS NULL THEN '' ELSE {nl(T.HF_INPUT)} || given END || {nl(T.HF_RESPONSE)} || r0 AS text FROM l),
lp AS (SELECT line, {strip(f"regexp_extract(text, {q('(?s)' + R.TEMPLATE)}, 1)")} AS instruction,
  CASE WHEN starts_with(text, {nl(T.HF_HEAD)} || regexp_extract(text, {q('(?s)' + R.TEMPLATE)}, 1) || {nl(T.HF_INPUT)}) THEN regexp_extract(text, {q('(?s)' + R.TEMPLATE)}, 2) END AS input,
  {strip(f"regexp_extract(text, {q('(?s)' + R.TEMPLATE)}, 3)")} AS response FROM lt)"""
REASONS = f"""{PARSED},
x0 AS (SELECT line, instruction, {reasons(cleaning("instruction", "input", "response"))} AS own, NOT {has("instruction || chr(10) || response", P.FINANCE)} AS off, array_to_string(regexp_extract_all({fold("instruction")}, {q(T.LATIN_WORD)}), ' ') AS k FROM lp),
x1 AS (SELECT *, min(CASE WHEN len(own) = 0 AND NOT off THEN line END) OVER (PARTITION BY k) AS kept FROM x0),
x AS (SELECT line, list_concat(list_concat(own, CASE WHEN line > kept THEN ['duplicate_instruction'] ELSE [] END), CASE WHEN off THEN ['off_domain'] ELSE [] END) AS reasons FROM x1)"""


def support(r: str, src: str) -> tuple[str, str]:
    """(level, coverage) of substring_support."""
    inside = lambda n: f"len(list_filter({grams(r, n)}, lambda g: contains({src}, g))) > 0"
    four = grams(r, 4)
    level = f"CASE WHEN {inside(5)} THEN 3 WHEN {inside(4)} THEN 2 WHEN {inside(3)} THEN 1 ELSE 0 END"
    return level, f"CASE WHEN len({four}) > 0 THEN len(list_filter({four}, lambda g: contains({src}, g))) / len({four})::DOUBLE ELSE 0::DOUBLE END"


_level, _coverage = support("topic", "src")
_name, _hits = best("i || chr(10) || r", P.FINANCE_CATEGORIES)
CANDIDATES = f"""{TURNS},
g0 AS (SELECT conv_id, turn, {strip("question")} AS i, {strip("answer")} AS r, question FROM p),
g1 AS (SELECT *, {words("r", True)} AS topic, array_to_string({words("i")}, ' ') AS src FROM g0),
g AS (SELECT *, {_level} AS level, {_coverage} AS coverage, {_name} AS category, {_hits} AS hits FROM g1)"""


def points(x: str, low: int, high: int, n: int) -> str:
    return f"CASE WHEN length({x}) BETWEEN {low} AND {high} THEN {n} ELSE 0 END"


_both = "i || chr(10) || r"
FINANCE_REASONS = [
    *common("i", "r"), ("weak_domain_signal", f"NOT {has(_both, P.FINANCE)}"), ("biographical_or_historical_trivia", has("i", P.TRIVIA)), ("not_conceptual", f"NOT {has('i', P.CONCEPTUAL_QUESTION)}"),
    ("formula_or_calculation", f"regexp_matches({_both}, {q('(?i)' + re2(P.FORMULA_HEAVY))})"), ("precise_contextual_fact", has("i", P.PRECISE_FACT)), ("numeric_specific_question", r"regexp_matches(i, '\p{Nd}')"),
    ("case_specific_question", has("i", P.CASE_SPECIFIC)), ("precise_numeric_answer", has("r", P.PRECISE_NUMBER, True)), ("insufficient_textual_grounding", "level < 2"), ("low_textual_coverage", "coverage < 0.70"),
]
CYBER_REASONS = [*common("i", "r"), ("weak_domain_signal", f"NOT {has(_both, P.CYBER)}"), ("source_file_missing", "turn % 2 <> 0"), ("not_textually_grounded", "turn % 2 = 0 AND level = 0"), ("low_textual_coverage", "turn % 2 = 0 AND coverage < 0.30")]
_fam = "['NIST ', 'CERTFR-', 'guide OWASP ', 'ISO_IEC 27001 ', 'CIS_AWS_Storage', 'CIS_', 'ANSSI ', 'x'][CAST(doc_id % 8 + 1 AS INTEGER)] || coalesce(source, '')"
FAMILY = first_of([("ANSSI", "regexp_matches(f, 'ANSSI|anssi|guide_hygiene|back to basics')"), ("NIST", "starts_with(f, 'NIST')"), ("CERTFR", "starts_with(f, 'CERTFR')"), ("OWASP", "contains(f, 'OWASP')"), ("ISO", "starts_with(f, 'ISO_IEC')"), ("CIS_AWS_STORAGE", "contains(f, 'CIS_AWS_Storage')"), ("CIS_OTHER", "starts_with(f, 'CIS_')")], "'none'")
_title = "['PowerPoint ', 'a catalog ', 'lab setup ', 'The Creature from Jekyll Island ', '', 'Learning Python 5e'][CAST(doc_id % 6 + 1 AS INTEGER)] || CASE WHEN doc_id % 6 = 5 THEN '' ELSE coalesce(source, '') END"


def lookup(x: str, values: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.items()) + f" ELSE {q(default)} END"


def stemmed(w: str) -> str:
    return f"CASE WHEN length({w}) > 5 AND ends_with({w}, 'ing') THEN {w}[:-4] WHEN length({w}) > 4 AND ends_with({w}, 'es') THEN {w}[:-3] WHEN length({w}) > 3 AND ends_with({w}, 's') THEN {w}[:-2] ELSE {w} END"


_low = strip("lower(text)")
_dq = quality("t")
_alnum = chars("text", r"\p{L}\p{N}")


def _bad(t: str) -> str:
    n = chars(t, r"\p{L}\p{N}")
    kinds = f"len(list_distinct(string_split(replace({t}, ' ', ''), '')))"
    return f"({n} < 50 AND ({n} / greatest(length({t}), 1)::DOUBLE < 0.40 OR ({kinds} <= 3 AND length({t}) > 20)))"


_required = "list_filter(['the', 'der', 'la'], lambda w: contains(s, w))"
_forbidden = "list_filter(['license', 'copyright'], lambda w: contains(s, w))"
SCORES = f"""{DOCS}, s0 AS (SELECT doc_id, text, {canon("text")} AS s FROM d),
sc AS (SELECT doc_id, round_even((CASE WHEN s <> '' THEN 1.0::DOUBLE ELSE 0 END + len({_required}) / 3.0::DOUBLE + (1 - len({_forbidden}) / 2.0::DOUBLE) + CASE WHEN length({strip("text")}) >= 400 THEN 1 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END) / 5, 6) AS score FROM s0)"""


def pieces(text: str, size: int, overlap: int, kind: str, keep_empty: bool) -> str:
    body = strip("substr(t, a + 1, b - a)")
    where = "p <> '' OR NOT last" if keep_empty else "p <> ''"
    return f"""WITH RECURSIVE {DOCS}, {cutter("d", "doc_id", text, size, overlap, kind)},
z AS (SELECT doc_id, pos, {body} AS p, b >= n AS last FROM cut WHERE n > 0)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS pos, CAST(length(p) AS INTEGER) AS chars, sha256(p) AS sha FROM z WHERE {where}"""


_METHOD = ", 'plain-text' AS extraction_method"
_RECORD = f"{q(DOMAIN)} AS domain, category, 'document ' || document_id AS source_title, '' AS section, CAST(NULL AS INTEGER) AS page_start, CAST(NULL AS INTEGER) AS page_end, source_sha256, {q(rag.RIGHTS)} AS rights_status, {UID} AS chunk_uid, quality_score{_METHOD}"


def mean_of(x: str, places: int) -> str:
    """The mean of scores, each taken to 6 places, rounded half up, in whole numbers."""
    unit = 10 ** (6 - places)
    return f"CAST((CAST(sum(CAST(round_even({x} * 1000000, 0) AS BIGINT)) AS BIGINT) + {unit // 2} * count({x})) // (count({x}) * {unit}) AS DOUBLE) / {10**places}"


SQL: dict[str, str] = {
    "chunks_by_source": f"{WITH_RAG} SELECT title AS source, count(*) AS chunks, CAST(sum(CAST(ceil(length(text) / 4.0) AS BIGINT)) AS BIGINT) AS tokens, {mean_of('quality_score', 3)} AS mean_quality FROM c GROUP BY title",
    "clean_text": f"WITH {DOCS} SELECT doc_id, {clean('text')} AS text FROM d",
    "canonical_hash": f"WITH {DOCS} SELECT doc_id, sha256({canon('text')}) AS sha FROM d",
    "words_ngrams": f"WITH {DOCS}, w AS (SELECT doc_id, {words('text')} AS w, {words('text', True)} AS topic FROM d) SELECT doc_id, len(w) AS n_words, len(topic) AS n_topic, len({grams('topic', 4)}) AS n_grams, sha256(coalesce(array_to_string(w, ' '), '')) AS sha FROM w",
    "near_dup_key": f"WITH {DOCS} SELECT doc_id, sha256(coalesce(array_to_string(list_sort(list_transform({words('text', True)}, lambda w: {stemmed('w')})), ' '), '')) AS near_key, sha256(coalesce(array_to_string(regexp_extract_all({fold('text')}, {q(T.LATIN_WORD)}), ' '), '')) AS alnum_key FROM d",
    "trigrams": f"WITH {DOCS}, s AS (SELECT doc_id, {_low} AS s FROM d) SELECT doc_id, CASE WHEN length(s) < 3 THEN 1 ELSE len(list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3)))) END AS n FROM s",
    "lookups": f"WITH {DOCS} SELECT doc_id, {lookup('lang', T.OCR_LANGUAGES, 'fra+eng')} AS ocr, {lookup(chr(39) + '.' + chr(39) + ' || coalesce(lang, ' + chr(39) * 2 + ')', T.MEDIA_TYPES, 'application/octet-stream')} AS media, CAST(ceil(length(text) / 4.0) AS INTEGER) AS tokens, CASE WHEN doc_id % 13 <= 2 THEN 'brief' WHEN doc_id % 13 <= 5 THEN 'balanced' WHEN doc_id % 13 <= 8 THEN 'detailed' ELSE 'exhaustive' END AS detail, 'other' AS kind FROM d",
    "durations": "WITH v AS (SELECT event_id, value * 100 AS x, CAST(floor(value * 100) AS BIGINT) AS s FROM events) SELECT event_id, CASE WHEN x IS NULL OR x <= 0 THEN 'unknown' WHEN s >= 3600 THEN lpad(CAST(s // 3600 AS VARCHAR), CAST(greatest(2, length(CAST(s // 3600 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') ELSE lpad(CAST(s // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') END AS length FROM v",
    "summary_cleanup": f"SELECT conv_id, turn, {strip('text')} AS text FROM conversations WHERE role = 'assistant'",
    "prompts": f"SELECT conv_id, string_agg(CASE WHEN role IN ('system', 'user', 'assistant') THEN upper(role[1:1]) || role[2:] || ': ' || coalesce(text, '') END, {BREAK} ORDER BY turn) || {BREAK} || 'Assistant:' AS prompt FROM conversations GROUP BY conv_id",
    "chunk_windows": f"WITH RECURSIVE {DOCS}, {cutter('d', 'doc_id', clean('text'), C.RAG_CHARS, C.RAG_OVERLAP, 'window')}, z AS (SELECT doc_id, pos, CASE WHEN n <= {C.RAG_CHARS} THEN t ELSE {clean('substr(t, a + 1, b - a)')} END AS p, n FROM cut) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS pos, CAST(length(p) AS INTEGER) AS chars, sha256(p) AS sha FROM z WHERE p <> '' OR n <= {C.RAG_CHARS}",
    "ir_split": pieces("text", C.IR_CHARS, C.IR_OVERLAP, "block", False),
    "summary_splits": pieces("text", C.SUMMARY_CHARS, 0, "summary", True),
    "repeated_lines": f"WITH {DOCS}, n AS (SELECT source, count(*) AS n FROM d GROUP BY source), l AS (SELECT DISTINCT doc_id, source, {canon('x')} AS line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS x FROM d)) SELECT source, line, count(*) AS pages FROM l JOIN n USING (source) WHERE length(line) BETWEEN 3 AND 120 GROUP BY source, line, n HAVING count(*) >= greatest(3, ceil(n * 0.20))",
    "doc_first_wins": f"WITH {DOCS} SELECT doc_id, sha256(text) AS sha, nullif(min(doc_id) OVER (PARTITION BY text), doc_id) AS duplicate_of FROM d",
    "chunk_quality": f"{WITH_RAG} SELECT document_id, win_pos, keep, round_even(score, 4) AS score, words, status FROM w",
    "rag_chunks": f"{WITH_RAG} SELECT {UID} AS chunk_uid, document_id, chunk_index, category, content_sha256, CAST(length(text) AS INTEGER) AS char_count, words AS word_count, CAST(ceil(length(text) / 4.0) AS INTEGER) AS token_estimate, quality_score FROM c",
    "rag_documents": f"{WITH_RAG}, {RDOCS} SELECT * FROM rd",
    "rag_stats": f"{WITH_RAG}, {RDOCS} SELECT * FROM (SELECT count(*) AS documents_total, CAST(count_if(extraction_status = 'indexed') AS BIGINT) AS documents_indexed, CAST(count_if(extraction_status = 'duplicate') AS BIGINT) AS documents_duplicate, CAST(count_if(extraction_status = 'no_native_text') AS BIGINT) AS documents_no_native_text, CAST(sum(extracted_char_count) AS BIGINT) AS extracted_chars FROM rd), (SELECT CAST(count_if(status = 'indexed') AS BIGINT) AS chunks_indexed, CAST(count_if(status = 'rejected_quality') AS BIGINT) AS chunks_rejected_quality, CAST(count_if(status = 'rejected_duplicate') AS BIGINT) AS chunks_rejected_duplicate FROM w)",
    "rag_category_counts": f"{WITH_RAG} SELECT category, count(*) AS chunks FROM c GROUP BY category",
    "fts_terms": f"{WITH_RAG}, x AS (SELECT document_id, chunk_index, unnest({TERMS}) AS term FROM c) SELECT term, count(DISTINCT (document_id, chunk_index)) AS chunks, count(*) AS occurrences FROM x GROUP BY term",
    "bm25_search": f"{WITH_RAG}, x AS (SELECT {UID} AS id, {TERMS} AS t FROM c), a AS (SELECT DISTINCT unnest({TERMS.replace('text', q(SEARCH))}) AS term), n AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM x), h AS (SELECT id, term, len, count(*) AS tf FROM (SELECT id, len(t) AS len, unnest(t) AS term FROM x) JOIN a USING (term) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM h GROUP BY term) SELECT id, CAST(round_even(sum(CAST(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)) AS DECIMAL(28, 12))), 6) AS DOUBLE) AS score FROM h JOIN f USING (term), n GROUP BY id ORDER BY score DESC, id LIMIT 10",
    "finance_category": f"SELECT p_partkey, {finance_stem('p_name')} AS category FROM part",
    "path_rules": f"WITH {DOCS}, z AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, {_fam} AS f FROM d) SELECT doc_id, CASE WHEN contains(path, '/') THEN upper(split_part(path, '/', 1)) ELSE 'CYBER' END AS category, CASE WHEN contains({fold('path')}, 'finance') THEN 'finance' WHEN contains({fold('path')}, 'cyber') THEN 'cyber' ELSE 'unknown' END AS domain, {FAMILY} AS family FROM z",
    "label_join_quality": f"WITH {DOCS}, z AS (SELECT quality, {clean('text')} AS t FROM d JOIN labels USING (doc_id)), y AS (SELECT quality, {_dq['keep']} AS keep, {_dq['score']} AS score FROM z) SELECT quality, count(*) AS n, CAST(count_if(keep) AS BIGINT) AS kept, {mean_of('score', 4)} AS mean_score FROM y GROUP BY quality",
    "doc_reject": f"WITH {DOCS}, z AS (SELECT doc_id, {fold(_title)} AS t FROM d) SELECT doc_id, {first_of([('presentation_layout', chr(40) + 'contains(t, ' + q('powerpoint') + ') OR contains(t, ' + q('.ppt') + '))'), ('catalog_or_poster', 'contains(t, ' + q('catalog') + ') OR contains(t, ' + q('poster') + ')'), ('lab_setup_or_reference_card', 'contains(t, ' + q('lab setup') + ') OR contains(t, ' + q('quick find chart') + ')'), ('off_domain', 't IN (' + ', '.join(map(q, P.OFF_DOMAIN_TITLES)) + ')')], q('none'))} AS cyber, CASE WHEN contains(t, 'creature from jekyll island') THEN 'untrusted_source' ELSE 'none' END AS finance FROM z",
    "train_reject_reason": f"WITH {DOCS} SELECT doc_id, coalesce({training_reason('text')}, 'none') AS reason FROM d",
    "train_reject_hist": f"WITH {DOCS} SELECT coalesce({training_reason('text')}, 'none') AS reason, count(*) AS n FROM d GROUP BY 1",
    "even_cap": f"{WITH_RAG}, z AS (SELECT document_id, chunk_index, row_number() OVER (PARTITION BY document_id ORDER BY chunk_index) - 1 AS p, count(*) OVER (PARTITION BY document_id) AS n FROM c) SELECT document_id, chunk_index FROM z WHERE n <= 3 OR p IN (0, CAST(round_even((n - 1) / 2.0::DOUBLE, 0) AS BIGINT), n - 1)",
    "overlap_trim": f"{WITH_RAG}, {TRIM} SELECT document_id, chunk_index, overlap_removed, sha256(trimmed) AS sha FROM t",
    "train_export": f"{WITH_RAG}, {CT}, {EXPORT} SELECT document_id, chunk_index, coalesce(reason, 'written') AS reason, CAST(length(trimmed) AS INTEGER) AS chars FROM e",
    "train_report": f"{WITH_RAG}, {CT}, {EXPORT}, k AS (SELECT document_id, count(*) AS n FROM e WHERE reason IS NULL GROUP BY 1) SELECT count(*) AS records, CAST(coalesce(sum(length(trimmed)), 0) AS BIGINT) AS characters, CAST(coalesce(sum(overlap_removed), 0) AS BIGINT) AS overlap_removed, count(DISTINCT document_id) AS sources, coalesce((SELECT max(n) FROM k), 0) AS largest_document_id, coalesce((SELECT max(n) FROM k), 0) AS largest_title_key FROM e WHERE reason IS NULL",
    "chat_split": f"{WITH_RAG}, {CT}, {CHAT} SELECT document_id, chunk_index, CAST(length(context) AS INTEGER) AS context_chars, CAST(length(answer) AS INTEGER) AS answer_chars FROM h",
    "chat_messages": f"{WITH_RAG}, {CT}, {CHAT} SELECT document_id, chunk_index, sha256({nl(P.CONTINUE_INSTRUCTION + chr(10) * 2)} || context || chr(10) || answer) AS message_key, 2 AS n_messages FROM h",
    "chat_report": f"{WITH_RAG}, {CT}, {CHAT} SELECT count(*) AS records, CAST(coalesce(sum(length(context)), 0) AS BIGINT) AS context_chars, CAST(coalesce(sum(length(answer)), 0) AS BIGINT) AS answer_chars FROM h",
    "indexed_chunks": f"{WITH_RAG}, {RDOCS} SELECT rd.document_uid, chunk_index, {UID.replace('source_sha256', 'c.source_sha256')} AS chunk_uid, c.category, 'document ' || c.document_id AS title, rd.rights_status, quality_score FROM c JOIN rd USING (document_id) WHERE quality_score >= 0.9",
    "train_records": f"{WITH_RAG}, {CT}, {EXPORT} SELECT {_RECORD}, CAST(length(trimmed) AS INTEGER) AS chars FROM e WHERE reason IS NULL",
    "chat_metadata": f"{WITH_RAG}, {CT}, {CHAT} SELECT {_RECORD.replace(_METHOD, '')}, 'grounded_document_continuation' AS task, CAST(length(answer) AS INTEGER) AS answer_chars FROM h",
    "train_rejections": f"{WITH_RAG}, {CT}, n0 AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY chunk_index) AS p, count(*) OVER (PARTITION BY document_id) AS n FROM c0), n AS (SELECT * FROM n0 WHERE n <= 2 OR p IN (1, n)), {EXPORT.replace('FROM c0 WINDOW', 'FROM n WINDOW')} SELECT reason, count(*) AS n FROM e WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'document_cap', (SELECT count(*) FROM c0) - (SELECT count(*) FROM n)",
    "top_sources": "SELECT source AS source_file, count(*) AS n FROM documents WHERE coalesce(source, '') <> '' GROUP BY source ORDER BY count(*) DESC, min(doc_id) LIMIT 25",
    "trusted_source": f"WITH {DOCS}, z AS (SELECT doc_id, ['investments.md', 'my investments.md', 'Macroéconomie 3e', 'Security-Analysis (1934).md', 'blog', 'PRINCIPES DE L''ÉCONOMIE', 'Financial Calculus.md'][CAST(doc_id % 7 + 1 AS INTEGER)] || CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(source, '') END AS f FROM d) SELECT doc_id, regexp_matches(f, {q('(?i)' + P.TRUSTED_FINANCE_SOURCE)}) AS trusted FROM z",
    "dense_ids": f"WITH {DOCS} SELECT doc_id, row_number() OVER (ORDER BY sha256(text), doc_id) AS number FROM d",
    "pending_chunks": f"WITH {DOCS} SELECT coalesce(source, 'none') AS source_id, doc_id AS chunk_index, sha256(text) AS chunk_hash FROM d WHERE doc_id % 3 <> 0 OR doc_id % 6 = 0",
    "valid_pairs": f"WITH {DOCS} SELECT coalesce(source, 'none') AS source_id, doc_id AS chunk_index, 'q' || doc_id AS question FROM d WHERE doc_id % 4 <> 0 AND doc_id % 5 <> 0",
    "heading_levels": "SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(coalesce(html, ''), '(?i)<h([1-6])\\b', 1), '') AS INTEGER), 1) AS level FROM pages",
    "snake_names": "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: lower(w)), '_') AS name FROM part",
    "file_names": f"WITH {DOCS}, z AS (SELECT doc_id, coalesce(source, 'none') || '/d' || doc_id AS base, ['.PDF', '.md', '.tar.Mp3', '.webm', '', '.xlsx', '.zzz', '.doc'][CAST(doc_id % 8 + 1 AS INTEGER)] AS s FROM d), y AS (SELECT *, CASE WHEN s = '.tar.Mp3' THEN '.mp3' ELSE lower(s) END AS suffix FROM z) SELECT doc_id, suffix, 'd' || doc_id || CASE WHEN s = '.tar.Mp3' THEN '.tar' ELSE '' END AS stem, CASE suffix WHEN '.mp3' THEN 'audio' WHEN '.webm' THEN 'video' WHEN '' THEN 'other' WHEN '.zzz' THEN 'other' ELSE 'document' END AS kind, {lookup('suffix', T.MEDIA_TYPES, 'application/octet-stream')} AS media, base || s AS below FROM y",
    "path_numbers": f"WITH {DOCS} SELECT doc_id, row_number() OVER (ORDER BY string_split(concat_ws('/', coalesce(source, ''), coalesce(lang, '-'), CAST(doc_id AS VARCHAR)), '/')) AS number FROM d",
    "ratio_sample": "WITH n AS (SELECT greatest(0, greatest(1, CAST(floor(count(*) * 0.3) AS BIGINT)) - count_if(doc_id % 10 = 0)) AS n FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('42/' || doc_id), doc_id) AS k FROM documents WHERE doc_id % 10 <> 0) SELECT doc_id FROM r, n WHERE k <= n",
    "qa_pairs": f"WITH {TURNS} SELECT * FROM p",
    "junk_chunk": f"WITH {DOCS} SELECT doc_id, CASE WHEN {strip('text')} = '' THEN true WHEN {_alnum} >= 150 THEN false WHEN {_alnum} < 40 THEN true ELSE {_alnum} / length(text)::DOUBLE < 0.30 END AS junk FROM d",
    "junk_qa": f"WITH {TURNS}, z AS (SELECT conv_id, turn, {strip('question')} AS q, {strip('answer')} AS a FROM p) SELECT conv_id, turn, coalesce(length(q) < 10 OR length(a) < 10 OR {_bad('q')} OR {_bad('a')}, true) AS junk FROM z",
    "source_refs": f"WITH {TURNS}, z AS (SELECT conv_id, turn, question || ' ' || CASE WHEN turn % 3 = 0 THEN answer || ' as described in the manual' ELSE answer END AS t FROM p) SELECT conv_id, turn, {has('t', P.SOURCE_REFERENCE)} AS refers FROM z",
    "qa_exact_dedup": f"WITH {DOCS} SELECT min(doc_id) AS doc_id FROM d GROUP BY {strip('lower(text)')}",
    "alpaca": f"WITH {TURNS} SELECT {strip('question')} AS instruction, '' AS input, {strip('answer')} AS output FROM p",
    "clean_dataset": f"WITH {TURNS}, z AS (SELECT coalesce({strip('question')}, '') AS instruction, '' AS input, coalesce({strip('answer')}, '') AS output FROM p) SELECT * FROM z WHERE instruction <> '' AND output <> ''",
    "hf_text": f"WITH {TURNS}, z AS (SELECT coalesce({strip('question')}, '') AS i, coalesce({strip('answer')}, '') AS o FROM p) SELECT {nl(T.HF_HEAD)} || i || {nl(T.HF_RESPONSE)} || o AS text FROM z WHERE i <> '' AND o <> ''",
    "qa_markdown": f"WITH {TURNS}, z AS (SELECT {strip('question')} AS q, {strip('answer')} AS a FROM p) SELECT '**Q: ' || q || {nl('**' + chr(10) * 2 + '**A:** ')} || a || {nl(chr(10) * 2 + '---' + chr(10))} AS value FROM z WHERE NOT coalesce(length(q) < 10 OR length(a) < 10 OR {_bad('q')} OR {_bad('a')}, true)",
    "unified_chat": f"WITH {TURNS}, z AS (SELECT coalesce({strip('question')}, '') AS i, coalesce({strip('answer')}, '') AS o FROM p) SELECT i AS asked, o AS said FROM z WHERE i <> '' AND o <> ''",
    "template_parse": f"WITH {PARSED} SELECT * FROM lp",
    "rejection_reasons": f"WITH {REASONS} SELECT line, {joined('reasons')} AS reasons FROM x",
    "reason_hist": f"WITH {REASONS} SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM x) GROUP BY reason",
    "retention": f"WITH {REASONS} SELECT count(*) AS total, CAST(count_if(len(reasons) = 0) AS BIGINT) AS kept, CAST(count_if(len(reasons) > 0) AS BIGINT) AS rejected, round_even(100 * count_if(len(reasons) = 0) / greatest(1, count(*))::DOUBLE, 2) AS retention_percent FROM x",
    "quality_reasons": f"WITH {TURNS}, z AS (SELECT conv_id, turn, {strip('question')} AS i, {strip('answer')} AS r FROM p) SELECT conv_id, turn, {joined(reasons(common('i', 'r')))} AS reasons FROM z",
    "category_argmax": f"WITH {DOCS} SELECT doc_id, {best('text', P.FINANCE_CATEGORIES)[0]} AS finance, {best('text', P.FINANCE_CATEGORIES)[1]} AS finance_hits, {best('text', P.CYBER_CATEGORIES)[0]} AS cyber, {best('text', P.CYBER_CATEGORIES)[1]} AS cyber_hits FROM d",
    "support_coverage": f"WITH {DOCS}, a AS (SELECT item_id, {words('coalesce(text, ' + chr(39) * 2 + ')', True)} AS t FROM benchmark), s AS (SELECT {words('text', True)} AS t FROM d), a4 AS (SELECT item_id, unnest({grams('t', 4)}) AS g FROM a), a5 AS (SELECT item_id, unnest({grams('t', 5)}) AS g FROM a), s4 AS (SELECT DISTINCT unnest({grams('t', 4)}) AS g FROM s), s5 AS (SELECT DISTINCT unnest({grams('t', 5)}) AS g FROM s), h4 AS (SELECT item_id, count(*) AS n, count(s4.g) AS h FROM a4 LEFT JOIN s4 USING (g) GROUP BY 1), h5 AS (SELECT item_id, count(s5.g) AS h FROM a5 LEFT JOIN s5 USING (g) GROUP BY 1) SELECT item_id, CASE WHEN coalesce(h5.h, 0) > 0 THEN 3 WHEN coalesce(h4.h, 0) > 0 THEN 2 ELSE 0 END AS level, round_even(coalesce(h4.h, 0) / greatest(1, coalesce(h4.n, 0))::DOUBLE, 6) AS coverage FROM a LEFT JOIN h4 USING (item_id) LEFT JOIN h5 USING (item_id)",
    "source_support": f"WITH {TURNS}, z AS (SELECT conv_id, turn, {words('answer', True)} AS topic, array_to_string({words('question')}, ' ') AS src FROM p) SELECT conv_id, turn, {_level} AS level, round_even({_coverage}, 6) AS coverage FROM z",
    "gold_score": f"WITH {CANDIDATES} SELECT conv_id, turn, category, CAST(least(hits, 6) * 8 + {points('r', 80, 450, 20)} + {points('i', 35, 150, 10)} + least(len(list_intersect(list_distinct({words('i', True)}), list_distinct(topic))), 5) * 3 + round_even(coverage * 20, 0) AS INTEGER) AS score, CAST(level * 25 + least(hits, 5) * 4 + CASE WHEN {has('i', P.CONCEPTUAL_QUESTION)} THEN 10 ELSE 0 END + {points('r', 70, 450, 10)} + {points('i', 35, 140, 5)} + round_even(coverage * 20, 0) AS INTEGER) AS cyber_score, sha256(encode(i) || '\\x00'::BLOB || encode(r)) AS stable_key FROM g",
    "gold_reasons": f"WITH {CANDIDATES} SELECT conv_id, turn, {joined(reasons(FINANCE_REASONS))} AS finance, CASE conv_id % 3 WHEN 2 THEN 'non_official_source' WHEN 1 THEN 'excluded_source_family' ELSE {joined(reasons(CYBER_REASONS))} END AS cyber FROM g",
    "json_pairs": f"WITH {TURNS} SELECT * FROM p WHERE question IS NOT NULL AND answer IS NOT NULL",
    "json_enrichment": f"WITH {TURNS} SELECT conv_id, turn, question AS input, answer AS output FROM p",
    "parser_score": f"WITH {SCORES} SELECT * FROM sc",
    "parser_summary": f"WITH {SCORES} SELECT parser, count(*) AS cases, count(*) AS successes, {mean_of('score', 4)} AS mean_score, 0.5::DOUBLE AS mean_seconds FROM sc, (SELECT unnest(['native', 'layout']) AS parser) GROUP BY parser",
    "incremental_pending": f"WITH {DOCS} SELECT CAST(doc_id AS VARCHAR) AS source_id, sha256(text) AS source_sha256 FROM d WHERE doc_id % 2 <> 0 OR doc_id % 10 = 0",
    "run_summary": f"WITH {DOCS} SELECT count(*) AS documents_total, CAST(count_if(doc_id % 3 = 0) AS BIGINT) AS documents_success, CAST(count_if(doc_id % 3 = 1) AS BIGINT) AS documents_skipped, CAST(count_if(doc_id % 3 = 2) AS BIGINT) AS documents_failed, CAST(sum(CASE WHEN doc_id % 3 = 0 THEN length(text) ELSE 0 END) AS BIGINT) AS total_characters, CAST(2 * count_if(doc_id % 3 = 0) AS BIGINT) AS total_chunks FROM d",
}
