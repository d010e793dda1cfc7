"""Operator 6: personal data by candidate generators and gradient-boosted trees, in SQL expressions only.

Base patterns (e-mail, IPv4, card, phone) are certain. High-recall generators propose further and
overlapping spans: spelled-out addresses, IPv6, local telephone numbers, digit runs that fail Luhn, long
mixed tokens. Boosted trees score each proposal by its format and by the words before it. The trees and a
threshold for each kind are fitted on the driver on a bounded, generated sample (``SAMPLE`` rows, a
parameter; the tables here carry no labels for personal data) and become ``CASE`` expressions, so that the
data never leave the JVM: no Python worker, no shuffle, one pass over the text.

The patterns use possessive quantifiers wherever giving characters back cannot lead to a match; the matches
are the same as without, and long runs cannot overflow the matcher's stack or take quadratic time. Lists of spans
are walked in sorted order, ``BLOCK`` spans at a time (:func:`scan`), and never compared each with each: a text with
m spans costs m * (BLOCK + m / BLOCK) cheap steps.

Defined cases: a null text counts as empty and stays null when redacted; offsets are code points with the
end exclusive; repeated rows give repeated rows; an empty table gives an empty result; other columns pass
unchanged, whatever their names.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .common import let, table

KINDS = ("email", "ip", "card", "phone")
#: A match can only start where a run of its first characters does, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
#: Only runs of 13 digits or more: shorter ones fail in any case.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Proposals beyond the base: kind, pattern, and a plain test that a text must pass before it is searched.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{2,}+(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{2,}+)++", r"\(at\)|\[at\]"),
    ("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){4,7}(?![0-9A-Fa-f:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    ("card", CARD, CARD),
    ("phone", r"(?<![0-9+.])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    ("secret", r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+={0,2}+", r"[A-Za-z0-9_/+-]{20}"),
)
ALL_KINDS = (*KINDS, "secret")
CONTEXT = 32
CONTEXT_WORDS = r"(?i)(?:tel|phone|fon|call|mobile|mobil|fax|card|visa|karte|tarjeta|carte|mail|contact|ip|host|token|key|secret|passw|bearer|auth)[a-z_]{0,8}[\x20=:.\"'(#-]{0,5}$"
SAMPLE, SEED, PRECISION = 1600, 11, 0.97
FEATURES = ("kind", "length", "digits", "letters", "others", "distinct", "hex", "context", "luhn", "opening")


BLOCK = 64


def scan(items: Column, state: Column, step, emit, kind: str) -> Column:
    """[emit(state before x, x) for x in items], state = step(state, x); kind is the type of what emit gives.

    An array that grows by one is copied each time; so results are gathered in blocks and copied once a block.
    """
    none = F.array().cast(f"array<{kind}>")

    def of_block(before: Column, block: Column) -> Column:
        add = lambda acc, x: F.struct(step(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out"))
        return F.aggregate(block, F.struct(before.alias("state"), none.alias("out")), add)

    def add(acc: Column, i: Column) -> Column:
        done = of_block(acc["state"], F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
        return let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], d["out"]).alias("out")))

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.when(F.size(items) == 0, none).otherwise(F.aggregate(blocks, F.struct(state.alias("state"), none.alias("out")), add, lambda a: a["out"]))


FOUND = "struct<s:string,start:int,before:string>"


def _last(text: Column) -> Column:
    return F.substring(text, -CONTEXT, CONTEXT)


def _found(text: Column, pattern: str, trigger: Column) -> Column:
    """All matches, left to right: array<struct<s, start, before>>; start in code points, before the CONTEXT characters there."""

    def located(matches: Column) -> Column:
        pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("0"), matches.alias("1"))
        state = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
        step = lambda s, x: F.struct((s["at"] + F.length(x["0"]) + F.length(x["1"])).alias("at"), _last(F.concat(s["tail"], x["0"], x["1"])).alias("tail"))
        emit = lambda s, x: F.struct(x["1"].alias("s"), (s["at"] + F.length(x["0"])).alias("start"), _last(F.concat(s["tail"], x["0"])).alias("before"))
        return let(pairs, lambda p: scan(p, state, step, emit, FOUND))

    none = F.array().cast(f"array<{FOUND}>")
    return F.when(trigger, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(located(m)))).otherwise(none)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def _typed(kind: str, found: Column, more: tuple[str, ...] = ()) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["s"])).alias("end"), x["s"].alias("s"), *[x[m].alias(m) for m in more]))


def base_spans(text: Column) -> dict[str, Column]:
    """Of each base kind: array<struct<kind, start, end, s>>, left to right, without overlaps."""
    card_ok = lambda x: let(_digits(x["s"]), lambda d: F.when(F.length(d) > 19, F.lit(False)).otherwise(_luhn(d)))
    return {
        "email": _typed("email", _found(text, EMAIL, F.contains(text, F.lit("@")))),
        "ip": _typed("ip", F.filter(_found(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda x: x["s"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))),
        "card": _typed("card", F.filter(_found(text, CARD, text.rlike("[0-9][\\x20-]?[0-9]")), card_ok)),
        "phone": _typed("phone", F.filter(_found(text, PHONE, F.contains(text, F.lit("+"))), lambda x: F.length(_digits(x["s"])).between(9, 15))),
    }


def _features(x: Column) -> Column:
    s, before = x["s"], x["before"]
    digits = F.length(_digits(s))
    letters = F.length(F.regexp_replace(s, "[^A-Za-z]+", ""))
    luhn = (x["kind"] == "card") & let(_digits(s), lambda d: F.when(F.length(d) > 19, F.lit(False)).otherwise(_luhn(d)))
    kind = F.element_at(F.create_map(*[v for i, k in enumerate(ALL_KINDS) for v in (F.lit(k), F.lit(i))]), x["kind"])
    values = (kind, F.length(s), digits, letters, F.length(s) - digits - letters, F.size(F.array_distinct(F.split(s, ""))), s.rlike("^[0-9a-fA-F]+$"), before.rlike(CONTEXT_WORDS), luhn, before.rlike(r"[\"'(=:]$"))
    return F.struct(*[v.cast("double").alias(n) for n, v in zip(FEATURES, values, strict=True)])


def _py_luhn(d: str) -> bool:
    return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)]) % 10 == 0


def py_features(kind: str, s: str, before: str) -> list[float]:
    """The same features in Python, for fitting and for tests."""
    d, a = re.sub("[^0-9]+", "", s), re.sub("[^A-Za-z]+", "", s)
    return [float(v) for v in (ALL_KINDS.index(kind), len(s), len(d), len(a), len(s) - len(d) - len(a), len(set(s)), bool(re.fullmatch("[0-9a-fA-F]+", s)), bool(re.search(CONTEXT_WORDS, before[-CONTEXT:])), kind == "card" and len(d) <= 19 and _py_luhn(d), bool(re.search(r"[\"'(=:]$", before)))]


def generated_sample(rows: int = SAMPLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Proposals as the generators make them, true and false ones, with features and labels."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(of) for _ in range(n))
    word = lambda: letters(r.randint(2, 10))
    neutral = lambda: " ".join(word() for _ in range(4)) + " "
    keyed = lambda *k: f"{word()} {word()} {r.choice(k)}{r.choice([': ', ' ', ' = ', '=', ' #'])}"
    x, y = [], []

    def put(kind: str, s: str, before: str, label: int) -> None:
        x.append(py_features(kind, s, before))
        y.append(label)

    for _ in range(rows // 16):
        hexes, mixed = letters(r.choice([32, 40, 64]), "0123456789abcdef"), letters(r.randint(20, 48), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        put("secret", r.choice([hexes, mixed]), keyed("token", "api_key", "secret", "password", "key") + r.choice(['"', "'", ""]), 1)
        put("secret", letters(r.randint(15, 90)) + digits(1) + letters(r.randint(5, 60)), keyed("token", "password", "key"), 1)
        put("secret", letters(r.randint(64, 400), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), keyed("token", "secret", "key"), 1)
        put("secret", mixed, neutral() + r.choice(['"', ""]), int(r.random() < 0.35))
        put("secret", "-".join([word(), word(), word(), word(), digits(2)]), neutral(), 0)
        put("secret", letters(24) + digits(1), neutral(), 0)
        for mark in "/-_":
            slug = mark.join(r.choice([word(), word(), digits(4), word() + "-" + word()]) for _ in range(r.randint(5, 9)))
            put("secret", r.choice(["/", ""]) + slug + digits(1), neutral(), 0)
        put("secret", letters(r.randint(24, 60), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"), keyed("token", "api_key", "secret", "key"), 1)
        put("phone", f"({digits(3)}) {digits(3)}-{digits(4)}", r.choice([keyed("tel", "phone", "call", "fax"), neutral()]), 1)
        put("phone", f"{digits(3)}-{digits(3)}-{digits(4)}", keyed("tel", "phone", "mobile"), 1)
        put("phone", f"{digits(4)} {digits(4)} {digits(4)}", neutral(), 0)
        put("phone", f"{digits(2)}.{digits(3)}.{digits(4)}", neutral(), 0)
        put("card", digits(r.randint(13, 24)), r.choice([neutral(), keyed("card", "key")]), 0)
        put("ip", ":".join(letters(4, "0123456789abcdef") for _ in range(8)), r.choice([neutral(), keyed("ip", "host")]), 1)
        put("ip", ":".join(digits(2) for _ in range(5)), neutral(), 0)
        put("email", f"{word()}.{word()} (at) {word()} (dot) {letters(3)}", r.choice([neutral(), keyed("mail", "contact")]), 1)
    return np.array(x), np.array(y, float)


@lru_cache(maxsize=4)
def fitted(rows: int = SAMPLE, seed: int = SEED, precision: float = PRECISION) -> tuple[BoostedTrees, tuple[tuple[str, float], ...]]:
    """The trees, and of each kind the least threshold that keeps the wanted precision on rows the trees did not see."""
    x, y = generated_sample(rows, seed)
    held = np.arange(len(y)) % 5 == 0
    trees = BoostedTrees(list(FEATURES)).fit(x[~held], y[~held])
    vx, vy = generated_sample(rows, seed + 1)
    score, limits = trees.score(vx), []
    for i, kind in enumerate(ALL_KINDS):
        own = vx[:, 0] == i
        order = np.argsort(-score[own])
        good = np.cumsum(vy[own][order]) / np.arange(1, own.sum() + 1) if own.any() else np.array([])
        at = np.flatnonzero(good >= precision)
        limits.append((kind, float(score[own][order][at[-1]]) if len(at) else 2.0))
    return trees, tuple((k, max(0.5, t)) for k, t in limits)


SPAN = "struct<start:int,back:int,is_base:boolean,kind:string,s:string,before:string,hit:boolean>"
FAR = 2**31 - 1


def _apart(proposals: Column, base: Column) -> Column:
    """The proposals, as SPAN by start and then length, that overlap no base span."""
    placed = lambda own, is_base: F.transform(own, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), F.lit(is_base).alias("is_base"), x["kind"].alias("kind"), x["s"].alias("s"), (F.lit("") if is_base else x["before"]).alias("before"), F.lit(False).alias("hit")))
    told = lambda x, hit: F.struct(*[x[f].alias(f) for f in ("start", "back", "is_base", "kind", "s", "before")], (x["hit"] | hit).alias("hit"))
    after_base = lambda c: scan(c, F.lit(0), lambda s, x: F.when(x["is_base"], F.greatest(s, -x["back"])).otherwise(s), lambda s, x: told(x, x["start"] < s), SPAN)
    before_base = lambda c: scan(c, F.lit(FAR), lambda s, x: F.when(x["is_base"], x["start"]).otherwise(s), lambda s, x: told(x, s < -x["back"]), SPAN)
    every = F.array_sort(F.concat(placed(proposals, False), placed(base, True)))
    marked = let(every, lambda c: let(F.reverse(after_base(c)), lambda r: F.reverse(before_base(r))))
    return F.filter(F.when(F.size(base) == 0, F.array_sort(placed(proposals, False))).otherwise(marked), lambda x: ~x["is_base"] & ~x["hit"])


def method_spans(text: Column, base: Column, trees: BoostedTrees, limits: tuple[tuple[str, float], ...]) -> Column:
    """The accepted proposals that overlap no base span; of overlapping ones the first, then the longest."""
    proposals = F.concat(*[_typed(kind, _found(text, pattern, text.rlike(test)), ("before",)) for kind, pattern, test in GENERATORS])
    proposals = F.filter(proposals, lambda x: (x["kind"] != "secret") | x["s"].rlike("[0-9]"))
    at_least = F.create_map(*[F.lit(v) for pair in limits for v in pair])
    kept = "struct<kind:string,start:int,end:int,s:string>"
    empty = F.array().cast(f"array<{kept}>")

    def accepted(c: Column) -> Column:
        good = F.filter(_apart(c, base), lambda x: let(_features(x), lambda f: trees.column(f) >= F.element_at(at_least, x["kind"])))
        first = let(good, lambda g: scan(g, F.lit(0), lambda at, x: F.when(x["start"] >= at, -x["back"]).otherwise(at), lambda at, x: F.struct(F.when(x["start"] >= at, x["kind"]).alias("kind"), x["start"].alias("start"), (-x["back"]).alias("end"), x["s"].alias("s")), kept))
        return F.filter(first, lambda x: x["kind"].isNotNull())

    return let(proposals, lambda c: F.when(F.size(c) == 0, empty).otherwise(accepted(c)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: str) -> Column:
    own = F.filter(spans, lambda x: x["kind"] == kind)
    return F.array_sort(F.transform(own, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))


def detect(docs: DataFrame, text_col: str = "text", seed: int = SEED) -> DataFrame:
    """docs with _base: struct<spans by base kind>, and _extra: the method's spans; columns of these two names are replaced."""
    trees, limits = fitted(seed=seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_base = docs.withColumn("_base", F.struct(*[c.alias(k) for k, c in base_spans(text).items()]))
    base = F.concat(*[F.col(f"_base.{k}") for k in KINDS])
    return with_base.withColumn("_extra", method_spans(text, base, trees, limits))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with every span replaced by its kind in brackets, overlapping spans as one; length_col is brought up to date."""
    columns, text = docs.columns, F.col("text")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text_col).alias("text"))
    found = detect(held, "text")
    spans = F.concat(*[F.col(f"_base.{k}") for k in KINDS], F.col("_extra"))
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def of_block(at: Column, block: Column) -> Column:
        """One block of spans: (where it ends, the new text from at to there), out of one cut of the text."""
        end = F.greatest(at, F.array_max(F.transform(block, lambda x: x["end"])))

        def replaced(cut: Column) -> Column:
            def add(acc: Column, x: Column) -> Column:
                piece = F.concat(acc["out"], F.substring(cut, acc["at"] - at + 1, x["start"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
                return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out"))

            return F.aggregate(block, F.struct(at.alias("at"), F.lit("").alias("out")), add)

        return let(F.substring(text, at + 1, end - at), replaced)

    def joined(s: Column) -> Column:
        add = lambda acc, i: let(of_block(acc["at"], F.slice(s, i * BLOCK + 1, F.lit(BLOCK))), lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))
        rest = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), start, add, rest)

    new_text = F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(let(order, joined))
    out = found.withColumn("_new", new_text)
    named = {text_col: F.col("_new"), **({length_col: F.length("_new").cast("long")} if length_col in columns else {})}
    return out.select(*[named.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document; n_spans counts the base's and the method's spans."""
    found = detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.concat(*[F.col(f"_base.{k}") for k in KINDS])
    every = F.concat(base, F.col("_extra"))
    ordered = F.concat(*[_of_kind(every, k) for k in ALL_KINDS])
    return found.select(
        "doc_id", *[F.size(f"_base.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.size(every).cast("long").alias("n_spans"), F.sha2(_joined(base), 256).alias("base_sha256"), F.when(F.size(base) + F.size("_extra") == 0, F.lit("")).otherwise(_joined(ordered)).alias("spans"),
    )


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op6 alone, which SQL can express."""
    return op6_pii(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256")


_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"),
    ("card", r"[0-9](?:[ -]?[0-9])+"), ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
)
BASE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(f"SELECT r, {i} AS o, '{k}' AS kind, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS p FROM d" for i, (k, p) in enumerate(_PATTERNS))}),
x AS (SELECT r, o, kind, m[i] AS s, CAST(list_sum(list_transform(p[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS b
      FROM f, unnest(range(1, len(m) + 1)) AS u(i)),
g AS (SELECT *, regexp_replace(s, '[^0-9]', '', 'g') AS n FROM x),
k AS (SELECT * FROM g WHERE kind = 'email'
      OR kind = 'ip' AND len(list_filter(string_split(s, '.'), lambda y: length(ltrim(y, '0')) > 3 OR coalesce(TRY_CAST(right(y, 4) AS INTEGER), 0) > 255)) = 0
      OR kind = 'card' AND length(n) BETWEEN 13 AND 19
         AND list_sum(list_transform(range(0, length(n)), lambda j: (CAST(n[length(n) - j] AS INTEGER) * (1 + j % 2)) // 10 + (CAST(n[length(n) - j] AS INTEGER) * (1 + j % 2)) % 10)) % 10 = 0
      OR kind = 'phone' AND length(n) BETWEEN 9 AND 15),
a AS (SELECT r, count_if(o = 0) AS n0, count_if(o = 1) AS n1, count_if(o = 2) AS n2, count_if(o = 3) AS n3, string_agg(kind || ':' || b || ':' || (b + length(s)), ',' ORDER BY o, b) AS spans FROM k GROUP BY r)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_email, CAST(coalesce(n1, 0) AS BIGINT) AS n_ip, CAST(coalesce(n2, 0) AS BIGINT) AS n_card, CAST(coalesce(n3, 0) AS BIGINT) AS n_phone,
       sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN a USING (r)
"""
