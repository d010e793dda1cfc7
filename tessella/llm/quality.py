"""Operator 9: quality rules with host-level verdicts, in DataFrame expressions only.

Each document is measured by base rules. Rule failures are added up by host (the document's source); a
host's rate is shrunk towards the rate of all hosts by a beta prior whose two parameters are fitted to the
hosts' rates by moments, so that a host with three documents is not judged on three coin flips. A host
whose shrunk rate passes the limit fails, and its verdict is joined back to all its documents.

Counting is partial before the shuffle, so a host with a third of all rows sends one row for each task. The
verdict table has one row for each failing or passing host and is joined by Spark's own choice of join.

Defined cases: a null or empty text has no words and fails the base rules; null hosts form one host;
repeated rows count each; an empty table gives an empty result; other columns of docs are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_CHARS, let, stored, table, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: The further rules are judged by host alone: a single document is not dropped for them.
MAX_SYMBOLS_PER_WORD = 0.5
MAX_DUP_LINES = 0.3
HOST_LIMIT = 0.5


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows which stand twice or more in the array.

    Windows are compared by a 64-bit hash. Only an array that has a window twice is sorted.
    """

    def covered(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            near = lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, near), lambda x: x["i"]))

        def add(acc: Column, p: Column) -> Column:
            return F.struct((acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n"), p.alias("last"))

        return let(order, lambda s: F.aggregate(positions(s), F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")), add, lambda a: a["n"]))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(words, counted)).cast("long")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs' columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    Columns of these names, and _w and _l, are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    no_space = F.length(F.translate(text, WS_CHARS, ""))
    no_symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
    per_text = let(
        word_array(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))
    )
    per_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    out = docs.withColumns({"_w": per_text, "_l": per_lines, "word_chars": no_space.cast("long"), "n_symbols": no_symbols.cast("long")})
    out = out.withColumns({"n_words": F.col("_w.n_words"), "n_repeat_words": F.col("_w.n_repeat_words"), "n_lines": F.col("_l.n_lines"), "n_dup_lines": F.col("_l.n_dup_lines")}).drop("_w", "_l")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_verdicts(measured: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_host, shrunk rate of each rule, host_failed)."""
    rules = {
        "base": F.col("base_failed"),
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words"),
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
    }
    hosts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n_host"), *[F.count_if(rule).alias(f"k_{name}") for name, rule in rules.items()]
    )
    n, total = F.col("n_host"), F.sum("n_host")
    means = [(F.sum(f"k_{r}") / total).alias(f"m_{r}") for r in rules]
    squares = [(F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / n) / total).alias(f"s_{r}") for r in rules]
    prior = hosts.agg(total.alias("_n"), F.count(F.lit(1)).alias("_hosts"), *means, *squares)
    out = hosts.crossJoin(F.broadcast(prior))  # one row: the prior
    failed = F.lit(False)
    for r in rules:
        m = F.col(f"m_{r}")
        noise = m * (1 - m)
        between = F.col(f"s_{r}") - m * m - noise * F.col("_hosts") / F.col("_n")  # variance between hosts beyond that of coin flips
        strength = F.greatest(F.lit(1.0), F.least(F.lit(1e6), noise / F.greatest(between, F.lit(1e-9)) - 1))
        out = out.withColumn(f"rate_{r}", (F.col(f"k_{r}") + m * strength) / (n + strength))
        failed = failed | (F.col(f"rate_{r}") > limit)
    return out.select("_host", "n_host", *[f"rate_{r}" for r in rules], failed.alias("host_failed"))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each document: carried columns, measures, base_failed, host_failed and kept."""
    slim = docs.select(*[F.col(c) for c in carry], F.col(host_col).alias("_h"), F.col(text_col).alias("_text"))
    measured = stored(measures(slim, "_text").drop("_text"))  # texts are measured once; the slim table is read twice
    hosts = host_verdicts(measured, "_h")
    joined = measured.join(hosts, F.col("_h").eqNullSafe(F.col("_host")), "left").drop("_host", "_h")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False)))


def op9_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_W = r"[^\x20\x09-\x0D]+"
OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents),
g AS (SELECT r, i, [w[i], w[i+1], w[i+2], w[i+3], w[i+4]] AS g FROM d, unnest(range(1, len(w) - 3)) AS x(i)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, sum(least(5, i - prev)) AS n FROM (SELECT r, i, lag(i, 1, -9) OVER (PARTITION BY r ORDER BY i) AS prev FROM p) GROUP BY r),
m AS (SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rep ON d.r = rep.r),
f AS (SELECT *, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, [count_if(base_failed), count_if(n_symbols > 0.5 * n_words), count_if(n_dup_lines > 0.3 * n_lines)] AS k FROM f GROUP BY source),
e AS (SELECT source, n, unnest(k) AS k, unnest([1, 2, 3]) AS rule FROM h),
pr AS (SELECT rule, sum(k) / sum(n) AS mu, sum(k * k / n) / sum(n) AS sq, count(*) / sum(n) AS hn FROM e GROUP BY rule),
st AS (SELECT *, greatest(1.0, least(1e6, mu * (1 - mu) / greatest(sq - mu * mu - mu * (1 - mu) * hn, 1e-9) - 1)) AS s FROM pr),
v AS (SELECT source, bool_or((k + mu * s) / (n + s) > 0.5) AS bad FROM e JOIN st USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
