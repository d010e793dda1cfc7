"""Question/answer pairs: emission, filters, instruction formats, the record cleaner, curated selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import patterns as P
from ..functions import rules as R
from ..functions import text as T
from .shared import numbered, stored


def turns_to_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, question, answer): a user turn directly followed by an assistant turn."""
    w = W.partitionBy("conv_id").orderBy("turn")
    after = turns.withColumn("_role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w))
    return after.where("role = 'user' and _role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


def emitted(chunks: DataFrame, pairs: Column) -> DataFrame:
    """A row for each generated pair that has both parts and does not speak of its source; chunk columns carried."""
    each = chunks.select("*", F.explode(pairs).alias("_pair")).select("*", "_pair.question", "_pair.answer").drop("_pair")
    return each.where(F.col("question").isNotNull() & F.col("answer").isNotNull() & ~R.refers_to_source(F.col("question"), F.col("answer")))


def without_junk(pairs: DataFrame) -> DataFrame:
    return pairs.where(~R.is_junk_pair(F.col("question"), F.col("answer")))


def alpaca(pairs: DataFrame, source_columns: tuple[str, ...] = ()) -> DataFrame:
    """instruction, input (empty), output; provenance columns go to _meta.source, without nulls."""
    meta = [F.struct(F.struct(*[F.col(c) for c in source_columns]).alias("source")).alias("_meta")] if source_columns else []
    return pairs.select(T.strip(F.col("question")).alias("instruction"), F.lit("").alias("input"), T.strip(F.col("answer")).alias("output"), *meta)


def clean_dataset(records: DataFrame) -> DataFrame:
    """The three text columns, stripped; rows without an instruction or output are dropped."""
    text = {c: T.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("instruction", "input", "output")}
    return records.select(*[v.alias(k) for k, v in text.items()]).where("instruction <> '' and output <> ''")


def to_hf(records: DataFrame) -> DataFrame:
    return records.select(T.hf_text(F.col("instruction"), F.col("input"), F.col("output")).alias("text"))


def pairs_markdown(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.concat(F.lit("**Q: "), T.strip(F.col("question")), F.lit("**\n\n**A:** "), T.strip(F.col("answer")), F.lit("\n\n---\n")).alias("value"))


def unified(records: DataFrame) -> DataFrame:
    """messages, instruction/output (or response) or a templated text, whichever a row has, as chat messages."""
    have = set(records.columns)
    col = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None).cast("string"))
    chat = lambda q, a: F.array(F.struct(F.lit("user").alias("role"), q.alias("content")), F.struct(F.lit("assistant").alias("role"), a.alias("content")))
    q, a, given = col("instruction"), col("output", "response"), col("input")
    asked = F.when(F.coalesce(given, F.lit("")) == "", q).otherwise(F.concat(q, F.lit("\n\n"), given))
    options = [F.when(q.isNotNull() & a.isNotNull(), chat(asked, a))]
    if "messages" in have:
        options.insert(0, F.when(F.size("messages") > 0, F.col("messages")))
    if "text" in have:
        t = R.parsed_template(F.col("text"))
        options.append(F.when(t.isNotNull(), chat(F.concat_ws("\n\n", t["instruction"], t["input"]), t["response"])))
    return records.withColumn("chat", F.coalesce(*options))


def sampled(records: DataFrame, key: str, ratio: float, seed: int, done: DataFrame | None = None) -> DataFrame:
    """max(1, int(n * ratio)) rows, less those done: those with the smallest hashes of seed and key, which names the rows.

    Hashes are ranked range by range, so that neither one task nor the driver sees the whole order.
    """
    wanted = max(1, int(records.count() * ratio))
    if done is not None:
        wanted = max(0, wanted - done.count())
        records = records.join(done.select(key), key, "left_anti")
    h = F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string")), 256)
    ranked = numbered(records.select(key, h.alias("_h")), [F.col("_h"), F.col(key)], "_n")
    return records.join(ranked.where(F.col("_n") < wanted).select(key), key, "left_semi")


def train_test(records: DataFrame, key: Column, percent: int = 1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split by hash, the same at every run."""
    test = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100)) < percent
    return records.where(~test), records.where(test)


# --- the record cleaner ---------------------------------------------------------------------------------------


def template_reasons(lines: DataFrame, value: str, line: str, domain: Column) -> DataFrame:
    """JSON lines -> line, instruction, reasons (empty: kept).

    A kept instruction makes every later row with the same key a duplicate; a rejected one does not.
    """
    parsed = F.try_parse_json(F.col(value))
    kind = F.schema_of_variant(parsed)
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    keys = F.json_object_keys(F.when(is_object, F.col(value)))
    right = is_object & (F.size(keys) == 1) & (F.element_at(keys, 1) == "text")
    raw = F.when(right, F.get_json_object(F.col(value), "$.text"))
    is_text = F.coalesce(F.try_variant_get(parsed, "$.text", "variant").isNotNull() & (F.schema_of_variant(F.try_variant_get(parsed, "$.text", "variant")) == "STRING"), F.lit(False))
    text = F.when(right & is_text, raw)
    structure = R.reason_array([("invalid_json", parsed.isNull()), ("invalid_schema", ~right), ("non_string_text", right & ~is_text), ("invalid_template", R.parsed_template(F.coalesce(text, F.lit(""))).isNull())])
    first = lines.select(F.col(line).alias("line"), domain.alias("_domain"), structure.alias("_structure"), R.parsed_template(F.coalesce(text, F.lit(""))).alias("_t"))
    return with_reasons(first)


def with_reasons(rows: DataFrame) -> DataFrame:
    """line, _domain, _structure, _t (parsed template) -> line, instruction, reasons."""
    own = R.cleaning_reasons(F.col("_t.instruction"), F.col("_t.input"), F.col("_t.response"), F.col("_domain"))
    told = rows.withColumn("_own", F.concat("_structure", F.when(F.col("_t").isNull(), F.array().cast("array<string>")).otherwise(own)))
    told = told.withColumn("_key", F.when(F.col("_t").isNotNull(), T.alnum_key(F.col("_t.instruction"))))
    # judged once, in a slim table; rows without a key join nothing, and meet nowhere
    told = stored(told.select("line", "_own", "_key", F.coalesce("_t.instruction", F.lit("")).alias("instruction")))
    kept = told.where("size(_own) = 0 and _key is not null").groupBy("_key").agg(F.min("line").alias("_kept"))
    told = told.join(kept, "_key", "left")
    again = F.col("line") > F.col("_kept")
    # the code stands before off_domain, in the order of the rules
    placed = F.concat(F.filter("_own", lambda r: r != "off_domain"), F.array(F.lit("duplicate_instruction")), F.filter("_own", lambda r: r == "off_domain"))
    return told.select("line", "instruction", F.when(F.coalesce(again, F.lit(False)), placed).otherwise(F.col("_own")).alias("reasons"))


def retention(rows: DataFrame) -> DataFrame:
    total, kept = F.count(F.lit(1)), F.count_if(F.size("reasons") == 0)
    return rows.agg(total.alias("total"), kept.alias("kept"), (total - kept).alias("rejected"), F.bround(100 * kept / F.greatest(F.lit(1), total), 2).alias("retention_percent"))


# --- grounding and the curated sets ---------------------------------------------------------------------------


def substring_support(response: Column, source: Column) -> Column:
    """struct<level, coverage>: runs of topic words that stand in the source's normalised text, as plain substrings.

    Level 3, 2, 1 for runs of 5, 4, 3 words, 0 for none; coverage is the share of the runs of 4 that are found.
    """

    def found(x: Column) -> Column:
        hits = lambda n: T.let(T.ngrams(x["answer"], n), lambda g: F.struct(F.size(g).alias("n"), F.size(F.filter(g, lambda v: F.contains(x["source"], v))).alias("hits")))
        return F.struct(*[hits(n).alias(f"g{n}") for n in (3, 4, 5)])

    def judged(x: Column) -> Column:
        level = F.when(x["g5"]["hits"] > 0, 3).when(x["g4"]["hits"] > 0, 2).when(x["g3"]["hits"] > 0, 1).otherwise(0)
        return F.struct(level.alias("level"), F.when(x["g4"]["n"] > 0, x["g4"]["hits"] / x["g4"]["n"]).otherwise(0.0).alias("coverage"))

    return T.let(T.let(F.struct(T.words(response, True).alias("answer"), source.alias("source")), found), judged)


#: Lengths of the runs that support an answer, and how many runs of answers are sent to the tasks that read the sources.
SUPPORT, ASKED = (4, 5), 500_000


def token_support(answers: DataFrame, key: str, response: str, sources: DataFrame, source_text: str, same: str | None = None) -> DataFrame:
    """(key, level, coverage): runs of topic words that the sources have as runs of topic words, by equi-join.

    Level 3 for a run of 5, 2 for a run of 4, else 0; with same, only sources with an equal value there count.
    """
    on = [same] if same else []
    asked = {n: stored(answers.select(key, *on, F.explode(T.ngrams(T.words(F.col(response), True), n)).alias("gram"))) for n in SUPPORT}
    each = stored(asked[4].union(asked[5]).select("gram").distinct())
    if each.count() <= ASKED:  # sources then tell only what is asked, in one pass
        wanted = answers.sparkSession.sparkContext.broadcast({r[0] for r in each.collect()})
        told = sources.select(*on, F.explode(K.arrow(K.grams(wanted, SUPPORT), "array<string>", pa.list_(pa.string()))(F.col(source_text))).alias("gram"))
        known = dict.fromkeys(SUPPORT, stored(told.distinct()))
    else:
        known = {n: sources.select(*on, F.explode(T.ngrams(T.words(F.col(source_text), True), n)).alias("gram")).join(each, "gram", "left_semi").select(*on, "gram").distinct() for n in SUPPORT}
    found = [asked[n].join(known[n].withColumn("_hit", F.lit(1)), [*on, "gram"], "left").groupBy(key).agg(F.count(F.lit(1)).alias(f"n{n}"), F.count("_hit").alias(f"h{n}")) for n in SUPPORT]
    both = answers.select(key).join(found[0], key, "left").join(found[1], key, "left").na.fill(0, ["n4", "h4", "n5", "h5"])
    level = F.when(F.col("h5") > 0, 3).when(F.col("h4") > 0, 2).otherwise(0)
    return both.select(key, level.alias("level"), (F.col("h4") / F.greatest(F.lit(1), F.col("n4"))).alias("coverage"))


# Limits of the curated selection.
SAME_RESPONSE, PER_SOURCE = 2, 300


def _chooser(target: int, category_target: int, family_limits: dict[str, int], limited: bool) -> Callable[[Iterator[pd.DataFrame]], pd.DataFrame]:
    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["score", "stable_key"], ascending=[False, True]).to_dict("records")
        taken, used = {}, {}
        count = lambda kind, value: used.get((kind, value), 0)

        def blocked(row: dict, by_category: bool, by_family: bool) -> bool:
            if row["stable_key"] in taken or count("question", row["question_key"]) or count("response", row["response_key"]) >= SAME_RESPONSE:
                return True
            if by_category and count("category", row["category"]) >= category_target:
                return True
            if row["source_file"] and count("source", row["source_file"]) >= PER_SOURCE:
                return True
            return bool(by_family and row["source_family"] and count("family", row["source_family"]) >= family_limits.get(row["source_family"], 0))

        rounds = [(True, limited), (False, limited)] + ([] if limited else [(False, False)])
        for by_category, by_family in rounds:
            for row in rows:
                if len(taken) >= target:
                    break
                if not blocked(row, by_category, by_family):
                    taken[row["stable_key"]] = row
                    for kind, value in (("question", row["question_key"]), ("response", row["response_key"]), ("category", row["category"]), ("source", row["source_file"]), ("family", row["source_family"])):
                        used[kind, value] = count(kind, value) + 1
        return pd.DataFrame({"stable_key": sorted(taken)}, dtype=object)

    return choose


def select_diverse(candidates: DataFrame, target: int, categories: dict[str, str], limited: bool) -> DataFrame:
    """At most `target` candidates, best score first, spread over categories, sources and families, in key order.

    The choice is sequential by definition (a row may be passed over because of any earlier one); only keys and
    scores of the candidates that passed all filters go to the one task that makes it.
    """
    keyed = candidates.withColumn("question_key", T.near_duplicate_key(F.col("instruction"))).withColumn("response_key", F.sha2(T.canonical_text(F.col("response")), 256))
    slim = keyed.select("stable_key", "score", "category", "source_file", "source_family", "question_key", "response_key").distinct()
    chooser = _chooser(target, max(1, target // len(categories)), P.SOURCE_FAMILY_LIMITS, limited)
    chosen = slim.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(chooser, "stable_key string")
    first = candidates.withColumn("_rank", F.row_number().over(W.partitionBy("stable_key").orderBy(F.desc("score"), "instruction"))).where("_rank = 1").drop("_rank")
    return first.join(chosen, "stable_key").withColumn("gold_line", F.row_number().over(W.orderBy("stable_key")))


def answered(rows: DataFrame, prompt: Column, complete: Callable[[], Callable[[str], str]], out: str = "reply") -> DataFrame:
    """rows with the replies of an injected model: complete() makes one client for each task; failures give null."""
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = complete()

        def ask(text: str) -> str | None:
            try:
                return client(text)
            except Exception:  # one bad reply never stops a run; it is found as null
                return None

        for pdf in batches:
            yield pdf.drop(columns="_prompt").assign(**{out: pdf["_prompt"].map(ask)})[[*names, out]]

    schema = rows.withColumn(out, F.lit(None).cast("string")).schema
    return rows.withColumn("_prompt", prompt).mapInPandas(run, schema)
