"""Everything around a model call: prompts, replies, retries, what is enriched, what is restored. The model is injected.

A client is a function of messages (a list of {role, content}) that returns a text. It is made once for each task and
wrapped in :class:`Patient`, which tries again where that can help.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_repair
from ..functions import text as T
from .qa import sampled

# How often a call is tried and how long it waits in between.
TRIES, WAIT, TIMEOUT = 3, 5, 300
PROVIDERS = ("ollama", "vllm")
DOMAINS = ("cyber", "finance", "generic")

Messages = list[dict]
Client = Callable[[Messages], str]


class PermanentError(Exception):
    """An answer that will be the same next time; status is that of the reply, if there was one."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def is_permanent(error: Exception) -> bool:
    """Client errors other than rate limits do not go away by trying again."""
    status = getattr(error, "status", None) or getattr(getattr(error, "response", None), "status_code", None)
    return isinstance(error, PermanentError) and status is None or (status is not None and 400 <= status < 500 and status != 429)


class Patient:
    """A client that tries again: waits of 5 and 10 seconds, none after the last try; an empty reply is an error."""

    def __init__(self, call: Client, tries: int = TRIES, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep):
        self.call, self.tries, self.wait, self.sleep = call, tries, wait, sleep

    def __call__(self, messages: Messages) -> str:
        for k in range(self.tries):
            try:
                reply = self.call(messages)
                if not reply or not reply.strip():
                    raise ValueError("empty reply")
                return reply
            except Exception as e:
                if is_permanent(e) or k + 1 == self.tries:
                    raise
                self.sleep(self.wait * 2**k)
        raise AssertionError("unreachable")


def generation_settings(provider: str, endpoint: str, temperature: float = 0.0, seed: int | None = None) -> dict:
    """What bears on generated text, for the fingerprint of incremental runs; nothing secret."""
    if provider not in PROVIDERS:
        raise ValueError(f"provider must be one of {PROVIDERS}")
    if not 0.0 <= temperature <= 2.0:
        raise ValueError("temperature must be between 0 and 2")
    return {"provider": provider, "endpoint": endpoint.rstrip("/").removesuffix("/api"), "temperature": float(temperature), "seed": seed}


def asked(rows: DataFrame, messages: Column, client: Callable[[], Client], key: str = "reply") -> DataFrame:
    """rows with reply and error: the client's answer to each row's messages (array<struct<role, content>>)."""
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()

        def one(said) -> tuple[str | None, str | None]:
            try:
                return call([{"role": m["role"], "content": m["content"]} for m in said]), None
            except Exception as e:  # a failed call is a row with an error, never the end of a run
                return None, f"{type(e).__name__}: {e}"

        for pdf in batches:
            got = [one(m) for m in pdf["_messages"]]
            yield pdf[names].assign(**{key: [g[0] for g in got], "error": [g[1] for g in got]})

    schema = rows.withColumn(key, F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string")).schema
    return rows.withColumn("_messages", messages).mapInPandas(run, schema)


def _said(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


PAIRS_TASK = """You write training data: question and answer pairs about the document below.

Rules:
1. Ask specific, factual and technical questions, with names, values, commands and settings that the text gives; conceptual ones only if they are not generic.
2. Answers stand alone, are exact, and are plain text without code blocks, markup or line breaks.
3. Never mention the document, its author, a chapter or a publication.
4. Be exhaustive: leave out no important detail.
5. Reply with a JSON array of objects and nothing else: [{"question": "...", "answer": "..."}]

Document:
---
"""


def generated_pairs(chunks: DataFrame, text: str, client: Callable[[], Client]) -> tuple[DataFrame, DataFrame]:
    """(a row for each pair that a reply holds, dead letters). Replies that hold no list give no pairs."""
    prompt = F.concat(F.lit(PAIRS_TASK), F.col(text), F.lit("\n---\n"))
    replies = asked(chunks, F.array(_said("user", prompt)), client).withColumn("_pairs", json_repair.parsed_pairs(F.col("reply")))
    failed = F.coalesce("error", F.when(F.size(F.coalesce("_pairs", F.array().cast("array<struct<question:string,answer:string>>"))) == 0, F.concat(F.lit("JSON parse failed. Raw response: "), F.left("reply", F.lit(500)))))
    good = replies.select(*chunks.columns, F.explode("_pairs").alias("_p")).select(*chunks.columns, "_p.question", "_p.answer")
    return good, dead_letters(replies.withColumn("message", failed).where("message is not null"), "QA GENERATION")


SUMMARY_LENGTH = {
    "brief": "Keep to the most critical information.", "balanced": "Cover the main points.", "detailed": "Include all important technical details, examples and specifics.",
    "exhaustive": "Extract every fact, detail, example, command and configuration; leave nothing out.",
}
SUMMARY_TASK = "You extract technical knowledge as structured Markdown, in English, starting with a heading. No preamble, no conclusion, no questions, nothing about the document itself. Code stays as it is. "


def summarised(chunks: DataFrame, text: str, client: Callable[[], Client], level: int = 7) -> DataFrame:
    """chunks with summary and error; an empty text, an empty reply and a reply without content are errors."""
    band = T.detail_instruction(F.lit(level))
    lengths = F.create_map(*[F.lit(v) for p in SUMMARY_LENGTH.items() for v in p])
    prompt = F.concat(F.lit(f"Detail level {min(10, max(1, level))} of 10. "), F.element_at(lengths, band), F.lit("\n\nDocument:\n---\n"), F.col(text), F.lit("\n---\n"))
    blank = T.strip(F.coalesce(F.col(text), F.lit(""))) == ""
    done = asked(chunks.where(~blank), F.array(_said("system", F.lit(SUMMARY_TASK)), _said("user", prompt)), client)
    done = done.withColumn("summary", F.nullif(T.summary_content(F.col("reply")), F.lit(""))).withColumn("error", F.coalesce("error", F.when(F.col("summary").isNull(), "empty summary"))).drop("reply")
    none = chunks.where(blank).withColumn("error", F.lit("no text to summarise")).withColumn("summary", F.lit(None).cast("string"))
    return done.unionByName(none)


#: What "input" and "output" of an enriched record are to be, by domain.
ENRICHMENT = {
    "cyber": ("a cybersecurity expert", "credible technical context (logs, tool output, scenario)", "summary, MITRE ATT&CK (TXXXX), CVSS, recommendations, IOC"),
    "finance": ("a finance and markets expert", "credible financial context (market data, filings, or a scenario)", "summary, instruments or metrics, risk factors, regulatory notes only when implied, recommendations; no invented tickers, prices or regulations"),
    "generic": ("a technical expert", "realistic technical context", "summary, key facts, constraints, recommendations"),
}


def enrichment_messages(domain: str, question: Column, answer: Column) -> Column:
    if domain not in ENRICHMENT:
        raise ValueError("domain must be one of: cyber, finance, generic")
    who, given, made = ENRICHMENT[domain]
    task = f'You are {who}. Turn the pair into a structured report. Reply with one JSON object with exactly two keys and nothing else: "input" = {given}; "output" = a report with: {made}.'
    return F.array(_said("system", F.lit(task)), _said("user", F.concat(F.lit("Question: "), question, F.lit("\nAnswer: "), answer, F.lit("\n\nGenerate enriched input/output."))))


META = "struct<enriched:boolean,model:string,domain:string>"


def restored(records: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """records (idx, instruction, input, output, _meta) with those that an earlier run has enriched put back by position.

    An earlier run over another number of records says nothing about these.
    """
    if earlier is None or earlier.count() != records.count():
        return records
    done = earlier.where("_meta.enriched").select("idx", *[F.col(c).alias(f"_e_{c}") for c in ("instruction", "input", "output", "_meta")], F.lit(True).alias("_done"))
    joined = records.join(done, "idx", "left")
    return joined.select("idx", *[F.when(F.col("_done"), F.col(f"_e_{c}")).otherwise(F.col(c)).alias(c) for c in ("instruction", "input", "output", "_meta")])


def enriched(records: DataFrame, client: Callable[[], Client], model: str, domain: str = "cyber", ratio: float = 0.3, seed: int = 0, earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(all records, dead letters): a share of them with input and output made by the model and _meta saying so.

    records: idx, instruction, input, output, _meta. What an earlier run has done counts towards the share.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must be between 0 and 1")
    base = restored(records, earlier)
    if ratio == 0:
        return base, base.limit(0).select(F.lit("").alias("source_id"), F.lit("").alias("category"), F.lit("").alias("message"))
    done = F.coalesce(F.col("_meta.enriched"), F.lit(False))
    usable = (F.coalesce("instruction", F.lit("")) != "") & (F.coalesce("output", F.lit("")) != "")
    chosen = sampled(base.select("idx", done.alias("_done")), "idx", ratio, seed, base.where(done).select("idx"))
    todo = base.join(chosen.select("idx"), "idx", "left_semi").where(usable & ~done)
    replies = asked(todo, enrichment_messages(domain, F.col("instruction"), F.col("output")), client).withColumn("_r", json_repair.parsed_enrichment(F.col("reply")))
    good = replies.where("_r.input is not null and _r.output is not null")
    made = good.select("idx", F.col("_r.input").alias("_in"), F.col("_r.output").alias("_out"))
    marked = F.struct(F.lit(True).alias("enriched"), F.lit(model).alias("model"), F.lit(domain).alias("domain"))
    out = base.join(made, "idx", "left").select(
        "idx", "instruction", F.when(F.col("_in").isNotNull(), F.col("_in")).otherwise(F.col("input")).alias("input"), F.when(F.col("_in").isNotNull(), F.col("_out")).otherwise(F.col("output")).alias("output"),
        F.when(F.col("_in").isNotNull(), marked).otherwise(F.col("_meta")).alias("_meta"),
    )
    lost = replies.where("_r.input is null or _r.output is null").withColumn("message", F.coalesce("error", F.concat(F.lit("could not parse: "), F.left("reply", F.lit(300)))))
    return out, dead_letters(lost.withColumn("source_id", F.col("idx").cast("string")), "ENRICHMENT")


def dead_letters(failed: DataFrame, category: str, source: str = "source_id", message: str = "message") -> DataFrame:
    """(source_id, category, message): what could not be done, to be appended to the error table."""
    where = F.col(source).cast("string") if source in failed.columns else F.lit("N/A")
    return failed.select(where.alias("source_id"), F.lit(category).alias("category"), F.col(message).alias("message"))


def log_errors(errors: DataFrame, path: str) -> None:
    """Appends to the error table; each batch's files are published as a whole."""
    errors.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
