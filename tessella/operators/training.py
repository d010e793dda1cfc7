"""Training records from chunks: caps, overlap trimming, rejection codes, deduplication, chat records, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import patterns as P
from ..functions import rules as R
from ..functions import text as T
from .dedup import first_wins
from .shared import stored

# The limits of the export.
MIN_QUALITY, MIN_CHARS, MIN_WORDS, CAP = 0.80, 400, 50, 600
ANCHOR, TAIL = 80, 600
CONTEXT, ANSWER, AROUND = 140, 220, 240
ENDS = r"(?:\n\n|[.?!:]\x20)"


def evenly_spaced(chunks: DataFrame, group: str, order: str, limit: int) -> DataFrame:
    """At most `limit` rows of a group, spread over it evenly from the first to the last; one alone is the middle."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    p = F.row_number().over(W.partitionBy(group).orderBy(order)) - 1
    numbered = chunks.withColumn("_p", p).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(group)))
    if limit == 1:
        keep = F.col("_p") == F.floor(F.col("_n") / 2)
    else:
        # the places are bround(q * step); a row's place can only come from the whole numbers around p / step
        step = F.greatest(F.col("_n") - 1, F.lit(1)) / F.lit(limit - 1)
        near = F.floor(F.col("_p") / step)
        hit = lambda d: F.bround((near + d) * (F.col("_n") - 1) / F.lit(limit - 1)) == F.col("_p")
        keep = hit(0) | hit(1) | hit(-1)
    return numbered.where((F.col("_n") <= limit) | keep).drop("_p", "_n")


def _trimmed(chunks: DataFrame, group: str, index: str, text: str, limits: tuple[int, int] | None = None) -> DataFrame:
    w = W.partitionBy(group).orderBy(index)
    # an overlap lies within the last TAIL characters of the neighbour
    before = F.when(F.lag(index).over(w) == F.col(index) - 1, F.lag(F.right(F.col(text), F.lit(TAIL))).over(w))
    out = chunks.withColumn("_before", before)
    cut = K.trimmed_column(F.col("_before"), F.col(text), ANCHOR, TAIL, limits)
    return out.withColumn("_cut", cut).withColumns({"overlap_removed": F.col("_cut.n"), "trimmed": F.col("_cut.text")}).drop("_before")


def trimmed(chunks: DataFrame, group: str = "document_id", index: str = "chunk_index", text: str = "text") -> DataFrame:
    """chunks with trimmed (the text without what repeats the neighbour before it) and overlap_removed."""
    return _trimmed(chunks, group, index, text).drop("_cut")


def judged(chunks: DataFrame, title: str = "title", domain: str = "domain", min_quality: float = MIN_QUALITY, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, cap: int = CAP) -> DataFrame:
    """Selected, trimmed chunks with a reason: null for those that become training records.

    Rejected titles and capped documents come first, then the text's own reasons, then duplicates and the title
    cap. A capped row is not remembered, so a later copy of it may be written: rows are decided title by title in
    order only where a cap binds; else the first copy wins.
    """
    good = chunks.where(F.col("quality_score") >= min_quality).withColumn("_doc", R.document_rejection(F.col(domain), F.coalesce(F.col(title), F.lit(""))))
    picked = _trimmed(evenly_spaced(good.where("_doc is null"), "document_id", "chunk_index", cap), "document_id", "chunk_index", "text", (min_chars, min_words))
    keys = {"content_key": F.col("_cut.key"), "title_key": T.canonical_text(F.coalesce(F.col(title), F.lit("")))}
    told = stored(picked.withColumn("reason", F.col("_cut.reason")).withColumns(keys).drop("_doc", "_cut"))
    late = decided(told.where("reason is null").select("content_key", "title_key", "document_id", "chunk_index"), cap).where("reason is not null")
    told = told.join(late.select("document_id", "chunk_index", F.col("reason").alias("_late")), ["document_id", "chunk_index"], "left").withColumn("reason", F.coalesce("reason", "_late")).drop("_late")
    of_documents = {"overlap_removed": F.lit(0), "trimmed": F.col("text"), "reason": F.col("_doc"), "content_key": F.lit(None).cast("string"), "title_key": keys["title_key"]}
    return told.unionByName(good.where("_doc is not null").withColumns(of_documents).drop("_doc"))


def decided(passed: DataFrame, cap: int) -> DataFrame:
    """duplicate and title_cap reasons among rows that pass otherwise, in the order of document and chunk.

    passed needs no more than content_key, title_key, document_id and chunk_index. Round by round: of each content the
    earliest undecided row is written unless its title is full by then. A capped row passes its turn to the next copy,
    in another title. Titles with fewer rows than the cap are never ranked, so one round is enough unless caps bind.
    """
    keys = ["document_id", "chunk_index"]
    place = F.struct(*keys)
    titles = W.partitionBy("title_key").orderBy(*keys)
    slim = stored(passed.select("content_key", "title_key", *keys))
    large = stored(slim.groupBy("title_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cap).select("title_key"))
    if large.isEmpty():
        first = first_wins(slim, ["content_key"], keys).select(*keys, F.lit(True).alias("_w"))
        return passed.drop("reason").join(first, keys, "left").withColumn("reason", F.when(F.col("_w").isNull(), "duplicate")).drop("_w")
    rest, written, capped = slim, slim.limit(0), slim.limit(0).select(*keys)
    while True:
        heads = rest.groupBy("content_key").agg(F.min_by("title_key", place).alias("title_key"), F.min(place).alias("_p")).select("content_key", "title_key", "_p.*")
        ranked = heads.join(large, "title_key", "left_semi").withColumn("_written", F.row_number().over(titles))
        over = stored(ranked.where(F.col("_written") > cap).select(*keys))
        # what stands before a title's first capped row is final; a freed place is taken by a later copy in the next round
        written = stored(heads.join(over, keys, "left_anti").select(*slim.columns))
        if over.isEmpty():
            break
        capped = stored(capped.union(over))
        rest = slim.join(capped, keys, "left_anti")
    mark = written.select(*keys, F.lit(True).alias("_w")).unionByName(capped.withColumn("_w", F.lit(False)))
    out = passed.drop("reason").join(mark, keys, "left")
    return out.withColumn("reason", F.when(F.col("_w").isNull(), "duplicate").when(~F.col("_w"), "title_cap")).drop("_w")


def report(rows: DataFrame) -> DataFrame:
    """One row: records, characters, sources, largest source and title, overlap removed."""
    written = rows.where("reason is null")
    most = lambda key: written.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias(f"largest_{key}"))
    total = written.agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.length("trimmed")), F.lit(0)).alias("characters"),
        F.coalesce(F.sum("overlap_removed"), F.lit(0)).alias("overlap_removed"), F.countDistinct("document_id").alias("sources"),
    )
    return total.crossJoin(most("document_id")).crossJoin(most("title_key"))


def reason_histogram(rows: DataFrame, reasons: Column) -> DataFrame:
    """How many rows have each reason; a row counts once for each of its distinct reasons."""
    return rows.select(F.explode(F.array_distinct(reasons)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def split_point(c: Column) -> Column:
    """Where a stripped text parts into context and answer: the sentence or paragraph end nearest to 30 % of it.

    Of two ends as near, the first; without any, the 30 % mark itself. Null if the text is too short for both parts.
    """
    return T.let(c, _split_point)


def _split_point(c: Column) -> Column:
    n = F.length(c)
    upper = n - ANSWER
    target = F.least(upper, F.greatest(F.lit(CONTEXT), F.bround(n * F.lit(0.30)).cast("int")))
    low, high = F.greatest(F.lit(CONTEXT), target - AROUND), F.least(upper, target + AROUND)

    # only the characters around the mark are looked at: the last end before it, and the first after it
    def nearest(x: Column) -> Column:
        start = F.greatest(x["low"], x["target"] - 1)
        before = F.length(F.regexp_extract(F.substr(c, x["low"] + 1, x["target"] - x["low"]), rf"(?s)^.*{ENDS}", 0))
        after = F.length(F.regexp_extract(F.substr(c, start + 1, x["high"] - start), rf"(?s)^.*?{ENDS}", 0))
        choice = F.array(F.when(before > 0, x["low"] + before), F.when(after > 0, start + after))
        return F.array_min(F.transform(F.array_compact(choice), lambda e: F.struct(F.abs(e - x["target"]).alias("far"), e.alias("at"))))["at"]

    best = T.let(F.struct(low.alias("low"), target.alias("target"), high.alias("high")), nearest)
    return F.when(upper > CONTEXT, F.coalesce(best, target))


def chat_records(records: DataFrame, text: str = "trimmed") -> DataFrame:
    """records with context, answer and messages. Texts too short for both parts raise, as do repeated messages
    when :func:`check_chat` is called."""
    own = T.strip(F.col(text))
    cut = records.withColumn("_text", own).withColumn("_at", split_point(F.col("_text")))
    cut = cut.withColumn("context", T.strip(F.substr("_text", F.lit(1), F.col("_at")))).withColumn("answer", T.strip(F.substr("_text", F.col("_at") + 1, F.length("_text"))))
    user = F.concat(F.lit(P.CONTINUE_INSTRUCTION + "\n\n"), F.col("context"))
    said = F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")))
    return cut.withColumn("messages", said).withColumn("message_key", F.sha2(F.concat(user, F.lit("\n"), F.col("answer")), 256)).drop("_text", "_at")


def check_chat(chat: DataFrame, domain: str) -> None:
    """Raises for rows of another domain, too short texts and repeated messages."""
    if not chat.where((F.col("domain") != domain) | F.col("answer").isNull()).isEmpty():
        raise ValueError("rows of another domain, or too short")
    if not chat.groupBy("message_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("repeated messages")


def chat_report(chat: DataFrame) -> DataFrame:
    return chat.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.length("context")), F.lit(0)).alias("context_chars"), F.coalesce(F.sum(F.length("answer")), F.lit(0)).alias("answer_chars"))
