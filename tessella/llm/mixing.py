"""Operator 5: mixing sources to target weights by weighted fair queueing.

Every source is a queue with a weight. Its documents stand in an order drawn from a hash of their id and text, and
are queued ``cap`` times over (a source smaller than its target is repeated). A copy is served from its virtual start time,
the number of source words queued before it divided by the source's weight, to its virtual finish time, the same with
its own words. The copies of all sources, sorted by finish time and cut where the words served reach the total budget, are
the mix (:func:`mix_documents` sorts and cuts); ``taken`` counts the words of a document's copies served before the cut.

No source is ever gathered in one task: a running sum is taken inside (source, hash bucket) groups and
shifted by the sum of the buckets before, so that a source with a third of all rows is spread evenly. Texts are measured
once, into a slim table; rows that share id and text are added up before anything is shuffled and are one entry with as
many copies. The virtual time of the cut needs only one row for each source: it solves
sum(min(cap_s, v * w_s)) = budget, which is where the sorted copies' sum reaches the budget.

Defined cases: a null text has size 0 and is never taken; null sources form one source, last in order; a null id hashes as
an empty text; repeated rows are queued one after the other, and a mix gives them the other columns of the first by their
JSON form; an empty table gives an empty mix; other columns are carried by :func:`mix_documents` and ignored by
:func:`schedule`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1"


#: Copies of repeated rows that one row stands for at most.
CHUNK = 1000


def _hash(id_col: Column, text_col: Column, seed: str) -> Column:
    text = F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f"/{seed}/"), text).cast("binary"))


def _key(source: Column) -> Column:
    """Stands for the source and is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(_key, _src, source_size) of each source -> with weight, target and the virtual time v of the cut.

    One row for each source passes the unpartitioned windows, never one for each document.
    """
    by_name = W.orderBy(F.col("_src").isNull(), "_src")
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")))
    full = F.col("source_size") * cap
    by_ratio = W.orderBy(full / F.col("weight"), "_rank")
    before, everything = by_ratio.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(full).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = ranked.withColumn("_v", left / weight_left).withColumn("_fits", F.col("_v") <= full / F.col("weight"))
    cut = F.max(F.when(F.col("_fits"), F.col("_v"))).over(everything)
    return filled.withColumn("cut", F.coalesce(cut, F.lit(float("inf")))).select(
        "_key", "_src", "source_size", "weight", "cut", F.least(full.cast("double"), F.col("cut") * F.col("weight")).alias("target")
    )


def _queue(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, cap: int, seed: str) -> DataFrame:
    """Every entry (id, source, hash; n rows of size words) with the words queued before it and the plan of its source."""
    text = F.col(text_col)
    slim = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), _key(F.col(source_col)).alias("_key"), word_count(text).alias("size"), _hash(F.col(id_col), text, seed).alias("_h"))
    entries = slim.groupBy("_key", "_h").agg(F.first("_id").alias("_id"), F.first("_src").alias("_src"), F.first("size").alias("size"), F.count(F.lit(1)).alias("_n"))
    entries = stored(entries.withColumn("_bucket", F.substring("_h", 1, 3)))
    words = F.col("size") * F.col("_n")
    sums = entries.groupBy("_key", "_bucket").agg(F.first("_src").alias("_src"), F.sum(words).alias("_sum"))
    offsets = sums.withColumn("_offset", F.sum("_sum").over(W.partitionBy("_key").orderBy("_bucket")) - F.col("_sum")).drop("_src")
    by_source = sums.groupBy("_key").agg(F.first("_src").alias("_src"), F.sum("_sum").alias("source_size"))
    targets = source_targets(by_source, weights, share, cap)
    plan = offsets.join(targets, "_key").select("_key", "_bucket", "_offset", "source_size", "weight", "cut", "target")
    inside = W.partitionBy("_key", "_bucket").orderBy("_h").rowsBetween(W.unboundedPreceding, 0)
    queued = entries.withColumn("_cum", F.sum(words).over(inside)).join(plan, ["_key", "_bucket"])
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / CHUNK)))
    each = queued.withColumn("_chunk", chunks).withColumn("_before", F.col("_offset") + F.col("_cum") - words + F.col("_chunk") * CHUNK * F.col("size"))
    return each.withColumn("_n", F.least(F.col("_n") - F.col("_chunk") * CHUNK, F.lit(CHUNK))).drop("_offset", "_cum", "_chunk", "_bucket")


def _served(before: Column, cap: int) -> Column:
    """The words of all copies of a document that are served before the cut; before: words queued before its first copy."""
    words, none = F.floor("target").cast("long"), F.lit(0).cast("long")
    out = none
    for k in range(cap):
        out = out + F.greatest(none, F.least(F.col("size"), words - F.col("source_size") * k - before))
    return out.cast("long")


def schedule(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED) -> DataFrame:
    """Each document with its size, its source's size, weight and target, the virtual start and finish time of its first copy, and the words taken.

    The copy that straddles the cut, one for each source, is counted in part.
    """
    q = _queue(docs, id_col, text_col, source_col, weights, share, cap, seed)
    each = q.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).withColumn("_start", F.col("_before") + F.col("_i") * F.col("size"))
    times = [(F.col("_start") / F.col("weight")).alias("start_time"), ((F.col("_start") + F.col("size")) / F.col("weight")).alias("finish_time")]
    return each.select(F.col("_id").alias(id_col), F.col("_src").alias(source_col), "size", "source_size", "weight", "target", *times, _served(F.col("_start"), cap).alias("taken"))


def mix_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED) -> DataFrame:
    """The mix itself: whole documents with docs' own columns, a row for each copy, range-sorted by virtual finish time.

    The straddling copy is taken whole if at least half of it lies before the cut.
    """
    q = _queue(docs, id_col, text_col, source_col, weights, share, cap, seed)
    words = F.floor("target").cast("long")

    def copy(i: Column, k: Column) -> Column:
        """The finish time of pass k of the i-th of the repeated rows, where half of it at least is served before the cut."""
        start = F.col("source_size") * k + F.col("_before") + i * F.col("size")
        return F.when(2 * (words - start) >= F.col("size"), (start + F.col("size")) / F.col("weight"))

    number = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    times = F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda k: F.transform(number, lambda i: copy(i, k)))))
    place = lambda key, h: F.md5(F.concat(h, key).cast("binary")).alias("_place")
    copies = q.where(F.col("size") > 0).select(place(F.col("_key"), F.col("_h")), F.col("_h"), times.alias("_times")).where(F.size("_times") > 0)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(place(_key(F.col(source_col)), _hash(F.col(id_col), F.col(text_col), seed)), F.to_json(F.struct(*others)).alias("_order"), row).groupBy("_place").agg(F.min_by("_row", "_order").alias("_row"))
    timed = rows.join(copies, "_place").select("_row", "_h", F.explode("_times").alias("_time"))
    return timed.repartitionByRange(shuffle_partitions(docs.sparkSession), "_time", "_h").sortWithinPartitions("_time", "_h").select("_row.*")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '/{SEED}/', md5(coalesce(text, '')))) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rk FROM d GROUP BY source),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
v AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS v,
             2 * source_size / CAST(weight AS DOUBLE) AS r
      FROM w WINDOW b AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * (SELECT max(v) FROM v WHERE v <= r)) AS target FROM v),
q AS (SELECT doc_id, size, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS prior
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target)::BIGINT - prior)) + greatest(0, least(size, floor(target)::BIGINT - source_size - prior)) AS BIGINT) AS taken
FROM q
"""
