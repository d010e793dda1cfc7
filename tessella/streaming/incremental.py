"""Incremental runs: a state table of what is done, anti-joins against it, and ingestion as a stream.

A source is current if its last run succeeded with the same content, under the same configuration fingerprint, and
left outputs that are not empty. Everything else is pending. Streams run the same batch functions on each delta.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

STATE = "source_id string, status string, source_sha256 string, fingerprint string, output_bytes long, batch long"
SECRETS = ("api_key", "token", "password", "secret")


def fingerprint(settings: dict) -> str:
    """SHA-256 of the settings as compact JSON with sorted keys; secrets do not count."""
    open_settings = {k: v for k, v in settings.items() if not any(s in k.lower() for s in SECRETS)}
    return hashlib.sha256(json.dumps(open_settings, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each source; an empty state if there is none or it cannot be read."""
    try:
        rows = spark.read.schema(STATE).parquet(path)
        rows.limit(1).count()
    except AnalysisException:
        return spark.createDataFrame([], STATE)
    except Exception:  # a damaged state means: do everything again
        return spark.createDataFrame([], STATE)
    last = W.partitionBy("source_id").orderBy(F.desc("batch"))
    return rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def pending(sources: DataFrame, state: DataFrame, mark: str, force: bool = False) -> DataFrame:
    """Sources (source_id, source_sha256, ...) that are not current."""
    if force:
        return sources
    done = state.where((F.col("status") == "success") & (F.col("fingerprint") == mark) & (F.col("output_bytes") > 0)).select("source_id", "source_sha256")
    return sources.join(done, ["source_id", "source_sha256"], "left_anti")


def pending_chunks(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks (source_id, chunk_index, chunk_hash) not done yet with the same content.

    A pair stays valid as long as its own chunk is unchanged, whatever else changes in the file.
    """
    return chunks.join(done.select("source_id", "chunk_index", "chunk_hash"), ["source_id", "chunk_index", "chunk_hash"], "left_anti")


def valid_pairs(pairs: DataFrame, chunks: DataFrame, mark: str) -> DataFrame:
    """Earlier pairs made under the same fingerprint from chunks that are still there."""
    keys = ["source_id", "chunk_index", "chunk_hash"]
    return pairs.where(F.col("fingerprint") == mark).join(chunks.select(*keys), keys, "left_semi")


def record(done: DataFrame, path: str, batch: int) -> None:
    """Appends states (all STATE columns but batch); a batch that is written twice leaves the same last rows."""
    done.withColumn("batch", F.lit(batch).cast("long")).select(*[c.split()[0] for c in STATE.split(", ")]).write.mode("append").parquet(path)


def ingest(stream: DataFrame, state_path: str, output_path: str, mark: str, build: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Runs build on what is new in a stream of sources (source_id, source_sha256, content ...), all that is there, once.

    Each batch overwrites its own folder of the output, so a batch that is repeated after a failure is not doubled.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        todo = pending(df, read_state(spark, state_path).where(F.col("batch") != number), mark)
        built = build(todo)
        built.write.mode("overwrite").parquet(f"{output_path}/batch={number}")
        sizes = spark.read.parquet(f"{output_path}/batch={number}").groupBy("source_id").agg(F.count(F.lit(1)).alias("output_bytes"))
        states = todo.select("source_id", "source_sha256").join(sizes, "source_id", "left").select(
            "source_id", F.when(F.col("output_bytes") > 0, "success").otherwise("failed").alias("status"), "source_sha256", F.lit(mark).alias("fingerprint"), F.coalesce("output_bytes", F.lit(0)).alias("output_bytes")
        )
        record(states, state_path, number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def nothing_to_do(todo: DataFrame, outputs: list[str], exists: Callable[[str], bool]) -> bool:
    """Whether later phases can be skipped: nothing is pending and every output is there."""
    return all(exists(p) for p in outputs) and todo.isEmpty()


def shut_down(queries: list[StreamingQuery], seconds: int = 300) -> None:
    """Ends streams after the batch that runs; what a batch has not published yet is done again at the next start.

    A batch that takes longer than the wait is cut off: its folder is overwritten then, so nothing is lost or doubled.
    """
    for query in queries:
        try:
            query.processAllAvailable() if seconds <= 0 else query.awaitTermination(seconds)
        finally:
            query.stop()


def in_batches(rows: DataFrame, key: str, batches: int, work: Callable[[DataFrame], DataFrame], output_path: str) -> DataFrame:
    """work over rows in batches by hash of the key, each saved when it is done: an interrupted run resumes at its batch.

    Each batch overwrites its own folder and is marked as done by Spark's committer; finished ones are not done again.
    """
    spark = rows.sparkSession
    place = F.pmod(F.xxhash64(key), F.lit(batches))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k in range(batches):
        mark = jvm.org.apache.hadoop.fs.Path(f"{output_path}/batch={k}/_SUCCESS")
        if not mark.getFileSystem(conf).exists(mark):
            work(rows.where(place == k)).write.mode("overwrite").parquet(f"{output_path}/batch={k}")
    return spark.read.parquet(output_path).drop("batch")
