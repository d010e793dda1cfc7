"""Pieces that several training-data operators share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import passing_place, stored  # noqa: F401

#: A word is a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() splits on exactly the six ASCII white-space bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def word_array(text: Column) -> Column:
    """The words of a text as an array; empty for null and for white space alone."""
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod modulus; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, also where a lambda uses it again and again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def even_keys(n: int) -> np.ndarray:
    """n ascending numbers, of which repartition(n, key) deals one to each partition.

    Numbers from 0 to n - 1 would fall on each other: Spark deals by pmod(murmur3(key), n), which is written out here.
    """
    mix = lambda h, k: h ^ (h >> np.uint32(k))
    turn = lambda h, k: (h << np.uint32(k)) | (h >> np.uint32(32 - k))
    found = np.zeros(0, np.int64)
    for size in (32 * n + 64, 512 * n + 4096, 8192 * n):
        keys = np.arange(size, dtype=np.uint32)
        h = turn(keys * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turn(h ^ np.uint32(42), 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h = mix(h ^ np.uint32(4), 16) * np.uint32(0x85EBCA6B)
        h = mix(mix(h, 13) * np.uint32(0xC2B2AE35), 16)
        _, found = np.unique(h.view(np.int32).astype(np.int64) % n, return_index=True)
        if len(found) == n:
            break
    return np.sort(found)


def give_back() -> None:
    """Returns what this Python worker has freed to the system: between tasks it waits beside the JVM's own memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow, with give_back() at the end of each task."""

    def mapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return mapped


HAS_ASCII_UPPER = re.compile(r"[A-Z]")
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
