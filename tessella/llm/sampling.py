"""Bounded samples of labelled rows for the fitted operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

WHOLE = 1 << 40


def bounded_sample(rows: DataFrame, label: str, per_label: int, keys: tuple[str, ...], salt: int = 0) -> list[Row]:
    """At most per_label rows of each label, those with the smallest hash of their keys, in order of that hash.

    Labels are counted first; each is then thinned by hash to about twice its share while it is read, so that no
    row is shuffled and a label with most rows costs no more than others. Of what is left, a top-k by hash goes to
    the driver: ``labels * (3 * per_label + 300)`` rows at most, also where many rows have equal keys.
    """
    h = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(WHOLE))
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().toLocalIterator()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, (2.0 * per_label + 200) / n) * WHOLE))])
    thin = rows.withColumn("_hash", h).where(F.col("_hash") < F.element_at(share, F.col(label)))
    found = thin.orderBy("_hash", *keys).limit(len(counts) * (3 * per_label + 300)).collect()
    taken, out = dict.fromkeys(counts, 0), []
    for r in found:
        if taken[r[label]] < per_label:
            taken[r[label]] += 1
            out.append(r)
    return out


def few_texts(docs: DataFrame, id_col: str, text_col: str, rows: int, most: int, chars: int) -> list[str]:
    """At most `most` texts of up to `chars` characters, with the smallest hashes; rows is how many docs has.

    For estimates that only move work about. Rows are thinned by hash as they are read, so that no task sends more than its
    share of about 4 * most texts.
    """
    h = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(WHOLE))
    share = int(min(1.0, 4 * most / max(1, rows)) * WHOLE)
    some = docs.where(F.col(text_col).isNotNull() & (F.length(text_col) <= chars)).select(F.col(text_col).alias("t"), h.alias("h")).where(F.col("h") < share)
    return [r["t"] for r in some.orderBy("h", "t").limit(most).collect()]
