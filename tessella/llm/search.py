"""Operator 2: exact top-k inner products by pivot-table elimination.

Distances from every vector to a table of pivots give, by the triangle inequality, a lower bound on the
distance between a query and a candidate: the largest difference of their distances to any one pivot. With
the norms it becomes an upper bound on their inner product, as 2<q,x> = |q|^2 + |x|^2 - |q-x|^2. Candidates
are evaluated in order of that bound and a query stops when its k-th best score beats the bound of the next
candidate, so the answer is exact whatever the pivots are.

Queries are a stated set. They are taken in blocks of at most ``BLOCK`` vectors, the only thing that is
broadcast, one after the other; each block passes over all candidates once, every task keeps its k best for each query,
and a partial top-k is merged by query. Nothing is collected but one block of queries and the pivots.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; nor does a row
without an id. Shorter vectors count as padded with zeros. Rows that repeat an id are candidates each; a
query id that repeats is asked once, with the smallest of its vectors; candidates with the query's own id are
left out. Ties go to the smaller id. Scores beyond the range of a long are held at its ends. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lean, stored, table

K = 5
PIVOTS = 24
BLOCK = 16_384
SCALE = 256.0
#: Candidates evaluated together; a first step finds good scores, later ones only what the bound leaves.
STEP = 512
CANDIDATES = 8192
_EXACT = float(1 << 53)


def _matrix(vectors: list, dim: int, scale: float) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(scale * out)


def usable(vec: Column) -> Column:
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


class PivotTable:
    """Queries, pivots, and the queries' distances to the pivots."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, k: int, scale: float):
        self.ids, self.q, self.pivots, self.k, self.scale = ids, queries, pivots, k, scale
        self.q_norm = (queries**2).sum(1)
        self.q_far = self.distances(queries, self.q_norm)

    def distances(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        square = norm[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * (x @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0))

    def bounds(self, q: int, far: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bounds of query q's inner products; a little slack covers rounding."""
        gap = np.abs(far - self.q_far[q]).max(1) if len(self.pivots) else np.zeros(len(norm))
        gap *= 1 - 1e-9
        top = (self.q_norm[q] + norm - gap * gap) / 2
        return top + 1e-9 * (self.q_norm[q] + norm) + 1e-6

    def exact(self, q: int, x: np.ndarray, largest: float) -> list[int] | np.ndarray:
        if largest * np.abs(self.q[q]).max(initial=0) * max(1, x.shape[1]) < _EXACT:
            return x @ self.q[q]  # sums of integers below 2**53
        own = [int(v) for v in self.q[q]]
        top = np.array([sum(a * int(b) for a, b in zip(own, row, strict=True)) for row in x], dtype=object)
        return np.clip(top, -(2**63), 2**63 - 1)

    def best(self, ids: np.ndarray, x: np.ndarray, kept: list[list[tuple[int, int]]]) -> int:
        """Adds a block of candidates to each query's (score, -id) list, best first; returns how many were evaluated."""
        norm = (x**2).sum(1)
        far, largest, evaluated = self.distances(x, norm), float(np.abs(x).max(initial=0)), 0
        for q in range(len(self.ids)):
            bound = self.bounds(q, far, norm)
            mine = kept[q]
            order = np.flatnonzero(bound >= mine[-1][0]) if len(mine) == self.k else np.arange(len(ids))
            order = order[np.argsort(-bound[order], kind="stable")]
            for at in range(0, len(order), STEP):
                step = order[at : at + STEP]
                if len(mine) == self.k and bound[step[0]] < mine[-1][0]:
                    break
                evaluated += len(step)
                score = self.exact(q, x[step], largest)
                good = np.flatnonzero(ids[step] != self.ids[q])
                if len(good) > self.k:
                    s = score[good]
                    limit = np.partition(s, len(s) - self.k)[len(s) - self.k] if s.dtype != object else sorted(s)[-self.k]
                    good = good[np.asarray(s >= limit, bool)]
                mine = sorted([*mine, *((int(score[i]), -int(ids[step[i]])) for i in good)], reverse=True)[: self.k]
            kept[q] = mine
        return evaluated


def pivots_of(vectors: DataFrame, dim: int, count: int, scale: float) -> np.ndarray:
    """count vectors spread over the table: a bounded sample by hash, thinned by farthest-first choice."""
    rows = vectors.select("_vec").orderBy(F.xxhash64("_id", "_vec"), "_id").limit(16 * count).collect()
    x = _matrix([r[0] for r in rows], dim, scale)
    if not len(x):
        return x
    chosen, near = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: float = SCALE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which is_query holds."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    all_vectors = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_vec"))
    queries = rows.where(is_query).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(F.col(vec_col).cast("array<double>")).alias("_vec"))
    dim = all_vectors.agg(F.max(F.size("_vec"))).first()[0] or 0
    table_of_pivots = pivots_of(all_vectors, dim, pivots, scale)
    parts, last = [], None
    while True:
        more = queries if last is None else queries.where(F.col("_id") > last)
        found = more.orderBy("_id").limit(block).collect()  # one block of the stated queries
        if not found:
            break
        last = found[-1]["_id"]
        model = PivotTable(np.array([r["_id"] for r in found], np.int64), _matrix([r["_vec"] for r in found], dim, scale), table_of_pivots, k, scale)
        shared = spark.sparkContext.broadcast(model)
        if len(found) < block:
            parts.append(_pass(all_vectors, shared, dim, k, scale))
            break
        parts.append(stored(_pass(all_vectors, shared, dim, k, scale)))  # a table, so that one block at a time is held by the tasks
        shared.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(candidates: DataFrame, shared, dim: int, k: int, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: PivotTable = shared.value
        kept: list[list[tuple[int, int]]] = [[] for _ in model.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, CANDIDATES):
                part = batch.slice(at, CANDIDATES)
                x = _matrix(part.column("_vec").to_pylist(), dim, scale)
                model.best(part.column("_id").to_numpy(zero_copy_only=False), x, kept)
        owner = [int(q) for q, mine in zip(model.ids, kept, strict=True) for _ in mine]
        flat = [p for mine in kept for p in mine]
        yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array([-p[1] for p in flat], pa.int64()), pa.array([p[0] for p in flat], pa.int64())], names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(lean(run), "query_id long, vec_id long, score long")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
