"""Exact top-k inner products by pivot-table elimination.

The distances of every vector to many pivots are computed once. By the triangle
inequality the largest difference of a query's and a vector's distance to one
pivot is a lower bound of the distance between them, which with both lengths gives
an upper bound of their inner product. Each task takes its vectors in the order of
that bound and stops where the bound falls below the worst of the best k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize, new_folder

SCALE = 1024
PIVOTS = 32
K = 10

# Below every score.
NONE = -(2 ** 63 - 1)
QUERY_MODULUS = 100

# Queries in one block, which is broadcast; vectors are compared with all of it.
BLOCK_QUERIES = 2048

# Bounds that are held at once, and vectors evaluated per query before looking again.
HELD_BOUNDS = 1 << 21
STEP = 32

# Queries that take a step together.
STEP_QUERIES = 256


def integer_vectors(embeddings: DataFrame, id_column: str = "vec_id",
                    vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component of the vectors that take part."""
    sound = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.where(
        F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & sound
    ).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector_column, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.ListArray, width: int, kind: str = "f8") -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS) -> tuple[DataFrame, int]:
    """The vectors with ``d``, their distances to the pivots, written; and their width.

    Pivots are the vectors whose ids have the least hashes.
    """
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    points = np.zeros((len(chosen), width))
    for i, row in enumerate(chosen):
        points[i, :len(row["v"])] = row["v"]
    shared = vectors.sparkSession.sparkContext.broadcast(points)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), width)
            d = np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in places], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32),
                                          pa.array(d.reshape(-1)))], ["vec_id", "v", "d"])

    table = vectors.mapInArrow(measure, "vec_id long, v array<long>, d array<double>")
    return materialize(table.withColumn("row", F.monotonically_increasing_id()), "pivots"), width


class Best:
    """The best k vectors of each query that a task has seen."""

    def __init__(self, queries: np.ndarray, distances: np.ndarray, ids: np.ndarray, k: int):
        self.queries, self.distances, self.ids, self.k = queries, distances, ids, k
        self.exact = queries.astype(np.int64)
        self.length = (queries ** 2).sum(1)
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.seen = np.zeros(len(ids), np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray) -> None:
        exact = vectors.astype(np.int64)
        far = np.zeros((len(self.ids), len(ids)))
        for p in range(distances.shape[1]):
            gap = np.subtract.outer(self.distances[:, p], distances[:, p])
            np.maximum(far, np.abs(gap, out=gap), out=far)
        length = (vectors ** 2).sum(1)
        bound = (self.length[:, None] + length - far * far) / 2
        bound += 1 + 1e-9 * (self.length[:, None] + length)  # more than rounding can lose
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, 1)
        for a in range(0, len(self.ids), STEP_QUERIES):
            active = np.arange(a, min(a + STEP_QUERIES, len(self.ids)))
            for at in range(0, len(ids), STEP):
                worst = self.scores[active, -1]
                full = self.seen[active] >= self.k
                active = active[~full | (bound[active, at] >= worst)]
                if not len(active):
                    break
                self._evaluate(active, order[active, at:at + STEP], ids, exact)

    def _evaluate(self, active, some, ids, exact) -> None:
        scores = np.einsum("qd,qnd->qn", self.exact[active], exact[some])
        names = ids[some]
        own = names == self.ids[active, None]
        self.seen[active] += (~own).sum(1)
        scores = np.where(own, NONE, scores)
        names = np.where(own, np.iinfo(np.int64).max, names)
        scores = np.concatenate([self.scores[active], scores], 1)
        names = np.concatenate([self.found[active], names], 1)
        best = np.lexsort((names, -scores), axis=1)[:, :self.k]
        self.scores[active] = np.take_along_axis(scores, best, 1)
        self.found[active] = np.take_along_axis(names, best, 1)


def top_products(embeddings: DataFrame, modulus: int = QUERY_MODULUS, k: int = K,
                 id_column: str = "vec_id", vector_column: str = "embedding",
                 block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For each vector whose id is divisible by ``modulus`` the k greatest inner products.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id,
    fewer rows if there are fewer candidates. Vectors that are null or hold a null
    or non-finite component, and rows without id, take no part. A query row's
    candidates are all rows with another id. Repeated rows are candidates each, and
    queries each. A shorter vector is taken as if it ended in zeros. Scores must
    fit 64 bits. Other columns are not read; an empty table gives no rows.

    Queries are taken in blocks of about ``block_queries``, each compared with all
    vectors in one pass; a task keeps k rows for each query of the block.
    """
    spark = embeddings.sparkSession
    table, width = pivot_table(integer_vectors(embeddings, id_column, vector_column))
    queries = table.where(F.col("vec_id") % modulus == 0)
    number = queries.count()
    blocks = -(-number // block_queries)
    folder = new_folder(spark, "best")
    schema = "q int, query_id long, vec_id long, score long"
    queries = materialize(
        queries.select("*", F.monotonically_increasing_id().alias("at")), "queries")
    for block in range(blocks):
        rows = queries.where(F.pmod("at", F.lit(blocks)) == block).select("vec_id", "v", "d").collect()
        if not rows:
            continue
        points = np.zeros((len(rows), width))
        for i, row in enumerate(rows):
            points[i, :len(row["v"])] = row["v"]
        shared = spark.sparkContext.broadcast(
            (points, np.array([r["d"] for r in rows]), np.array([r["vec_id"] for r in rows])))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points, distances, names = shared.value
            best = Best(points, distances, names, k)
            most = max(256, HELD_BOUNDS // len(names))
            for batch in batches:
                for a in range(0, batch.num_rows, most):
                    part = batch.slice(a, most)
                    best.add(part.column(0).to_numpy(), _matrix(part.column(1), width),
                             _matrix(part.column(2), distances.shape[1]))
            q, place = np.nonzero(best.found != np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), pa.array(names[q]), pa.array(best.found[q, place]),
                 pa.array(best.scores[q, place])], ["q", "query_id", "vec_id", "score"])

        found = table.select("vec_id", "v", "d").mapInArrow(search, schema)
        order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/block={block}")
    result = "query_id long, rank int, vec_id long, score long"
    if not blocks:
        return spark.createDataFrame([], result)
    return spark.read.schema(result).parquet(*(f"{folder}/block={b}" for b in range(blocks)))
