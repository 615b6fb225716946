"""Exact top-k inner products by pivot-table elimination.

Vectors of whole numbers are lifted by one coordinate to a common length, which makes
the largest inner product the smallest distance. A table of distances from every
candidate to many pivots is computed once; the triangle inequality over all pivots
gives each candidate the greatest known lower bound on its distance to a query.
Candidates are evaluated exactly, in the order of their bounds, until the next bound
cannot beat the k-th best found.

Candidates and queries meet as blocks: each query block goes once to each candidate
block, each meeting returns k rows for a query, and these are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, load

K = 5
SCALE = 256.0
# Pivots, chosen far from each other out of a bounded sample.
PIVOTS, PIVOT_SAMPLE = 16, 256
CANDIDATE_BLOCK, QUERY_BLOCK = 2048, 256
# Candidates evaluated between two looks at the stopping rule.
_STEP = 64
# Whole numbers up to here are exact as doubles.
_EXACT = float(1 << 53)
_NO_ID = np.iinfo(np.int64).max
_LONG = (-(1 << 63), (1 << 63) - 1)


def whole_numbers(values: np.ndarray, scale: float = SCALE) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers held as doubles; beyond the range of a long, its ends."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(left.shape[1], 1)
    if bound < _EXACT:
        return (left @ right.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in right] for x in left]
    return np.array([[min(max(v, _LONG[0]), _LONG[1]) for v in row] for row in exact], np.int64).reshape(len(left), len(right))


def spread_out(sample: np.ndarray, many: int) -> np.ndarray:
    """Up to `many` rows, each far from those before."""
    if not len(sample):
        return sample
    chosen, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(many, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def lifted_distances(rows: np.ndarray, heights: np.ndarray, pivots: np.ndarray, pivot_heights: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, both with their added coordinate."""
    square = (rows**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square + (heights[:, None] - pivot_heights[None]) ** 2, 0))


def heights(rows: np.ndarray, top: float) -> np.ndarray:
    """The added coordinate that brings rows to the length `top` squared."""
    return np.sqrt(np.maximum(top - (rows**2).sum(axis=1), 0))


def best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, query_table: np.ndarray, rows: np.ndarray, ids: np.ndarray, table: np.ndarray, top: float, floors: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its place, and the ids and scores of its best candidates here: score down, id up.

    `floors` are scores that k candidates anywhere are known to reach.
    """
    nearest = np.zeros((len(queries), len(rows)), np.float32)
    for p in range(table.shape[1]):
        np.maximum(nearest, np.abs(query_table[:, p, None] - table[None, :, p]), out=nearest)
    lengths = (queries**2).sum(axis=1)
    for place, (query, own) in enumerate(zip(queries, query_ids, strict=True)):
        most = (lengths[place] + top - nearest[place].astype(np.float64) ** 2) / 2
        # Room for the rounding of distances.
        most += 1 + 1e-5 * (lengths[place] + top)
        most[np.isnan(most)] = np.inf  # beyond the range of doubles nothing is ruled out
        able = np.flatnonzero((most >= floors[place]) & (ids != own))
        able = able[np.argsort(-most[able], kind="stable")]
        found_ids, found = np.empty(0, np.int64), np.empty(0, np.int64)
        for low in range(0, len(able), _STEP):
            part = able[low : low + _STEP]
            if len(found) >= k and most[part[0]] < found[k - 1]:
                break
            found_ids, found = np.concatenate([found_ids, ids[part]]), np.concatenate([found, products(query[None], rows[part])[0]])
            order = np.lexsort((found_ids, ~found))[:k]  # the complement falls where the score rises, for every long
            found_ids, found = found_ids[order], found[order]
        if len(found):
            yield place, found_ids, found


# ---------------------------------------------------------------------- Spark


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(flat.reshape(len(column), dim), scale)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def _blocks(size: int, scale: float, pivots: dict[int, tuple[np.ndarray, float]]) -> Callable:
    """Blocks of candidates, with their distances to the pivots of their dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for dim, rows in _by_dim(batch):
                for low in range(0, rows.num_rows, size):
                    part = rows.slice(low, size)
                    ids = part.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                    values = _matrix(part.column(1), dim, scale)
                    points, top = pivots[dim]
                    table = lifted_distances(values, heights(values, top), points, heights(points, top)).astype(np.float32)
                    row = [[dim], [task + number], [ids.tobytes()], [values.tobytes()], [table.tobytes()]]
                    number += 1
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["dim", "block", "ids", "vectors", "pivot_table"])

    return run


def _meet(k: int, pivots: dict[int, tuple[np.ndarray, float]], samples: dict[int, tuple[np.ndarray, np.ndarray]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_block", "place", "query_id", "vec_id", "score"]
        for batch in batches:
            for dim, q_block, q_ids, q_rows, ids, rows, table in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                points, top = pivots[dim]
                query_ids, own = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                queries = np.frombuffer(q_rows).reshape(len(query_ids), dim)
                candidates = np.frombuffer(rows).reshape(len(own), dim)
                far = np.frombuffer(table, np.float32).reshape(len(own), len(points))
                # Queries have no height: their inner products with lifted rows stay the same.
                near = lifted_distances(queries, np.zeros(len(queries)), points, heights(points, top)).astype(np.float32)
                sample_ids, sample = samples[dim]
                reached = np.where(sample_ids[None] == query_ids[:, None], _LONG[0], products(queries, sample))
                floors = np.sort(reached, axis=1)[:, -k] if len(sample) >= k else np.full(len(queries), _LONG[0])
                out = ([], [], [], [])
                for place, found, scores in best_of_block(queries, query_ids, near, candidates, own, far, top, floors, k):
                    for column, values in zip(out, (np.full(len(found), place), np.full(len(found), query_ids[place]), found, scores), strict=True):
                        column.append(values)
                if out[0]:
                    place, query, vec, score = (np.concatenate(c) for c in out)
                    columns = [pa.array(np.full(len(place), q_block)), pa.array(place), pa.array(query), pa.array(vec, mask=vec == _NO_ID), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: float = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score` of each query's best candidates by inner product of floor(scale * x).

    Ties go to the smaller id. Candidates with the query's id are left out. Vectors
    that are null or hold a null or a number that isn't finite take no part; vectors meet
    those of their own dimension only. A query with fewer candidates has fewer rows,
    none if it has none. Null ids may be found, after all others in ties, but don't ask.
    Rows that repeat an id are candidates each, and ask each. Empty tables give no row.
    """

    def slim(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))

    candidates, asking = slim(vectors), slim(queries).filter("id IS NOT NULL")
    # At least the square of every vector's length, which is all that the heights need.
    square = F.aggregate(F.transform("v", lambda x: F.pow(F.abs(x.cast("double") * scale) + 1, 2.0)), F.lit(0.0), lambda a, x: a + x)
    tops = {r["dim"]: float(r["top"]) for r in candidates.groupBy(F.size("v").alias("dim")).agg(F.max(square).alias("top")).collect()}
    sampled = candidates.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).collect()
    pivots, samples = {}, {}
    for dim, top in tops.items():
        rows = [r for r in sampled if len(r["v"]) == dim]
        values = whole_numbers(np.array([r["v"] for r in rows], np.float64).reshape(len(rows), dim), scale)
        pivots[dim] = (spread_out(values, PIVOTS), top)
        named = [i for i, r in enumerate(rows) if r["id"] is not None]
        samples[dim] = (np.array([rows[i]["id"] for i in named], np.int64), values[named])
    schema = "dim long, block long, ids binary, vectors binary, pivot_table binary"
    blocks = cut_lineage(candidates.mapInArrow(_blocks(CANDIDATE_BLOCK, scale, pivots), schema))
    seekers = asking.filter(F.size("v").isin([int(d) for d in tops])) if tops else asking.filter("false")
    wanted = seekers.mapInArrow(_blocks(QUERY_BLOCK, scale, pivots), schema).select("dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    # Each query block goes once to each candidate block of its dimension.
    sent = wanted.join(blocks.select("dim", "block"), "dim")
    met = sent.join(blocks, ["dim", "block"]).select("dim", "query_block", "query_ids", "query_vectors", "ids", "vectors", "pivot_table")
    found = met.mapInArrow(_meet(k, pivots, samples), "query_block long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_block", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_pivot_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
QUERIES = {"op3_pivot_top_k": op3_pivot_top_k}
ORACLES = {"op3_pivot_top_k": ORACLE}
