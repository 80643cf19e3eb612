"""Exact top-k search by the three-phase uniform threshold.

A vector's score is the sum of its partial scores over PARTS slices of the components; every task holds one list of partial
scores per slice. Phase 1 gathers the k best of the local lists, with their whole scores. Since any k scores make a safe
cutoff, its lists are those of one chunk in LEAD alone: the k-th best is a score that the answer reaches in any case. Phase 2
broadcasts this cutoff; a vector can only reach it if one of its partial scores reaches cutoff / PARTS. Vectors come in order
of their length, and a chunk whose longest vector can't reach a query's cutoff (by Cauchy and Schwarz, slice by slice) isn't
scored for it at all. Phase 3 resolves the scores of the entries that suffice exactly and ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, tune

#: Bytes of the queries of a block (all that is ever broadcast), queries and candidates that are scored at once, slices of the components.
BLOCK_BYTES, TURN, CHUNK, PARTS = 8_000_000, 2048, 1024, 2
#: Of so many chunks of a task phase 1 looks at one (the first always).
LEAD = 8


def scaled(rows: list, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, in float64 (exact for what is scored with it); shorter vectors are filled with 0."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return np.floor(out * scale)


def partial_scores(q: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
    """Exact inner products by slice. Float products are exact below 2^53; beyond that Python's integers take over."""
    width = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, v))
    if q.size and v.size and np.abs(q).max() * np.abs(v).max() * width >= 2.0**52:
        q, v = (np.array([[int(y) for y in x] for x in m], dtype=object).reshape(m.shape) for m in (q, v))
    edges = np.linspace(0, width, PARTS + 1).astype(int)
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _whole(x: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; what doesn't fit becomes the nearest that does."""
    if x.dtype == object:
        return np.array([max(-(2**63) + 1, min(2**63 - 1, int(y))) for y in x.reshape(-1)], np.int64).reshape(x.shape)
    return x.astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            yield part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64), scaled(part.column("embedding").to_pylist(), scale)


def _lists(batches: Iterator[pa.RecordBatch], shared: object, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: for each query the k best whole scores of those that lead a local list."""
    ids, q = shared.value[:2]
    best, known = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), bool)
    for turn, (vec, v) in enumerate(_chunks(batches, scale)):
        if turn % LEAD:
            continue
        width = min(k, len(vec))
        fresh_best, fresh_known = np.zeros((len(ids), PARTS * width), np.int64), np.zeros((len(ids), PARTS * width), bool)
        for lo in range(0, len(ids), TURN):
            rows = slice(lo, lo + TURN)
            parts = partial_scores(q[rows], v)
            total, own = sum(parts), vec[None, :] == ids[rows, None]
            lead = []
            for p in parts:
                p = np.where(own, -np.inf, p) if p.dtype != object else np.where(own, -(2**200), p)
                lead.append(np.argpartition(p, len(vec) - k, axis=1)[:, -k:] if len(vec) > k else np.broadcast_to(np.arange(len(vec)), p.shape))
            at = np.sort(np.concatenate(lead, axis=1), axis=1)
            fresh_known[rows] = np.concatenate((np.ones((len(at), 1), bool), at[:, 1:] != at[:, :-1]), axis=1) & ~np.take_along_axis(own, at, axis=1)
            fresh_best[rows] = _whole(np.take_along_axis(total, at, axis=1))
        best, known = np.concatenate((best, fresh_best), axis=1), np.concatenate((known, fresh_known), axis=1)
        order = np.lexsort((-best, ~known), axis=1)[:, :k]
        best, known = np.take_along_axis(best, order, axis=1), np.take_along_axis(known, order, axis=1)
    if best.shape[1]:
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([b[m].tolist() for b, m in zip(best, known, strict=True)], pa.list_(pa.int64()))], names=["query_id", "best"])


def _lengths(x: np.ndarray, width: int) -> list[np.ndarray]:
    """Length of each row's slices, a little too long, so that products of them are bounds."""
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    edges = np.linspace(0, width, PARTS + 1).astype(int)
    return [np.sqrt((x[:, a:b] ** 2).sum(axis=1)) * (1 + 1e-9) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _sufficient(batches: Iterator[pa.RecordBatch], shared: object, cutoff: object, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: entries with a partial score that suffices, resolved; the k first of this task for each query."""
    ids, q = shared.value[:2]
    cut, reach = cutoff.value
    qs, vs, ss = (np.zeros(0, np.int64) for _ in range(3))
    for vec, v in _chunks(batches, scale):
        width = max(q.shape[1], v.shape[1])
        bound = sum(a * b.max(initial=0.0) for a, b in zip(_lengths(q, width), _lengths(v, width), strict=True))
        able = np.flatnonzero(bound >= reach)
        for lo in range(0, len(able), TURN):
            rows = able[lo : lo + TURN]
            parts = partial_scores(q[rows], v)
            enough = parts[0] * PARTS >= reach[rows, None]
            for p in parts[1:]:
                enough |= p * PARTS >= reach[rows, None]
            i, j = np.nonzero(enough.astype(bool) & (vec[None, :] != ids[rows, None]))
            score = _whole(sum(p[i, j] for p in parts))
            ok = score >= cut[rows[i]]
            qs, vs, ss = np.concatenate((qs, rows[i[ok]])), np.concatenate((vs, vec[j[ok]])), np.concatenate((ss, score[ok]))
        if len(qs) > 4 * k * len(ids):
            qs, vs, ss = _first(qs, vs, ss, k)
    qs, vs, ss = _first(qs, vs, ss, k)
    yield pa.RecordBatch.from_arrays([pa.array(ids[qs]), pa.array(vs), pa.array(ss)], names=["query_id", "vec_id", "score"])


def _first(qs: np.ndarray, vs: np.ndarray, ss: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((vs, -ss, qs))
    qs, vs, ss = qs[order], vs[order], ss[order]
    start = np.searchsorted(qs, qs, side="left")
    ok = np.arange(len(qs)) - start < k
    return qs[ok], vs[ok], ss[ok]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector has no null and no component that isn't finite, and an id."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of floor(scale * x) for each query row.

    Candidates are all rows but those with the query's own id; ties go to the smaller vec_id; fewer than k rows give all.
    Queries are taken in blocks of about BLOCK_BYTES by a hash of their id: a block is all that the driver holds or broadcasts.
    An empty table gives no row; columns other than vec_id and embedding are ignored. Vectors that are null, or hold nulls or components that aren't finite, and null ids take no part; a shorter vector counts
    as filled with zeros. Repeated ids are separate candidates; as queries they count once (by the least vector).
    """
    tune(vectors.sparkSession)
    spark, rows = vectors.sparkSession, usable(vectors)
    queries = rows.where(is_query)
    size = queries.agg(F.approx_count_distinct("vec_id").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    blocks = max(1, -(-8 * (size["n"] or 0) * max(8, size["width"] or 0) // BLOCK_BYTES))
    long = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    sorted_ = rows.withColumn("_len", long).sortWithinPartitions(F.col("_len").desc()).select("vec_id", "embedding")
    out = None
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy("vec_id").collect()
        if not block:
            continue
        ids = np.array([r[0] for r in block], np.int64)
        shared = spark.sparkContext.broadcast((ids, scaled([r[1] for r in block], scale)))
        lists = rows.mapInArrow(lambda it, s=shared: _lists(it, s, k, scale), "query_id long, best array<long>")
        met = {r[0]: r[1] for r in lists.groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k).alias("b")).select("query_id", F.when(F.size("b") >= k, F.element_at("b", k)).alias("c")).collect()}
        cut = np.array([-(2**63) if met.get(i) is None else met[i] for i in ids.tolist()], np.int64)
        reach = np.where(cut == -(2**63), -np.inf, cut.astype(np.float64) - np.abs(cut) * 2.0**-50)  # never above the cutoff
        cutoff = spark.sparkContext.broadcast((cut, reach))
        found = durable(sorted_.mapInArrow(lambda it, s=shared, c=cutoff: _sufficient(it, s, c, k, scale), "query_id long, vec_id long, score long"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(vectors: DataFrame) -> DataFrame:
    """search() of the rows whose vec_id is divisible by 20 for their 20 best at scale 64; edges as there."""
    return search(vectors, F.col("vec_id") % 20 == 0, 20, 64)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
