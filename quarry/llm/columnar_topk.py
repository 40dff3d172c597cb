"""Exact top-k inner products by columnar branch and bound.

Candidates of a task are held dimension block by dimension block.  For a query the scores grow block after block; after
each block a candidate's final score lies within its partial score +- |rest of query| * |rest of candidate|
(Cauchy-Schwarz over the dimensions left).  Candidates whose upper end is below the k-th best lower end, or below the
k-th best score seen in this task, go, and the columns are compacted to the survivors.

Queries come in blocks of about ``query_block`` rows, by a hash; each block is broadcast (its size is bounded by that number
and the dimension), meets all candidates in one scan, and is released once its hits are written.  A task gives k rows a
query, however many candidates it has read.  Rows with components beyond ``LIMIT`` are scored in exact integers instead.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize

#: Components up to this size are held as 32-bit integers; rows with larger ones are scored one by one in exact integers.
LIMIT = 1 << 24


def quantized(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """rid, vec_id, v: components floor(scale * x), wide: whether one is beyond ``LIMIT``.  Vectors that are null or hold null
    or non-finite components are left out; a component that doesn't fit a long raises."""
    v = F.col("e")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    error = F.raise_error(F.lit("a component doesn't fit a long after scaling")).cast("long")
    whole = F.transform(v, lambda x: F.when(F.abs(x * scale) < float(1 << 63), F.floor(x * scale)).otherwise(error))
    rows = (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e")).filter(F.coalesce(ok, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id", whole.alias("v")))
    return rows.withColumn("wide", F.exists("v", lambda x: (x > LIMIT) | (x < -LIMIT)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an int-list column; shorter vectors are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class _Columns:
    """Vectors dimension block by block, with the norm of what is left after each block."""

    def __init__(self, m: np.ndarray, width: int, kind: type):
        self.blocks = [np.ascontiguousarray(m[:, i:i + width].T).astype(kind) for i in range(0, m.shape[1], width)]
        square = [(b.astype(np.float64) ** 2).sum(axis=0) for b in self.blocks]
        rest = np.cumsum(np.array(square[::-1]), axis=0)[::-1]  # mass of block i and those after it
        self.rest = [np.sqrt(r) * (1 + 1e-9) for r in rest[1:]] + [np.zeros(m.shape[0])]


def search(query: _Columns, qi: int, cand: _Columns, own: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that can be among the k best of a query, with their exact scores; ``floor``: the k-th best so far."""
    idx = np.arange(len(own)) if own.all() else np.flatnonzero(own)
    score = np.zeros(len(idx), dtype=cand.blocks[0].dtype)
    for b, block in enumerate(cand.blocks):
        part = block if len(idx) == block.shape[1] else block[:, idx]
        score = score + query.blocks[b][:, qi] @ part
        slack = query.rest[b][qi] * cand.rest[b][idx]
        least = floor
        if len(idx) > k:
            low = score - slack
            least = max(floor, float(np.partition(low, len(low) - k)[len(low) - k]))
        stay = score + slack >= least - 1e-6 * (1 + abs(least))  # ties stay
        if not stay.all():
            idx, score = idx[stay], score[stay]
    return idx, score


def _exact(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in exact integers."""
    scores = [sum(a * b for a, b in zip(row, q.tolist())) for row in m.tolist()]
    if any(not -(1 << 63) <= s < 1 << 63 for s in scores):
        raise OverflowError("an inner product doesn't fit a long")
    return np.array(scores, dtype=np.int64)


def exact_topk(df: DataFrame, query_filter: str = "vec_id % 100 = 0", vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024,
               dim_block: int = 8, query_block: int = 16384, chunk: int = 16384) -> DataFrame:
    """The ``k`` best candidates of each query row (rows of ``df`` for which ``query_filter`` over ``vec_id`` holds):
    query_id, rank from 1, vec_id, score.  Candidates are all rows but the query's own; rows that repeat a vec_id are
    candidates of their own.  Score: integer inner product, ties to the smaller vec_id (null last).  A shorter vector
    counts as filled with zeros.  Vectors that are null or hold null or non-finite components take no part; other
    columns are not read.  Fewer candidates than k: all of them.  Empty table: no rows."""
    spark = df.sparkSession
    rows = materialize(quantized(df, vec_id, vector, scale), "topk-vectors")
    queries = rows.filter(query_filter)
    n_queries, dims = queries.count(), max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    n_blocks = -(-n_queries // query_block) or 1
    found = None
    for b in range(n_blocks):
        part = queries.filter(F.pmod(F.xxhash64("rid"), F.lit(n_blocks)) == b) if n_blocks > 1 else queries
        block = part.toArrow()
        if not block.num_rows:
            continue
        shared = spark.sparkContext.broadcast((block["rid"].to_numpy(), block["vec_id"].to_numpy(), _matrix(block["v"], dims), block["wide"].to_numpy(zero_copy_only=False)))
        hits = rows.mapInArrow(_scan(shared, dims, k, dim_block, chunk), "query_rid long, query_id long, rid long, vec_id long, score long")
        hits = materialize(hits, "topk-hits")
        shared.destroy()
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(shared, dims: int, k: int, dim_block: int, chunk: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_rid, q_id, q, q_wide = shared.value
        narrow_q = np.where(q_wide[:, None], 0, q)
        best: list[tuple] = [(np.empty(0, np.int64),) * 3] * len(q_rid)  # scores, sort ids, rids
        last = np.iinfo(np.int64).max

        def take(parts: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(parts)
            rid, sort_id = t["rid"].to_numpy(), pc.fill_null(t["vec_id"], last).to_numpy()
            m, wide = _matrix(t["v"], dims), t["wide"].to_numpy()
            narrow = np.where(wide[:, None], 0, m)
            top = max(1, int(np.abs(narrow).max(initial=0))) * max(1, int(np.abs(narrow_q).max(initial=0))) * dims
            kind = np.float64 if top < 1 << 52 else np.int64  # products and sums of doubles are exact below
            cand, query = _Columns(narrow, dim_block, kind), _Columns(narrow_q, dim_block, kind)
            for i in range(len(q_rid)):
                s, n, r = best[i]
                floor = float(s[-1]) if len(s) == k else -np.inf
                own = rid != q_rid[i]
                idx, score = search(query, i, cand, own & ~wide & ~q_wide[i], k, floor)
                exact = np.flatnonzero(own & (wide | q_wide[i]))
                if len(exact):
                    idx, score = np.concatenate((idx, exact)), np.concatenate((score.astype(np.int64), _exact(m[exact], q[i])))
                if len(idx):
                    s, n, r = np.concatenate((s, score.astype(np.int64))), np.concatenate((n, sort_id[idx])), np.concatenate((r, rid[idx]))
                    o = np.lexsort((r, n, -s))[:k]
                    best[i] = s[o], n[o], r[o]

        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += batch.num_rows
            if size >= chunk:
                take(parts)
                parts, size = [], 0
        if size:
            take(parts)
        got = [len(b[0]) for b in best]
        if sum(got):
            s, n, r = (np.concatenate([b[i] for b in best]) for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_rid, got)), pa.array(np.repeat(q_id, got)), pa.array(r), pa.array(n, mask=n == last), pa.array(s)],
                                             ["query_rid", "query_id", "rid", "vec_id", "score"])

    return scan
