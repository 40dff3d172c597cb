"""Centroid clustering: Lloyd's rounds over vectors that are sharded by dimension.

Vectors are cut into blocks of rows and, across, into shards of ``dim_block`` components; a (block, shard) piece is one row
of a bucketed table.  In a round every piece meets its shard's slice of the centroids and gives the exact partial squared
distances of its rows; the partial distances of a block are added over the shards, which yields the nearest centroids; the
labels go back to the pieces, whose sums update each shard's own slice.  Only partial distances and labels are shuffled,
the pieces stay in their buckets.  All arithmetic is on integers, so results don't depend on order or partitioning.

The centroids of each round are written to shared storage (k x dimension numbers), so a lost executor repeats tasks of
one round at most.
"""
from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, scratch_dir

#: Partial distances of a piece: 8 MB.
CELLS = 1 << 20
#: Bytes of pieces in a bucket.
BUCKET = 64 << 20


def whole_vectors(df: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """vec_id, v: components floor(scale * x) of the vectors with exactly ``dims`` components, none null or non-finite."""
    v, limit = F.col("e"), math.isqrt((1 << 61) // dims)   # dims * (2 * limit)**2 < 2**63: distances fit a long
    ok = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    error = F.raise_error(F.lit(f"a component is {limit} or more in size after scaling: its squared distances don't fit a long")).cast("long")
    whole = F.transform(v, lambda x: F.when(F.abs(x * scale) < float(limit), F.floor(x * scale)).otherwise(error))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e"))
    return rows.filter(F.coalesce(ok, F.lit(False))).select("vec_id", whole.alias("v"))


def _pieces(rows: DataFrame, dims: int, width: int, block: int) -> DataFrame:
    """block, shard, ids (in shard 0), x (int32 rows of the shard's components)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            m = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype("<i4")
            for lo in range(0, len(m), block):
                part = m[lo:lo + block]
                x = [np.ascontiguousarray(part[:, d:d + width]).tobytes() for d in range(0, dims, width)]
                own = [ids.slice(lo, block).to_pylist() if s == 0 else None for s in range(len(x))]
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(x), pa.int64()), pa.array(range(len(x)), pa.int32()),
                                                  pa.array(own, pa.list_(pa.int64())), pa.array(x, pa.binary())], names=["block", "shard", "ids", "x"])
                at += 1
    return rows.mapInArrow(cut, "block long, shard int, ids array<long>, x binary")


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to those of c, over these components."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * top * top * x.shape[1] < 1 << 53 else np.int64   # whole doubles below 2**53 are exact
    x, c = x.astype(kind), c.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype("<i8")


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in batch.to_pylist():
            c = np.array(piece["slice"], dtype=np.int64)
            x = np.frombuffer(piece["x"], dtype="<i4").reshape(-1, c.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array([piece["block"]], pa.int64()), pa.array([len(c)], pa.int32()),
                                              pa.array([_distances(x, c).tobytes()], pa.binary())], names=["block", "k", "d"])


def _nearest(shards: int):
    def nearest(part: pd.DataFrame) -> pd.DataFrame:
        if len(part) != shards:
            raise ValueError(f"block {part['block'].iat[0]} has partial distances of {len(part)} shards, not {shards}")
        total = np.frombuffer(part["d"].iat[0], dtype="<i8").copy()
        for d in part["d"].iloc[1:]:
            total += np.frombuffer(d, dtype="<i8")
        total = total.reshape(-1, part["k"].iat[0])
        label = total.argmin(axis=1)                                              # the first: ties to the smaller number
        return pd.DataFrame({"block": part["block"].iloc[:1], "label": [label.astype(np.int32)], "distance": [total[np.arange(len(label)), label]]})
    return nearest


def _sums(k: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece in batch.to_pylist():
                label = np.array(piece["label"], dtype=np.int64)
                x = np.frombuffer(piece["x"], dtype="<i4").reshape(len(label), -1).astype(np.int64)
                mine = kept.setdefault(piece["shard"], np.zeros((k, x.shape[1] + 1), dtype=np.int64))
                np.add.at(mine, label, np.hstack([np.ones((len(x), 1), dtype=np.int64), x]))
        for shard, part in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard] * k, pa.int32()), pa.array(range(k), pa.int32()),
                                              pa.array(list(part), pa.list_(pa.int64()))], names=["shard", "cluster", "part"])
    return add


def _floor_div(a: Column, n: Column) -> Column:
    """floor(a / n), exactly."""
    return F.call_function("div", a - F.pmod(a, n), n)


def lloyd(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024,
          seed: str = "3", dim_block: int = 16) -> tuple[DataFrame, DataFrame]:
    """``rounds`` rounds of Lloyd's method over the vectors with exactly ``dims`` components, each made whole as
    floor(scale * x), and one last assignment.

    Returns (vec_id, cluster, distance), a row for each such vector, and (cluster, centroid).  The centroids start as the
    ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>`` (equal ids: by components); of fewer vectors all.  A
    vector goes to the nearest centroid by squared distance, ties to the smaller number; a centroid becomes the floor of
    its vectors' mean, an empty one stays.

    Null, shorter or longer vectors and those with a null or non-finite component take no part; a null id counts as
    empty text in the hash and stays null; rows that repeat are vectors of their own; no vector gives empty tables; other
    columns are not read.  A component too large for exact distances raises."""
    spark, width = df.sparkSession, min(dim_block, dims)
    shards = math.ceil(dims / width)
    rows = whole_vectors(df, vec_id, vector, dims, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(key, "v").limit(k).collect()                            # k x dims numbers
    if not first:
        empty = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        return empty, empty.select("cluster", F.lit(None).cast("array<long>").alias("centroid"))
    k = len(first)
    slices = [(s, c, [int(x) for x in r["v"][s * width:(s + 1) * width]]) for c, r in enumerate(first) for s in range(shards)]
    centres = materialize(spark.createDataFrame(slices, "shard int, cluster int, c array<long>").coalesce(1), "centres")
    table = f"lloyd_{uuid.uuid4().hex}"
    n = rows.count()
    cut = _pieces(rows, dims, width, max(16, min(4096, CELLS // k)))
    buckets = max(shards, min(8192, -(-n * dims * 4 // BUCKET)), min(64, spark.sparkContext.defaultParallelism))
    cut.repartition(buckets, "shard", "block").write.bucketBy(buckets, "shard", "block").option("path", scratch_dir(spark, "lloyd")).format("parquet").saveAsTable(table)
    try:
        pieces = spark.table(table)
        every = F.explode(F.sequence(F.lit(0).cast("int"), F.lit(shards - 1).cast("int")))

        def assigned(centres: DataFrame) -> DataFrame:
            ordered = F.sort_array(F.collect_list(F.struct("cluster", "c")))
            by_shard = centres.groupBy("shard").agg(F.transform(ordered, lambda s: s["c"]).alias("slice"))     # k vectors a row
            parts = pieces.select("block", "shard", "x").join(by_shard, "shard").select("block", "x", "slice")
            parts = parts.mapInArrow(_partials, "block long, k int, d binary")
            return parts.groupBy("block").applyInPandas(_nearest(shards), "block long, label array<int>, distance array<long>")

        for number in range(rounds):
            labels = assigned(centres).select("block", every.alias("shard"), "label")
            sums = pieces.select("block", "shard", "x").join(labels, ["shard", "block"]).select("shard", "x", "label").mapInArrow(_sums(k), "shard int, cluster int, part array<long>")
            sums = sums.groupBy("shard", "cluster").agg(F.sum(F.col("part")[0]).alias("n"), F.array(*[F.sum(F.get("part", F.lit(i + 1))) for i in range(width)]).alias("s"))
            new = F.transform("c", lambda x, i: F.when(F.coalesce("n", F.lit(0)) == 0, x).otherwise(_floor_div(F.get("s", i), F.col("n"))))
            centres = materialize(centres.join(sums, ["shard", "cluster"], "left").select("shard", "cluster", new.alias("c")), f"centres-{number + 1}")
        ids = pieces.filter("shard = 0").select("block", "ids")
        zipped = F.explode(F.arrays_zip("ids", "label", "distance"))
        out = ids.join(assigned(centres), "block").select(zipped.alias("r")).select(F.col("r.ids").alias("vec_id"), F.col("r.label").alias("cluster"), "r.distance")
        out = materialize(out, "clusters")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    ordered = F.sort_array(F.collect_list(F.struct("shard", "c")))
    return out, centres.groupBy("cluster").agg(F.flatten(F.transform(ordered, lambda s: s["c"])).alias("centroid"))


def cluster_digests(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Each vector's cluster with the distances summed over the cluster and over all, and the sha256 of the centroid's
    components as decimal integers joined by commas."""
    text = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    per = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia"))
    per = per.join(centres.select("cluster", F.sha2(text, 256).alias("centroid_sha256")), "cluster").crossJoin(F.broadcast(total))   # a row a cluster
    return members.join(per, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def lloyd_sql(dims: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: str = "3") -> str:
    """The rounds in DuckDB SQL."""
    near = ("SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT kept.rid, p.c, "
            "list_sum(list_transform(list_zip(kept.v, p.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{0} p) GROUP BY rid")
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM
(SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds):
        steps += [f"a{r} AS MATERIALIZED ({near.format(r)})",
                  f"""s{r} AS (SELECT c, pos, sum(x) AS s, count(*) AS n FROM (SELECT a{r}.c, unnest(v) AS x, generate_subscripts(v, 1) AS pos
FROM kept JOIN a{r} USING (rid)) GROUP BY c, pos)""",
                  f"""c{r + 1} AS MATERIALIZED (SELECT p.c, coalesce(m.v, p.v) AS v FROM c{r} p LEFT JOIN
(SELECT c, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY pos) AS v FROM s{r} GROUP BY c) m ON p.c = m.c)"""]
    return ("WITH " + ",\n".join(steps) + f""",
last AS MATERIALIZED ({near.format(rounds)})
SELECT vec_id, last.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY last.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 FROM kept JOIN last USING (rid) JOIN c{rounds} ON last.c = c{rounds}.c""")
