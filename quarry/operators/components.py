"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Each step is one partial aggregate (smallest neighbour of each vertex) and one equi-join of two written tables, so Spark
can split a hub's rows.  Rounds are written to and re-read from shared storage: the plan, its statistics and the lineage
start anew each time.  The number of rounds grows with the logarithm of the vertex count, and the loop runs until the
edges stop changing.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path


def _written(df: DataFrame, base: str, name: str) -> DataFrame:
    path = f"{base}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def star_components(edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``edges``: columns src, dst (any orderable type; nulls, loops and repeats don't matter) and optionally ``keys``,
    within which vertices live apart.  Returns keys, id, component: the smallest vertex id reachable, for every vertex
    of an edge between two different vertices."""
    spark, base, k = edges.sparkSession, scratch_path(edges.sparkSession, f"stars-{uuid.uuid4().hex}"), list(keys)
    e = edges.filter("src <> dst").select(*k, F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    e = _written(e.distinct(), base, "edges")
    seen, n = None, 0
    while True:
        n += 1
        both = e.unionByName(e.select(*k, F.col("v").alias("u"), F.col("u").alias("v")))
        low = _written(both.groupBy(*k, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), base, f"low-{n}")
        e = _written(both.join(low, [*k, "u"]).filter("v > u").select(*k, F.col("v").alias("u"), F.col("m").alias("v")).distinct(), base, f"large-{n}")
        low = _written(e.groupBy(*k, "u").agg(F.min("v").alias("m")), base, f"first-{n}")
        linked = e.join(low, [*k, "u"]).filter("v <> m").select(*k, F.col("v").alias("u"), F.col("m").alias("v"))
        e = _written(linked.unionByName(low.select(*k, "u", F.col("m").alias("v"))).distinct(), base, f"small-{n}")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*k, "u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = e.select(*k, F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(*k, F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
