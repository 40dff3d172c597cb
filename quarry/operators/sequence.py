"""Order-dependent helpers that stay distributed: exact prefix sums and dense global numbering.

Neither uses an un-partitioned window over the input: prefix sums are a tree of bucket totals, each level with windows of
bounded size; numbering sorts globally (range
partitioning splits heavy keys) and numbers rows from per-partition positions plus partition offsets (all JVM-side).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exclusive_prefix_sum(df: DataFrame, order_col: str, value_col: str, out: str = "offset",
                         bucket_width: int = 4096) -> DataFrame:
    """Adds ``out`` = sum of ``value_col`` over rows with a smaller ``order_col`` (an integer key,
    unique per row).  Buckets of ``bucket_width`` consecutive keys hold at most that many rows; the offsets of buckets are
    prefix sums of their totals, found in the same way, so no window sees more than ``bucket_width`` rows at any level."""
    low, high = df.agg(F.min(order_col), F.max(order_col)).first()
    return _prefix_level(df, order_col, value_col, out, bucket_width, low or 0, high or 0, 0)


def _prefix_level(df: DataFrame, order_col: str, value_col: str, out: str, width: int, low: int, high: int, level: int) -> DataFrame:
    bkt, key, total, off = (f"__{name}{level}" for name in ("bkt", "key", "total", "off"))
    inner = Window.partitionBy(bkt).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value_col).over(inner), F.lit(0))
    b = df.withColumn(bkt, F.floor((F.col(order_col) - F.lit(low)) / width))
    if high - low < width:
        return b.withColumn(out, inside).drop(bkt)
    totals = b.groupBy(F.col(bkt).alias(key)).agg(F.sum(value_col).alias(total))
    offsets = _prefix_level(totals, key, total, off, width, 0, (high - low) // width, level + 1)
    return b.join(offsets.select(F.col(key).alias(bkt), off), bkt).withColumn(out, F.col(off) + inside).drop(bkt, off)


def dense_index(df: DataFrame, order: list, out: str = "idx") -> DataFrame:
    """Adds ``out`` = 0, 1, 2, … in the given order (exact, deterministic for a total order).

    Stays in the JVM: after the global (range-partitioned) sort, ``monotonically_increasing_id`` gives
    each row (partition id << 33) + position in sort order; the sorted frame is checkpointed so that
    numbering is fixed, and each partition's exclusive row offset (one row per partition) is added to
    the position.  The raw id is only an intermediate; the result is a dense index."""
    from quarry.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order).withColumn("__mono", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumn("__pid", F.shiftright("__mono", 33))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offs = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offs), "__pid")
            .withColumn(out, (F.col("__off") + F.col("__mono").bitwiseAND(F.lit((1 << 33) - 1))).cast("long"))
            .drop("__pid", "__off", "__mono"))
