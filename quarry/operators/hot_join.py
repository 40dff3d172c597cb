"""Look-ups of a fact table's keys where a few keys hold much of it.

The heaviest keys (at most ``most`` of them) are joined by broadcast, so their rows aren't shuffled at all; only the tail
goes through a shuffle join, where no key holds more than a small share of the rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

HOT_KEYS = 1000


def hot_keys(rows: DataFrame, key: str, most: int = HOT_KEYS) -> DataFrame:
    """The ``most`` heaviest keys, by a sketch that is merged over partitions (its errors cost time alone)."""
    top = rows.agg(F.expr(f"approx_top_k({key}, {most}, {8 * most})").alias("t"))
    return top.select(F.explode("t").alias("t")).select(F.col("t.item").alias(key))


def lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", counts: str | None = None, most: int = HOT_KEYS) -> DataFrame:
    """``rows.join(table, key, how)`` for ``how`` inner or left_semi; ``table`` holds a key once.  ``counts`` names a column
    of ``table`` with the number of rows of each key, if it has one; otherwise a sketch finds the heavy keys."""
    if how not in ("inner", "left_semi"):
        raise ValueError("a look-up is an inner or a left_semi join")
    heavy = table.orderBy(F.col(counts).desc(), key).limit(most) if counts else table.join(F.broadcast(hot_keys(rows, key, most)), key, "left_semi")
    ensure_checkpoint_dir(rows.sparkSession)
    heavy = heavy.checkpoint(eager=True)                                         # at most ``most`` rows, chosen once
    hot = rows.join(F.broadcast(heavy), key, how)
    tail = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(table, key, how)
    return hot.unionByName(tail.select(*hot.columns))
