"""Sizes for blocked products: pairs of row blocks that are scored by one matrix product in one task."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scores in a block: 16 MB of doubles, so a block with a copy and an index of it stays below 64 MB.
CELLS = 1 << 21
#: Most rows of a left and a right block whose scores are taken in strips of ``CELLS``.  Each side is copied once for every
#: block of the other, so large blocks keep the shuffle small: 64 components are 16 and 32 MB.
SIDES = (1 << 15, 1 << 16)


def block_grid(spark: SparkSession, n_left: int, n_right: int, left_block: int | None = None, right_block: int | None = None, sides: tuple[int, int] | None = None, waves: int = 1) -> tuple[int, int]:
    """Numbers of blocks of the two sides: blocks of at most ``CELLS`` scores (or the sizes given), and ``waves`` times as many
    block pairs as there are cores unless they would get very small.  ``sides``: the most rows of a left and a right block,
    for work that takes a block pair in strips and so holds fewer scores than it has."""
    sides = sides or (math.isqrt(CELLS),) * 2
    left, right = (max(1, math.ceil(n / (size or side))) for n, size, side in ((n_left, left_block, sides[0]), (n_right, right_block, sides[1])))
    if left_block or right_block:
        return left, right
    want = min(waves * spark.sparkContext.defaultParallelism, max(1, n_left * n_right // 4096))
    while left * right < want:
        if n_left / left >= n_right / right:
            left *= 2
        else:
            right *= 2
    return left, right


def block_id(key: Column, n: int) -> Column:
    """The block of a row: a hash dealt to n blocks, as int."""
    return F.pmod(key, F.lit(n).cast("long")).cast("int")


def every_block(n: int) -> Column:
    """A row for each of the other side's n blocks; int, as ``block_id``."""
    return F.explode(F.sequence(F.lit(0).cast("int"), F.lit(n - 1).cast("int")))


def block_pairs(left: DataFrame, right: DataFrame, keys: list[str], score, schema: str) -> DataFrame:
    """``score(key, left block, right block)`` for each pair of blocks.  A cogroup doesn't align the types of its keys, and
    an int and a long of the same value hash to different partitions, so the types must be the same on both sides."""
    kinds = [[side.schema[k].dataType.simpleString() for k in keys] for side in (left, right)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"block keys {keys} differ in type: {kinds[0]} and {kinds[1]}")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema=schema)


def all_met(met: Column, n: int) -> Column:
    """``met``, or an error where a row met another number of rows of the other side than there are."""
    message = F.concat(F.lit(f"a row met another number of rows than the {n} of the other side: "), met.cast("string"))
    return F.when(met == n, met).otherwise(F.raise_error(message).cast("long"))
