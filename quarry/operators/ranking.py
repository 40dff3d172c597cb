"""Window functions, sorting, top-k and deterministic splits."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import uniform01


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """Global top-k: Spark plans ``orderBy + limit`` as TakeOrderedAndProject (a per-task heap of k)."""
    return df.orderBy(*order).limit(k)


def top_rows_lexicographic(df: DataFrame, k: int = 3) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in df.columns]).limit(k)


def argmax_id(df: DataFrame, id_col: str, score: str) -> DataFrame:
    """The id with the maximum score; on ties the smallest id (one aggregate, no sort)."""
    return df.agg(F.min_by(id_col, F.struct((-F.col(score)).alias("s"), F.col(id_col).alias("i"))).alias(id_col),
                  F.max(score).alias(score))


def top_n_per_group(df: DataFrame, group: str, order: list, n_col: str | None = None, n: int | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked within each group by ``order``; keep rank <= n (a constant or a per-row column)."""
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    limit = F.col(n_col) if n_col else F.lit(n)
    return ranked.filter(F.col(rank_col) <= limit)


def top_n_per_user(scores: DataFrame, truth_sizes: DataFrame, user="user_id", item="item_id",
                   score="score") -> DataFrame:
    """Per user, the best k_u items, k_u = number of true items of that user (ties: smaller item).

    The largest k_u (one scalar) is applied first as a literal limit, which Spark turns into a
    per-partition group limit before the shuffle, so a heavy user never ships all its rows."""
    k_max = truth_sizes.agg(F.max("k")).first()[0] or 0
    j = scores.join(truth_sizes.select(user, F.col("k").alias("__k")), user)
    ranked = top_n_per_group(j, user, [F.col(score).desc(), F.col(item)], n=int(k_max))
    return ranked.filter(F.col("rank") <= F.col("__k")).drop("__k")


def hash_split(df: DataFrame, key_cols: list[str], weights: list[float], seed: int = 13,
               name: str = "split") -> DataFrame:
    """Deterministic split by a seeded hash of the row key: adds ``split`` = 0, 1, … by weight."""
    total = float(sum(weights))
    u = uniform01(*key_cols, seed=seed)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        expr = F.when(u < bounds[i], F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr)


def random_split(df: DataFrame, key_cols: list[str], weights=(0.4, 0.4, 0.2), seed: int = 13) -> list[DataFrame]:
    """Split into parts by a seeded hash (same rows on every run; a partition of the input)."""
    tagged = hash_split(df, key_cols, list(weights), seed)
    return [tagged.filter(F.col("split") == i).drop("split") for i in range(len(weights))]


def stratified_split(df: DataFrame, label: str, key_cols: list[str], train_fraction: float = 0.6,
                     seed: int = 1, buckets: int = 1 << 20) -> DataFrame:
    """Per label, exactly the first ceil(fraction * n) rows in seeded-hash order go to train.

    No window spans a whole label: rows are counted per (label, hash bucket) — a table of at most
    labels x buckets rows — cumulative counts locate the one boundary bucket per label, and only
    that bucket (about n / buckets rows) is ranked row by row."""
    u = uniform01(*key_cols, seed=seed)
    tagged = df.withColumn("__u", u).withColumn("__b", F.floor(F.col("__u") * buckets).cast("long"))
    counts = tagged.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (counts.withColumn("__cum", F.sum("__c").over(w))
              .withColumn("__n", F.sum("__c").over(Window.partitionBy(label)))
              .withColumn("__target", F.ceil(F.col("__n") * train_fraction))
              .withColumn("__before", F.col("__cum") - F.col("__c")))
    j = tagged.join(counts.select(label, "__b", "__cum", "__before", "__target"), [label, "__b"])
    inside = j.filter((F.col("__before") < F.col("__target")) & (F.col("__cum") > F.col("__target")))
    wb = Window.partitionBy(label, "__b").orderBy("__u", *key_cols)
    inside = inside.withColumn("split", F.when(F.col("__before") + F.row_number().over(wb) <= F.col("__target"),
                                               "train").otherwise("test"))
    outside = (j.filter(~((F.col("__before") < F.col("__target")) & (F.col("__cum") > F.col("__target"))))
               .withColumn("split", F.when(F.col("__cum") <= F.col("__target"), "train").otherwise("test")))
    cols = df.columns + ["split"]
    return outside.select(*cols).unionByName(inside.select(*cols))


def ordered_split(df: DataFrame, order: list[str], n_train: int, n_test: int) -> DataFrame:
    """First ``n_train`` rows by ``order`` are train, the next ``n_test`` test (a bounded top-k first,
    so the numbering window only sees n_train + n_test rows)."""
    head = df.orderBy(*order).limit(n_train + n_test)
    r = head.withColumn("__rn", F.row_number().over(Window.orderBy(*order)))
    return r.withColumn("split", F.when(F.col("__rn") <= n_train, "train").otherwise("test")).drop("__rn")
