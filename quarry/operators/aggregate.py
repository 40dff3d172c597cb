"""Aggregations and statistics."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.sequence import dense_index


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def user_totals(plays: DataFrame, user="user_id", count="plays") -> DataFrame:
    """Per user: total plays and the integer mean (total // number of rows)."""
    return (plays.groupBy(user)
            .agg(F.sum(count).alias("total"), F.count(F.lit(1)).alias("n_rows"))
            .select(user, "total", F.floor(F.col("total") / F.col("n_rows")).cast("long").alias("mean_plays")))


def count_distinct_items(plays: DataFrame, user="user_id", item="item_id") -> DataFrame:
    return plays.agg(F.count_distinct(item).alias("n_items"), F.count_distinct(user).alias("n_users"))


def item_sets(plays: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """The set of items per user as a long, distinct (user, item) table plus the set size per user
    (a set held as rows: a heavy user is spread over many tasks instead of one array)."""
    pairs = plays.select(user, item).distinct()
    sizes = pairs.groupBy(user).agg(F.count(F.lit(1)).alias("set_size"))
    return pairs.join(sizes, user)


def group_counts_at_extremes(df: DataFrame, score_col: str, id_col: str = "id") -> DataFrame:
    """Scores (missing → 0, cast to int) grouped; rows with score 0 and rows at the maximum score."""
    s = df.select(id_col, F.coalesce((F.col(f"`{score_col}`")).try_cast("double"), F.lit(0.0))
                  .cast("long").alias("score"))
    g = s.groupBy("score").agg(F.count(id_col).alias("n"))
    return g.agg(F.coalesce(F.max(F.when(F.col("score") == 0, F.col("n"))), F.lit(0)).alias("n_at_zero"),
                 F.max_by("n", "score").alias("n_at_max"), F.max("score").alias("max_score"))


def group_means(df: DataFrame, by: str, target: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(target).alias(f"mean_{target}"), F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, col: str, fractions: dict[str, float]) -> DataFrame:
    """One row: the exact quantiles (linear interpolation) named in ``fractions``.

    Values are sorted by range partitions and numbered; only the rows at the needed ranks, two a quantile, are picked,
    so no task holds the column.  Nulls are left out; without values the quantiles are null."""
    values = df.select(F.col(f"`{col}`").cast("double").alias("__v")).filter("__v IS NOT NULL")
    ranked = dense_index(values, ["__v"], "__i")
    n = ranked.agg(F.count(F.lit(1)).alias("__n"))                       # one row
    picked = ranked.crossJoin(F.broadcast(n))
    at = {name: (F.col("__n") - 1) * F.lit(f) for name, f in fractions.items()}
    needed = reduce(Column.__or__, [F.col("__i").isin(F.floor(h), F.ceil(h)) for h in at.values()])
    ends = []
    for name, h in at.items():
        ends += [F.max(F.when(F.col("__i") == F.floor(h), F.col("__v"))).alias(f"{name}_lo"),
                 F.max(F.when(F.col("__i") == F.ceil(h), F.col("__v"))).alias(f"{name}_hi"), F.max(h - F.floor(h)).alias(f"{name}_w")]
    row = picked.filter(needed).agg(*ends)
    return row.select(*[(F.col(f"{q}_lo") + (F.col(f"{q}_hi") - F.col(f"{q}_lo")) * F.col(f"{q}_w")).alias(q) for q in fractions])


def describe_stats(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """mean, sample std, 25/50/75 % (linear interpolation, exact), max, min — rounded half-even."""
    c = F.col(f"`{col}`")
    q = exact_quantiles(df, col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    m = df.agg(F.bround(F.avg(c), digits).alias("mean"), F.bround(F.stddev_samp(c), digits).alias("std"),
               F.bround(F.max(c), digits).alias("max"), F.bround(F.min(c), digits).alias("min"))
    return m.crossJoin(F.broadcast(q)).select("mean", "std", *[F.bround(x, digits).alias(x) for x in ("q25", "q50", "q75")], "max", "min")


def box_plot_stats(df: DataFrame, col: str) -> DataFrame:
    """Quartiles, whiskers (most extreme point inside the 1.5·IQR fences) and the number of outliers."""
    c = F.col(f"`{col}`")
    q = exact_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    j = df.select(c.alias("__v")).crossJoin(F.broadcast(q))
    return j.groupBy("q1", "median", "q3", "lo_fence", "hi_fence").agg(
        F.min(F.when(F.col("__v") >= F.col("lo_fence"), F.col("__v"))).alias("whisker_lo"),
        F.max(F.when(F.col("__v") <= F.col("hi_fence"), F.col("__v"))).alias("whisker_hi"),
        F.sum(F.when((F.col("__v") < F.col("lo_fence")) | (F.col("__v") > F.col("hi_fence")), 1).otherwise(0))
        .cast("long").alias("n_outliers"))


def box_plot_outliers(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """The outlier rows themselves (a filter, so they stay distributed)."""
    c = F.col(f"`{col}`")
    q = exact_quantiles(df, col, {"q1": 0.25, "q3": 0.75})
    return (df.crossJoin(F.broadcast(q))
            .filter((c < F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) |
                    (c > F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
            .select(id_col, c.alias("value")))


def word_counts(tokens: DataFrame, word: str = "word") -> DataFrame:
    """Token frequency (partial aggregation combines per task before the shuffle)."""
    return tokens.groupBy(word).agg(F.count(F.lit(1)).alias("count"))


def labeled_vocab_counts(docs: DataFrame, tokens_col: str = "tokens", tags_col: str = "tags") -> DataFrame:
    """Every token counts 1; each document tag counts the number of tokens in its document."""
    words = docs.select(F.explode(tokens_col).alias("item"), F.lit(1).cast("long").alias("w"))
    tags = docs.select(F.explode(tags_col).alias("item"), F.size(tokens_col).cast("long").alias("w"))
    return words.unionByName(tags).groupBy("item").agg(F.sum("w").alias("count"))


def confusion_matrix(pred: DataFrame, labels: list, actual="actual", predicted="predicted") -> DataFrame:
    """actual × predicted counts over a fixed label grid (zeros kept)."""
    spark = pred.sparkSession
    lab = spark.createDataFrame([(x,) for x in labels], "lbl " + {int: "int", float: "double", str: "string"}[type(labels[0])])
    grid = lab.select(F.col("lbl").alias(actual)).crossJoin(lab.select(F.col("lbl").alias(predicted)))
    counts = pred.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(grid).join(counts, [actual, predicted], "left").select(
        actual, predicted, F.coalesce("n", F.lit(0)).alias("n"))


def accuracy(pred: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    return pred.agg(F.avg(F.when(F.col(actual) == F.col(predicted), 1.0).otherwise(0.0)).alias("accuracy"))


def classification_report(pred: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    """2×2 statistics with class 1 positive (the usual confusion-matrix summary)."""
    a, p = F.col(actual), F.col(predicted)
    t = pred.agg(F.sum(F.when((a == 1) & (p == 1), 1).otherwise(0)).cast("double").alias("tp"),
                 F.sum(F.when((a == 0) & (p == 1), 1).otherwise(0)).cast("double").alias("fp"),
                 F.sum(F.when((a == 1) & (p == 0), 1).otherwise(0)).cast("double").alias("fn"),
                 F.sum(F.when((a == 0) & (p == 0), 1).otherwise(0)).cast("double").alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    acc = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    sens = F.try_divide(tp, tp + fn)
    spec = F.try_divide(tn, tn + fp)
    return t.select(
        acc.alias("accuracy"),
        F.greatest((tp + fn) / n, (fp + tn) / n).alias("no_information_rate"),
        F.try_divide(acc - pe, 1 - pe).alias("kappa"),
        sens.alias("sensitivity"), spec.alias("specificity"),
        F.try_divide(tp, tp + fp).alias("pos_pred_value"), F.try_divide(tn, tn + fn).alias("neg_pred_value"),
        ((tp + fn) / n).alias("prevalence"), (tp / n).alias("detection_rate"),
        ((sens + spec) / 2).alias("balanced_accuracy"),
        F.try_divide((fp - fn) * (fp - fn), fp + fn).alias("mcnemar_statistic"))


def mean_squared_error(df: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)).alias("mse"))


def dice_coefficient(pixels: DataFrame, truth="truth", pred="predicted", by: str | None = None,
                     smooth: float = 1.0) -> DataFrame:
    """(2·Σt·p + s) / (Σt + Σp + s) over all pixels, or per ``by`` group."""
    aggs = [F.sum(F.col(truth) * F.col(pred)).alias("tp"), F.sum(truth).alias("t"), F.sum(pred).alias("p")]
    g = pixels.groupBy(by).agg(*aggs) if by else pixels.agg(*aggs)
    keep = [by] if by else []
    return g.select(*keep, ((2 * F.col("tp") + smooth) / (F.col("t") + F.col("p") + smooth)).alias("dice"))


def revenue_bound(budgets: DataFrame, budget="budget") -> DataFrame:
    return budgets.agg(F.sum(budget).alias("revenue_bound"))


def advertiser_budgets(rows: DataFrame, advertiser="advertiser", budget="budget") -> DataFrame:
    """Budget per advertiser = max of its budgets rounded half-even to 2 places, missing → 0."""
    return rows.groupBy(advertiser).agg(F.coalesce(F.max(F.bround(budget, 2)), F.lit(0.0)).alias("budget"))


def latest_bids(rows: DataFrame, advertiser="advertiser", keyword="keyword", bid="bid", order="row_no") -> DataFrame:
    """Bid per (keyword, advertiser), rounded to 2 places, last row wins."""
    return rows.groupBy(keyword, advertiser).agg(F.bround(F.max_by(bid, order), 2).alias("bid"))
