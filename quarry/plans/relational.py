"""§2.3–2.6 over plays (FIX-1/2): canonical ids, totals, top-k, splits, overlap, set difference,
and the classification metrics of §2.4 over labelled documents (FIX-10) and pixels (FIX-14)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import uniform01_sql
from quarry.operators import aggregate as agg
from quarry.operators import ranking
from quarry.operators import relational as rel
from quarry.plans import fixtures as fx
from quarry.plans.registry import register

SEED = 13
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def canonical_plays(spark, d):
    return rel.canonicalize_ids(fx.keyed_plays(spark, d), "item_id", fx.aliases(spark, d))


CANON_CTE = fx.with_sql(kp=fx.KEYED_PLAYS_SQL, al=fx.ALIASES_SQL, cp=fx.CANON_SQL)


def split_plays(spark, d):
    """40 / 40 / 20 train / validation / test by a seeded hash of the row key."""
    return ranking.hash_split(canonical_plays(spark, d), KEY, [0.4, 0.4, 0.2], seed=SEED)


_U = uniform01_sql(*KEY, seed=SEED)
SPLIT_CTE = CANON_CTE + (f", sp AS (SELECT *, CASE WHEN {_U} < 0.4 THEN 0 WHEN {_U} < 0.8 THEN 1 ELSE 2 END AS split FROM cp)")


@register("canonicalize_ids", "2.3", CANON_CTE + " SELECT user_id, item_id, plays FROM cp")
def q_canonicalize_ids(spark, d):
    return canonical_plays(spark, d).select("user_id", "item_id", "plays")


@register("user_totals", "2.4", CANON_CTE +
          " SELECT user_id, CAST(sum(plays) AS BIGINT) AS total, CAST(sum(plays) // count(*) AS BIGINT) AS mean_plays "
          "FROM cp GROUP BY user_id")
def q_user_totals(spark, d):
    return agg.user_totals(canonical_plays(spark, d))


@register("top_users", "2.5", CANON_CTE +
          " SELECT user_id, CAST(sum(plays) AS BIGINT) AS total, CAST(sum(plays) // count(*) AS BIGINT) AS mean_plays "
          "FROM cp GROUP BY user_id ORDER BY total DESC, user_id LIMIT 3")
def q_top_users(spark, d):
    """Flagship: plays ⋈ orders, alias canonicalisation, per-user totals and integer mean, top 3."""
    return ranking.top_k(agg.user_totals(canonical_plays(spark, d)), 3, [F.col("total").desc(), F.col("user_id")])


@register("count_distinct_items", "2.4", CANON_CTE +
          " SELECT count(DISTINCT item_id) AS n_items, count(DISTINCT user_id) AS n_users FROM cp")
def q_count_distinct_items(spark, d):
    return agg.count_distinct_items(canonical_plays(spark, d))


@register("item_sets", "2.4", CANON_CTE +
          " SELECT DISTINCT user_id, item_id, count(*) OVER (PARTITION BY user_id) AS set_size "
          "FROM (SELECT DISTINCT user_id, item_id FROM cp)")
def q_item_sets(spark, d):
    return agg.item_sets(canonical_plays(spark, d))


@register("lookup_names", "2.3", CANON_CTE + f", nm AS ({fx.NAMES_SQL}) "
          "SELECT t.item_id, nm.name, t.total FROM (SELECT item_id, CAST(sum(plays) AS BIGINT) AS total FROM cp "
          "GROUP BY item_id ORDER BY total DESC, item_id LIMIT 5) t LEFT JOIN nm ON t.item_id = nm.item_id")
def q_lookup_names(spark, d):
    top = ranking.top_k(canonical_plays(spark, d).groupBy("item_id").agg(F.sum("plays").alias("total")), 5,
                        [F.col("total").desc(), F.col("item_id")])
    return rel.lookup_names(top, fx.item_names(spark, d), "item_id").select("item_id", "name", "total")


@register("top_rows_lexicographic", "2.5", CANON_CTE +
          " SELECT user_id, item_id, plays FROM cp ORDER BY user_id DESC, item_id DESC, plays DESC LIMIT 3")
def q_top_rows_lexicographic(spark, d):
    return ranking.top_rows_lexicographic(canonical_plays(spark, d).select("user_id", "item_id", "plays"), 3)


@register("random_split", "2.5", SPLIT_CTE +
          " SELECT split, count(*) AS n_rows, CAST(sum(plays) AS BIGINT) AS total_plays FROM sp GROUP BY split")
def q_random_split(spark, d):
    parts = ranking.random_split(canonical_plays(spark, d), KEY, (0.4, 0.4, 0.2), seed=SEED)
    out = None
    for i, p in enumerate(parts):
        s = p.agg(F.lit(i).alias("split"), F.count(F.lit(1)).alias("n_rows"), F.sum("plays").alias("total_plays"))
        out = s if out is None else out.unionByName(s)
    return out


@register("anti_join_seen", "2.3", SPLIT_CTE +
          " SELECT DISTINCT v.user_id, v.item_id FROM sp v WHERE v.split = 1 AND NOT EXISTS "
          "(SELECT 1 FROM sp t WHERE t.split = 0 AND t.user_id = v.user_id AND t.item_id = v.item_id)")
def q_anti_join_seen(spark, d):
    s = split_plays(spark, d)
    val = s.filter(F.col("split") == 1).select("user_id", "item_id").distinct()
    return rel.anti_join_seen(val, s.filter(F.col("split") == 0), ["user_id", "item_id"])


# A fixed score table: the training play total of each (user, item); truth = validation item sets.
SCORES_CTE = SPLIT_CTE + (
    ", sc AS (SELECT user_id, item_id, CAST(sum(plays) AS DOUBLE) AS score FROM sp WHERE split = 0 GROUP BY 1, 2), "
    "tr AS (SELECT user_id, count(DISTINCT item_id) AS k FROM sp WHERE split = 1 GROUP BY 1), "
    "tn AS (SELECT * FROM (SELECT sc.user_id, sc.item_id, sc.score, row_number() OVER (PARTITION BY sc.user_id "
    "ORDER BY sc.score DESC, sc.item_id) AS rank, tr.k FROM sc JOIN tr ON sc.user_id = tr.user_id) WHERE rank <= k)")


def _scores_and_truth(spark, d):
    s = split_plays(spark, d)
    scores = (s.filter(F.col("split") == 0).groupBy("user_id", "item_id")
              .agg(F.sum("plays").cast("double").alias("score")))
    truth = s.filter(F.col("split") == 1).select("user_id", "item_id").distinct()
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("k"))
    return scores, truth, sizes


@register("top_n_per_user", "2.5", SCORES_CTE + " SELECT user_id, item_id, rank FROM tn")
def q_top_n_per_user(spark, d):
    scores, _, sizes = _scores_and_truth(spark, d)
    return ranking.top_n_per_user(scores, sizes).select("user_id", "item_id", F.col("rank").cast("long").alias("rank"))


@register("overlap_fraction", "2.6", SCORES_CTE + (
    ", tv AS (SELECT DISTINCT user_id, item_id FROM sp WHERE split = 1) "
    "SELECT tv.user_id, count(tn.item_id) / count(*) AS overlap FROM tv LEFT JOIN tn "
    "ON tv.user_id = tn.user_id AND tv.item_id = tn.item_id GROUP BY tv.user_id"))
def q_overlap_fraction(spark, d):
    scores, truth, sizes = _scores_and_truth(spark, d)
    pred = ranking.top_n_per_user(scores, sizes)
    return rel.overlap_fraction(pred, truth)


@register("stratified_split", "2.5", fx.with_sql(a=fx.AUCTIONS_SQL) + (
    f", r AS (SELECT competitive, row_number() OVER (PARTITION BY competitive ORDER BY {uniform01_sql('o_orderkey', seed=1)}, "
    "o_orderkey) AS rn, count(*) OVER (PARTITION BY competitive) AS n FROM a) "
    "SELECT competitive, CASE WHEN rn <= ceil(n * 0.6) THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows "
    "FROM r GROUP BY 1, 2"))
def q_stratified_split(spark, d):
    s = ranking.stratified_split(fx.auctions(spark, d), "competitive", ["o_orderkey"], 0.6, seed=1)
    return s.groupBy("competitive", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("ordered_split", "2.5", fx.with_sql(a=fx.AUCTIONS_SQL) + (
    " SELECT o_orderkey, CASE WHEN rn <= 25 THEN 'train' ELSE 'test' END AS split FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM a) WHERE rn <= 50"))
def q_ordered_split(spark, d):
    return ranking.ordered_split(fx.auctions(spark, d).select("o_orderkey"), ["o_orderkey"], 25, 25)


# ------------------------------------------------------------------ classification metrics

def doc_predictions(spark, d):
    """A fixed rule as the classifier under test: long documents are predicted good (1)."""
    docs = fx.labelled_docs(spark, d)
    return docs.select("doc_id", F.col("label").alias("actual"),
                       F.when(F.length("text") > 2000, 1).otherwise(0).alias("predicted"))


DOC_PRED_CTE = fx.with_sql(ld=fx.LABELLED_DOCS_SQL, pr="SELECT doc_id, label AS actual, CASE WHEN length(text) > 2000 "
                                                       "THEN 1 ELSE 0 END AS predicted FROM ld")


@register("confusion_matrix", "2.4", DOC_PRED_CTE + (
    ", g AS (SELECT a.x AS actual, p.x AS predicted FROM (VALUES (0), (1)) a(x), (VALUES (0), (1)) p(x)) "
    "SELECT g.actual, g.predicted, count(pr.doc_id) AS n FROM g LEFT JOIN pr ON g.actual = pr.actual "
    "AND g.predicted = pr.predicted GROUP BY 1, 2"))
def q_confusion_matrix(spark, d):
    return agg.confusion_matrix(doc_predictions(spark, d), [0, 1])


def _report_sql():
    return DOC_PRED_CTE + (
        ", t AS (SELECT CAST(sum(CASE WHEN actual = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, "
        "CAST(sum(CASE WHEN actual = 0 AND predicted = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, "
        "CAST(sum(CASE WHEN actual = 1 AND predicted = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn, "
        "CAST(sum(CASE WHEN actual = 0 AND predicted = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM pr), "
        "u AS (SELECT *, tp + fp + fn + tn AS n, tp / nullif(tp + fn, 0) AS sens, tn / nullif(tn + fp, 0) AS spec, "
        "((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS pe FROM t) "
        "SELECT (tp + tn) / n AS accuracy, greatest((tp + fn) / n, (fp + tn) / n) AS no_information_rate, "
        "((tp + tn) / n - pe) / nullif(1 - pe, 0) AS kappa, sens AS sensitivity, spec AS specificity, "
        "tp / nullif(tp + fp, 0) AS pos_pred_value, tn / nullif(tn + fn, 0) AS neg_pred_value, "
        "(tp + fn) / n AS prevalence, tp / n AS detection_rate, (sens + spec) / 2 AS balanced_accuracy, "
        "(fp - fn) * (fp - fn) / nullif(fp + fn, 0) AS mcnemar_statistic FROM u")


@register("classification_report", "2.4", _report_sql())
def q_classification_report(spark, d):
    return agg.classification_report(doc_predictions(spark, d))


@register("mean_squared_error", "2.4", fx.with_sql(x=fx.LINEITEM_XY_SQL) +
          " SELECT avg(pow(y / 1000 - x1 * 1.5, 2)) AS mse FROM x")
def q_mean_squared_error(spark, d):
    x = fx.lineitem_xy(spark, d).select((F.col("y") / 1000).alias("actual"), (F.col("x1") * 1.5).alias("predicted"))
    return agg.mean_squared_error(x)


@register("dice_coefficient", "2.4", fx.with_sql(px=fx.PIXELS_SQL) +
          " SELECT image_id, (2 * sum(truth * predicted) + 1.0) / (sum(truth) + sum(predicted) + 1.0) AS dice "
          "FROM px GROUP BY image_id")
def q_dice_coefficient(spark, d):
    return agg.dice_coefficient(fx.pixels(spark, d), by="image_id")
