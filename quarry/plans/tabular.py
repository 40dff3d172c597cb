"""§2.2 projection / cleansing and the tabular statistics of §2.4 (grades FIX-3, auctions FIX-9, …)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.arrays import as_double_array, zscore
from quarry.functions.hashing import uniform01, uniform01_sql
from quarry.functions.text import long_lower_tokens, split_nonword
from quarry.operators import aggregate as agg
from quarry.operators import clean, ranking
from quarry.operators.relational import inner_join_suffix
from quarry.plans import fixtures as fx
from quarry.plans.registry import register
from quarry.sources.tables import table

G = "Grade/100"          # score column after whitespace removal
GQ = '"Grade/100"'       # the same, quoted for SQL

# ------------------------------------------------------------------ shared cleaned grades


def clean_grades(spark, d):
    g = clean.normalize_column_names(fx.grades(spark, d))
    g = clean.parse_duration_seconds(g, "Timetaken", "time")
    g = clean.drop_duplicate_rows(g)
    return clean.coerce_numeric(g, [G])


TIME_SQL = ("coalesce(CAST(nullif(regexp_extract(coalesce(\"Time taken\", ''), '(\\d+)\\smin', 1), '') AS BIGINT), 0) * 60 "
            "+ coalesce(CAST(nullif(regexp_extract(coalesce(\"Time taken\", ''), '(\\d+)\\ssec', 1), '') AS BIGINT), 0)")
CLEAN_SQL = (f"SELECT DISTINCT id, user_id, quiz, \"State\", {TIME_SQL} AS time, "
             f"TRY_CAST(nullif(trim(\"Grade /100\"), '-') AS DOUBLE) AS {GQ} FROM g")
GRADES_CTE = fx.with_sql(g=fx.GRADES_SQL, c=CLEAN_SQL)


def imputed_grades(spark, d):
    return clean.impute_mean(clean_grades(spark, d), [G])


IMPUTED_CTE = GRADES_CTE + f", i AS (SELECT id, user_id, quiz, \"State\", time, coalesce({GQ}, (SELECT avg({GQ}) FROM c)) AS {GQ} FROM c)"


#: The two quizzes: every event type is on one of the two sides.
FIRST_QUIZ, SECOND_QUIZ = "quiz < 'p'", "quiz >= 'p'"


def quiz(spark, d, side):
    """One row per student (the latest attempt) of one quiz; student id = user_id."""
    c = clean_grades(spark, d).filter(side)
    return (c.groupBy(F.col("user_id").alias("id"))
            .agg(F.max_by(F.struct("quiz", "time", G), "id").alias("r")).select("id", "r.*"))


def quiz_sql(side):
    return (f"SELECT user_id AS id, quiz, time, {GQ} FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
            f"ORDER BY id DESC) AS rn FROM c WHERE {side}) WHERE rn = 1")


def merged(spark, d):
    return inner_join_suffix(quiz(spark, d, FIRST_QUIZ), quiz(spark, d, SECOND_QUIZ), ["id"])


MERGED_CTE = GRADES_CTE + (f", qx AS ({quiz_sql(FIRST_QUIZ)}), qy AS ({quiz_sql(SECOND_QUIZ)}), "
                           f"m AS (SELECT qx.id, qx.quiz AS quiz_x, qx.time AS time_x, qx.{GQ} AS \"Grade/100_x\", "
                           f"qy.quiz AS quiz_y, qy.time AS time_y, qy.{GQ} AS \"Grade/100_y\" FROM qx JOIN qy ON qx.id = qy.id)")


# ------------------------------------------------------------------ §2.2

@register("select_head", "2.2", GRADES_CTE + f" SELECT id, time, {GQ} FROM c ORDER BY id LIMIT 10")
def q_select_head(spark, d):
    return clean.select_head(clean_grades(spark, d), ["id", "time", G], ["id"], 10)


PROFILE_COLS = [("id", "bigint"), ("user_id", "bigint"), ("quiz", "string"), ("State", "string"),
                ("Time taken", "string"), ("Grade /100", "string")]


def _profile_sql():
    nulls = ", ".join(f"sum(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END) AS n{i}" for i, (c, _) in enumerate(PROFILE_COLS))
    parts = [f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, n{i} > 0 AS has_null, n AS n_rows, "
             f"CAST({len(PROFILE_COLS)} AS BIGINT) AS n_cols FROM s" for i, (c, t) in enumerate(PROFILE_COLS)]
    return fx.with_sql(g=fx.GRADES_SQL, s=f"SELECT count(*) AS n, {nulls} FROM g") + " " + " UNION ALL ".join(parts)


@register("table_profile", "2.2", _profile_sql())
def q_table_profile(spark, d):
    return clean.table_profile(fx.grades(spark, d))


@register("normalize_column_names", "2.2", fx.with_sql(g=fx.GRADES_SQL) +
          ' SELECT id, user_id, quiz, "State", "Time taken" AS "Timetaken", "Grade /100" AS "Grade/100" FROM g')
def q_normalize_column_names(spark, d):
    return clean.normalize_column_names(fx.grades(spark, d))


@register("parse_duration_seconds", "2.2", fx.with_sql(g=fx.GRADES_SQL) + f" SELECT id, {TIME_SQL} AS time FROM g")
def q_parse_duration_seconds(spark, d):
    return clean.parse_duration_seconds(fx.grades(spark, d), "Time taken", "time").select("id", "time")


@register("fill_missing_const", "2.2", GRADES_CTE + f" SELECT id, coalesce({GQ}, 0.0) AS {GQ} FROM c")
def q_fill_missing_const(spark, d):
    return clean.fill_missing_const(clean_grades(spark, d), [G], 0.0).select("id", G)


@register("coerce_numeric", "2.2", fx.with_sql(g=fx.GRADES_SQL) +
          f" SELECT id, TRY_CAST(nullif(trim(\"Grade /100\"), '-') AS DOUBLE) AS {GQ} FROM g")
def q_coerce_numeric(spark, d):
    g = clean.normalize_column_names(fx.grades(spark, d))
    return clean.coerce_numeric(g, [G]).select("id", G)


@register("drop_duplicate_rows", "2.2", fx.with_sql(g=fx.GRADES_SQL) + " SELECT DISTINCT * FROM g")
def q_drop_duplicate_rows(spark, d):
    return clean.drop_duplicate_rows(fx.grades(spark, d))


@register("impute_mean", "2.2", IMPUTED_CTE + f" SELECT id, {GQ} FROM i")
def q_impute_mean(spark, d):
    return imputed_grades(spark, d).select("id", G)


@register("append_mean_row", "2.2", IMPUTED_CTE +
          f" SELECT id, time, {GQ} FROM i UNION ALL SELECT max(id) + 1, CAST(trunc(avg(time)) AS BIGINT), avg({GQ}) FROM i")
def q_append_mean_row(spark, d):
    return clean.append_mean_row(imputed_grades(spark, d), "id", ["time", G], int_cols=["time"])


@register("filter_sum_threshold", "2.2", MERGED_CTE + " SELECT id FROM m WHERE time_x + time_y < 1200 ORDER BY id")
def q_filter_sum_threshold(spark, d):
    return merged(spark, d).filter(F.col("time_x") + F.col("time_y") < 1200).select("id").orderBy("id")


@register("drop_columns", "2.2", fx.with_sql(g=fx.GRADES_SQL) + ' SELECT id, user_id, quiz, "Time taken", "Grade /100" FROM g')
def q_drop_columns(spark, d):
    return fx.grades(spark, d).drop("State")


# The category regrouping applied to order priorities.
PRIORITY_GROUPS = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unknown"}


def recoded_auctions(spark, d):
    return clean.recode_categories(fx.auctions(spark, d), "priority", PRIORITY_GROUPS)


RECODE_SQL = ("CASE priority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' "
              "WHEN '4-NOT SPECIFIED' THEN 'unknown' ELSE priority END")
RECODED_CTE = fx.with_sql(a=fx.AUCTIONS_SQL, r=f"SELECT o_orderkey, competitive, {RECODE_SQL} AS priority, segment, "
                                              "total_price, acct_bal FROM a")


@register("recode_categories", "2.2", RECODED_CTE + " SELECT o_orderkey, priority, segment FROM r")
def q_recode_categories(spark, d):
    return recoded_auctions(spark, d).select("o_orderkey", "priority", "segment")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("dummy_encode", "2.2", RECODED_CTE + " SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS \"segment_{s}\"" for s in SEGMENTS) + " FROM r")
def q_dummy_encode(spark, d):
    return clean.dummy_encode(recoded_auctions(spark, d).select("o_orderkey", "segment"), "segment")


def _scaled_sql():
    base = fx.with_sql(x=fx.LINEITEM_XY_SQL,
                       s="SELECT min(x1) AS lo1, max(x1) AS hi1, min(x2) AS lo2, max(x2) AS hi2 FROM x WHERE l_orderkey % 4 <> 0")
    return base + (" SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (x1 - lo1) / nullif(hi1 - lo1, 0) AS x1, "
                   "(x2 - lo2) / nullif(hi2 - lo2, 0) AS x2 FROM x, s")


@register("min_max_scale", "2.2", _scaled_sql())
def q_min_max_scale(spark, d):
    x = fx.lineitem_xy(spark, d).drop("y")
    return clean.min_max_scale(x.filter(F.col("l_orderkey") % 4 != 0), x, ["x1", "x2"])   # both parts, by the training range


@register("zscore_vector", "2.2",
          "SELECT vec_id, pos, round((v - avg(v) OVER w) / stddev_pop(v) OVER w, 6) AS z FROM ("
          "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos "
          "FROM embeddings) WINDOW w AS (PARTITION BY vec_id)")
def q_zscore_vector(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", as_double_array("embedding").alias("x"))
    return (e.select("vec_id", F.posexplode(zscore("x")).alias("pos", "z"))
            .select("vec_id", "pos", F.round("z", 6).alias("z")))


TOKENS_SQL = ("SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), "
              "lambda t: length(t) >= 3), lambda t: lower(t)) AS tokens FROM ld")


@register("tokenize_words", "2.2", fx.with_sql(ld=fx.LABELLED_DOCS_SQL, t=TOKENS_SQL) +
          " SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS token "
          "FROM t WHERE len(tokens) > 0")
def q_tokenize_words(spark, d):
    docs = fx.labelled_docs(spark, d).select("doc_id", long_lower_tokens("text").alias("tokens"))
    return docs.filter(F.size("tokens") > 0).select("doc_id", F.posexplode("tokens").alias("pos", "token"))


NONWORD_SQL = "list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}_]+'), lambda t: t <> '')"


@register("split_nonword", "2.2",
          f"SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word "
          f"FROM (SELECT doc_id, {NONWORD_SQL} AS w FROM documents)")
def q_split_nonword(spark, d):
    docs = table(spark, d, "documents").select("doc_id", split_nonword("text").alias("w"))
    return docs.select("doc_id", F.posexplode("w").alias("pos", "word"))


@register("predict_threshold", "2.2", fx.with_sql(a=fx.AUCTIONS_SQL) +
          " SELECT o_orderkey, CASE WHEN 1 / (1 + exp(-(total_price / 100000 - 1.5 + acct_bal / 5000))) >= 0.5 "
          "THEN 1 ELSE 0 END AS predicted FROM a")
def q_predict_threshold(spark, d):
    a = fx.auctions(spark, d).withColumn(
        "score", F.col("total_price") / 100000 - 1.5 + F.col("acct_bal") / 5000)
    return clean.predict_threshold(a, "score").select("o_orderkey", "predicted")


@register("equal_width_bins", "2.2", IMPUTED_CTE + (
    f", s AS (SELECT min({GQ}) AS lo, max({GQ}) AS hi FROM i), "
    "b AS (SELECT id, greatest(1, least(5, CAST(ceil((" + GQ + " - lo) / ((hi - lo) / 5)) AS INTEGER))) AS bin FROM i, s), "
    "grid AS (SELECT CAST(k AS INTEGER) AS bin, CASE WHEN k = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (k - 1) * ((hi - lo) / 5) END "
    "AS lower, lo + k * ((hi - lo) / 5) AS upper FROM range(1, 6) r(k), s) "
    "SELECT grid.bin, lower, upper, count(b.id) AS n_ids, CAST(coalesce(sum(b.id), 0) AS BIGINT) AS id_sum "
    "FROM grid LEFT JOIN b ON grid.bin = b.bin GROUP BY grid.bin, lower, upper"))
def q_equal_width_bins(spark, d):
    # The mean row of append_mean_row lies inside [min, max] and is left out of the groups, so
    # binning the imputed rows alone gives the same bins and groups.
    return clean.equal_width_bins(imputed_grades(spark, d), "id", G, 5)


# ------------------------------------------------------------------ statistics over the grades (§2.4)

@register("group_counts_at_extremes", "2.4", fx.with_sql(g=fx.GRADES_SQL) + (
    ", s AS (SELECT id, CAST(trunc(coalesce(TRY_CAST(\"Grade /100\" AS DOUBLE), 0.0)) AS BIGINT) AS score FROM g), "
    "k AS (SELECT score, count(id) AS n FROM s GROUP BY score) "
    "SELECT coalesce(max(CASE WHEN score = 0 THEN n END), 0) AS n_at_zero, arg_max(n, score) AS n_at_max, "
    "max(score) AS max_score FROM k"))
def q_group_counts_at_extremes(spark, d):
    return agg.group_counts_at_extremes(fx.grades(spark, d), "Grade /100", "id")


@register("describe_stats", "2.4", GRADES_CTE + (
    f" SELECT round_even(avg({GQ}), 2) AS mean, round_even(stddev_samp({GQ}), 2) AS std, "
    f"round_even(quantile_cont({GQ}, 0.25), 2) AS q25, round_even(quantile_cont({GQ}, 0.5), 2) AS q50, "
    f"round_even(quantile_cont({GQ}, 0.75), 2) AS q75, round_even(max({GQ}), 2) AS max, round_even(min({GQ}), 2) AS min FROM c"))
def q_describe_stats(spark, d):
    return agg.describe_stats(clean_grades(spark, d), G, 2)


@register("box_plot_stats", "2.4", GRADES_CTE + (
    f", q AS (SELECT quantile_cont({GQ}, 0.25) AS q1, quantile_cont({GQ}, 0.5) AS median, quantile_cont({GQ}, 0.75) AS q3 FROM c), "
    "f AS (SELECT q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q) "
    f"SELECT q1, median, q3, lo_fence, hi_fence, min(CASE WHEN {GQ} >= lo_fence THEN {GQ} END) AS whisker_lo, "
    f"max(CASE WHEN {GQ} <= hi_fence THEN {GQ} END) AS whisker_hi, "
    f"CAST(sum(CASE WHEN {GQ} < lo_fence OR {GQ} > hi_fence THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers "
    "FROM c, f GROUP BY q1, median, q3, lo_fence, hi_fence"))
def q_box_plot_stats(spark, d):
    return agg.box_plot_stats(clean_grades(spark, d), G)


@register("group_means", "2.4", RECODED_CTE +
          " SELECT priority, avg(competitive) AS mean_competitive, count(*) AS n FROM r GROUP BY priority")
def q_group_means(spark, d):
    return agg.group_means(recoded_auctions(spark, d), "priority", "competitive")


@register("group_means_all", "2.4", RECODED_CTE + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS category, {c} AS level, avg(competitive) AS mean_competitive, count(*) AS n FROM r GROUP BY {c}" for c in ("priority", "segment")))
def q_group_means_all(spark, d):
    """Means for every categorical column, one scan: a row is counted once a column."""
    r = recoded_auctions(spark, d)
    long = r.select("competitive", F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("level")) for c in ("priority", "segment")])).alias("c"))
    return long.groupBy("c.category", "c.level").agg(F.avg("competitive").alias("mean_competitive"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ join / argmax over the merged quizzes

@register("inner_join_suffix", "2.3", MERGED_CTE + " SELECT * FROM m")
def q_inner_join_suffix(spark, d):
    return merged(spark, d)


@register("argmax_id", "2.5", MERGED_CTE + (
    ", t AS (SELECT id, \"Grade/100_x\" + \"Grade/100_y\" AS total_score FROM m) "
    "SELECT min(id) AS id, max(total_score) AS total_score FROM t WHERE total_score = (SELECT max(total_score) FROM t)"))
def q_argmax_id(spark, d):
    m = merged(spark, d).select("id", (F.col("Grade/100_x") + F.col("Grade/100_y")).alias("total_score"))
    return ranking.argmax_id(m.filter(F.col("total_score").isNotNull()), "id", "total_score")


# ------------------------------------------------------------------ image manifest (FIX-14 label rows)

N_CLASSES = 6


def _label_rows(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size")
    return p.select(
        (1 + F.col("p_partkey") % N_CLASSES).alias("class_no"),
        F.when(F.col("p_size") % 4 == 0, 1).otherwise(0).alias("defect"),
        F.concat(F.lit("img"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("file"),
        F.concat(F.lit("img"), F.col("p_partkey").cast("string"), F.lit("_mask.png")).alias("mask_file"),
        "p_partkey")


def _listing(spark, d):
    """The files that exist: every image except every 9th, every given mask except every 8th, and every
    derived ``_label.PNG`` mask except every 5th."""
    p = table(spark, d, "part").select("p_partkey")
    cls = F.concat(F.lit("Class"), (1 + F.col("p_partkey") % N_CLASSES).cast("string"))
    img = p.filter(F.col("p_partkey") % 9 != 0).select(
        F.concat(cls, F.lit("/img"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("path"))
    mask = p.filter(F.col("p_partkey") % 8 != 0).select(
        F.concat(cls, F.lit("/Label/img"), F.col("p_partkey").cast("string"), F.lit("_mask.png")).alias("path"))
    lab = p.filter(F.col("p_partkey") % 5 != 0).select(
        F.concat(cls, F.lit("/Label/img"), F.col("p_partkey").cast("string"), F.lit("_label.PNG")).alias("path"))
    return img.unionByName(mask).unionByName(lab)


#: Rows of labels that one task matches to files, about.
LABELS_PER_TASK = 250_000


def image_manifest(labels, listing, n_classes=N_CLASSES, per_class=None, seed=7, tasks=None):
    """Image / mask pairs: the given mask for defect rows, ``<stem>_label.PNG`` otherwise; only pairs whose
    two files exist.  With ``per_class``, a documented bound on training rows, at most ``per_class * n_classes``
    non-defect rows are taken (in seeded hash order); by default all are.  ``tasks``: rows and files are dealt by path over
    so many tasks, so that the paths a task sorts stay few whatever the reader of the shuffle would merge."""
    base = F.concat(F.lit("Class"), F.col("class_no").cast("string"))
    rows = labels.select(
        F.concat(base, F.lit("/"), F.col("file")).alias("image_path"),
        F.when(F.col("defect") == 1, F.concat(base, F.lit("/Label/"), F.col("mask_file")))
        .otherwise(F.concat(base, F.lit("/Label/"), F.split(F.col("file"), "\\.")[0], F.lit("_label.PNG")))
        .alias("mask_path"),
        "defect", uniform01("p_partkey", seed=seed).alias("__u"), "p_partkey")
    rows = rows.filter(F.col("defect").isin(0, 1))
    for path in ("image_path", "mask_path"):                                  # a path that is listed twice matches once
        files = listing.select(F.col("path").alias(path)).hint("merge")       # it grows with the rows: never a broadcast
        rows = (rows.repartition(tasks, path).join(files.repartition(tasks, path).hint("merge"), path, "left_semi") if tasks
                else rows.join(files, path, "left_semi"))
    if per_class is not None:
        others = rows.filter("defect = 0").orderBy("__u", "p_partkey").limit(per_class * n_classes)
        rows = rows.filter("defect = 1").unionByName(others)
    return rows.select("image_path", "mask_path", "defect")


def _manifest_sql():
    u = uniform01_sql("p_partkey", seed=7)
    cls = "'Class' || CAST(1 + p_partkey % 6 AS VARCHAR)"
    return (
        f"WITH lr AS (SELECT {cls} AS base, CASE WHEN p_size % 4 = 0 THEN 1 ELSE 0 END AS defect, p_partkey, "
        f"{u} AS u FROM part), "
        f"files AS (SELECT {cls} || '/img' || CAST(p_partkey AS VARCHAR) || '.png' AS path FROM part WHERE p_partkey % 9 <> 0 "
        f"UNION SELECT {cls} || '/Label/img' || CAST(p_partkey AS VARCHAR) || '_mask.png' FROM part WHERE p_partkey % 8 <> 0 "
        f"UNION SELECT {cls} || '/Label/img' || CAST(p_partkey AS VARCHAR) || '_label.PNG' FROM part WHERE p_partkey % 5 <> 0), "
        "r AS (SELECT base || '/img' || CAST(p_partkey AS VARCHAR) || '.png' AS image_path, "
        "CASE WHEN defect = 1 THEN base || '/Label/img' || CAST(p_partkey AS VARCHAR) || '_mask.png' "
        "ELSE base || '/Label/img' || CAST(p_partkey AS VARCHAR) || '_label.PNG' END AS mask_path, defect, u, p_partkey FROM lr), "
        "ok AS (SELECT * FROM r WHERE image_path IN (SELECT path FROM files) AND mask_path IN (SELECT path FROM files)) "
        "SELECT image_path, mask_path, defect FROM ok")


@register("image_manifest", "2.2", _manifest_sql())
def q_image_manifest(spark, d):
    tasks = max(spark.sparkContext.defaultParallelism, -(-table(spark, d, "part").count() // LABELS_PER_TASK))
    return image_manifest(_label_rows(spark, d), _listing(spark, d), tasks=tasks)
