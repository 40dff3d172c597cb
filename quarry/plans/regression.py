"""§2.10 regression and diagnostics.  Linear models: l_extendedprice / 1000 on l_quantity and
l_discount over all lineitem rows; kernel regression on FIX-8 (embedding rows); logistic GLM on FIX-9."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import regression as rg
from quarry.plans import fixtures as fx
from quarry.plans.registry import register

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
X = ["x1", "x2"]
WEIGHT = 2.0
LAMBDA = 0.1


def rows(spark, d):
    return fx.lineitem_xy(spark, d).withColumn("y", F.col("y") / 1000)


def fit(spark, d):
    return rg.ols_fit(rows(spark, d), X, "y")


def residuals(spark, d):
    r = rows(spark, d)
    return rg.residual_table(r, rg.ols_fit(r, X, "y"), "y")


LM = fx.with_sql(
    x="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x1, l_discount + 0.0 AS x2, "
      "l_extendedprice / 1000 AS y FROM lineitem",
    s="SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) * count(*) AS s11, "
      "covar_pop(x2, x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS s1y, "
      "covar_pop(x2, y) * count(*) AS s2y, covar_pop(y, y) * count(*) AS syy FROM x",
    c="SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s",
    f="SELECT *, my - b1 * m1 - b2 * m2 AS b0, syy - (b1 * s1y + b2 * s2y) AS rss FROM c",
    r0="SELECT x.*, f.b0 + f.b1 * x1 + f.b2 * x2 AS fitted, y - (f.b0 + f.b1 * x1 + f.b2 * x2) AS residual, "
       "1.0 / f.n + (f.s22 * (x1 - f.m1) ^ 2 - 2 * f.s12 * (x1 - f.m1) * (x2 - f.m2) + f.s11 * (x2 - f.m2) ^ 2) "
       "/ (f.s11 * f.s22 - f.s12 ^ 2) AS hat, f.rss / (f.n - 3) AS s2, f.n AS n, f.b1, f.b2 FROM x, f",
    r1="SELECT *, residual / sqrt(s2 * (1 - hat)) AS r_int FROM r0",
    r="SELECT *, r_int * sqrt((n - 4) / (n - 3 - r_int ^ 2)) AS r_ext, r_int ^ 2 * hat / (3 * (1 - hat)) AS cooks FROM r1")


@register("ols_fit", "2.10", LM + " SELECT '(Intercept)' AS term, b0 AS estimate FROM f UNION ALL SELECT 'x1', b1 FROM f "
          "UNION ALL SELECT 'x2', b2 FROM f")
def q_ols_fit(spark, d):
    return rg.coefficients(spark, fit(spark, d))


_SUMMARY = ("sqrt(rss / (n - 3)) AS sigma, 1 - rss / syy AS r_squared, 1 - (rss / syy) * (n - 1) / (n - 3) AS adj_r_squared, "
            "(syy - rss) / 2 / (rss / (n - 3)) AS f_statistic, 2::BIGINT AS df_model, n - 3 AS df_residual")


@register("linear_summary", "2.10", LM + (
    ", v AS (SELECT *, rss / (n - 3) AS s2, s11 * s22 - s12 * s12 AS det FROM f), "
    "t AS (SELECT '(Intercept)' AS term, b0 AS estimate, sqrt(s2 * (1.0 / n + (s22 * m1 * m1 - 2 * s12 * m1 * m2 + s11 * m2 * m2) / det)) AS std_error FROM v "
    "UNION ALL SELECT 'x1', b1, sqrt(s2 * s22 / det) FROM v UNION ALL SELECT 'x2', b2, sqrt(s2 * s11 / det) FROM v) "
    f"SELECT term, estimate, std_error, estimate / std_error AS t_value, {_SUMMARY} FROM t, f"))
def q_linear_summary(spark, d):
    return rg.fit_summary(spark, fit(spark, d)).drop("p_value")


@register("linear_predict", "2.10", LM + " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y AS actual, fitted AS predicted FROM r0")
def q_linear_predict(spark, d):
    r = rows(spark, d)
    p = rg.linear_predict(r, rg.ols_fit(r, X, "y"))
    return p.select(*KEY, F.col("y").alias("actual"), "predicted")


@register("residual_summary", "2.10", LM + " SELECT avg(residual) AS mean_residual, stddev_samp(residual) AS sd_residual FROM r0")
def q_residual_summary(spark, d):
    return rg.residual_summary(residuals(spark, d))


@register("residual_autocorrelation", "2.10", LM + (
    ", l AS (SELECT residual, lag(residual) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, residual) AS prev FROM r0) "
    "SELECT sum(residual * prev) / sum(residual * residual) AS lag1_autocorrelation, "
    "sum((residual - prev) ^ 2) / sum(residual * residual) AS durbin_watson FROM l"))
def q_residual_autocorrelation(spark, d):
    # the residual breaks ties between rows sharing a key, so the row order is total
    return rg.residual_autocorrelation(residuals(spark, d), KEY + ["residual"])


@register("score_test_variance", "2.10", LM + (
    ", u AS (SELECT residual ^ 2 / (SELECT sum(residual ^ 2) / count(*) FROM r0) AS u, fitted FROM r0) "
    "SELECT covar_pop(u, fitted) ^ 2 / var_pop(fitted) * count(*) / 2 AS chisq, 1 AS df FROM u"))
def q_score_test_variance(spark, d):
    r = residuals(spark, d)
    return rg.score_test_variance(r, r.count())


@register("variance_inflation", "2.10", LM + " SELECT 'x1' AS term, 1 / (1 - corr(x1, x2) ^ 2) AS vif FROM x "
          "UNION ALL SELECT 'x2', 1 / (1 - corr(x1, x2) ^ 2) FROM x")
def q_variance_inflation(spark, d):
    return rg.variance_inflation(rows(spark, d), X)


@register("leverage_cooks", "2.10", LM +
          " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, hat, r_int, r_ext, cooks, cooks > 4.0 / (n - 5) AS influential FROM r")
def q_leverage_cooks(spark, d):
    return residuals(spark, d).select(*KEY, "hat", "r_int", "r_ext", "cooks", "influential")


@register("outlier_test", "2.10", LM +
          " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_ext FROM r ORDER BY abs(r_ext) DESC LIMIT 1")
def q_outlier_test(spark, d):
    r = rows(spark, d)
    f = rg.ols_fit(r, X, "y")
    return rg.outlier_test(rg.residual_table(r, f, "y"), f, KEY).drop("bonferroni_p")


@register("outlier_test_pvalue", "2.10")
def q_outlier_test_pvalue(spark, d):
    r = rows(spark, d)
    f = rg.ols_fit(r, X, "y")
    return rg.outlier_test(rg.residual_table(r, f, "y"), f, KEY)


@register("partial_residuals", "2.10", LM + (
    ", a1 AS (SELECT regr_slope(y, x2) AS sy, regr_intercept(y, x2) AS iy, regr_slope(x1, x2) AS sx, regr_intercept(x1, x2) AS ix FROM x), "
    "a2 AS (SELECT regr_slope(y, x1) AS sy, regr_intercept(y, x1) AS iy, regr_slope(x2, x1) AS sx, regr_intercept(x2, x1) AS ix FROM x) "
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, b1 * x1 + residual AS cr_x1, b2 * x2 + residual AS cr_x2, "
    "y - (a1.iy + a1.sy * x2) AS av_y_x1, x1 - (a1.ix + a1.sx * x2) AS av_x1, "
    "y - (a2.iy + a2.sy * x1) AS av_y_x2, x2 - (a2.ix + a2.sx * x1) AS av_x2 FROM r0, a1, a2"))
def q_partial_residuals(spark, d):
    r = rows(spark, d)
    f = rg.ols_fit(r, X, "y")
    cr = rg.partial_residuals(rg.residual_table(r, f, "y"), f)
    cr = rg.added_variable(cr, X, "y", "x1", fit_on=r)
    cr = rg.added_variable(cr, X, "y", "x2", fit_on=r)
    return cr.select(*KEY, "cr_x1", "cr_x2", "av_y_x1", "av_x1", "av_y_x2", "av_x2")


@register("spread_level", "2.10", LM + (
    " SELECT regr_slope(ln(abs(r_int)), ln(fitted)) AS slope, 1 - regr_slope(ln(abs(r_int)), ln(fitted)) AS power "
    "FROM r WHERE fitted > 0 AND r_int <> 0"))
def q_spread_level(spark, d):
    return rg.spread_level(residuals(spark, d))


@register("qq_points", "2.10")
def q_qq_points(spark, d):
    return rg.qq_points(residuals(spark, d), KEY)


@register("linear_assumption_moments", "2.10", LM + (
    ", m AS (SELECT residual - avg(residual) OVER () AS dd FROM r0), "
    "a AS (SELECT count(*) AS n, avg(dd ^ 2) AS m2, avg(dd ^ 3) AS m3, avg(dd ^ 4) AS m4 FROM m) "
    "SELECT n * (m3 / m2 ^ 1.5) ^ 2 / 6 AS skewness_stat, n * (m4 / m2 ^ 2 - 3) ^ 2 / 24 AS kurtosis_stat FROM a"))
def q_linear_assumption_moments(spark, d):
    return rg.moment_tests(residuals(spark, d))


_ASSUMPTIONS = LM + (
    ", t AS (SELECT residual, (fitted - my) ^ 2 AS v, x1 - m1 AS d1, x2 - m2 AS d2, f.rss / f.n AS sg, "
    "row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, residual) - (f.n + 1) / 2.0 AS i FROM r0, f), "
    "a AS (SELECT count(*)::DOUBLE AS n, avg(residual ^ 2) AS q2, avg(residual ^ 3) AS q3, avg(residual ^ 4) AS q4, sum(v * residual) ^ 2 / any_value(sg) AS vr, "
    "sum(v * v) - sum(v) ^ 2 / count(*) AS vv, sum(v * d1) AS v1, sum(v * d2) AS v2, sum(d1 * d1) AS e11, sum(d1 * d2) AS e12, sum(d2 * d2) AS e22, "
    "(sum(i * residual ^ 2) / any_value(sg)) ^ 2 AS ir FROM t), "
    "w AS (SELECT n * (q3 / q2 ^ 1.5) ^ 2 / 6 AS sk, n * (q4 / q2 ^ 2 - 3) ^ 2 / 24 AS ku, "
    "vr / (vv - (e22 * v1 * v1 - 2 * e12 * v1 * v2 + e11 * v2 * v2) / (e11 * e22 - e12 * e12)) AS li, ir / (n * (n * n - 1) / 6) AS he FROM a) "
    "SELECT 'skewness' AS test, sk AS value, 1 AS df FROM w UNION ALL SELECT 'kurtosis', ku, 1 FROM w UNION ALL SELECT 'link_function', li, 1 FROM w "
    "UNION ALL SELECT 'heteroscedasticity', he, 1 FROM w UNION ALL SELECT 'global', sk + ku + li + he, 4 FROM w")


@register("linear_assumption_test", "2.10", _ASSUMPTIONS)
def q_linear_assumption_test(spark, d):
    return rg.linear_assumption_test(residuals(spark, d), X, KEY + ["residual"]).drop("p_value")


@register("linear_assumption_pvalues", "2.10")
def q_linear_assumption_pvalues(spark, d):
    return rg.linear_assumption_test(residuals(spark, d), X, KEY + ["residual"])


# ------------------------------------------------------------------ ridge

def ridge_rows(spark, d):
    li = fx.lineitem_xy(spark, d)
    return li.select(*KEY, (F.col("x1") / 50).alias("x"), (F.col("y") / 100000).alias("y"))


@register("ridge_closed_form", "2.10", fx.with_sql(
    x="SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem",
    a=f"SELECT avg(x * x) + {LAMBDA} AS a11, avg(x) AS a12, 1 + {LAMBDA} AS a22, avg(x * y) AS b1, avg(y) AS b2 FROM x") +
    " SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS w, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS b FROM a")
def q_ridge_closed_form(spark, d):
    w = rg.ridge_closed_form(ridge_rows(spark, d), ["x"], "y", LAMBDA)
    return spark.createDataFrame([(float(w[0]), float(w[1]))], "w double, b double")


#: Full-batch descent from zero: the sums are those of one step, so a step is a row of the recursion; the last epoch is the
#: first whose loss differs by less than eps.
_DESCENT = fx.with_sql(
    x="SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem",
    a="SELECT avg(x * x) AS xx, avg(x) AS mx, avg(x * y) AS xy, avg(y) AS my, avg(y * y) AS yy FROM x").replace("WITH", "WITH RECURSIVE", 1) + (
    f", it(epoch, w, b, pw, pb) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE UNION ALL "
    f"SELECT epoch + 1, w - 0.5 * (xx * w + mx * b - xy + {LAMBDA} * w), b - 0.5 * (mx * w + b - my + {LAMBDA} * b), w, b FROM it, a WHERE epoch < 200), "
    f"ls AS (SELECT epoch, w, b, yy - 2 * (xy * w + my * b) + xx * w * w + 2 * mx * w * b + b * b + {LAMBDA} * (w * w + b * b) AS loss FROM it, a), "
    "df AS (SELECT epoch, loss, abs(loss - lag(loss) OVER (ORDER BY epoch)) AS change FROM ls WHERE epoch < 200), "
    "e AS (SELECT coalesce(min(epoch), 199) AS last FROM df WHERE change < 1e-12) "
    "SELECT df.epoch, df.loss, fin.w, fin.b FROM df, e, ls fin WHERE df.epoch <= e.last AND fin.epoch = e.last + 1")


@register("ridge_sgd", "2.10", _DESCENT)
def q_ridge_sgd(spark, d):
    r = ridge_rows(spark, d).withColumn("row_id", F.xxhash64(*KEY))
    w, hist = rg.ridge_sgd(r, ["x"], "y", lam=LAMBDA, lr=0.5, epochs=200, batches=1, eps=1e-12)
    return spark.createDataFrame([(e, float(l), float(w[0]), float(w[1])) for e, l in hist],
                                 "epoch int, loss double, w double, b double")


@register("ridge_sgd_minibatch", "2.10")
def q_ridge_sgd_minibatch(spark, d):
    """Batches of 10 rows, as the reference runs it."""
    r = ridge_rows(spark, d).withColumn("row_id", F.concat_ws(":", *KEY))
    w, hist = rg.ridge_sgd(r, ["x"], "y", lam=LAMBDA, lr=0.01, epochs=20, batch_size=10, eps=1e-6)
    return spark.createDataFrame([(e, float(l), float(w[0]), float(w[1])) for e, l in hist], "epoch int, loss double, w double, b double")


# ------------------------------------------------------------------ kernel regression (FIX-8)

KR = fx.with_sql(
    e="SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings",
    z="SELECT vec_id, y, list_transform(x, lambda v: (v - list_avg(x)) / sqrt(list_avg(list_transform(x, lambda w: "
      "(w - list_avg(x)) ^ 2)))) AS z FROM e",
    q="SELECT * FROM z WHERE vec_id % 10 = 0",
    t="SELECT * FROM z WHERE vec_id % 10 <> 0",
    k=f"SELECT q.vec_id AS qid, count(*) AS n_pairs, sum(t.y * exp({WEIGHT} * list_dot_product(q.z, t.z) / len(q.z))) AS num, "
      f"sum(exp({WEIGHT} * list_dot_product(q.z, t.z) / len(q.z))) AS den FROM q, t GROUP BY q.vec_id")


def _kr_parts(spark, d):
    r = fx.regression_rows(spark, d)
    return r.filter(F.col("role") == "query"), r.filter(F.col("role") == "train")


@register("kernel_pairs", "2.3", KR + " SELECT qid, n_pairs, den AS weight_sum FROM k")
def q_kernel_pairs(spark, d):
    q, t = _kr_parts(spark, d)
    return rg.kernel_sums(q, t, WEIGHT).select("qid", "n_pairs", F.col("den").alias("weight_sum"))


@register("kernel_regression", "2.10", KR + " SELECT qid, num / den AS prediction FROM k")
def q_kernel_regression(spark, d):
    q, t = _kr_parts(spark, d)
    return rg.kernel_regression(q, t, WEIGHT)


HORIZONS = [16, 32, 64]


def _horizon_sql():
    def kernel(n):
        return (f"z{n} AS (SELECT vec_id, y, list_transform(x, lambda v: (v - list_avg(x)) / sqrt(list_avg(list_transform(x, lambda w: (w - list_avg(x)) ^ 2)))) AS z "
                f"FROM (SELECT vec_id, y, list_slice(x, -{n}, -1) AS x FROM e)), "
                f"k{n} AS (SELECT q.vec_id AS qid, any_value(q.y) AS y, sum(t.y * exp({WEIGHT} * list_dot_product(q.z, t.z) / {n})) / "
                f"sum(exp({WEIGHT} * list_dot_product(q.z, t.z) / {n})) AS h{n} FROM z{n} q, z{n} t WHERE q.vec_id % 10 = 0 AND t.vec_id % 10 <> 0 GROUP BY q.vec_id)")
    return ("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings), " + ", ".join(kernel(n) for n in HORIZONS) +
            ", h AS (SELECT k16.qid, k16.y, h16, h32, h64 FROM k16 JOIN k32 USING (qid) JOIN k64 USING (qid))")


@register("kernel_horizons", "2.10", _horizon_sql() + " SELECT qid, h16, h32, h64 FROM h")
def q_kernel_horizons(spark, d):
    q, t = _kr_parts(spark, d)
    return rg.kernel_horizons(q, t, HORIZONS, WEIGHT)


@register("horizon_regression", "2.10", _horizon_sql() + (
    ", c AS (SELECT covar_pop(h16, h16) AS s11, covar_pop(h16, h32) AS s12, covar_pop(h16, h64) AS s13, covar_pop(h32, h32) AS s22, covar_pop(h32, h64) AS s23, "
    "covar_pop(h64, h64) AS s33, covar_pop(h16, y) AS y1, covar_pop(h32, y) AS y2, covar_pop(h64, y) AS y3, avg(h16) AS m1, avg(h32) AS m2, avg(h64) AS m3, avg(y) AS my "
    "FROM h WHERE qid % 20 = 0), "
    "i AS (SELECT *, s22 * s33 - s23 * s23 AS c11, s13 * s23 - s12 * s33 AS c12, s12 * s23 - s13 * s22 AS c13, s11 * s33 - s13 * s13 AS c22, "
    "s12 * s13 - s11 * s23 AS c23, s11 * s22 - s12 * s12 AS c33 FROM c), "
    "b AS (SELECT *, (c11 * y1 + c12 * y2 + c13 * y3) / (s11 * c11 + s12 * c12 + s13 * c13) AS b1, (c12 * y1 + c22 * y2 + c23 * y3) / (s11 * c11 + s12 * c12 + s13 * c13) AS b2, "
    "(c13 * y1 + c23 * y2 + c33 * y3) / (s11 * c11 + s12 * c12 + s13 * c13) AS b3 FROM i) "
    "SELECT b1 AS w16, b2 AS w32, b3 AS w64, my - b1 * m1 - b2 * m2 - b3 * m3 AS w0, "
    "(SELECT avg((y - (my - b1 * m1 - b2 * m2 - b3 * m3 + b1 * h16 + b2 * h32 + b3 * h64)) ^ 2) FROM h WHERE qid % 20 <> 0) AS mse FROM b"))
def q_horizon_regression(spark, d):
    from quarry.operators.aggregate import mean_squared_error
    q, t = _kr_parts(spark, d)
    est = rg.kernel_horizons(q, t, HORIZONS, WEIGHT).join(q.select(F.col("row_id").alias("qid"), "y"), "qid").checkpoint()
    fit, pred = rg.horizon_regression(est, HORIZONS, "y", F.col("qid") % 20 == 0, F.col("qid") % 20 != 0)
    w = [F.lit(float(b)).alias(f"w{n}") for n, b in zip(HORIZONS, fit.coef)]
    return mean_squared_error(pred).select(*w, F.lit(float(fit.intercept)).alias("w0"), "mse")


# ------------------------------------------------------------------ logistic GLM (FIX-9)

def _glm_data(spark, d):
    from quarry.operators import clean
    from quarry.plans.tabular import recoded_auctions
    a = recoded_auctions(spark, d)
    a = clean.dummy_encode(a, "segment", ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])  # AUTOMOBILE = reference level
    a = clean.dummy_encode(a, "priority", ["high", "medium", "unknown"])                       # 5-LOW = reference level
    return a.withColumn("price_k", F.col("total_price") / 1000).withColumn("competitive", F.col("competitive").cast("double"))


GLM_ALL = ["segment_BUILDING", "segment_FURNITURE", "segment_HOUSEHOLD", "segment_MACHINERY",
           "priority_high", "priority_medium", "priority_unknown", "price_k", "acct_bal"]


@register("logistic_glm", "2.10")
def q_logistic_glm(spark, d):
    m = rg.logistic_glm(_glm_data(spark, d), GLM_ALL, "competitive")
    terms = ["(Intercept)"] + GLM_ALL
    vals = [m.intercept] + list(m.coefficients)
    return spark.createDataFrame([(t, float(v)) for t, v in zip(terms, vals)], "term string, estimate double")


GLM_MODELS = {"all": GLM_ALL, "one_term": ["price_k"], "reduced": ["priority_high", "priority_unknown", "price_k", "acct_bal"]}


@register("glm_holdout", "2.10")
def q_glm_holdout(spark, d):
    """All terms, one term and a chosen subset, fitted on 60 % of the rows (stratified) and judged on the rest."""
    from quarry.operators.ranking import stratified_split
    s = stratified_split(_glm_data(spark, d), "competitive", ["o_orderkey"], 0.6, seed=1).checkpoint()
    return rg.glm_holdout(s.filter("split = 'train'"), s.filter("split = 'test'"), GLM_MODELS, "competitive")


@register("deviance_test", "2.10")
def q_deviance_test(spark, d):
    data = _glm_data(spark, d).cache()
    reduced = rg.logistic_glm(data, ["price_k"], "competitive")
    full = rg.logistic_glm(data, GLM_ALL, "competitive")
    dfr, devr, dff, devf, p = rg.deviance_test(reduced, full)
    return spark.createDataFrame([("reduced", int(dfr), float(devr), None, None),
                                  ("full", int(dff), float(devf), float(devr - devf), float(p))],
                                 "model string, resid_df long, deviance double, deviance_diff double, p_value double")
