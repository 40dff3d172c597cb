"""Kernel regression, least squares, ridge (closed form and mini-batch gradient descent), logistic GLM,
and linear-model diagnostics.

Linear fits use sufficient statistics: one aggregation for the means, one for the centred
cross-products (two passes, numerically stable), then a d x d solve on the driver.  Only those
d x d numbers leave the executors; per-row quantities (fitted values, hat values, studentised
residuals) are column expressions with the small inverse matrix inlined as literals.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.arrays import zscore
from quarry.functions.hashing import mix_hash, uniform01
from quarry.functions.stats import chi2_sf, t_sf_two_sided
from quarry.operators.blocks import all_met, block_grid, block_id, block_pairs, every_block
from quarry.operators.sequence import dense_index


# ------------------------------------------------------------------ kernel regression

def kernel_sums(queries: DataFrame, train: DataFrame, weight: float = 2.0, q_block: int | None = None,
                t_block: int | None = None) -> DataFrame:
    """Per query row: ``(qid, n_pairs, num = Σ y_i e_i, den = Σ e_i)`` with e_i = exp(w · r_i) and r_i
    the population correlation of the query's and the training row's x vectors.

    Each row is z-scored once; r is then dot(z_q, z_i) / n.  Query blocks are cogrouped with training
    blocks and numpy reduces each block pair to per-query partial sums, which a grouped sum adds up —
    every pair is evaluated (the estimator needs all of them) but none is materialised as a row."""
    n_train = train.count()
    qb, tb = block_grid(queries.sparkSession, queries.count(), n_train, q_block, t_block)
    qz = (queries.select(F.col("row_id").alias("qid"), zscore("x").alias("z"))
          .withColumns({"qblk": block_id(mix_hash("qid"), qb), "tblk": every_block(tb)}))
    tz = (train.select("row_id", zscore("x").alias("z"), "y")
          .withColumns({"tblk": block_id(mix_hash("row_id"), tb), "qblk": every_block(qb)}))

    def block(key, qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        if qp.empty or tp.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "n_pairs": pd.Series([], dtype="int64"),
                                 "num": pd.Series([], dtype="float64"), "den": pd.Series([], dtype="float64")})
        Q = np.stack(qp["z"].to_numpy()).astype(np.float64)
        T = np.stack(tp["z"].to_numpy()).astype(np.float64)
        E = np.exp(weight * (Q @ T.T) / Q.shape[1])
        y = tp["y"].to_numpy(dtype=np.float64)
        return pd.DataFrame({"qid": qp["qid"].to_numpy(), "n_pairs": np.full(len(qp), len(tp), dtype=np.int64),
                             "num": E @ y, "den": E.sum(axis=1)})

    parts = block_pairs(qz, tz, ["qblk", "tblk"], block, "qid long, n_pairs long, num double, den double")
    return parts.groupBy("qid").agg(all_met(F.sum("n_pairs"), n_train).alias("n_pairs"), F.sum("num").alias("num"), F.sum("den").alias("den"))


def kernel_regression(queries: DataFrame, train: DataFrame, weight: float = 2.0) -> DataFrame:
    """Σ y_i exp(w r_i) / Σ exp(w r_i) per query row (any number of query and training rows)."""
    s = kernel_sums(queries, train, weight)
    return s.select("qid", (F.col("num") / F.col("den")).alias("prediction"))


def kernel_horizons(queries: DataFrame, train: DataFrame, horizons: list[int], weight: float = 2.0) -> DataFrame:
    """``(qid, h<n> for each horizon n)``: the kernel estimate from the last n steps of the vectors, for each horizon."""
    out = None
    for n in horizons:
        q, t = (side.withColumn("x", F.slice("x", -n, n)) for side in (queries, train))
        one = kernel_regression(q, t, weight).withColumnRenamed("prediction", f"h{n}")
        out = one if out is None else out.join(one, "qid")
    return out


def horizon_regression(estimates: DataFrame, horizons: list[int], target: str, fit_rows, test_rows) -> tuple[LinearFit, DataFrame]:
    """Least squares of the target on the estimates of all horizons over the rows where ``fit_rows`` holds; the fit, and
    (actual, predicted) for those where ``test_rows`` does."""
    cols = [f"h{n}" for n in horizons]
    fit = ols_fit(estimates.filter(fit_rows), cols, target)
    return fit, estimates.filter(test_rows).select(F.col(target).alias("actual"), fit.fitted().alias("predicted"))


# ------------------------------------------------------------------ least squares

class LinearFit:
    """Coefficients and the statistics the diagnostics need (all small, on the driver)."""

    def __init__(self, names, mean_x, mean_y, sxx, sxy, syy, n, coef, intercept):
        self.names, self.mean_x, self.mean_y = names, mean_x, mean_y
        self.sxx, self.sxy, self.syy, self.n = sxx, sxy, syy, n
        self.coef, self.intercept = coef, intercept
        self.k = len(names) + 1                               # coefficients incl. the intercept
        self.rss = float(syy - sxy @ coef)
        self.sigma2 = self.rss / (n - self.k)
        self.sxx_inv = np.linalg.inv(sxx)

    def fitted(self) -> F.Column:
        e = F.lit(float(self.intercept))
        for nm, b in zip(self.names, self.coef):
            e = e + F.lit(float(b)) * F.col(nm)
        return e

    def hat(self) -> F.Column:
        """h_i = 1/n + (x_i - x̄)ᵀ Sxx⁻¹ (x_i - x̄) (centred form of x_iᵀ(XᵀX)⁻¹x_i with an intercept)."""
        d = [F.col(nm) - F.lit(float(m)) for nm, m in zip(self.names, self.mean_x)]
        q = F.lit(1.0 / self.n)
        for i in range(len(d)):
            for j in range(len(d)):
                q = q + F.lit(float(self.sxx_inv[i, j])) * d[i] * d[j]
        return q


def sufficient_stats(df: DataFrame, xcols: list[str], ycol: str):
    """Two passes: means, then centred cross-products (one aggregate each)."""
    means = df.agg(F.count(F.lit(1)).alias("n"), F.avg(ycol).alias("my"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(xcols)]).first()
    n, my = means["n"], means["my"]
    mx = [means[f"m{i}"] for i in range(len(xcols))]
    cx = [F.col(c) - F.lit(float(m)) for c, m in zip(xcols, mx)]
    cy = F.col(ycol) - F.lit(float(my))
    aggs = [F.sum(cy * cy).alias("syy")]
    aggs += [F.sum(cx[i] * cy).alias(f"sxy{i}") for i in range(len(xcols))]
    aggs += [F.sum(cx[i] * cx[j]).alias(f"sxx{i}_{j}") for i in range(len(xcols)) for j in range(i, len(xcols))]
    r = df.agg(*aggs).first()
    d = len(xcols)
    sxx = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            sxx[i, j] = sxx[j, i] = r[f"sxx{i}_{j}"]
    sxy = np.array([r[f"sxy{i}"] for i in range(d)])
    return n, np.array(mx), my, sxx, sxy, r["syy"]


def ols_fit(df: DataFrame, xcols: list[str], ycol: str) -> LinearFit:
    n, mx, my, sxx, sxy, syy = sufficient_stats(df, xcols, ycol)
    coef = np.linalg.solve(sxx, sxy)
    return LinearFit(xcols, mx, my, sxx, sxy, syy, n, coef, my - mx @ coef)


def coefficients(spark, fit: LinearFit) -> DataFrame:
    rows = [("(Intercept)", float(fit.intercept))] + [(nm, float(b)) for nm, b in zip(fit.names, fit.coef)]
    return spark.createDataFrame(rows, "term string, estimate double")


def fit_summary(spark, fit: LinearFit) -> DataFrame:
    """The fitted model's table: per term estimate, standard error, t value and two-sided p value, and on every row the
    model's residual standard error, R², adjusted R², F statistic and degrees of freedom."""
    df = fit.n - fit.k
    m = np.asarray(fit.mean_x, dtype=float)
    var = [fit.sigma2 * (1 / fit.n + m @ fit.sxx_inv @ m), *(fit.sigma2 * np.diag(fit.sxx_inv))]
    r2 = 1 - fit.rss / fit.syy
    model = (math.sqrt(fit.sigma2), float(r2), float(1 - (1 - r2) * (fit.n - 1) / df), float((fit.syy - fit.rss) / (fit.k - 1) / fit.sigma2), int(fit.k - 1), int(df))
    rows = []
    for term, b, v in zip(["(Intercept)", *fit.names], [fit.intercept, *fit.coef], var):
        t = float(b) / math.sqrt(v)
        rows.append((term, float(b), math.sqrt(v), t, float(t_sf_two_sided(t, df)), *model))
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double, p_value double, sigma double, "
                                       "r_squared double, adj_r_squared double, f_statistic double, df_model long, df_residual long")


def linear_predict(df: DataFrame, fit: LinearFit, ycol: str | None = None) -> DataFrame:
    out = df.withColumn("predicted", fit.fitted())
    return out.withColumn("residual", F.col(ycol) - F.col("predicted")) if ycol else out


def ridge_closed_form(df: DataFrame, xcols: list[str], ycol: str, lam: float) -> np.ndarray:
    """Solves (XᵀX/n + λI) W = Xᵀy/n with a bias column (the bias is penalised as well).
    Returns [w_1..w_d, b]."""
    cols = [F.col(c) for c in xcols] + [F.lit(1.0)]
    d = len(cols)
    aggs = [F.avg(cols[i] * cols[j]).alias(f"a{i}_{j}") for i in range(d) for j in range(i, d)]
    aggs += [F.avg(cols[i] * F.col(ycol)).alias(f"b{i}") for i in range(d)]
    r = df.agg(*aggs).first()
    A = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            A[i, j] = A[j, i] = r[f"a{i}_{j}"]
    b = np.array([r[f"b{i}"] for i in range(d)])
    return np.linalg.solve(A + lam * np.eye(d), b)


def _batch_maps(stats: DataFrame, d: int, lam: float, lr: float) -> tuple[np.ndarray, np.ndarray, int]:
    """``stats(batch, n, xx d*d, xy d, yy)`` of all batches -> what an epoch does to u = (w, 1): the map T with u' = T u, the
    form L with sum of the batches' losses = u' L u (each loss at the weights before its step), the number of batches.

    A step is affine in w and its loss a quadratic form, so steps compose: (T2 T1, L1 + T1' L2 T1).  Each partition
    composes its run of batches in order, the driver those of the partitions: (d + 1)^2 numbers each."""
    def compose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        T, L, n, first = np.eye(d + 1), np.zeros((d + 1, d + 1)), 0, None
        for part in parts:
            for batch, size, xx, xy, yy in part[["batch", "n", "xx", "xy", "yy"]].itertuples(index=False, name=None):
                first = batch if first is None else first
                A, c = np.array(xx, dtype=float).reshape(d, d) / size, np.array(xy, dtype=float) / size
                step, loss = np.eye(d + 1), np.zeros((d + 1, d + 1))
                step[:d, :d] -= lr * (A + lam * np.eye(d))
                step[:d, d] = lr * c
                loss[:d, :d], loss[:d, d], loss[d, :d], loss[d, d] = A + lam * np.eye(d), -c, -c, yy / size
                L, T, n = L + T.T @ loss @ T, step @ T, n + 1
        if n:
            yield pd.DataFrame({"first": [first], "steps": [n], "t": [T.ravel()], "l": [L.ravel()]})

    runs = stats.repartitionByRange("batch").sortWithinPartitions("batch").mapInPandas(compose, "first long, steps long, t array<double>, l array<double>")
    T, L, n = np.eye(d + 1), np.zeros((d + 1, d + 1)), 0
    for row in sorted(runs.collect(), key=lambda r: r["first"]):
        t, l = (np.array(row[k]).reshape(d + 1, d + 1) for k in ("t", "l"))
        L, T, n = L + T.T @ l @ T, t @ T, n + row["steps"]
    return T, L, n


def ridge_sgd(df: DataFrame, xcols: list[str], ycol: str, lam: float = 0.0, lr: float = 0.01, epochs: int = 100,
              batches: int = 1, eps: float = 1e-9, seed: int = 3, key: str = "row_id", batch_size: int | None = None):
    """Mini-batch gradient descent on MSE + λ‖W‖² (bias penalised too) with the gradient
    ``Xᵀe/b + λW`` (e = prediction − target; half the derivative of that loss, kept as specified).
    Rows come in seeded-hash order; batches are ``batches`` hash classes or, with ``batch_size``, runs of that many rows (the last
    may be shorter), the same in every epoch; the start is zero.  Stops when the mean epoch loss
    changes by less than ``eps`` or after ``epochs``.  Returns (weights [w.., b], loss history).

    The batches' cross-products are one aggregation, and an epoch's steps compose into one affine map (``_batch_maps``),
    so there is one pass over the data whatever the number of batches and epochs."""
    d = len(xcols) + 1
    cols = [F.col(c) for c in xcols] + [F.lit(1.0)]
    data = df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)], F.col(ycol).alias("y"), F.col(key).alias("__key"), mix_hash(key, seed=seed).alias("__h"))
    if batch_size:
        data = dense_index(data, ["__h", "__key"], "__at").withColumn("batch", F.floor(F.col("__at") / batch_size).cast("long"))
    else:
        data = data.withColumn("batch", F.pmod(F.col("__h"), F.lit(batches)))
    size = F.count(F.lit(1))
    stats = data.groupBy("batch").agg(size.alias("n"), F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(d) for j in range(d)]).alias("xx"),
                                      F.array(*[F.sum(F.col(f"x{i}") * F.col("y")) for i in range(d)]).alias("xy"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    T, L, n = _batch_maps(stats, d, lam, lr)
    u, history, prev = np.append(np.zeros(d), 1.0), [], None
    for epoch in range(epochs if n else 0):
        mean_loss = float(u @ L @ u) / n
        u = T @ u
        history.append((epoch, mean_loss))
        if prev is not None and abs(prev - mean_loss) < eps:
            break
        prev = mean_loss
    return u[:d], history


# ------------------------------------------------------------------ diagnostics

def residual_table(df: DataFrame, fit: LinearFit, ycol: str) -> DataFrame:
    """Fitted, residual, hat value, internally / externally studentised residual, Cook's distance."""
    n, k, s2 = fit.n, fit.k, fit.sigma2
    out = (df.withColumn("fitted", fit.fitted()).withColumn("residual", F.col(ycol) - F.col("fitted"))
           .withColumn("hat", fit.hat()))
    out = out.withColumn("r_int", F.col("residual") / F.sqrt(F.lit(s2) * (1 - F.col("hat"))))
    out = out.withColumn("r_ext", F.col("r_int") * F.sqrt(F.lit(float(n - k - 1)) / (F.lit(float(n - k)) - F.col("r_int") ** 2)))
    out = out.withColumn("cooks", F.col("r_int") ** 2 * F.col("hat") / (F.lit(float(k)) * (1 - F.col("hat"))))
    return out.withColumn("influential", F.col("cooks") > F.lit(4.0 / (n - k - 2)))


def residual_summary(res: DataFrame) -> DataFrame:
    return res.agg(F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("sd_residual"))


def residual_autocorrelation(res: DataFrame, order: list[str]) -> DataFrame:
    """Lag-1 autocorrelation Σe_t e_{t-1} / Σe² and Durbin–Watson Σ(e_t − e_{t-1})² / Σe², rows in
    ``order``.  Neighbours are paired by an equi-join on a dense row index (no global window)."""
    cols = list(dict.fromkeys([*order, "residual"]))
    idx = dense_index(res.select(*cols), order, "__t")
    prev = idx.select((F.col("__t") + 1).alias("__t"), F.col("residual").alias("__prev"))
    j = idx.join(prev, "__t", "left")
    return j.agg((F.sum(F.col("residual") * F.col("__prev")) / F.sum(F.col("residual") ** 2)).alias("lag1_autocorrelation"),
                 (F.sum((F.col("residual") - F.col("__prev")) ** 2) / F.sum(F.col("residual") ** 2)).alias("durbin_watson"))


def score_test_variance(res: DataFrame, n: int) -> DataFrame:
    """Non-constant variance score test: regress e²/σ̂² (σ̂² = RSS/n) on the fitted values;
    χ² = SSreg / 2 with 1 df."""
    s = res.agg((F.sum(F.col("residual") ** 2) / n).alias("__s2"))
    u = res.crossJoin(F.broadcast(s)).select((F.col("residual") ** 2 / F.col("__s2")).alias("u"), "fitted")
    return u.agg((F.covar_pop("u", "fitted") ** 2 / F.var_pop("fitted") * F.count(F.lit(1)) / 2).alias("chisq"),
                 F.lit(1).alias("df"))


def variance_inflation(df: DataFrame, xcols: list[str]) -> DataFrame:
    """VIF_j = j-th diagonal element of the inverse correlation matrix of the predictors."""
    n, mx, _, sxx, _, _ = sufficient_stats(df.withColumn("__y", F.lit(0.0)), xcols, "__y")
    sd = np.sqrt(np.diag(sxx))
    corr = sxx / np.outer(sd, sd)
    vif = np.diag(np.linalg.inv(corr))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(xcols, vif)], "term string, vif double")


def outlier_test(res: DataFrame, fit: LinearFit, key: list[str]) -> DataFrame:
    """Row with the largest |externally studentised residual| (a max_by aggregate), with its Bonferroni
    p-value n · P(|T| > |t|), df = n − k − 1 (the p-value is a scalar computed on the driver)."""
    top = res.agg(F.max_by(F.struct(*key, "r_ext"), F.abs("r_ext")).alias("t")).select("t.*")
    row = top.first()
    p = min(1.0, fit.n * t_sf_two_sided(abs(row["r_ext"]), fit.n - fit.k - 1))
    return top.withColumn("bonferroni_p", F.lit(p))


def partial_residuals(res: DataFrame, fit: LinearFit) -> DataFrame:
    """Component + residual ``b_j x_j + e`` per predictor."""
    return res.select("*", *[(F.lit(float(b)) * F.col(nm) + F.col("residual")).alias(f"cr_{nm}")
                             for nm, b in zip(fit.names, fit.coef)])


def added_variable(df: DataFrame, xcols: list[str], ycol: str, j: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Adds the residual pair of the added-variable plot of predictor ``j``: y and x_j each regressed on
    the other predictors (fitted on ``fit_on``, default ``df``), as columns of the same rows."""
    base = fit_on if fit_on is not None else df
    others = [c for c in xcols if c != j]
    fy = ols_fit(base, others, ycol)
    fx_ = ols_fit(base, others, j)
    return df.withColumn(f"av_y_{j}", F.col(ycol) - fy.fitted()).withColumn(f"av_{j}", F.col(j) - fx_.fitted())


def spread_level(res: DataFrame) -> DataFrame:
    """Least-squares slope of log|studentised residual| on log(fitted); suggested power = 1 − slope."""
    r = res.filter((F.col("fitted") > 0) & (F.col("r_int") != 0)).select(
        F.log(F.abs("r_int")).alias("ly"), F.log("fitted").alias("lx"))
    return r.agg(F.regr_slope("ly", "lx").alias("slope")).select("slope", (1 - F.col("slope")).alias("power"))


def qq_points(res: DataFrame, key: list[str]) -> DataFrame:
    """Ordered externally studentised residuals with the normal quantile of (i − ½)/n."""
    from quarry.functions.stats import normal_quantile
    idx = dense_index(res.select(*key, "r_ext"), [F.col("r_ext"), *key], "__i")
    n = res.count()
    return idx.select(*key, "r_ext", ((F.col("__i") + 0.5) / n).alias("p"),
                      normal_quantile((F.col("__i") + 0.5) / n).alias("theoretical"))


def moment_tests(res: DataFrame) -> DataFrame:
    """Skewness n·g1²/6 and kurtosis n·(g2 − 3)²/24 of the residuals (each χ²₁)."""
    m = res.agg(F.avg("residual").alias("__m"))
    c = res.crossJoin(F.broadcast(m)).select((F.col("residual") - F.col("__m")).alias("d"))
    a = c.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("d") ** 2).alias("m2"), F.avg(F.col("d") ** 3).alias("m3"),
              F.avg(F.col("d") ** 4).alias("m4"))
    return a.select((F.col("n") * (F.col("m3") / F.col("m2") ** 1.5) ** 2 / 6).alias("skewness_stat"),
                    (F.col("n") * (F.col("m4") / F.col("m2") ** 2 - 3) ** 2 / 24).alias("kurtosis_stat"))


def linear_assumption_test(res: DataFrame, xcols: list[str], order: list[str]) -> DataFrame:
    """Global test of linear-model assumptions (Peña and Slate 2006): skewness, kurtosis, link function,
    heteroscedasticity, each χ²₁, and their sum χ²₄; ``(test, value, df, p_value)``.

    With R = residual / σ̂, σ̂² = RSS / n: the link statistic is (Σ v R)² over what is left of Σ v² after v = (fitted −
    mean)² is projected on the intercept and the predictors; the heteroscedasticity statistic is (Σ (i − ī) R²)² /
    (2 Σ (i − ī)²) with i the row's number in ``order`` (a total order)."""
    mom = moment_tests(res).first()
    cols = list(dict.fromkeys([*order, *xcols, "fitted", "residual"]))
    st = res.agg(F.count(F.lit(1)).alias("n"), F.avg("fitted").alias("mf"), F.avg(F.col("residual") ** 2).alias("s2"),
                 *[F.avg(c).alias(f"m{i}") for i, c in enumerate(xcols)]).first()
    n, s2 = st["n"], st["s2"]
    v, at = (F.col("fitted") - F.lit(st["mf"])) ** 2, F.col("__i") + 1 - (n + 1) / 2
    x = [F.col(c) - F.lit(float(st[f"m{i}"])) for i, c in enumerate(xcols)]
    sums = [F.sum(v * F.col("residual")).alias("vr"), F.sum(v).alias("v"), F.sum(v * v).alias("vv"), F.sum(at * F.col("residual") ** 2).alias("ir"),
            *[F.sum(v * x[i]).alias(f"vx{i}") for i in range(len(x))],
            *[F.sum(x[i] * x[j]).alias(f"xx{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]]
    t = dense_index(res.select(*cols), order, "__i").agg(*sums).first()
    sxx, vx = np.zeros((len(x), len(x))), np.array([t[f"vx{i}"] for i in range(len(x))])
    for i in range(len(x)):
        for j in range(i, len(x)):
            sxx[i, j] = sxx[j, i] = t[f"xx{i}_{j}"]
    left = t["vv"] - t["v"] ** 2 / n - float(vx @ np.linalg.solve(sxx, vx))
    stats = {"skewness": mom["skewness_stat"], "kurtosis": mom["kurtosis_stat"], "link_function": t["vr"] ** 2 / s2 / left,
             "heteroscedasticity": (t["ir"] / s2) ** 2 / (2 * n * (n * n - 1) / 12)}
    rows = [(k, float(x), 1, chi2_sf(float(x), 1)) for k, x in stats.items()]
    tot = float(sum(stats.values()))
    rows.append(("global", tot, 4, chi2_sf(tot, 4)))
    return res.sparkSession.createDataFrame(rows, "test string, value double, df int, p_value double")


# ------------------------------------------------------------------ logistic GLM

def logistic_glm(df: DataFrame, feature_cols: list[str], label: str):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression
    data = VectorAssembler(inputCols=feature_cols, outputCol="features").transform(df)
    model = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label, featuresCol="features",
                                        maxIter=50).fit(data)
    return model


def deviance_test(reduced, full) -> tuple[float, float, float, float, float]:
    """Nested models: (df_reduced, deviance_reduced, df_full, deviance_full, p) — χ² on the difference."""
    sr, sf = reduced.summary, full.summary
    d_dev = sr.deviance - sf.deviance
    d_df = sr.residualDegreeOfFreedom - sf.residualDegreeOfFreedom
    return (sr.residualDegreeOfFreedom, sr.deviance, sf.residualDegreeOfFreedom, sf.deviance, chi2_sf(d_dev, d_df))


def glm_predict(model, df: DataFrame, feature_cols: list[str], label: str, threshold: float = 0.5) -> DataFrame:
    """(actual, predicted 0/1) of a fitted GLM on rows it needn't have seen: the logistic curve of its linear predictor
    against the threshold."""
    eta = F.lit(float(model.intercept))
    for c, b in zip(feature_cols, model.coefficients):
        eta = eta + F.lit(float(b)) * F.col(c)
    return df.select(F.col(label).cast("int").alias("actual"), F.when(1 / (1 + F.exp(-eta)) >= threshold, 1).otherwise(0).alias("predicted"))


def glm_holdout(train: DataFrame, test: DataFrame, models: dict[str, list[str]], label: str) -> DataFrame:
    """``(model, residual_df, deviance, aic, statistics of the held-out predictions)`` for each named set of predictors,
    fitted on ``train`` and judged on ``test``."""
    from quarry.operators.aggregate import classification_report
    out = None
    for name, cols in models.items():
        m = logistic_glm(train, cols, label)
        s = m.summary
        one = classification_report(glm_predict(m, test, cols, label)).select(
            F.lit(name).alias("model"), F.lit(int(s.residualDegreeOfFreedom)).alias("residual_df"), F.lit(float(s.deviance)).alias("deviance"), F.lit(float(s.aic)).alias("aic"), "*")
        out = one if out is None else out.unionByName(one)
    return out
