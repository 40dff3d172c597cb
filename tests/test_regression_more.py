"""Mini-batch descent, held-out GLMs, horizons, assumption statistics and the labelled reader against plain versions."""
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import regression as rg
from quarry.operators import textmine as tm


def hashed(key, seed):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    x = rng.uniform(size=(237, 2))
    return x, x @ [2.0, -1.0] + 0.3 + rng.normal(0, 0.1, 237)


@pytest.fixture(scope="module")
def table(spark, points):
    x, y = points
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "row_id long, a double, b double, y double").repartition(5).cache()


def descend(x, y, groups, lam, lr, epochs, eps):
    """One batch after another."""
    X, w, history, prev = np.column_stack((x, np.ones(len(x)))), np.zeros(3), [], None
    for epoch in range(epochs):
        losses = []
        for g in groups:
            e = X[g] @ w - y[g]
            losses.append(np.mean(e * e) + lam * w @ w)
            w = w - lr * (X[g].T @ e / len(g) + lam * w)
        history.append((epoch, np.mean(losses)))
        if prev is not None and abs(prev - history[-1][1]) < eps:
            break
        prev = history[-1][1]
    return w, history


@pytest.mark.parametrize("size,batches", [(10, 1), (237, 1), (None, 7), (1, 1)])
def test_composed_steps_equal_one_batch_after_another(table, points, size, batches):
    x, y = points
    order = sorted(range(len(y)), key=lambda i: (hashed(i, 3), i))
    groups = [order[i:i + size] for i in range(0, len(order), size)] if size else [[i for i in range(len(y)) if hashed(i, 3) % batches == b] for b in range(batches)]
    w, hist = rg.ridge_sgd(table, ["a", "b"], "y", lam=0.05, lr=0.1, epochs=6, batches=batches, eps=1e-7, batch_size=size)
    want, history = descend(x, y, groups, 0.05, 0.1, 6, 1e-7)
    assert w == pytest.approx(want, rel=1e-9) and [e for e, _ in hist] == [e for e, _ in history]
    assert [v for _, v in hist] == pytest.approx([v for _, v in history], rel=1e-9)


def test_descent_of_no_rows(table):
    w, hist = rg.ridge_sgd(table.limit(0), ["a", "b"], "y", batch_size=10)
    assert list(w) == [0, 0, 0] and hist == []


def test_assumption_statistics(table, points):
    x, y = points
    X = np.column_stack((np.ones(len(y)), x))
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    e, fitted = y - X @ beta, X @ beta
    r, n = e / np.sqrt(np.mean(e * e)), len(y)
    v, i = (fitted - fitted.mean()) ** 2, np.arange(1, n + 1) - (n + 1) / 2
    left = v - X @ np.linalg.lstsq(X, v, rcond=None)[0]
    want = {"skewness": np.sum(r ** 3) ** 2 / (6 * n), "kurtosis": np.sum(r ** 4 - 3) ** 2 / (24 * n), "link_function": np.sum(v * r) ** 2 / np.sum(left ** 2),
            "heteroscedasticity": np.sum(i * (r * r - 1)) ** 2 / (2 * np.sum(i * i))}
    want["global"] = sum(want.values())
    res = rg.residual_table(table, rg.ols_fit(table, ["a", "b"], "y"), "y")
    got = {t.test: t for t in rg.linear_assumption_test(res, ["a", "b"], ["row_id"]).collect()}
    assert {k: t.value for k, t in got.items()} == pytest.approx(want, rel=1e-6)
    assert got["skewness"].p_value == pytest.approx(math.erfc(math.sqrt(want["skewness"] / 2)), rel=1e-6)
    assert got["global"].p_value == pytest.approx(math.exp(-want["global"] / 2) * (1 + want["global"] / 2), rel=1e-6)


def test_held_out_models(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 2))
    y = (rng.uniform(size=600) < 1 / (1 + np.exp(-(0.4 + 1.5 * x[:, 0] - 0.7 * x[:, 1])))).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "i long, a double, b double, y double")
    train, test = df.filter("i < 400"), df.filter("i >= 400")
    got = {r.model: r for r in rg.glm_holdout(train, test, {"all": ["a", "b"], "one": ["b"]}, "y").collect()}
    for name, cols in (("all", [0, 1]), ("one", [1])):
        X, w = np.column_stack((np.ones(600), x[:, cols])), np.zeros(len(cols) + 1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-X[:400] @ w))
            w += np.linalg.solve((X[:400] * (p * (1 - p))[:, None]).T @ X[:400], X[:400].T @ (y[:400] - p))
        p = 1 / (1 + np.exp(-X[:400] @ w))
        deviance = -2 * np.sum(y[:400] * np.log(p) + (1 - y[:400]) * np.log(1 - p))
        pred = X[400:] @ w >= 0
        r = got[name]
        assert r.deviance == pytest.approx(deviance, rel=1e-6) and r.residual_df == 400 - len(w)
        assert r.accuracy == pytest.approx(np.mean(pred == y[400:])) and r.sensitivity == pytest.approx(np.mean(pred[y[400:] == 1]))


def test_horizons(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=12)], float(rng.normal())) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, y double")
    q, t = df.filter("row_id < 15"), df.filter("row_id >= 15")
    got = {r.qid: (r.h4, r.h8, r.h12) for r in rg.kernel_horizons(q, t, [4, 8, 12]).collect()}

    def z(v):
        v = np.array(v)
        return (v - v.mean()) / v.std()
    for i in range(15):
        want = []
        for n in (4, 8, 12):
            e = np.array([math.exp(2 * float(z(rows[i][1][-n:]) @ z(r[1][-n:])) / n) for r in rows[15:]])
            want.append(float(e @ [r[2] for r in rows[15:]] / e.sum()))
        assert got[i] == pytest.approx(want)
    est = rg.kernel_horizons(q, t, [4, 8, 12]).join(q.select(F.col("row_id").alias("qid"), "y"), "qid")
    fit, pred = rg.horizon_regression(est, [4, 8, 12], "y", F.col("qid") < 10, F.col("qid") >= 10)
    X = np.array([[1, *got[i]] for i in range(15)])
    y = np.array([rows[i][2] for i in range(15)])
    w = np.linalg.lstsq(X[:10], y[:10], rcond=None)[0]
    assert [fit.intercept, *fit.coef] == pytest.approx(list(w), rel=1e-6)
    assert sorted(r.predicted for r in pred.collect()) == pytest.approx(sorted(X[10:] @ w), rel=1e-6)


def test_labelled_tagged_tokens(spark):
    lines = [("f", 0, "The/AT Dog/NN1 ./. a/b/c bad"), ("f", 1, ",/, ./."), ("f", 2, "Ran/vbd"), ("g", 0, ""), ("g", 1, None), ("g", 2, "É/Ñn x/1a")]
    got = {tuple(r.tags): list(r.tokens) for r in tm.labeled_tagged_tokens(spark.createDataFrame(lines, "file string, line_no int, line string")).collect()}
    assert got == {("f_SENT_0",): ["the/AT", "dog/NN"], ("f_SENT_2",): ["ran/vb"], ("g_SENT_2",): ["é/Ñn"]}
