"""Blocked products: every pair of rows is met whatever the shuffle does (AQE off, many partitions, small blocks)."""
import contextlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.arrays import l2_normalize
from quarry.operators import blocks, community, regression, vectors
from quarry.plans import REGISTRY
from quarry.plans import fixtures as fx
from tests.conftest import SF_SMALL
from tests.oracle import compare

BLOCKED = ["kernel_pairs", "kernel_regression", "move_gain", "nearest_neighbors", "nearest_neighbors_cosmul", "analogy_accuracy"]


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("partitions", ["8", "211"])
@pytest.mark.parametrize("name", BLOCKED)
def test_without_adaptive_plans(spark, duck, name, partitions, monkeypatch):
    monkeypatch.setattr(blocks, "CELLS", 4096)      # several blocks a side
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": partitions}):
        problems = compare(spark, name, REGISTRY[name].fn, REGISTRY[name].sql, SF_SMALL, duck, verbose=False)
    assert not problems, problems


def test_given_blocks_meet_every_pair(spark):
    r = fx.regression_rows(spark, SF_SMALL)
    q, t = r.filter("role = 'query'"), r.filter("role = 'train'")
    n = t.count()
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "13"}):
        got = regression.kernel_sums(q, t, q_block=3, t_block=5).collect()
    assert len(got) == q.count() and {g["n_pairs"] for g in got} == {n}


def test_lost_rows_raise(spark):
    with pytest.raises(Exception, match="another number of rows"):
        spark.range(1).select(blocks.all_met(F.lit(3).cast("long"), 4)).collect()
    a = spark.range(4).withColumn("k", F.lit(0).cast("int"))
    with pytest.raises(TypeError, match="differ in type"):
        blocks.block_pairs(a, a.withColumn("k", F.lit(0).cast("long")), ["k"], None, "id long")


@pytest.mark.parametrize("mode", ["cosine", "cosmul"])
def test_topk_of_small_blocks(spark, mode):
    rng = np.random.default_rng(5)
    vec = {f"w{i:03d}": rng.integers(-2, 3, 4).astype(float) + 0.5 for i in range(90)}     # many equal cosines
    v = spark.createDataFrame([(w, [float(x) for x in x]) for w, x in vec.items()], "word string, vec array<double>")
    unit = {w: x / np.linalg.norm(x) for w, x in vec.items()}
    terms = spark.createDataFrame([(q, f"w{(q * 7 + j) % 90:03d}", 1.0 if j < 2 else -1.0) for q in range(20) for j in range(3)], "qid long, word string, weight double")
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "13"}):
        u = v.select("word", l2_normalize("vec").alias("u"))
        if mode == "cosine":
            q = vectors.query_vectors(v, terms).join(terms.groupBy("qid").agg(F.collect_set("word").alias("excl")), "qid")
            rows = vectors._blocked_topk(q, u, 5, mode, 3, 7).collect()
        else:
            rows = vectors.nearest_neighbors_cosmul(v, terms, 5).collect()
    got = {q: [r["word"] for r in sorted(rows, key=lambda r: r["rank"]) if r["qid"] == q] for q in range(20)}
    for q in range(20):
        own = [f"w{(q * 7 + j) % 90:03d}" for j in range(3)]
        if mode == "cosine":
            m = unit[own[0]] + unit[own[1]] - unit[own[2]]
            score = {w: float(x @ m / np.linalg.norm(m)) for w, x in unit.items() if w not in own}
        else:
            score = {w: (1 + x @ unit[own[0]]) / 2 * (1 + x @ unit[own[1]]) / 2 / ((1 + x @ unit[own[2]]) / 2 + 1e-6) for w, x in unit.items() if w not in own}
        want = sorted(score, key=lambda w: (-round(score[w], 9), w))[:5]
        assert [round(score[w], 9) for w in got[q]] == [round(score[w], 9) for w in want]


def test_every_cluster_is_a_candidate(spark):
    rng = np.random.default_rng(3)
    u = rng.normal(size=(40, 3))
    u /= np.linalg.norm(u, axis=1)[:, None]
    verts = spark.createDataFrame([(i, i % 11, [float(x) for x in u[i]], i % 4) for i in range(40)], "id long, community long, u array<double>, k long")
    S = rng.normal(size=(11, 3))
    clusters = spark.createDataFrame([(c, [float(x) for x in S[c]], c + 1, c) for c in range(11)], "community long, S array<double>, n long, d long")
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "13"}):
        got = {r["id"]: (r["b"], r["score"]) for r in community._best_all_clusters(verts, clusters, 9.0, 0.4, 6, 2).collect()}
    for i in range(40):
        sc = {c: 0.6 * float(u[i] @ S[c]) / (c + 1) - 0.4 * (i % 4) * c / (2 * 81.0) for c in range(11) if c != i % 11}
        b = max(sc, key=lambda c: (sc[c], -c))
        assert got[i][0] == b and got[i][1] == pytest.approx(sc[b])


@pytest.mark.parametrize("strip", [1, 5, 64])
def test_pruned_clusters_equal_the_full_product(spark, monkeypatch, strip):
    """Norms fall quickly, so most clusters are skipped; the winner and its score are those of all scores, ties included."""
    monkeypatch.setattr(community, "STRIP", strip)
    rng = np.random.default_rng(8)
    u = rng.normal(size=(70, 4))
    u /= np.linalg.norm(u, axis=1)[:, None]
    u[7] = 0                                                              # a vertex without attributes
    S = rng.normal(size=(60, 4)) * (0.8 ** np.arange(60))[:, None]
    S[20] = S[10]                                                         # equal centroids
    n, d = np.ones(60), np.zeros(60)
    d[::7] = 3
    verts = spark.createDataFrame([(i, int(rng.integers(60)), [float(x) for x in u[i]], i % 4) for i in range(70)], "id long, community long, u array<double>, k long").cache()
    clusters = spark.createDataFrame([(c, [float(x) for x in S[c]], int(n[c]), int(d[c])) for c in range(60)], "community long, S array<double>, n long, d long")
    got = {r["id"]: r for r in community._best_all_clusters(verts, clusters, 9.0, 0.4, 30, 25).collect()}
    for v in verts.collect():
        sc = np.array([0.6 * float(u[v.id] @ S[c]) / n[c] - 0.4 * v.k * d[c] / 162.0 if c != v.community else -np.inf for c in range(60)])
        assert got[v.id]["score"] == pytest.approx(sc.max(), abs=1e-12) and sc[got[v.id]["b"]] == pytest.approx(sc.max(), abs=1e-12)
        assert got[v.id]["b"] == np.flatnonzero(sc >= sc.max() - 1e-15)[0]
    share = sum(r["scored"] for r in got.values()) / (70 * 60)
    assert share < (0.5 if strip < 64 else 1.01)


def test_kmeans_splits_until_clusters_are_tight(spark):
    rng = np.random.default_rng(6)
    axes = np.eye(5)
    rows = [(i * 5 + g, [float(x) for x in 3 * axes[g] + rng.normal(0, 0.15, 5)]) for i in range(12) for g in range(5)] + [(1000, [0.0] * 5)]
    df = spark.createDataFrame(rows, "id long, attr array<double>")
    got = {r["id"]: (r["community"], r["k"]) for r in community.kmeans_communities(df.repartition(3), 12, 0.2).collect()}
    assert len(got) == 61 and {k for _, k in got.values()} == {len({c for c, _ in got.values()})}
    groups = [{got[i * 5 + g][0] for i in range(12)} for g in range(5)]
    assert all(len(x) == 1 for x in groups) and len(set.union(*groups)) == 5
    assert got == {r["id"]: (r["community"], r["k"]) for r in community.kmeans_communities(df, 12, 0.2).collect()}
    few = community.kmeans_communities(df, 3, 0.2).collect()
    assert len({r["community"] for r in few}) <= 3 and len(few) == 61
    assert community.kmeans_communities(df.limit(0), 3).collect() == []
