"""Checks of what round 3 found: bytes a pair or an edge carries through shuffles, work repeated by readers."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as gr
from quarry.operators import recommend as rc
from quarry.operators.blocks import block_grid
from quarry.operators.relational import symmetric_edges
from quarry.plans import recommend as plans


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _cosine(a, b):
    if a is None or b is None:
        return 0.0
    n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / n if n else 0.0


def test_prediction_keeps_one_row_a_pair(spark):
    """a pair isn't multiplied by the stars before the shuffles that carry vectors."""
    vectors = [("u1", [1.0, 0.1]), ("u2", [0.0, 0.0]), ("u3", None), ("u4", [1.0, 2.0]), ("u4", [0.5, -3.0]),
               ("m_a_1", [0.0, 1.0]), ("m_a_2", [1.0, 0.0]), ("m_a_5", [1e-3, 1.0]), ("m_b_3", [1.0, 1.0]), ("m_b_4", [2.0, 2.0]),
               ("m_b_4", [0.0, -1.0]), ("m_c_7", [1.0, 1.0]), ("m_d_2", None), ("m_d_4", [1.0, 0.1])]
    pairs = [(u, m) for u in ("u1", "u2", "u3", "u4", "u9", None) for m in ("m_a", "m_b", "m_c", "m_d", "m", None)] + [("u1", "m_a")]
    want = {}
    for u, m in pairs:
        scores = [(_cosine(a, b), -s, s) for x, a in vectors if u and x == u for s in range(1, 6) for y, b in vectors if m and y == f"{m}_{s}"]
        if scores:
            want[u, m] = max(scores)[2]
    got = rc.predict_rating_by_similarity(spark.createDataFrame(pairs, "user_node string, movie string"), spark.createDataFrame(vectors, "node string, vec array<double>"))
    rows = [tuple(r) for r in got.select("user_node", "movie", "predicted").collect()]
    assert len(rows) == len(want) and {(u, m): p for u, m, p in rows} == want
    assert "NestedLoop" not in _plan(got) and "Cartesian" not in _plan(got)


def test_packed_vectors_lose_nothing(spark):
    rows = [([0.5, float("nan"), -0.0],), ([0.1, 2.0],), ([1e300],), ([],), (None,), ([None, 1.0],)]
    df = spark.createDataFrame(rows, "vec array<double>").select("vec", *rc._packed("vec"))
    back = df.select("vec", "f", F.coalesce("d", F.col("f").cast("array<double>")).alias("back")).collect()
    assert [repr(r.back) for r in back] == [repr(r.vec) for r in back]
    assert [r.f is None for r in back] == [False, True, True, False, True, True]


@pytest.fixture
def rated(spark, tmp_path):
    spark.createDataFrame([(k, k % 3) for k in range(8)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(k, k * 3 % 4, 1, n, float(k * 7 + n)) for k in range(8) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    vectors = [(i, [math.sin(i + j) for j in range(4)], i % 2) for i in range(11)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def test_evaluation_predicts_once(spark, rated):
    """the three measures read the pairs of actual and predicted stars from one written table."""
    got = plans.q_rating_evaluation(spark, rated)
    assert all("rating-evaluation" in f for f in got.inputFiles())
    rows, pairs = got.collect(), plans.q_predict_rating_by_similarity(spark, rated).count()
    assert len(rows) == 25 and sum(r.n for r in rows) == pairs
    assert rows[0].mse == pytest.approx(sum(r.n * (r.actual - r.predicted) ** 2 for r in rows) / pairs)
    assert rows[0].accuracy == pytest.approx(sum(r.n for r in rows if r.actual == r.predicted) / pairs)


@pytest.mark.parametrize("loops", [True, False])
def test_each_edge_is_deduplicated_once(spark, loops):
    """Edges are one row with ordered ends where duplicates go, not both directions."""
    edges = [(1, 2), (2, 1), (1, 2), (3, 3), (3, 3), (5, 4), (None, 1), (1, None), (None, None), (None, None), (6, None)]
    want = {e for a, b in edges for e in ((a, b), (b, a)) if not (loops and (a == b or None in (a, b)))}
    df = spark.createDataFrame(edges, "src long, dst long")
    got = symmetric_edges(df, drop_self_loops=loops)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert _plan(symmetric_edges(df, drop_self_loops=loops)).count("Union") == 0
    degree = {r.id: r.degree for r in gr.vertex_degree(df).collect()}
    assert degree == {1: 1, 2: 1, 4: 1, 5: 1}


def test_duplicates_go_in_as_many_tasks_as_asked(spark):
    """The reader of the shuffle doesn't merge the tasks that hold the edges."""
    df = spark.createDataFrame([(i % 40, i * 7 % 50) for i in range(400)], "src long, dst long")
    assert gr.simple_graph(df, tasks=13).rdd.getNumPartitions() == 13
    assert sorted(gr.simple_graph(df, tasks=13).collect()) == sorted(gr.simple_graph(df).collect())


def test_has_edge_of_odd_pairs(spark):
    """edges and pairs meet as one row an edge; loops count, null ends never match."""
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (None, 4), (5, None), (9, 7)], "src long, dst long")
    pairs = [(1, 2), (2, 1), (2, 2), (3, 3), (None, 4), (4, None), (5, None), (7, 9), (9, 7), (7, 9), (None, None)]
    got = gr.has_edge(edges, spark.createDataFrame(pairs, "a long, b long"), tasks=3)
    want = [(a, b, (a, b) in {(1, 2), (2, 1), (3, 3), (7, 9), (9, 7)}) for a, b in pairs]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert _plan(got).count("Union") == 0


@pytest.mark.parametrize("few", [0, 32])
def test_ranks_among_scores(few, monkeypatch):
    """counted one by one or by sorting, ties by id."""
    monkeypatch.setattr(rc, "FEW", few)
    rng = np.random.default_rng(4)
    for ties in (False, True):
        scores = (rng.integers(0, 4, 50) if ties else rng.normal(size=50)).astype(np.float32)
        ids = np.sort(rng.choice(200, 50, replace=False)).astype(np.int32)
        mine = np.concatenate([rng.choice(ids, 5, replace=False), [-1, 300]]).astype(np.int32)
        at = np.array([scores[list(ids).index(i)] if i in ids else 1.0 for i in mine], dtype=np.float32)
        want = [sum(s > a or s == a and i < m for i, s in zip(ids, scores)) for m, a in zip(mine, at)]
        assert rc._ranks(scores, ids, mine, at).tolist() == want


def test_blocks_of_strips_are_few(spark):
    """sides are copied for few blocks; 900,000 users and 1,200,000 items met in 829 blocks of items before."""
    left, right = block_grid(spark, 1_000_000, 1_200_000, sides=(rc.UNIT_BLOCK, rc.ITEM_BLOCK))
    assert left <= 32 and right <= 5


def test_manifest_broadcasts_no_listing(spark):
    """the listing grows with the rows, so it is merged, in the tasks asked for."""
    from quarry.plans.tabular import image_manifest
    labels = [(1, d, f"i{k}.png", f"i{k}_mask.png", k) for k, d in enumerate((1, 0, 1, 0, None, 2))] + [(1, 1, "i0.png", "i0_mask.png", 0)]
    df = spark.createDataFrame(labels, "class_no long, defect int, file string, mask_file string, p_partkey long")
    paths = [f"Class1/i{k}.png" for k in range(6)] * 2 + [f"Class1/Label/i{k}_mask.png" for k in (0, 4, 5)] + [f"Class1/Label/i{k}_label.PNG" for k in (1, 3, 4)]
    listing = spark.createDataFrame([(p,) for p in [*paths, None]], "path string")
    defects, others = [("Class1/i0.png", "Class1/Label/i0_mask.png", 1)] * 2, [(f"Class1/i{k}.png", f"Class1/Label/i{k}_label.PNG", 0) for k in (1, 3)]
    for tasks in (None, 5):
        got = image_manifest(df, listing, tasks=tasks)
        assert sorted(map(tuple, got.collect())) == sorted(defects + others)
        assert "Broadcast" not in _plan(image_manifest(df, listing, tasks=tasks))
        assert len(image_manifest(df, listing, n_classes=1, per_class=1, tasks=tasks).collect()) == 3
