"""Closed-form, golden and property checks for operators SQL cannot express."""
import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import allocation as al
from quarry.operators import community as cm
from quarry.operators import graph as gr
from quarry.operators import ranking
from quarry.operators import regression as rg
from quarry.operators.relational import symmetric_edges
from quarry.plans import fixtures as fx
from tests.conftest import SF_SMALL

# The ten-vertex example graph (36 directed pairs) and its closeness values.
TEN_VERTEX = [("A", "B"), ("A", "C"), ("A", "D"), ("B", "A"), ("B", "C"), ("B", "D"), ("B", "E"),
              ("C", "A"), ("C", "B"), ("C", "D"), ("C", "F"), ("C", "H"),
              ("D", "A"), ("D", "B"), ("D", "C"), ("D", "E"), ("D", "F"), ("D", "G"),
              ("E", "B"), ("E", "D"), ("E", "F"), ("E", "G"),
              ("F", "C"), ("F", "D"), ("F", "E"), ("F", "G"), ("F", "H"),
              ("G", "D"), ("G", "E"), ("G", "F"), ("H", "C"), ("H", "F"), ("H", "I"), ("I", "H"), ("I", "J"), ("J", "I")]
TEN_VERTEX_CLOSENESS = {"C": 1 / 14, "F": 1 / 14, "D": 1 / 15, "H": 1 / 15, "B": 1 / 17, "E": 1 / 17,
                        "A": 1 / 18, "G": 1 / 18, "I": 1 / 21, "J": 1 / 29}


def test_closeness_golden(spark):
    e = spark.createDataFrame(TEN_VERTEX, "src string, dst string")
    got = {r["id"]: r["closeness"] for r in gr.closeness_centrality(e).collect()}
    assert got.keys() == TEN_VERTEX_CLOSENESS.keys()
    for k, v in TEN_VERTEX_CLOSENESS.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


def test_isolated_closeness_is_infinite(spark):
    e = spark.createDataFrame([("a", "b")], "src string, dst string")
    v = spark.createDataFrame([("a",), ("b",), ("z",)], "id string")
    got = {r["id"]: r["closeness"] for r in gr.closeness_centrality(e, v).collect()}
    # distances are measured *to* the landmark along edge direction: only a reaches b
    assert math.isinf(got["z"]) and got["b"] == 1.0 and math.isinf(got["a"])


def test_articulation_points_hand_graph(spark):
    # two triangles sharing vertex c, plus a tail c-x-y and a separate component p-q
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("c", "e"),
                               ("c", "x"), ("x", "y"), ("p", "q")], "src string, dst string")
    got = {r["id"]: r["articulation"] for r in gr.articulation_points(e).collect()}
    assert {k for k, v in got.items() if v == 1} == {"c", "x"}


def test_components_long_path(spark):
    n = 300
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "src long, dst long")
    comp = gr.connected_components(e)
    rows = {r["id"]: r["component"] for r in comp.collect()}
    assert set(rows[i] for i in range(n + 1)) == {0} and rows[1001] == 1000


def test_random_walks_follow_edges(spark):
    e = fx.large_graph_edges(spark, SF_SMALL)
    walks = gr.random_walks(e, 2, 6, alpha=0.2, seed=5)
    both = symmetric_edges(e, drop_self_loops=False)
    steps = walks.alias("a").join(walks.alias("b"), (F.col("a.walk_id") == F.col("b.walk_id")) &
                                  (F.col("b.step") == F.col("a.step") + 1))
    hop = steps.select(F.col("a.node").alias("src"), F.col("b.node").alias("dst"), F.col("a.start").alias("start"))
    bad = hop.join(both, ["src", "dst"], "left_anti").filter(F.col("dst") != F.col("start"))
    assert bad.count() == 0
    again = gr.random_walks(e, 2, 6, alpha=0.2, seed=5)
    assert walks.exceptAll(again).count() == 0


def test_sac_phase_never_lowers_modularity(spark):
    e = fx.attributed_edges(spark, SF_SMALL)
    a = fx.attributes(spark, SF_SMALL)
    start = a.select("id", F.col("id").alias("community"))
    q0 = cm.composite_modularity(e, a, start, 0.5)
    mem = cm.sac_phase(e, a, start, 0.5, max_passes=3)
    assert cm.composite_modularity(e, a, mem, 0.5) >= q0 - 1e-12


def test_hash_split_is_partition(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    parts = ranking.random_split(df, ["k"], (0.4, 0.4, 0.2), seed=13)
    counts = [p.count() for p in parts]
    assert sum(counts) == 5000 and all(c > 800 for c in counts)
    assert parts[0].intersect(parts[1]).count() == 0


def test_stratified_split_exact_counts(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    s = ranking.stratified_split(df, "y", ["k"], 0.6, buckets=8).groupBy("y", "split").count().collect()
    got = {(r["y"], r["split"]): r["count"] for r in s}
    assert got[(1, "train")] == math.ceil(334 * 0.6) and got[(0, "train")] == math.ceil(666 * 0.6)


def test_allocation_matches_hand_trace(spark):
    bids = spark.createDataFrame([(1, 7, 0.5), (2, 7, 0.4), (2, 8, 0.9), (3, 8, 0.9)], "advertiser long, keyword long, bid double")
    budgets = spark.createDataFrame([(1, 1.2), (2, 1.0), (3, 1.0)], "advertiser long, budget double")
    arr = spark.createDataFrame([(i, k) for i, k in enumerate([7, 7, 7, 8, 8, 7])], "query_id long, keyword long")
    # greedy by hand: q0->1 (1.2>0.5, left 0.7); q1->1 (0.7>0.5, left 0.2); q2->2 (0.4, left 0.6);
    # q3: 2 has 0.6 < 0.9, 3 has 1.0 > 0.9 -> 3; q4: nobody; q5: 1 has 0.2, 2 has 0.6 > 0.4 -> 2
    want = {0: 1, 1: 1, 2: 2, 3: 3, 5: 2}
    got, _ = al.budgeted_allocation_rounds(arr, bids, budgets, "greedy", round_size=1)
    assert {r["query_id"]: r["advertiser"] for r in got.collect()} == want
    # one round: 1, 1 and 2 take q0, q1 and q3 by the frozen budgets (1.2, 1.0, 1.0); then 3 takes q4, and nobody can pay q2 and q5
    got, left = al.budgeted_allocation_rounds(arr, bids, budgets, "greedy", round_size=100)
    assert {r["query_id"]: r["advertiser"] for r in got.collect()} == {0: 1, 1: 1, 3: 2, 4: 3}
    assert {r["advertiser"]: round(r["budget"], 9) for r in left.collect()} == {1: 0.2, 2: 0.1, 3: 0.1}


def sequential(arrivals, bids, budgets, rule):
    left, spent, out = dict(budgets), dict.fromkeys(dict(budgets), 0.0), {}
    for q, k in arrivals:
        best = None
        for a, kw, bid in bids:
            if kw == k and left[a] > bid:
                score = bid if rule == "greedy" else left[a] if rule == "balance" else bid * (1 - math.exp(spent[a] / (left[a] + spent[a]) - 1))
                best = max(best or (-1, 0, 0, 0), (score, -a, a, bid))
        if best:
            out[q] = best[2]
            left[best[2]] -= best[3]
            spent[best[2]] += best[3]
    return out


@pytest.mark.parametrize("rule", ["greedy", "balance", "msvv"])
def test_allocation_rounds(spark, rule):
    rnd = random.Random(3)
    bids = [(a, k, rnd.choice([0.25, 0.5, 0.75, 1.0])) for a in range(6) for k in range(4) if rnd.random() < 0.7]
    budgets = [(a, rnd.choice([0.9, 1.6, 3.3])) for a in range(6)]
    arrivals = [(i, rnd.randrange(5)) for i in range(7)]
    frames = [spark.createDataFrame(x, t) for x, t in ((arrivals, "query_id long, keyword long"), (bids, "advertiser long, keyword long, bid double"), (budgets, "advertiser long, budget double"))]
    got, _ = al.budgeted_allocation_rounds(*frames, rule, round_size=1)
    assert {r["query_id"]: r["advertiser"] for r in got.collect()} == sequential(arrivals, bids, budgets, rule)
    more = [(i, rnd.randrange(5)) for i in range(60)]
    got, state = al.budgeted_allocation_rounds(spark.createDataFrame(more, "query_id long, keyword long"), *frames[1:], rule, round_size=25)
    rows, left = got.collect(), {r["advertiser"]: (r["budget"], r["spent"]) for r in state.collect()}
    assert len({r["query_id"] for r in rows}) == len(rows) and all((r["advertiser"], dict(more)[r["query_id"]], r["bid"]) in bids for r in rows)
    for a, b in budgets:                                                   # paid what was won, never more than there was
        paid = sum(r["bid"] for r in rows if r["advertiser"] == a)
        assert left[a] == pytest.approx((b - paid, paid)) and paid < b
    taken = {r["query_id"] for r in rows}
    assert not [1 for q, k in more if q not in taken and any(kw == k and left[a][0] > bid for a, kw, bid in bids)]   # nobody could pay the others


def test_ridge_sgd_reaches_closed_form(spark):
    df = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 17 / 17.0).alias("x"))
    df = df.withColumn("y", 3 * F.col("x") + 0.5)
    w_closed = rg.ridge_closed_form(df, ["x"], "y", 0.01)
    w_sgd, hist = rg.ridge_sgd(df, ["x"], "y", lam=0.01, lr=0.5, epochs=2000, batches=1, eps=1e-12)
    # the gradient Xᵀe/n + λW vanishes exactly at (XᵀX/n + λI)W = Xᵀy/n
    assert w_sgd == pytest.approx(w_closed, abs=1e-4) and len(hist) > 1


def test_bernoulli_nb_matches_counts(spark):
    from quarry.operators.textmine import bernoulli_nb_fit
    pres = spark.createDataFrame([(1, "f0"), (2, "f0"), (2, "f1"), (3, "f1")], "doc_id long, word string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, label int")
    feats = spark.createDataFrame([("f0",), ("f1",)], "word string")
    base, delta = bernoulli_nb_fit(pres, labels, feats, 1.0)
    b = {r["label"]: r["base"] for r in base.collect()}
    dl = {(r["label"], r["word"]): r["delta"] for r in delta.collect()}
    # class 1: prior 2/3, P(f0) = (2+1)/(2+2), P(f1) = (1+1)/(2+2)
    assert b[1] == pytest.approx(math.log(2 / 3) + math.log(1 / 4) + math.log(1 / 2))
    assert dl[(1, "f0")] == pytest.approx(math.log(3 / 4) - math.log(1 / 4))


def test_vectors_text_round_trip(spark, tmp_path):
    from quarry.sources import files
    v = spark.createDataFrame([("a", [1.0, 2.0], 5), ("b", [0.5, -1.0], 9)], "word string, vec array<double>, count long")
    files.write_vectors_text(v, str(tmp_path / "v"), str(tmp_path / "voc"))
    back = {r["word"]: (list(r["vec"]), r["count"]) for r in files.read_vectors_text(spark, str(tmp_path / "v"), str(tmp_path / "voc")).collect()}
    assert back == {"a": ([1.0, 2.0], 5), "b": ([0.5, -1.0], 9)}


def test_kernel_regression_single_block_equals_blocked(spark):
    r = fx.regression_rows(spark, SF_SMALL)
    q, t = r.filter("role = 'query'"), r.filter("role = 'train'")
    a = {x["qid"]: x["num"] / x["den"] for x in rg.kernel_sums(q, t).collect()}
    b = {x["qid"]: x["num"] / x["den"] for x in rg.kernel_sums(q, t, q_block=3, t_block=5).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)


def test_read_communities_plain_format(spark, tmp_path):
    from quarry.sources import files
    p = tmp_path / "c.txt"
    p.write_text("1,2,3\n4,5\n")
    got = sorted((r["id"], r["community"]) for r in files.read_communities(spark, str(p)).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (4, 1), (5, 1)]
