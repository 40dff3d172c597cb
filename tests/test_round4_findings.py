"""Findings of FINDINGS_r03: the local-move phase finds the moves of a membership once."""
import itertools

from pyspark.sql import functions as F

from quarry.functions.hashing import mix_hash
from quarry.operators import community as cm
from quarry.operators.relational import symmetric_edges


def _graph(spark, n=24, groups=4):
    pairs = [(a, b) for a, b in itertools.combinations(range(n), 2) if a % groups == b % groups or (a * 7 + b) % 11 == 0]
    edges = spark.createDataFrame(pairs + pairs[:5] + [(1, 1), (None, 2)], "src long, dst long")
    attrs = spark.createDataFrame([(i, [float(i % groups == j) + ((i * 13 + j * 5) % 7) / 20 for j in range(groups)]) for i in range(n)] + [(n, [0.0] * groups)], "id long, attr array<double>")
    return edges, attrs


def _slow_phase(edges, attrs, mem, alpha, passes):
    """Moves and modularity from scratch in each half-round, by the single operators."""
    q = cm.composite_modularity(edges, attrs, mem, alpha)
    for _ in range(passes):
        start = q
        for parity in (0, 1):
            moves = cm.move_gain(edges, attrs, mem, alpha).filter((F.col("gain") > cm.EPS) & (F.pmod(mix_hash("id", seed=99), F.lit(2)) == parity))
            new = mem.join(moves, "id", "left").select("id", F.coalesce("best_community", "community").alias("community")).localCheckpoint()
            q_new = cm.composite_modularity(edges, attrs, new, alpha)
            if q_new >= q - cm.EPS:
                mem, q = new, q_new
        if abs(q - start) <= cm.EPS:
            break
    return mem


def test_f4_sac_phase_equals_half_rounds_from_scratch(spark):
    edges, attrs = _graph(spark)
    start = attrs.select("id", F.col("id").alias("community"))
    got = sorted(map(tuple, cm.sac_phase(edges, attrs, start, 0.5, max_passes=1).collect()))
    assert got == sorted(map(tuple, _slow_phase(symmetric_edges(edges, drop_self_loops=True), attrs, start, 0.5, 1).collect()))
    assert len({c for _, c in got}) < 25


def test_f4_state_modularity_equals_the_operators(spark):
    edges, attrs = _graph(spark)
    mem = attrs.select("id", F.floor(F.col("id") / 6).alias("community")).unionByName(spark.createDataFrame([(99, 1), (None, 2)], "id long, community long"))
    sym = symmetric_edges(edges, drop_self_loops=True)
    clusters = cm._vertex_state(sym, cm.unit_attributes(attrs), cm._degrees(sym), mem, lambda df, name: df)[2]
    for alpha in (0.0, 0.3, 1.0):
        q, _ = cm._state_modularity(clusters, sym.count() / 2, alpha)
        assert abs(q - cm.composite_modularity(sym, attrs, mem, alpha)) < 1e-12


def test_f4_a_membership_that_stays_is_scored_once(spark, monkeypatch):
    edges, attrs = _graph(spark)
    start = attrs.select("id", F.lit(0).cast("long").alias("community"))      # one cluster: no other to move to
    calls, best = [], cm._best_all_clusters
    monkeypatch.setattr(cm, "_best_all_clusters", lambda *a, **k: calls.append(1) or best(*a, **k))
    assert {c for _, c in cm.sac_phase(edges, attrs, start, 0.5).collect()} == {0}
    assert len(calls) == 1
