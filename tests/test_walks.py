"""Walks over a neighbour table with many neighbours in a row."""
import hashlib

import pytest
from pyspark.sql import functions as F

from quarry.functions.hashing import RANGE, uniform01, uniform_below
from quarry.operators import graph as gr
from quarry.session import Scratch


def drawn(seed, walk, step, what):
    return int(hashlib.md5(f"{seed}:{walk}:{step}:{what}".encode()).hexdigest()[:13], 16)


def followed(pairs, walks_per_node, walk_length, alpha, seed):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    near = {a: sorted(b) for a, b in near.items()}
    out = set()
    for start in near:
        for walk in range(start * walks_per_node, (start + 1) * walks_per_node):
            node = start
            out.add((walk, start, 0, node))
            for step in range(1, walk_length):
                nbrs = near[node]
                node = start if drawn(seed, walk, step, "restart") / RANGE < alpha else nbrs[drawn(seed, walk, step, "pick") % len(nbrs)]
                out.add((walk, start, step, node))
    return out


@pytest.mark.parametrize("alpha", [0.0, 0.3, 1.0])
def test_walks_over_a_hub_of_many_rows(spark, alpha):
    pairs = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(1, 150)] + [(300, 300), (300, 301), (301, 300)]
    walks = gr.random_walks(spark.createDataFrame(pairs, "src long, dst long"), 3, 6, alpha=alpha, seed=4)
    rows = [tuple(r) for r in walks.select("walk_id", "start", "step", "node").collect()]
    want = followed(pairs, 3, 6, alpha, 4)
    assert len(rows) == len(want) and set(rows) == want


def test_a_step_moves_walkers_only_and_sorts_nothing(spark, monkeypatch):
    plans, write = {}, Scratch.write

    def noted(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(Scratch, "write", noted)
    gr.random_walks(spark.createDataFrame([(i, i + 1) for i in range(50)], "src long, dst long"), 2, 3, alpha=0.1, seed=1)
    plan = plans["steps/step=2"]
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan and "Sort" not in plan
    assert plan.count("Exchange") == 1
    assert plan.count("pick") == 1                    # one hash a walker


@pytest.mark.parametrize("limit", [-1.0, 0.0, 2.0 ** -52, 0.1, 0.5, 1 / 3, 1 - 2.0 ** -53, 1.0, 7.0, float("inf")])
def test_uniform_below_is_the_comparison(spark, limit):
    rows = spark.range(3000).select(uniform_below(limit, "id", F.lit("k"), seed=2).alias("a"), (uniform01("id", F.lit("k"), seed=2) < limit).alias("b"))
    assert rows.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
