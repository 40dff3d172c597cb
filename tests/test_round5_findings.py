"""Findings of FINDINGS_r04."""
import random

import numpy as np
import pytest

from quarry.operators import graph, recommend


class Factors:
    def __init__(self, spark, u, i):
        self.userFactors, self.itemFactors = (spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(m)], "id int, features array<float>") for m in (u, i))


@pytest.mark.parametrize("ties, head, block", [(False, 5, 7), (True, 5, 7), (False, 1, 200), (False, 500, None)])
def test_f1_f4_higher_items_are_counted_as_far_as_they_decide(spark, ties, head, block):
    """Every truth item that is not out has its exact number of higher items, and what is out has ``need`` of them."""
    rng, rnd = np.random.default_rng(5), random.Random(5)
    u, i = (rng.integers(-1, 2, (20, 2)), rng.integers(-1, 3, (90, 2))) if ties else (rng.normal(size=(20, 3)), rng.normal(size=(90, 3)))
    u, i = u.astype(np.float32), i.astype(np.float32)
    s = (u.astype(float) @ i.T.astype(float)).astype(np.float32)
    truth = [(a, sorted(rnd.sample(range(90), 6)), rnd.randrange(1, 30)) for a in range(20)]
    units = spark.createDataFrame([(a, 0, need, [float(x) for x in u[a]], [(b, float(s[a, b])) for b in mine]) for a, mine, need in truth],
                                  "__u int, part int, need long, fu array<double>, t array<struct<i: int, s: float>>")
    got = {(r[0], r[1]): r.better for r in recommend._count_better(units, Factors(spark, u, i), 4 if block else None, block, head).collect()}
    above = {(a, b): int((s[a] > s[a, b]).sum() + (s[a, :b] == s[a, b]).sum()) for a, mine, _ in truth for b in mine}
    assert got == {(a, b): above[a, b] for a, mine, need in truth for b in mine if above[a, b] < need}
    assert 0 < len(got) < len(above)


def _distances(pairs, nodes):
    """{(a, b): hops from a to b along edges}"""
    out = {}
    for a in nodes:
        level, seen = {a}, {a: 0}
        while level:
            level = {y for x, y in pairs if x in level and y not in seen}
            seen.update(dict.fromkeys(level, max(seen.values()) + 1))
        out.update({(a, b): d for b, d in seen.items()})
    return out


def _leafy():
    rnd = random.Random(8)
    both = [("c%d" % a, "c%d" % b) for a, b in [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4)]] + [("c%d" % (k % 5), "l%d" % k) for k in range(70)] + [("p", "q"), ("r", "s"), ("s", "t")]
    one_way = [("c0", "d0"), ("d1", "c1"), ("c4", "c0"), ("l1", "l1"), ("l2", "d2"), (None, "c1"), ("c2", None)]
    pairs = both + [(b, a) for a, b in both] + one_way + both[:9]
    rnd.shuffle(pairs)
    return pairs


def test_f5_distances_of_leaves_come_from_their_anchors(spark, monkeypatch):
    monkeypatch.setattr(graph, "LEAVES_PER_ROW", 4)
    pairs = _leafy()
    frame = spark.createDataFrame(pairs, "src string, dst string")
    nodes = {x for p in pairs if None not in p for x in p}
    want = _distances([p for p in pairs if None not in p], nodes)
    marks = ["c0", "l0", "l5", "l5", "l7", "d0", "p", "s", "t", "alone"]
    got = [tuple(r) for r in graph.shortest_path_lengths(frame, spark.createDataFrame([(m,) for m in marks], "id string")).select("id", "landmark", "distance").collect()]
    all_of = {(a, b, d) for (a, b), d in want.items() if b in marks} | {("alone", "alone", 0)}
    assert len(got) == len(set(got)) and set(got) == all_of
    got = [tuple(r) for r in graph.shortest_path_lengths(frame, spark.createDataFrame([(m,) for m in marks], "id string"), max_levels=2).select("id", "landmark", "distance").collect()]
    assert len(got) == len(set(got)) and set(got) == {x for x in all_of if x[2] <= 2}


def test_f5_f6_leaves_are_not_searched(spark, monkeypatch):
    pairs, searched, close = _leafy(), [], {}
    found = graph.levels
    monkeypatch.setattr(graph, "levels", lambda edges, sources, *a, **k: searched.append(sources.count()) or found(edges, sources, *a, **k))
    frame = spark.createDataFrame(pairs, "src string, dst string")
    nodes = {x for p in pairs if None not in p for x in p}
    for (_, b), d in _distances([p for p in pairs if None not in p], nodes).items():
        close[b] = close.get(b, 0) + d
    got = {r.id: r.closeness for r in graph.closeness_centrality(frame).filter("id is not null").collect()}
    assert got == pytest.approx({v: 1 / d if d else float("inf") for v, d in close.items()})
    assert searched[0] < 20
    ids = spark.createDataFrame([(v,) for v in nodes], "id string")
    assert graph.shortest_path_lengths(frame, ids).count() == len(_distances([p for p in pairs if None not in p], nodes))
    assert searched[1] < 20


def test_f3_walks_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            read.add(len(part))
            yield part

    steps = spark.createDataFrame([(w, s, (w + s) % 4) for w in range(6) for s in range(5)], "walk_id long, step int, node long")
    model = recommend.node_embeddings(steps.mapInPandas(counted, steps.schema), 3, 2)
    assert sorted(r.word for r in model.getVectors().collect()) == ["0", "1", "2", "3"] and read.value == 30
