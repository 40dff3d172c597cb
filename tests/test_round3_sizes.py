"""Checks of what round 3 found on larger tables: steps, bytes and rows of a task that grew faster than the input."""
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import allocation as al
from quarry.operators import bfs, blocks
from quarry.operators import community as cm
from quarry.operators import graph as gr
from quarry.operators import vectors as vq
from quarry.operators.relational import context_pair_counts, edge_endpoints, symmetric_edges
from quarry.session import Scratch
from quarry.sources import files


def _rounds(arrivals, bids, budgets, rule, size):
    """The allocation by its definition, one sub-round after the other."""
    left, spent, out = dict(budgets), dict.fromkeys(dict(budgets), 0.0), {}
    for lo in range(0, len(arrivals), size):
        pending = arrivals[lo:lo + size]
        while pending:
            best = {}
            for a, k, bid in bids:
                if left[a] > bid:
                    score = bid if rule == "greedy" else left[a]
                    best[k] = max(best.get(k, (-1, 0, 0, 0)), (score, -a, a, bid))
            tried = [(q, k, *best[k][2:]) for q, k in pending if k in best]
            before, paid, pending = {}, {}, []
            for q, k, a, bid in tried:
                if left[a] - before.get(a, 0.0) > bid:
                    out[q], paid[a] = a, paid.get(a, 0.0) + bid
                else:
                    pending.append((q, k))
                before[a] = before.get(a, 0.0) + bid
            for a, x in paid.items():
                left[a] -= x
                spent[a] += x
    return out, left


@pytest.mark.parametrize("rule", ["greedy", "balance"])
def test_allocation_takes_few_steps(spark, monkeypatch, rule):
    """a round with a sub-round for nearly every advertiser is played in a few steps, also where lists of offers run out."""
    monkeypatch.setattr(al, "OFFERS", 90)
    monkeypatch.setattr(al, "QUERIES", 120)
    rnd = random.Random(9)
    bids = [(a, k, rnd.choice([0.25, 0.5, 0.75])) for a in range(60) for k in range(3) if rnd.random() < 0.8]
    budgets = [(a, rnd.choice([0.2, 0.9, 1.6])) for a in range(60)]
    arrivals = [(i, rnd.randrange(4)) for i in range(250)]
    tables, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: (tables.append(name), write(self, df, name))[1])
    frames = [spark.createDataFrame(x, t) for x, t in ((arrivals, "query_id long, keyword long"), (bids, "advertiser long, keyword long, bid double"), (budgets, "advertiser long, budget double"))]
    got, state = al.budgeted_allocation_rounds(*frames, rule, round_size=40)
    want, left = _rounds(arrivals, bids, budgets, rule, 40)
    assert {r["query_id"]: r["advertiser"] for r in got.collect()} == want and got.count() == len(want)
    assert {r["advertiser"]: r["budget"] for r in state.collect()} == left
    if rule == "greedy":
        assert len(tables) < 40                                              # 3 a sub-round before


def test_blocks_stay_few(spark, monkeypatch):
    """Each side of a product is copied for few blocks of the other, whatever the number of scores."""
    rows = [(i, [float((i * 7 + j * j) % 11) for j in range(4)], i // 3) for i in range(60)]
    v = spark.createDataFrame(rows, "id long, attr array<double>, community long")
    words = v.select(F.col("id").cast("string").alias("word"), F.col("attr").alias("vec"))
    terms = v.limit(5).select(F.col("id").alias("qid"), F.col("id").cast("string").alias("word"), F.lit(1.0).alias("weight"))
    grids = []

    def spy(session, n, m, *rest):
        grids.append(blocks.block_grid(session, 600_000, 150_000, *rest))
        return blocks.block_grid(session, n, m, *rest)

    monkeypatch.setattr(cm, "block_grid", spy)
    monkeypatch.setattr(vq, "block_grid", spy)
    assert len(vq.nearest_neighbors_cosmul(words, terms, 3).collect()) == 15
    cm.move_gain(v.select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")), v, v, 0.5).collect()
    cm.kmeans_communities(v, 2)
    assert len(grids) >= 3 and all(left <= 20 and right <= 20 for left, right in grids)


def test_vectors_do_not_travel_with_every_pair(spark):
    """Mean vectors by blocks equal the plain means, with several vectors of a word, nulls and unknown words."""
    rnd = random.Random(4)
    vectors = [(f"w{i % 25}", [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(30)] + [(None, [1.0, 1.0, 1.0]), ("w29", None)]
    tokens = [(rnd.randrange(9), f"w{rnd.randrange(30)}", rnd.choice([0.5, 1.0, 2.0])) for _ in range(200)] + [(None, "w1", 1.0), (3, None, 1.0), (99, "w29", 1.0)]
    frame = spark.createDataFrame(tokens, "doc_id long, word string, w double")
    table = spark.createDataFrame(vectors, "word string, vec array<double>")
    for weight in (None, "w"):
        want = {}
        for doc, word, w in tokens:
            for name, vec in vectors:
                if doc is not None and word is not None and word == name and vec is not None:
                    x, t = want.setdefault(doc, ([0.0] * 3, [0.0]))
                    t[0] += w if weight else 1
                    x[:] = [a + b * (w if weight else 1) for a, b in zip(x, vec)]
        for sizes in ({}, {"pairs": 20, "word_block": 7}):
            out = vq.mean_word_vectors(frame, table, weight=weight, **sizes)
            got = {r["doc_id"]: r["vec"] for r in out.collect()}
            assert out.count() == len(want) and got.keys() == want.keys()
            for doc, (x, t) in want.items():
                assert got[doc] == pytest.approx([a / t[0] for a in x])


@pytest.mark.parametrize("small", [0, 1000])
def test_levels_deal_rows_over_tasks(spark, monkeypatch, small):
    """Rows of a level are dealt over tasks in proportion, a hub's words over several shares; distances stay."""
    edges = [("hub", f"v{i}") for i in range(90)] + [(f"v{i}", f"v{i + 1}") for i in range(0, 90, 7)] + [("x", "hub"), ("y", "z")]
    frame = symmetric_edges(spark.createDataFrame(edges, "src string, dst string"))
    near = lambda: {(r.id, r.landmark, r.distance) for r in gr.shortest_path_lengths(frame, edge_endpoints(frame)).collect()}
    close = lambda: {(r.id, r.closeness) for r in gr.closeness_centrality(frame).collect()}
    want = near(), close()
    monkeypatch.setattr(bfs, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(bfs, "SMALL_LINKS", small)
    dealt, deal = [], bfs.tasks_for
    monkeypatch.setattr(bfs, "tasks_for", lambda rows: (dealt.append(deal(rows)), dealt[-1])[1])
    assert (near(), close()) == want and len(want[0]) == 92 * 92 + 4
    assert dealt and all(n and n > 8 for n in dealt)


def test_context_counts_shuffle_once(spark):
    """counts of both directions come from one aggregation, with repeated words and missing ones."""
    docs = spark.createDataFrame([(1, ["a", "b", "a", "a"]), (2, ["b", "a"]), (3, [None, "a", None, None]), (4, []), (5, ["c"])], "doc_id long, tokens array<string>")
    want = {}
    for _, t in docs.collect():
        for i in range(len(t)):
            for j in range(len(t)):
                if 0 < abs(i - j) <= 2:
                    want[t[i], t[j]] = want.get((t[i], t[j]), 0) + 1
    got = context_pair_counts(docs, 2)
    rows = got.collect()
    assert {(r.word, r.context): r.n for r in rows} == want and len(rows) == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_adjacency_lines_sort_hubs_alone(spark, tmp_path, monkeypatch):
    """nodes within a line need no global sort; lines hold every neighbour in order, hubs on several."""
    edges = [("hub", f"n{i:02d}") for i in range(23)] + [("a", "x"), ("a", "b"), ("a", "b"), ("b", None), (None, "a"), ("c", "a")]
    sorted_rows, index = [], files.dense_index
    monkeypatch.setattr(files, "dense_index", lambda df, *a: (sorted_rows.append(df.count()), index(df, *a))[1])
    files.write_adjacency_list(spark.createDataFrame(edges, "src string, dst string"), str(tmp_path / "adj"), max_per_line=10)
    hub = [f"n{i:02d}" for i in range(23)]
    want = [" ".join(["hub", *hub[i:i + 10]]) for i in (0, 10, 20)] + ["a b b x", "b ", "c a"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "adj")).collect()) == sorted(want)
    assert sorted_rows == [23]
