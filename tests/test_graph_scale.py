"""Biconnectivity, bit-parallel search, prefix-sum trees, windowed pairs, heavy-key look-ups and ALS rank counting against
plain versions in Python."""
import random
from collections import Counter, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import biconnected, graph, recommend
from quarry.operators import relational as rel
from quarry.operators import textmine as tm
from quarry.operators.hot_join import hot_keys, lookup_join
from quarry.operators.sequence import exclusive_prefix_sum
from quarry.session import Scratch


def neighbours(edges, nodes=()):
    adj = {n: set() for n in nodes}
    for a, b in edges:
        adj.setdefault(a, set())
        adj.setdefault(b, set())
        if a != b:
            adj[a].add(b)
            adj[b].add(a)
    return adj


def pieces(adj, without=None):
    seen, n = set(), 0
    for s in adj:
        if s == without or s in seen:
            continue
        n, todo = n + 1, [s]
        seen.add(s)
        while todo:
            for y in adj[todo.pop()]:
                if y != without and y not in seen:
                    seen.add(y)
                    todo.append(y)
    return n


def cut_points(adj):
    """By depth-first search with low points (iterative)."""
    low, num, out, t = {}, {}, set(), 0
    for root in adj:
        if root in num:
            continue
        stack, kids = [(root, None, iter(adj[root]))], 0
        num[root] = low[root] = t = t + 1
        while stack:
            v, p, it = stack[-1]
            for w in it:
                if w not in num:
                    num[w] = low[w] = t = t + 1
                    kids += v == root
                    stack.append((w, v, iter(adj[w])))
                    break
                if w != p:
                    low[v] = min(low[v], num[w])
            else:
                stack.pop()
                if p is not None:
                    low[p] = min(low[p], low[v])
                    if p != root and low[v] >= num[p]:
                        out.add(p)
        if kids > 1:
            out.add(root)
    return out


def frame(spark, edges, kind="long"):
    return spark.createDataFrame(list(edges), f"src {kind}, dst {kind}")


def random_graph(rnd, n, m):
    """Several random parts of different density, with loops, repeats and both directions."""
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    edges += [(n + i, n + i + 1) for i in range(12)] + [(n + 20, n + 21 + i) for i in range(9)]      # a path and a star
    ring = list(range(n + 40, n + 52))
    edges += list(zip(ring, ring[1:] + ring[:1])) + [(n + 45, n + 60), (n + 60, n + 61), (n + 61, n + 45)]
    return edges + edges[:5] + [(b, a) for a, b in edges[3:9]] + [(2, 2)]


def test_plain_versions_agree():
    rnd = random.Random(0)
    for _ in range(60):
        adj = neighbours([(rnd.randrange(14), rnd.randrange(14)) for _ in range(rnd.randrange(5, 24))])
        whole = pieces(adj)
        assert cut_points(adj) == {v for v in adj if pieces(adj, v) > whole}


@pytest.mark.parametrize("seed,n,m", [(1, 40, 45), (4, 200, 230)])
def test_articulation_points(spark, seed, n, m, monkeypatch):
    monkeypatch.setattr(biconnected, "BLOCK", 4)                    # several levels of range minima
    edges = random_graph(random.Random(seed), n, m)
    adj = neighbours(edges, [9999])
    want = cut_points(adj)
    got = graph.articulation_points(frame(spark, edges), spark.createDataFrame([(v,) for v in adj], "id long")).collect()
    assert {r.id: r.articulation for r in got} == {v: int(v in want) for v in adj}


def test_articulation_of_text_ids_and_empty(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "x")]
    got = {r.id: r.articulation for r in graph.articulation_points(frame(spark, edges, "string")).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 0, "x": 0}
    assert graph.articulation_points(frame(spark, [])).collect() == []


def test_articulation_of_many_edges(spark):
    """100,000 edges: blocks of vertices in a ring of rings, hung on a long path.  Rows stay O(E), so this ends soon."""
    rnd = random.Random(9)
    edges = []
    for block in range(2000):
        ids = list(range(block * 25, block * 25 + 25))
        edges += list(zip(ids, ids[1:] + ids[:1])) + [tuple(rnd.sample(ids, 2)) for _ in range(24)]
        edges.append((ids[3], ids[3] + 25) if block < 1999 else (ids[3], 10 ** 6))
    want = cut_points(neighbours(edges))
    got = graph.articulation_points(frame(spark, edges)).filter("articulation = 1").collect()
    assert len(edges) >= 100_000 and {r.id for r in got} == want


def test_euler_tour_places(spark):
    rnd = random.Random(5)
    tree = [(rnd.randrange(i), i) for i in range(1, 80)] + [(200, 201), (201, 202)]
    e = frame(spark, tree + [(b, a) for a, b in tree]).toDF("u", "v")
    scratch = Scratch(spark, "test-tour")
    forest, labels = biconnected.spanning_forest(e, scratch)
    assert {tuple(r) for r in forest.collect()} == set(tree)
    tour = biconnected.euler_tour(forest, labels, scratch)
    rows = sorted(tour.collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(2 * len(tree)))
    assert all(a.v == b.u for a, b in zip(rows, rows[1:]) if a.root == b.root)
    places = {r.id: r for r in biconnected.tree_places(tour, labels).collect()}
    assert len(places) == 83 and all(places[r.parent].first < r.first < r.last < places[r.parent].last for r in places.values() if r.parent is not None)


def distances(edges, source):
    out, todo = {source: 0}, deque([source])
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
    while todo:
        v = todo.popleft()
        for w in adj.get(v, ()):
            if w not in out:
                out[w] = out[v] + 1
                todo.append(w)
    return out


@pytest.fixture(scope="module")
def directed():
    rnd = random.Random(3)
    return [(rnd.randrange(150), rnd.randrange(150)) for _ in range(260)] + [(300 + i, 301 + i) for i in range(9)]


def test_shortest_paths_of_a_directed_graph(spark, directed):
    nodes = sorted({x for e in directed for x in e})
    marks = nodes[::2] + [777]                                       # more than 64; one isolated
    got = graph.shortest_path_lengths(frame(spark, directed), spark.createDataFrame([(m,) for m in marks + marks[:3]], "id long")).collect()
    back = [(b, a) for a, b in directed]
    want = {(v, m, d) for m in marks for v, d in distances(back, m).items()}
    assert len(got) == len(want) and {(r.id, r.landmark, r.distance) for r in got} == want
    near = graph.shortest_path_lengths(frame(spark, directed), spark.createDataFrame([(m,) for m in marks], "id long"), max_levels=2).collect()
    assert {(r.id, r.landmark, r.distance) for r in near} == {x for x in want if x[2] <= 2}
    assert graph.shortest_path_lengths(frame(spark, directed), spark.createDataFrame([], "id long")).collect() == []


def test_closeness_counts_incoming_distances(spark, directed):
    nodes = sorted({x for e in directed for x in e})
    got = {r.id: r.closeness for r in graph.closeness_centrality(frame(spark, directed), spark.createDataFrame([(v,) for v in nodes + [888]], "id long")).collect()}
    total = Counter({v: 0 for v in nodes + [888]})
    for v in nodes:
        for w, d in distances(directed, v).items():
            total[w] += d
    assert got == {v: pytest.approx(1 / s if s else float("inf")) for v, s in total.items()}


def test_closeness_has_no_row_for_a_pair(spark, directed):
    plan = graph.closeness_centrality(frame(spark, directed))._jdf.queryExecution().toString()
    assert "landmark" not in plan


def test_spread_of_many_seeds(spark, directed):
    nodes = sorted({x for e in directed for x in e})
    home = {v: v % 3 for v in nodes if v != nodes[4]}                 # one vertex without a community
    seeds = nodes[:100]
    got = graph.spread_coverage(frame(spark, directed), spark.createDataFrame([(s,) for s in seeds], "seed long"), spark.createDataFrame(list(home.items()), "id long, community long")).orderBy("step").collect()
    inside, outside = Counter(), Counter()
    for s in seeds:
        if s in home:
            for v, d in distances(directed, s).items():
                if v in home:
                    (inside if home[v] == home[s] else outside)[d] += 1
    last = max(inside | outside)
    assert [r.step for r in got][:last + 1] == list(range(last + 1))
    for r in got:
        i, o = sum(n for d, n in inside.items() if d <= r.step), sum(n for d, n in outside.items() if d <= r.step)
        assert (r.reached_inside, r.reached_outside) == (i, o) and r.reached_fraction == pytest.approx((i + o) / (len(seeds) * len(home)))


@pytest.mark.parametrize("width", [2, 7, 4096])
def test_prefix_sums_by_levels(spark, width):
    rnd = random.Random(width)
    rows = [(k, rnd.randrange(-5, 9)) for k in rnd.sample(range(-500, 3000), 400)]
    df = spark.createDataFrame(rows, "k long, v long")
    out = exclusive_prefix_sum(df, "k", "v", "o", width)
    want, total = {}, 0
    for k, v in sorted(rows):
        want[k], total = total, total + v
    assert {r.k: r.o for r in out.collect()} == want
    assert exclusive_prefix_sum(df.limit(0), "k", "v", "o", width).collect() == []
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("[__bkt" in line for line in plan.splitlines() if "Window [" in line)     # every window is partitioned


def test_context_pairs(spark):
    rnd = random.Random(8)
    docs = {i: [rnd.choice("abcde") for _ in range(n)] for i, n in enumerate([0, 1, 2, 3, 7, 8, 9, 40, 1000])}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, tokens array<string>")
    df = df.unionByName(spark.createDataFrame([(99, None)], df.schema))
    for window, piece in ((1, 4), (3, 4), (4, 4), (2, 64)):
        want = Counter((d, i, j, t[i], t[j]) for d, t in docs.items() for i in range(len(t)) for j in range(max(0, i - window), min(len(t), i + window + 1)) if i != j)
        whole = rel.both_directions(rel.forward_context_pairs(df, window, piece=piece)).collect()
        rows = rel.context_pairs(tm.doc_tokens(df).repartition(5), window, piece=piece).collect()
        assert Counter(tuple(r) for r in whole) == Counter(tuple(r) for r in rows) == want
        counts = {(r.word, r.context): r.n for r in rel.context_pair_counts(df, window).collect()}
        assert counts == Counter((w, c) for *_, w, c in want.elements())


def test_windows_make_no_join(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, tokens array<string>")
    plan = rel.forward_context_pairs(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_token_chunks_and_lines(spark):
    rnd = random.Random(4)
    docs = [(i * 3, "\n".join(" ".join(f"w{rnd.randrange(9)}" for _ in range(rnd.randrange(0, 30))) for _ in range(rnd.randrange(1, 5)))) for i in range(60)] + [(1, ""), (4, None), (7, " \n ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    stream = [w for _, t in sorted(docs) for w in (t or "").split()]
    got = {r.chunk: list(r.tokens) for r in tm.token_chunks(df, max_len=17).collect()}
    assert got == {c: stream[c * 17:c * 17 + 17] for c in range(-(-len(stream) // 17))}
    lines = [(d, x.split()) for d, t in sorted(docs) if t is not None for x in t.split("\n")]
    got = {r.line_no: (r.doc_id, list(r.tokens), list(r.tags)) for r in tm.line_sentences(df, labelled=True).collect()}
    assert got == {i: (d, t, [f"SENT_{i}"]) for i, (d, t) in enumerate(lines)}


def test_heavy_key_lookup(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 400).cast("string"))).alias("word"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "word string, id long"))
    table = spark.createDataFrame([("hot", 1000, 0.5)] + [(f"w{i}", 5, float(i)) for i in range(0, 400, 2)], "word string, count long, p double")
    assert "hot" in {r.word for r in hot_keys(rows, "word", 3).collect()}
    for counts in ("count", None):
        for most in (1, 5, 1000):
            got = lookup_join(rows, table, "word", counts=counts, most=most).select("word", "id", "p")
            assert sorted(got.collect()) == sorted(rows.join(table, "word").select("word", "id", "p").collect())
            got = lookup_join(rows, table, "word", "left_semi", counts=counts, most=most)
            assert sorted(got.collect()) == sorted(rows.join(table, "word", "left_semi").select(*got.columns).collect())
    plan = lookup_join(rows, table, "word", counts="count")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("Join Inner") == 2


class Factors:
    def __init__(self, spark, u, i):
        self.userFactors, self.itemFactors = (spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(m)], "id int, features array<float>") for m in (u, i))


@pytest.mark.parametrize("ties", [False, True])
def test_overlap_by_rank_counting(spark, monkeypatch, ties):
    """Against sorting every user's items; a heavy user has several units, blocks are small."""
    monkeypatch.setattr(recommend, "UNIT", 8)
    rng, rnd = np.random.default_rng(2), random.Random(2)
    u, i = (rng.integers(0, 2, (25, 2)), rng.integers(0, 3, (60, 2))) if ties else (rng.normal(size=(25, 3)), rng.normal(size=(60, 3)))
    u, i = u.astype(np.float32), i.astype(np.float32)
    model = Factors(spark, u, i)
    uidx = spark.createDataFrame([(k + 1000, k) for k in range(25)], "user_id long, __u int")
    iidx = spark.createDataFrame([(k + 500, k) for k in range(60)], "item_id long, __i int")
    train = {(rnd.randrange(25), rnd.randrange(60)) for _ in range(300)} | {(3, x) for x in range(30)}
    truth = ({(rnd.randrange(27), rnd.randrange(63)) for _ in range(200)} | {(3, x) for x in range(25, 60)}) - train
    rows = [spark.createDataFrame([(a + 1000, b + 500) for a, b in x] * 2, "user_id long, item_id long") for x in (train, truth)]
    got = {r.user_id - 1000: r.overlap for r in recommend.als_overlap_score(model, uidx, iidx, *rows, unit_block=4, item_block=7).collect()}
    want = {}
    for a in {x for x, _ in truth}:
        mine = {y for x, y in truth if x == a}
        if a < 25:
            s = (u[a].astype(float) @ i.T.astype(float)).astype(np.float32)
            top = sorted((y for y in range(60) if (a, y) not in train), key=lambda y: (-s[y], y))[:len(mine)]
            want[a] = len(mine & set(top)) / len(mine)
        else:
            want[a] = 0.0
    assert got == pytest.approx(want)
