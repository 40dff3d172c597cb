import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing
from tests.llm.conftest import odd_rows

SP = " \t\n\x0b\x0c\r"


def n_words(t):
    for c in SP:
        t = (t or "").replace(c, " ")
    return len([w for w in t.split(" ") if w])


def brute_targets(sizes, weights, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over


@pytest.mark.parametrize("cut", [True, False])
def test_targets_and_taken(odd_docs, cut):
    rows = odd_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    plan = mixing.mix_plan(odd_docs, n_blocks=16, shard_levels=2, cut_edge=cut)
    got = plan.collect()
    again = mixing.mix_plan(odd_docs, n_blocks=16, shard_levels=2, cut_edge=cut).collect()
    key = lambda r: (repr(r.doc_id), r.size, r.source_size, r.target, str(r.copies))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(r[0]), n_words(r[1])) for r in rows)
    want = brute_targets(sizes, [1, 2, 3])
    src = {r[0]: r[3] for r in rows}
    taken, big = Counter(), Counter()
    for r in got:
        t = sum(c.words for c in r.copies)
        assert t <= 3 * r.size and len({c.copy for c in r.copies}) == len(r.copies) <= 3
        assert all(c.words == r.size or cut for c in r.copies)
        if r.doc_id is not None:
            assert r.source_size == sizes[src[r.doc_id]] and r.target == pytest.approx(want[src[r.doc_id]])
        k = r.source_size, round(r.target, 6)
        taken[k] += t
        big[k] = max(big[k], r.size)
    for (size, target), t in taken.items():
        assert abs(t - target) <= (1 if cut else big[size, target] / 2 + 1)


def test_tree_splits_quotas_exactly(spark):
    q = {"a": 700, "b": 200, "c": 100, "d": 1, "e": 0}
    quotas = spark.createDataFrame(list(q.items()), "skey string, q long")
    got = mixing.splitting_tree(quotas, 3, seed=1).collect()
    by, shard = Counter(), Counter()
    for r in got:
        assert r.q >= 0
        by[r.skey] += r.q
        shard[r.shard] += r.q
    assert by == Counter(q) and set(shard) == set(range(8)) and max(shard.values()) - min(shard.values()) <= 1


def test_tree_follows_the_hypergeometric_law(spark):
    """Mean and variance of the left child's count over many seeds."""
    quotas = spark.createDataFrame([("a", 30), ("b", 50), ("c", 20)], "skey string, q long")
    one = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("skey", "q"))).alias("quotas"))
    many = spark.range(2000).crossJoin(one).select(mixing._split(F.col("quotas"), F.col("id"), 9).alias("x"))
    got = many.select(F.explode("x").alias("x")).groupBy("x.skey").agg(F.avg("x.q").alias("m"), F.var_samp("x.q").alias("v")).collect()
    for r in got:
        k = {"a": 30, "b": 50, "c": 20}[r.skey]
        var = 50 * (k / 100) * (1 - k / 100) * (50 / 99)
        assert abs(r.m - k / 2) < 5 * math.sqrt(var / 2000) and abs(r.v / var - 1) < 0.2


def test_mix_rows(odd_docs):
    plan = mixing.mix_plan(odd_docs, n_blocks=16, shard_levels=2).collect()
    mix = mixing.mix_sources(odd_docs, shards=True, n_blocks=16, shard_levels=2)
    got = Counter()
    for r in mix.collect():
        got[repr(r.doc_id)] += n_words(r.text)
    want = defaultdict(int)
    for r in plan:
        want[repr(r.doc_id)] += sum(c.words for c in r.copies)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    clash = odd_docs.withColumns({"__size": F.lit("mine"), "__copy": F.lit("mine"), "words": F.lit(None).cast("int")})
    mix = mixing.mix_sources(clash, n_blocks=16)
    assert mix.columns == clash.columns and {(r["__src_pos"], r["__size"], r["__copy"]) for r in mix.collect()} == {("clash", "mine", "mine")}


def test_empty_table(no_docs):
    assert mixing.mix_plan(no_docs).count() == 0
    assert mixing.mix_sources(no_docs).count() == 0
