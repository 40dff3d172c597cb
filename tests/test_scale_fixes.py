"""Checks of the hash, components, readers, quantiles, blocks and stream batches."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.hashing import RANGE, mix_hash, uniform01
from quarry.operators import aggregate as agg
from quarry.operators import graph as gr
from quarry.operators import regression as rg
from quarry.operators.blocks import CELLS, block_grid
from quarry.operators.components import star_components
from quarry.sources import files


def test_hash_is_uniform_and_not_affine(spark):
    rows = spark.range(20000).select(uniform01("id", F.lit(1), seed=1).alias("a"), uniform01("id", F.lit(2), seed=1).alias("b"),
                                     uniform01("id", F.lit(1), seed=2).alias("c"), mix_hash("id").alias("h")).collect()
    a, b, c = (np.array([r[i] for r in rows]) for i in range(3))
    for x in (a, b, c):
        assert abs(x.mean() - 0.5) < 0.01 and abs(np.histogram(x, 20, (0, 1))[0] / 1000 - 1).max() < 0.15
    for x, y in ((a, b), (a, c), (a[1:], a[:-1])):
        assert abs(np.corrcoef(x, y)[0, 1]) < 0.03
        assert len(np.unique(np.round((x - y) % 1, 9))) > 0.99 * len(x)  # no fixed step from one to the other
    assert all(0 <= r.h < RANGE for r in rows)


def test_walk_restarts_and_picks_are_independent(spark):
    n = 40
    edges = spark.createDataFrame([(i, (i + k) % n) for i in range(n) for k in (1, 2, 3, 4, 5)], "src long, dst long")
    walks = gr.random_walks(edges, 60, 20, alpha=0.25, seed=3).toPandas().sort_values(["walk_id", "step"])
    path = np.stack(walks.groupby("walk_id")["node"].apply(np.array).to_numpy())
    start = path[:, :1]
    back = path[:, 1:] == start
    assert path.shape == (2400, 20)
    rate = back[:, 2:].mean()
    both = (back[:, 2:-1] & back[:, 3:]).mean()  # two restarts in a row: about alpha squared and chance returns
    assert 0.2 < rate < 0.35 and both > 0.5 * 0.25 ** 2
    hop = (path[:, 1:] - path[:, :-1]) % n
    share = np.array([(hop[~back] == h).mean() for h in [*range(1, 6), *range(n - 5, n)]])
    assert abs(share / share.mean() - 1).max() < 0.15


@pytest.mark.parametrize("n", [1000])
def test_components_of_a_shuffled_path(spark, n):
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    pairs = list(zip(ids, ids[1:])) + [(2000, 2001), (2001, 2000), (3000, 3000)]
    comp = {r.id: r.component for r in star_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert {comp[i] for i in ids} == {0} and comp[2001] == 2000 and 3000 not in comp


def test_edge_reader_keeps_every_edge_of_many_files(spark, tmp_path):
    folder = tmp_path / "e"
    folder.mkdir()
    for f in range(3):
        (folder / f"part-{f}.txt").write_text(("3000\n" if f == 1 else "") + "".join(f"{f * 1000 + i} {i}\n" for i in range(1000)))
    e, v = files.read_edge_list(spark, str(folder), large=True)
    assert e.count() == 3000 and v.count() == 3000
    (folder / "part-9.txt").write_text("1 x\n")
    assert files.read_edge_list(spark, str(folder), large=True, bad_lines="drop")[0].count() == 3000
    with pytest.raises(Exception, match="not an edge"):
        files.read_edge_list(spark, str(folder), large=True)[0].collect()


def test_exact_quantiles(spark):
    rnd = random.Random(0)
    x = [rnd.choice([rnd.random(), 0.5]) for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in [*x, None]], "v double")
    q = agg.exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.61, "d": 1.0}).first()
    assert np.allclose(list(q), np.quantile(x, [0, 0.25, 0.61, 1]))
    assert list(agg.exact_quantiles(df.limit(0), "v", {"a": 0.5}).first()) == [None]


def test_block_grid(spark):
    for n, m in ((1, 1), (500, 500), (10**6, 300), (50, 10**7)):
        left, right = block_grid(spark, n, m)
        assert math.ceil(n / left) * math.ceil(m / right) <= CELLS
    left, right = block_grid(spark, 500, 500)
    assert left * right > 1


def test_summary_p_values(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(60, 2))
    y = 1 + 2 * x[:, 0] + rnd.normal(size=60)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "x1 double, x2 double, y double")
    got = {r.term: r for r in rg.fit_summary(spark, rg.ols_fit(df, ["x1", "x2"], "y")).collect()}
    X = np.column_stack((np.ones(60), x))
    beta, rss, *_ = np.linalg.lstsq(X, y, rcond=None)
    se = np.sqrt(rss[0] / 57 * np.diag(np.linalg.inv(X.T @ X)))
    for t, b, s in zip(["(Intercept)", "x1", "x2"], beta, se):
        assert got[t].estimate == pytest.approx(b) and got[t].std_error == pytest.approx(s) and got[t].t_value == pytest.approx(b / s)
    assert got["x1"].p_value < 1e-6 < got["x2"].p_value <= 1


def test_rerun_batch_replaces_its_rows(spark, tmp_path):
    from quarry.streaming import lexicon as sl
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("good bad good\nnice\n")
    pos, neg = (spark.createDataFrame([(w,) for w in ws], "word string") for ws in (["good", "nice"], ["bad"]))
    for run in range(2):  # a second run with a new checkpoint writes the same batch ids again
        stream = files.text_stream_source(spark, str(tmp_path / "in"))
        got = sl.stream_lexicon_counts(spark, stream, pos, neg, str(tmp_path / "out"), str(tmp_path / f"ck{run}"))
        assert {r.type: r["count"] for r in got.groupBy("type").agg(F.sum("count").alias("count")).collect()} == {"positive": 3, "negative": 1}


def test_stream_interval_run_stops_in_time(spark, tmp_path):
    """A run by intervals with a duration: batches as they arrive, stopped after the timeout, taken up again later."""
    import time

    from quarry.sources import files
    from quarry.streaming import lexicon as sl
    pos, neg = (spark.createDataFrame([(w,)], "word string") for w in ("good", "bad"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("good good bad other\n")
    began = time.time()
    run = dict(trigger={"processingTime": "1 seconds"}, timeout=12)
    got = sl.stream_running_totals(spark, files.text_stream_source(spark, str(tmp_path / "in")), pos, neg, str(tmp_path / "out"), str(tmp_path / "ck"), **run)
    assert {r["type"]: r["total"] for r in got.collect()} == {"positive": 2, "negative": 1} and 10 < time.time() - began < 60
    (tmp_path / "in" / "b.txt").write_text("bad, BAD bad\n")
    got = sl.stream_running_totals(spark, files.text_stream_source(spark, str(tmp_path / "in")), pos, neg, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert {r["type"]: r["total"] for r in got.collect()} == {"positive": 2, "negative": 3}
