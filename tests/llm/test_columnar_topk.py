import math
import random

import numpy as np
import pytest

from quarry.llm import columnar_topk as ct


def brute(rows, every, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i is not None and i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for m, (j, v) in enumerate(good) if m != n)[:k]
            out += [(i, r + 1, None if null else j, -score) for r, (score, null, j) in enumerate(s)]
    return sorted(map(repr, out))


def rows(n=300, dims=20, seed=0):
    rnd = random.Random(seed)
    out = [(i, [rnd.gauss(0, 0.2) for _ in range(dims)]) for i in range(n)]
    out += [(7, out[3][1]), (5, out[5][1]), (None, out[10][1]), (1000, [0.0] * dims), (1001, None), (1002, [1.0, None] * (dims // 2)), (1003, [float("nan")] * dims),
            (1010, [float("inf")] + [0.0] * (dims - 1)), (1020, []), (1030, [0.5]), (1040, [1e9, -1e9] + [0.1] * (dims - 2)), (20, out[20][1])]
    return out


@pytest.mark.parametrize("options", [{}, {"query_block": 7, "chunk": 16, "dim_block": 3}])
def test_matches_brute_force(spark, options):
    data = [(i, v, "clash") for i, v in rows()]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, rid string")
    got = ct.exact_topk(df, query_filter="vec_id % 10 = 0", **options).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows(), 10, 10)


def test_wide_components(spark):
    """Components far beyond the narrow range, as queries and candidates; too large ones raise."""
    rnd = random.Random(6)
    data = [(i, [rnd.choice([1.0, 1e3, 2e4, 3e5]) * rnd.gauss(0, 1) for _ in range(5)]) for i in range(60)]
    data += [(100, [16384.0, 0.0, 0.0, 0.0, 0.0]), (101, [16384.5, 0.0, 0.0, 0.0, 0.0]), (102, [-30000.0, 1.0, 0.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>"
    got = ct.exact_topk(spark.createDataFrame(data, schema), query_filter="vec_id % 10 = 0", query_block=3, chunk=16).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(data, 10, 10)
    with pytest.raises(Exception, match="fit a long"):
        ct.exact_topk(spark.createDataFrame([(0, [1e17]), (1, [1.0])], schema)).collect()
    with pytest.raises(Exception, match="fit a long"):
        ct.exact_topk(spark.createDataFrame([(0, [1e14]), (1, [1e14])], schema)).collect()


def test_fewer_candidates_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None)], schema)
    assert [tuple(r) for r in ct.exact_topk(few).collect()] == [(0, 1, 1, 512 * 512 + 256 * 256)]
    assert ct.exact_topk(spark.createDataFrame([], schema)).count() == 0
    assert ct.exact_topk(spark.createDataFrame([(1, [1.0])], schema)).count() == 0


def test_bounds_drop_candidates():
    """Survivors are few where mass is concentrated, and always hold the best."""
    rnd = np.random.default_rng(0)
    m = (rnd.normal(size=(5000, 32)) * np.linspace(300, 1, 32)).astype(np.int32)
    cols = ct._Columns(m, 8, np.float64)
    idx, score = ct.search(cols, 0, cols, np.arange(5000) != 0, 10, -np.inf)
    exact = m.astype(np.int64) @ m[0]
    exact[0] = np.iinfo(np.int32).min
    assert set(np.argsort(-exact)[:10]) <= set(idx) and len(idx) < 100 and (score == exact[idx]).all()
