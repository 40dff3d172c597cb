"""Lloyd's rounds over dimension shards against a plain version in Python integers."""
import hashlib
import math
import random

import pytest

from quarry.llm import shard_lloyd
from quarry.llm.shard_lloyd import cluster_digests, lloyd


def brute(rows, dims, k, rounds, scale=1024, seed="3"):
    """rows: (vec_id, components).  Returns a sorted list of (vec_id, cluster, distance) and the centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        member = [near(v)[1] for _, v in kept]
        for c in range(len(centres)):
            mine = [v for (_, v), m in zip(kept, member) if m == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centres


def run(spark, rows, dims, k, rounds, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, block string, ids long")
    members, centres = lloyd(df.repartition(3), dims=dims, k=k, rounds=rounds, **kw)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in members.collect()), key=str)
    return got, [list(r.centroid) for r in centres.orderBy("cluster").collect()], members, centres


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(shard_lloyd, "CELLS", 64)
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(5)]) for i in range(70)]
    rows += [(3, rows[3][1]), (3, [9.0, -9.0, 0.1, 0.0, 1.0]), (None, [1.0] * 5), (None, None), (200, None), (201, [1.0] * 4), (202, [1.0] * 6),
             (203, [1.0, None, 1.0, 1.0, 1.0]), (204, [float("nan")] * 5), (205, [float("inf")] * 5), (206, []), (207, [100.0] * 5), (207, [-100.0] * 5)]
    want, centres = brute(rows, 5, 4, 3)
    got, mine, members, c = run(spark, [(i, v, "x", None, 1) for i, v in rows], 5, 4, 3, dim_block=2)
    assert got == want and mine == centres
    digests = cluster_digests(members, c).collect()
    assert len(digests) == len(want) and {r.inertia for r in digests} == {sum(w[2] for w in want)}
    for r in digests:
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_and_one_shard(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-2.0, 7.0])]
    want, centres = brute(rows, 2, 8, 2)
    got, mine, _, _ = run(spark, [(i, v, None, None, None) for i, v in rows], 2, 8, 2)
    assert got == want and mine == centres


def test_empty_and_too_large(spark):
    got, mine, members, centres = run(spark, [], 3, 4, 2)
    assert got == [] and mine == [] and cluster_digests(members, centres).collect() == []
    with pytest.raises(Exception, match="squared distances"):
        run(spark, [(1, [1e9, 0.0], None, None, None), (2, [1.0, 1.0], None, None, None)], 2, 2, 1)


def test_wide_components_stay_exact(spark):
    rows = [(i, [(-1) ** i * 2.0 ** 14 + i / 7, i * 911.25, -3.5 * i]) for i in range(40)]
    want, centres = brute(rows, 3, 5, 4, scale=4096)
    got, mine, _, _ = run(spark, [(i, v, None, None, None) for i, v in rows], 3, 5, 4, scale=4096, dim_block=1)
    assert got == want and mine == centres
