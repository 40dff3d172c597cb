import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import toxicity_knn as tk
from tests.llm.conftest import odd_rows


def corpus(n=1200, seed=0):
    rnd = random.Random(seed)
    calm, rude = [f"w{i}" for i in range(200)], ["grub", "lout", "oaf", "prat"]
    out = []
    for i in range(n):
        y = int(rnd.random() < 0.15)
        w = [rnd.choice(calm) for _ in range(rnd.randrange(20, 80))]
        for _ in range(rnd.randrange(2, 6) * y):
            w[rnd.randrange(len(w))] = rnd.choice(rude)
        out.append((i, " ".join(w), y))
    return out


def index(n=600):
    data = corpus(n)
    vocab = {w: j for j, w in enumerate(["grub", "lout", "oaf", "prat"] + [f"w{i}" for i in range(60)])}
    idf = np.linspace(3, 1, len(vocab))
    return tk.build_index(vocab, idf, [tk.term_counts(t, vocab) for _, t, _ in data], [i for i, _, _ in data], [y for *_, y in data], 10), data


def test_search_is_exact():
    idx, data = index()
    n, T = idx.blocks.shape[0], len(idx.idf)
    dense = idx.blocks.transpose(0, 2, 1).reshape(n * tk.BLOCK, T)
    for _, text, _ in corpus(60, seed=9) + [(0, "grub", 0), (0, "none here", 0), (0, data[5][1], 0)]:
        t, w = idx.vector(text)
        bound = w @ idx.block_max[t] * (1 + 1e-12) if len(t) else None
        at, cos = idx.neighbours(t, w, bound) if len(t) else (np.empty(0, int), np.empty(0))
        if len(t):
            part = idx.partial([(t, w)])[0]
            tight = idx.neighbours(t, w, idx.bounds(t, w, part), partial=part)
            assert tight[0].tolist() == at.tolist() and (idx.bounds(t, w, part) <= bound + 1e-12).all()
        q = np.zeros(T)
        q[t] = w
        c = dense @ q
        want = [p for p in sorted(range(len(c)), key=lambda p: (-round(c[p], 12), p)) if c[p] > 0][:10]
        assert at.tolist() == want and np.allclose(cos, c[want])


def test_held_out_accuracy_and_calibration(spark):
    data = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    truth = {i: y for i, _, y in data}
    got = tk.toxicity(docs, labels).collect()
    assert len(got) == len(data)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in data if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    brier, base = np.mean([(r.score - truth[r.doc_id]) ** 2 for r in held]), np.mean(list(truth.values()))
    assert brier < 0.3 * base * (1 - base) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in data], "doc_id long, toxic int")
    assert sorted(map(str, tk.toxicity(docs, flipped).collect())) == sorted(map(str, got))  # held-out labels aren't read
    kept = {r.doc_id for r in tk.drop_toxic(docs, labels).collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (3, 0, None), (None, 1, None), (2, None, None), (7, 7, None), (100, 0, None), (101, 1, None)], "doc_id long, toxic int, text string")
    got = tk.toxicity(odd_docs, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert tk.toxicity(no_docs, labels).count() == 0 and set(tk.drop_toxic(odd_docs, labels).columns) == set(odd_docs.columns)
    none = tk.toxicity(odd_docs, labels.limit(0))
    assert none.filter((F.col("score") == 0) & (F.col("predicted") == 0)).count() == len(odd_rows())


def test_cosines_cover_every_word(spark):
    """More label words than 256, and long texts whose words no example holds: cosines are those of the whole texts."""
    rnd = random.Random(4)
    rude = [f"r{i}" for i in range(400)]
    data = [(i, " ".join([f"w{rnd.randrange(3000)}" for _ in range(30)] + ([rnd.choice(rude)] * 2 if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(700)]
    extra = [(5000 + i, " ".join([f"new{rnd.randrange(500)}" for _ in range(200)] + [rnd.choice(rude)])) for i in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    texts = dict([(i, t) for i, t, _ in data] + extra)
    train = [(i, y) for i, _, y in data if zlib.crc32(str(i).encode()) % 5]
    n, pos, df, near, toxic = len(train), sum(y for _, y in train), {}, {}, {}
    for i, y in train:
        for w in set(tk.words(texts[i])):
            df[w] = near[w] = near.get(w, 0) + 1
            toxic[w] = toxic.get(w, 0) + y

    def vector(t):
        tf = {w: tk.words(t).count(w) for w in set(tk.words(t))}
        phi = {w: abs(toxic[w] * n - near[w] * pos) / np.sqrt(max(near[w] * (n - near[w]) * pos * (n - pos), 1)) if w in near else 0 for w in tf}
        v = {w: (1 + np.log(c)) * (np.log((1 + n) / (1 + df.get(w, 0))) + 1) * (phi[w] + tk.FLOOR) for w, c in tf.items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: vector(t) for i, t in texts.items()}
    got = tk.toxicity(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        a = vectors[r.doc_id]
        best = sorted((sum(x * vectors[i].get(w, 0) for w, x in a.items()), y) for i, y in train)[:-26:-1]
        want = [c for c, y in best if c > 0 and y == r.predicted][:3]
        assert np.allclose(r.cosines, want, atol=2e-6), (r, want)
    assert all(r.cosines[0] < 0.99 for r in got if r.doc_id >= 5000 and r.cosines)
