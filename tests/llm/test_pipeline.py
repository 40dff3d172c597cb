"""The pipeline's stages against brute force on a small fixture."""
import re
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline as cp
from quarry.llm import piece_lattice, toxicity_knn
from tests.llm.conftest import odd_rows
from tests.llm.test_mixing import brute_targets, n_words
from tests.llm.test_simhash_trie import brute_components, brute_print
from tests.llm.test_toxicity_knn import corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    data = corpus(400)
    rows = [(1000 + i, t, "en", f"s{i % 5}" if i % 11 else None, len(t)) for i, t, _ in data]
    rows += [(3000 + i, rows[i][1] + (" more" if i % 2 else "  "), "en", "s1", 0) for i in range(60)] + [rows[7], rows[7]] + [r[:5] for r in odd_rows()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1000 + i, y) for i, _, y in data], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def test_stages(spark, tables):
    folder, rows = tables
    docs, clean, unique, far, mixed, coded = stages(spark, folder)
    for df in (clean, unique, far, mixed):
        assert df.dtypes == docs.dtypes
    scored = Counter()
    for r in toxicity_knn.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")).filter("predicted = 0").collect():
        scored[r.doc_id] += 1
    key = lambda df: Counter(tuple(r) for r in df.collect())
    got = key(clean)
    ids = Counter()
    for r, n in got.items():
        ids[r[0]] += n
    assert ids == scored and not got - key(docs) and 0 < sum(got.values()) < len(rows)
    rude = {1000 + i for i, t, y in corpus(400) if y}
    assert len(rude & set(ids)) <= 0.05 * len(rude) and len(set(ids) - rude) >= 0.98 * len({r[0] for r in rows} - rude - {r[0] for r in rows if 3000 <= (r[0] or 0) < 4000})

    groups = {}
    for r in got:
        k = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        groups[k] = min(groups.get(k, r), r, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
    after = key(unique)
    assert Counter((r[0], r[1] or "") for r in after) == Counter((r[0], r[1] or "") for r in groups.values()) and max(after.values()) == 1

    comp = brute_components([(r[0], brute_print(r[1])) for r in after])
    left = key(far)
    assert len(left) == len(set(comp.values())) and {r[0] for r in left} == {comp[brute_print(r[1])] for r in after}

    sizes, taken = Counter(), Counter()
    for r in left:
        sizes[r[3]] += n_words(r[1])
    mix = key(mixed)
    assert set(mix) <= set(left) and max(mix.values()) <= 3
    for r, n in mix.items():
        taken[r[3]] += n * n_words(r[1])
    target = brute_targets(sizes, [1, 2, 3])
    biggest = {s: max(n_words(r[1]) for r in left if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= biggest[s] / 2 + 1 for s in sizes)

    texts = Counter((r[0], r[1] or "") for r, n in mix.items() for _ in range(n))
    pieces = piece_lattice.Pieces.open(public_tokenizers.path("piece_bpe_32k.model"), 4)
    back = coded.collect()
    assert Counter((r.doc_id, pieces.decode(r.ids)) for r in back) == texts and all(r.round_trip for r in back)


def test_run_and_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    assert cp.run(spark, folder).count() == stages(spark, folder)[-1].count()
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
