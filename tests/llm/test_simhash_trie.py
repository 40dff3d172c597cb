import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash_trie as st
from tests.llm.conftest import odd_rows


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(items, max_bits=2):
    """items: (id, print).  Smallest id reachable, by print."""
    prints = sorted({p for _, p in items})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    low = {}
    for i, p in items:
        if i is not None:
            low[find(p)] = min(i, low.get(find(p), i))
    return {p: low.get(find(p)) for p in prints}


def test_fingerprint():
    for r in odd_rows():
        assert st.fingerprint(r[1]) == brute_print(r[1])
    for t in ["", "A", "İ Ünï A b", "a\x1cb c\x85d e f", "A B C D " * 50]:
        assert st.fingerprint(t) == brute_print(t)


def clustered(n=400, seed=1):
    rnd, out = random.Random(seed), {0, (1 << 64) - 1}
    for _ in range(n // 20):
        p = rnd.getrandbits(64)
        for _ in range(20):
            out.add(p)
            q = p
            for _ in range(rnd.randrange(4)):
                q ^= 1 << rnd.randrange(64)
            out.add(q)
            p = q if rnd.random() < 0.5 else p
    return sorted(out)


@pytest.mark.parametrize("max_bits,max_group", [(2, 2048), (2, 3), (1, 2), (0, 2), (3, 4)])
def test_links_give_the_components_of_all_near_pairs(spark, max_bits, max_group):
    rnd, prints = random.Random(4), clustered()
    base = rnd.getrandbits(64)
    prints = sorted({*prints, *(base ^ rnd.getrandbits(12) for _ in range(150))})  # one dense group
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = st.near_links(spark.createDataFrame(signed, "fp long"), max_bits, max_group).collect()
    mask = (1 << 64) - 1
    assert all(((r.src ^ r.dst) & mask).bit_count() > 0 for r in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in links:
        root[find(r.src & mask)] = find(r.dst & mask)
    want = brute_components([(i, p) for i, p in enumerate(prints)], max_bits)
    low = {}
    for i, p in enumerate(prints):
        low[find(p)] = min(i, low.get(find(p), i))
    assert {p: low[find(p)] for p in prints} == want


def test_walk_finds_all_pairs_of_one_trie():
    rnd = random.Random(7)
    x = np.array(sorted({rnd.getrandbits(64) & ~(((1 << 40) - 1) << 10) for _ in range(300)}), dtype=np.uint64)
    n = len(x)
    got = set()
    for i, j in st.trie_links(x, np.array([0]), np.array([n]), np.array([n]), np.array([0]), np.array([0]), 3):
        got |= {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if int(x[i] ^ x[j]).bit_count() <= 3}


def test_documents(spark, odd_docs, no_docs):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = st.near_dedup(odd_docs).collect()
    prints = [(i, brute_print(t)) for i, t in rows]
    comp = brute_components(prints)
    assert sorted(repr((r.doc_id, r.fp & ((1 << 64) - 1), r.component_id)) for r in got) == sorted(repr((i, p, comp[p])) for i, p in prints)
    out = st.drop_near_copies(odd_docs)
    assert out.count() == len({comp[p] for _, p in prints}) == sum(r.kept for r in got) and "__src_file" not in out.columns
    clash = st.drop_near_copies(odd_docs)
    assert clash.columns == odd_docs.columns and {r["__src_pos"] for r in clash.collect()} == {"clash"}
    assert st.near_dedup(no_docs).count() == 0 and st.drop_near_copies(no_docs).count() == 0


def test_large_group_of_near_copies(spark):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(5000)}" for _ in range(400)]
    rows = [(i, " ".join(words[:rnd.randrange(398, 401)] + [f"t{i % 7}"])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    comp = brute_components([(i, brute_print(t)) for i, t in rows])
    got = st.near_dedup(df, max_group=4).select("doc_id", "component_id", F.col("fp")).collect()
    assert all(r.component_id == comp[r.fp & ((1 << 64) - 1)] for r in got)
