"""SimHash near-dedup by a binary-trie self-join.

Fingerprints are 64-bit SimHashes of word shingles.  Distinct fingerprints form a binary trie; a traversal walks pairs
of its nodes together, adds a differing bit where the two branch apart, and drops a pair once it has more than
``max_bits``.  To spread the walk, the trie is laid out ``max_bits + 1`` times, each time with another block of bits on
top: two fingerprints within ``max_bits`` agree in at least one block, so each walk may start at the node pairs (p, p)
below its top block.  Sub-tries of more than ``max_group`` fingerprints are walked down ``STEP`` more levels in Spark,
as node pairs of their own, until each fits a task.

Tasks don't give out the pairs they find but a spanning forest of them, so a group of m near copies sends m - 1 links
at most.  Components of the links are found over distinct fingerprints.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, keep_rows, materialize, text_column, with_plain_names, with_row_key
from quarry.operators.components import star_components

STEP, FRONTIER, BUFFER = 6, 1 << 20, 1 << 17


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, as an unsigned number; 0 for no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both act on ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return df.withColumn("fp", prints(text_column(df, text)))


def trie_links(x: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, err: np.ndarray, depth: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walks node pairs.  ``x``: fingerprints, sorted within each group.  Group i is [lo, hi); where mid = hi it is one
    node walked with itself, else the nodes [lo, mid) and [mid, hi), which differ in ``err`` of their ``depth`` bits.
    Yields index pairs within ``max_bits``."""
    same = mid == hi
    a0, a1, b0, b1 = lo, mid, np.where(same, lo, mid), hi
    todo = [(d, a0[depth == d], a1[depth == d], b0[depth == d], b1[depth == d], err[depth == d]) for d in np.unique(depth)]
    ones_at: dict[int, np.ndarray] = {}
    while todo:
        d, a0, a1, b0, b1, e = todo.pop()
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = (np.bitwise_count(x[i] ^ x[j]) <= max_bits) & (i != j)
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, e = (v[~single] for v in (a0, a1, b0, b1, e))
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            todo += [(d, *(v[k:k + FRONTIER] for v in (a0, a1, b0, b1, e))) for k in range(0, len(a0), FRONTIER)]
            continue
        if d not in ones_at:
            ones_at[d] = np.concatenate(([0], np.cumsum((x >> np.uint64(63 - d)) & np.uint64(1), dtype=np.int64)))
        ones = ones_at[d]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        cross = a0 != b0
        spare = e < max_bits
        kids = [(a0, am, b0, bm, e, np.ones_like(cross)), (am, a1, bm, b1, e, np.ones_like(cross)), (a0, am, bm, b1, e + 1, spare), (am, a1, b0, bm, e + 1, spare & cross)]
        parts = [tuple(v[ok] for v in kid[:5]) for kid in kids for ok in [kid[5] & (kid[1] > kid[0]) & (kid[3] > kid[2])]]
        todo.append((d + 1, *(np.concatenate(v) for v in zip(*parts, strict=True))))


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Root of each of n items under the links."""
    root = np.arange(n)
    for i, j in links:
        while True:
            while (root[root] != root).any():
                root = root[root]
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    while (root[root] != root).any():
        root = root[root]
    return root


def _turn(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def _walk(max_bits: int, turns: list[int]):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(rows: pd.DataFrame) -> pd.DataFrame:
            key = rows[["turn", "depth", "a", "b"]].to_numpy()
            x = rows["x"].to_numpy().view(np.uint64)
            lo = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            hi = np.append(lo[1:], len(x))
            depth, a, b = key[lo, 1], key[lo, 2].view(np.uint64), key[lo, 3].view(np.uint64)
            group = np.repeat(np.arange(len(lo)), hi - lo)
            in_a = (x >> (64 - depth).astype(np.uint64)[group]) == a[group]
            mid = lo + np.bincount(group, weights=in_a, minlength=len(lo)).astype(np.int64)
            big = (hi - lo > 1) & (mid > lo)
            root = _forest(len(x), trie_links(x, lo[big], mid[big], hi[big], np.bitwise_count(a ^ b)[big].astype(np.int64), depth[big], max_bits))
            at = np.flatnonzero(root != np.arange(len(x)))
            back = np.array(turns, dtype=np.uint64)[key[at, 0]]
            plain = [np.where(back == 0, v, (v >> back) | (v << ((np.uint64(64) - back) % np.uint64(64)))).view(np.int64) for v in (x[at], x[root[at]])]
            return pd.DataFrame({"src": plain[0], "dst": plain[1]})

        kept: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            kept.append(batch)
            if sum(map(len, kept)) < BUFFER:
                continue
            rows = pd.concat(kept, ignore_index=True)
            key = rows[["turn", "depth", "a", "b"]].to_numpy()
            last = np.flatnonzero((key != key[-1]).any(axis=1))  # the last group may go on in the next batch
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found(rows.iloc[:cut])
            kept = [rows.iloc[cut:]]
        if kept:
            yield found(pd.concat(kept, ignore_index=True))

    return walk


def _refined(rows: DataFrame, max_bits: int) -> DataFrame:
    """The node pairs of each row's group, ``STEP`` levels further down, that are still within ``max_bits``."""
    masks = [sum(1 << i for i in c) for n in range(max_bits + 1) for c in combinations(range(STEP), n)]
    x, step = F.col("x"), F.lit(STEP)
    shift = F.col("depth") + step
    node = F.expr(f"shiftrightunsigned(x, 64 - depth - {STEP})")
    in_a = F.expr("shiftrightunsigned(x, 64 - depth)") == F.col("a")
    other = F.shiftleft(F.when(in_a, F.col("b")).otherwise(F.col("a")), STEP).bitwiseOR(node.bitwiseAND(F.lit((1 << STEP) - 1)))
    err = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    out = rows.select("turn", shift.alias("depth"), "x", node.alias("node"), other.alias("other"), in_a.alias("in_a"), (F.col("a") == F.col("b")).alias("same"),
                      err.alias("err"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    out = out.filter(F.col("err") + F.bit_count("mask") <= max_bits).withColumn("mate", F.col("other").bitwiseXOR(F.col("mask")))
    first = F.when(F.col("same"), F.col("node") < F.col("mate")).otherwise(F.col("in_a"))
    return out.select("turn", "depth", F.when(first, F.col("node")).otherwise(F.col("mate")).alias("a"), F.when(first, F.col("mate")).otherwise(F.col("node")).alias("b"), "x")


def near_links(prints: DataFrame, max_bits: int = 2, max_group: int = 2048) -> DataFrame:
    """``prints``: distinct ``fp``.  Links (src, dst) whose components are those of all pairs within ``max_bits``."""
    width = 64 // (max_bits + 1)
    turns = [width * i for i in range(max_bits + 1)]
    rows = None
    for i, t in enumerate(turns):
        top = width if i < max_bits else 64 - t
        x = _turn(F.col("fp"), t)
        one = prints.select(F.lit(i).cast("long").alias("turn"), F.lit(top).cast("long").alias("depth"), F.shiftrightunsigned(x, 64 - top).alias("a"), x.alias("x"))
        rows = one if rows is None else rows.unionByName(one)
    rows, key, ready, n = rows.withColumn("b", F.col("a")).select("turn", "depth", "a", "b", "x"), ["turn", "depth", "a", "b"], None, 0
    while True:
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        large = materialize(sizes.filter(F.col("n") > max_group).filter(f"depth + {STEP} < 64").select(*key), f"trie-large-{n}")
        if large.isEmpty():
            break
        n += 1
        rows = materialize(rows, f"trie-rows-{n}") if n == 1 else rows
        fits = rows.join(large, key, "left_anti")
        ready = fits if ready is None else ready.unionByName(fits)
        rows = materialize(_refined(rows.join(large, key, "left_semi"), max_bits), f"trie-refined-{n}")
    rows = rows if ready is None else ready.unionByName(rows)
    sorted_rows = rows.repartition(*key).sortWithinPartitions(*key, F.expr("x < 0"), "x")
    return materialize(sorted_rows.mapInPandas(_walk(max_bits, turns), "src long, dst long"), "trie-links")


def near_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2, max_group: int = 2048) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest doc_id reachable over links of fingerprints that
    differ in at most ``max_bits``), kept (one row of each component, that with the smallest doc_id) and the row's place.

    Null text counts as empty; texts without words have fingerprint zero and link like any other.  Null doc_ids come
    last; a component of null ids only has a null id.  Rows that repeat are rows of one component.  Other columns are
    not read.  Empty table: no rows."""
    keyed = with_row_key(df)
    docs = with_fingerprint(keyed, text, shingle).select(FILE, POS, F.col(doc_id).alias("doc_id"), "fp")
    docs = materialize(docs, "simhash-docs")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(FILE), F.col(POS))).alias("first")
    prints = materialize(docs.groupBy("fp").agg(first), "simhash-prints")
    labels = materialize(star_components(near_links(prints.select("fp"), max_bits, max_group)), "simhash-labels")
    prints = materialize(prints.join(labels.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "simhash-classes")
    comps = materialize(prints.groupBy("component").agg(F.min("first").alias("best")), "simhash-components")
    classes = materialize(prints.select("fp", "component").join(comps, "component").select("fp", "best"), "simhash-best")
    return docs.join(classes, "fp").select(
        "doc_id", "fp", F.col("best.doc_id").alias("component_id"),
        ((F.col(FILE) == F.col(f"best.{FILE}")) & (F.col(POS) == F.col(f"best.{POS}"))).alias("kept"), FILE, POS)


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    plain, i, t = with_plain_names(docs, doc_id, text)
    keyed = with_row_key(plain)
    return keep_rows(keyed, near_dedup(keyed.drop(FILE, POS), i, t, **options).filter(~F.col("kept"))).toDF(*docs.columns)
