"""Word-vector queries over a ``vectors(word, vec array<double>, count)`` table.

Searches over the vocabulary (nearest neighbours, 3CosMul, analogies) are exact blocked products:
query blocks are cogrouped with vocabulary blocks (each side replicated once per block of the other
side, never per row), numpy scores a block pair and keeps its top-k, and a bounded window merges the
per-block top-k lists.  No (query, word) pair table is materialised.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import cosine, dot, l2_normalize, norm, vector_mean, vector_sum
from quarry.operators.blocks import CELLS, SIDES, all_met, block_grid, block_id, block_pairs, every_block
from quarry.session import Scratch


def normalize_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("vec", l2_normalize("vec"))


def vector_lookup(vectors: DataFrame, words: DataFrame) -> DataFrame:
    """For each query word: found flag and the vector (null when unknown)."""
    return words.select("word").join(vectors.select("word", "vec"), "word", "left").select(
        "word", F.col("vec").isNotNull().alias("found"), "vec")


def vector_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cosine for a table of (w1, w2) pairs (both words must be known)."""
    v = vectors.select("word", "vec")
    return (pairs.join(v.select(F.col("word").alias("w1"), F.col("vec").alias("v1")), "w1")
            .join(v.select(F.col("word").alias("w2"), F.col("vec").alias("v2")), "w2")
            .select("w1", "w2", cosine("v1", "v2").alias("similarity")))


def set_similarity(vectors: DataFrame, sets: DataFrame) -> DataFrame:
    """``sets(set_id, side, word)`` with side 1 / 2: cosine of the mean raw vectors of the two sides."""
    means = (sets.join(vectors.select("word", "vec"), "word").groupBy("set_id", "side")
             .agg(vector_mean("vec").alias("m")))
    a = means.filter(F.col("side") == 1).select("set_id", F.col("m").alias("m1"))
    b = means.filter(F.col("side") == 2).select("set_id", F.col("m").alias("m2"))
    return a.join(b, "set_id").select("set_id", cosine("m1", "m2").alias("similarity"))


def odd_one_out(vectors: DataFrame, sets: DataFrame) -> DataFrame:
    """``sets(set_id, word)``: the word with the lowest dot with the unit mean of the set's unit vectors
    (unknown words skipped; ties to the smaller word)."""
    u = vectors.select("word", l2_normalize("vec").alias("u"))
    j = sets.join(u, "word")
    m = j.groupBy("set_id").agg(vector_mean("u").alias("m")).select("set_id", l2_normalize("m").alias("m"))
    s = j.join(m, "set_id").select("set_id", "word", dot("u", "m").alias("score"))
    return s.groupBy("set_id").agg(F.min_by("word", F.struct("score", "word")).alias("word"))


def query_vectors(vectors: DataFrame, terms: DataFrame) -> DataFrame:
    """``terms(qid, word, weight)`` → ``(qid, q)``: unit mean of weight × unit vectors."""
    u = vectors.select("word", l2_normalize("vec").alias("u"))
    j = terms.join(u, "word").select("qid", F.transform("u", lambda x: x * F.col("weight")).alias("wu"))
    return j.groupBy("qid").agg(vector_mean("wu").alias("q")).select("qid", l2_normalize("q").alias("q"))


def _blocked_topk(queries: DataFrame, items: DataFrame, k: int, mode: str, q_block: int | None = None,
                  i_block: int | None = None) -> DataFrame:
    """queries(qid, pos array<array<double>>, neg array<array<double>>, q array<double>, excl array<string>);
    items(word, u array<double>).  Returns ``(qid, word, score, rank)`` for the top k per query."""
    n_items = items.count()
    qb, ib = block_grid(queries.sparkSession, queries.count(), n_items, q_block, i_block, SIDES)
    qrows = queries.withColumns({"qblk": block_id(F.xxhash64("qid"), qb), "iblk": every_block(ib)})
    irows = items.withColumns({"iblk": block_id(F.xxhash64("word"), ib), "qblk": every_block(qb)})

    def score(key, qp: pd.DataFrame, ip: pd.DataFrame) -> pd.DataFrame:
        if qp.empty or ip.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "met": pd.Series([], dtype="int64"), "top": pd.Series([], dtype="object")})
        ip = ip.sort_values("word", kind="stable")
        words = ip["word"].to_numpy()
        U = np.stack(ip["u"].to_numpy()).astype(np.float64)
        index, kk, top, strip = pd.Index(words), min(k, len(words)), [], max(1, CELLS // len(words))
        for lo in range(0, len(qp), strip):
            part = qp.iloc[lo:lo + strip]
            if mode == "cosine":
                S = np.stack(part["q"].to_numpy()).astype(np.float64) @ U.T
            else:
                S = _term_products(part["pos"], U) / (_term_products(part["neg"], U) + 1e-6)
            for r, excl in enumerate(part["excl"]):
                c = index.get_indexer(np.asarray([] if excl is None else excl, dtype=object))
                S[r, c[c >= 0]] = -np.inf
            kept = np.partition(S, len(words) - kk, axis=1)[:, len(words) - kk]      # ties with the last stay in
            rows, cols = np.nonzero((S >= kept[:, None]) & np.isfinite(S))
            order = np.lexsort((cols, -S[rows, cols], rows))                         # words ascend: ties to the smaller
            rows, cols = rows[order], cols[order]
            first = np.searchsorted(rows, np.arange(len(part) + 1))
            top += [[(words[c], S[r, c]) for c in cols[first[r]:min(first[r] + kk, first[r + 1])]] for r in range(len(part))]
        return pd.DataFrame({"qid": qp["qid"].to_numpy(), "met": np.full(len(qp), len(words), dtype=np.int64), "top": top})

    res = block_pairs(qrows, irows, ["qblk", "iblk"], score, "qid long, met long, top array<struct<word:string,score:double>>")
    met = res.groupBy("qid").agg(all_met(F.sum("met"), n_items).alias("met"), F.flatten(F.collect_list("top")).alias("top"))   # k rows a block
    best = F.slice(F.sort_array(F.transform("top", lambda t: F.struct((-t["score"]).alias("neg"), t["word"].alias("word")))), 1, k)
    return (met.filter(F.col("met") > 0).select("qid", F.posexplode(best).alias("rank", "t"))
            .select("qid", "t.word", (-F.col("t.neg")).alias("score"), (F.col("rank") + 1).cast("long").alias("rank")))


def _term_products(terms: pd.Series, U: np.ndarray) -> np.ndarray:
    """Per query (a list of vectors) and item: the product of (1 + cosine) / 2 over the query's vectors; 1 without any."""
    n = np.array([0 if t is None else len(t) for t in terms])
    out = np.ones((len(n), len(U)))
    have = np.flatnonzero(n)
    if len(have):
        P = np.stack([v for t in terms if t is not None for v in t]).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(n[have])[:-1]])
        out[have] = np.multiply.reduceat((1 + P @ U.T) / 2, starts, axis=0)
    return out


def nearest_neighbors(vectors: DataFrame, terms: DataFrame, topn: int = 10) -> DataFrame:
    """Batch ``most_similar``: ``terms(qid, word, weight ±1)``; top-n words by cosine to the unit mean of
    the weighted unit vectors, the query's own words excluded."""
    q = query_vectors(vectors, terms)
    excl = terms.groupBy("qid").agg(F.collect_set("word").alias("excl"))
    queries = q.join(excl, "qid").select("qid", "q", "excl", F.array().cast("array<array<double>>").alias("pos"),
                                         F.array().cast("array<array<double>>").alias("neg"))
    items = vectors.select("word", l2_normalize("vec").alias("u"))
    return _blocked_topk(queries, items, topn, "cosine")


def nearest_neighbors_cosmul(vectors: DataFrame, terms: DataFrame, topn: int = 10) -> DataFrame:
    """Batch ``most_similar_cosmul``: prod((1+cos+)/2) / (prod((1+cos-)/2) + 1e-6)."""
    u = vectors.select("word", l2_normalize("vec").alias("u"))
    j = terms.join(u, "word")
    queries = j.groupBy("qid").agg(
        F.collect_list(F.when(F.col("weight") > 0, F.col("u"))).alias("pos"),
        F.collect_list(F.when(F.col("weight") < 0, F.col("u"))).alias("neg"),
        F.collect_set("word").alias("excl")).withColumn("q", F.array().cast("array<double>"))
    return _blocked_topk(queries, u, topn, "cosmul")


def analogy_accuracy(vectors: DataFrame, questions: DataFrame, restrict_vocab: int | None = None) -> DataFrame:
    """``questions(section, qid, a, b, c, expected)`` (lower-cased).  A question is skipped when a word
    is outside the vocabulary (with ``restrict_vocab``, its most frequent words); the answer is the best word of that
    vocabulary by 3CosAdd (b + c - a), a, b, c excluded.  Per section correct / incorrect, plus 'total'."""
    ok = vectors if restrict_vocab is None else vectors.orderBy(F.col("count").desc(), F.col("word")).limit(restrict_vocab)
    q = questions.select("section", "qid", *[F.lower(c).alias(c) for c in ("a", "b", "c", "expected")])
    okw = ok.select("word")
    for c in ("a", "b", "c", "expected"):
        q = q.join(okw.withColumnRenamed("word", c), c, "left_semi")
    terms = (q.select("qid", F.col("b").alias("word"), F.lit(1.0).alias("weight"))
             .unionByName(q.select("qid", F.col("c").alias("word"), F.lit(1.0).alias("weight")))
             .unionByName(q.select("qid", F.col("a").alias("word"), F.lit(-1.0).alias("weight"))))
    best = nearest_neighbors(ok, terms, 1).select("qid", F.col("word").alias("predicted"))
    res = q.join(best, "qid", "left").withColumn("correct", F.col("predicted").eqNullSafe(F.col("expected")).cast("int"))   # no answer: incorrect
    per = res.groupBy("section").agg(F.sum("correct").cast("long").alias("correct"),
                                     F.sum(1 - F.col("correct")).cast("long").alias("incorrect"))
    tot = per.agg(F.lit("total").alias("section"), F.sum("correct").cast("long").alias("correct"),
                  F.sum("incorrect").cast("long").alias("incorrect"))
    return per.unionByName(tot)


#: Rows of a (document block, word block) pair and words of a block, about.
PAIRS, WORD_BLOCK = 1 << 20, 1 << 16


def mean_word_vectors(tokens: DataFrame, vectors: DataFrame, doc: str = "doc_id", weight: str | None = None,
                      pairs: int | None = None, word_block: int | None = None) -> DataFrame:
    """Document vector = (weighted) mean of its tokens' vectors; tokens without a vector are ignored.

    A word's vector never travels with each document that holds the word: weights of (document, word) meet a block of vectors
    and leave a sum for each document of the block, and the sums of a document's blocks are added up by Spark."""
    scratch = Scratch(tokens.sparkSession, "word-vectors")
    w = F.sum(weight) if weight else F.count(F.lit(1))
    counts = scratch.write(tokens.filter(F.col(doc).isNotNull() & F.col("word").isNotNull()).groupBy(F.col(doc).alias("doc"), "word").agg(w.cast("double").alias("n")), "counts")
    table = scratch.write(vectors.select("word", "vec").filter("word IS NOT NULL AND vec IS NOT NULL"), "vectors")
    wb = max(1, -(-table.count() // (word_block or WORD_BLOCK)))
    db = max(1, -(-counts.count() // (wb * (pairs or PAIRS))))
    left = counts.withColumns({"dblk": block_id(F.xxhash64("doc"), db), "wblk": block_id(F.xxhash64("word"), wb)})
    right = table.withColumns({"wblk": block_id(F.xxhash64("word"), wb), "dblk": every_block(db)})
    kind = counts.schema["doc"].dataType.simpleString()

    def add(key, cp: pd.DataFrame, vp: pd.DataFrame) -> pd.DataFrame:
        if cp.empty or vp.empty:
            return pd.DataFrame({"doc": cp["doc"].iloc[:0], "s": pd.Series([], dtype="object"), "w": pd.Series([], dtype="float64")})
        at, words = pd.factorize(vp["word"])                                      # a word may come with several vectors
        times, given = np.bincount(at), np.stack(vp["vec"].to_numpy()).astype(np.float64)
        V = np.zeros((len(words), given.shape[1]))
        np.add.at(V, at, given)
        cp = cp.assign(at=pd.Index(words).get_indexer(cp["word"])).query("at >= 0").sort_values("doc", kind="stable")
        who, docs = pd.factorize(cp["doc"])
        at, n = cp["at"].to_numpy(), cp["n"].to_numpy(dtype=np.float64)
        sums, strip = np.zeros((len(docs), V.shape[1])), max(1, CELLS // V.shape[1])
        for lo in range(0, len(at), strip):
            part = who[lo:lo + strip]
            first = np.flatnonzero(np.diff(part, prepend=-1))
            sums[part[first]] += np.add.reduceat(V[at[lo:lo + strip]] * n[lo:lo + strip, None], first, axis=0)
        return pd.DataFrame({"doc": docs, "s": list(sums), "w": np.bincount(who, weights=n * times[at], minlength=len(docs))})

    parts = block_pairs(left, right, ["dblk", "wblk"], add, f"doc {kind}, s array<double>, w double")
    total = parts.groupBy("doc").agg(vector_sum("s").alias("s"), F.sum("w").alias("w"))
    out = scratch.write(total.select(F.col("doc").alias(doc), F.transform("s", lambda x: x / F.col("w")).alias("vec")), "result")
    scratch.finish("result")
    return out


def tfidf_weights(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``(doc, word, w)`` with w = tf * log((N + 1) / (df + 1))."""
    n = tokens.select(doc).distinct().agg(F.count(F.lit(1)).alias("__n"))
    tf = tokens.groupBy(doc, "word").agg(F.count(F.lit(1)).alias("tf"))
    df_ = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return (tf.join(df_, "word").crossJoin(F.broadcast(n))
            .select(doc, "word", (F.col("tf") * F.log((F.col("__n") + 1) / (F.col("df") + 1))).alias("w")))


def vector_norms(vectors: DataFrame) -> DataFrame:
    return vectors.select("word", norm("vec").alias("norm"))

