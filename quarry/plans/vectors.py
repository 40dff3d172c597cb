"""§2.9 word-vector queries over FIX-12 (embeddings as word vectors), and document vectors."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.arrays import l2_normalize, norm
from quarry.functions.text import long_lower_tokens
from quarry.operators import textmine as tm
from quarry.operators import vectors as vq
from quarry.plans import fixtures as fx
from quarry.plans.registry import register
from quarry.sources.tables import table

TOPN = 3
#: Questions are asked of the most frequent words (the reference's default); the oracle has the same bound.
RESTRICT_VOCAB = 30000
V = fx.with_sql(
    v=fx.WORD_VECTORS_SQL,
    u="SELECT word, vec_id, count, label, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS u FROM v",
    qd="SELECT a.vec_id // 4 AS qid, a.word AS a, b.word AS b, c.word AS c, e.word AS expected, a.label AS section "
       "FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 JOIN v c ON c.vec_id = a.vec_id + 2 JOIN v e ON e.vec_id = a.vec_id + 3 "
       "WHERE a.vec_id % 4 = 0")


def wv(spark, d):
    return fx.word_vectors_table(spark, d)


def quads(spark, d):
    v = wv(spark, d).select("vec_id", "word", "label")
    a = v.filter(F.col("vec_id") % 4 == 0)
    j = a.alias("a")
    for off, name in ((1, "b"), (2, "c"), (3, "e")):
        j = j.join(v.alias(name), F.col(f"{name}.vec_id") == F.col("a.vec_id") + off)
    return j.select((F.col("a.vec_id") / 4).cast("long").alias("qid"), F.col("a.word").alias("a"),
                    F.col("b.word").alias("b"), F.col("c.word").alias("c"), F.col("e.word").alias("expected"),
                    F.col("a.label").alias("section"))


def analogy_terms(q):
    return (q.select("qid", F.col("b").alias("word"), F.lit(1.0).alias("weight"))
            .unionByName(q.select("qid", F.col("c").alias("word"), F.lit(1.0).alias("weight")))
            .unionByName(q.select("qid", F.col("a").alias("word"), F.lit(-1.0).alias("weight"))))


@register("normalize_vectors", "2.9", V + " SELECT word, CAST(generate_subscripts(u, 1) - 1 AS INTEGER) AS pos, unnest(u) AS value FROM u")
def q_normalize_vectors(spark, d):
    n = vq.normalize_vectors(wv(spark, d))
    return n.select("word", F.posexplode("vec").alias("pos", "value"))


@register("vector_similarity", "2.9", V +
          " SELECT a.word AS w1, b.word AS w2, list_dot_product(a.u, b.u) AS similarity FROM u a JOIN u b ON b.vec_id = a.vec_id + 1")
def q_vector_similarity(spark, d):
    v = wv(spark, d)
    pairs = (v.alias("a").join(v.alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1)
             .select(F.col("a.word").alias("w1"), F.col("b.word").alias("w2")))
    return vq.vector_similarity(v, pairs)


@register("set_similarity", "2.9", V + (
    ", m AS (SELECT qid, list_transform(va.vec, lambda x, i: (x + vb.vec[i]) / 2) AS m1, "
    "list_transform(vc.vec, lambda x, i: (x + ve.vec[i]) / 2) AS m2 FROM qd JOIN v va ON va.word = qd.a "
    "JOIN v vb ON vb.word = qd.b JOIN v vc ON vc.word = qd.c JOIN v ve ON ve.word = qd.expected) "
    "SELECT qid AS set_id, list_dot_product(m1, m2) / (sqrt(list_dot_product(m1, m1)) * sqrt(list_dot_product(m2, m2))) "
    "AS similarity FROM m"))
def q_set_similarity(spark, d):
    q = quads(spark, d)
    sets = (q.select(F.col("qid").alias("set_id"), F.lit(1).alias("side"), F.col("a").alias("word"))
            .union(q.select("qid", F.lit(1), "b")).union(q.select("qid", F.lit(2), "c"))
            .union(q.select("qid", F.lit(2), "expected")))
    return vq.set_similarity(wv(spark, d), sets)


NN_Q = (", q0 AS (SELECT qid, a, b, c, list_transform(ub.u, lambda x, i: (x + uc.u[i] - ua.u[i]) / 3) AS q FROM qd "
        "JOIN u ua ON ua.word = qd.a JOIN u ub ON ub.word = qd.b JOIN u uc ON uc.word = qd.c), "
        "q AS (SELECT qid, a, b, c, list_transform(q, lambda x: x / sqrt(list_dot_product(q, q))) AS q FROM q0)")


@register("nearest_neighbors", "2.9", V + NN_Q + (
    f" SELECT qid, word, score, rank FROM (SELECT q.qid, u.word, list_dot_product(q.q, u.u) AS score, "
    "row_number() OVER (PARTITION BY q.qid ORDER BY list_dot_product(q.q, u.u) DESC, u.word) AS rank "
    f"FROM q, u WHERE u.word NOT IN (q.a, q.b, q.c)) WHERE rank <= {TOPN}"))
def q_nearest_neighbors(spark, d):
    return vq.nearest_neighbors(wv(spark, d), analogy_terms(quads(spark, d)), TOPN)


@register("nearest_neighbors_cosmul", "2.9", V + (
    ", s AS (SELECT qd.qid, u.word, ((1 + list_dot_product(ub.u, u.u)) / 2) * ((1 + list_dot_product(uc.u, u.u)) / 2) "
    "/ ((1 + list_dot_product(ua.u, u.u)) / 2 + 1e-6) AS score FROM qd JOIN u ua ON ua.word = qd.a JOIN u ub ON ub.word = qd.b "
    "JOIN u uc ON uc.word = qd.c, u WHERE u.word NOT IN (qd.a, qd.b, qd.c)) "
    f"SELECT qid, word, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, word) AS rank "
    f"FROM s) WHERE rank <= {TOPN}"))
def q_nearest_neighbors_cosmul(spark, d):
    return vq.nearest_neighbors_cosmul(wv(spark, d), analogy_terms(quads(spark, d)), TOPN)


@register("odd_one_out", "2.9", V + (
    ", mem AS (SELECT qid, unnest([a, b, c, expected]) AS word FROM qd), "
    "mu AS (SELECT mem.qid, mem.word, u.u FROM mem JOIN u ON mem.word = u.word), "
    "uv AS (SELECT qid, word, unnest(u) AS x, generate_subscripts(u, 1) AS pos FROM mu), "
    "mv AS (SELECT qid, list(s ORDER BY pos) AS m FROM (SELECT qid, pos, avg(x) AS s FROM uv GROUP BY qid, pos) GROUP BY qid) "
    "SELECT mu.qid AS set_id, arg_min(mu.word, (list_dot_product(mu.u, mv.m) / sqrt(list_dot_product(mv.m, mv.m)), mu.word)) AS word "
    "FROM mu JOIN mv ON mu.qid = mv.qid GROUP BY mu.qid"))
def q_odd_one_out(spark, d):
    q = quads(spark, d)
    sets = q.select(F.col("qid").alias("set_id"), F.explode(F.array("a", "b", "c", "expected")).alias("word"))
    return vq.odd_one_out(wv(spark, d), sets)


@register("analogy_accuracy", "2.9", V + NN_Q + (
    f", ok AS (SELECT word FROM v ORDER BY count DESC, word LIMIT {RESTRICT_VOCAB}), "
    "best AS (SELECT qid, arg_max(u.word, (list_dot_product(q.q, u.u), -rank_w)) AS predicted FROM q, "
    "(SELECT *, row_number() OVER (ORDER BY word DESC) AS rank_w FROM u WHERE word IN (SELECT word FROM ok)) u WHERE u.word NOT IN (q.a, q.b, q.c) GROUP BY qid), "
    "r AS (SELECT CAST(qd.section AS VARCHAR) AS section, CASE WHEN best.predicted = qd.expected THEN 1 ELSE 0 END AS ok "
    "FROM qd LEFT JOIN best ON qd.qid = best.qid WHERE qd.a IN (SELECT word FROM ok) AND qd.b IN (SELECT word FROM ok) AND qd.c IN (SELECT word FROM ok) "
    "AND qd.expected IN (SELECT word FROM ok)), "
    "per AS (SELECT section, CAST(sum(ok) AS BIGINT) AS correct, CAST(sum(1 - ok) AS BIGINT) AS incorrect FROM r GROUP BY section) "
    "SELECT * FROM per UNION ALL SELECT 'total', CAST(sum(correct) AS BIGINT), CAST(sum(incorrect) AS BIGINT) FROM per"))
def q_analogy_accuracy(spark, d):
    q = quads(spark, d).withColumn("section", F.col("section").cast("string"))
    return vq.analogy_accuracy(wv(spark, d), q, restrict_vocab=RESTRICT_VOCAB)


@register("vector_lookup", "2.9", V + (
    " SELECT 'w' || CAST(e.vec_id * 3 AS VARCHAR) AS word, u.word IS NOT NULL AS found, "
    "sqrt(list_dot_product(v.vec, v.vec)) AS norm FROM embeddings e LEFT JOIN u ON u.word = 'w' || CAST(e.vec_id * 3 AS VARCHAR) "
    "LEFT JOIN v ON v.word = u.word"))
def q_vector_lookup(spark, d):
    words = table(spark, d, "embeddings").select(F.concat(F.lit("w"), (F.col("vec_id") * 3).cast("string")).alias("word"))
    r = vq.vector_lookup(wv(spark, d), words)
    return r.select("word", "found", norm("vec").alias("norm"))


# ------------------------------------------------------------------ document vectors over a fixed vector table

def token_vectors(spark, d):
    """The fixed vector table for document words: the word of vocabulary rank r (count desc, word)
    takes the embedding with vec_id = r mod (number of embeddings).  Returns the tokens, the vector that each word takes
    (word, vec_id), and the vectors under their ids as words, so that a vector isn't written once for each of its words."""
    from quarry.plans.text import labelled_tokens
    toks = tm.doc_tokens(labelled_tokens(spark, d))
    voc = tm.vocabulary(toks, 1)
    emb = fx.word_vectors_table(spark, d).select(F.col("vec_id").alias("word"), "vec")
    n = emb.count()
    return toks, voc.select("word", (F.col("idx") % n).alias("vec_id")), emb


def _by_vector(counted, takes):
    """``counted(doc_id, word, w)`` with the vector's id in place of the word."""
    return counted.join(takes, "word").select("doc_id", F.col("vec_id").alias("word"), "w")


@register("document_vectors", "2.9", (
    "WITH ld AS (" + fx.LABELLED_DOCS_SQL + "), lt AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, "
    "'[ \\t\\n\\x0B\\f\\r]+'), lambda t: length(t) >= 3), lambda t: lower(t)) AS tokens FROM ld), "
    "t AS (SELECT doc_id, unnest(tokens) AS word FROM lt), "
    "vo AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS idx FROM t GROUP BY word), "
    "tv AS (SELECT vo.word, CAST(e.embedding AS DOUBLE[]) AS vec FROM vo JOIN embeddings e "
    "ON e.vec_id = vo.idx % (SELECT count(*) FROM embeddings)), "
    "x AS (SELECT t.doc_id, unnest(tv.vec) AS x, generate_subscripts(tv.vec, 1) - 1 AS pos FROM t JOIN tv ON t.word = tv.word) "
    "SELECT doc_id, CAST(pos AS INTEGER) AS pos, avg(x) AS value FROM x GROUP BY doc_id, pos"))
def q_document_vectors(spark, d):
    toks, takes, emb = token_vectors(spark, d)
    counted = toks.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("w"))
    dv = vq.mean_word_vectors(_by_vector(counted, takes), emb, weight="w")
    return dv.select("doc_id", F.posexplode("vec").alias("pos", "value"))


@register("document_vectors_tfidf", "2.9")
def q_document_vectors_tfidf(spark, d):
    toks, takes, emb = token_vectors(spark, d)
    dv = vq.mean_word_vectors(_by_vector(vq.tfidf_weights(toks), takes), emb, weight="w")     # a row for each word of a document
    return dv.select("doc_id", F.posexplode("vec").alias("pos", "value"))


@register("gaussian_nb", "2.9")
def q_gaussian_nb(spark, d):
    from pyspark.ml.functions import array_to_vector
    from quarry.plans.text import labelled_tokens
    toks, takes, emb = token_vectors(spark, d)
    counted = toks.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("w"))
    dv = vq.mean_word_vectors(_by_vector(counted, takes), emb, weight="w")
    lab = labelled_tokens(spark, d).select("doc_id", F.col("label").cast("double").alias("label"), "split")
    data = dv.join(lab, "doc_id").select("doc_id", "label", "split", array_to_vector("vec").alias("features")).cache()
    model = tm.fit_gaussian_nb(data.filter(F.col("split") == "train"))
    p = model.transform(data.filter(F.col("split") == "test"))
    return p.select("doc_id", F.col("label").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"))


del l2_normalize, long_lower_tokens
