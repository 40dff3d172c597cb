"""§2.9 text features / vocabulary / classifiers and the text readers of §2.1 over `documents` and
`labels` (FIX-10, FIX-11)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import uniform01_sql
from quarry.functions.text import STOP_WORDS, long_lower_tokens, split_nonword, split_whitespace
from quarry.operators import relational as rel
from quarry.operators import textmine as tm
from quarry.plans import fixtures as fx
from quarry.plans.registry import register
from quarry.sources.tables import table

WS = "[ \\t\\n\\x0B\\f\\r]+"
NW = "[^\\p{L}\\p{N}_]+"
MIN_COUNT = 5
SAMPLE = 1e-3
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


# ------------------------------------------------------------------ corpora

def corpus(spark, d):
    """All documents as lower-cased whitespace tokens."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.transform(split_whitespace("text"), lambda t: F.lower(t)).alias("tokens"))


CORPUS_SQL = (f"SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, '{WS}'), lambda t: t <> ''), "
              "lambda t: lower(t)) AS tokens FROM documents")
CT_SQL = "SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS word FROM co"
VOCAB_SQL = (f"SELECT word, count, row_number() OVER (ORDER BY count DESC, word) - 1 AS idx FROM "
             f"(SELECT word, count(*) AS count FROM ct GROUP BY word HAVING count(*) >= {MIN_COUNT})")
BASE = fx.with_sql(co=CORPUS_SQL, ct=CT_SQL, vo=VOCAB_SQL)


def corpus_tokens(spark, d):
    return tm.doc_tokens(corpus(spark, d))


def vocab(spark, d):
    return tm.vocabulary(corpus_tokens(spark, d), MIN_COUNT)


def labelled_tokens(spark, d):
    docs = fx.labelled_docs(spark, d).select("doc_id", "label", "split", long_lower_tokens("text").alias("tokens"))
    return docs.filter(F.size("tokens") > 0)


LT_SQL = ("SELECT doc_id, label, split, list_transform(list_filter(regexp_split_to_array(text, '" + WS + "'), "
          "lambda t: length(t) >= 3), lambda t: lower(t)) AS tokens FROM ld")
LBASE = fx.with_sql(ld=fx.LABELLED_DOCS_SQL, lt0=LT_SQL, lt="SELECT * FROM lt0 WHERE len(tokens) > 0")


# ------------------------------------------------------------------ counts and vocabulary

@register("word_counts", "2.4", BASE + " SELECT word, count(*) AS count FROM ct GROUP BY word")
def q_word_counts(spark, d):
    from quarry.operators.aggregate import word_counts
    return word_counts(corpus_tokens(spark, d))


@register("vocabulary", "2.9", BASE + " SELECT word, count, idx FROM vo")
def q_vocabulary(spark, d):
    return vocab(spark, d)


@register("subsample_probability", "2.9", BASE +
          f" SELECT word, count, least(1.0, (sqrt(count / (t * {SAMPLE})) + 1) * (t * {SAMPLE}) / count) AS keep_prob "
          "FROM vo, (SELECT sum(count) AS t FROM vo)")
def q_subsample_probability(spark, d):
    return tm.subsample_probability(vocab(spark, d), SAMPLE)


@register("subsample_tokens", "2.9", BASE + (
    f", sp AS (SELECT word, least(1.0, (sqrt(count / (t * {SAMPLE})) + 1) * (t * {SAMPLE}) / count) AS keep_prob "
    "FROM vo, (SELECT sum(count) AS t FROM vo)) "
    f"SELECT ct.doc_id, count(*) AS n_kept FROM ct JOIN sp ON ct.word = sp.word "
    f"WHERE {uniform01_sql('ct.doc_id', 'ct.pos', seed=1)} <= sp.keep_prob GROUP BY ct.doc_id"))
def q_subsample_tokens(spark, d):
    kept = tm.subsample_tokens(corpus_tokens(spark, d), tm.subsample_probability(vocab(spark, d), SAMPLE), seed=1)
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_kept"))


@register("noise_distribution", "2.9", BASE + (
    " SELECT word, idx, p AS prob, sum(p) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative "
    "FROM (SELECT word, idx, pow(count, 0.75) / sum(pow(count, 0.75)) OVER () AS p FROM vo)"))
def q_noise_distribution(spark, d):
    return tm.noise_distribution(vocab(spark, d))


@register("semi_join_vocabulary", "2.3", BASE +
          " SELECT doc_id, count(*) AS n_in_vocab FROM ct WHERE word IN (SELECT word FROM vo) GROUP BY doc_id")
def q_semi_join_vocabulary(spark, d):
    kept = rel.semi_join_vocabulary(corpus_tokens(spark, d), vocab(spark, d))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_in_vocab"))


# ------------------------------------------------------------------ line / chunk readers

LINES_SQL = ("SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_in_doc, unnest(ls) AS line "
             "FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)")
LS_SQL = (f"SELECT row_number() OVER (ORDER BY doc_id, line_in_doc) - 1 AS line_no, doc_id, "
          f"list_filter(regexp_split_to_array(line, '{WS}'), lambda t: t <> '') AS tokens FROM li")


def line_sentences(spark, d, labelled=False):
    return tm.line_sentences(table(spark, d, "documents").select("doc_id", "text"), labelled=labelled)


@register("read_line_sentences", "2.1", fx.with_sql(li=LINES_SQL, ls=LS_SQL) +
          " SELECT line_no, doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, tokens[1] AS first_token FROM ls")
def q_read_line_sentences(spark, d):
    s = line_sentences(spark, d)
    return s.select("line_no", "doc_id", F.size("tokens").alias("n_tokens"), F.get("tokens", 0).alias("first_token"))


@register("labeled_vocab_counts", "2.4", fx.with_sql(li=LINES_SQL, ls=LS_SQL) + (
    " SELECT item, CAST(sum(w) AS BIGINT) AS count FROM (SELECT unnest(tokens) AS item, 1 AS w FROM ls "
    "UNION ALL SELECT 'SENT_' || CAST(line_no AS VARCHAR), len(tokens) FROM ls) GROUP BY item"))
def q_labeled_vocab_counts(spark, d):
    return tm.labeled_vocab_counts(line_sentences(spark, d, labelled=True))


@register("read_token_chunks", "2.1", (
    f"WITH t AS (SELECT doc_id, CAST(generate_subscripts(w, 1) AS BIGINT) AS pos, unnest(w) AS word FROM "
    f"(SELECT doc_id, list_filter(regexp_split_to_array(text, '{WS}'), lambda t: t <> '') AS w FROM documents)), "
    "g AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos, word FROM t) "
    "SELECT CAST(floor(gpos / 1000) AS BIGINT) AS chunk, CAST(count(*) AS INTEGER) AS n_tokens, arg_min(word, gpos) AS first_token, "
    "arg_max(word, gpos) AS last_token FROM g GROUP BY 1"))
def q_read_token_chunks(spark, d):
    c = tm.token_chunks(table(spark, d, "documents").select("doc_id", "text"), max_len=1000)
    return c.select(F.col("chunk").cast("long").alias("chunk"), F.size("tokens").alias("n_tokens"),
                    F.get("tokens", 0).alias("first_token"), F.element_at("tokens", -1).alias("last_token"))


# ------------------------------------------------------------------ features over labelled documents

FEAT_SQL = (LBASE + (
    f", pres AS (SELECT DISTINCT doc_id, label, unnest(tokens) AS word FROM lt WHERE split = 'train'), "
    f"np AS (SELECT sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS nn "
    f"FROM lt WHERE split = 'train'), "
    f"df AS (SELECT word, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n_neg "
    f"FROM pres WHERE NOT list_contains({STOP_SQL}, word) GROUP BY word), "
    "feat AS (SELECT word, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM df, np "
    "WHERE (n_pos >= 0.01 * np OR n_neg >= 0.01 * nn) AND (n_pos >= 2 * n_neg OR n_neg >= 2 * n_pos))"))


def train_features(spark, d):
    lt = labelled_tokens(spark, d)
    return tm.discriminative_features(lt.filter(F.col("split") == "train"))


@register("discriminative_features", "2.9", FEAT_SQL + " SELECT word, n_pos, n_neg FROM feat")
def q_discriminative_features(spark, d):
    return train_features(spark, d)


@register("binary_features", "2.9", FEAT_SQL +
          " SELECT DISTINCT lt.doc_id, w.word FROM (SELECT doc_id, unnest(tokens) AS word FROM lt) w "
          "JOIN lt ON lt.doc_id = w.doc_id JOIN feat ON feat.word = w.word")
def q_binary_features(spark, d):
    return tm.binary_features(labelled_tokens(spark, d), train_features(spark, d)).select("doc_id", "word")


@register("set_difference", "2.6", LBASE +
          f" SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(tokens) AS word FROM lt) "
          f"WHERE NOT list_contains({STOP_SQL}, word)")
def q_set_difference(spark, d):
    t = labelled_tokens(spark, d).select("doc_id", F.explode("tokens").alias("word"))
    return tm.remove_stop_words(t).distinct()       # broadcast anti-join on the word, then distinct


@register("context_pairs", "2.3", BASE + (
    " SELECT a.word, b.word AS context, count(*) AS n FROM ct a CROSS JOIN (VALUES (-2), (-1), (1), (2)) o(o) "
    "JOIN ct b ON a.doc_id = b.doc_id AND b.pos = a.pos + o.o GROUP BY 1, 2"))
def q_context_pairs(spark, d):
    return rel.context_pair_counts(corpus(spark, d), 2)


# ------------------------------------------------------------------ lexicons (FIX-11) and classification

def lexicon(spark, d, quality):
    """Every word whose share is larger in documents of this quality than in those of the other."""
    toks = fx.labelled_docs(spark, d).select("label", F.explode(split_nonword("text")).alias("word"))
    by = toks.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("n1"), F.count_if(F.col("label") == 0).alias("n0"))
    totals = by.agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))      # one row
    mine, other = F.col("n1") * F.col("t0"), F.col("n0") * F.col("t1")
    return by.crossJoin(F.broadcast(totals)).filter(mine > other if quality else mine < other).select("word")


LEXW_SQL = (f"SELECT word, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM (SELECT label, "
            f"unnest(list_filter(regexp_split_to_array(text, '{NW}'), lambda t: t <> '')) AS word FROM ld) GROUP BY word")


def lexicon_sql(q):
    return f"SELECT word FROM lexw, (SELECT sum(n1) AS t1, sum(n0) AS t0 FROM lexw) WHERE n1 * t0 {'>' if q else '<'} n0 * t1"


LEX_CTE = fx.with_sql(ld=fx.LABELLED_DOCS_SQL, lexw=LEXW_SQL, pos=lexicon_sql(1), neg=lexicon_sql(0))


def classified_tokens(spark, d):
    toks = table(spark, d, "documents").select("doc_id", F.explode(split_nonword("text")).alias("word"))
    return tm.classify_lexicon(toks, lexicon(spark, d, 1), lexicon(spark, d, 0))


@register("classify_lexicon", "2.2", LEX_CTE + (
    f", t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '{NW}'), lambda t: t <> '')) AS word FROM documents) "
    "SELECT doc_id, CAST(sum(CASE WHEN word IN (SELECT word FROM pos) THEN 1 ELSE 0 END) AS BIGINT) AS n_positive, "
    "CAST(sum(CASE WHEN word NOT IN (SELECT word FROM pos) AND word IN (SELECT word FROM neg) THEN 1 ELSE 0 END) AS BIGINT) AS n_negative, "
    "CAST(sum(CASE WHEN word NOT IN (SELECT word FROM pos) AND word NOT IN (SELECT word FROM neg) THEN 1 ELSE 0 END) AS BIGINT) AS n_oov "
    "FROM t GROUP BY doc_id"))
def q_classify_lexicon(spark, d):
    c = classified_tokens(spark, d)
    return c.groupBy("doc_id").agg(
        F.sum(F.when(F.col("type") == "positive", 1).otherwise(0)).cast("long").alias("n_positive"),
        F.sum(F.when(F.col("type") == "negative", 1).otherwise(0)).cast("long").alias("n_negative"),
        F.sum(F.when(F.col("type") == "oov", 1).otherwise(0)).cast("long").alias("n_oov"))


@register("read_lexicon", "2.1", LEX_CTE + " SELECT word, 'positive' AS list FROM pos UNION ALL SELECT word, 'negative' FROM neg")
def q_read_lexicon(spark, d):
    """The lexicons written as one-word-per-line text (with padding and duplicates) and read back."""
    from quarry.sources import files
    out = []
    for q, name in ((1, "positive"), (0, "negative")):
        path = files.scratch_text(spark, f"lexicon-{name}",
                                  lexicon(spark, d, q).select(F.concat(F.lit("  "), "word", F.lit(" ")).alias("value"))
                                  .unionByName(lexicon(spark, d, q).select(F.col("word").alias("value"))))
        out.append(files.read_lexicon(spark, path).withColumn("list", F.lit(name)))
    return out[0].unionByName(out[1])


def _vectorised(spark, d):
    lt = labelled_tokens(spark, d)
    words = [r[0] for r in train_features(spark, d).select("word").collect()]   # the selected vocabulary (small)
    return tm.feature_vectors(lt, words).withColumn("label", F.col("label").cast("double"))


def _evaluate(model, data):
    p = model.transform(data.filter(F.col("split") == "test"))
    return p.select("doc_id", F.col("label").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"))


NB_SQL = FEAT_SQL + (
    ", pres2 AS (SELECT DISTINCT w.doc_id, w.word FROM (SELECT doc_id, unnest(tokens) AS word FROM lt) w JOIN feat USING (word)), "
    "tr AS (SELECT doc_id, label FROM lt WHERE split = 'train'), "
    "nc AS (SELECT label, count(*) AS n_c FROM tr GROUP BY label), "
    "k AS (SELECT tr.label, p.word, count(*) AS k FROM pres2 p JOIN tr USING (doc_id) GROUP BY 1, 2), "
    "pp AS (SELECT nc.label, feat.word, (coalesce(k.k, 0) + 1.0) / (nc.n_c + 2.0) AS p, nc.n_c FROM nc CROSS JOIN feat "
    "LEFT JOIN k ON k.label = nc.label AND k.word = feat.word), "
    "base AS (SELECT label, ln(any_value(n_c) / (SELECT count(*) FROM tr)) + sum(ln(1 - p)) AS base FROM pp GROUP BY label), "
    "te AS (SELECT doc_id, label FROM lt WHERE split = 'test'), "
    "sc AS (SELECT te.doc_id, base.label, base.base + coalesce((SELECT sum(ln(pp.p) - ln(1 - pp.p)) FROM pres2 "
    "JOIN pp ON pp.word = pres2.word WHERE pres2.doc_id = te.doc_id AND pp.label = base.label), 0) AS score FROM te CROSS JOIN base) "
    "SELECT te.doc_id, te.label AS actual, arg_max(sc.label, (sc.score, -sc.label)) AS predicted FROM te JOIN sc USING (doc_id) "
    "GROUP BY te.doc_id, te.label")


@register("bernoulli_nb", "2.9", NB_SQL)
def q_bernoulli_nb(spark, d):
    lt = labelled_tokens(spark, d)
    feats = train_features(spark, d)
    pres = tm.binary_features(lt, feats).select("doc_id", "word")
    train = lt.filter(F.col("split") == "train").select("doc_id", "label")
    test = lt.filter(F.col("split") == "test").select("doc_id", F.col("label").alias("actual"))
    base, delta = tm.bernoulli_nb_fit(pres.join(train, "doc_id", "left_semi"), train, feats, 1.0)
    pred = tm.bernoulli_nb_predict(pres.join(test, "doc_id", "left_semi"), test, base, delta)
    return test.join(pred, "doc_id").select("doc_id", "actual", "predicted")


@register("bernoulli_nb_spark_ml", "2.9")
def q_bernoulli_nb_spark_ml(spark, d):
    """The same classifier through ``ml.classification.NaiveBayes`` (its class prior is smoothed)."""
    data = _vectorised(spark, d).cache()
    return _evaluate(tm.fit_bernoulli_nb(data.filter(F.col("split") == "train")), data)


@register("logistic_classifier", "2.9")
def q_logistic_classifier(spark, d):
    data = _vectorised(spark, d).cache()
    return _evaluate(tm.fit_logistic(data.filter(F.col("split") == "train")), data)
