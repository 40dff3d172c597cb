"""Text features, vocabulary and classifiers."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import uniform01
from quarry.functions.text import STOP_WORDS, split_whitespace
from quarry.operators.hot_join import lookup_join
from quarry.operators.sequence import dense_index, exclusive_prefix_sum


def doc_tokens(docs: DataFrame, tokens_col: str = "tokens", doc: str = "doc_id") -> DataFrame:
    """``(doc, pos, word)`` long form of a token-array column."""
    return docs.select(doc, F.posexplode(tokens_col).alias("pos", "word"))


# ------------------------------------------------------------------ readers over text columns

def line_sentences(docs: DataFrame, text: str = "text", doc: str = "doc_id", labelled: bool = False) -> DataFrame:
    """One line = one sentence of whitespace tokens.  Lines are numbered across the whole corpus in
    (doc, line) order with an exact distributed prefix sum of per-document line counts (``doc``: unique integers); a text
    meets its offset whole, before it is cut into lines.  The labelled form adds the tag ``SENT_<line no>``."""
    lines = F.split(F.col(text), "\n")
    per_doc = docs.select(doc, F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("__n"))
    offs = exclusive_prefix_sum(per_doc, doc, "__n", "__off").select(doc, "__off")
    out = (docs.join(offs, doc).select(doc, "__off", F.posexplode(lines).alias("line_in_doc", "line"))
           .select((F.col("__off") + F.col("line_in_doc")).alias("line_no"), doc,
                   split_whitespace("line").alias("tokens")))
    if labelled:
        out = out.withColumn("tags", F.array(F.concat(F.lit("SENT_"), F.col("line_no").cast("string"))))
    return out


def token_chunks(docs: DataFrame, text: str = "text", doc: str = "doc_id", max_len: int = 1000) -> DataFrame:
    """The whole corpus as one token stream (documents in id order) cut into sentences of ``max_len``
    tokens: ``(chunk, tokens)``.  A document is cut where chunks end and its pieces, not its tokens, are shuffled; each
    chunk gathers at most ``max_len`` tokens."""
    t = docs.select(doc, split_whitespace(text).alias("t")).filter(F.size("t") > 0)
    offs = exclusive_prefix_sum(t.select(doc, F.size("t").cast("long").alias("__n")), doc, "__n", "__off").select(doc, "__off")
    off, n, size = F.col("__off"), F.size("t").cast("long"), F.lit(max_len).cast("long")
    chunks = F.sequence(F.floor(off / size), F.floor((off + n - 1) / size))

    def piece(c):
        start = F.greatest(c * size - off, F.lit(0).cast("long"))
        return F.struct(c.alias("chunk"), (off + start).alias("gpos"), F.slice("t", (start + 1).cast("int"), (F.least((c + 1) * size - off, n) - start).cast("int")).alias("part"))

    pieces = t.join(offs, doc).select(F.explode(F.transform(chunks, piece)).alias("p"))
    return (pieces.groupBy(F.col("p.chunk").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("p.gpos", "p.part"))).alias("__s"))
            .select("chunk", F.flatten(F.transform("__s", lambda s: s["part"])).alias("tokens")))


def tagged_tokens(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``WORD/TAG`` tokens → ``word_lower/TA`` (first two characters of the tag).  Tokens without exactly
    one slash are malformed and dropped, as are tokens whose two-character tag prefix is not all
    letters; sentences left empty are dropped."""
    def conv(t):
        word = F.substring_index(t, "/", 1)
        tag2 = F.substring(F.substring_index(t, "/", -1), 1, 2)
        ok = t.rlike("^[^/]*/[^/]*$") & tag2.rlike("^\\p{L}+$")
        return F.when(ok, F.concat(F.lower(word), F.lit("/"), tag2))
    out = docs.withColumn(tokens_col, F.filter(F.transform(tokens_col, conv), lambda x: x.isNotNull()))
    return out.filter(F.size(tokens_col) > 0)


def labeled_tagged_tokens(lines: DataFrame, file: str = "file", line_no: str = "line_no", text: str = "line") -> DataFrame:
    """The labelled form of ``tagged_tokens`` over the lines of files: ``(file, line_no, tokens, tags)`` with the one tag
    ``<file>_SENT_<line_no>``; lines are numbered from 0 within their file, and those left without tokens are dropped (their
    numbers stay unused)."""
    sentences = lines.select(F.col(file).alias("file"), F.col(line_no).alias("line_no"), split_whitespace(text).alias("tokens"))
    tag = F.concat(F.col("file"), F.lit("_SENT_"), F.col("line_no").cast("string"))
    return tagged_tokens(sentences).select("file", "line_no", "tokens", F.array(tag).alias("tags"))


# ------------------------------------------------------------------ vocabulary

def vocabulary(tokens: DataFrame, min_count: int = 5, word: str = "word") -> DataFrame:
    """``(word, count, idx)`` for words with count >= min_count; idx by count desc, then word."""
    counts = tokens.groupBy(word).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)
    return dense_index(counts, [F.col("count").desc(), F.col(word)], "idx")


def subsample_probability(vocab: DataFrame, sample: float = 1e-3) -> DataFrame:
    """Keep-probability ``min(1, (sqrt(c/t) + 1) * t / c)`` with ``t = sample * total words``."""
    total = vocab.agg(F.sum("count").alias("__total"))
    t = F.col("__total") * sample
    return (vocab.crossJoin(F.broadcast(total))
            .select("word", "count", F.least(F.lit(1.0), (F.sqrt(F.col("count") / t) + 1) * t / F.col("count"))
                    .alias("keep_prob")))


def subsample_tokens(tokens: DataFrame, probs: DataFrame, seed: int = 1, doc: str = "doc_id") -> DataFrame:
    """Drop tokens at random by their keep-probability; the draw is a hash of (doc, pos, seed)."""
    hot = "count" if "count" in probs.columns else None
    return (lookup_join(tokens, probs.select("word", "keep_prob", *([hot] if hot else [])), "word", counts=hot).drop(*([hot] if hot else []))
            .filter(uniform01(doc, "pos", seed=seed) <= F.col("keep_prob")).drop("keep_prob"))


def noise_distribution(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """``count^0.75 / Σ count^0.75`` and its cumulative sum in index order (the negative-sampling table)."""
    w = vocab.select("word", "idx", F.pow(F.col("count"), power).alias("__w"))
    total = w.agg(F.sum("__w").alias("__t"))
    p = w.crossJoin(F.broadcast(total)).select("word", "idx", (F.col("__w") / F.col("__t")).alias("prob"))
    c = exclusive_prefix_sum(p, "idx", "prob", "__before")
    return c.select("word", "idx", "prob", (F.col("__before") + F.col("prob")).alias("cumulative"))


def labeled_vocab_counts(docs: DataFrame, tokens_col="tokens", tags_col="tags") -> DataFrame:
    words = docs.select(F.explode(tokens_col).alias("item"), F.lit(1).cast("long").alias("w"))
    tags = docs.select(F.explode(tags_col).alias("item"), F.size(tokens_col).cast("long").alias("w"))
    return words.unionByName(tags).groupBy("item").agg(F.sum("w").alias("count"))


def remove_stop_words(tokens: DataFrame, word: str = "word") -> DataFrame:
    spark = tokens.sparkSession
    sw = spark.createDataFrame([(w,) for w in STOP_WORDS], f"{word} string")
    return tokens.join(F.broadcast(sw), word, "left_anti")


# ------------------------------------------------------------------ discriminative features

def discriminative_features(docs: DataFrame, tokens_col="tokens", label="label", min_frac=0.01, ratio=2.0) -> DataFrame:
    """Non-stop-words present in >= 1 % of positive or >= 1 % of negative documents, whose document
    frequency is at least twice that of the other class.  ``(word, n_pos, n_neg)``."""
    n = docs.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("__np"),
                 F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("__nn"))
    pres = docs.select("doc_id", label, F.explode(F.array_distinct(tokens_col)).alias("word"))
    pres = remove_stop_words(pres)
    df = pres.groupBy("word").agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n_pos"),
                                  F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("n_neg"))
    return (df.crossJoin(F.broadcast(n))
            .filter(((F.col("n_pos") >= min_frac * F.col("__np")) | (F.col("n_neg") >= min_frac * F.col("__nn")))
                    & ((F.col("n_pos") >= ratio * F.col("n_neg")) | (F.col("n_neg") >= ratio * F.col("n_pos"))))
            .select("word", F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg")))


def binary_features(docs: DataFrame, features: DataFrame, tokens_col="tokens") -> DataFrame:
    """Long form of the 0/1 feature vectors: ``(doc_id, word)`` for each selected word present."""
    pres = docs.select("doc_id", F.explode(F.array_distinct(tokens_col)).alias("word"))
    return pres.join(features.select("word"), "word", "left_semi")


def feature_vectors(docs: DataFrame, feature_words: list[str], tokens_col="tokens", out="features") -> DataFrame:
    """Binary ``Vector`` column over a fixed, sorted vocabulary (for the ML estimators)."""
    from pyspark.ml.feature import CountVectorizerModel
    cv = CountVectorizerModel.from_vocabulary(sorted(feature_words), inputCol=tokens_col, outputCol=out, binary=True)
    return cv.transform(docs)


def classify_lexicon(tokens: DataFrame, positive: DataFrame, negative: DataFrame, word: str = "word") -> DataFrame:
    """Adds ``type``: positive if in the positive list, else negative if in the negative list, else oov."""
    p = positive.select(F.col(word).alias("__p")).distinct()
    n = negative.select(F.col(word).alias("__n")).distinct()
    return (tokens.join(p, F.col(word) == F.col("__p"), "left").join(n, F.col(word) == F.col("__n"), "left")
            .withColumn("type", F.when(F.col("__p").isNotNull(), "positive")
                        .when(F.col("__n").isNotNull(), "negative").otherwise("oov")).drop("__p", "__n"))


# ------------------------------------------------------------------ classifiers (Spark ML)

def fit_bernoulli_nb(train: DataFrame, features="features", label="label"):
    from pyspark.ml.classification import NaiveBayes
    return NaiveBayes(modelType="bernoulli", smoothing=1.0, featuresCol=features, labelCol=label).fit(train)


def fit_gaussian_nb(train: DataFrame, features="features", label="label"):
    from pyspark.ml.classification import NaiveBayes
    return NaiveBayes(modelType="gaussian", featuresCol=features, labelCol=label).fit(train)


def fit_logistic(train: DataFrame, features="features", label="label"):
    """L2 logistic regression with C = 1 on the summed loss ⇔ mean-loss regParam = 1/n; intercept
    unpenalised, no standardisation."""
    from pyspark.ml.classification import LogisticRegression
    n = train.count()
    return LogisticRegression(regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
                              featuresCol=features, labelCol=label, maxIter=200).fit(train)


# ------------------------------------------------------------------ Bernoulli naive Bayes on sparse presence rows

def bernoulli_nb_fit(presence: DataFrame, labels: DataFrame, features: DataFrame, alpha: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Bernoulli naive Bayes with additive smoothing ``alpha`` on the feature likelihoods and the
    empirical class prior n_c / n (no smoothing of the prior).

    ``presence(doc_id, word)`` lists the selected features present in each document; ``labels(doc_id,
    label)``; ``features(word)``.  Returns ``(base(label, base), delta(label, word, delta))`` where a
    document's log-posterior is ``base + Σ_{present words} delta`` —
    base = log prior + Σ_f log(1 − p_cf), delta = log p_cf − log(1 − p_cf)."""
    n = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    total = labels.agg(F.count(F.lit(1)).alias("__n"))
    cnt = presence.join(labels, "doc_id").groupBy("label", "word").agg(F.count(F.lit(1)).alias("k"))
    # classes x selected words: a handful of classes times the feature vocabulary
    grid = F.broadcast(n).crossJoin(features.select("word").distinct())
    p = (grid.join(cnt, ["label", "word"], "left")
         .withColumn("p", (F.coalesce("k", F.lit(0)) + alpha) / (F.col("n_c") + 2 * alpha)))
    delta = p.select("label", "word", (F.log("p") - F.log(1 - F.col("p"))).alias("delta"))
    base = (p.groupBy("label", "n_c").agg(F.sum(F.log(1 - F.col("p"))).alias("__s")).crossJoin(total)
            .select("label", (F.log(F.col("n_c") / F.col("__n")) + F.col("__s")).alias("base")))
    return base, delta


def bernoulli_nb_predict(presence: DataFrame, docs: DataFrame, base: DataFrame, delta: DataFrame) -> DataFrame:
    """``(doc_id, predicted)``: the class with the highest log-posterior (ties to the smaller label)."""
    s = presence.join(delta, "word").groupBy("doc_id", "label").agg(F.sum("delta").alias("__d"))
    allc = docs.select("doc_id").distinct().crossJoin(F.broadcast(base))
    scored = (allc.join(s, ["doc_id", "label"], "left")
              .withColumn("score", F.col("base") + F.coalesce("__d", F.lit(0.0))))
    return scored.groupBy("doc_id").agg(F.max_by("label", F.struct(F.col("score"), -F.col("label"))).alias("predicted"))
