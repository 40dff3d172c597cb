"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

At most ``max_examples`` labelled documents (those with the smallest hash) are the examples; the classifier with its
vocabulary and weights is learnt from them, in one task.  A word weighs its TF-IDF, by its document frequency among the
examples, times its association with the label (the phi coefficient) plus ``FLOOR``, so no word is left out; a word in no
example weighs as one of frequency 0, and a document's norm covers all its words.  Example vectors are sorted and dealt to
blocks of ``BLOCK``; a word's postings lie block by block, each with its largest weight.  The sum of a document's weights
times these maxima bounds its cosine with every example of a block, so blocks are opened from the highest bound on and the
search ends, exactly, when the next bound is below the k-th best cosine.  Words that a sixth of the examples hold have a
dense matrix beside their postings: their part of the cosines of many documents is one matrix product.  Neighbours vote
with weight 1 / (0.1 + distance), pulled to the base rate, and the vote is calibrated by a logistic curve fitted on
examples that vote without themselves.  Only the text is an input of a score.
"""
from __future__ import annotations

import ctypes
import gc
import pickle
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, keep_rows, materialize, text_column, with_plain_names, with_row_key

BLOCK, PULL, CALIBRATION, FLOOR = 128, 0.5, 4000, 0.01
#: A word is dense from this share of the examples on; documents whose dense parts are one product.
DENSE, TOGETHER = 1 / 6, 128
#: Bytes of the index that travel in a row.
PIECE = 1 << 22
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Index:
    vocab: dict[str, int] | None
    idf: np.ndarray  # weight of each word: idf, in fit times its association with the label
    n_blocks: int
    first: np.ndarray  # first entry of each word; an entry is a word's postings in one block
    block: np.ndarray  # block of each entry
    most: np.ndarray  # largest weight of each entry
    begin: np.ndarray  # first posting of each entry
    places: np.ndarray  # place and weight of each posting
    held: np.ndarray
    ids: np.ndarray  # doc_id of each place, -1 for none
    labels: np.ndarray
    prior: float  # base rate among the examples
    blank: float  # base rate among examples without any vocabulary word
    curve: tuple[float, float] = (1.0, 0.0)
    k: int = 25
    other: float = 0.0  # weight of a word in no example
    column: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # column of each word in the dense matrix, -1 for none
    dense: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))  # (dense word, place)
    terms: pa.Array | None = None  # the vocabulary in place of ``vocab``

    @property
    def blocks(self) -> np.ndarray:
        """Dense copy (block, term, example) of the weights, for small vocabularies."""
        out = np.zeros((self.n_blocks, len(self.idf), BLOCK))
        entry = np.repeat(np.arange(len(self.block)), np.diff(self.begin))
        term = np.repeat(np.arange(len(self.idf)), np.diff(self.first))
        out[self.block[entry], term[entry], self.places % BLOCK] = self.held
        return out

    @property
    def block_max(self) -> np.ndarray:
        """Dense copy (term, block) of the maxima, for small vocabularies."""
        return self.blocks.max(axis=2).T if self.n_blocks else np.zeros((len(self.idf), 0))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return unit(term_counts(text, self.vocab), self.idf)

    def partial(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The dense words' part of the cosines (document, place)."""
        q = np.zeros((len(docs), len(self.dense)))
        for row, (terms, weights) in zip(q, docs):
            at = self.column[terms]
            row[at[at >= 0]] = weights[at >= 0]
        return q @ self.dense

    def bounds(self, terms: np.ndarray, weights: np.ndarray, partial: np.ndarray) -> np.ndarray:
        """Upper bound of the cosine with any example of each block."""
        rare = self.column[terms] < 0
        e, n = _ranges(self.first[terms[rare]], self.first[terms[rare] + 1])
        return (partial.reshape(-1, BLOCK).max(axis=1) + np.bincount(self.block[e], np.repeat(weights[rare], n) * self.most[e], self.n_blocks)) * (1 + 1e-12)

    def neighbours(self, terms: np.ndarray, weights: np.ndarray, bound: np.ndarray, skip: int = -1, partial: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a cosine above 0: highest first, ties to the lower place."""
        partial = self.partial([(terms, weights)])[0] if partial is None else partial
        at, cos = np.empty(0, np.int64), np.empty(0)
        rare = self.column[terms] < 0
        terms, weights = terms[rare], weights[rare]
        floor = float(np.partition(partial, -self.k - 1)[-self.k - 1]) - 1e-12 if len(partial) > self.k else 0.0  # the rest of a cosine isn't negative
        order, done, step = np.argsort(-bound, kind="stable"), 0, 4
        while done < len(order):
            least = max(floor, cos[-1] - 1e-12) if len(cos) == self.k else floor
            part = order[done:done + step]
            part = part[(bound[part] > 0) & (bound[part] >= least)]
            if not len(part):
                break
            if 4 * np.count_nonzero(bound >= least) > self.n_blocks:  # many blocks: whole posting lists are faster
                at, cos, step = at[:0], cos[:0], len(order)
                p, n = _ranges(self.begin[self.first[terms]], self.begin[self.first[terms + 1]])
                c = np.bincount(self.places[p], np.repeat(weights, n) * self.held[p], self.n_blocks * BLOCK) + partial
                place = np.flatnonzero((c > 0) & (c >= least))
            else:
                entries, n = _ranges(self.first[terms], self.first[terms + 1])
                opened = np.zeros(self.n_blocks, dtype=bool)
                opened[part] = True
                mine = opened[self.block[entries]]
                p, m = _ranges(self.begin[entries[mine]], self.begin[entries[mine] + 1])
                c = np.bincount(self.places[p], np.repeat(np.repeat(weights, n)[mine], m) * self.held[p], self.n_blocks * BLOCK) + partial
                place = (part[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                place = place[(c[place] > 0) & (c[place] >= least)]
            place = place[place != skip]
            at, cos = np.concatenate((at, place)), np.concatenate((cos, c[place]))
            if len(at) > 4 * self.k:  # what is below the k-th can't come back; ties stay
                stays = cos >= np.partition(cos, -self.k)[-self.k] - 1e-11
                at, cos = at[stays], cos[stays]
            o = np.lexsort((at, -np.round(cos, 12)))[:self.k]
            at, cos, done, step = at[o], cos[o], done + step, step * 4
        return at, cos

    def __getstate__(self) -> dict:
        """The vocabulary travels as an Arrow array, a tenth of a dict's size."""
        return self.__dict__ | {"vocab": None, "terms": pa.array(list(self.vocab), pa.string()) if self.vocab is not None else self.terms}

    def numbers(self, words: list[str]) -> np.ndarray:
        """Term numbers, -1 for words of no example."""
        if self.vocab is not None:
            return np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        return pc.fill_null(pc.index_in(pa.array(words, pa.string()), self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def weigh(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and weights of the vocabulary's words of each text; the norm is that of all its words."""
        counts = [Counter(words(t)) for t in texts]
        numbers, at, out = self.numbers([w for n in counts for w in n]), 0, []
        for n in counts:
            terms = numbers[at:at + len(n)]
            at += len(n)
            count = 1 + np.log(np.fromiter(n.values(), dtype=np.float64, count=len(n)))
            order = np.argsort(terms)
            order, others = order[terms[order] >= 0], count[terms < 0] * self.other
            terms = terms[order]
            raw = count[order] * self.idf[terms]
            out.append((terms, raw / np.sqrt(raw @ raw + others @ others) if len(terms) else raw))
        return out

    def search(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the nearest examples of each text."""
        docs, out = self.weigh(texts), []
        for lo in range(0, len(docs), TOGETHER):
            some = docs[lo:lo + TOGETHER]
            for (terms, weights), partial in zip(some, self.partial(some)):
                out.append(self.neighbours(terms, weights, self.bounds(terms, weights, partial), partial=partial) if len(terms) else (terms, weights))
        return out

    def vote(self, at: np.ndarray, cos: np.ndarray) -> float:
        if not len(at):
            return self.blank
        w = 1 / (0.1 + (1 - np.minimum(cos, 1)))
        return float((w @ self.labels[at] + PULL * self.prior) / (w.sum() + PULL))

    def calibrated(self, vote: float) -> float:
        a, b = self.curve
        v = min(max(vote, 1e-6), 1 - 1e-6)
        return float(1 / (1 + np.exp(-np.clip(a * np.log(v / (1 - v)) + b, -30, 30))))

    def judge(self, at: np.ndarray, cos: np.ndarray) -> tuple[float, list[int], list[float]]:
        """Score and evidence (doc_ids and cosines of the nearest examples that carry the winning label)."""
        s = self.calibrated(self.vote(at, cos)) if len(at) else self.blank
        mine = self.labels[at] == (s >= 0.5)
        return s, self.ids[at][mine][:3].tolist(), cos[mine][:3].round(6).tolist()


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all ranges one after another, and the length of each range."""
    n = (end - begin).astype(np.int64)
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def term_counts(text: str | None, vocab: dict[str, int]) -> dict[int, int]:
    tf: dict[int, int] = {}
    for w in words(text):
        if (i := vocab.get(w)) is not None:
            tf[i] = tf.get(i, 0) + 1
    return tf


def unit(tf: dict[int, int] | np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term numbers and unit-length TF-IDF weights of term counts, a dict or rows (term, count)."""
    if not len(tf):
        return np.empty(0, np.int64), np.empty(0)
    pairs = np.array(list(tf.items())) if isinstance(tf, dict) else tf
    terms, n = pairs[np.argsort(pairs[:, 0])].T.astype(np.int64)
    w = (1 + np.log(n)) * idf[terms]
    return terms, w / np.sqrt(w @ w)


def build_index(vocab: dict[str, int], idf: np.ndarray, counts: list[dict[int, int]] | list[np.ndarray], ids: list[int], labels: list[int], k: int) -> Index:
    """Index over the examples that hold vocabulary words; calibration over the first ``CALIBRATION`` of them in hash
    order (each votes without itself)."""
    prior = float(np.mean(labels)) if len(labels) else 0.0
    made = [(*unit(tf, idf), i, y) for tf, i, y in zip(counts, ids, labels, strict=True)]
    blank = [y for t, _, _, y in made if not len(t)]
    held = [m for m in made if len(m[0])]
    order = sorted(range(len(held)), key=lambda j: (held[j][0][np.argsort(-held[j][1], kind="stable")[:4]].tolist(), held[j][2]))
    n = -(-len(held) // BLOCK)
    at, truth = np.full(n * BLOCK, -1, np.int64), np.zeros(n * BLOCK)
    for p, j in enumerate(order):
        at[p], truth[p] = held[j][2:]
    place = {j: p for p, j in enumerate(order)}
    term = np.concatenate([np.empty(0, np.int64), *[held[j][0] for j in order]])
    weight = np.concatenate([np.empty(0), *[held[j][1] for j in order]])
    places = np.repeat(np.arange(len(order)), [len(held[j][0]) for j in order])
    o = np.argsort(term, kind="stable")  # by word, then place
    term, weight, places = term[o], weight[o], places[o]
    begin = np.flatnonzero(np.diff(term * max(n, 1) + places // BLOCK, prepend=-1))
    places = places.astype(np.int32)
    idx = Index(vocab, idf, n, np.searchsorted(term[begin], np.arange(len(idf) + 1)), (places[begin] // BLOCK).astype(np.int32),
                np.maximum.reduceat(weight, begin) if len(begin) else np.empty(0), np.append(begin, len(term)).astype(np.int32), places, weight,
                at, truth, prior, (sum(blank) + prior) / (len(blank) + 1), k=k)
    size = np.diff(idx.begin[idx.first]) if len(idf) else np.zeros(0, np.int64)
    common = np.flatnonzero(size >= max(2, DENSE * len(held)))
    idx.column, idx.dense = np.full(len(idf), -1), np.zeros((len(common), n * BLOCK))
    idx.column[common] = np.arange(len(common))
    in_dense = idx.column[term] >= 0
    idx.dense[idx.column[term[in_dense]], places[in_dense]] = weight[in_dense]
    votes, y = [], []
    for j, (t, w, _, label) in enumerate(held[:CALIBRATION]):
        partial = idx.partial([(t, w)])[0]
        votes.append(idx.vote(*idx.neighbours(t, w, idx.bounds(t, w, partial), skip=place[j], partial=partial)))
        y.append(label)
    if len(set(y)) == 2:
        idx.curve = _logistic(np.array(votes), np.array(y, dtype=float))
    return idx


def _logistic(votes: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the votes' log odds; Newton steps with a ridge to (1, 0)."""
    v = np.clip(votes, 1e-6, 1 - 1e-6)
    x, beta, start = np.column_stack((np.log(v / (1 - v)), np.ones(len(v)))), np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (y - p) - (beta - start))
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def learn(texts: list[str | None], ids: list[int], y: list[int], k: int) -> Index:
    """The classifier from labelled examples; no examples: score 0 for all."""
    vocab: dict[str, int] = {}
    counts, labels = [], np.array(y, dtype=np.int64)
    for t in texts:
        tf = Counter(words(t))
        counts.append(np.array([(vocab.setdefault(w, len(vocab)), c) for w, c in tf.items()], dtype=np.int32).reshape(-1, 2))
    n, pos, near, toxic = len(labels), int(labels.sum()), np.zeros(len(vocab)), np.zeros(len(vocab))
    for tf, label in zip(counts, labels, strict=True):
        j = tf[:, 0]
        near[j] += 1
        toxic[j] += label
    spread = near * (n - near) * max(pos * (n - pos), 1)  # phi coefficient of the 2 x 2 table of word and label
    phi = np.abs(toxic * n - near * pos) / np.sqrt(np.maximum(spread, 1.0))
    index = build_index(vocab, (np.log((1 + n) / (1 + near)) + 1) * (phi + FLOOR), counts, ids, labels.tolist(), k)
    index.other = float((np.log(1 + n) + 1) * FLOOR)
    return index


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_examples: int = 8192, k: int = 25) -> Index:
    """Learns from rows of ``labels`` whose crc32(doc_id as text) mod 5 isn't 0 and whose label is 0 or 1; a doc_id
    with both labels counts as 1, a doc_id of several documents by its smallest text.  No such rows: score 0 for all.
    At most ``max_examples`` rows are learnt from, in one task."""
    lab = (labels.select(F.col(doc_id).cast("long").alias("i"), F.col(label).cast("int").alias("y")).filter("i IS NOT NULL AND y IN (0, 1)")
           .filter(F.crc32(F.col("i").cast("string")) % 5 != 0).groupBy("i").agg(F.max("y").alias("y")))
    near = docs.select(F.col(doc_id).cast("long").alias("i")).filter("i IS NOT NULL").distinct()
    chosen = lab.join(near, "i", "left_semi").orderBy(F.xxhash64("i"), "i").limit(max_examples)
    chosen = materialize(chosen, "toxic-chosen")  # at most max_examples rows of two numbers
    picked = docs.select(F.col(doc_id).cast("long").alias("i"), text_column(docs, text).alias("t")).join(F.broadcast(chosen), "i")
    picked = materialize(picked.groupBy("i", "y").agg(F.min("t").alias("t")), "toxic-examples")

    def learnt(parts):
        rows = sorted(((h, i, y, t) for p in parts for h, i, y, t in zip(p["h"], p["i"], p["y"], p["t"])), key=lambda r: r[:2])
        data = pickle.dumps(learn([t for *_, t in rows], [int(i) for _, i, _, _ in rows], [int(y) for *_, y, _ in rows], k), protocol=5)
        del rows
        _give_back()
        for at in range(0, len(data), PIECE):
            yield pd.DataFrame({"at": [at], "piece": [data[at:at + PIECE]]})

    made = materialize(picked.select(F.xxhash64("i").alias("h"), "i", "y", "t").coalesce(1).mapInPandas(learnt, "at long, piece binary"), "toxic-index")
    pieces = made.orderBy("at").toArrow()["piece"]
    return pickle.loads(b"".join(x.as_py() for x in pieces)) if len(pieces) else learn([], [], [], k)


def _give_back() -> None:
    """Freed memory goes back to the system: a worker that has learnt is used again for scoring."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def scored(docs: DataFrame, keep: dict, index: Index, text: str = "text") -> DataFrame:
    """The columns ``keep`` (name: column) of each row, and ``s``: score, evidence, cosines."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by max_examples

    rows = docs.select(*[c.alias(name) for name, c in keep.items()], text_column(docs, text).alias("__text"))
    names = [*keep, "s"]
    kind = pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.int64())), ("cosines", pa.list_(pa.float64()))])

    def judge(batches):
        index = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 4 * TOGETHER):
                part = batch.slice(lo, 4 * TOGETHER)
                texts = part.column(part.num_columns - 1).to_pylist()
                once = list(dict.fromkeys(texts))  # copies are scored once
                found = {t: dict(zip(kind.names, index.judge(at, cos))) for t, (at, cos) in zip(once, index.search(once))}
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([found[t] for t in texts], kind)], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(judge, ", ".join([*fields, "s struct<score:double,evidence:array<bigint>,cosines:array<double>>"]))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= 0.5), evidence (doc_ids of the nearest
    examples that carry the predicted label) and their cosines.

    Null and empty texts, and texts without a word of the examples, get the smoothed base rate of examples without
    words.  held_out is false for a null doc_id.  Rows that repeat are scored each; other columns are not read.  Empty
    tables: no rows without documents, score 0 without labels."""
    i = F.col(doc_id)
    held_out = F.coalesce(F.crc32(i.cast("string")) % 5 == 0, F.lit(False))
    out = scored(docs, {"doc_id": i, "held_out": held_out}, fit(docs, labels, doc_id, text, **options), text)
    return out.select("doc_id", "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.evidence", "s.cosines")


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that are predicted toxic, all columns kept."""
    plain, i, text = with_plain_names(docs, doc_id, text)
    keyed = with_row_key(plain)
    index = fit(keyed.withColumnRenamed(i, doc_id), labels, doc_id, text, **options)
    toxic = scored(keyed, {FILE: keyed[FILE], POS: keyed[POS]}, index, text).filter("s.score >= 0.5")
    return keep_rows(keyed, toxic).toDF(*docs.columns)
