"""Spelling variants by variable-length grams.

Words of at least ``min_len`` code points get an anchor on both ends and one gram for each start.  A gram has three code
points and grows while it is frequent in the vocabulary, so lists of a frequency-pruned dictionary stay short: only grams
that occur more than 1/``FREQUENT`` of all places are extended, which bounds the dictionary's inner nodes by ``FREQUENT`` a
length, whatever the vocabulary.  A gram is decided by its own code points alone; hence one edit changes just those grams
that hold the edited place, at most ``a`` of a word's ``m`` (its largest cover), and near words share at least m - a grams,
shifted by one place at most.  So the a + 1 rarest grams of both words have one in common (prefix bound), and only these
lists are merged, by length, shift and place.  What meets is verified by edit distance.

Grams are at most half as long as the shorter word of a pair, with its anchors, so m - a >= 1 always and no pair escapes.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, text_column

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, MOST = 3, 8
#: Frequent grams of a length that are extended, at most.
FREQUENT = 8192
HEAD, TAIL = "\x02", "\x03"


def typo(run: Column, doc_id: Column, every: int) -> Column:
    """The run, or the run without one code point where the crc32 of ``<doc_id>:<run>`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(every)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_len: int = 7, min_count: int = 2, every: int = 31) -> DataFrame:
    """word, n: the vocabulary of maximal letter runs, A-Z in lower case, some with a planted slip (``typo``), of at least
    ``min_len`` code points and ``min_count`` occurrences in all documents."""
    runs = F.regexp_extract_all(text_column(docs, text), F.lit(f"[{LETTERS}]{{{min_len},}}"), F.lit(0))    # a slip never lengthens a run
    runs = docs.select(docs[doc_id].alias("d"), F.explode(runs).alias("run"))
    words = runs.select(typo(F.translate("run", UPPER, LOWER), F.col("d"), every).alias("word"))
    return words.filter(F.length("word") >= min_len).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def longest(band: int) -> int:
    """Most code points of a gram for pairs whose shorter word has ``band``: half of the word with its anchors."""
    return min(MOST, max(LEAST, (band + 2) // 2))


def frequent_grams(vocab: DataFrame) -> dict[str, int]:
    """Inner nodes of the gram dictionary with their counts, length by length: a longer gram is counted only where its
    prefix is frequent.  At most ``FREQUENT`` of a length come to the driver."""
    places = vocab.agg(F.sum(F.length("word"))).first()[0] or 0
    least, found = max(1, places // FREQUENT), {}
    for size in range(LEAST, MOST):
        parents = frozenset(g for g in found if len(g) == size - 1)
        if size > LEAST and not parents:
            break

        def count(batches: Iterator[pa.RecordBatch], size=size, parents=parents) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    s = HEAD + word + TAIL
                    seen.update(s[p:p + size] for p in range(len(s) - size + 1) if size == LEAST or s[p:p + size - 1] in parents)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["gram", "c"])

        rows = vocab.select("word").mapInArrow(count, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))
        found |= {r.gram: r.c for r in rows.filter(F.col("c") > least).collect()}
    return found


def decompose(word: str, most: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(place, gram) of each start; a gram grows while it is frequent, up to ``most``."""
    s, out = HEAD + word + TAIL, []
    for p in range(len(s) - LEAST + 1):
        e = p + LEAST
        while e < len(s) and e - p < most and s[p:e] in frequent:
            e += 1
        out.append((p, s[p:e]))
    return out


def affected(grams: list[tuple[int, str]]) -> int:
    """Grams that one edit can change: the largest number that hold one place."""
    change = Counter()
    for p, g in grams:
        change[p] += 1
        change[p + len(g)] -= 1
    now = most = 0
    for p in sorted(change):
        now += change[p]
        most = max(most, now)
    return most


def prefix(word: str, most: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The a + 1 rarest grams of a word; near words share one of them at least."""
    grams = decompose(word, most, frequent)
    keep = affected(grams) + 1
    if keep > len(grams):
        raise ValueError(f"a word of {len(word)} code points is too short for the gram bound")
    return sorted(grams, key=lambda g: (frequent.get(g[1], 0), -len(g[1]), g[1], g[0]))[:keep]


def parity(word: str) -> int:
    """Code points that occur an odd number of times, as bits (signed).  One edit turns two bits at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _signatures(frequent: dict[str, int]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.string())]))
        for batch in batches:
            words = batch.column(0).to_pylist()
            own, longer = ([[{"pos": p, "gram": g} for p, g in prefix(w, longest(len(w) - less), frequent)] for w in words] for less in (0, 1))
            odd = pa.array(map(parity, words), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), odd, pa.array(own, kind), pa.array(longer, kind)], names=["word", "n", "odd", "own", "longer"])
    return sign


def near_words(vocab: DataFrame) -> DataFrame:
    """word, n, near, near_n: each pair of words of ``vocab`` (word, n; distinct words of 4 code points or more) that
    differ by exactly one inserted, deleted or replaced code point, in both directions."""
    grams = "array<struct<pos:int,gram:string>>"
    frequent = frequent_grams(vocab)
    signed = materialize(vocab.select("word", "n").mapInArrow(_signatures(frequent), f"word string, n long, odd long, own {grams}, longer {grams}"), "grams")

    def keyed(kind: str, band: Column, places: Column) -> DataFrame:
        """A row for each gram and place with its list: the shorter word's length, whether lengths are equal, place, gram."""
        return (signed.select("word", "n", "odd", band.alias("band"), F.explode(kind).alias("g")).select("word", "n", "odd", "band", "g.gram", F.explode(places).alias("at"))
                .select(F.xxhash64("band", "at.longer", "at.pos", "gram").alias("key"), "word", "n", "odd"))

    def at(longer: int, pos: Column) -> Column:
        return F.struct(F.lit(longer).alias("longer"), pos.alias("pos"))

    size, pos = F.length("word"), F.col("g.pos")
    left = keyed("own", size, F.array(at(0, pos), at(1, pos), at(1, pos + 1)))
    right = keyed("own", size, F.array(at(0, pos))).unionByName(keyed("longer", size - 1, F.array(at(1, pos))))
    right = right.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("odd").alias("near_odd"))
    once = (F.length("word") < F.length("near")) | (F.col("word") < F.col("near"))
    able = F.bit_count(F.col("odd").bitwiseXOR(F.col("near_odd"))) <= 2   # most words that meet fail here, before the edit distance
    pairs = left.join(right, "key").filter(able & once & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n").distinct()
    pairs = materialize(pairs, "near-words")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def variants(vocab: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of ``vocab`` (word, n; words distinct, other columns not read).
    The form is the near word of largest n (ties: smallest in code-point order) if that is at least ``ratio`` (above 1)
    times the word's n, else null; the root follows forms to the last.  An empty vocabulary gives an empty table."""
    if ratio <= 1:
        raise ValueError("the ratio must be above 1, or forms could run in circles")
    vocab = vocab.select("word", "n")
    best = F.min_by(F.struct("near", "near_n"), F.struct((-F.col("near_n")).alias("m"), "near"))
    near = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    enough = F.col("b.near_n") >= F.lit(ratio) * F.col("n")
    words = materialize(vocab.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                                F.when(enough, F.col("b.near")).alias("form"), F.when(enough, F.col("b.near_n")).alias("form_n")), "forms")
    roots = words.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:                                       # a chain grows by the ratio at each link, so pointers double few times
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_len: int = 7, min_count: int = 2, ratio: int = 10, every: int = 31) -> DataFrame:
    """``variants`` of the documents' vocabulary.  Null and empty texts have no words; a null id counts as empty text in
    the slips; rows that repeat count each; other columns are not read."""
    if min_len < 4:
        raise ValueError("words must have 4 code points at least")
    return variants(materialize(document_words(docs, doc_id, text, min_len, min_count, every), "vocabulary"), ratio)


#: The same in DuckDB SQL, which has no crc32: bytes run through the polynomial's table.  Near words are equal without the
#: code point at one place, or one without a code point is the other (levenshtein() there counts bytes).
VARIANTS_SQL = r"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
  lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c FROM
  (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda ch:
  CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [(192 | (unicode(ch) >> 6))::BIGINT, (128 | (unicode(ch) & 63))::BIGINT] END)) AS b FROM runs),
hashed AS (SELECT run, c, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM bytes, tab),
vocab AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
part AS MATERIALIZED (SELECT word, i, left(word, i::INT) || substr(word, i::INT + 2) AS p FROM (SELECT word, unnest(range(length(word))) AS i FROM vocab)),
longer AS (SELECT DISTINCT part.word, vocab.word AS near FROM part JOIN vocab ON part.p = vocab.word),
pairs AS (SELECT a.word, b.word AS near FROM part a JOIN part b ON a.p = b.p AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, near FROM longer UNION ALL SELECT near, word FROM longer),
near AS (SELECT p.word, count(*) AS n_near, arg_min(p.near, (-v.n, p.near)) AS near, max(v.n) AS near_n FROM pairs p JOIN vocab v ON v.word = p.near GROUP BY p.word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form, CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocab v LEFT JOIN near ON v.word = near.word),
chain(word, link, depth) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN forms f ON f.word = c.link WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, arg_max(link, depth) AS root FROM chain GROUP BY word) r ON f.word = r.word"""
