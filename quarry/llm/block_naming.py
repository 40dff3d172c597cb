"""Exact dedup by deterministic block naming (DataFrame functions only).

The text without white space is cut into blocks of ``block_chars`` code points.  The distinct blocks are sorted and
numbered; then adjacent names are paired, the distinct pairs sorted and numbered, again and again, until each document
has one name.  Equal name at equal depth means equal text, without a chance of a collision: a name stands for one
distinct block, or for one distinct pair of names.

Only distinct blocks are shuffled with their characters (copies combine before the shuffle).  A document looks its
block names up by a 128-bit fingerprint that was checked to be different for all distinct blocks; if two ever share
one, the step is repeated with other seeds.  Later rounds carry integers only and shrink by half.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, SPACE, keep_rows, materialize, text_column, with_plain_names, with_row_key

EMPTY_LEVEL = -1


def squeezed(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(text, SPACE, "")


def _blocks(text: Column, block_chars: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), 0)


def _fingerprint(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2"))


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Sorts the distinct keys of each hash partition and numbers them: partition number and rank make the name."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _regroup(items: DataFrame) -> DataFrame:
    """(rid, pos, name) back to one row a document with its names in order."""
    return (items.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("s"))
            .select("rid", F.transform("s", lambda x: x["name"]).alias("names")))


def _name_blocks(texts: DataFrame, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """(documents with key columns and ``fps``, table h1, h2 -> name)."""
    for seed in range(8):
        docs = materialize(texts.select(FILE, POS, "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
                                        F.transform(_blocks(F.col("norm"), block_chars), lambda b: _fingerprint(b, seed)).alias("fps"))
                           .withColumn("rid", F.monotonically_increasing_id()), "naming-docs")
        distinct = texts.select(F.explode(_blocks(F.col("norm"), block_chars)).alias("block")).distinct()
        names = materialize(_numbered(distinct, ["block"]).select(_fingerprint(F.col("block"), seed).alias("fp"), "name")
                            .select("fp.h1", "fp.h2", "name"), "naming-blocks")
        if names.groupBy("h1", "h2").count().filter("count > 1").isEmpty():
            return docs, names
    raise RuntimeError("no seed separates the distinct blocks")


def exact_identities(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_chars: int = 2048) -> DataFrame:
    """One row per input row: the row's place, ``doc_id``, ``n_chars``, ``text_sha256``, ``rid`` and its identity
    (``level``, ``name``).  Null text counts as empty; empty texts share the identity (-1, 0)."""
    keyed = with_row_key(df)
    texts = keyed.select(FILE, POS, F.col(doc_id).alias("doc_id"), text_column(keyed, text).alias("t")).select(
        FILE, POS, "doc_id", F.char_length("t").cast("long").alias("n_chars"), squeezed(F.col("t")).alias("norm"))
    docs, names = _name_blocks(texts, block_chars)
    items = docs.select("rid", F.posexplode("fps").alias("pos", "fp")).select("rid", "pos", "fp.h1", "fp.h2")
    state = materialize(_regroup(items.join(names, ["h1", "h2"]).select("rid", "pos", "name")), "naming-0")
    level, done = 0, docs.filter(F.size("fps") == 0).select("rid", F.lit(EMPTY_LEVEL).alias("level"), F.lit(0).cast("long").alias("name"))
    while True:
        done = done.unionByName(state.filter(F.size("names") == 1).select("rid", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        open_docs = state.filter(F.size("names") > 1)
        if open_docs.isEmpty():
            break
        level += 1
        pairs = open_docs.select("rid", F.posexplode(F.transform(
            F.expr("sequence(0, cast(ceil(size(names) / 2) as int) - 1)"),
            lambda i: F.struct(F.get("names", 2 * i).alias("a"), F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("b")))).alias("pos", "p")
        ).select("rid", "pos", "p.a", "p.b")
        pair_names = materialize(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), f"naming-pairs-{level}")
        state = materialize(_regroup(pairs.join(pair_names, ["a", "b"]).select("rid", "pos", "name")), f"naming-{level}")
    return docs.drop("fps").join(done, "rid")


def exact_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_chars: int = 2048) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the row's place.

    Texts are equal when equal without white space; null counts as empty, and empty texts are one group.  The row with
    the most code points in its original text stays, then the smallest doc_id (null last), then any one of rows that
    agree in both.  Other columns are not read.  An empty table gives an empty result."""
    ident = materialize(exact_identities(df, doc_id, text, block_chars), "naming-identities")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))).alias("best")
    groups = materialize(ident.groupBy("level", "name").agg(best, F.count(F.lit(1)).alias("group_size"))
                         .select("level", "name", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size"), "naming-groups")
    return ident.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256", FILE, POS)


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_chars: int = 2048) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    plain, i, t = with_plain_names(docs, doc_id, text)
    keyed = with_row_key(plain)
    return keep_rows(keyed, exact_dedup(keyed.drop(FILE, POS), i, t, block_chars).filter(~F.col("kept"))).toDF(*docs.columns)
