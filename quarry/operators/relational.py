"""Joins and set operations."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.hot_join import lookup_join


def inner_join_suffix(left: DataFrame, right: DataFrame, on: list[str], suffixes=("_x", "_y")) -> DataFrame:
    """Inner equi-join; non-key columns present on both sides get the suffixes."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    lrenamed = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    rrenamed = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return lrenamed.join(rrenamed, on=on, how="inner")


def latest_alias(aliases: DataFrame, bad="bad_id", good="good_id", order="line_no") -> DataFrame:
    """One canonical id per bad id; when a bad id is listed more than once the last line wins."""
    return aliases.groupBy(bad).agg(F.max_by(good, order).alias(good))


def canonicalize_ids(df: DataFrame, column: str, aliases: DataFrame, bad="bad_id", good="good_id",
                     order="line_no") -> DataFrame:
    """Replace ``column`` by its canonical id when listed (one hop, not transitive), else keep it.

    The alias table is a dimension (one row per listed id); it is broadcast when Spark's size estimate
    is under the broadcast threshold, otherwise the left join shuffles — no hint forces it."""
    m = latest_alias(aliases, bad, good, order).withColumnsRenamed({bad: "__bad", good: "__good"})
    return (df.join(m, F.col(column) == F.col("__bad"), "left")
            .withColumn(column, F.coalesce(F.col("__good"), F.col(column))).drop("__bad", "__good"))


def lookup_names(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    return df.join(names, key, "left")


def anti_join_seen(candidates: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate (user, item) rows minus those already seen."""
    return candidates.join(seen.select(*keys).distinct(), keys, "left_anti")


def semi_join_vocabulary(tokens: DataFrame, vocab: DataFrame, key: str = "word", counts: str | None = "count") -> DataFrame:
    """Tokens whose word is in the vocabulary; the heaviest words by broadcast (``counts``: their column in ``vocab``)."""
    hot = counts if counts in vocab.columns else None
    return lookup_join(tokens, vocab.select(key, *([hot] if hot else [])), key, "left_semi", counts=hot)


def subgraph(edges: DataFrame, nodes: DataFrame, node_col: str = "id") -> DataFrame:
    """Edges with both ends in ``nodes``."""
    n = nodes.select(F.col(node_col).alias("__n")).distinct()
    return (edges.join(n, F.col("src") == F.col("__n"), "left_semi")
            .join(n, F.col("dst") == F.col("__n"), "left_semi"))


def remove_vertex_edges(edges: DataFrame, removed: DataFrame, node_col: str = "id") -> DataFrame:
    """Edges touching none of the removed vertices."""
    r = removed.select(F.col(node_col).alias("__n")).distinct()
    return (edges.join(r, F.col("src") == F.col("__n"), "left_anti")
            .join(r, F.col("dst") == F.col("__n"), "left_anti"))


def _pair_pieces(pieces: DataFrame, window: int, piece: int) -> DataFrame:
    """``pieces(doc, start, t)``: the tokens of a piece from position ``start`` on with up to ``window`` tokens that follow
    it.  (doc, pos, cpos, word, context) with pos < cpos, pos inside the piece."""
    def shifted(o: int):
        n = F.greatest(F.least(F.lit(piece), F.size("t") - o), F.lit(0))
        return F.struct(F.lit(o).alias("o"), F.arrays_zip(F.slice("t", F.lit(1), n).alias("word"), F.slice("t", F.lit(1 + o), n).alias("context")).alias("z"))

    by_offset = pieces.select("doc", "start", F.explode(F.array(*[shifted(o) for o in range(1, window + 1)])).alias("s"))
    pairs = by_offset.select("doc", "start", F.col("s.o").alias("o"), F.posexplode("s.z").alias("i", "z"))
    at = (F.col("start") + F.col("i")).cast("int")
    return pairs.select("doc", at.alias("pos"), (at + F.col("o")).alias("cpos"), "z.word", "z.context")


def forward_context_pairs(docs: DataFrame, window: int, doc="doc_id", tokens="tokens", piece: int = 1024) -> DataFrame:
    """(doc, pos, cpos, word, context) for token arrays, each pair of positions pos < cpos <= pos + window once.  A
    document is cut into pieces of ``piece`` tokens, each with the ``window`` tokens that follow it, so a row stays small
    whatever the document's length, and pairs come from slices of a piece: no join and no shuffle."""
    t = F.col(tokens)
    starts = F.when(F.size(t) > 0, F.sequence(F.lit(0), F.size(t) - 1, F.lit(piece)))
    cut = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(t, s + 1, F.lit(piece + window)).alias("t")))
    pieces = docs.select(F.col(doc).alias("doc"), F.explode(cut).alias("p")).select("doc", "p.start", "p.t")
    return _pair_pieces(pieces, window, piece)


def context_pairs(tokens: DataFrame, window: int, doc="doc_id", pos="pos", word="word", piece: int = 1024) -> DataFrame:
    """(word, context) pairs within ±window positions inside a document, self excluded, for token rows (positions from 0
    on without gaps).  A token goes to the piece of ``piece`` positions that holds it, and also to the piece before if
    that one's windows reach it; a piece is gathered into one array and gives its pairs there."""
    p = F.col(pos).cast("long")
    own = F.floor(p / piece)
    to = F.array_distinct(F.array(own, F.greatest(F.floor((p - window) / piece), F.lit(0))))
    if window > piece:
        raise ValueError("a window must fit into a piece")
    rows = tokens.select(F.col(doc).alias("doc"), p.alias("pos"), F.col(word).alias("word"), F.explode(to).alias("piece"))
    pieces = (rows.groupBy("doc", "piece").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("a"))
              .select("doc", (F.col("piece") * piece).alias("start"), F.transform("a", lambda x: x["word"]).alias("t")))
    return both_directions(_pair_pieces(pieces, window, piece))


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each forward pair and its mirror image."""
    same = F.struct("pos", "cpos", "word", "context")
    turned = F.struct(F.col("cpos").alias("pos"), F.col("pos").alias("cpos"), F.col("context").alias("word"), F.col("word").alias("context"))
    return pairs.select("doc", F.explode(F.array(same, turned)).alias("p")).select("doc", "p.*")


def context_pair_counts(docs: DataFrame, window: int, doc="doc_id", tokens="tokens") -> DataFrame:
    """(word, context, n) over all documents.  A forward pair counts for both of its directions, so the pair's words are put
    in order and counted once; the two rows of a count are made after the only shuffle."""
    first, second = ordered_ends("word", "context")
    once = forward_context_pairs(docs, window, doc, tokens).groupBy(first.alias("a"), second.alias("b")).agg(F.count(F.lit(1)).alias("n"))

    def row(word: str, context: str, n: Column) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(context).alias("context"), n.alias("n"))

    n = F.col("n")
    both = F.when(F.col("a").eqNullSafe(F.col("b")), F.array(row("a", "b", 2 * n))).otherwise(F.array(row("a", "b", n), row("b", "a", n)))
    return once.select(F.explode(both).alias("p")).select("p.word", "p.context", "p.n")


def ordered_ends(a: str, b: str) -> list[Column]:
    """The ends of an undirected edge in order (null first): the same two values for both of its directions."""
    first, second = F.col(a), F.col(b)
    swap = F.coalesce(first > second, second.isNull())
    return [F.when(swap, second).otherwise(first), F.when(swap, first).otherwise(second)]


def undirected_edges(edges: DataFrame, drop_self_loops: bool = True, tasks: int | None = None) -> DataFrame:
    """Each edge once, with ordered ends.  ``tasks``: rows are dealt over so many tasks, so that a task's share stays small
    whatever the reader of the shuffle would merge."""
    rows = edges.filter(F.col("src") != F.col("dst")) if drop_self_loops else edges
    src, dst = ordered_ends("src", "dst")
    rows = rows.select(src.alias("src"), dst.alias("dst"))
    return (rows.repartition(tasks, "src", "dst") if tasks else rows).distinct()


def symmetric_edges(edges: DataFrame, drop_self_loops: bool = True, tasks: int | None = None) -> DataFrame:
    """Both directions of each edge, no duplicates.  Duplicates go while an edge is still one row, so a task holds each edge
    once; the turned edges need no look-up of their own.  ``tasks``: see ``undirected_edges``."""
    same, turned = F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    both = F.when(F.col("src").eqNullSafe(F.col("dst")), F.array(same)).otherwise(F.array(same, turned))
    return undirected_edges(edges, drop_self_loops, tasks).select(F.explode(both).alias("e")).select("e.src", "e.dst")


def edge_endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()


def overlap_fraction(predicted: DataFrame, actual: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """Per user: |predicted ∩ actual| / |actual| over distinct (user, item) pairs (join + counts, no arrays)."""
    a = actual.select(user, item).distinct()
    p = predicted.select(user, item).distinct().withColumn("__hit", F.lit(1))
    return (a.join(p, [user, item], "left").groupBy(user)
            .agg((F.count("__hit") / F.count(F.lit(1))).alias("overlap")))


def set_difference(df: DataFrame, remove: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``remove`` (distinct)."""
    return df.select(*keys).distinct().join(remove.select(*keys).distinct(), keys, "left_anti")
