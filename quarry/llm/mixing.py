"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (DataFrame functions only).

Every source's documents are dealt by a hash into ``n_blocks`` blocks.  A source takes part with whole passes over all
its blocks, as often as its target holds its size, and one last pass over the first blocks of a random block order, up
to its target; the block at the edge is filled document by document.  The block draws of all sources are the quotas at
the root of a tree.  Each node gives half of its draws to its left child: it goes through its draws source by source
and lets each go left with probability (places left on the left side) / (draws left), which makes the split of the
quotas exactly multivariate hypergeometric.  The leaves are the output shards.  A source's draws, in random order, fill
its leaves one after the other, so shards hold disjoint draws; rows are then shuffled within their shard.

What runs per source (block order, draws, tree) has at most ``n_blocks`` x ``max_repeat`` rows a source, whatever the
number of documents; documents meet it in one join on (source, block), which spreads a hot source over its blocks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, WORD, materialize, text_column, with_plain_names, with_row_key


def _uniform(*key: Column) -> Column:
    """A number in [0, 1) from the key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) * F.lit(2.0 ** -53)


def source_targets(sizes: DataFrame, weights: list[float], max_repeat: int) -> DataFrame:
    """``sizes``: skey, source_size.  Adds ``target``: sources in code-point order (null last) weigh ``weights``,
    repeated; a target stops at ``max_repeat`` times its source's size, and what it leaves is shared by weight among
    the others until none is above.  That fixed point is min(cap, lambda * weight): sources are capped in the order of
    cap / weight.  One row per source here, never more."""
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy("skey")
    before = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "skey").rowsBetween(0, Window.unboundedFollowing)
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (sizes.withColumn("weight", F.get(w, (F.row_number().over(order) - 1) % len(weights)))
         .withColumn("cap", F.col("source_size") * float(max_repeat))
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("level", (F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
         .withColumn("capped", F.col("level") >= F.col("ratio"))
         .withColumn("share", F.min(F.when(~F.col("capped"), F.struct("ratio", "skey", "level"))).over(total)))
    return s.select("skey", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("share.level") * F.col("weight"))).alias("target"))


def _split(quotas: Column, node: Column, seed: int) -> Column:
    """Counts that go left, by source: a draw from the multivariate hypergeometric distribution."""
    n = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q["q"])
    zero = F.struct(n.alias("rest"), F.floor(n / 2).alias("places"), F.array().cast("array<struct<skey:string,q:bigint>>").alias("out"))

    def one_source(acc, s):
        start = F.struct(acc["rest"].alias("rest"), acc["places"].alias("places"), F.lit(0).cast("long").alias("got"))

        def one_draw(a, j):
            left = (_uniform(F.lit(seed), node, s["skey"], j) * a["rest"] < a["places"]).cast("long")
            return F.struct((a["rest"] - 1).alias("rest"), (a["places"] - left).alias("places"), (a["got"] + left).alias("got"))

        end = F.when(s["q"] > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(s["q"], F.lit(1))), start, one_draw)).otherwise(start)
        return F.transform(F.array(end), lambda e: F.struct(
            e["rest"].alias("rest"), e["places"].alias("places"),
            F.concat(acc["out"], F.array(F.struct(s["skey"].alias("skey"), e["got"].alias("q")))).alias("out")))[0]

    return F.aggregate(quotas, zero, one_source, lambda acc: acc["out"])


def splitting_tree(quotas: DataFrame, levels: int, seed: int = 0) -> DataFrame:
    """``quotas``: skey, q.  Returns shard (0 .. 2**levels - 1), skey, q: how many of a source's draws each leaf gets.
    Each half of a node gets half of its draws (the left one the smaller half)."""
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("skey", "q"))).alias("quotas")).select(F.lit(1).cast("long").alias("node"), "quotas")
    for _ in range(levels):
        halves = nodes.withColumn("left", _split(F.col("quotas"), F.col("node"), seed)).withColumn(
            "right", F.zip_with("quotas", "left", lambda a, b: F.struct(a["skey"].alias("skey"), (a["q"] - b["q"]).alias("q"))))
        nodes = halves.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
                                                F.struct((F.col("node") * 2 + 1).alias("node"), F.col("right").alias("quotas")))).alias("h")).select("h.*")
        nodes = materialize(nodes, "mix-tree")
    return nodes.select((F.col("node") - 2 ** levels).alias("shard"), F.explode("quotas").alias("x")).select("shard", "x.skey", "x.q")


def mix_plan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=(1.0, 2.0, 3.0),
             max_repeat: int = 3, n_blocks: int = 1024, shard_levels: int = 4, seed: int = 0, cut_edge: bool = True) -> DataFrame:
    """One row per input row: place, doc_id, size, source_size, target and ``copies``, an array of (copy, shard, words).

    Size is the number of words, null text and empty text 0; documents of no words follow their block.  With
    ``cut_edge`` the document at the edge of a source's target gives as many of its words as are missing; without it
    the document is taken whole if at least half of it is missing.  Null sources form one source, the last.  Rows that
    repeat are documents of their own; which of them is taken doesn't matter as they are equal.  Other columns are not
    read.  Empty table: no rows."""
    keyed = with_row_key(df)
    t = text_column(keyed, text)
    src = F.col(source).cast("string")
    docs = keyed.select(FILE, POS, F.col(doc_id).alias("doc_id"), F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src)).alias("skey"),
                        F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"),
                        F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), t).alias("h"))
    docs = materialize(docs.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(n_blocks)).cast("int")), "mix-docs")
    blocks = materialize(docs.groupBy("skey", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sources = source_targets(blocks.groupBy("skey").agg(F.sum("words").alias("source_size")), list(weights), max_repeat)
    sources = materialize(sources.withColumn("passes", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeat))).otherwise(0).cast("long"))
                          .withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "mix-sources")
    # the last pass: blocks in random order up to the rest; ``missing`` is what the edge block has to give
    order = Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed + 1), "skey", "block"), "block")
    b = (blocks.join(sources, "skey").withColumn("missing", F.col("rest") - (F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")))
         .withColumn("last", F.when((F.col("missing") > 0) & (F.col("missing") >= F.col("words")), "all").when(F.col("missing") > 0, "edge").otherwise("no")))
    draws = b.select("skey", "block", F.explode(F.concat(
        F.expr("CASE WHEN passes > 0 THEN sequence(0, cast(passes as int) - 1) ELSE cast(array() as array<int>) END"),
        F.when(F.col("last") == "no", F.array().cast("array<int>")).otherwise(F.array(F.col("passes").cast("int"))))).alias("copy"))
    mine = Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed + 2), "skey", "block", "copy"), "block", "copy")
    draws = materialize(draws.withColumn("rank", F.row_number().over(mine)), "mix-draws")
    leaves = splitting_tree(draws.groupBy("skey").agg(F.count(F.lit(1)).alias("q")), shard_levels, seed + 3)
    upto = F.sum("q").over(Window.partitionBy("skey").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    places = leaves.filter("q > 0").withColumn("upto", upto).select(
        "skey", "shard", F.explode(F.sequence((F.col("upto") - F.col("q") + 1).cast("int"), F.col("upto").cast("int"))).alias("rank"))
    placed = draws.join(places, ["skey", "rank"]).groupBy("skey", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("draws"))
    info = materialize(b.join(placed, ["skey", "block"], "left").select("skey", "block", "source_size", "target", "passes", "missing", "last", "draws"), "mix-info")
    docs = docs.join(info, ["skey", "block"])
    given = F.sum("size").over(Window.partitionBy("skey", "block").orderBy("h", "doc_id", FILE, POS).rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    edge = docs.filter("last = 'edge'").withColumn("left", F.col("missing") - given)
    part = F.greatest(F.lit(0), F.least("size", "left")) if cut_edge else F.when(F.col("left") * 2 >= F.col("size"), F.col("size")).otherwise(0)
    edge = edge.withColumn("part", F.when((F.col("left") > 0) | (F.col("size") == 0), part).otherwise(0).cast("long")).drop("left")
    both = docs.filter("last != 'edge'").withColumn("part", F.when(F.col("last") == "all", F.col("size")).otherwise(0)).unionByName(edge)
    copies = F.transform(F.coalesce("draws", F.array().cast("array<struct<copy:int,shard:bigint>>")), lambda d: F.struct(
        d["copy"].alias("copy"), d["shard"].alias("shard"), F.when(d["copy"] < F.col("passes"), F.col("size")).otherwise(F.col("part")).alias("words")))
    return both.select(FILE, POS, "doc_id", "size", "source_size", "target",
                       F.filter(copies, lambda c: (c["words"] > 0) | (F.col("size") == 0)).alias("copies"))


def mix_sources(docs: DataFrame, shards: bool = False, doc_id: str = "doc_id", text: str = "text", seed: int = 0, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each copy taken, whole texts but for a cut document at the edge of a source.
    With ``shards`` the columns ``shard`` and ``place`` are added; ordering by them shuffles within each shard."""
    plain, doc_id, text, source = with_plain_names(docs, doc_id, text, options.pop("source", "source"))
    keyed = with_row_key(plain)
    plan = mix_plan(keyed.drop(FILE, POS), doc_id=doc_id, text=text, source=source, seed=seed, **options)
    taken = plan.filter(F.size("copies") > 0).select(FILE, POS, F.col("size").alias("__size"), F.explode("copies").alias("__copy"))
    out = keyed.join(taken, [FILE, POS])
    cut = F.regexp_extract(F.col(text), r"(?s)^[\x20\x09-\x0D]*", 0)  # what stands before the first word stays
    if options.get("cut_edge", True):
        words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), 0)
        out = out.withColumn(text, F.when(F.col("__copy.words") < F.col("__size"), F.concat(
            cut, F.array_join(F.slice(words, 1, F.greatest(F.col("__copy.words"), F.lit(1)).cast("int")), ""))).otherwise(F.col(text)))
    if not shards:
        return out.select(plain.columns).toDF(*docs.columns)
    place = F.xxhash64(F.lit(seed + 4), F.col(doc_id).cast("string"), F.col(text), F.col("__copy.copy"))
    return out.select(*plain.columns, F.col("__copy.shard").alias("shard"), place.alias("place")).toDF(*docs.columns, "shard", "place")


def write_shards(mix: DataFrame, path: str) -> None:
    """Writes a mix made with ``shards=True``, one folder a shard, rows in shuffled order."""
    mix.repartition("shard").sortWithinPartitions("shard", "place").write.partitionBy("shard").parquet(path)
