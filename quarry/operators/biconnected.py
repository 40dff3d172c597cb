"""Articulation points by biconnectivity: spanning forest, Euler tour, low and high values, components of the skeleton.

After Tarjan and Vishkin (1985), with the skeleton of Dong et al. (2023), for any rooted spanning forest:

1. a spanning forest by rounds in which each part takes its smallest edge to another part (Boruvka);
2. the Euler tour of the forest's arcs, ranked by pointer jumping, which gives each vertex its first and last place;
3. for each subtree the lowest and highest first place that a non-tree edge reaches from it, as range minima over places
   in blocks of blocks;
4. a tree edge whose subtree has no edge out of the parent's subtree is a fence; vertices joined by other tree edges and
   by edges between unrelated vertices live in one component of the skeleton, and each component, with the parent above
   it (behind a fence, in another component), is a biconnected component.  A vertex is an articulation point iff it is in
   two of them.

Every round reads and writes O(E) rows in equi-joins and grouped aggregates; the number of rounds grows with the logarithm
of the graph.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.components import star_components
from quarry.operators.relational import edge_endpoints, symmetric_edges
from quarry.operators.sequence import dense_index
from quarry.session import Scratch

#: Places in a block of the range minima.
BLOCK = 64


def spanning_forest(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``edges(u, v)``, both directions, no loops, integer ids.  Returns the forest's edges (u < v) and (id, root): a
    vertex of each vertex's tree, the same for the whole tree."""
    between = scratch.write(edges.select(F.col("u").alias("cu"), F.col("v").alias("cv"), F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "between-0")
    chosen, maps, n = [], [], 0
    while not between.isEmpty():
        n += 1
        best = between.groupBy("cu").agg(F.min(F.struct("u", "v", "cv")).alias("m")).select(F.col("cu").alias("c"), "m.u", "m.v", F.col("m.cv").alias("p"))
        best = scratch.write(best, f"best-{n}")       # the order of edges is total, so only pairs can point at each other
        chosen.append(best.select("u", "v"))
        back = best.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        point = scratch.write(best.join(back, "p").select("c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p"),
                                                          F.lit(True).alias("moved")), f"point-{n}-0")
        point, jumps = _jump(point, scratch, f"point-{n}")
        maps.append(point)
        to = point.select("c", "p")
        moved = (between.join(to.toDF("cu", "pu"), "cu").join(to.toDF("cv", "pv"), "cv").filter("pu <> pv")
                 .groupBy(F.col("pu").alias("cu"), F.col("pv").alias("cv")).agg(F.min(F.struct("u", "v")).alias("m")).select("cu", "cv", "m.u", "m.v"))
        between = scratch.write(moved, f"between-{n}")
        scratch.drop(f"between-{n - 1}", *(f"point-{n}-{j}" for j in range(jumps)))
    labels = edges.select(F.col("u").alias("id")).distinct().withColumn("root", F.col("id"))
    for to in maps:                                  # one narrow table a round, names of parts that still changed
        labels = labels.join(to.select(F.col("c").alias("root"), F.col("p").alias("next")), "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    forest = reduce(DataFrame.unionByName, chosen).distinct() if chosen else edges.select("u", "v").limit(0)
    return scratch.write(forest, "forest"), scratch.write(labels, "labels")


def _jump(point: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """Pointers c -> p doubled until all end at roots; also the number of rounds."""
    n = 0
    while True:
        n += 1
        on = point.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        twice = point.select("c", "p").join(on, "p").select("c", F.col("pp").alias("p"))
        twice_on = twice.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        point = scratch.write(twice.join(twice_on, "p").select("c", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), f"{name}-{n}")   # two doublings
        if point.filter("moved").isEmpty():
            return point, n


def euler_tour(forest: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v, place, root) of each arc of the rooted forest: places run through all trees, each tree's arcs in the order
    of its tour from the root.  List ranking by pointer jumping."""
    arcs = forest.unionByName(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
    arcs = scratch.write(dense_index(arcs, ["u", "v"], "arc"), "arcs")
    ends = arcs.groupBy("u").agg(F.min("arc").alias("first"), F.max("arc").alias("last"))
    rooted = labels.filter("id = root").select(F.col("id").alias("u"), F.lit(True).alias("is_root"))
    turn = (arcs.join(ends, "u").join(rooted, "u", "left")
            .select(F.col("v").alias("u"), F.col("u").alias("v"), F.when(F.col("arc") < F.col("last"), F.col("arc") + 1).when(F.col("is_root"), None).otherwise(F.col("first")).alias("next")))
    at = scratch.write(arcs.join(turn, ["u", "v"]).select("arc", "next", F.col("next").isNotNull().cast("long").alias("left")), "list-0")
    n = 0
    while not at.filter("next IS NOT NULL").isEmpty():
        n += 1
        for _ in range(2):                           # two doublings a table
            on = at.select(F.col("arc").alias("next"), F.col("next").alias("after"), F.col("left").alias("more"))
            at = at.join(on, "next", "left").select("arc", F.col("after").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left"))
        at = scratch.write(at, f"list-{n}")
        scratch.drop(f"list-{n - 1}")
    ranked = arcs.join(at.select("arc", "left"), "arc").join(labels.select(F.col("id").alias("u"), "root"), "u")
    return scratch.write(dense_index(ranked.select("u", "v", "root", (-F.col("left")).alias("before")), ["root", "before"], "place").drop("before"), "tour")


def tree_places(tour: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, parent, root, first, last) of each vertex: the places of the arcs into it and back; of a root, around all."""
    back = tour.select(F.col("u").alias("v"), F.col("v").alias("u"), F.col("place").alias("last"))
    below = tour.join(back, ["u", "v"]).filter("place < last").select(F.col("v").alias("id"), F.col("u").alias("parent"), "root", F.col("place").alias("first"), "last")
    span = tour.groupBy("root").agg((F.min("place") - 1).alias("first"), (F.max("place") + 1).alias("last"))
    return below.unionByName(span.select(F.col("root").alias("id"), F.lit(None).cast("long").alias("parent"), "root", "first", "last"))


def range_extremes(items: DataFrame, ranges: DataFrame, scratch: Scratch) -> DataFrame:
    """``items(k, lo, hi)`` with distinct integers k, ``ranges(q, l, r)``: (q, lo, hi), the least lo and largest hi of the
    items with l <= k <= r.  Blocks of ``BLOCK`` keys answer the ends of a range; the blocks between are a range of the
    next level, whose items are the blocks."""
    found, level = [], 0
    items, ranges = items.select("k", "lo", "hi"), ranges.select("q", "l", "r")
    while True:
        block = F.floor(F.col("k") / BLOCK)
        blocks = scratch.write(items.groupBy(block.alias("b")).agg(F.collect_list(F.struct("k", "lo", "hi")).alias("a"), F.min("lo").alias("lo"), F.max("hi").alias("hi")), f"blocks-{level}")
        bl, br = F.floor(F.col("l") / BLOCK), F.floor(F.col("r") / BLOCK)
        ends = ranges.select("q", "l", "r", F.explode(F.array_distinct(F.array(bl, br))).alias("b"))
        inside = F.filter("a", lambda x: x["k"].between(F.col("l"), F.col("r")))
        hit = ends.join(blocks.select("b", "a"), "b").select("q", inside.alias("a")).filter(F.size("a") > 0)
        found.append(hit.select("q", F.array_min(F.transform("a", lambda x: x["lo"])).alias("lo"), F.array_max(F.transform("a", lambda x: x["hi"])).alias("hi")))
        ranges = scratch.write(ranges.select("q", (bl + 1).alias("l"), (br - 1).alias("r")).filter("l <= r"), f"ranges-{level}")
        if ranges.isEmpty():
            break
        items, level = blocks.select(F.col("b").alias("k"), "lo", "hi"), level + 1
    return reduce(DataFrame.unionByName, found).groupBy("q").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def articulation_points(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """1 for a vertex whose removal leaves more components than the whole graph has, else 0.  Edges count as undirected;
    loops and repeats don't matter; a vertex of degree 0 or 1 never qualifies."""
    nodes = (vertices.select("id") if vertices is not None else edge_endpoints(edges)).distinct()
    scratch = Scratch(edges.sparkSession, "biconnected")
    simple = symmetric_edges(edges, drop_self_loops=True)
    names = scratch.write(dense_index(edge_endpoints(simple), ["id"], "x"), "names")
    e = (simple.join(names.toDF("src", "u"), "src").join(names.toDF("dst", "v"), "dst").select("u", "v"))
    e = scratch.write(e, "edges")
    forest, labels = spanning_forest(e, scratch)
    places = scratch.write(tree_places(euler_tour(forest, labels, scratch), labels), "places")

    once = e.filter("u < v").join(forest, ["u", "v"], "left_anti")                       # edges outside the forest
    first = places.select("id", "first", "last")
    other = once.join(first.toDF("u", "fu", "lu"), "u").join(first.toDF("v", "fv", "lv"), "v")
    other = scratch.write(other, "other")
    reach = (other.select(F.col("u").alias("id"), F.col("fv").alias("to")).unionByName(other.select(F.col("v").alias("id"), F.col("fu").alias("to")))
             .groupBy("id").agg(F.min("to").alias("lo"), F.max("to").alias("hi")))
    below = places.filter("parent IS NOT NULL")
    items = below.join(reach, "id").select(F.col("first").alias("k"), "lo", "hi")
    extremes = range_extremes(items, below.select(F.col("id").alias("q"), F.col("first").alias("l"), F.col("last").alias("r")), scratch)
    tree = (below.join(extremes.withColumnRenamed("q", "id"), "id", "left").join(first.toDF("parent", "fp", "lp"), "parent")
            .select("id", "parent", F.coalesce((F.col("lo") < F.col("fp")) | (F.col("hi") > F.col("lp")), F.lit(False)).alias("plain")))
    tree = scratch.write(tree, "tree")

    above = (F.col("fu") <= F.col("fv")) & (F.col("lv") <= F.col("lu")) | (F.col("fv") <= F.col("fu")) & (F.col("lu") <= F.col("lv"))
    skeleton = other.filter(~above).select(F.col("u").alias("src"), F.col("v").alias("dst")).unionByName(tree.filter("plain").select(F.col("id").alias("src"), F.col("parent").alias("dst")))
    parts = star_components(skeleton)
    fences = tree.filter("NOT plain").join(parts, "id", "left").select("parent", F.coalesce("component", "id").alias("part"))
    own = parts.select(F.col("id").alias("parent"), F.col("component").alias("own"))
    heads = (fences.join(own, "parent", "left").filter(F.col("part") != F.coalesce("own", "parent"))   # else a way round the fence
             .select("parent", "part").distinct().groupBy(F.col("parent").alias("x")).agg(F.count(F.lit(1)).alias("parts")))
    roots = labels.filter("id = root").select(F.col("id").alias("x"), F.lit(1).alias("is_root"))
    cut = heads.join(roots, "x", "left").filter(F.col("parts") > F.coalesce("is_root", F.lit(0))).join(names, "x").select("id", F.lit(1).alias("cut"))
    out = scratch.write(nodes.join(cut, "id", "left").select("id", F.coalesce("cut", F.lit(0)).alias("articulation")), "result")
    scratch.finish("result")
    return out
