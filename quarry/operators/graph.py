"""Graph operators over ``edges(src, dst)`` (and optional ``vertices(id)``) DataFrames.

Iterative operators cut lineage with reliable ``checkpoint()`` (directory from
``spark.checkpoint.dir``), so a lost executor recomputes at most one round.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import mix_hash, uniform_below
from quarry.operators.bfs import BITS, levels, one_bit, set_bits, source_bits, tasks_for
from quarry.operators.biconnected import articulation_points  # noqa: F401
from quarry.operators.components import star_components
from quarry.operators.relational import edge_endpoints, ordered_ends, symmetric_edges, undirected_edges
from quarry.session import Scratch, ensure_checkpoint_dir


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ------------------------------------------------------------------ structure

def simple_graph(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Both directions present, no duplicates, no self-loops.  Here and below ``tasks`` is the number of tasks that edges are
    dealt over while duplicates go (``undirected_edges``)."""
    return symmetric_edges(edges, drop_self_loops=True, tasks=tasks)


def graph_size(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Order (number of vertices) and size (undirected edges = directed / 2) of the simple graph."""
    n_v = edge_endpoints(edges).agg(F.count(F.lit(1)).alias("n_vertices"))
    n_e = undirected_edges(edges, drop_self_loops=True, tasks=tasks).agg(F.count(F.lit(1)).alias("n_edges"))
    return n_v.crossJoin(n_e)


def self_loop_check(edges: DataFrame) -> DataFrame:
    return edges.agg(F.coalesce(F.max(F.col("src") == F.col("dst")), F.lit(False)).alias("has_self_loop"))


def has_edge(edges: DataFrame, pairs: DataFrame, a: str = "a", b: str = "b", tasks: int | None = None) -> DataFrame:
    """For each (a, b) pair: is there an edge a–b in either direction?  Edges and pairs meet by their ordered ends, so an
    edge is one row."""
    once = undirected_edges(edges, drop_self_loops=False, tasks=tasks).withColumn("__hit", F.lit(True))
    low, high = ordered_ends(a, b)
    return (pairs.select(a, b, low.alias("src"), high.alias("dst")).join(once, ["src", "dst"], "left")
            .select(a, b, F.coalesce("__hit", F.lit(False)).alias("has_edge")))


def vertex_degree(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Neighbours per vertex in the simple graph (partial aggregation absorbs hub vertices)."""
    return simple_graph(edges, tasks).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def degree_distribution(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """degree → number of vertices; isolated vertices do not appear."""
    return vertex_degree(edges, tasks).groupBy("degree").agg(F.count(F.lit(1)).alias("count"))


def degree_fraction(edges: DataFrame, k_max: int = 49, tasks: int | None = None) -> DataFrame:
    """Fraction of vertices per degree, beside the power-law baselines 1/k^2 and 1/k^3 (k = 1..k_max)."""
    dist = degree_distribution(edges, tasks)
    total = dist.agg(F.sum("count").alias("__total"))
    frac = dist.crossJoin(total).select("degree", (F.col("count") / F.col("__total")).alias("fraction"))
    ks = edges.sparkSession.range(1, k_max + 1).select(F.col("id").alias("degree"))
    return (ks.join(frac, "degree", "full")
            .select("degree", F.coalesce("fraction", F.lit(0.0)).alias("fraction"),
                    F.when(F.col("degree") <= k_max, F.pow(F.col("degree"), -2.0)).alias("power2"),
                    F.when(F.col("degree") <= k_max, F.pow(F.col("degree"), -3.0)).alias("power3")))


# ------------------------------------------------------------------ components

def keyed_components(edges: DataFrame, nodes: DataFrame, key: str = "grp") -> DataFrame:
    """Connected components of many graphs at once: ``edges(key, src, dst)``, ``nodes(key, id)``.  Returns
    ``(key, id, component)`` with component = smallest id reachable; a vertex without edges is its own.

    Alternating star steps run until the edges stop changing (see ``components``); rounds grow with the logarithm of
    the vertex count, whatever the order of ids along a path."""
    comp = star_components(edges, (key,))
    return (nodes.select(key, "id").distinct().join(comp, [key, "id"], "left")
            .select(key, "id", F.coalesce("component", "id").alias("component")))


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Component label (smallest vertex id in the component) per vertex."""
    sym = symmetric_edges(edges, drop_self_loops=True).withColumn("grp", F.lit(0))
    nodes = (vertices.select("id") if vertices is not None else edge_endpoints(edges)).withColumn("grp", F.lit(0))
    return keyed_components(sym, nodes).select("id", "component")


def component_count(components: DataFrame) -> DataFrame:
    return components.agg(F.count_distinct("component").alias("n_components"))


# ------------------------------------------------------------------ distances

#: Leaves of a vertex that are one row, about, when pairs are made.
LEAVES_PER_ROW = 1024
#: The least share of leaves among the vertices that are left out of a search.
LEAVES_SHARE = 0.75


def _without_leaves(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(links without those of leaves, leaves ``(id, anchor)``; None if there are few).  A leaf's one link in and one link out
    are of the same vertex, its anchor, which is no leaf itself: all its paths are the anchor's and one step more."""
    links = scratch.write(edges.filter("src <> dst").select("src", "dst").distinct(), "edges")
    one = F.lit(1)
    ends = links.select(F.col("src").alias("id"), F.col("dst").alias("nbr"), one.alias("out")).unionByName(links.select(F.col("dst").alias("id"), F.col("src").alias("nbr"), F.lit(0).alias("out")))
    ends = ends.groupBy("id").agg(F.min("nbr").alias("anchor"), F.max("nbr").alias("last"), F.count(one).alias("n"), F.sum("out").alias("out"))
    ends = scratch.write(ends.select("id", "anchor", F.expr("anchor = last and n = 2 and out = 1").alias("one")), "ends")
    n_vertices, ends = ends.count(), ends.filter("one").select("id", "anchor")
    leaves = scratch.write(ends.join(ends.select(F.col("id").alias("anchor")), "anchor", "left_anti").select("id", "anchor"), "leaves")
    scratch.drop("ends")
    if leaves.count() < max(1, LEAVES_SHARE * n_vertices):
        return links, None
    core = links.join(leaves.select(F.col("id").alias("src")), "src", "left_anti").join(leaves.select(F.col("id").alias("dst")), "dst", "left_anti")
    return scratch.write(core.select("src", "dst"), "core"), leaves


def _dealt(members: DataFrame, key: str, ids: str) -> DataFrame:
    """``members(anchor, away, id)`` -> (anchor, away, key, ids): about ``LEAVES_PER_ROW`` of them a row."""
    most = members.groupBy("anchor", "away").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    share = F.pmod(F.xxhash64("id"), F.lit(-(-most // LEAVES_PER_ROW)).cast("long"))
    return members.groupBy("anchor", "away", share.alias(key)).agg(F.collect_list("id").alias(ids))


def shortest_path_lengths(edges: DataFrame, landmarks: DataFrame, max_levels: int | None = None) -> DataFrame:
    """Hop counts ``(id, landmark, distance)`` from every vertex to every landmark along edge direction; 0 to itself;
    unreachable pairs absent.  Breadth-first over reversed edges, 64 landmarks a row (``bfs``), until a level finds nothing
    new (or ``max_levels``); a pair becomes a row only in the result.  Leaves stay out of the search: their distances are
    those of their anchors and one more at each end that is a leaf."""
    scratch = Scratch(edges.sparkSession, "distances")
    links, leaves = _without_leaves(edges, scratch)
    marks = landmarks
    if leaves is not None:
        anchored = landmarks.select("id").distinct().join(leaves, "id", "left")
        anchored = scratch.write(anchored.select("id", F.coalesce("anchor", "id").alias("anchor"), F.col("anchor").isNotNull().cast("int").alias("away")), "marks")
        marks = anchored.select(F.col("anchor").alias("id"))
    sources = source_bits(marks, scratch)
    found = [front.select("node", "word", "fresh", F.lit(d).alias("distance"))
             for d, _, front in levels(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")), sources, scratch, max_levels)]
    scratch.finish("sources", "level-0", "leaves", "marks", *(f"front-{d}" for d in range(len(found))))
    if not found:
        return landmarks.select("id", F.col("id").alias("landmark"), F.lit(0).alias("distance")).limit(0)
    found = reduce(DataFrame.unionByName, found)
    landmark = F.max(F.struct(F.lit(True).alias("known"), F.col("id").alias("landmark")))
    names = sources.groupBy("word").pivot("bit", list(range(BITS))).agg(landmark)
    names = names.select("word", F.array(*[F.col(str(b)) for b in range(BITS)]).alias("names"))    # a word meets its 64 landmarks as one row
    tasks = tasks_for(found.count())
    if tasks:
        found, names = found.repartition(tasks, "word"), names.repartition(tasks, "word")
    rows = found.join(names, "word").select(F.col("node").alias("id"), "names", F.explode(set_bits("fresh")).alias("bit"), "distance")
    rows = rows.select("id", F.col("names")[F.col("bit")]["landmark"].alias("landmark"), "distance")
    return rows if leaves is None else _with_leaves(rows, links, leaves, anchored, max_levels)


def _with_leaves(rows: DataFrame, links: DataFrame, leaves: DataFrame, marks: DataFrame, max_levels: int | None) -> DataFrame:
    """Distances between anchors to those between all vertices and the landmarks ``marks(id, anchor, away)``.  Leaves of an
    anchor are rows of many, and only numbers of such rows meet before the last two joins."""
    ends = rows.select(F.col("id").alias("anchor")).distinct().select(F.col("anchor").alias("id"), "anchor", F.lit(0).alias("away"))
    ids = _dealt(ends.unionByName(leaves.select("id", "anchor", F.lit(1).alias("away"))), "i", "ids").withColumnsRenamed({"anchor": "a", "away": "from"})
    ends = _dealt(marks, "j", "marks").withColumnsRenamed({"anchor": "b", "away": "to"})
    pairs = rows.withColumnsRenamed({"id": "a", "landmark": "b"}).join(ids.select("a", "from", "i"), "a").join(ends.select("b", "to", "j"), "b")
    both = pairs.join(ids, ["a", "from", "i"]).join(ends, ["b", "to", "j"]).select("ids", "marks", (F.col("distance") + F.col("from") + F.col("to")).alias("far"))
    both = both.select(F.explode("ids").alias("id"), "marks", "far").select("id", F.explode("marks").alias("landmark"), "far")
    out = both.select("id", "landmark", F.when(F.col("id") == F.col("landmark"), 0).otherwise(F.col("far")).alias("distance"))
    if max_levels is not None:
        out = out.filter(F.col("distance") <= max_levels)
    return out.unionByName(marks.filter("id is null").select("id", F.col("id").alias("landmark"), F.lit(0).alias("distance")))


def closeness_centrality(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Per landmark (every vertex): 1 / Σ distance to it; unreachable ignored; Σ = 0 → Infinity.  The sources whose
    paths end at a vertex are bits of its rows; a level adds its number times the count of new bits, so there is no row
    for a pair of vertices.  Leaves stay out of the search: an anchor counts as often as it has leaves and once more, and a
    leaf's sum is its anchor's and a step more from everywhere else."""
    nodes = (vertices.select("id") if vertices is not None else edge_endpoints(edges)).distinct()
    scratch, last = Scratch(edges.sparkSession, "closeness"), None
    links, leaves = _without_leaves(edges, scratch)
    ends = edge_endpoints(edges).unionByName(nodes)
    if leaves is not None:
        ends = ends.join(leaves, "id", "left_anti")
    sources, fronts = source_bits(ends, scratch), []
    for d, last, front in levels(links, sources, scratch):
        fronts.append(front.select("node", "word", "fresh", F.lit(d).cast("long").alias("d")))
    if last is None:
        return nodes.select("id", F.lit(float("inf")).alias("closeness"))
    if leaves is None:
        total = last.groupBy(F.col("node").alias("id")).agg(F.sum("total").cast("double").alias("__s"))
    else:
        total = _weighted_totals(reduce(DataFrame.unionByName, fronts), sources, leaves)
        total = scratch.write(total, "totals")
        of_leaves = leaves.join(total.withColumnRenamed("id", "anchor"), "anchor").select("id", (F.col("s") + F.col("reached") - 2).alias("s"))
        total = total.select("id", "s").unionByName(of_leaves).select("id", F.col("s").cast("double").alias("__s"))
    near = nodes.join(total, "id").select("id", F.when(F.col("__s") == 0, F.lit(float("inf"))).otherwise(F.pow("__s", -1.0)).alias("closeness"))
    near = scratch.write(near, "result")
    scratch.finish("result")
    return near


def _weighted_totals(fronts: DataFrame, sources: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(id, s, reached)``: the sum of the distances from all vertices, leaves too, and how many there are.  A source weighs
    its leaves and itself; the sources of a word whose weights have a binary digit are a mask, so a row counts bits a digit."""
    weights = sources.join(leaves.groupBy(F.col("anchor").alias("id")).agg(F.count(F.lit(1)).alias("n")), "id", "left").select("word", "bit", (F.coalesce("n", F.lit(0)) + 1).alias("w"))
    digits = int(weights.agg(F.max("w")).first()[0]).bit_length()
    zero = F.lit(0).cast("long")
    masks = weights.groupBy("word").agg(*[F.bit_or(F.when(F.call_function("getbit", F.col("w"), F.lit(k)) == 1, one_bit("bit")).otherwise(zero)).alias(f"m{k}") for k in range(digits)])
    weight = reduce(lambda a, b: a + b, [F.bit_count(F.col("fresh").bitwiseAND(F.col(f"m{k}"))).cast("long") * (1 << k) for k in range(digits)])
    rows = fronts.join(masks, "word").select(F.col("node").alias("id"), "d", weight.alias("w"), F.bit_count("fresh").cast("long").alias("n"))
    return rows.groupBy("id").agg((F.sum(F.col("d") * F.col("w")) + F.sum(F.col("w") - F.col("n"))).alias("s"), F.sum("w").alias("reached"))


def spread_coverage(edges: DataFrame, seeds: DataFrame, membership: DataFrame, steps: int | None = None) -> DataFrame:
    """Deterministic spread (transmission probability 1) from each seed vertex along edge direction,
    until nothing new is reached (or ``steps`` steps).  Per step: vertices reached so far (summed over seeds), split into inside
    and outside the seed's own community, and the reached fraction of all (seed, vertex) pairs.
    ``seeds(seed)``; ``membership(id, community)``.  Seeds are bits (``bfs``); a community's seeds are a mask of each word."""
    scratch = Scratch(edges.sparkSession, "spread")
    m = membership.select("id", "community")
    sources = source_bits(seeds.select(F.col("seed").alias("id")), scratch)
    masks = scratch.write(sources.join(m, "id").groupBy("word", "community").agg(F.bit_or(one_bit("bit")).alias("own")), "masks")
    known = masks.groupBy("word").agg(F.bit_or("own").alias("known"))       # seeds that are members of a community
    home = m.select(F.col("id").alias("node"), "community")
    fronts = [front.select("node", "word", "fresh", F.lit(d).alias("step")) for d, _, front in levels(edges, sources, scratch, steps)]
    if not fronts:
        return m.select(F.lit(0).alias("step"), F.lit(0).cast("long").alias("reached_inside"), F.lit(0).cast("long").alias("reached_outside"), F.lit(0.0).alias("reached_fraction")).limit(0)
    fresh = reduce(DataFrame.unionByName, fronts).join(home, "node", "left").join(known, "word", "left").join(masks, ["word", "community"], "left")
    zero = F.lit(0).cast("long")
    inside = F.bit_count(F.col("fresh").bitwiseAND(F.coalesce("own", zero)))
    both = F.when(F.col("community").isNull(), 0).otherwise(F.bit_count(F.col("fresh").bitwiseAND(F.coalesce("known", zero))))
    per = fresh.groupBy("step").agg(F.sum(inside).alias("new_inside"), F.sum(both - inside).alias("new_outside"))
    denom = seeds.agg(F.count(F.lit(1)).alias("__s")).crossJoin(m.agg(F.count(F.lit(1)).alias("__v")))
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row a step, so the un-partitioned running sum is over a tiny table
    out = scratch.write(per.crossJoin(denom)
            .select("step", F.sum("new_inside").over(w).cast("long").alias("reached_inside"),
                    F.sum("new_outside").over(w).cast("long").alias("reached_outside"),
                    ((F.sum("new_inside").over(w) + F.sum("new_outside").over(w)) / (F.col("__s") * F.col("__v")))
                    .alias("reached_fraction")), "result")
    scratch.finish("result")
    return out


# ------------------------------------------------------------------ random walks

#: Neighbours in a bucket of the neighbour table, about, and in a row of it, at most, as a power of two.
NEIGHBOURS_PER_BUCKET, ROW_BITS = 4_000_000, 6
#: Walkers that a task holds at once, about.
WALKERS_PER_BUCKET = 1_000_000


def neighbour_index(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, idx, nbr)`` with idx = 0..deg-1 in neighbour order, and ``(node, deg)``.

    Kept as rows, not arrays, and numbered without a per-node window: the symmetric edge list is
    range-sorted globally (a hub's neighbours spread over several partitions), numbered densely
    (``sequence.dense_index``), and each node's first number (a grouped minimum) is subtracted."""
    from quarry.operators.sequence import dense_index
    sym = symmetric_edges(edges, drop_self_loops=False).select(F.col("src").alias("node"), F.col("dst").alias("nbr"))
    g = _checkpoint(dense_index(sym, ["node", "nbr"], "gidx"))
    first = g.groupBy("node").agg(F.min("gidx").alias("__first"), F.count(F.lit(1)).alias("deg"))
    first = _checkpoint(first)
    idx = _checkpoint(g.join(first.select("node", "__first"), "node")
                      .select("node", (F.col("gidx") - F.col("__first")).alias("idx"), "nbr"))
    return idx, first.select("node", "deg")


def random_walks(edges: DataFrame, walks_per_node: int, walk_length: int, alpha: float = 0.0, seed: int = 0) -> DataFrame:
    """``(walk_id, start, step, node)``: ``walks_per_node`` walks of ``walk_length`` nodes from every
    node; the next node is uniform over the neighbours; with probability alpha the walk jumps back to
    its start node; a walk stops at a dead end.  Draws are seeded hashes of (walk, step), so the same
    seed gives the same walks.

    The neighbour table has a row for each ``2**ROW_BITS`` neighbours of a node, with their degrees, and is bucketed
    once, so a step is one equi-join in which only the walkers move, a hub's neighbours lie in many buckets, and neither side
    is sorted: a task holds the walkers of a bucket and reads the bucket once.  No key is hot: neighbours are mutual, so a
    row of the table is met by some ``walks_per_node`` walkers for each neighbour in it.  A walker is a row of fixed size:
    each step's positions are a table of their own, and these tables are the result."""
    idx, deg = neighbour_index(edges)
    nodes = edge_endpoints(edges)
    spark, scratch = edges.sparkSession, Scratch(edges.sparkSession, "walks")
    row, place = F.shiftright("idx", ROW_BITS), F.col("idx").bitwiseAND((1 << ROW_BITS) - 1).cast("int")
    links = idx.join(deg.select(F.col("node").alias("nbr"), F.col("deg").alias("nbr_deg")), "nbr", "left").select("node", row.alias("row"), F.struct("idx", "nbr", "nbr_deg").alias("l"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-idx.count() // NEIGHBOURS_PER_BUCKET), -(-deg.count() * walks_per_node // WALKERS_PER_BUCKET))
    rows = links.repartition(buckets, "node", "row").groupBy("node", "row").agg(F.sort_array(F.collect_list("l")).alias("l")).select("node", "row", F.col("l.nbr").alias("nbrs"), F.col("l.nbr_deg").alias("degs"))
    name = f"walk_links_{uuid.uuid4().hex}"
    (rows.write.bucketBy(buckets, "node", "row").option("path", f"{scratch.base}/links").format("parquet").saveAsTable(name))
    scratch.tables.add("links")
    try:
        table = spark.table(name)
        reps = spark.range(walks_per_node).select(F.col("id").alias("rep"))
        walk_id = (F.col("id") * walks_per_node + F.col("rep")) if _is_numeric(nodes) else \
            F.concat_ws("#", F.col("id").cast("string"), F.col("rep").cast("string"))
        start = nodes.join(deg.withColumnRenamed("node", "id"), "id", "left").crossJoin(F.broadcast(reps))
        at = scratch.write(start.select(walk_id.alias("walk_id"), F.col("id").alias("start"), F.col("deg").alias("start_deg"), F.col("id").alias("node"), "deg"), "steps/step=0")
        for step in range(1, walk_length):
            restart = uniform_below(alpha, "walk_id", F.lit(step), F.lit("restart"), seed=seed)
            pick = F.pmod(mix_hash("walk_id", F.lit(step), F.lit("pick"), seed=seed), F.col("deg"))
            pick = F.coalesce(pick, F.lit(0))         # never null, so that the join's filter for nulls needs no hash of its own
            walkers = at.filter("deg > 0").withColumn("idx", pick).select("walk_id", "start", "start_deg", "node", row.alias("row"), place.alias("place"))
            nbr, nbr_deg = F.get("nbrs", F.col("place")), F.get("degs", F.col("place"))
            moved = walkers.hint("shuffle_hash").join(table, ["node", "row"]).filter(nbr.isNotNull())
            at = scratch.write(moved.select("walk_id", "start", "start_deg", F.when(restart, F.col("start")).otherwise(nbr).alias("node"),
                                            F.when(restart, F.col("start_deg")).otherwise(nbr_deg).alias("deg")), f"steps/step={step}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    scratch.drop("links")
    schema = at.select("walk_id", "start", "node").withColumn("step", F.lit(0)).schema
    return spark.read.schema(schema).parquet(f"{scratch.base}/steps").select("walk_id", "start", "step", "node")


def _is_numeric(df: DataFrame) -> bool:
    return df.schema["id"].dataType.typeName() in ("long", "integer", "short")
