"""§2.7 graph operators: degree measures on the large bipartite graph (FIX-5), iterative operators on the
small string-keyed graph (FIX-4, recursive-CTE oracles), the typed graph (FIX-6) and random walks."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import mix_hash_sql, uniform01_sql
from quarry.operators import graph as gr
from quarry.operators import hetero
from quarry.operators import relational as rel
from quarry.plans import fixtures as fx
from quarry.plans.registry import register
from quarry.sources.tables import table

# ------------------------------------------------------------------ SQL building blocks

E5 = fx.with_sql(e0=fx.LARGE_GRAPH_SQL,
                 e="SELECT src, dst FROM e0 WHERE src <> dst UNION SELECT dst, src FROM e0 WHERE src <> dst")
E4 = ("WITH RECURSIVE " + ",\n".join([
    f"e0 AS ({fx.SMALL_GRAPH_SQL})",
    "e AS (SELECT src, dst FROM e0 WHERE src <> dst UNION SELECT dst, src FROM e0 WHERE src <> dst)",
    "v AS (SELECT src AS id FROM e0 UNION SELECT dst FROM e0)"]))
CC4 = ("r(id, lbl) AS (SELECT id, id FROM v UNION SELECT e.dst, r.lbl FROM r JOIN e ON r.id = e.src), "
       "cc AS (SELECT id, min(lbl) AS component FROM r GROUP BY id)")
SP4 = ("p(landmark, id, d) AS (SELECT id, id, 0 FROM v UNION SELECT p.landmark, e.src, p.d + 1 FROM p JOIN e "
       "ON e.dst = p.id WHERE p.d < 40), sp AS (SELECT id, landmark, min(d) AS distance FROM p GROUP BY id, landmark)")
DEG5 = "deg AS (SELECT src AS id, count(*) AS degree FROM e GROUP BY src)"


def small(spark, d):
    return fx.small_graph_edges(spark, d)


def large(spark, d):
    return fx.large_graph_edges(spark, d)


# ------------------------------------------------------------------ structure (FIX-5)

@register("simple_graph", "2.7", E5 + " SELECT src, dst FROM e")
def q_simple_graph(spark, d):
    return gr.simple_graph(large(spark, d), tasks=fx.edge_tasks(spark, d))


@register("symmetric_edges", "2.6", fx.with_sql(e0=fx.SMALL_GRAPH_SQL) +
          " SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0")
def q_symmetric_edges(spark, d):
    return rel.symmetric_edges(small(spark, d), drop_self_loops=False)


@register("edge_endpoints", "2.6", fx.with_sql(e0=fx.LARGE_GRAPH_SQL) + " SELECT src AS id FROM e0 UNION SELECT dst FROM e0")
def q_edge_endpoints(spark, d):
    return rel.edge_endpoints(large(spark, d))


@register("graph_size", "2.7", E5 + " SELECT (SELECT count(*) FROM (SELECT src FROM e0 UNION SELECT dst FROM e0)) AS n_vertices, "
          "CAST(count(*) / 2 AS BIGINT) AS n_edges FROM e")
def q_graph_size(spark, d):
    return gr.graph_size(large(spark, d), tasks=fx.edge_tasks(spark, d))


@register("self_loop_check", "2.7", fx.with_sql(e0=fx.LARGE_GRAPH_SQL) +
          " SELECT coalesce(bool_or(src = dst), false) AS has_self_loop FROM e0")
def q_self_loop_check(spark, d):
    return gr.self_loop_check(large(spark, d))


HAS_EDGE_PAIRS = ("SELECT DISTINCT l_suppkey AS a, 1000000 + l_partkey + l_linenumber % 2 AS b FROM lineitem "
                  "UNION SELECT DISTINCT 1000000 + l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 3")


@register("has_edge", "2.7", fx.with_sql(e0=fx.LARGE_GRAPH_SQL, pr=HAS_EDGE_PAIRS,
                                         e="SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0") +
          " SELECT pr.a, pr.b, e.src IS NOT NULL AS has_edge FROM pr LEFT JOIN e ON pr.a = e.src AND pr.b = e.dst")
def q_has_edge(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber")
    pairs = (li.select(F.col("l_suppkey").alias("a"), (1000000 + F.col("l_partkey") + F.col("l_linenumber") % 2).alias("b"))
             .unionByName(li.filter(F.col("l_linenumber") == 3)
                          .select((1000000 + F.col("l_partkey")).alias("a"), F.col("l_suppkey").alias("b"))))
    tasks = fx.edge_tasks(spark, d)
    return gr.has_edge(large(spark, d), pairs.repartition(tasks, "a", "b").distinct(), tasks=tasks)


@register("vertex_degree", "2.7", E5 + ", " + DEG5 + " SELECT id, degree FROM deg")
def q_vertex_degree(spark, d):
    return gr.vertex_degree(large(spark, d), tasks=fx.edge_tasks(spark, d))


@register("degree_distribution", "2.7", E5 + ", " + DEG5 + " SELECT degree, count(*) AS count FROM deg GROUP BY degree")
def q_degree_distribution(spark, d):
    return gr.degree_distribution(large(spark, d), tasks=fx.edge_tasks(spark, d))


@register("degree_fraction", "2.7", E5 + ", " + DEG5 + (
    ", dd AS (SELECT degree, count(*) AS count FROM deg GROUP BY degree), "
    "fr AS (SELECT degree, count / (SELECT sum(count) FROM dd) AS fraction FROM dd), "
    "ks AS (SELECT range AS degree FROM range(1, 50)) "
    "SELECT coalesce(ks.degree, fr.degree) AS degree, coalesce(fr.fraction, 0.0) AS fraction, "
    "CASE WHEN coalesce(ks.degree, fr.degree) <= 49 THEN pow(coalesce(ks.degree, fr.degree), -2.0) END AS power2, "
    "CASE WHEN coalesce(ks.degree, fr.degree) <= 49 THEN pow(coalesce(ks.degree, fr.degree), -3.0) END AS power3 "
    "FROM ks FULL OUTER JOIN fr ON ks.degree = fr.degree"))
def q_degree_fraction(spark, d):
    return gr.degree_fraction(large(spark, d), tasks=fx.edge_tasks(spark, d))


# ------------------------------------------------------------------ iterative (FIX-4)

@register("subgraph", "2.3", fx.with_sql(e0=fx.SMALL_GRAPH_SQL,
                                         ns="SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS id FROM nation UNION "
                                            "SELECT 'r' || CAST(r_regionkey AS VARCHAR) FROM region") +
          " SELECT src, dst FROM e0 WHERE src IN (SELECT id FROM ns) AND dst IN (SELECT id FROM ns)")
def q_subgraph(spark, d):
    ns = (table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"))
          .unionByName(table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"))))
    return rel.subgraph(small(spark, d), ns)


@register("connected_components", "2.7", E4 + ", " + CC4 + " SELECT id, component FROM cc")
def q_connected_components(spark, d):
    return gr.connected_components(small(spark, d))


@register("component_count", "2.7", E4 + ", " + CC4 + " SELECT count(DISTINCT component) AS n_components FROM cc")
def q_component_count(spark, d):
    return gr.component_count(gr.connected_components(small(spark, d)))


ART4 = E4 + ", " + (
    "deg AS (SELECT src AS id, count(*) AS d FROM e GROUP BY src), "
    "cand AS (SELECT id AS rem FROM deg WHERE d >= 2), "
    "r2(rem, id, lbl) AS (SELECT c.rem, v.id, v.id FROM cand c, v WHERE v.id <> c.rem "
    "UNION SELECT r2.rem, e.dst, r2.lbl FROM r2 JOIN e ON r2.id = e.src WHERE e.dst <> r2.rem AND e.src <> r2.rem), "
    "lab AS (SELECT rem, id, min(lbl) AS comp FROM r2 GROUP BY rem, id), "
    "pieces AS (SELECT e.src AS rem, count(DISTINCT lab.comp) AS p FROM e JOIN lab ON lab.rem = e.src AND lab.id = e.dst "
    "WHERE e.src IN (SELECT rem FROM cand) GROUP BY e.src) "
    "SELECT v.id, CASE WHEN p >= 2 THEN 1 ELSE 0 END AS articulation FROM v LEFT JOIN pieces ON v.id = pieces.rem")


@register("articulation_points", "2.7", ART4)
def q_articulation_points(spark, d):
    return gr.articulation_points(small(spark, d))


@register("shortest_path_lengths", "2.7", E4 + ", " + SP4 + " SELECT id, landmark, distance FROM sp")
def q_shortest_path_lengths(spark, d):
    e = gr.simple_graph(small(spark, d))
    return gr.shortest_path_lengths(e, rel.edge_endpoints(e))


@register("closeness_centrality", "2.7", E4 + ", " + SP4 +
          " SELECT landmark AS id, CASE WHEN sum(distance) = 0 THEN 'Infinity'::DOUBLE ELSE "
          "pow(CAST(sum(distance) AS DOUBLE), -1.0) END AS closeness FROM sp GROUP BY landmark")
def q_closeness_centrality(spark, d):
    return gr.closeness_centrality(gr.simple_graph(small(spark, d)))


# ------------------------------------------------------------------ spread coverage on the attributed graph (FIX-7)

def _spread_sql():
    return ("WITH RECURSIVE " + ",\n".join([
        f"e0 AS ({fx.ATTR_EDGES_SQL})",
        "e AS (SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0)",
        f"m AS ({fx.MEMBERSHIP_SQL})",
        "seeds AS (SELECT min(id) AS seed FROM m GROUP BY community)",
        "p(seed, id, d) AS (SELECT seed, seed, 0 FROM seeds UNION SELECT p.seed, e.dst, p.d + 1 FROM p JOIN e "
        "ON e.src = p.id WHERE p.d <= (SELECT count(*) FROM m))",
        "r AS (SELECT seed, id, min(d) AS step FROM p GROUP BY seed, id)",
        "per AS (SELECT step, sum(CASE WHEN m.community = ms.community THEN 1 ELSE 0 END) AS ni, "
        "sum(CASE WHEN m.community <> ms.community THEN 1 ELSE 0 END) AS no FROM r JOIN m ON r.id = m.id "
        "JOIN m ms ON r.seed = ms.id GROUP BY step)"]) +
        " SELECT step, CAST(sum(ni) OVER w AS BIGINT) AS reached_inside, CAST(sum(no) OVER w AS BIGINT) AS reached_outside, "
        "(sum(ni) OVER w + sum(no) OVER w) / ((SELECT count(*) FROM seeds) * (SELECT count(*) FROM m)) AS reached_fraction "
        "FROM per WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


@register("spread_coverage", "2.7", _spread_sql())
def q_spread_coverage(spark, d):
    m = fx.base_membership(spark, d)
    seeds = m.groupBy("community").agg(F.min("id").alias("seed")).select("seed")
    e = rel.symmetric_edges(fx.attributed_edges(spark, d), drop_self_loops=False)
    return gr.spread_coverage(e, seeds, m)


# ------------------------------------------------------------------ typed graph (FIX-6) and walks

def typed_graph(spark, d):
    return hetero.heterogeneous_graph(fx.movies(spark, d), fx.directors(spark, d), fx.actors(spark, d),
                                      fx.genres(spark, d), fx.ratings(spark, d),
                                      ["l_orderkey", "l_linenumber", "l_suppkey", "rating"])


def _hetero_sql():
    return fx.with_sql(
        mv=fx.MOVIES_SQL, di=fx.DIRECTORS_SQL, ac=fx.ACTORS_SQL, ge=fx.GENRES_SQL, ra=fx.RATINGS_SQL,
        r="SELECT 'u' || CAST(user_id AS VARCHAR) AS u, 'm' || CAST(movie_id AS VARCHAR) AS m, "
          "CAST(round(arg_max(rating, (l_orderkey, l_linenumber, l_suppkey, rating))) AS INTEGER) AS star FROM ra GROUP BY user_id, movie_id",
        m="SELECT 'm' || CAST(movie_id AS VARCHAR) AS m FROM mv",
        und="SELECT 'node:' || 'm' || CAST(movie_id AS VARCHAR) AS a, 'node:' || arg_max(director, line_no) AS b FROM di "
            "WHERE 'm' || CAST(movie_id AS VARCHAR) IN (SELECT m FROM m) GROUP BY movie_id "
            "UNION ALL SELECT 'node:' || m, 'node:' || m || '_' || CAST(s AS VARCHAR) FROM m, range(1, 6) t(s) "
            "UNION ALL SELECT 'node:m' || CAST(movie_id AS VARCHAR), 'node:' || actor FROM ac "
            "WHERE 'm' || CAST(movie_id AS VARCHAR) IN (SELECT m FROM m) "
            "UNION ALL SELECT 'node:m' || CAST(movie_id AS VARCHAR), 'node:' || genre FROM ge "
            "WHERE 'm' || CAST(movie_id AS VARCHAR) IN (SELECT m FROM m) "
            "UNION ALL SELECT 'node:' || u, 'node:' || m || '_' || CAST(star AS VARCHAR) FROM r WHERE m IN (SELECT m FROM m)")


HETERO_SQL = _hetero_sql()


@register("heterogeneous_graph", "2.7", HETERO_SQL + " SELECT a AS src, b AS dst FROM und UNION SELECT b, a FROM und")
def q_heterogeneous_graph(spark, d):
    return typed_graph(spark, d)[1]


@register("heterogeneous_nodes", "2.7", HETERO_SQL + (
    " SELECT type, count(*) AS n_nodes FROM (SELECT DISTINCT * FROM ("
    "SELECT 'node:' || u AS id, u AS name, 'user' AS type FROM r UNION ALL SELECT 'node:' || m, m, 'movie' FROM m "
    "UNION ALL SELECT 'node:' || director, director, 'director' FROM di UNION ALL SELECT 'node:' || actor, actor, 'actor' FROM ac "
    "UNION ALL SELECT 'node:' || genre, genre, 'genre' FROM ge "
    "UNION ALL SELECT 'node:' || m || '_' || CAST(s AS VARCHAR), m || '_' || CAST(s AS VARCHAR), 'rating' FROM m, range(1, 6) t(s))) "
    "GROUP BY type"))
def q_heterogeneous_nodes(spark, d):
    return typed_graph(spark, d)[0].groupBy("type").agg(F.count(F.lit(1)).alias("n_nodes"))


WALKS_PER_NODE, WALK_LENGTH, ALPHA, WALK_SEED = 10, 40, 0.1, 42
_RESTART = uniform01_sql("w.walk_id", "w.step + 1", "'restart'", seed=WALK_SEED)
_PICK = mix_hash_sql("w.walk_id", "w.step + 1", "'pick'", seed=WALK_SEED)
WALKS_SQL = "WITH RECURSIVE " + ",\n".join([
    f"e0 AS ({fx.LARGE_GRAPH_SQL})",
    "e AS (SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0)",
    "nb AS (SELECT src AS node, dst AS nbr, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS idx, count(*) OVER (PARTITION BY src) AS deg FROM e)",
    "dg AS (SELECT DISTINCT node, deg FROM nb)",
    f"w AS (SELECT node * {WALKS_PER_NODE} + r AS walk_id, node AS start, 0 AS step, node FROM dg, range({WALKS_PER_NODE}) t(r) "
    f"UNION ALL SELECT w.walk_id, w.start, w.step + 1, CASE WHEN {_RESTART} < {ALPHA} THEN w.start ELSE nb.nbr END FROM w "
    f"JOIN dg ON dg.node = w.node JOIN nb ON nb.node = w.node AND nb.idx = {_PICK} % dg.deg WHERE w.step < {WALK_LENGTH - 1})"])


def walks(spark, d):
    return gr.random_walks(large(spark, d), WALKS_PER_NODE, WALK_LENGTH, alpha=ALPHA, seed=WALK_SEED)


@register("random_walks", "2.7", WALKS_SQL + " SELECT walk_id, start, step, node FROM w")
def q_random_walks(spark, d):
    return walks(spark, d)
