"""Fixtures: the reference's inputs mapped onto the driver's tables (FIX-1 … FIX-14).

Every fixture is defined twice, as a DataFrame builder and as SQL text with the same meaning, so a
query and its oracle start from the same rows.  The fixture definitions (moduli, offsets, label
rules) are part of the test-data contract, not filters to make anything cheaper.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.arrays import as_double_array
from quarry.sources.tables import table


def with_sql(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())


# ---------------------------------------------------------------- FIX-1 plays, FIX-2 aliases / names

def plays(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                    F.col("l_quantity").cast("long").alias("plays")))


PLAYS_SQL = ("SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(trunc(l_quantity) AS BIGINT) AS plays "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def aliases(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey")
    return p.filter(F.col("p_partkey") % 7 == 3).select(
        F.col("p_partkey").alias("bad_id"), (F.col("p_partkey") - 3).alias("good_id"),
        F.col("p_partkey").alias("line_no"))


ALIASES_SQL = "SELECT p_partkey AS bad_id, p_partkey - 3 AS good_id, p_partkey AS line_no FROM part WHERE p_partkey % 7 = 3"


def item_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))


NAMES_SQL = "SELECT p_partkey AS item_id, p_name AS name FROM part"


# ---------------------------------------------------------------- FIX-3 grades

GRADE_COL = "Grade /100"
TIME_COL = "Time taken"


def grades(spark: SparkSession, d: str) -> DataFrame:
    """Quiz rows: a duration string (null every 17th id), a score string with '-' marks, duplicates."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    base = e.select(
        F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("quiz"),
        F.lit("Finished").alias("State"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat((F.col("event_id") % 30).cast("string"), F.lit(" mins "),
                            (F.col("event_id") % 60).cast("string"), F.lit(" secs"))).alias(TIME_COL),
        F.when(F.col("event_id") % 11 == 0, F.lit("-"))
        .otherwise(F.round("value", 2).cast("string")).alias(GRADE_COL))
    return base.unionByName(base.filter(F.col("id") % 13 == 0))


GRADES_SQL = (
    "SELECT event_id AS id, user_id, event_type AS quiz, 'Finished' AS \"State\", "
    "CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat(CAST(event_id % 30 AS VARCHAR), ' mins ', "
    "CAST(event_id % 60 AS VARCHAR), ' secs') END AS \"Time taken\", "
    "CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(round(value, 2) AS VARCHAR) END AS \"Grade /100\" "
    "FROM events WHERE TRUE "
    "UNION ALL SELECT event_id AS id, user_id, event_type AS quiz, 'Finished' AS \"State\", "
    "CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat(CAST(event_id % 30 AS VARCHAR), ' mins ', "
    "CAST(event_id % 60 AS VARCHAR), ' secs') END AS \"Time taken\", "
    "CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(round(value, 2) AS VARCHAR) END AS \"Grade /100\" "
    "FROM events WHERE event_id % 13 = 0")


# ---------------------------------------------------------------- FIX-4 small string-keyed graph

def small_graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Region–nation, nation–supplier and nation i – nation i+1 (i % 5 = 0) edges, one direction each."""
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    rn = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("src"),
                  F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("dst"))
    ns = s.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("src"),
                  F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("dst"))
    nn = (n.alias("a").join(n.alias("b"), F.col("b.n_nationkey") == F.col("a.n_nationkey") + 1)
          .filter(F.col("a.n_nationkey") % 5 == 0)
          .select(F.concat(F.lit("n"), F.col("a.n_nationkey").cast("string")).alias("src"),
                  F.concat(F.lit("n"), F.col("b.n_nationkey").cast("string")).alias("dst")))
    return rn.unionByName(ns).unionByName(nn)


SMALL_GRAPH_SQL = (
    "SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS src, 'n' || CAST(n_nationkey AS VARCHAR) AS dst FROM nation "
    "UNION ALL SELECT 'n' || CAST(s_nationkey AS VARCHAR), 's' || CAST(s_suppkey AS VARCHAR) FROM supplier "
    "UNION ALL SELECT 'n' || CAST(a.n_nationkey AS VARCHAR), 'n' || CAST(b.n_nationkey AS VARCHAR) "
    "FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1 WHERE a.n_nationkey % 5 = 0")


# ---------------------------------------------------------------- FIX-5 large bipartite graph

#: Rows of lineitem whose edges one task deduplicates, about.
ROWS_PER_TASK = 1_000_000


def edge_tasks(spark: SparkSession, d: str) -> int:
    """Tasks for duplicates of lineitem's edges; the number of rows is in the file's footer."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, d, "lineitem").count() // ROWS_PER_TASK))


def large_graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Rows are dealt by edge before duplicates go, over as many tasks as their number asks for: a split of a file of small
    rows holds many millions of edges, and a task's table of them would grow with the file."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey")
    edges = li.select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + 1000000).alias("dst"))
    return edges.repartition(edge_tasks(spark, d), "src", "dst").distinct()


LARGE_GRAPH_SQL = "SELECT DISTINCT l_suppkey AS src, l_partkey + 1000000 AS dst FROM lineitem"


# ---------------------------------------------------------------- FIX-6 typed records

def movies(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))


def directors(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("movie_id"), F.col("p_brand").alias("director"),
                                          F.col("p_partkey").alias("line_no"))


def actors(spark, d):
    return (table(spark, d, "lineitem").select(F.col("l_partkey").alias("movie_id"),
                                               F.col("l_suppkey").cast("string").alias("actor")).distinct())


def genres(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("movie_id"), F.col("p_type").alias("genre"))


def ratings(spark, d):
    """user, movie, rating and a line order (for "last rating wins")."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"),
                    (1 + F.col("l_quantity") % 5).alias("rating"),
                    F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")))


MOVIES_SQL = "SELECT p_partkey AS movie_id, p_name AS title FROM part"
DIRECTORS_SQL = "SELECT p_partkey AS movie_id, p_brand AS director, p_partkey AS line_no FROM part"
ACTORS_SQL = "SELECT DISTINCT l_partkey AS movie_id, CAST(l_suppkey AS VARCHAR) AS actor FROM lineitem"
GENRES_SQL = "SELECT p_partkey AS movie_id, p_type AS genre FROM part"
RATINGS_SQL = ("SELECT o_custkey AS user_id, l_partkey AS movie_id, 1 + fmod(l_quantity, 5) AS rating, "
               "l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


# ---------------------------------------------------------------- FIX-7 attributed graph

def attributes(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), as_double_array("embedding").alias("attr"), "label")


def attributed_edges(spark, d):
    """i – i+1 inside a block of ten, and i – i+7 when the labels agree (one direction each)."""
    e = table(spark, d, "embeddings").select("vec_id", "label")
    a, b = e.alias("a"), e.alias("b")
    step1 = (a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1)
             .filter(F.floor(F.col("a.vec_id") / 10) == F.floor(F.col("b.vec_id") / 10))
             .select(F.col("a.vec_id").alias("src"), F.col("b.vec_id").alias("dst")))
    step7 = (a.join(b, (F.col("b.vec_id") == F.col("a.vec_id") + 7) & (F.col("a.label") == F.col("b.label")))
             .select(F.col("a.vec_id").alias("src"), F.col("b.vec_id").alias("dst")))
    return step1.unionByName(step7).distinct()


def base_membership(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"),
                                                F.floor(F.col("vec_id") / 10).cast("long").alias("community"))


ATTR_EDGES_SQL = ("SELECT DISTINCT * FROM (SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b "
                  "ON b.vec_id = a.vec_id + 1 WHERE floor(a.vec_id / 10) = floor(b.vec_id / 10) "
                  "UNION ALL SELECT a.vec_id, b.vec_id FROM embeddings a JOIN embeddings b "
                  "ON b.vec_id = a.vec_id + 7 AND a.label = b.label)")
MEMBERSHIP_SQL = "SELECT vec_id AS id, CAST(floor(vec_id / 10) AS BIGINT) AS community FROM embeddings"


# ---------------------------------------------------------------- FIX-8 regression rows

def regression_rows(spark, d):
    """x = embedding as doubles, y = label; role = query (id % 10 = 0) or train."""
    e = table(spark, d, "embeddings")
    role = F.when(F.col("vec_id") % 10 == 0, F.lit("query")).otherwise(F.lit("train"))
    return e.select(F.col("vec_id").alias("row_id"), as_double_array("embedding").alias("x"),
                    F.col("label").cast("double").alias("y"), role.alias("role"))


def lineitem_xy(spark, d):
    """Scalar regression rows: l_extendedprice on l_quantity and l_discount."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_quantity", "l_discount", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("l_quantity").alias("x1"), (F.col("l_discount") + 0.0).alias("x2"),
                     F.col("l_extendedprice").alias("y"))


LINEITEM_XY_SQL = ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x1, l_discount + 0.0 AS x2, "
                   "l_extendedprice AS y FROM lineitem")


# ---------------------------------------------------------------- FIX-9 auctions

def auctions(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("competitive"),
                    F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
                    F.col("o_totalprice").alias("total_price"), F.col("c_acctbal").alias("acct_bal")))


AUCTIONS_SQL = ("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS competitive, "
                "o_orderpriority AS priority, c_mktsegment AS segment, o_totalprice AS total_price, "
                "c_acctbal AS acct_bal FROM orders JOIN customer ON o_custkey = c_custkey")


# ---------------------------------------------------------------- FIX-10 labelled documents

def labelled_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    lab = table(spark, d, "labels").select("doc_id", "quality")
    return (docs.join(lab, "doc_id")
            .select("doc_id", "text", F.col("quality").alias("label"),
                    F.when(F.col("doc_id") % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split")))


LABELLED_DOCS_SQL = ("SELECT d.doc_id, d.text, l.quality AS label, CASE WHEN d.doc_id % 5 = 0 THEN 'test' "
                     "ELSE 'train' END AS split FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


# ---------------------------------------------------------------- FIX-12 word vectors

def word_vectors_table(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"),
                    as_double_array("embedding").alias("vec"),
                    (1000 - F.col("vec_id") % 997).alias("count"), "vec_id", "label")


WORD_VECTORS_SQL = ("SELECT 'w' || CAST(vec_id AS VARCHAR) AS word, CAST(embedding AS DOUBLE[]) AS vec, "
                    "1000 - vec_id % 997 AS count, vec_id, label FROM embeddings")


# ---------------------------------------------------------------- FIX-13 bids

def bids(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_discount")
    return (li.groupBy(F.col("l_suppkey").alias("advertiser"), (F.col("l_partkey") % 100).alias("keyword"))
            .agg((F.max(F.col("l_discount") + 0.0) + 0.1).alias("bid")))


def budgets(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return s.select(F.col("s_suppkey").alias("advertiser"),
                    (F.greatest(F.col("s_acctbal"), F.lit(0.0)) / 500).alias("budget"))


def arrivals(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("query_id"), "o_orderdate", (F.col("o_orderkey") % 100).alias("keyword"))


BIDS_SQL = ("SELECT l_suppkey AS advertiser, l_partkey % 100 AS keyword, max(l_discount + 0.0) + 0.1 AS bid "
            "FROM lineitem GROUP BY 1, 2")
BUDGETS_SQL = "SELECT s_suppkey AS advertiser, greatest(s_acctbal, 0.0) / 500 AS budget FROM supplier"
ARRIVALS_SQL = "SELECT o_orderkey AS query_id, o_orderdate, o_orderkey % 100 AS keyword FROM orders"


# ---------------------------------------------------------------- FIX-14 pixels

def pixels(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                            "l_returnflag", "l_discount")
    return li.select(F.col("l_suppkey").alias("image_id"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("truth"),
                     F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("predicted"))


PIXELS_SQL = ("SELECT l_suppkey AS image_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS truth, "
              "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS predicted FROM lineitem")


# ---------------------------------------------------------------- FIX-1 with row keys, canonicalised

def keyed_plays(spark: SparkSession, d: str) -> DataFrame:
    """Plays with the lineitem row key (l_orderkey, l_linenumber, l_partkey, l_suppkey), which is unique."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                    F.col("l_quantity").cast("long").alias("plays")))


KEYED_PLAYS_SQL = ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS user_id, l_partkey AS item_id, "
                   "CAST(trunc(l_quantity) AS BIGINT) AS plays FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
CANON_SQL = ("SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey, p.user_id, "
             "coalesce(a.good_id, p.item_id) AS item_id, p.plays FROM kp p LEFT JOIN "
             "(SELECT bad_id, arg_max(good_id, line_no) AS good_id FROM al GROUP BY bad_id) a ON p.item_id = a.bad_id")
