"""§2.1 sources and sinks: each query writes a fixture to the scratch area (next to the checkpoint
directory) in the reference's file format and reads it back with the source under test."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as gr
from quarry.plans import fixtures as fx
from quarry.plans.graphs import DEG5, E5, HETERO_SQL, WALKS_SQL, typed_graph, walks
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.tables import table

_n = [0]


def _path(spark, name):
    _n[0] += 1
    return scratch_path(spark, f"{name}-{_n[0]}")


@register("read_delimited", "2.1", fx.PLAYS_SQL)
def q_read_delimited(spark, d):
    p = _path(spark, "plays")
    files.write_delimited(fx.plays(spark, d), p, sep=" ")
    return files.read_delimited(spark, p, "user_id long, item_id long, plays long", sep=" ").drop("_corrupt_record")


@register("read_edge_list", "2.1", fx.LARGE_GRAPH_SQL)
def q_read_edge_list(spark, d):
    p = _path(spark, "edges-large")
    e = fx.large_graph_edges(spark, d)
    # large format: space-separated pairs in as many files as there are tasks, and a count line in one of them
    head = e.agg(F.count(F.lit(1)).cast("string").alias("value"))
    body = e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    head.unionByName(body).write.mode("overwrite").text(p)
    edges, _ = files.read_edge_list(spark, p, large=True)
    return edges


@register("read_edge_vertices", "2.1", fx.with_sql(e0=fx.SMALL_GRAPH_SQL) + " SELECT src AS id FROM e0 UNION SELECT dst FROM e0")
def q_read_edge_vertices(spark, d):
    p = _path(spark, "edges-small")
    fx.small_graph_edges(spark, d).write.mode("overwrite").csv(p)
    _, v = files.read_edge_list(spark, p, large=False, id_type="string")
    return v


@register("read_adjacency_list", "2.1", fx.with_sql(e0=fx.SMALL_GRAPH_SQL) +
          " SELECT src, dst FROM e0 WHERE src <> dst UNION SELECT dst, src FROM e0 WHERE src <> dst")
def q_read_adjacency_list(spark, d):
    p = _path(spark, "adj")
    files.write_adjacency_list(gr.simple_graph(fx.small_graph_edges(spark, d)), p, max_per_line=7)
    return files.read_adjacency_list(spark, p, checked=True)


@register("read_fixed_labels", "2.1",
          "SELECT CAST(p_partkey AS VARCHAR) AS no, CASE WHEN p_size % 4 = 0 THEN '1' ELSE '0' END AS defect, "
          "'img' || CAST(p_partkey AS VARCHAR) || '.png' AS file, 'img' || CAST(p_partkey AS VARCHAR) || '_mask.png' AS mask "
          "FROM part")
def q_read_fixed_labels(spark, d):
    p = _path(spark, "labels")
    part = table(spark, d, "part").select("p_partkey", "p_size")
    rows = part.select(F.format_string("%8d %6d   %-16s %-22s", "p_partkey", F.when(F.col("p_size") % 4 == 0, 1).otherwise(0),
                                       F.concat(F.lit("img"), F.col("p_partkey").cast("string"), F.lit(".png")),
                                       F.concat(F.lit("img"), F.col("p_partkey").cast("string"), F.lit("_mask.png")))
                       .alias("value"))
    head = spark.createDataFrame([("      no defect   file             mask",)], "value string")
    head.unionByName(rows).write.mode("overwrite").text(p)
    return files.read_fixed_labels(spark, p, ["no", "defect", "file", "mask"])


@register("write_communities", "2.1", fx.MEMBERSHIP_SQL)
def q_write_communities(spark, d):
    p = _path(spark, "communities")
    files.write_communities(fx.base_membership(spark, d), p, max_per_line=4)
    return files.read_communities(spark, p)


@register("write_vectors_text", "2.1",
          "SELECT 'w' || CAST(vec_id AS VARCHAR) AS word, 1000 - vec_id % 997 AS count, "
          "round(list_sum(list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6))), 3) AS total FROM embeddings")
def q_write_vectors_text(spark, d):
    p, vp = _path(spark, "vectors"), _path(spark, "vocab")
    v = fx.word_vectors_table(spark, d)
    files.write_vectors_text(v, p, vp)
    back = files.read_vectors_text(spark, p, vp)
    return back.select("word", "count", F.round(F.aggregate(F.transform("vec", lambda x: x.cast("double")), F.lit(0.0),
                                                            lambda a, x: a + x), 3).alias("total"))


@register("read_vectors_text", "2.1",
          "SELECT 'w' || CAST(vec_id AS VARCHAR) AS word, CAST(len(embedding) AS INTEGER) AS dim, "
          "row_number() OVER (ORDER BY 1000 - vec_id % 997 DESC, 'w' || CAST(vec_id AS VARCHAR)) AS rank FROM embeddings")
def q_read_vectors_text(spark, d):
    """Without a vocabulary file the counts are vocab_size - row, so they rank rows in file order."""
    p = _path(spark, "vectors-novocab")
    files.write_vectors_text(fx.word_vectors_table(spark, d), p)
    back = files.read_vectors_text(spark, p)
    n = back.count()
    return back.select("word", F.size("vec").alias("dim"), (F.lit(n) - F.col("count") + 1).alias("rank"))


@register("write_result_csv", "2.1", E5 + ", " + DEG5 + " SELECT degree, count(*) AS count FROM deg GROUP BY degree")
def q_write_result_csv(spark, d):
    p = _path(spark, "degree-csv")
    files.write_result_csv(gr.degree_distribution(fx.large_graph_edges(spark, d), fx.edge_tasks(spark, d)), p)
    return spark.read.option("header", True).schema("degree long, count long").csv(p)


@register("write_graph_files", "2.1", HETERO_SQL + " SELECT a AS src, b AS dst FROM und UNION SELECT b, a FROM und")
def q_write_graph_files(spark, d):
    nodes, edges = typed_graph(spark, d)
    p = _path(spark, "graph")
    files.write_graph_files(nodes, edges, p)
    return files.read_adjacency_list(spark, p + "/adjlist")


@register("write_walk_corpus", "2.1", WALKS_SQL + " SELECT list(CAST(node AS VARCHAR) ORDER BY step) AS walk FROM w GROUP BY walk_id")
def q_write_walk_corpus(spark, d):
    p = _path(spark, "walks")
    files.write_walk_corpus(walks(spark, d), p)
    return files.read_walk_corpus(spark, p)


@register("file_inventory", "2.1", "SELECT 'source=' || source AS folder, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source")
def q_file_inventory(spark, d):
    """Documents written by source, one text line a document; the files' lengths by folder."""
    p = _path(spark, "by-source")
    table(spark, d, "documents").select("source", "text").write.mode("overwrite").partitionBy("source").text(p)
    return files.file_inventory(spark, p, "*.txt").groupBy("folder").agg(F.sum("length").alias("n_bytes"))


@register("read_tagged_tokens", "2.1", (
    "SELECT conv_id, turn, CAST(len(w) AS INTEGER) AS n_tokens, w[1] AS first_token FROM (SELECT conv_id, turn, "
    "list_filter(list_transform(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> ''), "
    "lambda t: CASE WHEN regexp_matches(t || '/' || upper(role), '^[^/]*/[^/]*$') AND "
    "regexp_matches(substr(upper(role), 1, 2), '^\\p{L}+$') THEN lower(split_part(t || '/' || upper(role), '/', 1)) || '/' || "
    "substr(upper(role), 1, 2) END), lambda x: x IS NOT NULL) AS w FROM conversations) WHERE len(w) > 0"))
def q_read_tagged_tokens(spark, d):
    """Conversation turns with every word tagged by the speaker role (``word/ROLE``)."""
    from quarry.functions.text import split_whitespace
    from quarry.operators.textmine import tagged_tokens
    c = table(spark, d, "conversations").select(
        "conv_id", "turn", F.transform(split_whitespace("text"), lambda t: F.concat(t, F.lit("/"), F.upper(F.col("role"))))
        .alias("tokens"))
    t = tagged_tokens(c)
    return t.select("conv_id", "turn", F.size("tokens").alias("n_tokens"), F.get("tokens", 0).alias("first_token"))


@register("read_labeled_tagged_tokens", "2.1", (
    "SELECT 'conv' || conv_id || '_SENT_' || turn AS tag, CAST(len(w) AS INTEGER) AS n_tokens, w[len(w)] AS last_token FROM (SELECT conv_id, turn, "
    "list_filter(list_transform(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> ''), "
    "lambda t: CASE WHEN regexp_matches(t || '/' || upper(role), '^[^/]*/[^/]*$') AND "
    "regexp_matches(substr(upper(role), 1, 2), '^\\p{L}+$') THEN lower(split_part(t || '/' || upper(role), '/', 1)) || '/' || "
    "substr(upper(role), 1, 2) END), lambda x: x IS NOT NULL) AS w FROM conversations) WHERE len(w) > 0"))
def q_read_labeled_tagged_tokens(spark, d):
    """Each conversation a file, each turn one of its lines."""
    from quarry.functions.text import split_whitespace
    from quarry.operators.textmine import labeled_tagged_tokens
    words = F.transform(split_whitespace("text"), lambda t: F.concat(t, F.lit("/"), F.upper(F.col("role"))))
    lines = table(spark, d, "conversations").select(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("file"),
                                                    F.col("turn").alias("line_no"), F.array_join(words, " ").alias("line"))
    t = labeled_tagged_tokens(lines)
    return t.select(F.get("tags", 0).alias("tag"), F.size("tokens").alias("n_tokens"), F.element_at("tokens", -1).alias("last_token"))
