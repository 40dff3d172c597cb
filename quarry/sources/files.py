"""File sources and sinks: delimited records, edge / adjacency lists, fixed-width labels, word lists,
vector text files, community files, graph files and walk corpora.

Writers produce ordinary partitioned output directories (``part-*`` files); readers accept a file,
a directory or a glob.  Nothing is gathered on the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import WHITESPACE_RUN, split_whitespace
from quarry.operators.sequence import dense_index
from quarry.session import Scratch, scratch_path

_counter = [0]


def scratch_text(spark: SparkSession, name: str, lines: DataFrame) -> str:
    """Write a one-column (``value``) DataFrame as text under the scratch area; return the path."""
    _counter[0] += 1
    path = scratch_path(spark, f"{name}-{_counter[0]}")
    lines.select("value").write.mode("overwrite").text(path)
    return path


def file_inventory(spark: SparkSession, directory: str, glob: str = "*", pattern: str | None = None) -> DataFrame:
    """Folder, name and length of the files under ``directory`` matching ``glob``; with ``pattern``, only the first name
    that matches the regex (or no row).  Only file metadata is read — the content column is pruned."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(directory).select(F.element_at(F.split("path", "/"), -2).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"), "length"))
    if pattern is None:
        return files.select("folder", "name", "length")
    return files.filter(F.col("name").rlike(pattern)).agg(F.min("name").alias("name"))


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """Delimited records cast by position to ``schema``; malformed rows are kept (nulls) and flagged in
    ``_corrupt_record`` rather than failing the job."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    st = st.add("_corrupt_record", "string")
    return (spark.read.schema(st).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def read_edge_list(spark: SparkSession, path: str, large: bool = False, id_type: str = "long",
                   bad_lines: str = "raise") -> tuple[DataFrame, DataFrame]:
    """``id1<delim>id2`` lines → ``(edges(src, dst), vertices(id))``.  ``large`` files are space-separated and have a
    count line, known by its shape (one field) in whichever part file it stands; otherwise comma-separated.  Blank
    lines are skipped; any other line raises, or with ``bad_lines="drop"`` is left out."""
    p = F.split(F.trim("value"), " +" if large else " *, *")
    src, dst = F.get(p, 0).try_cast(id_type), F.get(p, 1).try_cast(id_type)
    good = (F.size(p) == 2) & src.isNotNull() & dst.isNotNull()
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if large:
        lines = lines.filter(F.size(p) != 1)
    if bad_lines == "drop":
        lines = lines.filter(good)
    else:
        src = F.when(good, src).otherwise(F.raise_error(F.concat(F.lit("not an edge: "), F.substring("value", 1, 80))).cast(id_type))
    e = lines.select(src.alias("src"), dst.alias("dst"))
    v = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id"))).distinct()
    return e, v


def read_adjacency_list(spark: SparkSession, path: str, checked: bool = True) -> DataFrame:
    """``node n1 n2 …`` lines (``#`` lines skipped) → ``edges(src, dst)``; a node may span several lines.
    The checked variant removes duplicate neighbours."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    toks = lines.select(split_whitespace(F.trim("value")).alias("t")).filter(F.size("t") > 0)
    e = toks.select(F.col("t")[0].alias("src"), F.explode(F.slice("t", 2, 1 << 30)).alias("dst"))
    return e.distinct() if checked else e


def write_adjacency_list(edges: DataFrame, path: str, max_per_line: int = 10_000) -> None:
    """One line per (node, chunk of at most ``max_per_line`` neighbours): a hub's neighbours are split
    over several lines instead of one unbounded gather.  Only hubs' neighbours are numbered by a global sort."""
    scratch = Scratch(edges.sparkSession, "adjacency")
    rows = scratch.write(edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst")).filter("src IS NOT NULL"), "edges")
    hubs = scratch.write(rows.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_per_line).select("src"), "hubs")
    lines = rows.join(F.broadcast(hubs), "src", "left_anti").groupBy("src").agg(F.sort_array(F.collect_list("dst")).alias("n"))
    if not hubs.isEmpty():                                                    # at most a row for each max_per_line edges
        idx = dense_index(rows.join(F.broadcast(hubs), "src", "left_semi"), ["src", "dst"], "gidx")
        first = idx.groupBy("src").agg(F.min("gidx").alias("__f"))
        large = (idx.join(first, "src").withColumn("chunk", F.floor((F.col("gidx") - F.col("__f")) / max_per_line))
                 .groupBy("src", "chunk").agg(F.sort_array(F.collect_list(F.struct("gidx", "dst"))).alias("__n")))
        lines = lines.unionByName(large.select("src", F.transform("__n", lambda s: s["dst"]).alias("n")))
    lines.select(F.concat_ws(" ", F.col("src"), F.array_join("n", " ")).alias("value")).write.mode("overwrite").text(path)
    scratch.finish()


def read_fixed_labels(spark: SparkSession, path: str, names: list[str], skip_header: bool = True) -> DataFrame:
    """Whitespace-aligned columns → named string columns by position."""
    lines = spark.read.text(path)
    parts = lines.select(F.split(F.trim("value"), WHITESPACE_RUN).alias("p")).filter(F.col("p")[0] != "")
    if skip_header:
        parts = parts.filter(F.col("p")[0] != names[0])
    return parts.select(*[F.col("p")[i].alias(n) for i, n in enumerate(names)])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, stripped, as a set (case kept)."""
    return (spark.read.text(path).select(F.trim("value").alias("word")).filter(F.col("word") != "").distinct())


def write_vectors_text(vectors: DataFrame, path: str, vocab_path: str | None = None) -> None:
    """Header ``n dim``, then ``word v1 … vd`` (``%f``) in descending count order (ties by word); the
    optional vocabulary file holds ``word count``.  The global sort range-partitions the rows, so the
    part files concatenate in order; the header sorts first."""
    n_dim = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"))
    header = n_dim.select(F.lit(0).alias("__k"), F.lit(None).cast("long").alias("count"), F.lit("").alias("word"),
                          F.concat_ws(" ", F.col("n").cast("string"), F.col("dim").cast("string")).alias("value"))
    body = vectors.select(F.lit(1).alias("__k"), "count", "word",
                          F.concat_ws(" ", "word", F.array_join(F.transform("vec", lambda x: F.format_string("%f", x)), " "))
                          .alias("value"))
    (header.unionByName(body).orderBy("__k", F.col("count").desc_nulls_first(), "word").select("value")
     .write.mode("overwrite").text(path))
    if vocab_path:
        (vectors.orderBy(F.col("count").desc(), "word").select(F.concat_ws(" ", "word", F.col("count").cast("string")).alias("value"))
         .write.mode("overwrite").text(vocab_path))


def read_vectors_text(spark: SparkSession, path: str, vocab_path: str | None = None, normalize: bool = False) -> DataFrame:
    """Inverse of ``write_vectors_text``: ``(word, vec array<float>, count)``.  A row of the wrong width
    raises.  Counts come from the vocabulary file, else ``vocab_size - row_no`` (file order).

    Lines are numbered in file order: part files sort by name, and within a file the scan keeps line
    order, which ``monotonically_increasing_id`` preserves (used only as a sort key, then replaced by a
    dense index)."""
    raw = (spark.read.text(path).withColumn("__name", F.input_file_name())
           .withColumn("__mono", F.monotonically_increasing_id()))
    numbered = dense_index(raw, ["__name", "__mono"], "line_no")
    parts = numbered.select("line_no", F.split(F.trim("value"), " ").alias("p"))
    head = parts.filter(F.col("line_no") == 0).select(F.col("p")[0].cast("long").alias("n"),
                                                      F.col("p")[1].cast("int").alias("dim"))
    body = parts.filter(F.col("line_no") > 0).crossJoin(F.broadcast(head)).select(
        (F.col("line_no") - 1).alias("row_no"), F.col("p")[0].alias("word"),
        F.when(F.size("p") - 1 == F.col("dim"), F.transform(F.slice("p", 2, 1 << 30), lambda x: x.cast("float")))
        .otherwise(F.raise_error(F.lit("vector row of the wrong width")).cast("array<float>")).alias("vec"),
        "n")
    if vocab_path:
        voc = spark.read.text(vocab_path).select(F.split("value", " ").alias("p")).select(
            F.col("p")[0].alias("word"), F.col("p")[1].cast("long").alias("count"))
        out = body.join(voc, "word", "left").select("word", "vec", "count")
    else:
        out = body.select("word", "vec", (F.col("n") - F.col("row_no")).alias("count"))
    if normalize:
        from quarry.functions.arrays import l2_normalize
        out = out.withColumn("vec", l2_normalize(F.transform("vec", lambda x: x.cast("double"))))
    return out


def write_result_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_communities(membership: DataFrame, path: str, max_per_line: int = 100_000) -> None:
    """``community<TAB>m1,m2,…`` lines (members ascending).  A community larger than ``max_per_line``
    continues on further lines with the same id, so no line needs an unbounded gather."""
    idx = dense_index(membership.select("community", "id"), ["community", "id"], "gidx")
    first = idx.groupBy("community").agg(F.min("gidx").alias("__f"))
    lines = (idx.join(first, "community").withColumn("chunk", F.floor((F.col("gidx") - F.col("__f")) / max_per_line))
             .groupBy("community", "chunk").agg(F.sort_array(F.collect_list("id")).alias("m"))
             .select(F.concat(F.col("community").cast("string"), F.lit("\t"),
                              F.array_join(F.transform("m", lambda x: x.cast("string")), ",")).alias("value")))
    lines.write.mode("overwrite").text(path)


def read_communities(spark: SparkSession, path: str) -> DataFrame:
    """Community file → ``membership(id, community)``.  ``community<TAB>members`` lines keep their id; plain
    ``m1,m2,…`` lines (one cluster per line) are numbered in file order (0, 1, …)."""
    lines = spark.read.text(path)
    has_id = F.instr("value", "\t") > 0
    tagged = lines.filter(has_id).select(F.substring_index("value", "\t", 1).cast("long").alias("community"),
                                         F.substring_index("value", "\t", -1).alias("members"))
    plain = (lines.filter(~has_id & (F.trim("value") != "")).withColumn("__name", F.input_file_name())
             .withColumn("__mono", F.monotonically_increasing_id()))
    plain = dense_index(plain, ["__name", "__mono"], "community").select("community", F.col("value").alias("members"))
    both = tagged.unionByName(plain)
    return both.select(F.explode(F.split("members", ",")).alias("id"), "community").select(
        F.trim("id").cast("long").alias("id"), "community")


def write_graph_files(nodes: DataFrame, edges: DataFrame, directory: str) -> None:
    """``nodelist`` (``id<TAB>name<TAB>type``) and ``adjlist`` (``node n1 n2 …``, chunked) under a directory."""
    nodes.select(F.concat_ws("\t", "id", "name", "type").alias("value")).write.mode("overwrite").text(f"{directory}/nodelist")
    write_adjacency_list(edges, f"{directory}/adjlist")


def write_walk_corpus(walks: DataFrame, path: str) -> None:
    """One line per walk (space-joined node names in step order).  A walk holds ``walk_length`` nodes."""
    lines = (walks.groupBy("walk_id").agg(F.sort_array(F.collect_list(F.struct("step", F.col("node").cast("string").alias("n"))))
                                          .alias("s"))
             .select(F.array_join(F.transform("s", lambda x: x["n"]), " ").alias("value")))
    lines.write.mode("overwrite").text(path)


def read_walk_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(split_whitespace("value").alias("walk"))


def text_stream_source(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text messages: a one-column ``value`` stream over files arriving in ``directory``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)
