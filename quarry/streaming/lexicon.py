"""Streaming lexicon counts: text messages → words → positive / negative / oov, counted per micro-batch
and as running totals.

The reference uses 10-second processing-time batches over a message bus with keyed running state;
here the source is the file-backed text stream (same one-column ``value`` contract), lexicons are
joined as static DataFrames (Spark broadcasts them if they are small enough), per-batch counts go through
``foreachBatch`` into one directory per batch id, overwritten if a batch is run again, and running totals are a
stateful ``groupBy().count()`` in complete mode (two keys, so the state stays tiny).  Every query has
a checkpoint location on shared storage, so a restarted driver resumes where it stopped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import split_nonword
from quarry.session import Scratch


def word_types(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """``(word, type)``: one table of both lists, positive before negative; written once, so that no batch makes it anew."""
    p, n = positive.select("word").distinct(), negative.select("word").distinct()
    both = p.withColumn("type", F.lit("positive")).unionByName(n.join(p, "word", "left_anti").withColumn("type", F.lit("negative")))
    return Scratch(positive.sparkSession, "word-types").write(both, "types")


def classified_words(stream: DataFrame, positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Streaming words with their class, by one join; oov words dropped."""
    words = stream.select(F.explode(split_nonword("value")).alias("word"))
    return words.join(word_types(positive, negative), "word")


def stream_lexicon_counts(spark: SparkSession, stream: DataFrame, positive: DataFrame, negative: DataFrame,
                          sink_path: str, checkpoint: str, trigger: dict | None = None, timeout: float | None = None):
    """Per micro-batch ``(batch_id, type, count)`` in a Parquet table at ``sink_path``; a batch that is run again
    replaces its own rows."""
    words = classified_words(stream, positive, negative)

    def write_batch(df: DataFrame, batch_id: int):
        (df.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
         .write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}"))

    q = (words.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination(timeout)
    if timeout is not None:
        q.stop()
    return spark.read.schema("type string, count long, batch_id long").parquet(sink_path)


def stream_running_totals(spark: SparkSession, stream: DataFrame, positive: DataFrame, negative: DataFrame,
                          sink_path: str, checkpoint: str, trigger: dict | None = None, timeout: float | None = None):
    """Running total per class since the start (stateful aggregation, complete output mode); every batch
    overwrites the small totals table, which is returned after the stream drains or the timeout."""
    totals = classified_words(stream, positive, negative).groupBy("type").agg(F.count(F.lit(1)).alias("total"))

    def write_totals(df: DataFrame, batch_id: int):
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(sink_path)

    q = (totals.writeStream.outputMode("complete").foreachBatch(write_totals).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination(timeout)
    if timeout is not None:
        q.stop()
    return spark.read.parquet(sink_path)


def stream_count_series(batch_counts: DataFrame) -> DataFrame:
    """``(batch_id, positive, negative)`` per batch; a class absent from a batch counts 0."""
    return (batch_counts.groupBy("batch_id").pivot("type", ["positive", "negative"]).agg(F.sum("count"))
            .fillna(0).select("batch_id", F.col("positive").cast("long"), F.col("negative").cast("long")))
