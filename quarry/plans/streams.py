"""§2.11 streaming: the documents' text written as several files into a stream directory (FIX-11),
drained with an availableNow trigger; lexicons as in the batch plans."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import register
from quarry.plans.text import LEX_CTE, NW, lexicon
from quarry.session import scratch_path
from quarry.sources.files import text_stream_source
from quarry.sources.tables import table
from quarry.streaming import lexicon as sl

_n = [0]


FILES = 5


def _stream_dir(spark, d):
    """Write the documents' text into a fresh stream directory, about ``FILES`` files whatever the number of tasks."""
    _n[0] += 1
    base = scratch_path(spark, f"stream-{_n[0]}")
    docs = table(spark, d, "documents").select(F.col("text").alias("value"))
    docs.write.option("maxRecordsPerFile", max(1, docs.count() // FILES)).mode("overwrite").text(f"{base}/in")
    return base


def _lexicon(spark, d, quality, base):
    """The lexicon written once, not computed anew in every micro-batch."""
    path = f"{base}/lexicon-{quality}"
    lexicon(spark, d, quality).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _arrivals(spark, d):
    """The series' stream: documents of doc_id % ``FILES`` = 0, 1, ... arrive one after another, each lot a batch."""
    _n[0] += 1
    base = scratch_path(spark, f"arrivals-{_n[0]}")
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("value"))
    pos, neg = (_lexicon(spark, d, q, base) for q in (1, 0))
    for lot in range(FILES):
        docs.filter(F.col("doc_id") % FILES == lot).select("value").write.mode("append").text(f"{base}/in")
        counts = sl.stream_lexicon_counts(spark, text_stream_source(spark, f"{base}/in"), pos, neg, f"{base}/out", f"{base}/ckpt")   # goes on where the last run stopped
    return counts


def _run(spark, d, which):
    base = _stream_dir(spark, d)
    stream = text_stream_source(spark, f"{base}/in", max_files_per_trigger=1)
    pos, neg = (_lexicon(spark, d, q, base) for q in (1, 0))
    run = sl.stream_lexicon_counts if which == "batches" else sl.stream_running_totals
    return run(spark, stream, pos, neg, f"{base}/out", f"{base}/ckpt")


WORDS_SQL = (f", w AS (SELECT unnest(list_filter(regexp_split_to_array(text, '{NW}'), lambda t: t <> '')) AS word FROM documents), "
             "c AS (SELECT CASE WHEN word IN (SELECT word FROM pos) THEN 'positive' WHEN word IN (SELECT word FROM neg) "
             "THEN 'negative' END AS type FROM w) ")


@register("stream_lexicon_counts", "2.11", LEX_CTE + WORDS_SQL +
          "SELECT type, count(*) AS count FROM c WHERE type IS NOT NULL GROUP BY type")
def q_stream_lexicon_counts(spark, d):
    b = _run(spark, d, "batches")
    return b.groupBy("type").agg(F.sum("count").alias("count"))


@register("stream_running_totals", "2.11", LEX_CTE + WORDS_SQL +
          "SELECT type, count(*) AS total FROM c WHERE type IS NOT NULL GROUP BY type")
def q_stream_running_totals(spark, d):
    return _run(spark, d, "totals").select("type", "total")


@register("stream_count_series", "2.11", LEX_CTE + WORDS_SQL.replace("SELECT unnest(", "SELECT doc_id, unnest(", 1).replace("c AS (SELECT CASE", "c AS (SELECT doc_id, CASE", 1) +
          f"SELECT doc_id % {FILES} AS batch_id, count(*) FILTER (type = 'positive') AS positive, count(*) FILTER (type = 'negative') AS negative FROM c GROUP BY 1")
def q_stream_count_series(spark, d):
    """Positive and negative words per batch."""
    return sl.stream_count_series(_arrivals(spark, d))


@register("text_stream_source", "2.1", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def q_text_stream_source(spark, d):
    base = _stream_dir(spark, d)
    stream = text_stream_source(spark, f"{base}/in")
    q = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
