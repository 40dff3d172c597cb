"""The registered queries of the training-data operators, and their SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import block_lstm, block_naming, columnar_topk, credentials, gear_chunks, gram_variants, mixing, piece_lattice, rans_store, shard_lloyd, simhash_trie, toxicity_knn, warc_derivatives
from quarry.llm.byte_bpe import Words
from quarry.llm.common import scratch_dir
from quarry.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@_query("op1_rans_token_store")
def op1(spark, sf_dir, end_id: int = 2, tokenizer: str = "byte_bpe_50k.json"):
    file, path = public_tokenizers.path(tokenizer), scratch_dir(spark, "rans")
    rans_store.write_ids(table(spark, sf_dir, "documents"), lambda texts: Words.open(file, end_id).encode(texts), path)
    return rans_store.read_checksums(spark, path)


@_query("op2_gear_chunk_dedup")
def op2(spark, sf_dir):
    return gear_chunks.repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "start", "end", "n_chunks", "kept", "first_doc_id")


@_query("op3_block_naming_dedup", r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-n_chars, doc_id)) AS keep_id FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm""")
def op3(spark, sf_dir):
    return block_naming.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query("op4_piece_lattice")
def op4(spark, sf_dir, model: str = "piece_bpe_32k.model"):
    out = piece_lattice.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(model), keep=["doc_id"])
    return out.select("doc_id", F.size("pieces.ids").cast("long").alias("n_ids"), "pieces.ids_crc32", "pieces.score",
                      F.transform("pieces.others", lambda o: o["score"]).alias("other_scores"), "pieces.round_trip")


@_query("op6_source_mixing")
def op6(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("copies").alias("copies"))


@_query("op10_credential_linking")
def op10(spark, sf_dir):
    return credentials.scan_secrets(table(spark, sf_dir, "documents")).drop("links")


@_query("op5_simhash_trie")
def op5(spark, sf_dir):
    return simhash_trie.near_dedup(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op7_toxicity_knn")
def op7(spark, sf_dir):
    return toxicity_knn.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op8_columnar_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op8(spark, sf_dir):
    return columnar_topk.exact_topk(table(spark, sf_dir, "embeddings"))


@_query("op9_warc_derivatives")
def op9(spark, sf_dir):
    responses, path = scratch_dir(spark, "warc"), scratch_dir(spark, "warc-derived")
    warc_derivatives.write_warc(warc_derivatives.page_responses(table(spark, sf_dir, "pages")), responses)
    out = warc_derivatives.build_derivatives(spark, responses, path)
    text = F.col("block").cast("string")
    return out.select(warc_derivatives.header("X-Page-Id").cast("long").alias("page_id"), "type", "record_id", "refers_to", "target_uri", "date", "block_digest", "digest_ok",
                      warc_derivatives.header("X-Source-Payload-Digest").alias("source_digest"), F.octet_length("block").cast("long").alias("n_bytes"),
                      F.when(F.col("type") == "metadata", F.get_json_object(text, "$.title")).alias("title"))


@_query("op12_shard_lloyd", shard_lloyd.lloyd_sql())
def op12(spark, sf_dir):
    return shard_lloyd.cluster_digests(*shard_lloyd.lloyd(table(spark, sf_dir, "embeddings")))


@_query("op11_gram_variants", gram_variants.VARIANTS_SQL)
def op11(spark, sf_dir):
    return gram_variants.spelling_variants(table(spark, sf_dir, "documents"))


@_query("op13_block_lstm")
def op13(spark, sf_dir):
    return block_lstm.extract_main_text(table(spark, sf_dir, "pages"))
