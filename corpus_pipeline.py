"""Corpus pipeline: toxicity filter, exact dedup, SimHash near-dedup, source mixing, SentencePiece encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the columns of ``documents``; the last
returns doc_id, lang, source and the pieces of each text.  Rows of an empty table, null or empty texts and repeated rows
pass as the operators define: an empty text is clean, all empty texts are one exact copy, an empty text has no pieces.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import block_naming, mixing, piece_lattice, simhash_trie, toxicity_knn
from quarry.llm.common import materialize
from quarry.sources.tables import table

#: No SQL: the toxicity, SimHash, mixing and SentencePiece stages can't be expressed; tests/llm/test_pipeline.py checks them.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity_knn.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return block_naming.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints stays."""
    return simhash_trie.drop_near_copies(docs, shingle=3, max_bits=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes; documents stay whole."""
    return mixing.mix_sources(docs, cut_edge=False)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation of each text, its score, and the others of the N best."""
    out = piece_lattice.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", "pieces.*")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("source_mixing", source_mixing), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
