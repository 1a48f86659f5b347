"""Corpus pipeline over ``documents``: each stage calls one operator of ledgerflow.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import content_sort, crf_quality, decontam, minhash, piece_codec
from ledgerflow.llm.common import free_name, stored, table

MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted on all labelled documents' sample, scores 0.5 or more."""
    field = crf_quality.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "__quality")
    scored = crf_quality.score_column(docs, field, out_col=score)
    return scored.filter(F.col(score) >= 0.5).select(*[f"`{c}`" for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text that is equal after lower-casing A-Z: the smallest doc_id."""
    return content_sort.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 of five-word shingles: the smallest doc_id."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and digests of ids and of the text they decode to."""
    model = public_tokenizers.path(MODEL)
    ids = piece_codec.encode_column(docs.select("doc_id", "lang", "source", "text"), model).drop("text")
    both = piece_codec.decode_column(ids, model)
    return both.select("doc_id", "lang", "source", "ids", *piece_codec.digest_columns())


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontaminate), ("SentencePiece encoding and decoding", encode)]

#: Stages with a fitted model or a tokenizer have no SQL; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
