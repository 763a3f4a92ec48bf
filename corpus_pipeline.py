"""A corpus pipeline of four stages: toxicity, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread
as the next stage's docs; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import decontaminate, near_dup, tokens, toxicity
from lexspark.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what a classifier fitted on the labelled rows of ``docs`` scores below one half."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: that of the smallest doc_id. Rows without words stay."""
    return near_dup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, also with other numbers, names or units."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, checked by decoding them."""
    return tokens.encode_decode(docs, with_ids=True)


STAGES = [("toxicity", drop_toxic), ("near_dup", drop_near_duplicates), ("decontaminate", drop_leaks), ("byte_bpe", encode)]

#: No SQL expresses the fitted classifier of the first stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.keep(docs)
    return docs
