"""The corpus pipeline: documents in, encoded training mix out.

Each stage takes (spark, docs, sf_dir), with docs the rows that the stage
before kept, and returns a DataFrame; all but the last return the columns of
documents.  ``run`` writes every stage's result as Parquet to the shared
folder and reads it again.

1. language: texts whose language is unknown go (language ID, operator 10):
   those without letters, and those whose best language is hardly likelier than
   chance (a margin set on the calibration rows).  If no row has a language to
   learn from, all texts with letters stay
2. exact: one row of each text stays (block naming, operator 9)
3. near: one row of each group of near copies stays (parity-sketch join,
   operator 6, on 5-word shingles with a similarity of 0.8 or more)
4. mix: rows are repeated or left out to meet the sources' targets (entropy
   balancing, operator 3)
5. encode: token ids of every row (byte-level BPE, operator 1)
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import block_names, bpe, langid, mixing, parity_join
from tickline.llm.common import held_out, setup, stage, table

#: Workers remember less than by themselves: the executors have the other stages behind them.
ENCODE_MEMO = 0.4
NEAR = parity_join.JoinParams(width=5, num=80, den=100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a known language; the model learns from the rows outside the
    held-out fold.  A null text and one without letters go."""
    setup(spark)
    model = langid.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return docs.where(langid.accept(F.col("text"), model))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    setup(spark)
    return block_names.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id."""
    setup(spark)
    return parity_join.drop_similar(docs, params=NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    setup(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and packed ids of every row."""
    setup(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, "doc_id", "text", path, public_tokenizers.PATTERN, keep_ids=True, memo=ENCODE_MEMO)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: Learned and sketched stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    setup(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
