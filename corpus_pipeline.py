"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage's rows to
the shared folder and reads them again for the next one, so a lost executor costs one stage's
tasks at most. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callfunnel.llm import bpe, line_dedup, mixing, near_dup, quality_rules
from callfunnel.llm.common import TEXT_ROWS, drop_stored, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality_rules.apply_rules(docs).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their sources' boilerplate lines; n_chars is that of the new text."""
    return line_dedup.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near copies (five-word shingles, 0.8)."""
    return near_dup.keep_one(docs).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source repeated, or left out, to the mixture's weights."""
    return mixing.mix(docs).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, its number of tokens, SHA-256 of its ids and of the text they decode to."""
    return stored(bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json")), "token-ids", TEXT_ROWS)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("source mixing", mixture), ("token ids", encode)]

#: Neither the components of near copies nor BPE can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last is not None:
            drop_stored(spark, last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
