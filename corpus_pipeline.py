"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns those it keeps, all
columns (the last returns pieces of sequences); between stages they are a Parquet table
in the shared scratch folder, so a lost executor costs part of one stage only.

1. quality: base rules and compression bands; rejected documents go.
2. exact: of equal texts (white space aside) the smallest doc_id stays.
3. near: one document of each group of near copies stays (five words, 0.8).
4. mix: sources to their target weights; a document may go, stay or come twice.
5. pack: sequences of at most 2048 tokens.

Null texts and empty tables follow the stages' own definitions: the quality stage drops
null, empty and very short texts; an empty table stays empty to the end; rows that repeat
a document are one after the exact stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sintonia.llm import budget_mix, exact_dedup, near_dedup, packing, quality
from sintonia.llm.common import discard, table, written

#: SQL cannot express the compression, forest, knapsack and tokenizer stages; the tests
#: hold each stage against a brute-force version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return budget_mix.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_packing())


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near),
    ("mix", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # its successor is on disk
        before = docs
    return docs
