"""The training-data pipeline: five stages over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet under the shared checkpoint folder and reads it again as the next
stage's docs, so a lost executor costs the current stage at most.  All stages
but the last keep the columns of documents.

1. toxicity: documents that the clause grammar rejects go.
2. exact_dedup: of equal texts the smallest doc_id stays.
3. near_dedup: of each group that near-duplicate links connect, the smallest doc_id stays.
4. decontamination: benchmark spans are cut out, documents that are mostly benchmark go.
5. encoding: SentencePiece ids with seeded merge-dropout.

Null texts pass the filters as empty ones; repeated rows are exact duplicates;
extra columns are carried; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skywave.llm import decontamination, exact_dedup, jaccard_join, sentencepiece_dropout, toxicity
from skywave.llm.common import table
from skywave.session import scratch_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_dropout.encoded(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("encoding", encode),
]

#: Learned weights, rolling sketches and keyed merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
