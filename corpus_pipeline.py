"""A training-data pipeline: each stage applies one operator to what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchledger.llm import decontam, mixing, near_sets, toxicity
from matchledger.llm.common import cut, table
from matchledger.llm.queries import token_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5. A document that occurs more than once is scored by row."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_below(docs, model, 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles are alike by 0.8 or more, the one with the smallest id."""
    return near_sets.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of tokens."""
    return mixing.sample(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents; what is read back from them: doc_id, start, n_tokens, ids_crc32."""
    return token_table(spark, docs, keep=400_000, between=False)  # workers and executors hold what earlier stages have left, too


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_ids", to_token_ids),
]

ORACLE_SQL = None  # the first stage learns a model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
