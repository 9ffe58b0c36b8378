"""From raw documents to training shards: five stages, each by one operator of callscope.llm.

Every stage takes (spark, docs, sf_dir) and returns the columns of `documents`, but for the
last, which adds `shard` and `slot`. `run` writes each stage's result to the shared scratch
folder and hands it to the next one.

- language: documents of no known language go (null texts, texts without letters, or a
  posterior below 0.5). The model learns from the stage's own labelled rows.
- near_duplicates: of each component of documents whose SimHash fingerprints are linked (three-word
  shingles, at most two bits apart) the document with the smallest doc_id stays.
- decontamination: documents that hold a window of a benchmark item go.
- mixing: documents are repeated or left out so that sources reach their target words.
- sharding: the rows in Hilbert order, cut into shards.

Null or empty texts leave in the first stage; empty tables pass through all of them; columns
beyond those of `documents` are carried along.
"""

from pyspark.sql import DataFrame, SparkSession

from callscope.llm import decontamination, language, mixing, near_duplicates, sharding
from callscope.llm.common import materialise, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.fitted(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

#: XXH64 fingerprints and the language model cannot be written in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
