"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Toxic documents go, of each group of near copies the smallest doc_id stays, documents that hold a
benchmark item go, what is left is mixed to the target weights of its sources, and the mix is placed
in shards of near equal bytes. A document that the mix takes several times has several rows, each
with the text that is taken. Results of the last stage carry ``shard`` and ``slot``.

Every stage takes (spark, docs, sf_dir) and, but for the last, returns the columns of ``docs``. Missing
values, empty tables and clashing columns behave as the operators' modules say.

Stages pass whole texts to Python, so they set the session's Arrow batches to ``BATCH_ROWS`` rows: with
the default of 10,000, the batches of a few tasks in Spark and in Python take most of a small executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from guildmart.llm import decontamination, mixing, sharding, simhash, toxicity
from guildmart.llm.common import documents
from guildmart.sources.warehouse import written


BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return toxicity.ordinary_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return simhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return mixing.mixed_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

# Models, permutations and pruned searches are not SQL; tests/llm/test_pipeline.py checks every stage by
# what it must have kept and dropped of its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if i < len(STAGES) - 1 else docs
    return docs
