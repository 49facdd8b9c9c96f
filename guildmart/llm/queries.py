"""The operators as queries over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildmart.llm import alignment, decontamination, language, licenses, line_dedup, merkle, mixing, ngram_lm, quality, ranking, sharding, simhash, toxicity
from guildmart.llm.common import documents
from guildmart.llm.labelled import remainder
from guildmart.sources.warehouse import written

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept = line_dedup.deduplicate(line_dedup.build(docs), docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text", "spans")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = remainder("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "source", mixing.n_words().alias("size"), F.xxhash64("text").alias("digest")
    )
    mix = mixing.Mix(docs, size=F.col("size"), digest=F.col("digest"))
    named = mix.taken().join(F.broadcast(mix.sources.drop("source")), "source_no")
    return named.select(F.col("row.doc_id").alias("doc_id"), named["size"], "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id",
        sharding.record_bytes().alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.xxhash64("text").alias("group"),
    )
    placed = sharding.shard(docs, key=F.col("group"), size=F.col("size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = language.learn(language.training_documents(docs))
    held_out = remainder("doc_id", language.FOLDS) == language.HELD_OUT
    return language.predict(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", ngram_lm.FOLDS) == ngram_lm.HELD_OUT
    scored = ngram_lm.score(documents(spark, sf_dir).select("doc_id", "text"), held_out)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    crf = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, crf).drop("text")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontamination.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = simhash.near_duplicates(documents(spark, sf_dir))
    return named.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.Alignment(documents(spark, sf_dir)).documents()


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = written(ranking.with_features(docs).drop("text"))
    ranker = ranking.fit(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = remainder("doc_id", ranking.FOLDS) == ranking.HELD_OUT
    return ranking.score(rows, ranker).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(documents(spark, sf_dir)).versions().drop("copied")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_licenses": op2_licenses,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_language": op6_language,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_ranking": op12_ranking,
    "op13_merkle": op13_merkle,
}
