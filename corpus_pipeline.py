"""The corpus pipeline: quality filter, exact dedup, near-dedup, mixing, packing."""

from pyspark.sql import DataFrame, SparkSession

from flowgauge.llm import exact_dedup, mixing, packing, quality, simhash
from flowgauge.llm.queries import tokenizer_path
from flowgauge.storage import written


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors come here with the memory that the stages before have taken; workers get by with less.
    return packing.pack(docs, tokenizer_path(), cached_words=200_000, batch_bytes=2_000_000)


STAGES = [("quality", drop_poor), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mix", mix_sources), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
