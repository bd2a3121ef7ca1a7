"""A training corpus from the documents table, in five stages; each is written as Parquet and read again by the next."""

from pyspark.sql import DataFrame, SparkSession

from sylvaspark.llm import apply, mixing, packing, shared


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return apply.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return apply.one_of_each_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut."""
    return apply.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their rounded rate says."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the documents' pieces."""
    return packing.packed(docs)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", ngram_jaccard), ("suffix_array_dedup", suffix_array_dedup), ("mixing", mix_sources), ("packing", pack)]

#: A trained network, an iterative solution and a heuristic can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = shared.persist_shared(docs, spark)
    return docs
