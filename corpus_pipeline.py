"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigmill.llm import decontam, line_dedup, packing, quality, simhash
from sigmill.llm._shared import materialize, table

#: Words in a generation of the tokenizer's cache: the executors hold the memory of earlier stages too.
CACHE_WORDS = 100_000


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled rows among docs."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, by source; every document stays."""
    return line_dedup.drop_boilerplate(docs).drop("n_dropped")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences."""
    return packing.pack(docs, cache_words=CACHE_WORDS)


STAGES = [("quality classifier", quality_filter), ("line dedup", line_filter), ("simhash near-dedup", near_duplicates), ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]
#: A trained network and a tokenizer are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
