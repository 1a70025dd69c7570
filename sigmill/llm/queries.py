"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, divergence, ffd, line_dedup, media, packing, phrases, quality, secrets, simhash, token_store, url_filter
from ._shared import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.NARROW)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read_back(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chats(table(spark, sf_dir, "conversations"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.tokenize_to_store(table(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ffd.pack(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_media_columns": op4_media_columns,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_url_filters": op6_url_filters,
    "op7_packing": op7_packing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_token_store": op9_token_store,
    "op10_secret_scans": op10_secret_scans,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_source_divergence": op12_source_divergence,
    "op13_ffd_packing": op13_ffd_packing,
}
ORACLE_SQL: dict[str, str] = {"op1_line_dedup": line_dedup.SQL, "op3_decontamination": decontam.SQL, "op8_chat_formatting": chat.SQL, "op11_phrase_mining": phrases.SQL, "op12_source_divergence": divergence.SQL}
