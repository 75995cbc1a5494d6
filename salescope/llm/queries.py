"""Registered queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from salescope.llm.centroid_clusters import centroid_clusters
from salescope.llm.chat_format import format_chats
from salescope.llm.decontaminate import contamination
from salescope.llm.html_extract import main_text
from salescope.llm.kd_shards import kd_shards
from salescope.llm.near_dedup import near_duplicates
from salescope.llm.oracle import SQL
from salescope.llm.packing import pack
from salescope.llm.quality_classifier import quality_classifier
from salescope.llm.quality_rules import quality_rules
from salescope.llm.token_counts import token_counts
from salescope.llm.toxicity import held_out, toxicity
from salescope.llm.turn_repair import repair_damaged
from salescope.llm.url_trust import Rule, judge_urls

#: Rules of the URL filter.
URL_RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, _read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    laws = {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    return kd_shards(docs, shards=16).withColumns(laws)


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, _read(spark, sf_dir, "benchmark").select("item_id", "text"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=3, percent=85)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity(docs, _read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_classifier(docs, _read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(_read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_quality_rules,
        op3_html_extraction,
        op4_kd_shards,
        op5_url_trust,
        op6_decontamination,
        op7_token_counts,
        op8_near_duplicates,
        op9_toxicity,
        op10_packing,
        op11_quality_classifier,
        op12_centroid_clusters,
        op13_turn_repair,
    )
}

#: DuckDB SQL where an operator is expressible in SQL.
ORACLE: dict[str, str] = dict(SQL)
