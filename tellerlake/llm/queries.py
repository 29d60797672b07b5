"""The queries of the corpus operators, on their whole tables, and SQL for some of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import collocations, conversation_trie, html_extract, line_dedup, lm_score, mixing, near_dedup, pieces, pu_quality, quality_rules, topk, url_filter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.planned(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return pu_quality.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return near_dedup.verdicts(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extracted(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", "n_chars")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return topk.top_k(rows.where("id % 100 = 0"), rows)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return rows.select("doc_id", *pieces.DERIVED)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_nodes(table(spark, sf_dir, "conversations"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", *url_filter.DERIVED)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_lm_score": op3_lm_score,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_html_extract": op8_html_extract,
    "op9_topk_search": op9_topk_search,
    "op10_pieces": op10_pieces,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_url_filter": op12_url_filter,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op1_mixing": mixing.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op9_topk_search": topk.ORACLE,
    "op11_conversation_trie": conversation_trie.ORACLE,
    "op12_url_filter": url_filter.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
