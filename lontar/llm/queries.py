"""Queries of the training-data operators, on the tables of a folder; with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm import blocks, contamination, history, lines, mixing, pii, quality, residue, spans, topics
from lontar.llm.common import cut, site_of, table


def _texts(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """``table_name, record_id, text`` of tables of texts."""
    key, text = {"extracted_content": "page_id"}, {"extracted_content": "content"}
    out = None
    for n in tables:
        one = table(spark, sf_dir, n).select(F.lit(n).alias("table_name"), F.col(key.get(n, "id")).cast("string").alias("record_id"), F.col(text.get(n, "text")).alias("text"))
        out = one if out is None else out.unionByName(one)
    return out


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).select("id", "subject").distinct()


def p1_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).groupBy("subject").agg(F.countDistinct("id").alias("entries"), F.sum("share").alias("share_sum"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = table(spark, sf_dir, "classification_results").select(F.col("doc_id").alias("id"), "topic")
    return topics.subjects_of(table(spark, sf_dir, "export_entries").select("id", "text"), table(spark, sf_dir, "topic_labels"), table(spark, sf_dir, "subject_areas"), groups=coarse)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.no_prose(_texts(spark, sf_dir, "export_entries", "news_articles"))
    cases = residue.residue(_texts(spark, sf_dir, "news_articles"))
    return found.join(cases, ["table_name", "record_id"], "left_anti")


def p2_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.typed(cut(quality.statistics(_texts(spark, sf_dir, "export_entries", "news_articles"))))


def _prose_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``site, id, text`` of articles that have an address and are no case of p2 or p5."""
    texts = _texts(spark, sf_dir, "news_articles")
    cases = residue.residue(texts).union(quality.no_prose(texts))
    news = table(spark, sf_dir, "news_articles").select(site_of(F.col("source_url")).alias("site"), "id", "text").where("site IS NOT NULL")
    return residue.without(news, cut(cases), "id", "news_articles")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(_prose_news(spark, sf_dir)).select("site", "line")


def p3_without_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated(_prose_news(spark, sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fetches, and extracted contents that are no case of p5."""
    extracted = table(spark, sf_dir, "extracted_content")
    cases = cut(residue.residue(_texts(spark, sf_dir, "extracted_content")))
    return table(spark, sf_dir, "fetch_results"), residue.without(extracted, cases, "page_id", "extracted_content")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.labelled_lines(*_pages(spark, sf_dir)).where("NOT main").select("page_id", "line_no")


def p4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.main_text(*_pages(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(_texts(spark, sf_dir, "news_articles", "extracted_content"))


def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaning = table(spark, sf_dir, "cleaning_results").select(F.lit("cleaning_results").alias("table_name"), F.col("doc_id").alias("record_id"), F.col("original_text").alias("text"))
    comments = table(spark, sf_dir, "reddit_comments").select(F.lit("reddit_comments").alias("table_name"), F.col("comment_id").alias("record_id"), F.col("body").alias("text"))
    return cleaning.unionByName(comments)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(_personal(spark, sf_dir)).select("table_name", "record_id", "pii_type", "start_pos").distinct()


def p6_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.masked(_personal(spark, sf_dir)).select("table_name", "record_id", "masked_text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return history.known_articles(t("incoming_articles"), t("news_articles"), t("deduplication_index")).select("id").distinct()


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p9_mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cut(mixing.count_tokens(table(spark, sf_dir, "documents")))
    return mixing.select(counts, mixing.budgets(counts, table(spark, sf_dir, "source_targets")))


def p9_mix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cut(mixing.count_tokens(table(spark, sf_dir, "documents")))
    return mixing.report(mixing.budgets(counts, table(spark, sf_dir, "source_targets")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_pairs(table(spark, sf_dir, "documents"))


def p10_shared_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(table(spark, sf_dir, "documents")).withColumn("spans", F.to_json("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    from lontar.llm.oracles import ORACLES

    return dict(ORACLES)
