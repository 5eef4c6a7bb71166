"""Whole plans: cleaning of documents, the news corpus, export entries. One lazy plan each, cheap gates first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions import ids, pii, text, urls
from lontar.functions.unicode import nfkc
from lontar.operators import dedup, quality
from lontar.plans.stage import cut


def cleaned(df: DataFrame, column: str, least: int = 200, names: bool = True) -> DataFrame:
    """``df`` with ``cleaned_text, pii_found, emojis_removed, formatting_changes, issues, quality_score``."""
    plain = df.withColumns({"_e": F.regexp_replace(column, text.EMOJI, ""), "emojis_removed": F.coalesce(text.emojis(F.col(column)), F.lit(0))})
    formed = plain.withColumn("_f", nfkc(F.col("_e"))).withColumns({"_n": text.normalised(F.col("_f")), "formatting_changes": text.change_counts(F.col("_f"))})
    kinds = None if names else tuple(dict.fromkeys(k for k, _, _ in pii.STEPS if k != "name"))
    masked = pii.mask(formed, "_n", kinds, "cleaned_text", "pii_found").withColumn("issues", quality.issues(F.col("cleaned_text"), least))
    total = F.aggregate(F.map_values("formatting_changes"), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    score = quality.clean_score(F.col(column), F.coalesce("cleaned_text", F.lit("")), F.col("issues"), F.col("pii_found"), F.col("emojis_removed"), total)
    return masked.withColumn("quality_score", score).drop("_e", "_f", "_n")


def export_text(title: Column, content: Column, least: int = 200) -> Column:
    """Title and content on two lines, or the content alone if that is short or there is no title."""
    both = F.concat(title, F.lit("\n"), content)
    return F.when((F.coalesce(title, F.lit("")) != "") & (F.length(both) >= least), both).otherwise(content)


def export_entries(df: DataFrame, source: str, version: str) -> DataFrame:
    """Nested entries of ``df`` (``url, title, content, language, topic, subdomain, author, publish_date, description, processed_at``); null optional fields are left out by the JSON writer."""
    host = urls.domain(F.col("url"))
    meta = F.struct(
        F.col("language").alias("lang"), "url", F.lit(source).alias("source"), F.lit("text").alias("type"), F.date_format("processed_at", "yyyy-MM-dd").alias("processing_date"), F.lit(version).alias("delivery_version"),
        "title", "content", "author", "publish_date", "description",
    )
    return df.select(ids.export_id(F.col("url"), F.col("content")).alias("id"), export_text(F.col("title"), F.col("content")).alias("text"), meta.alias("meta"), F.struct(F.coalesce("topic", host).alias("domain"), "subdomain").alias("content_info"))


def pending(df: DataFrame, metadata: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with fields out of a JSON column: ``name: (path, type)``; what is missing or of another type is null."""
    return df.withColumns({name: F.expr(f"try_cast(get_json_object(`{metadata}`, '{path}') AS {kind})") for name, (path, kind) in fields.items()})


def gated(fetched: DataFrame, now: Column, least: int = 200) -> DataFrame:
    """``page_id, rejected_at`` of the last fetch of each page, and the fields of accepted ones.

    The gates in order: ``fetch``, ``extraction``, ``cleaning``, ``topic``,
    ``duplicate`` (by exact hash, then by signature, against smaller page ids);
    null if all are passed. A page sees no gate after the one that stops it.
    """
    from lontar.operators import classify, html

    last = cut(fetched.groupBy("page_id").agg(F.max_by(F.struct("url", "success", "content"), F.struct(F.coalesce("success", F.lit(False)), "fetched_at", F.xxhash64("content"))).alias("f")).select("page_id", "f.*"))
    ok = F.coalesce(F.col("success"), F.lit(False)) & F.col("content").isNotNull()
    # Each costly step is written once: several others read it.
    extracted = cut(html.extract(last.where(ok).select("page_id", "url", "content"), "content"))
    formed = cut(cleaned(extracted.where("extraction_method <> 'failed'").select("page_id", "url", "title", "content", "author", "publish_date", "description"), "content", least))
    ranked = cut(classify.classify(formed.where(F.size("issues") == 0), "title", "cleaned_text"))
    judged = classify.validated(ranked, "title", "cleaned_text")
    allowed = ids.simhashes(judged.where("is_allowed"), "cleaned_text")
    allowed = cut(allowed.withColumns({"exact": ids.content_hash(F.col("cleaned_text")), "signature": ids.simhash_number(F.col("simhash"))}))
    copies = dedup.cascade(allowed, "page_id", "exact", "signature")
    stages = cut(
        last.where(ok).select("page_id").join(extracted.select("page_id", "extraction_method"), "page_id", "left").join(formed.select("page_id", F.size("issues").alias("_issues")), "page_id", "left")
        .join(copies.select(F.col("key").alias("page_id"), "duplicate_type"), "page_id", "left")
    )
    gate = F.when(F.coalesce("extraction_method", F.lit("failed")) == "failed", "extraction").when(F.coalesce("_issues", F.lit(1)) > 0, "cleaning").when(F.col("duplicate_type").isNull(), "topic").when(F.col("duplicate_type") != "none", "duplicate")
    out = last.where(~ok).select("page_id", F.lit("fetch").alias("rejected_at")).unionByName(stages.select("page_id", gate.alias("rejected_at")))
    kept = allowed.select("page_id", "url", "title", F.col("cleaned_text").alias("content"), text.language(F.col("cleaned_text")).alias("language"), "topic", "subdomain", "author", "publish_date", "description", now.alias("processed_at"))
    return out.join(kept.withColumnRenamed("page_id", "_page"), (F.col("page_id") == F.col("_page")) & F.col("rejected_at").isNull(), "left").drop("_page")


def news_corpus(news: DataFrame) -> DataFrame:
    """``document_id, title, text, site`` of clean articles, copies reduced to the smallest id."""
    formed = news.withColumns({"text": text.news_text(F.col("text")), "title": text.news_text(F.col("title"))})
    good = formed.where(quality.clean_status(F.col("title"), F.col("text")) == "clean").where(quality.filled(F.col("source_url")))
    first = dedup.keep_first(good.select("id", "title", "text", "source_url"), [ids.content_hash(F.col("text"))], [F.col("id"), F.col("source_url"), F.col("title"), F.col("text")])
    return first.select(ids.document_id(F.col("source_url"), F.col("text")).alias("document_id"), "title", "text", urls.domain(F.col("source_url")).alias("site"))
