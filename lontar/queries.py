"""Queries of the engine's own operators over whole tables, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lontar.functions import ids, pii, text, urls
from lontar.functions.text import NO_LETTER_NO_SPACE, SPACE
from lontar.functions.unicode import nfkc
from lontar.operators import classify, dedup, frontier, html, news, quality, stats, threads
from lontar.plans import corpus
from lontar.plans.stage import fresh_folder, spread
from lontar.sources import books, jsonl, pages, sinks
from lontar.streaming import corpus as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOW = "2024-12-01 00:00:00"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _q(pattern: str) -> str:
    """A pattern as an SQL literal."""
    return "'" + pattern.replace("'", "''") + "'"


def _rep(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        expr = f"regexp_replace({expr}, {_q(pattern)}, {_q(by)}, 'g')"
    return expr


def _strip(expr: str) -> str:
    return _rep(expr, (rf"^{SPACE}+|{SPACE}+$", ""))


def _squeeze(expr: str) -> str:
    return f"trim({_rep(expr, (SPACE + '+', ' '))}, ' ')"


def _count(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {_q(pattern)}))"


# --- sources and projections ---------------------------------------------------------------------------------------

_ARTICLE = StructType([StructField(c, StringType()) for c in ("id", "language", "source_url", "title", "text", "clean_status", "category")])


@query("SELECT id, language, source_url, title, text, clean_status, category FROM news_articles WHERE id NOT LIKE '0%'")
def scan_json_lines(spark, d):
    """Lines of JSON, those of ids with a leading 0 cut off in the middle: the broken ones are left out."""
    news = _t(spark, d, "news_articles").select(*(f.name for f in _ARTICLE.fields))
    lines = news.select("id", F.to_json(F.struct(*news.columns)).alias("line"))
    cut = F.when(F.col("id").startswith("0"), F.substring("line", F.lit(1), F.length("line") - 20)).otherwise(F.col("line"))
    return jsonl.parse_lines(lines.select(cut.alias("line")), "line", _ARTICLE)


@query("SELECT page_id, unnest(regexp_extract_all(content, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS link FROM fetch_results WHERE success")
def scan_links(spark, d):
    return _t(spark, d, "fetch_results").where("success").select("page_id", F.explode(urls.links(F.col("content"))).alias("link"))


@query("SELECT doc_id, unnest(regexp_extract_all('<a href=\"/ebooks/' || doc_id || '\">' || coalesce(title, '') || '</a><a href=\"/ebooks/' || (doc_id % 10) || '.txt\">text</a>', '/ebooks/(\\d+)', 1)) AS book FROM documents")
def scan_book_ids(spark, d):
    """Ids of books on search pages; the pages are made of the documents' titles."""
    link = lambda n: F.concat(F.lit('<a href="/ebooks/'), n.cast("string"))
    pages = _t(spark, d, "documents").select("doc_id", F.concat(link(F.col("doc_id")), F.lit('">'), F.coalesce("title", F.lit("")), F.lit("</a>"), link(F.col("doc_id") % 10), F.lit('.txt">text</a>')).alias("page"))
    return pages.select("doc_id", F.explode(books.book_ids(F.col("page"))).alias("book"))


@query("SELECT page_id, CASE WHEN link LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || link ELSE link END AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(content, '<a\\s[^>]*href=\"(/[^\"/][^\"]*|https?://[^\"]*)\"', 1)) AS link FROM fetch_results WHERE success)")
def scan_resolved_links(spark, d):
    pages = _t(spark, d, "fetch_results").where("success").select("page_id", "url", F.explode(urls.links(F.col("content"))).alias("link"))
    return pages.select("page_id", urls.resolved(F.col("url"), F.col("link")).alias("link")).where(urls.valid(F.col("link")))


@query("SELECT comment_id, author, body, score FROM reddit_comments")
def scan_listing(spark, d):
    """Comments wrapped as listing JSON, a listing per row, and read again."""
    c = _t(spark, d, "reddit_comments")
    wrapped = c.select("comment_id", F.to_json(F.struct(F.struct(F.array(F.struct(F.lit("t1").alias("kind"), F.struct("comment_id", "author", "body", "score").alias("data"))).alias("children")).alias("data"))).alias("j"))
    parsed = wrapped.select(F.explode(F.from_json("j", "data struct<children:array<struct<kind:string,data:struct<comment_id:string,author:string,body:string,score:int>>>>")["data"]["children"]).alias("x"))
    return parsed.where("x.kind = 't1'").select("x.data.*")


@query("SELECT id, language, source_url, title, text, category FROM news_articles")
def proj_drop_fields(spark, d):
    return _t(spark, d, "news_articles").drop("clean_status", "site", "scraped_at")


@query("SELECT * FROM (SELECT id, coalesce(language, 'id') AS language, source_url, title, text, coalesce(clean_status, 'clean') AS clean_status, coalesce(category, 'news') AS category FROM news_articles) WHERE id <> '' AND language <> '' AND source_url <> '' AND title <> '' AND text <> '' AND clean_status <> '' AND category <> ''")
def proj_seven_fields(spark, d):
    n = _t(spark, d, "news_articles").select("id", F.coalesce("language", F.lit("id")).alias("language"), "source_url", "title", "text", F.coalesce("clean_status", F.lit("clean")).alias("clean_status"), F.coalesce("category", F.lit("news")).alias("category"))
    return n.where(quality.filled(*(F.col(c) for c in n.columns)))


@query("SELECT id, title, text, 'clean' AS clean_status FROM news_articles")
def proj_constant(spark, d):
    return _t(spark, d, "news_articles").select("id", "title", "text", F.lit("clean").alias("clean_status"))


@query("SELECT page_id, CASE WHEN title IS NOT NULL AND title <> '' AND length(title || chr(10) || content) >= 200 THEN title || chr(10) || content ELSE content END AS text FROM extracted_content WHERE content IS NOT NULL")
def proj_export_text(spark, d):
    e = _t(spark, d, "extracted_content").where("content IS NOT NULL")
    return e.select("page_id", corpus.export_text(F.col("title"), F.col("content")).alias("text"))


@query("SELECT doc_id, length(original_text)::BIGINT AS original_length, coalesce(length(cleaned_text), 0)::BIGINT AS cleaned_length, (length(original_text) - coalesce(length(cleaned_text), 0))::BIGINT AS removed, coalesce(len(pii_found), 0)::BIGINT AS pii_kinds, coalesce(emojis_removed, 0)::BIGINT AS emojis_removed, coalesce(list_sum(map_values(formatting_changes)), 0)::BIGINT AS changes FROM cleaning_results")
def proj_clean_stats(spark, d):
    c = _t(spark, d, "cleaning_results")
    size = F.when(F.col("pii_found").isNotNull(), F.size("pii_found"))
    return c.select(
        "doc_id", F.length("original_text").cast("long").alias("original_length"), F.coalesce(F.length("cleaned_text"), F.lit(0)).cast("long").alias("cleaned_length"), (F.length("original_text") - F.coalesce(F.length("cleaned_text"), F.lit(0))).cast("long").alias("removed"),
        F.coalesce(size, F.lit(0)).cast("long").alias("pii_kinds"), F.coalesce("emojis_removed", F.lit(0)).cast("long").alias("emojis_removed"), F.aggregate(F.coalesce(F.map_values("formatting_changes"), F.array().cast("array<int>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0))).alias("changes"),
    )


@query("SELECT doc_id, topic, CASE topic " + " ".join(f"WHEN '{t[0]}' THEN '{t[1]}'" for t in classify.TOPICS) + " ELSE topic END AS subdomain FROM classification_results")
def proj_subdomain(spark, d):
    return _t(spark, d, "classification_results").select("doc_id", "topic", classify.subdomain(F.col("topic")).alias("subdomain"))


@query("SELECT comment_id, subreddit || ' > ' || replace(body, chr(10), ' <newline> ') AS line FROM reddit_comments WHERE body IS NOT NULL")
def proj_comment_lines(spark, d):
    return _t(spark, d, "reddit_comments").where("body IS NOT NULL").select("comment_id", F.concat("subreddit", F.lit(" > "), F.replace("body", F.lit("\n"), F.lit(" <newline> "))).alias("line"))


# --- filters -------------------------------------------------------------------------------------------------------

_STATUS_SQL = "CASE WHEN length(coalesce(text, '')) < 100 THEN 'short_content' WHEN length(coalesce(title, '')) < 10 THEN 'poor_title' WHEN contains(lower(text), 'click here') OR contains(lower(text), 'subscribe now') OR contains(lower(text), 'advertisement') THEN 'contains_spam' ELSE 'clean' END"


@query(f"SELECT id, {_STATUS_SQL} AS status FROM news_articles")
def filt_clean_status(spark, d):
    return _t(spark, d, "news_articles").select("id", quality.clean_status(F.col("title"), F.col("text")).alias("status"))


@query("SELECT count(*) FILTER (WHERE clean_status = 'clean') AS kept, count(*) FILTER (WHERE clean_status IS DISTINCT FROM 'clean') AS removed FROM news_articles")
def filt_clean_counts(spark, d):
    kept = F.col("clean_status").eqNullSafe("clean")
    return _t(spark, d, "news_articles").agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("removed"))


@query("SELECT id, (id <> '' AND language = 'id' AND source_url <> '' AND title <> '' AND text <> '' AND clean_status <> '' AND category <> '') IS TRUE AS valid FROM news_articles")
def filt_valid_articles(spark, d):
    n = _t(spark, d, "news_articles")
    return n.select("id", F.coalesce(quality.filled(*(F.col(c) for c in ("id", "source_url", "title", "text", "clean_status", "category"))) & (F.col("language") == "id"), F.lit(False)).alias("valid"))


@query("SELECT id, unnest(list_filter([CASE WHEN coalesce(id, '') = '' THEN 'missing_id' END, CASE WHEN coalesce(text, '') = '' THEN 'missing_text' END, CASE WHEN coalesce(meta.lang, '') = '' THEN 'missing_lang' END, CASE WHEN coalesce(meta.url, '') = '' THEN 'missing_url' END, CASE WHEN coalesce(content_info.subdomain, '') = '' THEN 'missing_subdomain' END, CASE WHEN length(coalesce(text, '')) < 200 THEN 'text_too_short' END], lambda x: x IS NOT NULL)) AS error FROM export_entries")
def filt_entry_errors(spark, d):
    e = _t(spark, d, "export_entries")
    return e.select("id", F.explode(quality.entry_errors({"id": F.col("id"), "text": F.col("text"), "lang": F.col("meta.lang"), "url": F.col("meta.url"), "subdomain": F.col("content_info.subdomain")})).alias("error"))


@query("SELECT id, (contains(source_url, '.test') AND (contains(source_url, '/berita/') OR contains(source_url, '/read/') OR contains(source_url, '/news/')) AND regexp_matches(source_url, '-[0-9a-f]+$')) IS TRUE AS article FROM news_articles")
def filt_article_urls(spark, d):
    return _t(spark, d, "news_articles").select("id", urls.article(F.col("source_url"), ".test", ("/berita/", "/read/", "/news/"), "-[0-9a-f]+$").alias("article"))


@query("SELECT page_id FROM fetch_results WHERE starts_with(content_type, 'text/html') OR starts_with(content_type, 'application/xhtml') OR starts_with(content_type, 'text/plain') OR starts_with(content_type, 'application/xml') OR starts_with(content_type, 'text/xml')")
def filt_content_types(spark, d):
    c = F.col("content_type")
    return _t(spark, d, "fetch_results").where(c.startswith("text/html") | c.startswith("application/xhtml") | c.startswith("text/plain") | c.startswith("application/xml") | c.startswith("text/xml")).select("page_id")


@query(f"SELECT id, regexp_matches(lower(coalesce(title, '') || ' ' || text), {_q(chr(92) + 'b(?:' + '|'.join(classify.EXCLUDED) + ')' + chr(92) + 'b')}) AS excluded FROM news_articles")
def filt_excluded(spark, d):
    return _t(spark, d, "news_articles").select("id", classify.excluded(F.col("title"), F.col("text")).alias("excluded"))


_PROMO_SQL = " + ".join(_count("lower(text)", rf"\b(?:{p})\b") for p in classify.PROMOTION)
_PIECES = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"SELECT id, length({_strip('text')}) < 100 OR ({_count('text', _PIECES)} > 0 AND ({_PROMO_SQL}) / {_count('text', _PIECES)} > 0.1) OR (upper(text) = text AND lower(text) <> text AND length(text) > 50) OR (len(string_split(text, '.')) > 3 AND len(list_distinct(list_transform(string_split(text, '.'), lambda s: lower({_strip('s')})))) / len(string_split(text, '.')) < 0.7) AS low_quality FROM news_articles")
def filt_low_quality(spark, d):
    return _t(spark, d, "news_articles").select("id", classify.low_quality(F.col("text")).alias("low_quality"))


_GARBLED_SQL = (
    f"length(text) >= 50 AND ((length(text) - {_count('text', '[' + chr(92) + 'p{C}' + chr(92) + 'p{Zl}' + chr(92) + 'p{Zp}' + chr(92) + 'x{a0}' + chr(92) + 'x{1680}' + chr(92) + 'x{2000}-' + chr(92) + 'x{200a}' + chr(92) + 'x{202f}' + chr(92) + 'x{205f}' + chr(92) + 'x{3000}]')}) / length(text) < 0.9"
    f" OR {_count('text', text.LETTER + '+')} = 0 OR ({_count('text', text.LETTER + '+')} - {_count('text', text.LETTER + '{2,}')}) / greatest(1, {_count('text', text.LETTER + '+')}) > 0.3"
    f" OR ({_count('text', '[.!?]+')} >= 1 AND {_count(_rep('text', ('[.!?]+', ' ')), _PIECES)} / ({_count('text', '[.!?]+')} + 1) < 3))"
)


@query(f"SELECT id, coalesce({_GARBLED_SQL}, false) AS garbled FROM export_entries")
def filt_garbled(spark, d):
    return _t(spark, d, "export_entries").select("id", quality.garbled(F.col("text")).alias("garbled"))


@query(f"SELECT doc_id, array_to_string(list_filter([CASE WHEN length(text) < 200 THEN 'too_short' END, CASE WHEN {_strip('text')} = '' THEN 'empty_after_cleaning' END, CASE WHEN {_GARBLED_SQL} THEN 'garbled_content' END], lambda x: x IS NOT NULL), ',') AS issues FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def filt_issues(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.array_join(quality.issues(F.col("text")), ",").alias("issues"))


@query(f"SELECT id, doc_id FROM deduplication_index WHERE created_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 30 DAY")
def filt_expired(spark, d):
    return _t(spark, d, "deduplication_index").where(frontier.expired(F.col("created_at"), F.lit(NOW).cast("timestamp"))).select("id", "doc_id")


@query(f"SELECT id FROM news_articles WHERE length({_strip('title')}) > 10 AND length({_strip('text')}) > 100 AND {_strip('source_url')} <> ''")
def filt_report_guards(spark, d):
    return _t(spark, d, "news_articles").where((F.length(text.strip(F.col("title"))) > 10) & (F.length(text.strip(F.col("text"))) > 100) & (text.strip(F.col("source_url")) != "")).select("id")


# --- joins ---------------------------------------------------------------------------------------------------------


@query("SELECT batch_no, id, source_url FROM incoming_articles i WHERE source_url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM news_articles n WHERE n.source_url = i.source_url)")
def join_unseen(spark, d):
    new, old = _t(spark, d, "incoming_articles").where("source_url IS NOT NULL"), _t(spark, d, "news_articles")
    return new.withColumn("h", urls.url_hash(F.col("source_url"))).join(old.select(urls.url_hash(F.col("source_url")).alias("h")).where("h IS NOT NULL").distinct(), "h", "left_anti").select("batch_no", "id", "source_url")


_HASH_SQL = f"sha256({_strip(_rep('lower(text)', (SPACE + '+', ' '), (NO_LETTER_NO_SPACE, '')))})"


@query(f"SELECT i.id FROM (SELECT id, {_HASH_SQL} AS h FROM incoming_articles WHERE text IS NOT NULL) i WHERE h IN (SELECT exact_hash FROM deduplication_index)")
def join_known_hash(spark, d):
    return dedup.known(_t(spark, d, "incoming_articles").where("text IS NOT NULL"), _t(spark, d, "deduplication_index"), ids.content_hash(F.col("text")), "exact_hash").select("id")


@query("WITH v AS (SELECT simhash, count(*) AS members, ('0x' || simhash)::UBIGINT AS n FROM deduplication_index WHERE simhash IS NOT NULL GROUP BY simhash) SELECT a.simhash, a.members, (SELECT count(*) FROM v b WHERE b.n <> a.n AND bit_count(xor(a.n, b.n)) <= 3) AS links FROM v a")
def join_hamming(spark, d):
    """Every signature with its rows and the number of other signatures within 3 bits."""
    s = _t(spark, d, "deduplication_index").select(ids.simhash_number(F.col("simhash")).alias("signature"))
    counts = dedup.link_counts(dedup.hamming_links(s), s)
    return counts.select(F.lower(F.lpad(F.hex("signature"), 16, "0")).alias("simhash"), "members", "links")


@query("SELECT q.vec_id AS query, v.vec_id AS neighbour, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) DESC, v.vec_id) AS place FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 QUALIFY place <= 10")
def join_nearest(spark, d):
    v = _t(spark, d, "embeddings")
    return dedup.nearest(v.where("vec_id % 50 = 0"), v, "vec_id", "embedding", 10).select("query", "neighbour", F.round("cosine", 6).alias("cosine"), F.col("place").cast("long").alias("place"))


@query("SELECT e.id, e.text, c.topic, c.confidence FROM export_entries e LEFT JOIN classification_results c ON c.doc_id = e.id")
def join_classified(spark, d):
    c = _t(spark, d, "classification_results").select("doc_id", "topic", "confidence")
    return _t(spark, d, "export_entries").join(c, F.col("id") == F.col("doc_id"), "left").select("id", "text", "topic", "confidence")


@query("WITH k(keyword, topic) AS (VALUES " + ", ".join(f"('{w}', '{t[0]}')" for t in classify.TOPICS for w in t[3]) + "), u AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS keyword FROM documents) SELECT k.topic, count(*) AS documents FROM u JOIN k USING (keyword) GROUP BY k.topic")
def join_keywords(spark, d):
    k = F.broadcast(classify.keyword_index(spark))  # a fixed table
    return _t(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1))).alias("keyword")).join(k, "keyword").groupBy("topic").agg(F.count("*").alias("documents"))


@query("SELECT n.n_name, year(o.o_orderdate)::BIGINT AS year, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL")
def join_star(spark, d):
    t = lambda n: _t(spark, d, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", F.year("o_orderdate").cast("long").alias("year")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


# --- aggregates ----------------------------------------------------------------------------------------------------


@query("WITH f AS (SELECT coalesce(nullif(clean_status, ''), 'unknown') AS clean_status, coalesce(nullif(language, ''), 'unknown') AS language, coalesce(nullif(category, ''), 'unknown') AS category, length(coalesce(text, '')) AS t, length(coalesce(title, '')) AS h FROM news_articles), p AS (SELECT NULL AS field, NULL AS value, t, h FROM f UNION ALL SELECT 'clean_status', clean_status, t, h FROM f UNION ALL SELECT 'language', language, t, h FROM f UNION ALL SELECT 'category', category, t, h FROM f) SELECT field, value, count(*) AS records, sum(t)::BIGINT AS text_chars, sum(h)::BIGINT AS title_chars, (sum(t) // count(*))::BIGINT AS mean_text, (sum(h) // count(*))::BIGINT AS mean_title FROM p GROUP BY ALL")
def agg_histograms(spark, d):
    return stats.histograms(_t(spark, d, "news_articles"), ["clean_status", "language", "category"], "text", "title")


@query("SELECT md5(text) AS signature, count(*) AS members, min(id) AS first_member FROM news_articles WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def agg_duplicate_groups(spark, d):
    return dedup.duplicate_groups(_t(spark, d, "news_articles"), F.md5("text"), "id")


@query("WITH g AS (SELECT count(*) AS members FROM news_articles WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1), t AS (SELECT count(*) AS records FROM news_articles) SELECT (SELECT count(*) FROM g) AS groups, (SELECT coalesce(sum(members), 0) FROM g)::BIGINT AS members, records, (records - ((SELECT coalesce(sum(members), 0) FROM g) - (SELECT count(*) FROM g)))::BIGINT AS unique_records, round(100.0::DOUBLE * (SELECT coalesce(sum(members), 0) FROM g) / records, 6) AS duplicate_rate FROM t")
def agg_duplicate_summary(spark, d):
    n = _t(spark, d, "news_articles")
    return stats.duplicate_summary(dedup.duplicate_groups(n, F.md5("text"), "id"), n.agg(F.count("*").alias("records")))


@query(f"SELECT id, title FROM news_articles QUALIFY row_number() OVER (PARTITION BY {_strip('coalesce(title, ' + chr(39) * 2 + ')')}, {_strip('coalesce(text, ' + chr(39) * 2 + ')')}, {_strip('coalesce(source_url, ' + chr(39) * 2 + ')')} ORDER BY id) = 1")
def agg_keep_first(spark, d):
    n = _t(spark, d, "news_articles").select("id", "title", "text", "source_url")
    return dedup.keep_first(n, [ids.article_signature(F.col("title"), F.col("text"), F.col("source_url"))], [F.col("id")]).select("id", "title")


@query("SELECT strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS domain, count(*) AS pages, count(*) FILTER (WHERE success) AS successes, coalesce(sum(content_length), 0)::BIGINT AS bytes, round(sum(coalesce(response_time, 0)), 4) AS seconds FROM fetch_results WHERE url IS NOT NULL GROUP BY ALL")
def agg_crawl_days(spark, d):
    f = _t(spark, d, "fetch_results").where("url IS NOT NULL")
    return f.groupBy(F.date_format("fetched_at", "yyyy-MM-dd").alias("day"), urls.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("pages"), F.count_if("success").alias("successes"), F.coalesce(F.sum(F.col("content_length").cast("long")), F.lit(0)).alias("bytes"), F.round(F.sum(F.coalesce("response_time", F.lit(0.0))), 4).alias("seconds"))


@query("SELECT count(*) AS requests, coalesce(sum(content_length), 0)::BIGINT AS bytes, round(count(*) FILTER (WHERE success) / count(*), 6) AS success_rate, round(avg(response_time), 6) AS mean_time FROM fetch_results")
def agg_fetch_totals(spark, d):
    return _t(spark, d, "fetch_results").agg(F.count("*").alias("requests"), F.coalesce(F.sum(F.col("content_length").cast("long")), F.lit(0)).alias("bytes"), F.round(stats.ratio(F.count_if("success"), F.count("*")), 6).alias("success_rate"), F.round(F.avg("response_time"), 6).alias("mean_time"))


@query("SELECT rejection_reason, count(*) AS entries FROM classification_results WHERE NOT is_allowed GROUP BY rejection_reason")
def agg_rejections(spark, d):
    return _t(spark, d, "classification_results").where("NOT is_allowed").groupBy("rejection_reason").agg(F.count("*").alias("entries"))


@query("SELECT count(*) AS checked, count(*) FILTER (WHERE is_allowed) AS allowed, round(count(*) FILTER (WHERE is_allowed) / count(*), 6) AS acceptance FROM classification_results")
def agg_acceptance(spark, d):
    return _t(spark, d, "classification_results").agg(F.count("*").alias("checked"), F.count_if("is_allowed").alias("allowed"), F.round(stats.ratio(F.count_if("is_allowed"), F.count("*")), 6).alias("acceptance"))


@query("SELECT coalesce(status_code, 0)::BIGINT AS status_code, success, count(*) AS pages FROM fetch_results GROUP BY ALL")
def agg_by_status(spark, d):
    return _t(spark, d, "fetch_results").groupBy(F.coalesce("status_code", F.lit(0)).cast("long").alias("status_code"), "success").agg(F.count("*").alias("pages"))


_TOKENS = f"regexp_extract_all(lower(content), {_q(text.LETTER + '+')})"


@query(f"SELECT page_id, {_count('content', text.LETTER + '+')}::BIGINT AS words, len(list_distinct({_TOKENS}))::BIGINT AS different, {_count('content', '[.!?]+' + SPACE + '+[A-Z]')}::BIGINT AS sentences, greatest(1, {_count('content', text.LETTER + '+')} // 200)::BIGINT AS minutes FROM extracted_content WHERE content IS NOT NULL")
def agg_text_figures(spark, d):
    e = _t(spark, d, "extracted_content").where("content IS NOT NULL")
    tokens = F.regexp_extract_all(F.lower("content"), F.lit(f"({text.LETTER}+)"), 1)
    return e.select("page_id", text.words(F.col("content")).alias("words"), F.size(F.array_distinct(tokens)).cast("long").alias("different"), text.sentence_ends(F.col("content")).alias("sentences"), quality.reading_minutes(F.col("content")).alias("minutes"))


@query("SELECT thread_url, coalesce(string_agg(body, chr(10) || chr(10) ORDER BY comment_id) FILTER (WHERE body <> ''), '') AS replies_body FROM (SELECT DISTINCT thread_url, comment_id, body FROM reddit_comments) GROUP BY thread_url")
def agg_replies(spark, d):
    c = _t(spark, d, "reddit_comments").select("thread_url", "comment_id", "body").distinct()
    return threads.joined_replies(c, "thread_url", "body", ["comment_id"])


# --- windows, sorting, sets ----------------------------------------------------------------------------------------


@query("SELECT site, id, place FROM (SELECT regexp_replace(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS site, id, row_number() OVER (PARTITION BY site ORDER BY scraped_at DESC NULLS LAST, id) AS place FROM (SELECT DISTINCT source_url, id, scraped_at FROM news_articles WHERE source_url LIKE 'http%')) WHERE place <= 5")
def win_next_per_site(spark, d):
    n = _t(spark, d, "news_articles").select("source_url", "id", "scraped_at").where("source_url LIKE 'http%'").distinct().withColumn("site", urls.domain(F.col("source_url")))
    return frontier.next_per_domain(n, "site", [F.col("scraped_at").desc_nulls_last(), F.col("id")], 5).select("site", "id", F.col("place").cast("long").alias("place"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS in_window FROM events")
def win_rate(spark, d):
    return frontier.within_window(_t(spark, d, "events"), "user_id", "ts").select("event_id", "in_window")


@query("SELECT event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS gap_seconds FROM events")
def win_gap(spark, d):
    return frontier.since_previous(_t(spark, d, "events"), "user_id", "ts", "event_id").select("event_id", F.round("gap_seconds", 6).alias("gap_seconds"))


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS candidates FROM events")
def win_newest_candidates(spark, d):
    return dedup.newest_candidates(_t(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type").select("event_id", "candidates")


@query("WITH e AS (SELECT user_id, event_id, (value < 50)::INT AS e FROM events), i AS (SELECT *, sum(1 - e) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e), r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS k FROM i WHERE e = 1) SELECT user_id, min(event_id) AS stop_at FROM r WHERE k = 5 GROUP BY user_id")
def win_streak(spark, d):
    return frontier.first_streak(_t(spark, d, "events").where("value IS NOT NULL"), "user_id", "event_id", F.col("value") < 50)


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 1000)::BIGINT AS shard FROM documents")
def win_shards(spark, d):
    return stats.shards(_t(spark, d, "documents").select("doc_id"), [F.col("doc_id")], 1000)


@query("SELECT text, count(*) AS members, min(id) AS first_member FROM news_articles WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1 ORDER BY members DESC, first_member LIMIT 5")
def sort_largest_groups(spark, d):
    n = _t(spark, d, "news_articles").where("text IS NOT NULL").groupBy("text").agg(F.count("*").alias("members"), F.min("id").alias("first_member"))
    return n.where("members > 1").orderBy(F.desc("members"), "first_member").limit(5)


@query("SELECT id, source_url FROM news_articles UNION ALL SELECT id, source_url FROM incoming_articles")
def set_union(spark, d):
    return _t(spark, d, "news_articles").select("id", "source_url").unionByName(_t(spark, d, "incoming_articles").select("id", "source_url"))


@query("SELECT source_url FROM incoming_articles EXCEPT SELECT source_url FROM news_articles")
def set_new_urls(spark, d):
    return _t(spark, d, "incoming_articles").select("source_url").subtract(_t(spark, d, "news_articles").select("source_url"))


@query("SELECT source_url, min(id) AS first_id FROM (SELECT id, source_url FROM news_articles UNION ALL SELECT id, source_url FROM incoming_articles) WHERE source_url <> '' GROUP BY source_url")
def set_distinct_urls(spark, d):
    return set_union(spark, d).where("source_url <> ''").groupBy("source_url").agg(F.min("id").alias("first_id"))


# --- text ----------------------------------------------------------------------------------------------------------


@query(f"SELECT comment_id, coalesce({_squeeze(_rep('body', (text.USER_V1, ''), (text.URL_HTTP, ''), (text.URL_WWW, ''), (text.MAIL_V1, ''), (text.PHONE_V1, ''), (text.ODD_V1, ' ')))}, '') AS cleaned FROM reddit_comments")
def text_thread_v1(spark, d):
    return _t(spark, d, "reddit_comments").select("comment_id", text.thread_text_v1(F.col("body")).alias("cleaned"))


_BLANK = r"[\t\x0b\x0c\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_V2_SQL = _rep("body", (rf"(?m)^{SPACE}*>{SPACE}*", ""), (text.USER_V2, ""), (text.URL_HTTP, ""), (text.MAIL_V2, ""), (text.PHONE_V2, ""), (f"{text.EMOJI}+", ""))
_V2_SQL = _strip(_rep(f"replace(replace(replace({_V2_SQL}, '&gt;', '>'), '&lt;', '<'), '&amp;', '&')", (_BLANK, " "), (r"[ \t\r\f\x0b]+", " "), (r"\n{3,}", "\n\n")))


@query(f"SELECT comment_id, coalesce({_V2_SQL}, '') AS cleaned FROM reddit_comments")
def text_thread_v2(spark, d):
    return _t(spark, d, "reddit_comments").select("comment_id", text.thread_text_v2(F.col("body")).alias("cleaned"))


@query(f"SELECT id, coalesce({_rep(_squeeze('text'), ('[' + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0b-' + chr(92) + 'x1f]', ''))}, '') AS cleaned FROM news_articles")
def text_news(spark, d):
    return _t(spark, d, "news_articles").select("id", text.news_text(F.col("text")).alias("cleaned"))


def _residue_sql() -> str:
    e = "text"
    for x in text.NEWS_LITERALS:
        e = f"replace({e}, '{x}', '')"
    e = _rep(_squeeze(e), ("^ *- *", ""), *((f" *{c} *", "") for c in text.NEWS_CODES))
    return f"SELECT id, {_strip('CASE WHEN trim(tail) <> ' + chr(39) * 2 + ' AND len(regexp_split_to_array(trim(tail), ' + chr(39) + ' +' + chr(39) + ')) <= 5 THEN substring(c, 1, length(c) - length(tail)) ELSE c END')} AS cleaned FROM (SELECT id, c, regexp_extract(c, ' +[a-z ]+$') AS tail FROM (SELECT id, {e} AS c FROM news_articles))"


@query(_residue_sql())
def text_news_residue(spark, d):
    return _t(spark, d, "news_articles").select("id", text.news_without_residue(F.col("text")).alias("cleaned"))


@query("SELECT page_id, " + _strip(_rep("content", *(("(?i)" + p, "") for p in text.PAGE_PHRASES), (SPACE + "+", " "), (r"([.!?]) *([.!?])+", r"\1"))) + " AS cleaned FROM extracted_content")
def text_page(spark, d):
    return _t(spark, d, "extracted_content").select("page_id", text.page_text(F.col("content")).alias("cleaned"))


_NORMAL_SQL = _strip(_rep(
    "text", (r"[\x00-\x1f\x7f-\x{9f}]", ""), (" {2,}", " "), (r"\.{2,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?"), (SPACE + r"+([.!?,:;])", r"\1"), ("[\"'`]", '"'), ('"{2,}', '"'),
    ("[•·▪▫‣⁃]", "•"), ("[—–]", "—"), ("…", "..."), (r"(\d+) +(cm|mm|km|m|ft|in|lb|kg|oz|g)\b", r"\1\2"),
))


@query(f"SELECT doc_id, {_NORMAL_SQL} AS cleaned FROM documents")
def text_normalised(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.normalised(F.col("text")).alias("cleaned"))


def _counts_sql() -> str:
    plain = _rep("text", (text.CONTROL, ""))
    spaced = _rep(plain, (r"[ \t]+", " "), (r"[ \t]+$", ""))
    marks = _rep(spaced, (r"\.{2,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?"))
    fixed = _rep(marks, (SPACE + r"+([.!?,:;])", r"\1"))
    return f"""WITH s AS (SELECT doc_id, text, {plain} AS p, {spaced} AS s, {marks} AS m, {fixed} AS f FROM documents)
SELECT doc_id, {_count('text', text.CONTROL)}::BIGINT AS control_chars, {_count('text', text.EMOJI)}::BIGINT AS emojis, ({_count('p', ' ')} - {_count('s', ' ')})::BIGINT AS spaces, ({_count('s', '[.!?]')} - {_count('m', '[.!?]')})::BIGINT AS punctuation, {_count('f', '["' + "'" + '`]')}::BIGINT AS quotes,
({_count('f', '[•·▪▫‣⁃]')} + {_count('f', '[—–]')} + {_count('f', '…')})::BIGINT AS special, ({_count('f', chr(92) + 'd+ *° *[CF]')} + {_count('f', chr(92) + 'd+ *(?:cm|mm|km|m|ft|in|lb|kg|oz|g)' + chr(92) + 'b')})::BIGINT AS units, 0::BIGINT AS linebreaks FROM s"""


@query(_counts_sql())
def text_counts(spark, d):
    """All counts of what normalisation changes, and of emoji; line ends go with the control characters and so count nothing."""
    names = {"control_chars": "control_chars_removed", "spaces": "spaces_normalized", "punctuation": "punctuation_normalized", "quotes": "quotes_normalized", "special": "special_chars_normalized", "units": "units_normalized", "linebreaks": "linebreaks_normalized"}
    counted = _t(spark, d, "documents").select("doc_id", text.change_counts(F.col("text")).alias("c"), text.emojis(F.col("text")).alias("emojis"))
    return counted.select("doc_id", "emojis", *(F.col("c")[key].cast("long").alias(name) for name, key in names.items()))


@query()
def text_clean_documents(spark, d):
    """The whole cleaning of a document: emoji, forms, marks, personal data, problems, score."""
    return corpus.cleaned(spread(_t(spark, d, "documents").select("doc_id", "text")), "text").select("doc_id", "cleaned_text", "pii_found", "emojis_removed", "issues", F.round("quality_score", 6).alias("quality_score"))


def _mask_sql() -> str:
    """One step of the cascade per subquery: the text after it, and the kind if it has hit."""
    stay = ", ".join(f"'{p}'" for p in pii.PLACEHOLDERS)
    q = "SELECT doc_id, original_text AS s0 FROM cleaning_results"
    for k, (kind, pattern, by) in enumerate(pii.STEPS):
        s = f"s{k}"
        if kind in ("account", "name"):
            found = f"list_filter(regexp_extract_all({s}, {_q(pattern)}), lambda m: m NOT IN ({stay if kind == 'name' else _q('')}))"
            put = "repeat('x', length(m)::INT)" if by is None else _q(by)
            after, hit = f"list_reduce({found}, lambda t, m: replace(t, m, {put}), {s})", f"len({found}) > 0"
        else:
            after, hit = _rep(s, (pattern, by)), f"regexp_matches({s}, {_q(pattern)})"
        q = f"SELECT *, {after} AS s{k + 1}, CASE WHEN {hit} THEN '{kind}' END AS k{k} FROM ({q})"
    n = len(pii.STEPS)
    seen = [kind for kind, _, _ in pii.STEPS]
    marks = ", ".join("CASE WHEN " + " OR ".join(f"k{j} IS NOT NULL" for j in range(n) if seen[j] == kind) + f" THEN '{kind}' END" for kind in dict.fromkeys(seen))
    return f"SELECT doc_id, s{n} AS masked, CASE WHEN s0 IS NULL THEN '' ELSE array_to_string(list_filter([{marks}], lambda x: x IS NOT NULL), ',') END AS pii_found FROM ({q})"


@query(_mask_sql())
def text_masked(spark, d):
    return pii.mask(_t(spark, d, "cleaning_results").select("doc_id", "original_text"), "original_text").select("doc_id", F.col("masked_text").alias("masked"), F.array_join("pii_found", ",").alias("pii_found"))


@query()
def text_nfkc(spark, d):
    return _t(spark, d, "documents").select("doc_id", nfkc(F.col("text")).alias("plain"))


# --- addresses and ids ---------------------------------------------------------------------------------------------


@query(f"SELECT id, CASE WHEN text = '' THEN '' ELSE {_HASH_SQL} END AS content_hash FROM news_articles")
def id_content_hash(spark, d):
    return _t(spark, d, "news_articles").select("id", ids.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT id, substring(sha256(source_url || '#' || substring(sha256(text), 1, 16)), 1, 16) AS document_id, substring(sha256(source_url || '#' || sha256(text)), 1, 16) AS export_id, sha256(source_url) AS url_hash FROM news_articles")
def id_documents(spark, d):
    u, t = F.col("source_url"), F.col("text")
    return _t(spark, d, "news_articles").select("id", ids.document_id(u, t).alias("document_id"), ids.export_id(u, t).alias("export_id"), urls.url_hash(u).alias("url_hash"))


@query("WITH p AS (SELECT DISTINCT source_url, regexp_replace(source_url, '#.*$', '') AS plain FROM (SELECT source_url FROM news_articles UNION ALL SELECT source_url FROM incoming_articles) WHERE source_url IS NOT NULL), k AS (SELECT source_url, regexp_extract(plain, '^([^?]*)', 1) AS base, list_sort(list_filter(string_split(regexp_extract(plain, '\\?(.*)$', 1), '&'), lambda x: regexp_matches(x, '^[^=]+=.+'))) AS kept FROM p) SELECT source_url, base || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS normal FROM k")
def id_normal_urls(spark, d):
    return set_union(spark, d).select("source_url").where("source_url IS NOT NULL").distinct().select("source_url", urls.normal(F.col("source_url")).alias("normal"))


@query("SELECT page_id, CASE WHEN h = '' THEN 'unknown' ELSE h END AS domain FROM (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS h FROM fetch_results WHERE url IS NOT NULL)")
def id_domains(spark, d):
    return _t(spark, d, "fetch_results").where("url IS NOT NULL").select("page_id", urls.domain(F.col("url")).alias("domain"))


@query("SELECT comment_id, CASE WHEN coalesce(thread_url, '') = '' THEN '' WHEN thread_url LIKE 'http%' THEN thread_url WHEN thread_url LIKE '/%' THEN 'https://threads.example' || thread_url ELSE 'https://threads.example/' || thread_url END AS url, coalesce(nullif(regexp_extract(thread_url, '/r/([^/]+)/', 1), ''), 'Cooking') AS subreddit FROM reddit_comments")
def id_threads(spark, d):
    u = F.col("thread_url")
    return _t(spark, d, "reddit_comments").select("comment_id", urls.absolute_v2(u, "https://threads.example").alias("url"), urls.group_v2(u).alias("subreddit"))


@query("SELECT strftime(m, '%m/%d/%Y') AS first_day, strftime(last_day(m), '%m/%d/%Y') AS last_day, strftime(m, '%m_%d_%Y') || '_to_' || strftime(last_day(m), '%m_%d_%Y') || '_output.jsonl' AS name FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2025-09-01', INTERVAL 1 MONTH))::DATE AS m)")
def id_months(spark, d):
    from lontar.functions.dates import months

    return months(spark, "2020-01-01", "2025-09-01")


def _simhash_sql(texts: str) -> str:
    """CTEs ``simhashes`` (``text, n`` as an unsigned number) of the different filled texts of ``texts``."""
    bits = " + ".join(f"CASE WHEN 2 * sum((h >> {k}) & 1) > count(*) THEN {1 << k}::UBIGINT ELSE 0::UBIGINT END" for k in range(64))
    return f"""words AS (SELECT text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM (SELECT DISTINCT text FROM ({texts}) WHERE text IS NOT NULL)),
grams AS (SELECT text, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]), list_transform(range(1, greatest(1, len(w) - 1)), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])))) AS g FROM words),
features AS (SELECT text, ('0x' || substring(md5(g), 17, 16))::UBIGINT AS h FROM grams),
simhashes AS (SELECT text, {bits} AS n FROM features GROUP BY text)"""


@query(f"WITH {_simhash_sql('SELECT text FROM news_articles')} SELECT a.id, CASE WHEN s.n IS NULL THEN '' ELSE lpad(lower(to_hex(s.n)), 16, '0') END AS simhash FROM news_articles a LEFT JOIN simhashes s ON s.text = a.text")
def id_simhash(spark, d):
    return ids.simhashes(spread(_t(spark, d, "news_articles").select("id", "text")), "text").select("id", "simhash")


# --- classification, extraction, cascades --------------------------------------------------------------------------


def _score_sql(full: str) -> str:
    parts = []
    for rank, (topic, _, patterns, keywords) in enumerate(classify.TOPICS):
        hits = " + ".join([f"2 * {_count(full, chr(92) + 'b(?:' + p + ')' + chr(92) + 'b')}" for p in patterns] + [f"((length({full}) - length(replace({full}, '{w}', ''))) // {len(w)})" for w in keywords])
        parts.append(f"{{'score': round(({hits}) / w, 9), 'rank': {-rank}, 'topic': '{topic}'}}")
    return "[" + ", ".join(parts) + "]"


_SCORED_SQL = f"WITH f AS (SELECT doc_id, text, lower(coalesce(title, '') || ' ' || text) AS full_text FROM documents), g AS (SELECT *, CASE WHEN {_count('full_text', _PIECES)} > 0 THEN ln({_count('full_text', _PIECES)} + 1.0) ELSE 1.0 END AS w FROM f), s AS (SELECT doc_id, text, full_text, list_reverse_sort({_score_sql('full_text')}) AS s FROM g)"


@query(f"{_SCORED_SQL} SELECT doc_id, s[1].topic AS topic, round(s[1].score, 6) AS best, round(s[2].score, 6) AS second FROM s")
def class_scores(spark, d):
    return _class_scores(spread(_t(spark, d, "documents").select("doc_id", "title", "text")))


def _class_scores(e: DataFrame) -> DataFrame:
    s = F.sort_array(classify.scores(F.col("title"), F.col("text")), asc=False)
    return e.select("doc_id", s.alias("s")).select("doc_id", F.col("s")[0]["topic"].alias("topic"), F.round(F.col("s")[0]["score"], 6).alias("best"), F.round(F.col("s")[1]["score"], 6).alias("second"))


_LOW_SQL = f"length({_strip('text')}) < 100 OR ({_count('text', _PIECES)} > 0 AND ({_PROMO_SQL}) / {_count('text', _PIECES)} > 0.1) OR (upper(text) = text AND lower(text) <> text AND length(text) > 50) OR (len(string_split(text, '.')) > 3 AND len(list_distinct(list_transform(string_split(text, '.'), lambda s: lower({_strip('s')})))) / len(string_split(text, '.')) < 0.7)"
_DECIDED_SQL = f"""{_SCORED_SQL}, c AS (SELECT doc_id, text, full_text, s[1].topic AS t, s[1].score AS b, s[2].score AS r, {_strip('text')} = '' AS empty FROM s),
k AS (SELECT *, CASE WHEN r = 0 THEN least(b / 5.0, 1.0) ELSE least(b / r / 3.0, 1.0) END AS conf FROM c),
e AS (SELECT *, CASE WHEN empty THEN 'empty_content' WHEN b = 0 THEN 'no_matching_topics' WHEN conf < 0.3 THEN 'low_confidence_' || printf('%.2f', conf) END AS why FROM k),
v AS (SELECT *, CASE WHEN why IS NULL AND regexp_matches(full_text, {_q(chr(92) + 'b(?:' + '|'.join(classify.EXCLUDED) + ')' + chr(92) + 'b')}) THEN 'excluded_topic' WHEN why IS NULL AND ({_LOW_SQL}) THEN 'low_quality' END AS gone FROM e)
SELECT doc_id, CASE WHEN why IS NULL AND gone IS NULL THEN t END AS topic, CASE WHEN NOT empty AND b > 0 AND gone IS NULL THEN CASE t {' '.join(f"WHEN '{t[0]}' THEN '{t[1]}'" for t in classify.TOPICS)} ELSE t END END AS subdomain,
round(CASE WHEN empty OR b = 0 OR gone IS NOT NULL THEN 0.0 ELSE conf END, 6)::DOUBLE AS confidence, round(CASE WHEN empty THEN 0.0 ELSE b END, 6)::DOUBLE AS rule_score, why IS NULL AND gone IS NULL AS is_allowed, coalesce(gone, why) AS rejection_reason FROM v"""


@query(_DECIDED_SQL)
def class_documents(spark, d):
    docs = spread(_t(spark, d, "documents").select("doc_id", "title", "text"))
    out = classify.validated(classify.classify(docs, "title", "text"), "title", "text")
    return out.select("doc_id", "topic", "subdomain", F.round("confidence", 6).alias("confidence"), F.round("rule_score", 6).alias("rule_score"), "is_allowed", "rejection_reason")


@query("SELECT page_id, nullif(trim(regexp_extract(content, '(?s)<title>([^<]*)</title>', 1)), '') AS title FROM fetch_results WHERE success")
def html_titles(spark, d):
    return _t(spark, d, "fetch_results").where("success").select("page_id", html.title_of(F.col("content")).alias("title"))


def _last_fetches(spark: SparkSession, d: str) -> DataFrame:
    """``page_id, url, content`` of the last successful fetch of each page."""
    f = _t(spark, d, "fetch_results").where("success")
    last = f.groupBy("page_id").agg(F.max_by(F.struct("url", "content"), F.struct("fetched_at", F.xxhash64("content"), "url")).alias("f"))
    return last.select("page_id", "f.url", "f.content")


@query()
def html_extracted(spark, d):
    return html.extract(_last_fetches(spark, d), "content").select("page_id", "title", "content", "author", "publish_date", "word_count", "reading_time", "extraction_method", F.round("quality_score", 6).alias("quality_score"))


@query()
def html_best(spark, d):
    """Of four methods the best result of each page."""
    return html.extract(spread(_last_fetches(spark, d)), "content", html.METHODS).select("page_id", "title", "content", "extraction_method", F.round("quality_score", 6).alias("quality_score"))


_SITE = news.Site(items=("article", "li"), titles=("h2 a", "h3 a", "a"), links=("h2 a", "h3 a", "a"), bodies=(".story-body", ".entry-content", "main"))


@query()
def scan_list_pages(spark, d):
    """Articles that the items of all pages link to, each address once, those of the history left out."""
    return news.list_pages(spread(_last_fetches(spark, d)), "content", "url", _SITE, _t(spark, d, "news_articles"))


@query("SELECT DISTINCT page_id, coalesce(trim(regexp_extract(content, '(?s)<h1[^>]*>([^<&]*)</h1>', 1)), '') AS heading FROM fetch_results WHERE success AND regexp_matches(content, '(?s)<h1[^>]*>[^<&]*</h1>') AND NOT regexp_matches(content, '(?s)<h1.*<h1')")
def html_articles(spark, d):
    """Title and body of all article pages; compared are the titles of pages with one plain heading."""
    f = _t(spark, d, "fetch_results").where("success")
    plain = F.col("content").rlike(r"(?s)<h1[^>]*>[^<&]*</h1>") & ~F.col("content").rlike(r"(?s)<h1.*<h1")
    return news.articles(f.select("page_id", "content", plain.alias("plain")), "content").where("plain").select("page_id", F.col("title").alias("heading")).distinct()


@query(f"WITH f AS (SELECT page_id, title, author, publish_date, description, keywords, content, {_TOKENS} AS tokens, {_count('content', '[.!?]+' + SPACE + '+[A-Z]')} AS s FROM extracted_content WHERE content IS NOT NULL) SELECT page_id, round(least(100, CASE WHEN length(content) >= 200 THEN least(length(content) / 100, 30) ELSE 0 END + CASE WHEN length(coalesce(title, '')) > 10 THEN 10 ELSE 0 END + CASE WHEN s > 5 THEN least(s, 20) ELSE 0 END + CASE WHEN len(tokens) > 0 THEN 10 * len(list_distinct(tokens)) / len(tokens) ELSE 0 END + CASE WHEN coalesce(author, '') <> '' THEN 2 ELSE 0 END + CASE WHEN coalesce(publish_date, '') <> '' THEN 2 ELSE 0 END + CASE WHEN coalesce(description, '') <> '' THEN 3 ELSE 0 END), 6)::DOUBLE AS score FROM f")
def html_scores(spark, d):
    e = _t(spark, d, "extracted_content").where("content IS NOT NULL")
    c = [F.col(x) for x in ("content", "title", "author", "publish_date", "description")]
    return e.select("page_id", F.round(quality.extraction_score(*c, F.array().cast("array<string>")), 6).alias("score"))


@query("SELECT doc_id, CASE WHEN first < doc_id THEN 'exact' ELSE 'none' END AS duplicate_type, first AS duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)")
def dedup_exact(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("exact"), F.lit(None).cast("long").alias("signature"))
    out = dedup.cascade(docs, "doc_id", "exact", "signature")
    return out.select(F.col("key").alias("doc_id"), "duplicate_type", F.coalesce("duplicate_of", "key").alias("duplicate_of"))


@query("SELECT v.vec_id, CASE WHEN min(w.vec_id) IS NULL THEN 'none' ELSE 'near_embedding' END AS duplicate_type FROM embeddings v LEFT JOIN embeddings w ON w.vec_id < v.vec_id AND list_cosine_similarity(v.embedding::DOUBLE[], w.embedding::DOUBLE[]) >= 0.95 GROUP BY v.vec_id")
def dedup_vectors(spark, d):
    """The last step of the cascade alone."""
    v = _t(spark, d, "embeddings").select("vec_id", "embedding", F.lit(None).cast("string").alias("exact"), F.lit(None).cast("long").alias("signature"))
    return dedup.cascade(v, "vec_id", "exact", "signature", vector="embedding").select(F.col("key").alias("vec_id"), "duplicate_type")


@query(f"""WITH {_simhash_sql('SELECT text FROM documents')},
b AS (SELECT doc_id, CASE WHEN text = '' THEN '' ELSE {_HASH_SQL} END AS e, n FROM documents LEFT JOIN simhashes USING (text)),
x AS (SELECT e, min(doc_id) AS first FROM b WHERE e IS NOT NULL GROUP BY e), h AS (SELECT n, min(doc_id) AS holder FROM b WHERE n IS NOT NULL GROUP BY n),
l AS (SELECT p.n, min({{'d': bit_count(xor(p.n, q.n))::BIGINT, 'of': q.holder}}) AS near FROM h p JOIN h q ON q.holder < p.holder AND bit_count(xor(p.n, q.n)) <= 3 GROUP BY p.n),
j AS (SELECT doc_id, first, CASE WHEN holder < doc_id THEN {{'d': 0::BIGINT, 'of': holder}} ELSE near END AS near FROM b LEFT JOIN x USING (e) LEFT JOIN h USING (n) LEFT JOIN l USING (n))
SELECT doc_id, CASE WHEN first < doc_id THEN 'exact' WHEN near IS NOT NULL THEN 'near_simhash' ELSE 'none' END AS duplicate_type, (CASE WHEN first < doc_id THEN first ELSE near.of END)::VARCHAR AS duplicate_of, round(CASE WHEN first < doc_id THEN 1.0 WHEN near IS NOT NULL THEN 1 - near.d / 64 ELSE 0.0 END, 6)::DOUBLE AS confidence FROM j""")
def dedup_cascade(spark, d):
    signed = ids.simhashes(spread(_t(spark, d, "documents").select("doc_id", "text")), "text").select("doc_id", ids.content_hash(F.col("text")).alias("exact"), ids.simhash_number(F.col("simhash")).alias("signature"))
    return dedup.cascade(signed, "doc_id", "exact", "signature").withColumnRenamed("key", "doc_id").withColumn("duplicate_of", F.col("duplicate_of").cast("string"))


@query("""WITH RECURSIVE v AS (SELECT DISTINCT ('0x' || simhash)::UBIGINT AS n FROM deduplication_index WHERE simhash IS NOT NULL), e AS (SELECT p.n AS a, q.n AS b FROM v p JOIN v q ON p.n <> q.n AND bit_count(xor(p.n, q.n)) <= 3),
r(a, b) AS (SELECT a, b FROM e UNION SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), s AS (SELECT CASE WHEN a >= 9223372036854775808 THEN (a::HUGEINT - 18446744073709551616)::BIGINT ELSE a::BIGINT END AS node, CASE WHEN b >= 9223372036854775808 THEN (b::HUGEINT - 18446744073709551616)::BIGINT ELSE b::BIGINT END AS other FROM r)
SELECT node, min(other) AS component FROM s GROUP BY node""")
def dedup_components(spark, d):
    """Signatures of the index as components of the 3-bit graph."""
    s = _t(spark, d, "deduplication_index").select(ids.simhash_number(F.col("simhash")).alias("signature"))
    return dedup.components(dedup.hamming_links(s).select("a", "b"))


# --- reports, tallies and plans over several steps ------------------------------------------------------------------

_BY = ("url", "title", "text", "article")


def _duplicate_kinds() -> dict[str, F.Column]:
    """Signatures of the duplicate analysis; what is too short to tell anything has none."""
    title, body, url = (text.strip(F.col(c)) for c in ("title", "text", "source_url"))
    return {
        "url": F.when(url != "", url), "title": F.when(F.length(title) > 10, title), "text": F.when(F.length(body) > 100, F.md5(body)),
        "article": ids.article_signature(F.col("title"), F.col("text"), F.col("source_url")),
    }


_KINDS_SQL = f"""s AS (SELECT id, substring(title, 1, 100) AS title, {_strip('source_url')} AS u, {_strip('title')} AS t, {_strip('text')} AS b FROM news_articles),
k AS (SELECT 'url' AS kind, u AS signature, id, title FROM s WHERE u <> '' UNION ALL SELECT 'title', t, id, title FROM s WHERE length(t) > 10 UNION ALL SELECT 'text', md5(b), id, title FROM s WHERE length(b) > 100
  UNION ALL SELECT 'article', dense_rank() OVER (ORDER BY coalesce(b, ''), coalesce(t, ''), coalesce(u, ''))::VARCHAR, id, title FROM s), g AS (SELECT kind, signature, count(*) AS members, min(id) AS first_member, min((id, title)) AS e FROM k GROUP BY kind, signature HAVING count(*) > 1)"""


@query(f"WITH {_KINDS_SQL} SELECT k.kind, g.members, g.first_member, k.id AS member FROM k JOIN g ON k.kind = g.kind AND k.signature = g.signature")
def agg_duplicate_members(spark, d):
    """Every row of every group of copies, by address, title, text and all three."""
    m = dedup.duplicate_members(_t(spark, d, "news_articles"), _duplicate_kinds(), "id")
    first = m.groupBy("kind", "signature").agg(F.min("member").alias("first_member"))
    return m.join(first, ["kind", "signature"]).select("kind", "members", "first_member", "member")


@query(f"WITH {_KINDS_SQL} SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY members DESC, first_member) AS place, members, first_member FROM g QUALIFY row_number() OVER (PARTITION BY kind, members, first_member ORDER BY signature) >= 1 AND place <= 5")
def agg_duplicate_report(spark, d):
    """The five largest groups of each kind."""
    return dedup.duplicate_report(_t(spark, d, "news_articles"), _duplicate_kinds(), "id", "title").select("kind", "place", "members", "first_member")


@query("WITH c AS (SELECT CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'exact' ELSE 'none' END AS duplicate_type FROM documents), g AS (SELECT duplicate_type, count(*) AS documents FROM c GROUP BY 1) SELECT duplicate_type, documents, round(documents / (SELECT sum(documents) FROM g), 6) AS share, round(1 - (SELECT coalesce(sum(documents), 0) FROM g WHERE duplicate_type = 'none') / (SELECT sum(documents) FROM g), 6) AS duplicate_rate, round((SELECT coalesce(sum(documents), 0) FROM g WHERE duplicate_type = 'none') / (SELECT sum(documents) FROM g), 6) AS unique_rate FROM g")
def agg_duplicate_types(spark, d):
    return dedup.type_rates(dedup_exact(spark, d))


@query(f"SELECT *, round(100.0::DOUBLE * records / sum(records) OVER (PARTITION BY field), 6) AS percent FROM ({SQL['agg_histograms']})")
def agg_percentages(spark, d):
    return stats.with_percentages(agg_histograms(spark, d))


@query("SELECT domain, pages, round(pages / greatest(seconds / 60, 1), 6) AS per_minute, round(pages / greatest(seconds / 86400, 1), 6) AS per_day FROM (SELECT CASE WHEN h = '' THEN 'unknown' ELSE h END AS domain, count(*) AS pages, epoch(max(fetched_at)) - epoch(min(fetched_at)) AS seconds FROM (SELECT *, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS h FROM fetch_results WHERE url IS NOT NULL) GROUP BY 1)")
def agg_rates(spark, d):
    f = _t(spark, d, "fetch_results").where("url IS NOT NULL").groupBy(urls.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("pages"), ((F.max(F.unix_micros(F.col("fetched_at").cast("timestamp"))) - F.min(F.unix_micros(F.col("fetched_at").cast("timestamp")))) / 1e6).alias("seconds"))
    return f.select("domain", "pages", F.round(stats.per_minute(F.col("pages"), F.col("seconds")), 6).alias("per_minute"), F.round(stats.per_day(F.col("pages"), F.col("seconds")), 6).alias("per_day"))


@query("SELECT strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, success, count(*) AS pages, coalesce(sum(content_length), 0)::BIGINT AS bytes FROM fetch_results GROUP BY ALL")
def agg_increments(spark, d):
    """Totals of days, added up from two halves of the fetches as they would come in one after the other."""
    f = _t(spark, d, "fetch_results")
    totals = None
    for late in (False, True):
        half = f.where(F.coalesce(F.col("page_id") % 2 == 1, F.lit(False)) == late)
        new = half.groupBy(F.date_format("fetched_at", "yyyy-MM-dd").alias("day"), "success").agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.col("content_length").cast("long")), F.lit(0)).alias("bytes"))
        totals = stats.increment(totals, new, ["day", "success"])
    return totals


@query("SELECT count(*) FILTER (WHERE is_allowed) AS exported, count(*) FILTER (WHERE NOT is_allowed) AS failed, round(count(*) FILTER (WHERE is_allowed) / greatest(1, count(*) FILTER (WHERE is_allowed IS NOT NULL)), 6) AS success_rate FROM classification_results")
def agg_export_summary(spark, d):
    return _t(spark, d, "classification_results").agg(*stats.export_summary(F.col("is_allowed"), ~F.col("is_allowed")))


@query("WITH m AS (SELECT strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m') AS month, min(success::INT) AS ok, sum(response_time) AS s FROM fetch_results WHERE fetched_at IS NOT NULL GROUP BY 1) SELECT count(*) FILTER (WHERE ok = 1) AS succeeded, count(*) FILTER (WHERE coalesce(ok, 0) = 0) AS failed, round(coalesce(avg(s), 0), 4) AS mean_seconds, round(greatest(0, 69 - count(*)) * coalesce(avg(s), 0), 4) AS eta_seconds FROM m")
def agg_month_tally(spark, d):
    f = _t(spark, d, "fetch_results").where("fetched_at IS NOT NULL").withColumn("month", F.date_format("fetched_at", "yyyy-MM"))
    return stats.tally(f, "month", F.col("success"), F.col("response_time"), 69).withColumns({c: F.round(c, 4) for c in ("mean_seconds", "eta_seconds")})


@query("SELECT CASE WHEN h = '' THEN 'unknown' ELSE h END AS domain, CASE WHEN success THEN 'completed' ELSE 'failed' END AS status, count(*) AS pages FROM (SELECT success, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS h FROM fetch_results WHERE url IS NOT NULL) GROUP BY ALL")
def agg_frontier(spark, d):
    return _t(spark, d, "fetch_results").where("url IS NOT NULL").groupBy(urls.domain(F.col("url")).alias("domain"), F.when(F.col("success"), "completed").otherwise("failed").alias("status")).agg(F.count("*").alias("pages"))


@query("SELECT records, valid, round(valid / records, 6) AS share, valid / records >= 0.9 AS passed FROM (SELECT count(*) AS records, count(*) FILTER (WHERE id <> '' AND source_url <> '' AND title <> '' AND text <> '') AS valid FROM news_articles)")
def filt_gate(spark, d):
    return _t(spark, d, "news_articles").agg(*quality.gate(quality.filled(*(F.col(c) for c in ("id", "source_url", "title", "text")))))


@query("SELECT id, unnest(list_filter([CASE WHEN coalesce(id, '') = '' THEN 'missing_id' END, CASE WHEN coalesce(title, '') = '' THEN 'missing_title' END, CASE WHEN site IS NOT NULL THEN 'banned_site' END, CASE WHEN scraped_at IS NOT NULL THEN 'banned_scraped_at' END], lambda x: x IS NOT NULL)) AS error FROM news_articles")
def filt_fields(spark, d):
    n = _t(spark, d, "news_articles")
    return n.select("id", F.explode(quality.field_errors({c: F.col(c) for c in ("id", "title")}, {c: F.col(c) for c in ("site", "scraped_at")})).alias("error"))


_RATES = (("click", 5.0), ("view", 20.0), ("purchase", 1.0))


@query("WITH r(event_type, rate) AS (VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in _RATES) + ") SELECT e.event_id, coalesce(r.rate, 2.0::DOUBLE) AS rate FROM events e LEFT JOIN r USING (event_type)")
def join_rates(spark, d):
    rates = spark.createDataFrame(list(_RATES), "event_type string, rate double")
    return frontier.with_rate(_t(spark, d, "events").select("event_id", "event_type"), rates, "event_type", "rate", 2.0).select("event_id", "rate")


@query("SELECT batch_no, id FROM incoming_articles i WHERE NOT EXISTS (SELECT 1 FROM export_entries e WHERE e.id = i.id)")
def join_unexported(spark, d):
    """What has not been exported yet."""
    return _t(spark, d, "incoming_articles").select("batch_no", "id").join(_t(spark, d, "export_entries").select("id").distinct(), "id", "left_anti").select("batch_no", "id")


@query("SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) % 7)::INT AS worker FROM events")
def win_round_robin(spark, d):
    return frontier.round_robin(_t(spark, d, "events").select("event_id"), [F.col("event_id")], 7)


@query("WITH e AS (SELECT user_id, event_id, CASE WHEN value < 50 THEN 0 ELSE 1 END AS found FROM events WHERE value IS NOT NULL), t AS (SELECT *, sum(found) OVER (PARTITION BY user_id ORDER BY event_id) AS total, sum(found) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e), r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS k FROM t WHERE found = 0), d AS (SELECT user_id, min(event_id) AS dry FROM r WHERE k = 5 GROUP BY user_id), g AS (SELECT user_id, min(event_id) FILTER (WHERE total >= 20) AS enough, max(event_id) AS last FROM t GROUP BY user_id) SELECT user_id, least(enough, dry, last) AS stop_at, CASE WHEN least(enough, dry, last) = enough THEN 'target' WHEN least(enough, dry, last) = dry THEN 'empty' ELSE 'end' END AS reason FROM g LEFT JOIN d USING (user_id)")
def win_last_page(spark, d):
    e = _t(spark, d, "events").where("value IS NOT NULL").withColumn("found", F.when(F.col("value") < 50, 0).otherwise(1))
    return frontier.last_page(e, "user_id", "event_id", "found", 20, resume=0)


@query("WITH f AS (SELECT source_url, min((id, source_url)) AS first FROM (SELECT id, source_url FROM news_articles UNION ALL SELECT id, source_url FROM incoming_articles) WHERE source_url IS NOT NULL GROUP BY source_url) SELECT source_url, row_number() OVER (ORDER BY first) AS place FROM f")
def set_first_seen(spark, d):
    """Distinct addresses in the order in which they come first."""
    return stats.first_seen(set_union(spark, d), "source_url", [F.col("id"), F.col("source_url")])


@query("SELECT author, 'What is this author interested in?' || chr(10) || string_agg(coalesce(subreddit, '') || ' > ' || replace(body, chr(10), ' <newline> '), chr(10) ORDER BY comment_id) AS prompt FROM (SELECT DISTINCT author, subreddit, body, comment_id FROM reddit_comments WHERE author IS NOT NULL AND body IS NOT NULL) GROUP BY author")
def proj_prompts(spark, d):
    c = _t(spark, d, "reddit_comments").where("body IS NOT NULL").select("author", "subreddit", "body", "comment_id").distinct()
    return threads.prompt(c, "author", "subreddit", "body", ["comment_id"], "What is this author interested in?\n")


@query("SELECT doc_id, json_extract_string(j, '$.topic') AS topic, json_extract_string(j, '$.scores.confidence')::DOUBLE AS confidence FROM (SELECT doc_id, to_json({'topic': topic, 'scores': {'confidence': confidence}}) AS j FROM classification_results)")
def proj_pending(spark, d):
    """Fields of pending documents out of their metadata in JSON."""
    c = _t(spark, d, "classification_results").select("doc_id", F.to_json(F.struct("topic", F.struct("confidence").alias("scores"))).alias("metadata"))
    return corpus.pending(c, "metadata", {"topic": ("$.topic", "string"), "confidence": ("$.scores.confidence", "double")}).drop("metadata")


@query("SELECT comment_id, body FROM reddit_comments")
def proj_nested(spark, d):
    """Comments as listing JSON, rebuilt to nested bodies and replies, and flattened again."""
    c = _t(spark, d, "reddit_comments").select("comment_id", "body")
    listing = F.to_json(F.struct(F.struct(F.array(F.struct(F.lit("t1").alias("kind"), F.struct("body", F.lit("").alias("replies")).alias("data")), F.struct(F.lit("more").alias("kind"), F.struct(F.lit("gone").alias("body"), F.lit("").alias("replies")).alias("data"))).alias("children")).alias("data")))
    return threads.flatten_comments(threads.nested_comments(c.select("comment_id", listing.alias("comments")), "comments"), "comments").select("comment_id", "body")


@query()
def flagship_gates(spark, d):
    """Pages that fall out at each gate of the whole pipeline, and those accepted."""
    gated = corpus.gated(_t(spark, d, "fetch_results"), F.lit(NOW).cast("timestamp"))
    return gated.groupBy(F.coalesce("rejected_at", F.lit("accepted")).alias("gate")).agg(F.count("*").alias("pages"))


@query("SELECT page_id, sum(1)::BIGINT AS links FROM (SELECT DISTINCT page_id, url, unnest(regexp_extract_all(content, '<a\\s[^>]*href=\"(https?://[^\"/]+/[^\"]*-[0-9]+|/[^\"]*-[0-9]+)\"', 1)) AS link FROM fetch_results WHERE success) GROUP BY page_id")
def scan_article_links(spark, d):
    """Addresses of articles on each page: absolute, by the rule of article addresses, each once."""
    f = _t(spark, d, "fetch_results").where("success").select("page_id", "url", "content").distinct()
    return urls.article_links(f, "content", "url", lambda u: u.rlike("-[0-9]+$"), ["page_id"]).groupBy("page_id").agg(F.count("*").alias("links"))


_NEWS_SQL = lambda c: f"coalesce({_rep(_squeeze(c), ('[' + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0b-' + chr(92) + 'x1f]', ''))}, '')"
_FLAGSHIP_SQL = f"""WITH f AS (SELECT id, source_url, {_NEWS_SQL('title')} AS title, {_NEWS_SQL('text')} AS text FROM news_articles WHERE coalesce(source_url, '') <> ''), g AS (SELECT * FROM f WHERE {_STATUS_SQL} = 'clean')
SELECT substring(sha256(source_url || '#' || substring(sha256(text), 1, 16)), 1, 16) AS document_id, title, text, CASE WHEN host = '' THEN 'unknown' ELSE host END AS site FROM (SELECT *, regexp_replace(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS host FROM g QUALIFY row_number() OVER (PARTITION BY {_HASH_SQL} ORDER BY id, source_url, title, text) = 1)"""


# --- sources and sinks, there and back ------------------------------------------------------------------------------


@query("SELECT doc_id, text, lang FROM documents")
def sink_lines(spark, d):
    path = fresh_folder(spark, "lines")
    sinks.write_lines(_t(spark, d, "documents").select("doc_id", "text", "lang"), path)
    return jsonl.read_lines(spark, path, StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())]))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM documents")
def sink_numbered(spark, d):
    """Lines written in order and read again: their files and numbers give the order back."""
    path = fresh_folder(spark, "numbered")
    sinks.write_lines(_t(spark, d, "documents").select("doc_id").repartitionByRange("doc_id").sortWithinPartitions("doc_id"), path)
    lines = jsonl.read_lines(spark, path, StructType([StructField("doc_id", LongType())]), numbered=True)
    return stats.numbered(lines, [F.col("file"), F.col("line_number")]).select("doc_id", F.col("number").alias("place"))


@query("SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS shard, 1 AS n FROM documents".replace("SELECT", "SELECT shard::BIGINT AS shard, sum(n)::BIGINT AS entries FROM (SELECT", 1) + ") GROUP BY shard")
def sink_shards(spark, d):
    path = fresh_folder(spark, "shards")
    sinks.write_shards(_t(spark, d, "documents").select("doc_id", "text"), path, [F.col("doc_id")], 1000)
    return sinks.manifest(spark, path).groupBy("shard").agg(F.sum("entries").alias("entries"))


@query("SELECT doc_id, lang, title FROM documents")
def sink_csv(spark, d):
    path = fresh_folder(spark, "csv")
    sinks.write_csv(_t(spark, d, "documents").select("doc_id", "lang", "title"), path)
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("doc_id bigint, lang string, title string").csv(path)


@query("SELECT doc_id, title, substring(text, 1, 269) AS description FROM documents")
def scan_posts(spark, d):
    """Documents wrapped as listings of posts, and read again."""
    post = F.struct(F.lit("t3").alias("kind"), F.struct("title", F.col("text").alias("selftext"), F.col("doc_id").cast("string").alias("permalink")).alias("data"))
    j = F.to_json(F.struct(F.struct(F.array(post).alias("children"), F.lit(None).cast("string").alias("after")).alias("data")))
    return jsonl.listing_posts(_t(spark, d, "documents").select(j.alias("j")), "j").select(F.col("permalink").cast("long").alias("doc_id"), "title", "description")


@query("SELECT comment_id, 'comment' AS type, body, subreddit FROM reddit_comments")
def scan_activity(spark, d):
    item = F.struct(F.lit("t1").alias("kind"), F.struct("body", "subreddit", F.col("comment_id").alias("permalink")).alias("data"))
    other = F.struct(F.lit("t9").alias("kind"), F.struct(F.lit("x").alias("body"), F.lit("x").alias("subreddit"), F.lit("x").alias("permalink")).alias("data"))
    j = F.to_json(F.struct(F.struct(F.array(item, other).alias("children")).alias("data")))
    return jsonl.user_activity(_t(spark, d, "reddit_comments").select(j.alias("j")), "j").select(F.col("url").alias("comment_id"), "type", "body", "subreddit")


@query("SELECT doc_id, title, text AS body FROM documents WHERE title IS NOT NULL")
def scan_details(spark, d):
    post = F.struct(F.struct(F.array(F.struct(F.lit("t3").alias("kind"), F.struct("title", F.col("text").alias("selftext")).alias("data"))).alias("children")).alias("data"))
    docs = _t(spark, d, "documents").where("title IS NOT NULL").select("doc_id", F.to_json(F.array(post)).alias("j"))
    return jsonl.post_details(docs, "j").select("doc_id", "title", "body")


def _echo(url: str) -> tuple[int, dict, str]:
    """A transport without a network: even addresses answer with themselves, the others are missing."""
    return (200, {"Content-Type": "text/html"}, url) if len(url) % 2 == 0 else (404, {}, "")


@query("SELECT DISTINCT source_url AS url, length(source_url) % 2 = 0 AS success, CASE WHEN length(source_url) % 2 = 0 THEN 200 ELSE 404 END::INT AS status_code, CASE WHEN length(source_url) % 2 = 0 THEN source_url END AS content FROM incoming_articles WHERE source_url IS NOT NULL")
def scan_fetched(spark, d):
    return pages.fetch(_t(spark, d, "incoming_articles").select(F.col("source_url").alias("url")), _echo, workers=8).select("url", "success", "status_code", "content")


@query("SELECT DISTINCT url, NOT starts_with(coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$', 1), ''), '/'), '/read') AS permitted FROM fetch_results WHERE url IS NOT NULL")
def filt_permitted(spark, d):
    """Addresses under the rules of their domains' robots files, which are made here: all forbid one section."""
    f = _t(spark, d, "fetch_results").where("url IS NOT NULL").select("url").distinct()
    rules = f.select(urls.domain(F.col("url")).alias("domain"), F.lit(NOW).alias("fetched_at"), F.lit("User-agent: *\nDisallow: /read\nAllow: /").alias("content")).distinct()
    return pages.permitted(f, pages.robots_table(rules), F.lit(NOW).cast("timestamp")).select("url", "permitted")


@query("SELECT DISTINCT id FROM incoming_articles WHERE id NOT IN (SELECT id FROM news_articles WHERE id IS NOT NULL)")
def join_missing(spark, d):
    return books.missing(_t(spark, d, "incoming_articles").select("id"), _t(spark, d, "news_articles").select("id"), "id")


@query("SELECT d.doc_id, d.title, b.task FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id")
def join_metadata(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("stem"), "title")
    return books.with_metadata(docs, _t(spark, d, "benchmark").select(F.col("item_id").alias("stem"), "task")).select(F.col("stem").alias("doc_id"), "title", "task")


@query(f"SELECT page_id FROM fetch_results WHERE NOT success AND fetched_at + INTERVAL 1 HOUR <= TIMESTAMPTZ '{NOW}+00'")
def filt_eligible(spark, d):
    f = _t(spark, d, "fetch_results").withColumn("status", F.when(F.col("success"), "completed").otherwise("pending"))
    return f.where(frontier.eligible(F.col("status"), F.col("fetched_at") + F.expr("INTERVAL 1 HOUR"), F.lit(NOW).cast("timestamp"))).where("NOT success").select("page_id")


@query("SELECT page_id, (page_id % 3 + 1)::INT AS attempts, CASE WHEN page_id % 3 + 1 >= 3 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN page_id % 3 + 1 < 3 THEN (epoch_us(fetched_at) + 3600000000)::VARCHAR END AS next_attempt FROM fetch_results WHERE NOT success")
def win_retries(spark, d):
    f = _t(spark, d, "fetch_results").where("NOT success").select("page_id", (F.col("page_id") % 3).cast("int").alias("attempts"), "fetched_at")
    return frontier.after_failure(f, "attempts", "fetched_at").select("page_id", "attempts", "status", F.unix_micros("next_attempt").cast("string").alias("next_attempt"))


def _record_sql(version: int) -> str:
    one = (lambda c: f"coalesce({_squeeze(_rep(c, (text.USER_V1, ''), (text.URL_HTTP, ''), (text.URL_WWW, ''), (text.MAIL_V1, ''), (text.PHONE_V1, ''), (text.ODD_V1, ' ')))}, '')") if version == 1 else (lambda c: f"coalesce({_V2_SQL.replace('body', c)}, '')")
    url = "CASE WHEN coalesce(thread_url, '') = '' THEN '' WHEN thread_url LIKE 'http%' THEN thread_url" + (" WHEN thread_url LIKE '/%' THEN 'https://threads.example' || thread_url ELSE 'https://threads.example/' || thread_url END" if version == 2 else " ELSE 'https://threads.example' || thread_url END")
    group = "coalesce(nullif(regexp_extract(url, '/r/([^/]+)/', 1), ''), 'Cooking')" if version == 2 else "coalesce(CASE WHEN starts_with(thread_url, '/r/') THEN string_split(thread_url, '/')[3] END, CASE WHEN contains(thread_url, '.com/r/') OR contains(thread_url, '.example/r/') THEN nullif(regexp_extract(thread_url, '/r/([^/]+)/', 1), '') END, 'Cooking')"
    return f"WITH c AS (SELECT comment_id, thread_url, {url} AS url, {one('thread_title')} AS thread_title, {one('body')} AS thread_body FROM reddit_comments) SELECT comment_id, CASE WHEN regexp_matches(thread_title || ' ' || thread_body, '[A-Za-z]') THEN 'en' ELSE 'und' END AS language, url AS source_url, thread_title, thread_body, {group} AS subreddit FROM c"


def _records(spark: SparkSession, d: str, version: int) -> DataFrame:
    """Comments as records of threads without replies."""
    c = _t(spark, d, "reddit_comments")
    make = threads.records_v1 if version == 1 else threads.records_v2
    out = make(c, F.col("thread_title"), F.col("thread_url"), F.col("body"), F.lit(""), "https://threads.example", ("comment_id",))
    return out.select("comment_id", "language", "source_url", "thread_title", "thread_body", "subreddit")


@query(_record_sql(1))
def proj_records_v1(spark, d):
    return _records(spark, d, 1)


@query(_record_sql(2))
def proj_records_v2(spark, d):
    return _records(spark, d, 2)


# --- streams -------------------------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, d: str, name: str, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a plan over a table read as a stream has given, after a run over all there is; windows that are not yet complete are not in it."""
    path = f"{d}/{name}.parquet"
    out = fresh_folder(spark, f"stream-{name}")
    rows = streams.read_files(spark, path, spark.read.parquet(path).schema, "parquet")
    stream = plan(rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows)
    stream = stream.select(*(F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in stream.schema.fields))
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


_REACHED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(f"SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, rows FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS rows FROM events GROUP BY ALL) WHERE window_start + INTERVAL 1 HOUR <= {_REACHED}")
def stream_hours(spark, d):
    return _streamed(spark, d, "events", lambda s: streams.counts(s, "event_type", "ts"))


@query(f"WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS rows FROM s GROUP BY user_id, n HAVING max(ts) + INTERVAL 30 MINUTE <= {_REACHED}")
def stream_sessions(spark, d):
    return _streamed(spark, d, "events", lambda s: streams.sessions(s, "user_id", "ts"))


@query("SELECT event_type, count(*) AS users FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY event_type")
def stream_first_seen(spark, d):
    """First events of each user and type, as state would keep them."""
    seen = _streamed(spark, d, "events", lambda s: streams.first_seen(s.withColumn("pair", F.concat_ws(" ", "event_type", "user_id")), "pair", "ts", "3650 days").select("event_type", "user_id"))
    return seen.groupBy("event_type").agg(F.count("*").alias("users"))


@query()
def stream_limited(spark, d):
    """Events within five a minute of each user."""
    return _streamed(spark, d, "events", lambda s: streams.limited(s, "user_id", "ts", 5)).groupBy("user_id", "allowed").agg(F.count("*").alias("events"))


@query(f"WITH f AS (SELECT {_NEWS_SQL('title')} AS title, {_NEWS_SQL('text')} AS text FROM news_articles) SELECT DISTINCT CASE WHEN text = '' THEN '' ELSE {_HASH_SQL} END AS content_hash FROM f WHERE {_STATUS_SQL} = 'clean'")
def stream_accepted(spark, d):
    """Contents of clean articles, accepted batch by batch, each once."""
    out, path = fresh_folder(spark, "accepted"), f"{d}/news_articles.parquet"
    stream = streams.clean_articles(streams.read_files(spark, path, spark.read.parquet(path).schema, "parquet"))
    streams.accept(stream, f"{out}/history", f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("content_hash string").parquet(f"{out}/rows").select("content_hash")


@query(_FLAGSHIP_SQL)
def flagship_corpus(spark, d):
    return flagship(spark, d)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """News articles cleaned, gated and rid of copies, with their ids."""
    return corpus.news_corpus(spread(_t(spark, d, "news_articles").select("id", "title", "text", "source_url")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
