"""Command line: python -m lontar COMMAND --in TABLE --out FOLDER."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMANDS = {
    "crawl": "fetch the addresses of --in (a column url, or a list of domains) by --transport module:function", "clean": "clean texts", "classify": "topics of texts", "corpus": "news corpus", "extract": "contents of pages",
    "export": "sharded JSON lines and their manifest", "all": "pages through every gate, exported", "status": "counts of an exported or stated folder", "stats": "histograms", "duplicates": "groups of copies",
    "report": "duplicate report", "validate": "what entries lack", "cleanup": "drop keys older than --days", "query": "a query by --name",
}
#: Settings of a bulk run: no limit on articles, no waiting, validation always.
BULK = {"limit": None, "delay": 0.0, "validate": True}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lontar", epilog="; ".join(f"{k}: {v}" for k, v in COMMANDS.items()))
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--in", dest="source", required=True, help="folder of the tables, or a table for single-table commands")
    p.add_argument("--out", help="folder of the result; shown if left out")
    p.add_argument("--text", default="text")
    p.add_argument("--title", default="title")
    p.add_argument("--url", default="source_url")
    p.add_argument("--key", default="id")
    p.add_argument("--at", default="created_at")
    p.add_argument("--days", type=int, default=30)
    p.add_argument("--limit", type=int, help="rows at most")
    p.add_argument("--bulk", action="store_true", help="no limit and no waiting between fetches, entries are validated")
    p.add_argument("--delay", type=float, default=1.0)
    p.add_argument("--transport", help="module:function, url -> (status, headers, body)")
    p.add_argument("--config", help="options, JSON or YAML")
    p.add_argument("--name", help="query to run")
    p.add_argument("--format", default="json", choices=("json", "parquet", "csv"))
    o = p.parse_args(args)
    if o.bulk:
        o.limit, o.delay = BULK["limit"], BULK["delay"]
    from lontar.functions import ids
    from lontar.operators import classify, dedup, html, quality, stats
    from lontar.plans import corpus
    from lontar.sources import config, pages, sinks

    options = config.load(o.config)
    spark = SparkSession.builder.appName(f"lontar {o.command}").getOrCreate()
    if o.command in ("query", "status", "cleanup"):
        df = None
    elif o.command == "crawl" and o.source.endswith(".txt"):
        df = pages.domains(spark, o.source).select(F.concat(F.lit("https://"), "domain").alias("url"))
    else:
        df = spark.read.json(o.source) if o.source.endswith((".json", ".jsonl")) else spark.read.parquet(o.source)
    if df is not None and o.limit is not None:
        df = df.limit(o.limit)
    out: DataFrame | None = None
    if o.command == "crawl":
        if not o.transport:
            p.error("crawl needs --transport module:function")
        module, _, function = o.transport.partition(":")
        out = pages.fetch(df, getattr(importlib.import_module(module), function), config.get(options, "crawler.concurrency", 64), config.get(options, "crawler.max_retries", 3), o.delay)
    elif o.command == "clean":
        out = corpus.cleaned(df, o.text)
    elif o.command == "classify":
        out = classify.validated(classify.classify(df, o.title, o.text), o.title, o.text)
    elif o.command == "corpus":
        out = corpus.news_corpus(df)
    elif o.command == "extract":
        out = html.extract(df, "content", html.METHODS)
    elif o.command == "export":
        return _export(spark, df, o, config.get(options, "export.shard_size", 10_000))
    elif o.command == "all":
        gated = corpus.gated(df, F.current_timestamp(), config.get(options, "content.min_length", 200))
        entries = corpus.export_entries(gated.where("rejected_at IS NULL"), "web", config.get(options, "export.delivery_version", "v1"))
        if not o.out:
            gated.groupBy(F.coalesce("rejected_at", F.lit("accepted")).alias("gate")).count().show()
            return 0
        done = _export(spark, entries, o, config.get(options, "export.shard_size", 10_000))
        gated.groupBy(F.coalesce("rejected_at", F.lit("accepted")).alias("gate")).agg(F.count("*").alias("pages")).write.mode("overwrite").json(f"{o.out}/gates")
        return done
    elif o.command == "status":
        manifest = sinks.manifest(spark, f"{o.source.rstrip('/')}/shards")
        manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).show()
        return 0
    elif o.command == "cleanup":
        from lontar.streaming.corpus import forget

        print(f"{forget(spark, o.source, o.at, o.days)} rows kept")
        return 0
    elif o.command == "stats":
        out = stats.with_percentages(stats.histograms(df, [c for c in ("clean_status", "language", "category") if c in df.columns], o.text, o.title))
    elif o.command == "duplicates":
        out = dedup.duplicate_groups(df, ids.content_hash(F.col(o.text)), o.key)
    elif o.command == "report":
        kinds = {"url": F.nullif(F.trim(o.url), F.lit("")), "title": F.when(F.length(o.title) > 10, F.col(o.title)), "text": F.when(F.length(o.text) > 100, F.md5(o.text))}
        summary = stats.duplicate_summary(dedup.duplicate_groups(df, kinds["text"], o.key), df.agg(F.count("*").alias("records")))
        groups = dedup.duplicate_report(df, kinds, o.key, o.title)
        if o.out:
            sinks.write_report(summary, groups, o.out)
            return 0
        summary.show()
        out = groups
    elif o.command == "validate":
        out = df.select(o.key, F.explode(quality.entry_errors({o.key: F.col(o.key), "text": F.col(o.text)})).alias("error"))
    else:
        from lontar import queries

        out = queries.queries()[o.name](spark, o.source)
    if o.out:
        out.write.mode("overwrite").format(o.format).save(o.out)
    else:
        out.show(20, truncate=80)
    return 0


def _export(spark: SparkSession, entries: DataFrame, o: argparse.Namespace, size: int) -> int:
    from lontar.operators import quality
    from lontar.sources import sinks

    if not o.out:
        raise SystemExit("export needs --out")
    key = o.key if o.key in entries.columns else entries.columns[0]
    if o.bulk and BULK["validate"]:
        found = entries.agg(*quality.gate(quality.filled(F.col(key).cast("string"), F.col(o.text)))).first()
        if not found["passed"]:
            raise SystemExit(f"only {found['share']:.1%} of the entries are valid")
    sinks.write_shards(entries, f"{o.out}/shards", [F.col(key)], size)
    sinks.manifest(spark, f"{o.out}/shards").write.mode("overwrite").json(f"{o.out}/manifest")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
