"""Connectors, options, streams and the command line."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from lontar.sources import books, config, pages
from lontar.streaming import corpus


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"export": {"shard_size": 5}, "own": 1}))
    tree = config.load(str(tmp_path / "c.json"), {"LONTAR_HAMMING": "2", "LONTAR_REMOVE_EMOJI": "False", "LONTAR_SIMILARITY": "0.9", "LONTAR_OUT_DIR": "x y"})
    assert config.get(tree, "export.shard_size") == 5 and config.get(tree, "deduplication.hamming_distance") == 2 and config.get(tree, "content.remove_emojis") is False
    assert config.get(tree, "deduplication.similarity") == 0.9 and config.get(tree, "export.out_dir") == "x y" and config.get(tree, "own") == 1 and config.get(tree, "a.b", 7) == 7


def test_fetch_one():
    waits, calls = [], []

    def flaky(url):
        calls.append(url)
        return (429, {"Retry-After": "7"}, "") if len(calls) == 1 else (503, {}, "") if len(calls) == 2 else (200, {"Content-Type": "text/html"}, "<p>")

    assert pages.fetch_one(flaky, "u", sleep=waits.append, jitter=lambda: 0.5)["success"] and waits == [7.0, 2.5]
    gone = pages.fetch_one(lambda u: (404, {}, ""), "u", sleep=waits.append)
    assert not gone["success"] and gone["status_code"] == 404 and len(waits) == 2
    assert "content type" in pages.fetch_one(lambda u: (200, {"Content-Type": "image/png"}, ""), "u")["error"]

    def broken(u):
        raise OSError("down")

    assert "down" in pages.fetch_one(broken, "u", retries=1, sleep=waits.append)["error"]


def test_fetch(spark):
    df = spark.createDataFrame([("http://a/1",), ("http://a/2",), ("http://a/1",), (None,)], "url string")
    out = pages.fetch(df, lambda u: (200, {"Content-Type": "text/html"}, f"<p>{u}") if u.endswith("1") else (404, {}, ""), 2, 0).collect()
    assert {(r["url"], r["success"], r["content_length"]) for r in out} == {("http://a/1", True, 13), ("http://a/2", False, None)}
    rules = spark.createDataFrame([("/a/b", ["/a"], ["/a/b"]), ("/a/c", ["/a"], ["/a/b"]), ("/x", [""], [])], "p string, d array<string>, a array<string>")
    assert [r[0] for r in rules.select(pages.allowed(F.col("p"), F.col("d"), F.col("a"))).collect()] == [True, False, True]
    assert [r["url"] for r in pages.page_plan(spark, "http://x/?p={page}", 3, 5).orderBy("page").collect()] == ["http://x/?p=3", "http://x/?p=4", "http://x/?p=5"]


def test_books(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p><w:r><w:t>Two </w:t></w:r><w:r><w:t>three</w:t></w:r></w:p></w:body></w:document>')
    (tmp_path / "good.docx").write_bytes(z.getvalue())
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    found = books.read_docx(spark, str(tmp_path))
    assert {(r["stem"], r["text"]) for r in found.collect()} == {("good", "One\nTwo three"), ("bad", None)}
    meta = spark.createDataFrame([("good", "T"), ("good", "T")], "stem string, title string")
    assert {(r["stem"], r["title"]) for r in books.with_metadata(found, meta).collect()} == {("good", "T"), ("bad", None)}
    ids = spark.createDataFrame([('<a href="/ebooks/12">x</a><a href="/ebooks/12">y</a><a href="/ebooks/7">',)], "h string").select(books.book_ids(F.col("h"))).first()[0]
    assert ids == ["12", "12", "7"]


ARTICLE = "id string, title string, text string, source_url string, ts timestamp"


def _article(k, t, at):
    return json.dumps({"id": f"a{k}", "title": f"A title of article {t}", "text": f"Text {t} " * 30, "source_url": f"https://www.site.x/{k}", "ts": at})


def test_streams(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(ARTICLE)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text("\n".join([_article(1, "x", "2024-01-01T00:00:00"), _article(2, "y", "2024-01-01T00:10:00"), _article(3, "x", "2024-01-01T02:00:00"), json.dumps({"id": "s", "title": "short", "text": "t"})]))
    stream = lambda: corpus.clean_articles(corpus.read_files(spark, str(tmp_path / "in"), schema, files=1))
    args = (str(tmp_path / "history"), str(tmp_path / "out"), str(tmp_path / "check"))
    corpus.accept(stream(), *args).awaitTermination()
    assert {r["id"] for r in spark.read.parquet(args[1]).collect()} in ({"a1", "a2"}, {"a3", "a2"})
    (tmp_path / "in/2.json").write_text("\n".join([_article(4, "x", "2024-01-02T00:00:00"), _article(5, "z", "2024-01-02T00:00:00")]))
    corpus.accept(stream(), *args).awaitTermination()
    assert spark.read.parquet(args[1]).where("id IN ('a4', 'a5')").count() == 1 and spark.read.parquet(args[0]).count() == 3
    corpus.to_table(corpus.counts(stream(), "site", "ts"), "hours", str(tmp_path / "c1"), "complete").awaitTermination()
    assert sorted(r["rows"] for r in spark.table("hours").collect()) == [1, 2, 2]
    corpus.to_table(corpus.first_seen(stream(), "content_hash", "ts"), "firsts", str(tmp_path / "c2")).awaitTermination()
    assert spark.table("firsts").count() == 3
    corpus.to_table(corpus.sessions(stream(), "site", "ts"), "sessions", str(tmp_path / "c3"), "complete").awaitTermination()
    assert spark.table("sessions").count() == 3


def test_limited(spark, tmp_path):
    rows = [(1, f"2024-01-01 00:00:{s:02d}") for s in (0, 10, 20, 30)] + [(1, "2024-01-01 00:01:05"), (2, "2024-01-01 00:00:00")]
    spark.createDataFrame(rows, "k long, s string").select("k", F.col("s").cast("timestamp").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("k long, ts timestamp").parquet(str(tmp_path / "e"))
    corpus.to_table(corpus.limited(stream, "k", "ts", 2), "limits", str(tmp_path / "c")).awaitTermination()
    out = [r["allowed"] for r in spark.table("limits").where("k = 1").orderBy("ts").collect()]
    assert out == [True, True, False, False, True] and spark.table("limits").where("k = 2 AND allowed").count() == 1


def test_command_line(spark, tmp_path, sf_dir):
    from lontar.__main__ import main

    assert main(["stats", "--in", f"{sf_dir}/news_articles.parquet", "--out", str(tmp_path / "s")]) == 0
    assert spark.read.json(str(tmp_path / "s")).count() > 3
    assert main(["query", "--in", sf_dir, "--name", "agg_acceptance"]) == 0
