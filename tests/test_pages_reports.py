"""News pages, extraction methods, reports, state, robots rules, paging and the command line."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lontar.operators import dedup, frontier, html, news, stats, threads
from lontar.operators.html import tree
from lontar.operators.selectors import first, select
from lontar.plans import corpus
from lontar.sources import books, jsonl, pages, sinks

PAGE = """<html><head><title>Growing beans on a balcony | Garden</title><meta name="keywords" content="beans, balcony"><meta name="description" content="How to grow beans in pots on a small balcony, from seed to harvest."></head>
<body><nav><a href="/">Home</a><a href="/x">More</a></nav><article><h1 class="detail__title">Growing beans on a balcony</h1><span class="byline">By Rosa</span><time datetime="2024-05-01">1 May</time>
<div class="detail__body"><p>Beans grow well in deep pots, as long as they get water every day and some shade at noon. Pick a sunny corner, and keep the soil moist.</p>
<p>After three weeks the first shoots climb up the strings. Then it is time for some compost, and for patience, which beans reward. Harvest them young.</p><div class="ad-box">Buy pots</div><script>x()</script></div>
<img src="/i/bean.jpg"><img data-src="https://c.test/b.jpg"></article><footer>Imprint</footer></body></html>"""
LIST = """<ul class="list"><li class="item"><h3><a href="/read/a-1">Rain in the north</a></h3></li><li class="item"><h3><a href="https://n.test/read/b-2">Bread is cheap</a></h3></li>
<li class="item"><h3><a href="/read/a-1">Rain in the north, again</a></h3></li><li class="item"><h3>No link</h3></li></ul>"""


@pytest.mark.parametrize(
    ("selector", "n"),
    [("p", 2), ("article p", 2), ("div.detail__body p", 2), ('h1[class*="title"]', 1), ("nav a", 2), (".byline", 1), ('[class^="detail"]', 2), ("article nav", 0), ("body article time[datetime]", 1), ('meta[name="keywords"]', 1), ("#none", 0), ("*.byline", 1)],
)
def test_selectors(selector, n):
    assert len(list(select(tree(PAGE), selector))) == n


def test_selector_that_is_not_understood():
    with pytest.raises(ValueError, match="not understood"):
        list(select(tree(PAGE), "p:first-child"))
    assert first(tree(PAGE), ".nowhere", "h1").text() == "Growing beans on a balcony"


def test_article_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>no selector fits</p>")], "id int, html string")
    out = {r["id"]: (r["title"], r["text"]) for r in news.articles(df, "html").collect()}
    assert out[1][0] == "Growing beans on a balcony" and out[1][1].startswith("Beans grow") and "Buy pots" not in out[1][1] and "x()" not in out[1][1]
    assert out[2] == out[3] == out[4] == ("", "")
    by_site = {r["id"]: r["text"] for r in news.articles(df, "html", news.Site(bodies=(".nothing",))).collect()}
    assert "Beans grow" in by_site[1] and by_site[4] == ""


def test_list_pages(spark):
    df = spark.createDataFrame([("https://n.test/p/1", LIST), ("https://n.test/p/2", LIST), ("https://n.test/p/3", None)], "url string, html string")
    site = news.Site(items=(".missing", "li.item"))
    out = [tuple(r) for r in news.list_pages(df, "html", "url", site).orderBy("page", "place").collect()]
    assert out == [("https://n.test/read/a-1", "Rain in the north", "https://n.test/p/1", 0), ("https://n.test/read/b-2", "Bread is cheap", "https://n.test/p/1", 1)]
    known = spark.createDataFrame([("https://n.test/read/a-1",), (None,)], "source_url string")
    assert [r["source_url"] for r in news.list_pages(df, "html", "url", site, known, 5).collect()] == ["https://n.test/read/b-2"]
    assert news.list_pages(df, "html", "url", site, most=1).count() == 1


@pytest.mark.parametrize("name", list(html.METHODS))
def test_methods(name):
    r = html.METHODS[name](PAGE)
    assert "Beans grow well" in r["content"] and "Harvest them young" in r["content"] and "Imprint" not in r["content"]
    assert not html.METHODS[name]("<p>short</p>") or name == "custom"


def test_best_of_all_methods(spark):
    df = spark.createDataFrame([(1, "https://g.test/a/b", PAGE), (2, "https://g.test/a/c", None), (1, "https://g.test/a/b", PAGE)], "page_id int, url string, content string")
    rows = html.extract(df, "content", html.METHODS).orderBy("page_id").collect()
    assert len(rows) == 3 and rows[0] == rows[1] and rows[2]["extraction_method"] == "failed" and rows[2]["quality_score"] == 0
    r = rows[0]
    assert r["extraction_method"] in html.METHODS and r["quality_score"] > 0
    one = html.extract(df, "content").where("page_id = 1").first()
    assert one["author"] == "By Rosa" and one["publish_date"] == "2024-05-01" and one["description"].startswith("How to grow") and one["keywords"] == ["balcony", "beans"]
    assert one["images"] == ["https://c.test/b.jpg", "https://g.test/i/bean.jpg"]
    short = PAGE.replace("How to grow beans in pots on a small balcony, from seed to harvest.", "Beans.")
    assert html.extract(spark.createDataFrame([(1, short)], "page_id int, content string"), "content").first()["description"] is None


def test_numbered_lines(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"k": 1}\nbroken\n\n{"k": 4}\n')
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"k": k}) + "\n" for k in range(1, 3001)))
    from pyspark.sql.types import LongType, StructField, StructType

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        out = [(r["file"].rsplit("/", 1)[1], r["line_number"], r["k"]) for r in jsonl.read_folder(spark, str(tmp_path), StructType([StructField("k", LongType())])).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert out == [("a.jsonl", k, k) for k in range(1, 3001)] + [("b.jsonl", 1, 1), ("b.jsonl", 4, 4)]


def test_arrays(spark, tmp_path):
    from pyspark.sql.types import LongType, StructField, StructType

    kind = StructType([StructField("k", LongType())])
    (tmp_path / "good.json").write_text(' [\n{"k": 1}, {"k": 2}]')
    (tmp_path / "bad.json").write_text('{"k": 1}')
    assert jsonl.read_array(spark, str(tmp_path / "good.json"), kind).count() == 2
    with pytest.raises(ValueError, match="no JSON array"):
        jsonl.read_array(spark, str(tmp_path / "bad.json"), kind)
    rows = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "x").alias("n"))
    for pretty in (False, True):
        path = tmp_path / f"out-{pretty}"
        sinks.write_array(rows, str(path), [F.col("k")], pretty)
        whole = json.loads("".join(f.read_text() for f in sorted(path.glob("part-*"))))
        assert [x["k"] for x in whole] == list(range(100)) and whole[1]["n"] is None
    sinks.write_array(rows.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(f.read_text() for f in (tmp_path / "none").glob("part-*"))) == []


def test_state_names_and_report(spark, tmp_path):
    state = sinks.State(spark, str(tmp_path / "state"))
    assert state.get("page", 7) == 7
    state.put(page=3, cycle=1)
    state.put(page=4)
    assert (state.get("page"), state.get("cycle"), state.get("none")) == (4, 1, None)
    assert sinks.run_name("news", "2024-03-05T06:07:08") == "news_20240305_060708"
    df = spark.createDataFrame([("a", "t" * 150, "x"), ("b", "t" * 150, "x"), ("c", "u", None)], "id string, title string, text string")
    groups = dedup.duplicate_report(df, {"title": F.col("title"), "text": F.col("text")}, "id", "title")
    summary = stats.duplicate_summary(dedup.duplicate_groups(df, F.col("text"), "id"), df.agg(F.count("*").alias("records")))
    sinks.write_report(summary, groups, str(tmp_path / "report"))
    report = json.loads("".join(f.read_text() for f in (tmp_path / "report").glob("part-*")))
    assert report["largest"][0]["first_member"] == "a" and len(report["largest"][0]["title"]) == 100 and report["records"] == 3 and len(report["largest"]) == 2


def test_robots(spark):
    text = "User-agent: other\nDisallow: /\n\nUser-agent: *\nUser-agent: x\nDisallow: /private # no\nAllow: /private/open\nCrawl-delay: 2\nDisallow:"
    assert pages.robots_rules(text) == (["/private"], ["/private/open"], 2.0)
    assert pages.robots_rules(text, "Other/1.0")[0] == ["/"] and pages.robots_rules(None) == ([], [], None)
    files = spark.createDataFrame([("a.test", "2024-01-02 00:00:00", text), ("a.test", "2024-01-01 00:00:00", "User-agent: *\nDisallow: /"), ("b.test", "2024-01-02 00:00:00", None)], "domain string, fetched_at string, content string")
    urls = spark.createDataFrame([("https://a.test/private/x",), ("https://www.a.test/private/open/y",), ("https://a.test",), ("https://b.test/q",), ("https://c.test/q",), (None,)], "url string")
    out = {r["url"]: (r["permitted"], r["stale"]) for r in pages.permitted(urls, pages.robots_table(files), F.lit("2024-01-02 12:00:00").cast("timestamp")).collect()}
    assert out["https://a.test/private/x"] == (False, False) and out["https://www.a.test/private/open/y"] == (True, False) and out["https://a.test"] == (True, False) and out["https://b.test/q"] == (True, False) and out["https://c.test/q"] == (True, True)


def test_paging(spark, tmp_path):
    listings = {None: {"after": "p2", "children": [1, 2]}, "p2": {"after": "p3", "children": [3]}, "p3": {"after": None, "children": [4]}}
    read = lambda after: json.dumps({"data": listings[after]})
    assert len(list(jsonl.paged(read))) == 3 and len(list(jsonl.paged(read, 2))) == 1 and list(jsonl.paged(lambda _: "no json")) == []
    df = spark.createDataFrame([(read("p2"),), (read("p3"),)], "j string")
    assert [r["after"] for r in jsonl.cursor(df, "j").collect()] == ["p3", None]
    shown = {1: '<a href="/ebooks/5">', 26: '<a href="/ebooks/6">', 51: "<p>none"}
    assert [n for n, _ in books.pages(shown.get)] == [1, 26]
    ids = spark.createDataFrame([("5",), ("6",), ("6",), (None,)], "book_id string")
    assert books.download(ids, lambda i: None if i == "6" else f"text {i}", str(tmp_path / "books")).count() == 1
    assert {r["text"] for r in books.download(ids, lambda i: f"new {i}", str(tmp_path / "books")).collect()} == {"text 5", "new 6"}


def test_post_details(spark):
    post = [{"data": {"children": [{"kind": "t3", "data": {"title": "T", "selftext": "B"}}]}}, {"data": {"children": [{"kind": "t1", "data": {"body": "one", "replies": {"data": {"children": [{"kind": "t1", "data": {"body": "two", "replies": ""}}, {"kind": "more", "data": {}}]}}}}]}}]
    df = spark.createDataFrame([(1, json.dumps(post)), (2, "broken"), (3, None)], "id int, j string")
    out = {r["id"]: r for r in jsonl.post_details(df, "j").collect()}
    assert (out[1]["title"], out[1]["body"]) == ("T", "B") and out[2]["title"] is None and out[3]["comments"] is None
    nested = threads.nested_comments(jsonl.post_details(df, "j"), "comments").where("id = 1").first()["comments"]
    assert json.loads(nested) == [{"body": "one", "replies": [{"body": "two", "replies": []}]}]


def test_last_page_and_look_ahead(spark):
    rows = [("a", p, n) for p, n in enumerate([3, 0, 2, 0, 0, 0, 0, 0, 9], 1)] + [("b", p, 5) for p in range(1, 9)] + [("c", 1, 0)]
    df = spark.createDataFrame(rows, "site string, page int, found int")
    assert {r["site"]: (r["stop_at"], r["reason"]) for r in frontier.last_page(df, "site", "page", "found", 20).collect()} == {"a": (8, "empty"), "b": (4, "target"), "c": (1, "end")}
    assert {r["site"]: r["stop_at"] for r in frontier.last_page(df, "site", "page", "found", 20, resume=6).collect()} == {"a": 9, "b": 8}
    assert {r["site"]: r["stop_at"] for r in frontier.look_ahead(df, "site", "page", "found", after=3).collect()} == {"a": 4}


def test_round_robin_and_rates(spark):
    df = spark.createDataFrame([(k, "x" if k % 2 else None) for k in range(20)], "k int, d string")
    out = {r["k"]: r["worker"] for r in frontier.round_robin(df, [F.desc("k")], 3).collect()}
    assert out == {k: (19 - k) % 3 for k in range(20)}
    rates = spark.createDataFrame([("x", 5.0), (None, 9.0), ("x", 4.0)], "d string, rate double")
    assert {r["k"]: r["rate"] for r in frontier.with_rate(df, rates, "d", "rate", 1.0).collect()} == {k: 5.0 if k % 2 else 1.0 for k in range(20)}


def test_embedding_step(spark):
    def model(texts):
        return np.array([[len(t.split()), 1.0, 0.0] if t != "zero" else [0.0] * 3 for t in texts])

    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, " "), (4, "zero"), (5, "w " * 600)], "id int, t string")
    out = {r["id"]: r for r in dedup.embedded(df, "t", model).collect()}
    assert out[2]["embedding"] is None and out[3]["embedding"] is None and out[4]["embedding_hash"] is None
    assert abs(np.linalg.norm(out[1]["embedding"]) - 1) < 1e-6 and abs(out[5]["embedding"][0] / out[5]["embedding"][1] - 512) < 0.1 and len(out[1]["embedding_hash"]) == 64


def test_cascade_with_vectors(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((60, 24))
    close = base[:20] + 0.01 * r.standard_normal((20, 24))
    rows = [(k, f"h{k}", None, v.tolist()) for k, v in enumerate(base)] + [(100 + k, f"c{k}", None, v.tolist()) for k, v in enumerate(close)]
    rows += [(200, "h3", 5, None), (201, None, 5, None), (202, None, 7, base[30].tolist()), (203, None, None, base[31].tolist())]
    df = spark.createDataFrame(rows, "id int, h string, s long, v array<double>")
    out = {x["key"]: (x["duplicate_type"], x["duplicate_of"], x["confidence"]) for x in dedup.cascade(df, "id", "h", "s", vector="v").collect()}
    assert out[200] == ("exact", 3, 1.0) and out[201] == ("near_simhash", 200, 1.0) and out[202] == ("near_simhash", 200, round(1 - 1 / 64, 6)) and out[203] == ("near_embedding", 31, 1.0)
    assert sum(out[100 + k][:2] == ("near_embedding", k) for k in range(20)) >= 19 and all(out[k] == ("none", None, 0.0) for k in range(60))


def test_recall_of_vector_links(spark):
    """Against brute force, at the threshold of the cascade."""
    r = np.random.default_rng(9)
    base = r.standard_normal((120, 32))
    near = base + r.uniform(0.0, 0.4, (120, 1)) * r.standard_normal((120, 32))
    v = np.concatenate((base, near))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    cos = unit @ unit.T
    expected = {(a, b) for a in range(240) for b in range(a + 1, 240) if cos[a, b] >= 0.95}
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id int, v array<double>")
    found = {(x["a"], x["b"]) for x in dedup.lsh_links(df, "id", "v").collect()}
    assert found <= expected and len(found) >= 0.95 * len(expected) > 50


def test_keep_first_of_many_copies(spark):
    rows = [(k, "same" if k % 3 else f"t{k}", "x") for k in range(90)] + [(5, "same", "x"), (None, None, "y"), (None, None, "y")]
    out = dedup.keep_first(spark.createDataFrame(rows, "id int, t string, e string"), [F.col("t")], [F.col("id")])
    assert out.columns == ["id", "t", "e"] and sorted((r["t"] or "", r["id"] or 0) for r in out.collect()) == sorted([(f"t{k}", k) for k in range(0, 90, 3)] + [("same", 1), ("", 0)])


def test_numbered_within_groups(spark):
    df = spark.createDataFrame([("a" if k % 4 else None, k) for k in range(200)], "g string, k int")
    out = stats.numbered(df, [F.col("k")], ["g"]).collect()
    for g in ("a", None):
        assert [r["number"] for r in sorted((r for r in out if r["g"] == g), key=lambda r: r["k"])] == list(range(1, sum(r["g"] == g for r in out) + 1))


def test_replies_of_a_long_thread(spark):
    rows = [("t", k, f"b{k}") for k in range(500)] + [("u", 1, None), ("u", 2, ""), (None, 1, "z")]
    out = {r["thread"]: r["replies_body"] for r in threads.joined_replies(spark.createDataFrame(rows, "thread string, k int, body string"), "thread", "body", ["k"]).collect()}
    assert out == {"t": "\n\n".join(f"b{k}" for k in range(500)), "u": "", None: "z"}


def test_gates(spark):
    body = "<p>" + "You can bake the bread in a hot oven, and then let it rest on the table. Recipe and cooking need patience. " * 4 + "</p>"
    page = lambda t: f"<html><body><article><h1>Bread recipe for beginners</h1>{t}</article></body></html>"
    rows = [(1, "https://a.test/1", True, page(body), "2024-01-01 00:00:00"), (2, "https://a.test/2", True, page(body), "2024-01-01 00:00:00"), (3, "https://a.test/3", False, None, "2024-01-01 00:00:00"), (4, "https://a.test/4", True, "<p>x</p>", "2024-01-01 00:00:00"), (5, "https://a.test/5", True, page("<p>Too short a text to be kept by the gate for cleaning, though it is an article of a kind.</p>"), "2024-01-01 00:00:00")]
    out = {r["page_id"]: r["rejected_at"] for r in corpus.gated(spark.createDataFrame(rows, "page_id int, url string, success boolean, content string, fetched_at string"), F.lit("2024-02-01").cast("timestamp")).collect()}
    assert out[3] == "fetch" and out[4] == "extraction" and out[5] == "cleaning" and out[2] in ("duplicate", out[1]) and len(out) == 5


def test_stream_loop_and_cleanup(spark, tmp_path):
    from lontar.streaming import corpus as streams

    for k in range(3):
        spark.createDataFrame([(k * 10 + n,) for n in range(5)], "k long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen, cleaned = [], []
    stream = streams.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, "parquet", 1)
    q = streams.loop(stream, str(tmp_path / "run"), lambda b, n: b.count(), lambda b, n: seen.extend(r["k"] for r in b.collect()), 5, 10, lambda: cleaned.append(1), available_now=True)
    assert streams.until_stopped(q) == "done" and sorted(seen) == sorted(k * 10 + n for k in range(3) for n in range(5)) and cleaned == [1]
    assert sinks.State(spark, str(tmp_path / "run/state")).get("progress")["rows"] == 15
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-03-01 00:00:00")], "k string, created_at string").selectExpr("k", "CAST(created_at AS timestamp) AS created_at").write.parquet(str(tmp_path / "keys"))
    assert streams.forget(spark, str(tmp_path / "keys"), "created_at", 30, "2024-03-10 00:00:00") == 1


def test_all_and_export(spark, tmp_path, capsys):
    from lontar.__main__ import main

    spark.createDataFrame([(f"e{k}", "text " * 50) for k in range(25)], "id string, text string").write.parquet(str(tmp_path / "entries"))
    assert main(["export", "--in", str(tmp_path / "entries"), "--out", str(tmp_path / "out"), "--bulk"]) == 0
    assert main(["status", "--in", str(tmp_path / "out")]) == 0
    assert "25" in capsys.readouterr().out
    assert main(["report", "--in", str(tmp_path / "entries"), "--title", "text", "--url", "id", "--out", str(tmp_path / "report")]) == 0


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "t.json").write_text('[\n{"k": 1},\n{"k": 2}\n]')
    assert [json.loads(r["thread"])["k"] for r in jsonl.read_threads(spark, str(tmp_path / "t.json")).orderBy("place").collect()] == [1, 2]
    (tmp_path / "b.txt").write_text("one\ntwo")
    assert books.read_texts(spark, str(tmp_path / "b.txt")).first()["text"] == "one\ntwo"
