"""Operators on small fixtures, against brute force where there is one."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lontar.operators import classify, dedup, frontier, html, stats, threads
from lontar.sources import jsonl, sinks


def test_hamming_links(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(40)]
    values = set(base)
    for v in base[:20]:
        for n in (1, 2, 3, 4):
            x = v
            for b in r.sample(range(64), n):
                x ^= 1 << b
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    expected = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    df = spark.createDataFrame([(v,) for v in signed + signed[:9]] + [(None,)], "signature long")
    links = dedup.hamming_links(df)
    assert {(x["a"], x["b"]) for x in links.collect()} == expected
    counts = {x["signature"]: (x["members"], x["links"]) for x in dedup.link_counts(links, df).collect()}
    assert len(counts) == len(signed) and counts[signed[0]][0] == 2


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 6), (9, 8), (8, 7), (7, 5), (4, 4)] + [(k, k + 1) for k in range(100, 160)]
    out = {r["node"]: r["component"] for r in dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out[3] == 1 and out[9] == 5 and out[160] == 100 and 4 not in out
    assert dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cascade(spark):
    rows = [(1, "h1", 0), (2, "h1", 0), (3, "h3", 7), (4, None, None), (5, "h5", 1 << 40)]
    out = {r["key"]: (r["duplicate_type"], r["duplicate_of"]) for r in dedup.cascade(spark.createDataFrame(rows, "k long, e string, s long"), "k", "e", "s").collect()}
    assert out == {1: ("none", None), 2: ("exact", 1), 3: ("near_simhash", 1), 4: ("none", None), 5: ("near_simhash", 1)}


def test_keep_first(spark):
    df = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, None)], "i int, t string")
    assert sorted(r["i"] for r in dedup.keep_first(df, [F.col("t")], [F.col("i")]).collect()) == [1, 3]


def test_nearest_and_lsh(spark):
    import numpy as np

    g = np.random.default_rng(1)
    v = g.standard_normal((60, 16))
    v[30:45] = v[:15] + 0.02 * g.standard_normal((15, 16))
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(100, None), (101, []), (102, [0.0] * 16), (103, v[0].tolist())]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    best = {(r["query"], r["place"]): r["neighbour"] for r in dedup.nearest(df.where("id < 5"), df.where("id < 100"), "id", "v", 3).collect()}
    for q in range(5):
        order = [k for k in np.argsort(-(u @ u[q])) if k != q]
        assert [best[q, p] for p in (1, 2, 3)] == order[:3]
    pairs = {(r["a"], r["b"]) for r in dedup.lsh_links(df, "id", "v", 0.95).collect()}
    expected = {(a, b) for a in range(60) for b in range(a + 1, 60) if u[a] @ u[b] >= 0.95}
    assert len(pairs & expected) >= 0.9 * len(expected) and pairs <= expected


def test_classify(spark):
    rows = [(1, "How to clean", "wash and scrub the floor with soap " * 5), (2, None, ""), (3, "x", None), (4, "zzz", "qqq " * 40), (5, "Clean", "wash scrub soap news " * 8)]
    df = classify.validated(classify.classify(spark.createDataFrame(rows, "i int, t string, c string"), "t", "c"), "t", "c")
    out = {r["i"]: r for r in df.collect()}
    assert out[1]["topic"] == "cleaning_techniques" and out[1]["subdomain"] == "sanitation_methods" and out[1]["is_allowed"]
    assert out[2]["rejection_reason"] == out[3]["rejection_reason"] == "empty_content"
    assert out[4]["rejection_reason"] == "no_matching_topics"
    assert out[5]["rejection_reason"] == "excluded_topic" and out[5]["topic"] is None


def test_frontier(spark):
    rows = [(1, "d", "2024-01-01 00:00:00"), (2, "d", "2024-01-01 00:00:30"), (3, "d", "2024-01-01 00:01:00"), (4, "d", "2024-01-01 00:01:31"), (5, "e", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "i int, k string, s string").select("i", "k", F.col("s").cast("timestamp").alias("ts"))
    assert {r["i"]: r["in_window"] for r in frontier.within_window(df, "k", "ts").collect()} == {1: 1, 2: 2, 3: 3, 4: 2, 5: 1}
    assert {r["i"]: r["gap_seconds"] for r in frontier.since_previous(df, "k", "ts", "i").collect()} == {1: None, 2: 30, 3: 30, 4: 31, 5: None}
    failed = frontier.after_failure(df.withColumn("n", F.lit(2)), "n", "ts").first()
    assert failed["status"] == "failed" and failed["next_attempt"] is None
    again = frontier.after_failure(df.withColumn("n", F.lit(0)).where("i = 1"), "n", "ts").first()
    assert again["status"] == "pending" and str(again["next_attempt"]) == "2024-01-01 01:00:00"


def test_shards(spark):
    df = spark.createDataFrame([(k,) for k in range(95)], "i int")
    out = stats.shards(df, [F.col("i")], 10).collect()
    assert all(r["shard"] == r["i"] // 10 for r in out) and len(out) == 95


PAGE = """<html><head><title>A title of the page</title><meta name="author" content="Someone"><meta name="keywords" content="b, a,,b"></head><body><nav><a href="/x">Menu entry</a></nav>
<div class="sidebar">Side words</div><article><h1>The heading of this article</h1><p>{}</p><p>Second paragraph. It ends here.</p><script>x()</script></article></body></html>"""


def test_extract(spark):
    rows = [(1, PAGE.format("Some real words of the first paragraph. " * 8)), (2, None), (3, "<p>short</p>"), (4, "x" * 200), (5, "<div>" * 3000 + "deep" + "</div>" * 3000)]
    out = {r["i"]: r for r in html.extract(spark.createDataFrame(rows, "i int, h string"), "h").collect()}
    assert out[1]["title"] == "The heading of this article" and out[1]["author"] == "Someone" and out[1]["keywords"] == ["a", "b"]
    assert "real words" in out[1]["content"] and "x()" not in out[1]["content"] and "Side words" not in out[1]["content"]
    assert out[2]["extraction_method"] == out[3]["extraction_method"] == out[4]["extraction_method"] == "failed"
    assert len(out) == 5


def test_extract_best_of(spark):
    df = spark.createDataFrame([(1, PAGE.format("Words. " * 40))], "i int, h string")
    methods = {"poor": lambda h: {"content": "few"}, "custom": html.custom, "same": html.custom, "broken": lambda h: (_ for _ in ()).throw(ValueError())}
    assert html.extract(df, "h", methods).first()["extraction_method"] == "custom"


def test_paragraphs(spark):
    page = "<h1>T</h1><article><p>" + "word " * 20 + "</p><p>short</p></article><div>" + "other " * 60 + "</div>"
    assert html.paragraphs(page)["content"] == ("word " * 20).strip()
    assert html.paragraphs("<div>" + "other " * 60 + "</div>")["content"].startswith("other") and html.paragraphs("<p>x</p>") is None
    df = spark.createDataFrame([(1, page)], "i int, h string")
    assert html.extract(df, "h", {"custom": html.custom, "paragraphs": html.paragraphs}).count() == 1


def test_comments(spark):
    tree = json.dumps([{"body": "A", "replies": [{"body": "B"}]}, {"body": "C", "replies": ""}, {"body": None}])
    listing = json.dumps({"data": {"children": [{"kind": "t1", "data": {"body": "X", "replies": {"data": {"children": [{"kind": "more", "data": {}}, {"kind": "t1", "data": {"body": "Y"}}]}}}}]}})
    df = spark.createDataFrame([(1, tree), (2, listing), (3, "no json"), (4, None), (5, "[]")], "t int, c string")
    flat = threads.flatten_comments(df, "c")
    assert [(r["t"], r["place"], r["depth"], r["body"]) for r in flat.orderBy("t", "place").collect()] == [(1, 0, 0, "A"), (1, 1, 1, "B"), (1, 2, 0, "C"), (1, 3, 0, None), (2, 0, 0, "X"), (2, 1, 1, "Y")]
    joined = {r["t"]: r["replies_body"] for r in threads.joined_replies(flat, "t", "body", ["place"]).collect()}
    assert joined == {1: "A\n\nB\n\nC", 2: "X\n\nY"}


def test_sniffed():
    assert jsonl.sniffed('{"a": 1}\nbroken\n{"data": [{"b": 2}, 3]}') == [{"a": 1}, {"b": 2}]
    assert jsonl.sniffed('[{"a": 1}, {"b": "}"}]') == [{"a": 1}, {"b": "}"}]
    assert jsonl.sniffed('[{"a": 1}, {bad}, {"b": "x\\"}"}, {"c": ') == [{"a": 1}, {"b": 'x"}'}]
    assert jsonl.sniffed("") == []
    assert jsonl.sniffed('{\n "data": [\n {\n"a": 1\n}\n]}') == []


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": "1", "text": "x"}\nbroken\n{"id": "2"}\n')
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("id", StringType()), StructField("text", StringType())])
    df = jsonl.read_lines(spark, str(tmp_path / "in"), schema)
    assert sorted(map(tuple, df.collect()), key=lambda r: r[0]) == [("1", "x"), ("2", None)]
    assert len(jsonl.read_lines(spark, str(tmp_path / "in"), schema, keep_broken=True).collect()) == 3
    (tmp_path / "t.json").write_text('[{"title": "t", "comments": []}, {"title": "u"')
    assert jsonl.read_threads(spark, str(tmp_path / "t.json")).count() == 1
    rows = spark.createDataFrame([(k, f"text {k}") for k in range(25)], "id int, text string")
    sinks.write_shards(rows, str(tmp_path / "out"), [F.col("id")], 10)
    found = sinks.manifest(spark, str(tmp_path / "out"))
    assert found.agg(F.sum("entries")).first()[0] == 25 and {r["shard"] for r in found.collect()} == {0, 1, 2}
    assert spark.read.json(str(tmp_path / "out")).count() == 25
    sinks.write_lines(df, str(tmp_path / "lines"))
    assert jsonl.read_lines(spark, str(tmp_path / "lines"), schema).count() == 2
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 25
    sinks.write_array(rows.coalesce(1), str(tmp_path / "arrays"))
    assert spark.read.option("multiLine", True).json(str(tmp_path / "arrays")).count() == 25


def test_listings(spark):
    post = {"kind": "t3", "data": {"title": "T", "author": "a", "permalink": "/r/x/1", "score": 1, "num_comments": 2, "created_utc": 1.0, "post_hint": "image", "url": "u.png", "thumbnail": "self", "selftext": "s" * 300}}
    other = {"kind": "t3", "data": {"title": "U", "preview": {"images": [{"source": {"url": "p.png"}}]}, "thumbnail": "t.png"}}
    df = spark.createDataFrame([(json.dumps({"data": {"children": [post, other]}}),), ("broken",), (None,)], "j string")
    out = {r["title"]: r for r in jsonl.listing_posts(df, "j").collect()}
    assert out["T"]["image_url"] == "u.png" and out["T"]["thumbnail_url"] is None and len(out["T"]["description"]) == 269
    assert out["U"]["image_url"] == "p.png" and out["U"]["thumbnail_url"] == "t.png"
    feed = {"data": {"children": [{"kind": "t3", "data": {"title": "P", "url": "u"}}, {"kind": "t1", "data": {"body": "B"}}, {"kind": "x", "data": {}}]}}
    kinds = jsonl.user_activity(spark.createDataFrame([(json.dumps(feed),)], "j string"), "j").collect()
    assert sorted((r["type"], r["title"], r["body"]) for r in kinds) == [("comment", None, "B"), ("post", "P", None)]


@pytest.mark.parametrize("empty", [True, False])
def test_histograms_of_nothing(spark, empty):
    df = spark.createDataFrame([] if empty else [(None, None, None)], "k string, t string, h string")
    assert stats.histograms(df, ["k"], "t", "h").count() == (0 if empty else 2)
