"""Goldens and edge cases of the functions."""

import pytest
from pyspark.sql import functions as F

from lontar.functions import ids, pii, text, urls
from lontar.operators import quality


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("Don't stop.. now!!", 'Don"t stop... now!'), ("a\nb", "ab"), ("10 : 30 ,", "10: 30,"), ("  two   words ", "two words"), ("5 kg of x", "5kg of x"), ("", ""), (None, None), ("“curly” – dash…", "“curly” — dash...")],
)
def test_normalised(spark, value, expected):
    assert one(spark, value, text.normalised) == expected


def test_normalised_keeps_lines(spark):
    assert one(spark, "a\r\nb\n\n\n\nc", lambda c: text.normalised(c, keep_lines=True)) == "a\nb\n\nc"


@pytest.mark.parametrize(("value", "expected"), [("you/me", "yo"), ("see https://x.y/z now", "see now"), ("call (555) 123-4567!", "call !"), (None, ""), ("a 😀 b", "a b"), ("x@y.io there", "there")])
def test_thread_v1(spark, value, expected):
    assert one(spark, value, text.thread_text_v1) == expected


@pytest.mark.parametrize(("value", "expected"), [("&gt; quoted", "> quoted"), ("> quoted\ntext", "quoted\ntext"), ("a\n\n\n\nb", "a\n\nb"), ("you/me u/someone", "you/me"), ("2020-2025", ""), (None, "")])
def test_thread_v2(spark, value, expected):
    assert one(spark, value, text.thread_text_v2) == expected


def test_news_residue(spark):
    assert one(spark, "ADVERTISEMENT - Hujan turun di kota. tag berita kota", text.news_without_residue) == "Hujan turun di kota."
    assert one(spark, "Hujan turun. satu dua tiga empat lima enam", text.news_without_residue) == "Hujan turun. satu dua tiga empat lima enam"


def test_masked(spark):
    row = pii.mask(spark.createDataFrame([(1, "Call 555-123-4567 or mail a.b@x.io"), (2, None), (3, ""), (4, "acct 123456789012 ok")], "i int, t string"), "t").orderBy("i").collect()
    assert (row[0]["masked_text"], row[0]["pii_found"]) == ("Call xxx-xxx-xxxx or mail xxxx@xxxx.xxx", ["email", "phone"])
    assert row[1]["masked_text"] is None
    assert row[2]["masked_text"] == ""
    assert row[3]["masked_text"] == "acct xxxxxxxxxxxx ok"


@pytest.mark.parametrize(
    ("value", "masked", "kinds"),
    [
        ("Your Name wrote to Mary Jones", "Your Name wrote to xxxx xxxx", ["name"]), ("sign as John Doe", "sign as John Doe", []), ("mail xxxx@xxxx.xxx now", "mail xxxx@xxxx.xxx now", ["email"]), ("id ١٢٣-٤٥-٦٧٨٩", "id xxx-xx-xxxx", ["ssn"]),
        ("J. Smith and Ann B. Lee met Ann Lee", "xxxx xxxx and Ann xxxx xxxx met xxxx xxxx", ["name"]),
    ],
)
def test_masked_like_the_rules(spark, value, masked, kinds):
    row = pii.mask(spark.createDataFrame([(value,)], "t string"), "t").select("*", pii.found(F.col("t")).alias("found"), pii.masked(F.col("t")).alias("whole")).first()
    assert (row["masked_text"], row["pii_found"]) == (masked, kinds)
    assert (row["whole"], row["found"]) == (masked, kinds)


def test_line_ends_are_counted_where_they_stay(spark):
    counts = spark.createDataFrame([("a\r\n\n\n\nb",)], "t string").select(text.change_counts(F.col("t"), True).alias("kept"), text.change_counts(F.col("t")).alias("gone")).first()
    assert counts["kept"]["linebreaks_normalized"] == 2 and counts["gone"]["linebreaks_normalized"] == 0


@pytest.mark.parametrize(
    ("value", "expected"),
    [("https://x.com/a?b=2&a=1#f", "https://x.com/a?a=1&b=2"), ("https://x.com/a?b=", "https://x.com/a"), ("https://x.com/a", "https://x.com/a"), (None, None)],
)
def test_normal_url(spark, value, expected):
    assert one(spark, value, urls.normal) == expected
    if expected:
        assert one(spark, expected, urls.normal) == expected


def test_resolved(spark):
    df = spark.createDataFrame([("https://a.b/c/d", "../e"), ("https://a.b/c/d", "/e"), ("https://a.b/c", "https://z.y/"), (None, "x"), ("https://a.b/c", None)], "b string, l string")
    assert [r[0] for r in df.select(urls.resolved(F.col("b"), F.col("l"))).collect()] == ["https://a.b/e", "https://a.b/e", "https://z.y/", None, None]


@pytest.mark.parametrize(("title", "body", "expected"), [("A good long title", "x" * 99, "short_content"), ("nine char", "x" * 100, "poor_title"), ("A good long title", "x" * 100 + "Click Here", "contains_spam"), ("A good long title", "x" * 100, "clean"), (None, None, "short_content")])
def test_clean_status(spark, title, body, expected):
    df = spark.createDataFrame([(title, body)], "t string, b string")
    assert df.select(quality.clean_status(F.col("t"), F.col("b"))).first()[0] == expected


@pytest.mark.parametrize(("n", "expected"), [(0, 1), (199, 1), (399, 1), (400, 2)])
def test_reading_minutes(spark, n, expected):
    assert one(spark, " ".join(["w"] * n), quality.reading_minutes) == expected


def test_garbled(spark):
    assert one(spark, "a b c d e f g h i j k l m n o p q r s t u v w x y z", quality.garbled)
    assert not one(spark, "This is a perfectly ordinary sentence of some length, as it were. And here is another.", quality.garbled)
    assert not one(spark, None, quality.garbled)
    assert not one(spark, "short", quality.garbled)


def test_hash_form(spark):
    assert one(spark, "A - b\t\tc!", ids.hash_form) == "a  b c"
    assert one(spark, "", ids.content_hash) == ""
    assert one(spark, None, ids.content_hash) is None


def test_simhash(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, "one two three four"), (3, ""), (4, None), (5, "!!!")], "i int, t string")
    out = {r["i"]: r["simhash"] for r in ids.simhashes(df, "t").collect()}
    assert out[1] == out[2] and len(out[1]) == 16
    assert out[3] == out[4] == out[5] == ""
    assert one(spark, out[1], ids.simhash_number) is not None and one(spark, "", ids.simhash_number) is None


@pytest.mark.parametrize(("value", "expected"), [("5 m and 5 minutes", "5m and 5minutes"), ("10 kg", "10kg"), ("none", "none"), ("", ""), (None, None)])
def test_units_replaced(spark, value, expected):
    assert one(spark, value, text.units_replaced) == expected


def test_garbled_like_brute_force(spark, sf_dir):
    import re

    def expected(t):
        if len(t) < 50:
            return False
        words = re.findall(r"\w+", t)
        parts = re.split(r"[.!?]+", t)
        return sum(c.isprintable() for c in t) / len(t) < 0.9 or not words or sum(len(w) == 1 for w in words) / len(words) > 0.3 or (len(parts) >= 2 and sum(len(x.split()) for x in parts) / len(parts) < 3)

    rows = spark.read.parquet(f"{sf_dir}/export_entries.parquet").select("text", quality.garbled(F.col("text")).alias("g")).collect()
    assert rows and all(r["g"] == expected(r["text"]) for r in rows)


@pytest.mark.parametrize("value", ["plain", "ﬁne ①²", "é e\u0301", "", None])
def test_nfkc(spark, value):
    import unicodedata

    from lontar.functions.unicode import nfkc

    assert one(spark, value, nfkc) == (None if value is None else unicodedata.normalize("NFKC", value))
