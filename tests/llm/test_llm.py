"""Operators for training data: small fixtures against brute force, and the defined results of odd input."""

import random
import re
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from lontar.llm import blocks, contamination, history, lines, mixing, pii, pii_examples, quality, residue, spans, topics

WORDS = "river stone lamp garden winter copper slow bright market harbour paper violin carpet signal orchard velvet thunder meadow lantern bridge".split()


def sentence(r, n=12):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 60)) for _ in range(n))


# --- 7 -------------------------------------------------------------------------------------------------------------


def triples(t):
    w = re.findall(r"\w+", t.lower()) if t else []
    return frozenset(zip(w, w[1:], w[2:]))


def near_rows(seed=5):
    r = random.Random(seed)
    base = [sentence(r, 60) for _ in range(30)]
    edited = []
    for t in base:
        w = t.split()
        for k in range(r.randint(0, 14)):
            w[r.randrange(len(w))] = f"new{k}"
        edited.append(" ".join(w))
    return base, edited


@pytest.fixture(scope="module")
def articles(spark):
    base, edited = near_rows()
    news = [(f"n{k}", f"https://www.a.b/p/{k}/?utm_source=x#f", t) for k, t in enumerate(base)] + [("n0", "https://www.a.b/p/0/?utm_source=x#f", base[0]), ("nn", None, None), ("ne", "", "")]
    new = [(1 + k % 3, f"i{k}", f"http://c.d/{k}", t) for k, t in enumerate(edited)]
    new += [(2, "same-url", "HTTP://A.B/p/3", "some other words here"), (3, "earlier", "http://z/1", edited[0] + " tail"), (1, "null", None, None), (2, "empty", "", ""), (3, "two", "http://z/2", "two words"), (1, "ascii", "http://z/3", base[2].upper() + "!!")]
    return (
        spark.createDataFrame(new, "batch_no int, id string, source_url string, text string"), spark.createDataFrame(news, "id string, source_url string, text string"),
        spark.createDataFrame([(1, "0" * 64, None)], "id long, exact_hash string, simhash string"), base, edited, new,
    )


def expected_near(news, new):
    rows = [(0, t) for t in news] + [(b, t) for b, _, _, t in new]
    out = set()
    for b, i, _, t in new:
        a = triples(t)
        if any(x < b and a and triples(u) and len(a & triples(u)) / len(a | triples(u)) >= 0.6 for x, u in rows):
            out.add(i)
    return out


def test_known_articles(spark, articles):
    new, news, index, base, _, rows = articles
    out = history.known_articles(new, news, index).collect()
    assert {r["id"] for r in out if r["reason"] == "near"} == expected_near(base, rows)
    assert {r["id"] for r in out if r["reason"] == "url"} == {"same-url"}
    assert "ascii" in {r["id"] for r in out if r["reason"] == "exact"}
    assert not {"null", "empty", "two"} & {r["id"] for r in out}


def test_hot_triples_give_the_same(spark, articles, monkeypatch):
    new, news, index, base, _, rows = articles
    copies = [(f"c{k}", f"http://e.f/{k}", base[0] + f" copy{k}") for k in range(40)]
    many = news.unionByName(spark.createDataFrame(copies, news.schema))
    for name, value in (("USES", 2), ("HOT", 2), ("REPRESENTATIVES", 2), ("SALTS", 3)):
        monkeypatch.setattr(history, name, value)
    found = history.known_articles(new, many, index).where("reason = 'near'").collect()
    assert {r["id"] for r in found} == expected_near(base + [t for _, _, t in copies], rows)


def test_long_and_short_texts_meet(spark):
    r = random.Random(8)
    base = [sentence(r, n) for n in (3, 4, 5, 8, 13, 40, 150, 700)]
    new = []
    for k, t in enumerate(base):
        w = t.split()
        for part in (0.5, 0.62, 0.75, 0.9, 1.0):
            new.append((1, f"{k}-{part}", None, " ".join(w[: max(1, int(len(w) * part))])))
        new.append((1, f"{k}-more", None, t + " " + sentence(r, max(1, len(w) // 2))))
    news, batch = spark.createDataFrame([(f"n{k}", None, t) for k, t in enumerate(base)], "id string, source_url string, text string"), spark.createDataFrame(new, "batch_no int, id string, source_url string, text string")
    found = history.known_articles(batch, news, spark.createDataFrame([], "exact_hash string")).where("reason = 'near'").collect()
    assert {x["id"] for x in found} == expected_near(base, new)


def test_history_of_nothing(spark, articles):
    new, news, index, *_ = articles
    assert history.known_articles(new.limit(0), news, index).count() == 0
    assert history.known_articles(new.where("batch_no = 1"), news.limit(0), index.limit(0)).count() == 0


def test_history_is_signed_once(spark, articles, tmp_path):
    """Batches are checked one after the other against the table; the texts of history are gone by then."""
    new, news, index, base, _, rows = articles
    news.write.parquet(str(tmp_path / "news"))
    table = history.HistoryTable(spark, str(tmp_path / "h"))
    table.create(spark.read.parquet(str(tmp_path / "news")), index)
    shutil.rmtree(tmp_path / "news")
    found = set()
    for number in (1, 2, 3):
        before = table.rows().count()
        table.append(new.where(F.col("batch_no") == number).select("id", F.col("batch_no").alias("batch"), "source_url", "text"))
        assert table.rows().count() == before + sum(b == number for b, *_ in rows)
        found |= {(r["id"], r["reason"]) for r in table.known(number).collect()}
    assert found == {(r["id"], r["reason"]) for r in history.known_articles(new, news, index).collect()}
    assert {i for i, reason in found if reason == "near"} == expected_near(base, rows)
    plan = table.known(3)._jdf.queryExecution().toString()
    assert "news" not in plan and "range" in plan


@pytest.mark.parametrize(
    ("a", "b"),
    [("https://www.A.b/x/", "http://a.b/x"), ("https://a.b/x?utm_a=1&k=2&fbclid=3", "a.b/x?k=2"), ("https://a.b/x#y", "https://a.b/x"), ("https://a.b/", "https://a.b"), ("https://a.b/x/?gclid=1", "https://a.b/x")],
)
def test_normal_url(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(history.normal_url(F.col("a")), history.normal_url(F.col("b"))).first()
    assert row[0] == row[1]


# --- 8 -------------------------------------------------------------------------------------------------------------


def test_suffix_order():
    r = np.random.default_rng(2)
    for n in (1, 2, 50, 300):
        codes = r.integers(1, 4, n)
        order = contamination.suffix_order(codes, 12).tolist()
        assert order == sorted(range(n), key=lambda i: (codes[i : i + 16].tolist(), i)) or [codes[i : i + 12].tolist() for i in order] == sorted(codes[i : i + 12].tolist() for i in range(n))


def test_fm_index():
    r = np.random.default_rng(4)
    codes = r.integers(1, 5, 400)
    index = contamination.FMIndex(codes, 5, 6)
    phrases = np.array([codes[i : i + 5] for i in r.integers(0, 395, 40)] + [[4, 4, 4, 4, 1]])
    lo, hi = index.search(phrases)
    for p, a, b in zip(phrases, lo, hi):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(396) if (codes[i : i + 5] == p).all()]


def leaks(docs, items, n):
    out = set()
    for i, t in docs:
        w = re.findall(r"\w+", t.lower()) if t else []
        have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for j, u in items:
            v = re.findall(r"\w+", u.lower()) if u else []
            if any(tuple(v[k : k + n]) in have for k in range(len(v) - n + 1)):
                out.add((i, j))
    return out


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    r = random.Random(6)
    items = [(k, sentence(r, 20)) for k in range(12)]
    docs = [(k, sentence(r, 9) + " " + " ".join(items[k % 12][1].split()[k % 7 :]) + " " + sentence(r, 5)) for k in range(30)] + [(99, None)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (50, None)], "item_id long, text string")
    whole = sorted(map(tuple, contamination.leaked_spans(d, i).collect()))
    assert len({x[0] for x in whole}) == 30
    monkeypatch.setattr(contamination, "ITEM_WORDS", 100)
    assert whole == sorted(map(tuple, contamination.leaked_spans(d, i).collect()))


def test_leaked(spark, monkeypatch):
    r = random.Random(8)
    items = [(k, sentence(r, 20)) for k in range(12)] + [(50, None), (51, "too short"), (52, "")]
    docs = []
    for k in range(60):
        w = sentence(r, 40).split()
        if k % 3 == 0:
            v = items[k % 12][1].split()
            a = r.randint(0, 8)
            w[10:10] = v[a : a + r.randint(10, 14)]
        docs.append((k, ", ".join(w).upper() if k % 2 else "\n".join(w)))
    docs += [(90, None), (91, ""), (92, docs[0][1]), (92, docs[0][1]), (93, sentence(r, 3000) + " " + items[1][1] + " " + sentence(r, 3000))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(contamination, "SHARD_WORDS", 500)
    out = contamination.leaked(d, i)
    assert {tuple(x) for x in out.collect()} == leaks(docs, items, 12)
    assert contamination.leaked(d.limit(0), i).count() == 0 and contamination.leaked(d, i.limit(0)).count() == 0
    spans_ = {(x["doc_id"], x["item_id"]): (x["first_word"], x["last_word"]) for x in contamination.leaked_spans(d, i).collect()}
    assert spans_[93, 1] == (3000, 3019)


# --- 9 -------------------------------------------------------------------------------------------------------------


def test_mixing(spark):
    r = random.Random(1)
    docs = [(k, r.choice(["a", "b", "c", None]), sentence(r, r.randint(1, 40))) for k in range(400)] + [(900, "a", None), (901, "a", ""), (902, "d", "no target"), (5, "b", "again the same id")]
    targets = [("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.1, None), ("none", 0.1, 3), (None, 0.1, 1)]
    d, t = spark.createDataFrame(docs, "doc_id long, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    counts = mixing.count_tokens(d).cache()
    plan = mixing.budgets(counts, t)
    report = {x["source"]: x for x in mixing.report(plan).collect()}
    chosen = mixing.select(counts, plan).collect()
    for s, repeats in (("a", 2), ("b", 1), ("c", 1)):
        own = [x for x in chosen if x["source"] == s]
        assert sum(x["used_tokens"] for x in own) == report[s]["used_tokens"] == min(report[s]["budget_tokens"], repeats * report[s]["available_tokens"])
        assert max(x["copies"] for x in own) <= repeats and all(x["used_tokens"] <= x["copies"] * x["n_tokens"] for x in own)
    assert report["none"]["used_tokens"] == 0 and "d" not in report and None not in report
    assert abs(sum(x["reached_share"] for x in report.values()) - 1) < 1e-9
    assert mixing.report(mixing.budgets(counts.limit(0), t)).count() == 4
    assert mixing.select(counts.limit(0), mixing.budgets(counts.limit(0), t)).count() == 0


def test_long_texts_count_as_in_one_piece(monkeypatch):
    encoding = mixing._encoding(mixing.DEFAULT_TOKENIZER)
    r = random.Random(3)
    text = " ".join(sentence(r, 30) + r.choice([".\n", "  ", " 'll ", "! "]) for _ in range(80))
    whole = len(encoding.encode_ordinary(text))
    monkeypatch.setattr(mixing, "PIECE", 150)
    assert mixing._length(encoding, text) == whole


# --- 10 ------------------------------------------------------------------------------------------------------------


def shared(docs, n):
    have = {}
    for i, t in docs:
        for k in range(len(t or "") - n + 1):
            have.setdefault(t[k : k + n], set()).add(i)
    return {(a, b) for s in have.values() for a in s for b in s if a < b}


def test_shared_pairs(spark, monkeypatch):
    r = random.Random(6)
    block = [sentence(r, 40) for _ in range(5)]
    docs = []
    for k in range(40):
        b = r.choice(block)
        a = r.randint(0, 40)
        docs.append((k, sentence(r, 20) + b[a : a + r.randint(60, 140)] + sentence(r, 10)))
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, None), (103, ""), (104, "x" * 700), (105, "y" + "x" * 500), (106, "ab" * 200), (107, "é😀" * 80), (108, "z" + "é😀" * 70), (0, docs[0][1]), (109, "tiny")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(x) for x in spans.shared_pairs(df, 100).collect()} == shared(docs, 100)
    monkeypatch.setattr(spans, "CHUNK", 150)
    monkeypatch.setattr(spans, "HOT", 2)
    assert {tuple(x) for x in spans.shared_pairs(df, 100).collect()} == shared(docs, 100)
    assert spans.shared_pairs(df.limit(0), 100).count() == 0


def test_shared_share_with_repeats_and_overlaps(spark, monkeypatch):
    r = random.Random(21)
    rand = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    p, q, long = rand(70), rand(90), rand(200)
    texts = [rand(30) + p + rand(40) + p + rand(20), rand(55) + p + rand(30), long + rand(40), rand(25) + long[:120] + rand(10), rand(12) + long[80:] + rand(33), q + rand(20) + q, rand(31) + q, rand(150), "short", rand(10) + p[20:] + q[:65] + rand(9)]
    least = 60
    covered = {}
    for a, t in enumerate(texts):
        spots = set()
        for i in range(len(t) - least + 1):
            if any(t[i : i + least] in u for b, u in enumerate(texts) if b != a):
                spots.update(range(i, i + least))
        if spots:
            covered[a] = len(spots)
    out = {x["doc_id"]: x["shared_chars"] for x in spans.shared_share(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least).collect()}
    assert out == covered


def test_shared_share(spark):
    a, b = "abcdefghij" * 3, "klmnopqrst" * 3
    docs = [(1, "1" * 9 + a + "2" * 11), (2, "3" * 8 + a + b), (3, "4" * 5 + b), (4, "x" * 40), (5, "x" * 40), (6, None)]
    out = {x["doc_id"]: (x["shared_chars"], x["n_chars"]) for x in spans.shared_share(spark.createDataFrame(docs, "doc_id long, text string"), 25).collect()}
    assert out == {1: (30, 50), 2: (60, 68), 3: (30, 35), 4: (40, 40), 5: (40, 40)}


# --- 3 -------------------------------------------------------------------------------------------------------------


def norm(line):
    return re.sub(r"\d+", "0", re.sub(r"\s+", " ", line).strip().lower())


def test_repeated_lines(spark):
    r = random.Random(9)
    notes = ["Share  this NOW", "Copyright 2023 Us", "one\ttwo", "  Read more 17 "]
    docs = []
    for k in range(80):
        own = [sentence(r, 6) for _ in range(5)] + [n.replace("2023", str(2000 + k)) for n in notes if r.random() < 0.5]
        r.shuffle(own)
        docs.append((r.choice(["a", "b", None]), f"d{k % 60}", r.choice(["\n", "\n\n", "\r\n"]).join(own)))
    docs += [("a", "x", None), ("a", "y", ""), ("a", None, "Share this now"), ("c", "z", "Share this now")] + [("c", "z", "Share this now")] * 9
    df = spark.createDataFrame(docs, "site string, id string, text string")
    have = {}
    for s, i, t in docs:
        for line in (t or "").split("\n"):
            if s and i and norm(line):
                have.setdefault((s, norm(line)), set()).add(i)
    expected = {k for k, v in have.items() if len(v) >= 5}
    assert {(x["site"], x["line"]) for x in lines.repeated_lines(df).collect()} == expected
    left = lines.without_repeated(df).collect()
    assert len(left) == len(docs)
    assert not any((x["site"], norm(line)) in expected for x in left if x["text"] for line in x["text"].split("\n"))
    assert lines.repeated_lines(df.limit(0)).count() == 0


def test_blocks_of_lines(spark):
    docs = [("s", str(k), f"own {chr(97 + k)}\nfirst\nsecond\nthird\nend {chr(97 + k)}") for k in range(6)]
    found = lines.repeated_blocks(lines.sequences(spark.createDataFrame(docs, "site string, id string, text string"))).collect()
    assert sorted(len(x["block"]) for x in found) == [1, 1, 1, 2, 2, 3] and {x["ids"] for x in found} == {6}


def test_blocks_of_any_length_are_deleted_as_one(spark, monkeypatch):
    r = random.Random(4)
    block = [f"fixed line {chr(97 + k)}" for k in range(11)]
    docs = [("s", f"d{k}", "\n".join([sentence(r, 5), "", *block[:3], "", *block[3:], sentence(r, 5), block[7]])) for k in range(6)] + [("t", "d1", "\n".join(block)), (None, "d2", "\n".join(block)), ("s", None, "own\n" + "\n".join(block))]
    df = spark.createDataFrame(docs, "site string, id string, text string")
    told = sorted((x["site"] or "", x["id"] or "", x["text"], x["removed_blocks"], x["removed_lines"]) for x in lines.without_repeated(df).collect())
    assert {x[3:] for x in told if x[0] == "s" and x[1]} == {(2, 12)} and [x for x in told if x[0] == "s" and not x[1]] == [("s", "", "own", 1, 11)] and all(x[3:] == (0, 0) for x in told if x[0] != "s")
    monkeypatch.setattr(lines, "TOLD", 0)
    assert told == sorted((x["site"] or "", x["id"] or "", x["text"], x["removed_blocks"], x["removed_lines"]) for x in lines.without_repeated(df).collect())


def test_ids_of_many_texts_count_once(spark, monkeypatch):
    r = random.Random(14)
    docs = [("s", f"d{k}", f"shared one\nshared two\n{sentence(r, 4)}") for k in range(3)] + [("s", i, f"{sentence(r, 4)}\nshared one\nshared two\nonly here {i}\nshared one") for i in ("x", "y") for _ in range(9)]
    docs += [("s", "z", f"lonely line\n{sentence(r, 4)}") for _ in range(9)]
    df = spark.createDataFrame(docs, "site string, id string, text string")
    told = sorted((x["line"], x["ids"]) for x in lines.repeated_lines(df).collect())
    assert told == [("shared one", 5), ("shared two", 5)]
    monkeypatch.setattr(lines, "TEXTS", 4)
    assert told == sorted((x["line"], x["ids"]) for x in lines.repeated_lines(df).collect())
    assert sorted((len(x["block"]), x["ids"]) for x in lines.blocks_of(df).collect()) == [(1, 5), (1, 5), (2, 5)]


def test_cover():
    known = {(1,), (2,), (3,), (1, 2), (2, 3), (1, 2, 3), (5, 6)}
    assert lines.cover([9, 1, 2, 3, 9, 2, 5, 6, 5], known) == [(1, 4), (5, 6), (6, 8)] and lines.cover([], known) == []
    long = list(range(20, 40))
    assert lines.cover([7, *long, 8], {tuple(long[k : k + d]) for d in range(1, 5) for k in range(20 - d + 1)}) == [(1, 21)]


# --- 2, 5 ----------------------------------------------------------------------------------------------------------

PROSE = "The old bridge was closed for the winter, and the people of the town had to walk around the hill. It took them an hour more than before. "
LIST = "\n".join(f"- {w} {k}" for k, w in enumerate(WORDS))
JUNK = "x9$#@! ~~|| {}{} <<>> %%^^ 0x00ff &&** " * 8


def test_no_prose(spark):
    rows = [("p", PROSE * 3), ("caps", (PROSE * 3).upper()), ("mixed", PROSE * 3 + "\n- one\n- two\n- three"), ("list", LIST), ("junk", JUNK), ("half", PROSE + "\n" + LIST * 3), ("null", None), ("empty", ""), ("blank", " \n ")]
    rows += [(f"p{k}", PROSE * (k % 4 + 1)) for k in range(40)] + [("list", LIST)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "id string, text string, n_chars int")
    assert {x["id"] for x in quality.no_prose(df.select("id", "text")).collect()} == {"list", "junk", "half"}
    types = {x["id"]: x["text_type"] for x in quality.typed(quality.statistics(df)).collect()}
    assert types["p"] == "prose" and types["null"] == types["empty"] == types["blank"] == "empty"
    assert quality.no_prose(df.select("id", "text").limit(0)).count() == 0


def test_fit_learns_a_poor_function():
    r = np.random.default_rng(0)
    truth = r.random(4000) < 0.3
    good = [np.where(r.random(4000) < 0.95, truth, ~truth).astype(int) for _ in range(3)]
    poor = (r.random(4000) < 0.5).astype(int)
    patterns, counts = np.unique(np.stack([*good, poor], 1), axis=0, return_counts=True)
    prior, table = quality.fit(patterns, counts.astype(float))
    assert abs(prior[1] - 0.3) < 0.05 and table[0, 1, 2] > 0.9 and abs(table[3, 1, 2] - 0.5) < 0.1


def test_residue(spark):
    article = PROSE * 4
    rows = [
        ("n", "ok", article), ("n", "ph", article + " {{ page.title }} more"), ("n", "js", "You need to enable JavaScript to run qwerty."), ("n", "err", "Error 503 on zxcvb. Please try again later."), ("n", "talk", article + " She learned JavaScript and found error 404."),
        ("n", "lorem", "Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod"), ("n", "null", None), ("n", "empty", ""), ("p", "1", "Menu\nAccess denied. Your request ABC12 was blocked.\nFooter"), ("p", "2", "Menu\n" + article + "\nThis site uses cookies. Accept all"),
        ("n", "tag", article + "\n<%= post.author %>"), ("n", "code", article + "\nif (a[3] <= 47) { b(y); }"), ("n", "ph", article + " {{ page.title }} more"),
    ]
    df = spark.createDataFrame(rows, "table_name string, record_id string, text string")
    assert {(x["table_name"], x["record_id"]) for x in residue.residue(df, ("p",)).collect()} == {("n", "ph"), ("n", "js"), ("n", "err"), ("n", "lorem"), ("p", "1"), ("n", "tag")}
    assert residue.residue(df.limit(0)).count() == 0


def test_functions_together_beat_each_alone():
    """Votes of types with known answers: what is learnt from agreement makes fewer errors than any one function, and than a plain majority."""
    r = np.random.default_rng(3)
    truth = r.choice(3, 6000, p=[0.9, 0.06, 0.04])
    right, silent = (0.97, 0.93, 0.9, 0.75, 0.6), (0.05, 0.1, 0.1, 0.3, 0.2)
    given = np.stack([np.where(r.random(6000) < q, -1, np.where(r.random(6000) < p, truth, r.integers(0, 3, 6000))) for p, q in zip(right, silent)], 1)
    patterns, inverse, counts = np.unique(given, axis=0, return_inverse=True, return_counts=True)
    learnt = quality.posteriors(patterns, *quality.fit(patterns, counts.astype(float)))[inverse.ravel()].argmax(1)
    majority = np.stack([(given == t).sum(1) for t in range(3)], 1).argmax(1)
    errors = (learnt != truth).sum()
    assert errors < (majority != truth).sum() and all(errors < (given[:, j] != truth).sum() for j in range(5)) and errors < 120


def test_votes_without_the_definition(spark):
    """No function sees the share of characters in running sentences."""
    df = quality.statistics(spark.createDataFrame([("a", PROSE)], "id string, text string"))
    assert "running_share" not in str([v._jc.toString() for v in quality.votes().values()]).replace("running_word_share", "") and df.select(*quality.votes().values()).count() == 1


def test_residue_needs_its_graph(spark, monkeypatch):
    """Messages in a wording that no pattern fits are found by their likeness to trusted ones; without the links they are lost."""
    shop = "Welcome to the garden shop, which sells pots and seeds all year round.\nHome | About | Contact | Imprint and more\n"
    say = "enable JavaScript to read the article {}lamp on this page and on all the pages of the series that come after it."
    rows = [("n", f"seed{k}", "Please " + say.format(w)) for k, w in enumerate(WORDS[:6])]
    rows += [("p", f"page{k}", shop + "Note, reader: please " + say.format(w) + "\nFooter of the shop, all about pots and seeds") for k, w in enumerate(WORDS[6:14])]
    rows += [("p", "alone", shop + "Sorry, the page tirolamp could not be found.\nFooter of the shop, all about pots and seeds"), ("n", "prose", PROSE * 3), ("p", "talk", shop + "Some sites ask readers to enable JavaScript, which is a nuisance on old machines and slow lines.")]
    df = spark.createDataFrame(rows, "table_name string, record_id string, text string")
    found = {x["record_id"] for x in residue.residue(df, ("p",)).collect()}
    assert found == {f"seed{k}" for k in range(6)} | {f"page{k}" for k in range(8)} | {"alone"}
    trusted = residue.units(df).where("trusted").select("record_id").distinct().collect()
    assert {x["record_id"] for x in trusted} == {f"seed{k}" for k in range(6)}
    monkeypatch.setattr(residue, "linked", lambda nodes: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    assert {x["record_id"] for x in residue.residue(df, ("p",)).collect()} == {f"seed{k}" for k in range(6)} | {"alone"}


def test_residue_spreads_to_near_duplicates(spark):
    found = [(f"Sorry we could not load the {w} page for you so please reload it in a short while or write to us about this", k == 0) for k, w in enumerate(["red"] * 2 + ["lemon", "orange", "purple", "silver"])]
    df = spark.createDataFrame([(" ".join(u.lower().split()), t, False) for u, t in found], "unit string, trusted boolean, strange boolean")
    assert residue.residue_units(df).count() == 5



def test_residue_counts_a_line_as_often_as_it_stands(spark):
    rows = [("n", "thrice", "\n".join(f"Error 503 on zxcvb. Please try again later, ref {k}" for k in range(3))), ("n", "once", PROSE + "\nError 503 on zxcvb. Please try again later, ref 1")]
    df = spark.createDataFrame(rows + rows[1:] * 4, "table_name string, record_id string, text string")
    assert [x["record_id"] for x in residue.residue(df, ("p",)).collect()] == ["thrice"]


def test_residue_of_long_lines(spark):
    long = "Error 503 on zxcvb. The service is unavailable because of maintenance that takes longer than we had hoped. Please try again later or reload the page in a short while. If the error comes up again, write to us and tell us the reference below, the time at which the error came up and the page that was not found."
    rows = [("n", "long", long), ("p", "long", "Menu\n" + long + "\nFooter"), ("n", "prose", "Error 503 on zxcvb. " + PROSE * 3), ("p", "prose", "Error 503 on zxcvb. " + PROSE * 3)]
    df = spark.createDataFrame(rows, "table_name string, record_id string, text string")
    assert {(x["table_name"], x["record_id"]) for x in residue.residue(df, ("p",)).collect()} == {("n", "long"), ("p", "long")}


def test_alike_pairs_are_all_found(spark):
    r = random.Random(12)
    rows = []
    for _ in range(40):
        w = [r.choice(WORDS) for _ in range(r.randint(3, 44))]
        for k in range(6):
            v = list(w)
            for _ in range(k and r.randint(1, 2)):
                at = r.choice([0, len(v) - 1, r.randrange(len(v))])
                v[at : at + 1] = r.choice([[], [r.choice(WORDS)], [v[at], r.choice(WORDS)]])
            rows.append(" ".join(v))
    rows = sorted({x for x in rows if x})
    of = {x: frozenset(tuple(x.split()[i : i + 5]) for i in range(max(1, len(x.split()) - 4))) for x in rows}
    expected = {(a, b) for a in rows for b in rows if a < b and len(of[a] & of[b]) * 5 >= len(of[a] | of[b]) * 4}
    nodes = residue._shingled(spark.createDataFrame([(x, False) for x in rows], "masked string, trusted boolean"))
    name = {x["node"]: x["masked"] for x in nodes.collect()}
    out = residue.alike(nodes).collect()
    assert len(expected) > 50 and {tuple(sorted((name[x["a"]], name[x["b"]]))) for x in out} == expected and len(out) == len(expected)
    few = [tuple(sorted((name[x["a"]], name[x["b"]]))) for x in residue.linked(nodes).collect()]
    assert set(few) <= expected and classes(few) == classes(expected)


def classes(pairs):
    of = {}
    for a, b in pairs:
        both = of.get(a, {a}) | of.get(b, {b})
        for x in both:
            of[x] = both
    return {frozenset(c) for c in of.values()}


def test_large_class_of_alike_units_has_few_links(spark):
    stem = [f"word{k}" for k in range(120)]
    rows = [(" ".join([*stem[: k % 120], f"odd{k}", *stem[k % 120 :]]), k == 0) for k in range(300)]
    nodes = residue._shingled(spark.createDataFrame(rows, "masked string, trusted boolean"))
    pairs = [(x["a"], x["b"]) for x in residue.linked(nodes).collect()]
    assert len({n for c in classes(pairs) for n in c}) == 300 and len(classes(pairs)) == 1 and len(pairs) < 300 * 20


def test_residue_spreads_over_names_met_often(spark):
    units_ = [(f"sorry we could not load the {WORDS[k % 20]}{'abc'[k % 3]} page of {WORDS[k // 20]}{'xy'[k % 2]} for you so please reload it", k == 0, False) for k in range(400)]
    assert residue.residue_units(spark.createDataFrame(units_, "unit string, trusted boolean, strange boolean")).count() == 400


# --- 4 -------------------------------------------------------------------------------------------------------------

HTML = """<html><head><title>Heading of the day - Site</title></head><body><div class="x"><div><a href="/a">Home</a></div><div><a href="/b">Contact</a></div></div>
<div class="y"><h1>Heading of the day</h1><div>By the Site desk, 3 May 2022</div><p>A first paragraph about the river and its <a href="/r">banks</a>, long enough to be one.</p><h2>Tools</h2><p>A second paragraph that tells of the tools and of how they are used.</p><li>3 small stones</li></div>
<div class="z"><div><a href="/m">Most read</a></div><div><a href="/1">1 Another heading of some day</a></div></div><div><div>© 2022 Site</div><div>Terms Privacy</div></div></body></html>"""
CONTENT = "Home\nHeading of the day\nBy the Site desk, 3 May 2022\nA first paragraph about the river and its banks, long enough to be one.\nTools\nA second paragraph that tells of the tools and of how they are used.\n3 small stones\nMost read\n1 Another heading of some day\n© 2022 Site\nTerms Privacy"


def test_parse():
    found, title = blocks.parse("<title>T &amp; U</title><p>a <b>b</b> <a href=x>cd</a></p><script>no</script><ul><li>x<li>y</ul>tail<br>more")
    assert title == "T & U" and [(b[0], b[1]) for b in found] == [("a b cd", "p"), ("x", "li"), ("y", "li"), ("tail", "body"), ("more", "body")] and found[0][3] == 2


def test_line_labels(spark):
    f = spark.createDataFrame([(1, HTML, "2024-01-02"), (1, HTML, "2024-01-01"), (3, None, "2024-01-01"), (4, "<p>", None)], "page_id long, content string, s string").withColumn("fetched_at", F.col("s").cast("timestamp"))
    e = spark.createDataFrame([(1, CONTENT), (1, CONTENT), (2, "A lone sentence about a river and nothing else in all the world."), (3, None), (4, "")], "page_id long, content string")
    out = blocks.labelled_lines(f, e).collect()
    assert sorted(x["line_no"] for x in out if x["page_id"] == 1 and not x["main"]) == [1, 3, 8, 9, 10, 11]
    assert sum(x["page_id"] == 1 for x in out) == 11 and sum(x["page_id"] == 2 for x in out) == 1 and not [x for x in out if x["page_id"] == 4 and x["main"]]
    text = {x["page_id"]: x["main_text"] for x in blocks.main_text(f, e).collect()}
    assert text[1].startswith("Heading of the day\nA first") and text[1].endswith("3 small stones")
    assert blocks.labelled_lines(f, e.limit(0)).count() == 0 and blocks.labelled_lines(f.limit(0), e).count() == 13


def test_tree():
    r = np.random.default_rng(3)
    x = r.random((500, 4))
    y = ((x[:, 1] > 0.4) & (x[:, 3] < 0.7)).astype(float)
    assert ((blocks.judge(blocks.grow(x, y), x) >= 0.5) == y.astype(bool)).mean() > 0.98
    data = blocks.trained()
    assert len(data) > 3


# --- 6 -------------------------------------------------------------------------------------------------------------


def test_model_on_held_out_sentences():
    words = pii_examples.ordinary()
    weights = pii._trained(words)
    held = pii_examples.examples(seed=77, rounds=1)
    right = found = true = 0
    for text, gold in held:
        out = set(pii.decode(pii._candidates(text, words), weights))
        right, found, true = right + len(out & set(gold)), found + len(out), true + len(gold)
    assert right / found > 0.95 and right / true > 0.95


def test_decode_takes_the_best_set():
    weights = {"a": 2.0, "b": 1.5, "c": 1.2, "d": -1.0}
    found = [(0, 10, "x", ["a"]), (0, 4, "x", ["b"]), (5, 10, "y", ["c"]), (20, 22, "z", ["d"])]
    assert pii.decode(found, weights) == [(0, 4, "x"), (5, 10, "y")]


def test_spans_and_masked(spark):
    rows = [(1, "Call 0812-0001-3876 or mail a.b@c.example now"), (2, None), (3, ""), (4, "Nothing here."), (5, "Thanks to Marla Hidayat for it! Ship it to 12 Gozert Street, Maling please.")]
    df = spark.createDataFrame([(*x, "k") for x in rows], "id long, text string, masked_text string")
    out = {(x["id"], x["pii_type"], x["start_pos"]) for x in pii.spans(df).collect()}
    assert out == {(1, "phone", 6), (1, "email", 29), (5, "person_name", 11), (5, "address", 44)}
    texts = {x["id"]: x["masked_text"] for x in pii.masked(df).collect()}
    assert texts[1] == "Call [PHONE] or mail [EMAIL] now" and texts[2] is None and texts[3] == "" and texts[4] == "Nothing here."
    assert texts[5] == "Thanks to [PERSON_NAME] for it! Ship it to [ADDRESS] please."
    assert pii.spans(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["José Ángel Núñez", "Maria Clara Dewi Ratna Santoso", "Łukasz Żółtowski", "Ганна Шевченко"])
def test_names_of_many_parts_and_letters(name):
    known = pii_examples.ordinary()
    text = f"Please ask for {name} when you call."
    assert [(text[a:e], kind) for a, e, kind in pii.decode(pii._candidates(text, known), pii._trained(known))] == [(name, "person_name")]


def test_vocabulary_is_of_all_texts(spark):
    few = spark.range(0, 20_100, 1, 4).select(F.lit("stir the soup").alias("text"))
    late = spark.createDataFrame([("then ladle it gently with Orrin and orrin",)] * 5, "text string")
    words = pii.fit_vocabulary(few.union(late))
    assert {"soup", "gently", "ladle"} <= words and "orrin" not in words
    assert pii.fit_vocabulary(late.union(few)) == words and pii.fit_vocabulary(few.limit(0)) == frozenset()


def test_vocabulary_goes_by_share(spark):
    many = spark.range(0, 100, 1, 4).select(F.repeat(F.lit("soup "), 20_000).alias("text"))
    late = spark.createDataFrame([("soup by marla",)] * 3, "text string")
    assert pii.fit_vocabulary(many.union(late)) == {"soup"} and "marla" in pii.fit_vocabulary(late)


# --- 1 -------------------------------------------------------------------------------------------------------------


def entries(seed=4, n=240):
    r = random.Random(seed)
    terms = {s: [f"{s}{w}" for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()] for s in ("stars", "boats", "cakes")}
    plain = [f"plain{w}" for w in "one two three four five six seven eight".split()]
    rows, truth = [], {}
    for k in range(n):
        main, other = r.sample(list(terms), 2)
        part = r.choice([0, 0, 1, 4])
        body = [" ".join(r.sample(terms[main], 3) + r.sample(plain, 4)) + "." for _ in range(10 - part)] + [" ".join(r.sample(terms[other], 3) + r.sample(plain, 4)) + "." for _ in range(part)]
        r.shuffle(body)
        rows.append((f"e{k}", r.choice([" ", "\n"]).join(body)))
        truth[f"e{k}"] = {main} | ({other} if part >= 3 else set())
    return rows, truth


@pytest.mark.parametrize("most", [topics.MAX_TERMS, 3])
def test_subjects(spark, monkeypatch, most):
    rows, truth = entries()
    labels = [(i, s) for i in list(truth)[:40] for s in truth[i]] + [("gone", "stars"), ("e1", "unknown"), (None, "stars"), ("e2", None)]
    e = spark.createDataFrame([*rows, ("null", None), ("empty", ""), ("other", "nothing known at all."), ("e0", rows[0][1])], "id string, text string")
    lab, areas = spark.createDataFrame(labels, "id string, subject string"), spark.createDataFrame([("stars", "d"), ("boats", "d"), ("cakes", None)], "subject string, description string")
    monkeypatch.setattr(topics, "MAX_TERMS", most)
    out = {}
    for x in topics.subjects_of(e, lab, areas).collect():
        out.setdefault(x["id"], set()).add(x["subject"])
    right = sum(out.get(i) == s for i, s in truth.items())
    assert right >= 0.97 * len(truth) and not {"null", "empty", "other"} & set(out)


def test_labels_are_kept_and_groups_help(spark):
    """With a label per subject only, documents of a coarse group pass the subject on; labels stay even where the text says nothing."""
    rows, truth = entries()
    few = {}
    for i, t in truth.items():
        for s in t:
            few.setdefault(s, i) if len(t) == 1 else None
    labels = [(i, s) for s, i in few.items()] + [("quiet", "boats")]
    single = {i: next(iter(t)) for i, t in truth.items() if len(t) == 1}
    groups = [(i, f"group of {s}") for i, s in single.items()] + [("gone", "x"), (None, "x"), ("e1", None), ("e1", "")]
    e = spark.createDataFrame([*rows, ("quiet", "nothing known at all.")], "id string, text string")
    lab, areas, by = (spark.createDataFrame(x, k) for x, k in ((labels * 2, "id string, subject string"), ([("stars",), ("boats",), ("cakes",)], "subject string"), (groups, "id string, topic string")))
    again = spark.createDataFrame([(f"g{k}-{s}", rows[[r[0] for r in rows].index(i)][1] + f" again{k}") for s, i in few.items() for k in range(3)], "id string, text string")
    more = lab.union(spark.createDataFrame([(f"g{k}-{s}", s) for s in few for k in range(3)], lab.schema))
    by = by.union(spark.createDataFrame([(f"g{k}-{s}", f"group of {s}") for s in few for k in range(3)], by.schema))

    def right(**more_args):
        out = {}
        for x in topics.subjects_of(e.union(again), more, areas, **more_args).collect():
            out.setdefault(x["id"], set()).add(x["subject"])
        assert all(s in out[i] for i, s in labels)
        return sum(out.get(i) == truth[i] for i in truth)

    assert right(groups=by) >= 0.95 * len(truth) and right(groups=by) >= right()


def test_subjects_of_nothing(spark):
    rows, _ = entries(n=5)
    e = spark.createDataFrame(rows, "id string, text string")
    lab, areas = spark.createDataFrame([], "id string, subject string"), spark.createDataFrame([("stars",)], "subject string")
    assert topics.subjects_of(e, lab, areas).count() == 0
    assert topics.subjects_of(e, lab, areas.limit(0)).count() == 0
    assert topics.subjects_of(e.limit(0), lab, areas).count() == 0
