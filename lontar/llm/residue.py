"""Problem 5: template residue and error-page text.

Method: each line that could be residue (it has a word of error pages, filler
or demands for scripts) becomes a unit; names and numbers in it, words that few
units have, are masked. Masked units that are near-duplicates, pairs of five-word
shingle similarity 0.8 or more, are all found: two such units share one of the
rarest fifth of their shingles, so they meet in a join on those. They are joined
into connected components. Only a few units are trusted: those of strict
patterns of such messages that make up at least half of their record. Their
label then holds for all of their component, wherever else its units stand, in
whatever wording that is still alike, as in pages among menus and notices. A
component without a trusted unit is residue only if all of its units fit a strict
pattern (a message that nothing else is like).
Placeholders are found by their form.

SimHash tables of 3 bits find 26 of 183 such pairs of a fixture, and 60 tables
of 16 bits would be needed for nearly all, so units meet on rare shingles
instead, which finds all.

A record is residue if it has a placeholder, or if its content is residue: in
pages any line that is as a whole a residue unit (a real article never has one),
in articles units that make up at least half of the characters.

Defined results: null and empty texts are no cases; a record that appears
several times is a case if any of its rows is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import WORD, cut, sized
from lontar.operators.dedup import components

#: Forms of unfilled placeholders in template languages.
PLACEHOLDER = re.compile(
    r"\{\{[#/^&>!]?\s*[A-Za-z_][\w.|:\s\"'()-]{0,80}\}\}|\{%-?\s*[A-Za-z_][^%{}\n]{0,120}-?%\}|<%[=@#-]?\s*[A-Za-z_][^%\n]{0,120}%>|<\?(?:php|=)\s?[^?\n]{0,120}\?>"
    r"|[$#]\{\s*[A-Za-z_][\w.]{0,60}\s*\}|\[\[\s*[A-Za-z_][\w. -]{0,60}\]\]|(?<![\w%])%[A-Z][A-Z0-9_]{2,40}%(?![\w%])|(?<!\w)__[A-Z][A-Z0-9_]{1,40}?__(?!\w)"
    r"|(?<![\w\[])\[?[A-Z][A-Z0-9_]*_GOES_HERE\]?|\[(?:[Ii][Nn][Ss][Ee][Rr][Tt]|TODO|TBD|[Yy][Oo][Uu][Rr]|[Ss][Ii][Ss][Ii][Pp][Kk][Aa][Nn])\b[^\]\n]{0,60}\]|@@[A-Za-z_][\w.]{0,40}@@|(?<![\w({\[])\{\d{1,2}\}(?![\w)}\]])"
)
#: Words that make a line worth looking at, from a word's start; nothing is decided by them.
_CUES = (
    "galat:", "galat 4", "galat 5", "javascript", "script ", "scripts", "script.", "script,", "skrip", "cookie", "kuki", "lorem", "ipsum", "dummy", "placeholder", "not found",
    "not be found", "no longer", "ditemukan", "dihapus", "access denied", "ditolak", "blocked", "diblokir", "forbidden", "unauthorized", "unauthorised", "maintenance", "perbaikan",
    "too many", "terlalu banyak permintaan", "reload", "muat ulang", "unavailable", "tidak tersedia", "timed out", "timeout", "captcha", "loading", "memuat", "oops", "ups!", "hiccup",
    "beberapa saat", "try again", "coba lagi", "reference", "rujukan", "ticket", "exception", "rendering", "checking your", "memeriksa peramban", "400", "401", "403", "404", "408", "410",
    "429", "500", "502", "503", "504", "error",
)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for w in _CUES:
        found.add_word(w, len(w))
    found.make_automaton()
    return found


def _cued_lines(text: str) -> set[int]:
    """Numbers of the lines that have a cue."""
    low = text.lower()
    hits = [end for end, n in _automaton().iter(low) if end < n or not low[end - n].isalpha()]
    if not hits:
        return set()
    breaks = [k for k, c in enumerate(low) if c == "\n"]
    return {bisect_left(breaks, end) for end in hits}


#: A placeholder has one of these.
_MARKS = ("{", "<%", "<?", "[[", "@@", "__", "_GOES_HERE", "%", "[i", "[I", "[T", "[y", "[Y", "[s", "[S")


#: Messages that are residue beyond doubt when they make up a line.
_TRUSTED = [re.compile(p, re.I) for p in (
    r"^(?:please |harap |mohon |silakan )?(?:you (?:need|have) to |you must |kindly )?(?:enable|turn on|turn|activate|allow|aktifkan|nyalakan|hidupkan)\b.{0,20}\b(?:javascript|scripts?|skrip|cookies|kuki)\b",
    r"^(?:your|this|peramban|browser)\b.{0,20}\b(?:does not|doesn't|do not|tidak)\b.{0,12}\b(?:run|support|mendukung|menjalankan)\b.{0,10}\b(?:javascript|scripts?|skrip)\b",
    r"^(?:this|the|situs|halaman|laman)\b.{0,12}\b(?:site|page|app|ini)?.{0,6}\b(?:requires?|needs?|memerlukan|membutuhkan)\b.{0,14}\b(?:javascript|scripts?|skrip|cookies|kuki)\b",
    r"^(?:loading|memuat)\b.{0,40}\b(?:scripts?|skrip|javascript|cookies|kuki)\b",
    r"^(?:checking|verifying|memeriksa)\b.{0,12}\b(?:your|anda|peramban)\b",
    r"^(?:http )?(?:error|galat|kesalahan)\s*:?\s*[45]\d\d\b", r"^[45]\d\d\s*[-:–|]\s*\w", r"^(?:fatal|internal|server|database)\s+(?:server\s+)?error\b.{0,40}(?:while|rendering|exception|module|occurred|$)",
    r"^(?:sorry|maaf)\b[, ].{0,70}\b(?:not be found|not found|tidak ditemukan)\b",
    r"^(?:access|akses)\s+(?:denied|ditolak)\b\s*[.!:-]", r"^(?:the |halaman |page |laman )?(?:page|halaman|laman)?\s*/?\S*\s*(?:was |could |can )?(?:not be found|cannot be found|not found|tidak ditemukan|tidak dapat ditemukan)\b",
    r"^(?:oops|ups|whoops|maaf|sorry)\b[,!. ].{0,60}(?:no longer|moved|removed|deleted|never existed|not exist|dihapus|tidak pernah ada|tidak ada|perbaikan|gangguan|unavailable|wrong)",
    r"^(?:we are|we're|the site is|situs|layanan|this site is)\b.{0,20}\b(?:down|maintenance|perbaikan|pemeliharaan)\b", r"^(?:too many requests|terlalu banyak permintaan)\b",
    r"^(?:service|layanan)\b.{0,12}\b(?:unavailable|tidak tersedia)\b",
)]
#: Lines that only go with a message.
_ATTACHED = re.compile(r"^(?:reference|ref|ticket|incident|request id|kode rujukan|kode|tiket|rujukan)\b[\s:#.]*\S{4,40}$", re.I)
#: Words of filler text (fixed values).
_FILLER = frozenset("lorem ipsum dolor amet sit consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua".split())
_REPEATED = frozenset("contoh sampel konten isi teks dummy sample content text here filler placeholder kalimat paragraf".split())
#: Share of its record from which a unit of a strict pattern is trusted.
SEED_SHARE = 0.5
#: A longer line is a unit like any other, but a pattern, which looks at its start, is trusted only if half of its characters are in sentences with a cue.
UNIT_WORDS = 45
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


#: Small words, one of which nearly every real line of some length has.
_SMALL = (" the ", " a ", " and ", " of ", " to ", " in ", " is ", " yang ", " dan ", " di ", " dari ", " untuk ", " dengan ", " ke ", " pada ", ",", ";", "|", "\t", "=")


def _strange(line: str) -> bool:
    """A sentence-like line of some length without any small word or comma."""
    return len(line) > 60 and line[-1] in ".!?" and "," not in line and not any(map(line.lower().__contains__, _SMALL))


def _filler(words: list[str], strange: bool = False) -> bool:
    """Whether the words of a line are filler: stock Latin, a few stock words over and over, or a strange line that repeats its words."""
    n = len(words)
    if n < 6:
        return False
    if strange and n >= 12 and len(set(words)) <= 0.85 * n and not any(w.isdigit() for w in words):
        return True
    latin, stock = sum(w in _FILLER for w in words), sum(w in _REPEATED for w in words)
    return len({w for w in words if w in _FILLER}) >= 2 and latin >= 0.08 * n and "the" not in words and "yang" not in words or stock >= 0.6 * n and len(set(words)) <= 0.7 * n


def trusted(line: str, long: bool = False) -> bool:
    return any(p.search(line) for p in _TRUSTED) and (not long or _mostly_cued(line))


def _mostly_cued(line: str) -> bool:
    parts = _SENTENCE.split(line)
    return 2 * sum(len(s) for s in parts if _cued_lines(s)) >= sum(map(len, parts))


def units(texts: DataFrame) -> DataFrame:
    """``texts`` (keys and ``text``) as ``keys, placeholder, unit, trusted, fits (a strict pattern), strange, share``: a row per different line to look at, and one without unit per record with a placeholder."""
    import pyarrow as pa

    keep = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows, places, found, sure, like, odd, shares = [], [], [], [], [], [], []

            def add(row: int, place: bool, unit: str | None, label: bool, fits: bool, strange: bool, share: float) -> None:
                rows.append(row), places.append(place), found.append(unit), sure.append(label), like.append(fits), odd.append(strange), shares.append(share)

            for k, text in enumerate(b.column(len(keep)).to_pylist()):
                if not text:
                    continue
                if any(map(text.__contains__, _MARKS)) and PLACEHOLDER.search(text):
                    add(k, True, None, False, False, False, 0.0)
                cued = _cued_lines(text)
                raw = text.split("\n")
                looked = [(i, line) for i, line in enumerate(map(str.strip, raw)) if line and (i in cued or _strange(line))]
                if not looked:
                    continue
                total = max(1, sum(len(s.strip()) for s in raw))
                own: dict[str, list] = {}  # a line that stands several times counts each time
                for i, line in looked:
                    words = WORD.findall(line.lower())
                    strange = _strange(line)
                    label = _filler(words, strange)
                    size = len(line)
                    if i + 1 < len(raw) and _ATTACHED.search(raw[i + 1].strip()):
                        size += len(raw[i + 1].strip())
                    unit = own.setdefault(" ".join("0" if any(c.isdigit() for c in w) else w for w in words), [False, False, False, 0.0])
                    unit[:] = unit[0] or label, unit[1] or trusted(line, len(words) > UNIT_WORDS), unit[2] or strange, unit[3] + size / total
                for unit, (filler, fits, odd_, share) in own.items():
                    add(k, False, unit, filler or (fits and share >= SEED_SHARE), fits, odd_, share)
            at = pa.array(rows, pa.int64())
            cols = [pa.array(places, pa.bool_()), pa.array(found, pa.string()), pa.array(sure, pa.bool_()), pa.array(like, pa.bool_()), pa.array(odd, pa.bool_()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(len(keep))), *cols], [*keep, "placeholder", "unit", "trusted", "fits", "strange", "share"])

    schema = ", ".join([f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep] + ["placeholder boolean", "unit string", "trusted boolean", "fits boolean", "strange boolean", "share double"])
    return texts.select(*keep, "text").mapInArrow(run, schema)


def _masked(distinct: DataFrame, least: int = 3, rare: float = 0.05) -> DataFrame:
    """``unit, masked, trusted``: words that fewer than ``least`` different units have, or ``rare`` times as many as have the middle word of the unit, have become ``*``."""
    numbered = distinct.withColumn("no", F.xxhash64("unit"))
    words = numbered.select("no", F.posexplode(F.split("unit", " ")).alias("at", "word"))
    often = words.select("no", "word").distinct().groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counted = words.join(often, "word", "left").select("no", F.coalesce("n", F.lit(0)).alias("n"), "at", "word")
    # The bound grows with the units: a name of a list comes up in any number of them, if there are enough.
    known = counted.groupBy("no").agg(F.median("n").alias("middle"), F.collect_list(F.struct("at", "word", "n")).alias("s"))
    kept = F.transform(F.array_sort("s"), lambda s: F.when(s["n"] >= F.greatest(F.lit(float(least)), rare * F.col("middle")), s["word"]).otherwise("*"))
    text = known.select("no", F.array_join(kept, " ").alias("masked"))
    # A unit of mostly rare words is told by its own words: else any two such units would look alike.
    stars = F.size(F.filter(F.split("masked", " "), lambda w: w == "*"))
    return numbered.join(text, "no").drop("no").withColumn("masked", F.when(stars > 0.4 * F.size(F.split("masked", " ")), F.col("unit")).otherwise(F.col("masked")))


def _shingled(classes: DataFrame) -> DataFrame:
    """``masked, trusted`` with ``node`` and ``shingles`` (hashes of five-word shingles)."""
    w = F.split("masked", " ")
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 4)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, 5), " ")))
    kept = [c for c in ("masked", "trusted", "fits") if c in classes.columns]
    return classes.select(*kept, F.xxhash64("masked").alias("node"), F.array_distinct(shingles).alias("shingles"))


def _first_shingles(nodes: DataFrame) -> DataFrame:
    """``node, key``: of each one's shingles, the rarest first, the first fifth (and one) that other nodes have, too."""
    each = nodes.select("node", F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    ranked = each.join(counts, "shingle", "left").groupBy("node").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("s"))
    first = ranked.select("node", F.explode(F.expr("slice(s, 1, size(s) - (4 * size(s) + 4) div 5 + 1)")).alias("x"))
    return first.where("x.n > 1").select("node", F.col("x.shingle").alias("key"))


def linked(nodes: DataFrame) -> DataFrame:
    """``a, b``: as many of the pairs of ``alike`` as connect what all of them connect.

    The nodes of a key come one after the other. Each is compared with those of
    the key that it isn't connected with yet, so a class of very many alike ones
    costs one comparison each and gives one pair each, not all pairs.
    """
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        key, classes = None, []  # of the key: classes of connected nodes, each a list of (node, shingles)
        for b in batches:
            left, right = [], []
            for k, node, shingles in zip(*(b.column(j).to_pylist() for j in range(3))):
                if k != key:
                    key, classes = k, []
                mine, met, rest = frozenset(shingles), [], []
                for members in classes:
                    other = next((n for n, own in members if 9 * len(mine & own) >= 4 * (len(mine) + len(own))), None)
                    if other is None:
                        rest.append(members)
                    else:
                        met.append(members)
                        left.append(node), right.append(other)
                classes = [*rest, [(node, mine), *(m for members in met for m in members)]]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    keyed = _first_shingles(nodes).join(nodes.select("node", "shingles"), "node").select("key", "node", "shingles")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint").distinct()


def alike(nodes: DataFrame) -> DataFrame:
    """``a, b``, a < b: all pairs of ``node, shingles`` of similarity 0.8 or more.

    Such a pair has four fifths of either's shingles in common. With each one's
    shingles put in one order, the rarest first, one of them is among the first
    fifth (and one) of both.
    """
    left = cut(_first_shingles(nodes))
    met = cut(left.join(left.withColumnRenamed("node", "b"), "key").where("node < b").select("node", "b").distinct())
    known = nodes.select("node", "shingles")
    both = met.join(known, "node").join(known.toDF("b", "shingles_b"), "b")
    same = 9 * F.size(F.array_intersect("shingles", "shingles_b")) >= 4 * (F.size("shingles") + F.size("shingles_b"))
    return both.where(same).select(F.col("node").alias("a"), "b")


def _same_filler(distinct: DataFrame) -> DataFrame:
    """``unit``: strange lines (no small words) of whose words three in ten are words of trusted filler."""
    words = distinct.where("strange").select(F.xxhash64("unit").alias("no"), "unit", "trusted", F.explode(F.split("unit", " ")).alias("word"))
    stock = words.where("trusted").select("no", "word").distinct().groupBy("word").count().where("count > 2").select("word", F.lit(1).alias("stock"))
    rated = words.where("NOT trusted").join(stock, "word", "left").groupBy("no").agg(F.avg(F.coalesce("stock", F.lit(0))).alias("share"), F.first("unit").alias("unit"))
    return rated.where("share >= 0.3").select("unit")


def residue_units(found: DataFrame) -> DataFrame:
    """``unit``: units (column ``unit`` of ``found``, with ``trusted``, ``fits`` and ``strange``) whose component has a trusted one or consists of units of strict patterns, or that are of the same filler."""
    fits = F.col("fits") if "fits" in found.columns else F.col("trusted")
    distinct = cut(found.where("unit IS NOT NULL").groupBy("unit").agg(F.max("trusted").alias("trusted"), F.max(fits).alias("fits"), F.max("strange").alias("strange")))
    masked = cut(_masked(distinct))
    nodes = cut(_shingled(masked.groupBy("masked").agg(F.max("trusted").alias("trusted"), F.min("fits").alias("fits"))))
    parts = components(linked(nodes))
    labelled = nodes.join(parts, "node", "left").select("masked", "trusted", "fits", F.coalesce("component", "node").alias("component"))
    sure = labelled.groupBy("component").agg((F.max("trusted") | F.min("fits")).alias("residue")).where("residue")
    near = masked.join(labelled.join(sure, "component", "left_semi").select("masked"), "masked", "left_semi").select("unit")
    return near.union(_same_filler(distinct))


def residue(texts: DataFrame, page_tables: tuple[str, ...] = ("extracted_content",)) -> DataFrame:
    """Distinct ``table_name, record_id`` of residue in ``texts`` (``table_name, record_id, text``)."""
    found = cut(units(texts.select("table_name", "record_id", "text")))
    placed = found.where("placeholder").select("table_name", "record_id")
    bad = found.where("unit IS NOT NULL").join(sized(cut(residue_units(found).distinct())), "unit", "left_semi")  # one message may be in a third of all records
    # Rows of one record that are repeated count their shares once.
    lines = bad.groupBy("table_name", "record_id", "unit").agg(F.max("share").alias("share")).groupBy("table_name", "record_id").agg(F.sum("share").alias("share"))
    held = lines.where(F.col("table_name").isin(*page_tables) | (F.col("share") >= 0.5)).select("table_name", "record_id")
    return placed.union(held).distinct()


def without(df: DataFrame, cases: DataFrame, key: str, table_name: str) -> DataFrame:
    """``df`` without the records that are cases."""
    ids = cases.where(F.col("table_name") == table_name).select(F.col("record_id").alias("_case")).distinct()
    return df.join(ids, F.col(key).cast("string") == F.col("_case"), "left_anti")
