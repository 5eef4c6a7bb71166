"""Problem 10: long exact spans shared between records.

Method: relative Lempel-Ziv parsing. Reference blocks are found for each text
by a shared-block index: of every text the hashes of some of its ``BLOCK``-
character windows are kept, chosen as the smallest in each run of ``RUN``
windows, so that any two texts with an identical stretch of ``BLOCK + RUN - 1``
characters keep one and the same window of it (the density is 2 / RUN, the
index about 1.7 % of the characters). A text is then factored greedily against
every text of the index that shares a block: at each place the longest factor
is taken, factors are grown over the boundary to the left of the place where
the parse met them, and a factor of ``min_chars`` or more characters is a
duplicate span. Every factor is compared character by character.

Texts that are equal as a whole are one class (told by half of their SHA-256),
parsed once; the index knows a text by a 64-bit hash, and whatever two texts
might share one is told apart when factors are compared. Blocks that occur
in exactly the same classes are one key, so a passage of many blocks gives each
pair once, and hot keys are spread by salts.

Defined results: null texts and texts under ``min_chars`` share nothing; rows
that are repeated with the same ``doc_id`` are one document; characters are
Unicode code points, white space and case included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import cut, sized

#: Default length of a shared stretch.
MIN_CHARS = 240
#: Windows hashed at once in a Python worker; 8 arrays of 8 bytes each.
CHUNK = 2_000_000
#: Keys with more members than this are spread over as many salts as it takes.
HOT = 2_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_NONE = np.uint64(2**64 - 1)


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all windows of ``width`` code points."""
    n = len(codes)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, _BASE, np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power)))
        del power
        h = (total[width:] - total[:-width]) * np.cumprod(np.full(n - width + 1, _INVERSE, np.uint64))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each run of ``width``, in a few passes at any width."""
    m = len(values)
    x = np.concatenate((values, np.full(-m % width, _NONE, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(x, 1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: m - width + 1], ahead[width - 1 : m])


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _anchors(texts: list[str], block: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of each kept window. Every text has at least ``block + run - 1`` characters."""
    lengths = np.array([len(t) for t in texts])
    h = window_hashes(codes_of("\0".join(texts) + "\0"), block)
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    last = np.repeat(np.cumsum(lengths + 1) - 1 - block, lengths + 1)  # last window within the text
    smallest = sliding_min(h, run)
    at = np.arange(len(smallest))
    inside = at + run - 1 <= last[: len(smallest)]
    t, v = text[: len(smallest)][inside], smallest[inside]
    fresh = np.concatenate(([True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])))
    return t[fresh], v[fresh]


def _block_index(docs: DataFrame, min_chars: int) -> DataFrame:
    """``cls, block``: 64-bit hash of the text and hashes of its kept windows."""
    import pyarrow as pa

    block = max(1, min_chars // 2)
    run = min_chars - block + 1

    def run_batches(batches: Iterator) -> Iterator:
        def emit(keys: list, texts: list[str]):
            t, v = _anchors(texts, block, run)
            return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.int64)[t]), pa.array(v.view(np.int64))], ["cls", "block"])

        for b in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # A very long text goes in pieces that overlap by a stretch less one character: no stretch is lost.
                for k in range(0, max(1, len(text) - min_chars + 1), CHUNK):
                    piece = text[k : k + CHUNK + min_chars - 1]
                    keys.append(key), texts.append(piece)
                    size += len(piece)
                    if size > CHUNK:
                        yield emit(keys, texts)
                        keys, texts, size = [], [], 0
            if keys:
                yield emit(keys, texts)

    return docs.select(F.xxhash64("text").alias("cls"), "text").mapInArrow(run_batches, "cls bigint, block bigint")


def factors(text: str, reference: str, min_chars: int) -> list[tuple[int, int, int]]:
    """Greedy parse of ``text`` against ``reference``: ``(start, reference start, length)`` of factors of ``min_chars`` or more.

    The parse goes on behind a factor, but a window within it that meets the
    reference elsewhere, and there goes on beyond the factor's end, is one too.
    """
    if len(text) < min_chars or len(reference) < min_chars:
        return []
    width = max(1, (min_chars + 1) // 2)
    a, b = codes_of(reference), codes_of(text)
    grid = window_hashes(a, width)[::width]  # any stretch of 2 * width - 1 characters holds a whole cell of the grid
    order = np.argsort(grid, kind="stable")
    cells = grid[order]
    rolling = window_hashes(b, width)
    lo, hi = np.searchsorted(cells, rolling, "left"), np.searchsorted(cells, rolling, "right")
    found, end, shift = [], 0, None
    for i in np.flatnonzero(hi > lo):
        within = i + width <= end
        best = (0, 0, 0)
        for k in range(lo[i], hi[i]):
            j = int(order[k]) * width
            if within and i - j == shift or not np.array_equal(a[j : j + width], b[i : i + width]):
                continue
            m = min(len(a) - j, len(b) - i)
            miss = np.flatnonzero(a[j : j + m] != b[i : i + m])
            right = int(miss[0]) if len(miss) else m
            m = min(j, i)
            miss = np.flatnonzero(a[j - m : j][::-1] != b[i - m : i][::-1])
            left = int(miss[0]) if len(miss) else m
            if left + right > best[2]:
                best = (int(i) - left, j - left, left + right)
        if best[2] >= min_chars and best[0] + best[2] > end:
            found.append(best)
            end, shift = best[0] + best[2], best[0] - best[1]
    return found


def _candidates(index: DataFrame) -> DataFrame:
    """``cls_a < cls_b`` (64-bit hashes) that keep a common window."""
    members = cut(index.distinct())
    keys = (
        members.groupBy("block").agg(F.count("*").alias("n"), F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(7), "cls")).alias("s2"))
        .where("n > 1").groupBy("n", "s1", "s2").agg(F.min("block").alias("block"))
    )
    salts = F.ceil(F.col("n") / HOT).cast("int")
    left = cut(members.join(sized(cut(keys.select("block", salts.alias("salts")))), "block"))
    one = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("block", "salt", F.col("cls").alias("cls_a"))
    two = left.select("block", F.pmod(F.hash("cls"), F.col("salts")).alias("salt"), F.col("cls").alias("cls_b"))
    return one.join(two.hint("merge"), ["block", "salt"]).where("cls_a < cls_b").select("cls_a", "cls_b").distinct()


def shared_factors(docs: DataFrame, min_chars: int = MIN_CHARS, both_ways: bool = False) -> tuple[DataFrame, DataFrame]:
    """Members and factors.

    Members: ``doc_id, cls``, of texts of ``min_chars`` or more. Factors, of
    pairs of different texts: ``cls_a, cls_b, start_a, start_b, length``. A pair
    is parsed in one direction, which tells whether there is any; ``both_ways``
    parses each text of it against the other, for all places of both.
    """
    import pyarrow as pa

    long = docs.select("doc_id", "text").where(F.length("text") >= min_chars).withColumn("cls", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    members = cut(long.select("doc_id", "cls").distinct())
    pairs = cut(_candidates(_block_index(long, min_chars)))
    wanted = cut(pairs.select(F.col("cls_a").alias("h")).union(pairs.select(F.col("cls_b").alias("h"))).distinct())
    # One text per class; all others stay where they are if the wanted ones are few enough to be told to every executor.
    texts = cut(long.select(F.xxhash64("text").alias("h"), "cls", "text").join(sized(wanted), "h", "left_semi").dropDuplicates(["cls"]))
    one = lambda x: texts.select(F.col("h").alias(f"h_{x}"), F.col("cls").alias(f"cls_{x}"), F.col("text").alias(f"text_{x}"))
    # The text of b travels once for each pair; the text of a is met where the pairs of a lie.
    found = pairs.toDF("h_a", "h_b").join(one("b").hint("merge"), "h_b").join(one("a").hint("merge"), "h_a")
    both = found.select("cls_a", "cls_b", "text_a", "text_b")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for a, b, text_a, text_b in zip(*(batch.column(k).to_pylist() for k in range(4))):
                rows += [(a, b, j, i, n) for i, j, n in factors(text_b, text_a, min_chars)]
                if both_ways:
                    rows += [(a, b, i, j, n) for i, j, n in factors(text_a, text_b, min_chars)]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))], ["cls_a", "cls_b", "start_a", "start_b", "length"])

    return members, both.mapInArrow(run, "cls_a binary, cls_b binary, start_a bigint, start_b bigint, length bigint")


def _spread(members: DataFrame, side: str, salts: int = 16) -> tuple[DataFrame, DataFrame]:
    """Members twice for a join on the class: spread by a salt, and copied to each salt's place."""
    spread = members.select(F.col("cls").alias(f"cls_{side}"), F.col("doc_id").alias(f"doc_{side}"), F.pmod(F.hash("doc_id"), F.lit(salts)).alias(f"salt_{side}"))
    return spread, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def shared_pairs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id_a < doc_id_b`` of all documents with an identical stretch of ``min_chars``; copies are expanded."""
    members, found = shared_factors(docs, min_chars)
    pairs = found.select("cls_a", "cls_b").distinct()
    a, copies_a = _spread(members, "a")
    b, copies_b = _spread(members, "b")
    other = pairs.withColumn("salt_a", copies_a).join(a, ["cls_a", "salt_a"]).select("cls_b", "doc_a").withColumn("salt_b", copies_b).join(b, ["cls_b", "salt_b"]).select("doc_a", "doc_b")
    several = members.join(members.groupBy("cls").count().where("count > 1").select("cls"), "cls", "left_semi")
    x, copies_x = _spread(several, "a")
    same = several.withColumn("salt_a", copies_x).withColumnRenamed("cls", "cls_a").join(x, ["cls_a", "salt_a"]).where("doc_a < doc_id").select("doc_a", F.col("doc_id").alias("doc_b"))
    return other.union(same).select(F.least("doc_a", "doc_b").alias("doc_id_a"), F.greatest("doc_a", "doc_b").alias("doc_id_b")).where("doc_id_a < doc_id_b").distinct()


def shared_share(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_chars, shared_chars, shared_share, spans`` of documents that share a stretch; ``spans`` are merged ``start`` (from 1) and ``length``."""
    members, found = shared_factors(docs, min_chars, both_ways=True)
    spans = found.select(F.col("cls_a").alias("cls"), F.col("start_a").alias("start"), "length").union(found.select("cls_b", "start_b", "length")).distinct()
    whole = members.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls", F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("length"))
    from pyspark.sql.window import Window

    w = Window.partitionBy("cls").orderBy("start", "length")  # spans of one text
    end = F.col("start") + F.col("length")
    merged = (
        spans.withColumn("reach", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("span", F.sum(F.coalesce((F.col("start") > F.col("reach")).cast("int"), F.lit(1))).over(w))
        .groupBy("cls", "span").agg(F.min("start").alias("start"), F.max(end).alias("end"))
        .groupBy("cls").agg(F.sum(F.col("end") - F.col("start")).alias("shared_chars"), F.array_sort(F.collect_list(F.struct((F.col("start") + 1).alias("start"), (F.col("end") - F.col("start")).alias("length")))).alias("spans"))
    )
    by_class = merged.join(whole.select("cls", F.lit(True).alias("copied")), "cls", "full_outer")
    n = docs.select("doc_id", F.length("text").cast("long").alias("n_chars")).where(F.col("n_chars") >= min_chars).distinct()
    out = members.join(by_class, "cls").join(n, "doc_id")
    full = F.array(F.struct(F.lit(1).cast("long").alias("start"), F.col("n_chars").alias("length")))
    out = out.withColumn("shared_chars", F.when(F.col("copied"), F.col("n_chars")).otherwise(F.col("shared_chars"))).withColumn("spans", F.when(F.col("copied"), full).otherwise(F.col("spans")))
    return out.select("doc_id", "n_chars", "shared_chars", (F.col("shared_chars") / F.col("n_chars")).alias("shared_share"), "spans")
