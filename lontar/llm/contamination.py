"""Problem 8: evaluation texts leaking into training text.

Method: an FM-index per shard of the corpus, over words. A shard's words are
numbered (words that no test item has share one number, which no phrase can
match), its suffixes are sorted, and the Burrows-Wheeler transform is held in a
wavelet matrix with rank counts. All phrases of ``min_words`` words of all test
items are searched backward at once, by vectorised ranks; the hits are located
by walking to sampled suffix positions, and overlapping hits of one item become
one span.

Shards are bounded by ``SHARD_WORDS``; a longer text makes a shard of its own,
cut into pieces that overlap by ``min_words - 1`` words, so no passage is lost
and no task holds more than a shard. Suffixes are sorted as far as a phrase can
reach (``min_words`` words), which is all that backward search needs.

Defined results: null and empty texts hold no passage; items of fewer than
``min_words`` words can't be found; repeated rows give repeated spans in
``spans`` and one row in ``found``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import WORD

#: Words of a shard; about 60 bytes each while the index is built.
SHARD_WORDS = 1_000_000
#: Every so many positions of a text are kept for locating.
SAMPLE = 8
#: Words of test items that every executor holds at once (some 100 bytes each with their phrases); more items go in several blocks, each in a pass of its own.
ITEM_WORDS = 2_000_000


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``codes`` in the order of their first ``depth`` codes, by prefix doubling; ties by position."""
    n = len(codes)
    rank, k = codes.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        shifted = np.full(n, -1, np.int64)
        shifted[: n - k] = rank[k:]
        key = rank * (int(rank.max()) + 2) + shifted + 1
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        rank, k = new, 2 * k
        if rank[order[-1]] == n - 1:
            break
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, many at once."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(seq) - self.ones[-1][-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start, end = np.zeros_like(end), end.copy()
        for ones, zeros, b in zip(self.ones, self.zeros, range(self.bits - 1, -1, -1)):
            one = ((symbol >> b) & 1).astype(bool)
            s1, e1 = ones[start], ones[end]
            start, end = np.where(one, zeros + s1, start - s1), np.where(one, zeros + e1, end - e1)
        return end - start


class FMIndex:
    """Backward search and locate over a sequence of codes 1.. (0 ends it)."""

    def __init__(self, codes: np.ndarray, symbols: int, depth: int):
        text = np.concatenate((codes, [0])).astype(np.int64)
        order = suffix_order(text, depth)
        self.n = len(text)
        bwt = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.bwt, self.wavelet = bwt, WaveletMatrix(bwt, symbols)
        self.sampled = np.full(self.n, -1, np.int64)
        at = order % SAMPLE == 0
        self.sampled[at] = order[at]
        # The row of the suffix one position earlier. Suffixes are sorted to `depth` only, so among equal ones an LF
        # step by ranks could land on a neighbour; ranges of phrases of at most `depth` codes are exact either way.
        where = np.empty(self.n, np.int64)
        where[order] = np.arange(self.n)
        self.step = where[order - 1]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of ``phrases``."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero(hi > lo)
            if not len(live):
                break
            c = phrases[live, j]
            lo[live], hi[live] = self.first[c] + self.wavelet.rank(c, lo[live]), self.first[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps to the next sampled one."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            known = self.sampled[at[todo]]
            done = known >= 0
            out[todo[done]] = known[done] + steps[todo[done]]
            todo = todo[~done]
            at[todo] = self.step[at[todo]]
            steps[todo] += 1
        return out


def leaked_spans(docs: DataFrame, items: DataFrame, min_words: int = 12) -> DataFrame:
    """``doc_id, item_id, first_word, last_word`` (from 0): merged passages of items in documents.

    ``docs`` has ``doc_id, text``; ``items`` ``item_id, text``. Every executor
    gets the items, in blocks of bounded size. The documents are read where they
    lie; only hits leave the scan.
    """
    kind, item_kind = (t.schema[c].dataType for t, c in ((docs, "doc_id"), (items, "item_id")))
    schema = f"doc_id {kind.simpleString()}, item_id {item_kind.simpleString()}, first_word bigint, last_word bigint"
    long = items.select("item_id", "text").where("text IS NOT NULL")
    words = long.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"] // 4  # hardly more words than that
    blocks = int(words // ITEM_WORDS) + 1
    hits = None
    for k in range(blocks):
        block = long if blocks == 1 else long.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = _hits(docs, [(r["item_id"], r["text"]) for r in block.toLocalIterator()], min_words, schema)
        if found is not None:
            hits = found if hits is None else hits.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if hits is None else merge_spans(hits)


def _hits(docs: DataFrame, items: list[tuple], min_words: int, schema: str) -> DataFrame | None:
    """Places of the phrases of some items; None if they have none."""
    import pyarrow as pa

    vocabulary: dict[str, int] = {}
    phrases, of = [], []
    for item, text in items:
        words = WORD.findall(text.lower())
        if len(words) >= min_words:
            codes = [vocabulary.setdefault(w, len(vocabulary) + 3) for w in words]
            for i in range(len(codes) - min_words + 1):
                phrases.append(codes[i : i + min_words])
                of.append(item)
    if not phrases:
        return None
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, np.array(phrases, np.int64), np.array(of, dtype=object)))

    def run(batches: Iterator) -> Iterator:
        known, wanted, items_of = shared.value
        get, symbols = known.get, len(known) + 3
        codes: list[int] = []
        ids, starts, base = [], [], []  # of the texts in the shard: id, place in the shard, number of its first word

        def flush() -> Iterator:
            index = FMIndex(np.array(codes, np.int64), symbols, min_words)
            lo, hi = index.search(wanted)
            hit = np.flatnonzero(hi > lo)
            if len(hit):
                n = hi[hit] - lo[hit]
                rows = np.repeat(lo[hit] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                at = index.locate(rows)
                text = np.searchsorted(np.array(starts), at, side="right") - 1
                out = [(ids[t], items_of[p], int(a - starts[t] + base[t])) for t, p, a in zip(text, np.repeat(hit, n), at)]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array([x + min_words - 1 for x in cols[2]], pa.int64())], ["doc_id", "item_id", "first_word", "last_word"])
            codes.clear(), ids.clear(), starts.clear(), base.clear()

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = WORD.findall(text.lower()) if text else ()
                if len(words) < min_words:
                    continue
                for k in range(0, len(words) - min_words + 1, SHARD_WORDS):
                    piece = words[k : k + SHARD_WORDS + min_words - 1]
                    ids.append(i), starts.append(len(codes)), base.append(k)
                    codes.extend([get(w, 1) for w in piece])
                    codes.append(2)
                    if len(codes) >= SHARD_WORDS:
                        yield from flush()
        if codes:
            yield from flush()

    return docs.select("doc_id", "text").where("text IS NOT NULL").mapInArrow(run, schema)


def merge_spans(hits: DataFrame) -> DataFrame:
    """Overlapping or touching hits of one item in one document become one span (few rows: hits only)."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("doc_id", "item_id").orderBy("first_word", "last_word")
    reach = F.max("last_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (
        hits.distinct().withColumn("fresh", F.coalesce((F.col("first_word") > reach + 1).cast("int"), F.lit(1)))
        .withColumn("span", F.sum("fresh").over(w))
        .groupBy("doc_id", "item_id", "span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"))
        .drop("span")
    )


def leaked(docs: DataFrame, items: DataFrame, min_words: int = 12) -> DataFrame:
    """``doc_id, item_id``: every document that holds a passage of an item."""
    return leaked_spans(docs, items, min_words).select("doc_id", "item_id").distinct()
