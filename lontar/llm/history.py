"""Problem 7: checking new batches for (near-)duplicates against all history.

Method: a pivot-distance table. Each text is the set of its word triples; sets
are compared in the symmetric-difference metric |A - B| + |B - A|, for which a
Jaccard similarity of s or more means a distance of at most
(1 - s) / (1 + s) * (|A| + |B|). The fixed pivots are the empty set, whose
distance is a set's size, and the empty sets of ``PIVOTS`` disjoint parts of all
possible triples (parts by hash), whose distances are the numbers of a set's
triples in each part; by the triangle inequality the sum of the differences over
the parts bounds the distance of two sets from below.

``HistoryTable`` keeps these distances on disk, with the triples (as hashes) and
the keys of address and exact text, in folders by ranges of the distance to the
empty set. History is written once; a batch is signed, appended, and compared
with the rows of smaller batches: only the table is read, never an old text.

1. Join on the range: a probe goes to the ranges that the triangle inequality
   leaves for its size, and there meets the rows with which it shares one of the
   triples that come first in one fixed order of all triples. Two sets A and B of
   similarity s have ceil(s / (1 + s) * (|A| + |B|)) triples in common, so one
   common triple is among the first |A| + 1 less that number of A, and of B.
2. Prune by the distances to all pivots.
3. Verify by the true distance of the two triple sets.

The order puts triples that many texts have last. It is fitted on a random
sample of about ``SAMPLE`` texts of all history and stored with the table; it
changes the speed and never the result. A triple the sample lacks is a rare one:
one that a thousandth of the texts have is missing with a chance of e ** -20.

A triple that is first in very many texts all the same (of a text with a great
many near copies) is hot. Hot triples are met with a few representatives each
first, which tells nearly every copy; only probes still unknown then go to the
rest of the hot rows, in a salted join. Both ways together are exact.

Defined results: null texts and texts under three words have no triples and are
never near-duplicates; null or empty addresses match none; texts without any
word have no exact hash; rows of one batch are not compared; a null batch number
is never compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.llm.common import WORD, cut, fresh_folder, sized
from lontar.plans.stage import spread

SIMILARITY = 0.6
PIVOTS = 64
#: Texts on which the order of triples is fitted, and uses among them from which a triple has a place of its own (so there are at most a third as many as triples in the sample).
SAMPLE, USES = 20_000, 3
#: A triple is hot from so many texts on (estimated by the sample).
HOT = 10_000
#: Representatives of a hot triple, and salts of the join of what they leave.
REPRESENTATIVES, SALTS = 16, 16
#: Bits of the filter of a batch's first triples, 16 for each, at most: 128 MB.
FILTER_BITS = 1 << 30
#: Sets of triples (a kilobyte or so each) that may be told to every executor.
TOLD = 20_000
#: Quotient of the ends of a range of distances to the empty set.
RANGE = 1.67
#: Words whose hashes a worker remembers, and texts that it knows it has signed.
REMEMBERED = 500_000
#: Texts and characters signed at once.
AT_ONCE, CHARS = 2_048, 4_000_000

_HASH_BITS, _CLASSES = 42, 63
#: Rows travel under the last 40 bits of the hash of their text; all texts under one number are looked at in the end.
_SHORT = (1 << 40) - 1
_HASH = np.uint64((1 << _HASH_BITS) - 1)
_NO_WORD = re.compile(r"[^\w ]+")


def normal_url(url: Column) -> Column:
    """Address apart from scheme, ``www.``, case of the host, trailing slash, fragment and tracking parameters; null if empty."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(r"^(utm_[^=]*|fbclid|gclid)(=|$)")), "&")
    return F.when(host == "", None).otherwise(F.concat(host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def exact_hash(text: str) -> bytes | None:
    """First half of the SHA-256 of the text in lower case, white space runs made one space, all but word characters and spaces dropped, stripped; None if nothing is left."""
    from hashlib import sha256

    t = _NO_WORD.sub("", " ".join(text.lower().split())).strip()
    return sha256(t.encode("utf-8", "surrogatepass")).digest()[:16] if t else None


_memory: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    if len(_memory) > REMEMBERED:
        _memory.clear()
    get = _memory.get
    out = [get(w) for w in words]
    for k in [k for k, h in enumerate(out) if h is None]:
        out[k] = _memory[words[k]] = xxhash.xxh64_intdigest(words[k])
    return np.array(out, np.uint64)


def triple_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash (``_HASH_BITS`` bits) of each of its word triples, in the order of the text."""
    words, lengths = [], []
    for t in texts:
        w = WORD.findall(t.lower()) if t else []
        words += w
        lengths.append(len(w))
    h = _word_hashes(words)
    if len(h) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        t = h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + (h[2:] >> np.uint64(7)) * np.uint64(0x165667B19E3779F9))
        t ^= t >> np.uint64(32)
        t *= np.uint64(0xBF58476D1CE4E5B9)
        t ^= t >> np.uint64(29)
    text = np.repeat(np.arange(len(texts)), np.array(lengths))
    within = text[:-2] == text[2:]
    return text[:-2][within], t[within] & _HASH


Order = tuple[np.ndarray, np.ndarray, int]


def fit_order(texts: DataFrame) -> DataFrame:
    """``t, place``: triples that several texts of a random sample have, and their class from 1 (rare) to ``_CLASSES``, a step for each 12 per cent more uses; the row of ``t`` -1 has the class from which a triple is hot."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            own = b.column(0).to_pylist()
            for i in range(0, len(own), AT_ONCE):
                text, t = triple_hashes(own[i : i + AT_ONCE])
                t = np.unique((text.astype(np.uint64) << np.uint64(_HASH_BITS)) | t) & _HASH
                t, n = np.unique(t, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int64)), pa.array(n)], ["t", "n"])

    spark = texts.sparkSession
    rows = texts.count()
    sample = spread(texts.select("text").where("text IS NOT NULL").sample(min(1.0, SAMPLE / max(1, rows)), seed=7))
    often = sample.mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).where(F.col("n") >= USES)
    klass = lambda n: F.least(F.lit(_CLASSES), 1 + F.floor(F.log(n / F.lit(float(USES))) / math.log(1.12))).cast("int")
    hot = F.greatest(F.lit(float(USES)), F.lit(HOT * min(1.0, SAMPLE / max(1, rows))))
    return often.select("t", klass(F.col("n")).alias("place")).union(spark.range(1).select(F.lit(-1).cast("long"), klass(hot)))


def pivot_distances(text: np.ndarray, triples: np.ndarray, size: int) -> np.ndarray:
    """``[size, PIVOTS]``: distances to the parts' empty sets, cut off at 255, which keeps differences lower bounds."""
    part = (triples & np.uint64(PIVOTS - 1)).astype(np.int64)
    return np.minimum(255, np.bincount(text * PIVOTS + part, minlength=size * PIVOTS)).astype(np.uint8).reshape(size, PIVOTS)


def common_least(a: Column | np.ndarray, b: Column | np.ndarray, similarity: float):
    """Triples that sets of ``a`` and ``b`` triples have in common at the least, times one: compare with whole numbers."""
    return (a + b) * (similarity / (1 + similarity)) - 1e-9


def range_of(n: np.ndarray | int) -> np.ndarray:
    """Range of the distance to the empty set."""
    return np.floor(np.log(np.maximum(1, n)) / math.log(RANGE) + 1e-9).astype(np.int64)


def _packed(values: np.ndarray) -> np.ndarray:
    """Six bytes of each value."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :6].ravel()


def _unpacked(raw: bytes | np.ndarray) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).ravel()


def _binary(flat: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None):
    """An Arrow column of the slices of ``flat`` between ``ends``."""
    import pyarrow as pa

    offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes())
    valid = None if missing is None else pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends), [valid, offsets, pa.py_buffer(flat.tobytes())])


_SIGNED = "id string, batch int, address binary, exact binary, row bigint, n int, range int, pivots binary, triples binary"


def sign(rows: DataFrame, order: Order) -> DataFrame:
    """Rows of the table for ``rows`` (``id, batch, address, text``).

    Copies of a text in one batch are signed once per task; the others have
    their keys only (range -1), so a text in a third of all rows is no hot one.
    """
    import pyarrow as pa

    shared = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator) -> Iterator:
        import xxhash

        known, place, _ = shared.value
        seen: set = set()
        for whole in batches:
            sizes = np.cumsum([len(t or "") for t in whole.column(3).to_pylist()])
            at = 0
            while at < whole.num_rows:
                end = min(at + AT_ONCE, max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHARS, "right"))))
                b = whole.slice(at, end - at)
                at = end
                texts, numbers, size = b.column(3).to_pylist(), b.column(1).to_pylist(), b.num_rows
                row = np.array([xxhash.xxh64_intdigest(t) if t else 0 for t in texts], np.uint64)
                if len(seen) > REMEMBERED:
                    seen.clear()
                fresh = np.zeros(size, bool)
                for k, key in enumerate(zip(numbers, row.tolist())):
                    if texts[k] and key not in seen:
                        seen.add(key)
                        fresh[k] = True
                text, t = triple_hashes([x if f else None for x, f in zip(texts, fresh)])
                if len(known) and len(t):
                    i = np.minimum(np.searchsorted(known, t), len(known) - 1)
                    t = t | (np.where(known[i] == t, place[i], 0).astype(np.uint64) << np.uint64(_HASH_BITS))
                # One sort puts the triples of a text in the fixed order, and repeated ones side by side.
                both = np.unique((text.astype(np.uint64) << np.uint64(48)) | t)
                text, t = (both >> np.uint64(48)).astype(np.int64), both & np.uint64((1 << 48) - 1)
                n = np.bincount(text, minlength=size)
                none = n == 0
                cols = [
                    b.column(0), b.column(1), b.column(2), pa.array([exact_hash(x) if x else None for x in texts], pa.binary()), pa.array(row.view(np.int64)), pa.array(n, pa.int32()),
                    pa.array(np.where(none, -1, range_of(n)), pa.int32()), _binary(pivot_distances(text, t, size)[~none].ravel(), np.cumsum(np.where(none, 0, PIVOTS)), none), _binary(_packed(t), np.cumsum(n * 6), none),
                ]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in _SIGNED.split(", ")])

    return rows.select(F.col("id").cast("string").alias("id"), F.col("batch").cast("int").alias("batch"), "address", "text").mapInArrow(run, _SIGNED)


def _filter(probes: DataFrame, keys: int) -> tuple[np.ndarray, bool]:
    """Bits of the keys of ``probes``, about ``keys`` of them, and whether any is hot. It is built where they lie and has a bounded size, whatever the batch."""
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(15, (16 * keys).bit_length()))
    slot = F.pmod(F.col("k"), F.lit(bits)) + 1  # buckets of the built-in bitmaps count from 1
    rows = probes.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("m"), F.max("hot").alias("hot")).toArrow()
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for b, m in zip(rows.column("b").to_pylist(), rows.column("m").to_pylist()):
        out[b - 1] = np.frombuffer(m, np.uint8)
    return out.ravel(), any(rows.column("hot").to_pylist())


def _firsts(signed: DataFrame, order: Order, similarity: float, probes: bool, wanted: np.ndarray | None = None) -> DataFrame:
    """``k, hot, row, batch, n, place``: the first triples of each set, with the range; of probes for each range that the triangle inequality leaves. ``wanted`` are the bits of keys that may be met; others are left out."""
    import pyarrow as pa

    hot_class = np.uint64(order[2])
    shared = None if wanted is None else signed.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            row, batch, n = (b.column(k).to_numpy() for k in range(3))
            row, n, size = row & _SHORT, n.astype(np.int64), b.num_rows
            start = np.cumsum(n) - n
            t = _unpacked(b"".join(b.column(4).to_pylist()))
            if probes:
                low, high = range_of(np.ceil(similarity * n - 1e-9)), range_of(np.floor(n / similarity + 1e-9))
                many = high - low + 1
                who = np.repeat(np.arange(size), many)
                at_range = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + low[who]
                smallest = np.maximum(np.ceil(RANGE**at_range - 1e-6), np.ceil(similarity * n[who] - 1e-9))
                first = n[who] - np.ceil(common_least(n[who], smallest, similarity)).astype(np.int64) + 1
            else:
                who, at_range = np.arange(size), range_of(n)
                first = n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1
            first = np.minimum(first, n[who])
            owner = np.repeat(who, first)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(first) - first, first)
            value = t[start[owner] + place]
            key = ((value & _HASH) | (np.repeat(at_range, first).astype(np.uint64) << np.uint64(_HASH_BITS))).view(np.int64)
            if shared is not None:
                bits = shared.value
                slot = key % (8 * len(bits))
                met = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                owner, place, value, key = owner[met], place[met], value[met], key[met]
            hot = (value >> np.uint64(_HASH_BITS)) >= hot_class
            for i in range(0, len(key), 100_000):
                s = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(hot[s]), pa.array(row[owner[s]]), pa.array(batch[owner[s]]), pa.array(n[owner[s]], pa.int32()), pa.array(place[s], pa.int32())], ["k", "hot", "row", "batch", "n", "place"])

    return signed.select("row", "batch", "n", "range", "triples").mapInArrow(run, "k bigint, hot boolean, row bigint, batch int, n int, place int")


def _meet(a: DataFrame, b: DataFrame, similarity: float, *on: str) -> DataFrame:
    """``a, b, first``: probes and rows of a smaller batch that share a key within the first triples that their two sizes ask for, and the row's batch; a pair may stand several times."""
    names = ["row", "batch", "n", "place"]
    a, b = a.select("k", *on, *(F.col(c).alias(f"{c}_a") for c in names)), b.select("k", *on, *(F.col(c).alias(f"{c}_b") for c in names))
    least = common_least(F.col("n_a"), F.col("n_b"), similarity)
    near = (F.col("batch_b") < F.col("batch_a")) & (F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9) & (F.col("place_a") <= F.col("n_a") - least) & (F.col("place_b") <= F.col("n_b") - least)
    return a.join(b.hint("merge"), ["k", *on]).where(near).select(F.col("row_a").alias("a"), F.col("row_b").alias("b"), F.col("batch_b").alias("first"))


def _verified(pairs: DataFrame, new: DataFrame, old: DataFrame, similarity: float) -> DataFrame:
    """``a`` (hash of the text), ``first`` of ``pairs`` (short numbers) that pass the pivots and then the true distance."""
    import pyarrow as pa

    short = F.col("row").bitwiseAND(F.lit(_SHORT))

    def once(df: DataFrame, side: str, column: str) -> DataFrame:
        own = df.select(short.alias(side), F.col("row").alias(f"row_{side}"), column).repartition(side)  # by the number, so that the join needs no other shuffle
        return own.groupBy(side, f"row_{side}").agg(F.first(column).alias(f"{column}_{side}"))

    def pruned(batches: Iterator) -> Iterator:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, PIVOTS).astype(np.int16) for k in (3, 4))
            n = x.sum(1, dtype=np.int64) + y.sum(1, dtype=np.int64)
            # Distances cut off at 255 make n too small; such sets go on unpruned.
            near = (np.abs(x - y).sum(1) <= (1 - similarity) / (1 + similarity) * n + 1e-9) | (x == 255).any(1) | (y == 255).any(1)
            at = pa.array(np.flatnonzero(near))
            yield pa.RecordBatch.from_arrays([b.column(k).take(at) for k in range(3)], ["a", "b", "first"])

    def true(batches: Iterator) -> Iterator:
        for b in batches:
            near = []
            for p, q in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                p, q = _unpacked(p), _unpacked(q)
                common = len(np.intersect1d(p, q, assume_unique=True))
                near.append(common >= similarity * (len(p) + len(q) - common) - 1e-9)
            at = pa.array(np.flatnonzero(near))
            yield pa.RecordBatch.from_arrays([b.column(k).take(at) for k in range(2)], ["a", "first"])

    joined = pairs.join(once(old, "b", "pivots").hint("merge"), "b").join(sized(once(new, "a", "pivots")), "a")
    left = cut(joined.select("a", "b", "first", "pivots_a", "pivots_b").mapInArrow(pruned, "a bigint, b bigint, first int").groupBy("a", "b").agg(F.min("first").alias("first")))
    wanted = lambda df, side: df.join(sized(cut(left.select(F.col(side).alias("_row")).distinct())), short == F.col("_row"), "left_semi")
    both = left.join(once(wanted(old, "b"), "b", "triples").hint("merge"), "b").join(sized(once(wanted(new, "a"), "a", "triples"), TOLD), "a")
    return both.select(F.col("row_a").alias("a"), "first", "triples_a", "triples_b").mapInArrow(true, "a bigint, first int").groupBy("a").agg(F.min("first").alias("first"))


class HistoryTable:
    """The pivot-distance table on disk: history is signed once, batches are appended and compared with what was there before.

    The folder holds ``signed`` (rows by range), ``order`` and ``hashes`` (exact
    hashes of articles known by them only). ``create`` writes, ``append`` adds.
    """

    def __init__(self, spark: SparkSession, path: str, similarity: float = SIMILARITY):
        self.spark, self.path, self.similarity, self._known = spark, path.rstrip("/"), similarity, None

    def create(self, history: DataFrame, index: DataFrame | None = None) -> None:
        """Writes ``history`` (``source_url, text``) as batch 0, and the ``exact_hash`` values of ``index``."""
        fit_order(history).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/order")
        self._known = None
        self._write(history.select(F.lit(None).cast("string").alias("id"), F.lit(0).alias("batch"), "source_url", "text"), "overwrite")
        if index is not None:
            half = F.try_to_binary(F.substring("exact_hash", 1, 32), F.lit("hex"))
            index.where("exact_hash IS NOT NULL").select(half.alias("exact")).where("exact IS NOT NULL").distinct().write.mode("overwrite").parquet(f"{self.path}/hashes")

    def append(self, batches: DataFrame) -> None:
        """Signs ``batches`` (``id, batch, source_url, text``), one or several, and adds them."""
        self._write(batches, "append")

    def _write(self, rows: DataFrame, mode: str) -> None:
        own = spread(rows.select("id", "batch", "source_url", "text")).select("id", "batch", F.unhex(F.md5(normal_url(F.col("source_url")))).alias("address"), "text")
        sign(own, self._order()).write.mode(mode).partitionBy("range").parquet(f"{self.path}/signed")

    def _order(self) -> Order:
        if self._known is None:
            rows = self.spark.read.parquet(f"{self.path}/order").toArrow()
            t, place = rows.column("t").to_numpy(), rows.column("place").to_numpy()
            hot = place[t == -1]
            t, place = t[t >= 0], place[t >= 0]
            o = np.argsort(t)
            self._known = (t[o].astype(np.uint64), place[o], int(hot.max()) if len(hot) else _CLASSES + 1)
        return self._known

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_SIGNED).parquet(f"{self.path}/signed")

    def known(self, *numbers: int) -> DataFrame:
        """``id, reason`` (url, exact, near) of the rows of the batches of these numbers (all from 1, if none is given) that a row of a smaller batch has."""
        rows = self.rows()
        mine = (F.col("batch").isin(*numbers) if numbers else F.col("batch") > 0)

        def earlier(key: str, known: DataFrame, reason: str) -> DataFrame:
            first = known.where(f"{key} IS NOT NULL").groupBy(key).agg(F.min("batch").alias("first"))
            return rows.where(mine & F.col(key).isNotNull()).select("id", "batch", key).join(first, key).where("first < batch").select("id", F.lit(reason).alias("reason"))

        by_url = earlier("address", rows.select("address", "batch"), "url")
        hashes = rows.select("exact", "batch")
        if self._has("hashes"):
            hashes = hashes.unionByName(self.spark.read.parquet(f"{self.path}/hashes").select("exact", F.lit(0).alias("batch")))
        by_hash = earlier("exact", hashes, "exact")
        near = self._near(rows.where("range >= 0 AND batch IS NOT NULL"), mine)
        by_text = rows.where(mine).select("id", "batch", F.col("row").alias("a")).join(near, "a").where("first < batch").select("id", F.lit("near").alias("reason"))
        return by_url.unionByName(by_hash).unionByName(by_text).distinct()

    def _near(self, sets: DataFrame, mine: Column) -> DataFrame:
        """``a, first``: texts of the batches with the smallest batch of a similar text."""
        new, order = sets.where(mine), self._order()
        a = _firsts(new, order, self.similarity, True)
        bits, hot = _filter(a, int(new.agg(F.sum("n")).first()[0] or 0))
        b = _firsts(sets, order, self.similarity, False, bits)
        verified = lambda pairs: _verified(pairs, new, sets, self.similarity)
        if not hot:  # no probe has a hot triple among its first ones
            return verified(_meet(a, b, self.similarity))
        some = F.pmod(F.xxhash64("row"), F.lit(REPRESENTATIVES))
        few = b.where("hot").groupBy("k", some.alias("r")).agg(F.min(F.struct("batch", "row", "n", "place")).alias("x")).select("k", "x.*")
        first = cut(verified(_meet(a.where("NOT hot"), b.where("NOT hot"), self.similarity).unionByName(_meet(a.where("hot"), few, self.similarity))))
        # What a representative hasn't told to be known from the start meets all hot rows.
        told = new.groupBy("row").agg(F.min("batch").alias("batch")).join(first.withColumnRenamed("a", "row").hint("merge"), "row", "left").where("first IS NULL OR first >= batch")
        unsettled = told.select(F.col("row").bitwiseAND(F.lit(_SHORT)).alias("row")).distinct()
        open_ = a.where("hot").join(unsettled.hint("merge"), "row", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rest = _meet(open_, b.where("hot").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")), self.similarity, "salt")
        return first.unionByName(verified(rest)).groupBy("a").agg(F.min("first").alias("first"))

    def _has(self, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def known_articles(incoming: DataFrame, history: DataFrame, index: DataFrame, similarity: float = SIMILARITY, path: str | None = None) -> DataFrame:
    """``id, reason`` of rows of ``incoming`` (``id, batch_no, source_url, text``) that ``history``, ``index`` or an earlier batch has.

    History is written to a table once; all batches at hand are appended, and
    each is compared with the rows of smaller batches. Kept at ``path``, the
    table serves later batches without the history's texts.
    """
    spark = incoming.sparkSession
    table = HistoryTable(spark, path or fresh_folder(spark, "history"), similarity)
    table.create(history, index)
    table.append(incoming.select("id", F.col("batch_no").alias("batch"), "source_url", "text"))
    return table.known()
