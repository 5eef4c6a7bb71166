"""Problem 1: subject areas of each document.

Method: labels are propagated over a verified document-similarity graph by
iterative DataFrame joins. The graph is kept in its factored form: a document
is tied to the terms it uses, so two documents are neighbours if they share
terms, and no pair of documents is ever written. A term is verified, and its
ties count, only if the documents that have it agree on a subject; common and
subject-free words so drop out. Documents that a coarse classification has put
in one group are neighbours too: labels first go over the groups (where their
labelled documents agree), then over terms. From the documents labelled by hand, which stay
clamped to their labels in every round, subjects pass to terms, from those to
all documents, and back, ``ROUNDS`` times. A document keeps several subjects:
in the end each of its sentences and list items is given to the subject of its
terms, and the document has every subject that at least ``SHARE`` of them are
about.

Labelled entries keep their labels in the result too; subjects that their text
adds are given beside them, as labels may be missing.

Equal texts are one node. Defined results: null and empty texts, and texts
without any sentence or item of a known subject, have no row unless they are
labelled; labels of unknown entries and subjects outside ``subject_areas`` are
ignored; with no labels at all the result is empty; sentences and items of no
known subject don't count; the share of a label that its text doesn't show is
null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import cut, size_checked
from lontar.llm.quality import COMMON

SHARE = 0.3
ROUNDS = 2
#: Subject areas that may be in use.
MAX_SUBJECTS = 200
#: Terms that every executor may hold (a row of them is a hash and a number per subject); more are joined, with the same result.
MAX_TERMS = 200_000
#: Salts of the join of terms that aren't held by every executor: one term may be in a third of all documents.
SALTS = 16
#: Terms that a coarse topic of the project's own classification counts as, in the graph only.
TOPIC_TIES = 3
#: Part of the mean weight of a subject that each one has at least: else the words of the one or two documents of a small subject, which may be about another one too, would all be its own.
LEAST_MASS = 0.5
#: Share of all documents' weight from which a term may be verified: a word of fewer, such as a name, agrees on a subject by chance.
LEAST_USE = 3e-4
#: Agreement of its documents that verifies a term.
AGREEMENT = 0.5

_WORD = re.compile(r"[^\W\d_]{3,}")
_UNIT = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])|\n+")


def _hashes(words: list[str], memory: dict[str, int]) -> list[int]:
    import xxhash

    out = []
    for w in words:
        h = memory.get(w)
        if h is None:
            if len(memory) > 1_000_000:
                memory.clear()
            h = memory[w] = xxhash.xxh64_intdigest(w) - (1 << 63)
        out.append(h)
    return out


def ties(entries: DataFrame, without: DataFrame | None = None) -> DataFrame:
    """``doc, term``: hashes of texts and of their different words, but for common ones and those of ``without`` (a column ``term``)."""
    import pyarrow as pa

    told = None
    if without is not None and without.count() <= MAX_TERMS:
        told = entries.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in without.collect()))

    def run(batches: Iterator) -> Iterator:
        memory: dict[str, int] = {}
        gone = told.value if told else frozenset()
        for b in batches:
            rows, terms = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                own = set(_hashes(list(set(_WORD.findall(text.lower())) - COMMON), memory)) - gone
                rows += [k] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.int64())], ["doc", "term"])

    texts = entries.where("text IS NOT NULL AND text <> ''").select(F.xxhash64("text").alias("doc"), "text")
    found = texts.mapInArrow(run, "doc bigint, term bigint")
    if without is not None and told is None:
        found = found.join(without.select("term").hint("merge"), "term", "left_anti").select("doc", "term")
    return found.distinct()


def _with_terms(graph: DataFrame, terms: DataFrame) -> DataFrame:
    """``graph`` (a column ``term``) with the values of its terms; where they are too many to be told to every executor, each is copied to ``SALTS`` places."""
    if _small(terms):
        return graph.join(F.broadcast(terms), "term")
    copied = terms.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return graph.withColumn("_salt", F.pmod(F.hash("doc"), F.lit(SALTS)).cast("int")).join(copied.hint("merge"), ["term", "_salt"]).drop("_salt")


def _sums(subjects: int, prefix: str = "s") -> list:
    return [F.sum(f"{prefix}{k}").alias(f"s{k}") for k in range(subjects)]


def _mass(nodes: DataFrame, subjects: int) -> list[float]:
    """Documents' weight per subject: one row."""
    row = [max(float(v or 0.0), 0.5) for v in nodes.agg(*_sums(subjects)).first()]
    return [m + LEAST_MASS * sum(row) / subjects for m in row]


def _verified(per_term: DataFrame, mass: list[float]) -> DataFrame:
    """``term, s0 ...``: shares of the subjects, of terms whose documents agree; ``per_term`` has the sums of documents.

    A subject's sum is taken in proportion to all its documents (``mass``), so
    that large subjects don't draw in the words of small ones; a part of a
    document in proportion to the subjects is added, so that few documents
    don't verify a term by chance.
    """
    n, whole = len(mass), sum(mass)
    raw = [F.col(f"s{k}") for k in range(n)]
    even = [(c + 0.3 * m / whole) / m for c, m in zip(raw, mass)]
    total = sum(even[1:], even[0])
    top = F.greatest(*even) if n > 1 else even[0]
    return per_term.where((sum(raw[1:], raw[0]) > max(1.2, LEAST_USE * whole)) & (top >= AGREEMENT * total)).select("term", *((c / total).alias(f"s{k}") for k, c in enumerate(even)))


def _small(terms: DataFrame) -> bool:
    return terms.count() <= MAX_TERMS


def group_ties(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc, term`` of documents that a coarse classification (``id, topic``) has put in one group: ``TOPIC_TIES`` terms stand for the group."""
    named = groups.where("id IS NOT NULL AND coalesce(topic, '') <> ''").select("id", "topic").distinct()
    docs = entries.where("text IS NOT NULL AND text <> ''").select("id", F.xxhash64("text").alias("doc"))
    terms = F.explode(F.array(*(F.xxhash64(F.lit(f"topic {k}"), "topic") for k in range(TOPIC_TIES))))
    return docs.join(named.hint("merge"), "id").select("doc", terms.alias("term")).distinct()


def propagate(entries: DataFrame, labels: DataFrame, subjects: list[str], rounds: int = ROUNDS, groups: DataFrame | None = None) -> DataFrame:
    """``term, s0 ...``: verified terms with their shares of the subjects. ``entries`` has ``id, text``, ``labels`` ``id, subject``, ``groups`` ``id, topic``."""
    n = len(subjects)
    number = F.create_map(*(F.lit(x) for k, s in enumerate(subjects) for x in (s, k)))
    seeds = labels.select("id", number[F.col("subject")].alias("k")).where("k IS NOT NULL").distinct()
    per_id = seeds.groupBy("id").agg(*(F.max((F.col("k") == k).cast("double")).alias(f"s{k}") for k in range(n)))
    labelled = entries.select("id", "text").where("text IS NOT NULL").join(per_id, "id")
    share = sum((F.col(f"s{k}") for k in range(1, n)), F.col("s0"))
    texts = cut(labelled.select("text", *((F.col(f"s{k}") / share).alias(f"s{k}") for k in range(n))))
    clamped = cut(texts.groupBy(F.xxhash64("text").alias("doc")).agg(*(F.avg(f"s{k}").alias(f"s{k}") for k in range(n))))
    own = ties(texts.select("text"))
    by_group = None if groups is None else cut(group_ties(entries, groups))
    if by_group is not None:
        own = own.unionByName(by_group.join(clamped.select("doc").hint("merge"), "doc", "left_semi"))
    seed_terms = cut(own.join(clamped, "doc").groupBy("term").agg(F.count("*").alias("n"), *_sums(n)))
    terms = cut(_verified(seed_terms, _mass(clamped, n)))
    # Words that many labelled documents have without agreeing on anything say nothing about subjects; they are left out of
    # the graph. Their number is bounded by the words of the labelled sample.
    idle = seed_terms.where("n >= 5").join(terms.hint("merge"), "term", "left_anti").select("term")
    graph = ties(entries, cut(idle))
    graph = cut(graph if by_group is None else graph.unionByName(by_group))
    if by_group is not None:
        # The first step goes over the groups alone: where labelled documents of a group agree, its other ones count half, for that subject.
        of_group = _verified(by_group.join(clamped, "doc").groupBy("term").agg(*_sums(n)), [1.0] * n)  # a group is no word: small subjects need no help
        held = _with_terms(by_group, cut(of_group)).groupBy("doc").agg(*_sums(n))
        top = F.greatest(*(F.col(f"s{k}") for k in range(n))) if n > 1 else F.col("s0")
        half = held.select("doc", *(F.when(F.col(f"s{k}") == top, 0.5).otherwise(0.0).alias(f"s{k}") for k in range(n)))
        nodes = cut(half.join(clamped.select("doc").hint("merge"), "doc", "left_anti").unionByName(clamped))
        terms = cut(_verified(graph.join(nodes.hint("merge"), "doc").groupBy("term").agg(*_sums(n)), _mass(nodes, n)))
    for _ in range(rounds):
        scores = _with_terms(graph, terms).groupBy("doc").agg(*_sums(n))
        # Squared: a document leans to the subjects most of its terms speak for.
        square = sum((F.col(f"s{k}") ** 2 for k in range(1, n)), F.col("s0") ** 2)
        free = scores.join(clamped.select("doc").hint("merge"), "doc", "left_anti").select("doc", *((F.col(f"s{k}") ** 2 / square).alias(f"s{k}") for k in range(n)))
        nodes = cut(free.unionByName(clamped))
        terms = cut(_verified(graph.join(nodes.hint("merge"), "doc").groupBy("term").agg(*_sums(n)), _mass(nodes, n)))
    return terms


def _units_of(text: str) -> list[list[str]]:
    return [w for w in (_WORD.findall(u) for u in _UNIT.split(text.lower())) if w]


def subjects_of(entries: DataFrame, labels: DataFrame, areas: DataFrame, share: float = SHARE, groups: DataFrame | None = None) -> DataFrame:
    """``id, subject, share`` of the subjects of each entry, each once. ``areas`` has ``subject``; ``groups`` (``id, topic``), if there are any, a coarse classification of entries, wrong or missing at times."""
    subjects = sorted({r["subject"] for r in size_checked(areas.select("subject").where("subject IS NOT NULL").distinct(), MAX_SUBJECTS, "subject areas")})
    spark, kind = entries.sparkSession, entries.schema["id"].dataType.simpleString()
    if not subjects:
        return spark.createDataFrame([], f"id {kind}, subject string, share double")
    terms = propagate(entries, labels, subjects, groups=groups)
    found = _by_broadcast(entries, terms, subjects, share) if _small(terms) else _by_join(entries, terms, subjects, share)
    named = labels.select(F.col("id").cast(kind).alias("id"), "subject").where(F.col("subject").isin(*subjects)).distinct()
    seeds = named.join(entries.select("id").where("id IS NOT NULL").distinct().hint("merge"), "id", "left_semi").select("id", "subject", F.lit(None).cast("double").alias("share"))
    return found.unionByName(seeds).groupBy("id", "subject").agg(F.max("share").alias("share"))


def _by_broadcast(entries: DataFrame, terms: DataFrame, subjects: list[str], share: float) -> DataFrame:
    """``id, subject, share`` by a table of terms that every executor holds; units are scored where the texts lie."""
    import pyarrow as pa

    spark, kind, n = entries.sparkSession, entries.schema["id"].dataType.simpleString(), len(subjects)
    table = terms.toArrow()
    shared = spark.sparkContext.broadcast((np.array(table.column("term").to_pylist(), np.int64), np.stack([table.column(f"s{k}").to_numpy() for k in range(n)], 1) if table.num_rows else np.zeros((0, n))))

    def run(batches: Iterator) -> Iterator:
        keys, values = shared.value
        place = {int(k): i for i, k in enumerate(keys)}
        memory: dict[str, int] = {}
        at_word: dict[str, int] = {}
        for b in batches:
            rows, which, shares = [], [], []
            owner, unit, at = [], [], []  # of each known term: text, unit, row of its values
            units = 0
            for k, text in enumerate(b.column(1).to_pylist()):
                for words in _units_of(text):
                    for w in words:
                        i = at_word.get(w)
                        if i is None:
                            if len(at_word) > 1_000_000:
                                at_word.clear()
                            i = at_word[w] = -1 if w in COMMON else place.get(_hashes([w], memory)[0], -1)
                        if i >= 0:
                            at.append(i), unit.append(units)
                    if unit and unit[-1] == units:
                        owner.append(k)
                        units += 1
            if at:
                scores = np.zeros((units, n))
                np.add.at(scores, np.array(unit), values[np.array(at)])
                best = scores.argmax(1)
                held = scores[np.arange(units), best] >= 0.5 * scores.sum(1)
                counts = np.zeros((b.num_rows, n))
                np.add.at(counts, (np.array(owner)[held], best[held]), 1)
                part = counts / np.maximum(1, counts.sum(1, keepdims=True))
                rows, which = np.nonzero(part >= share - 1e-9)
                shares = part[rows, which]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array([subjects[s] for s in which], pa.string()), pa.array(shares, pa.float64())], ["id", "subject", "share"])

    return entries.where("text IS NOT NULL").select("id", "text").mapInArrow(run, f"id {kind}, subject string, share double")


def _by_join(entries: DataFrame, terms: DataFrame, subjects: list[str], share: float) -> DataFrame:
    """As the end of ``subjects_of``, for any number of terms: units are exploded and joined with them."""
    import pyarrow as pa

    n = len(subjects)

    def run(batches: Iterator) -> Iterator:
        memory: dict[str, int] = {}
        for b in batches:
            docs, units, found = [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for u, words in enumerate(_units_of(text)):
                    h = _hashes([w for w in words if w not in COMMON], memory)
                    docs += [doc] * len(h)
                    units += [u] * len(h)
                    found += h
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(units, pa.int32()), pa.array(found, pa.int64())], ["doc", "unit", "term"])

    texts = entries.where("text IS NOT NULL").select(F.xxhash64("text").alias("doc"), "text").dropDuplicates(["doc"])
    cols = [F.col(f"s{k}") for k in range(n)]
    total = sum(cols[1:], cols[0])
    scored = texts.mapInArrow(run, "doc bigint, unit int, term bigint").transform(_with_terms, terms).groupBy("doc", "unit").agg(*_sums(n))
    best = F.array_position(F.array(*cols), F.array_max(F.array(*cols)))
    counted = scored.where(F.array_max(F.array(*cols)) >= 0.5 * total).groupBy("doc", best.alias("k")).count()
    whole = counted.groupBy("doc").agg(F.sum("count").alias("all"))
    part = counted.join(whole, "doc").withColumn("share", F.col("count") / F.col("all")).where(F.col("share") >= share - 1e-9)
    named = part.select("doc", F.element_at(F.array(*map(F.lit, subjects)), F.col("k").cast("int")).alias("subject"), "share")
    return entries.select("id", F.xxhash64("text").alias("doc")).join(named, "doc").select("id", "subject", "share")
