"""Problem 3: lines repeated across one site's documents.

Method: each document becomes the sequence of its line identifiers (hashes of
the lines in their common form). The suffixes of all sequences of a site form
its suffix array: they are sorted, in ranges over the cluster, by site and
their first ``DEPTH`` identifiers (and by document, so that a run of equal
suffixes may lie in several ranges), and neighbours' common prefixes give the
blocks: runs of suffixes that agree in 1, 2, ... ``DEPTH`` lines. Runs cut by
the end of a range are summed up afterwards. A block that enough different
documents have is repeated. A longer one is a chain of repeated blocks of
``DEPTH`` lines, each one line further than the last, so blocks of any length
are found in a document by chaining, and are deleted as a whole, the longest
first (``cover``).

A document counts once for a block, however often it has it: among its own
suffixes only the first with the same beginning counts. All rows of one id are
one document, with a gap between different texts; an id with a great many texts
is counted apart (``blocks_of``).

Defined results: null and empty texts have no lines; rows without a site are
left out; rows without an id don't count, but lose the lines that are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import cut, sized

#: Lines of a suffix that are compared at once; longer blocks are chains of blocks of so many lines.
DEPTH = 4
MIN_IDS = 5
#: Different texts of one id that are one sequence at most; those of an id with more are counted apart.
TEXTS = 64
#: Repeated blocks that every executor may hold.
TOLD = 200_000
#: Places to which the blocks of a site are copied where they are joined.
SALTS = 16


def common_form(line: Column) -> Column:
    """White space runs made one space, ends trimmed, lower case, each run of digits made ``0``."""
    return F.regexp_replace(F.trim(F.lower(F.regexp_replace(line, r"(?U)\s+", " "))), r"\p{Nd}+", "0")


def _line_ids(docs: DataFrame) -> DataFrame:
    """``site, id, lines`` (hashes of non-empty lines in common form) of the different texts of ``docs`` (``site, id, text``)."""
    own = docs.where("site IS NOT NULL AND id IS NOT NULL AND text IS NOT NULL")
    return own.select("site", "id", F.transform(F.filter(F.transform(F.split("text", "\n"), common_form), lambda s: s != ""), lambda s: F.xxhash64(s)).alias("lines")).distinct()


def _in_one(texts: DataFrame) -> DataFrame:
    """All texts of one id as one sequence, with a 0 after each."""
    return texts.groupBy("site", "id").agg(F.collect_list("lines").alias("all")).select("site", "id", F.flatten(F.transform("all", lambda a: F.concat(a, F.array(F.lit(0).cast("long"))))).alias("lines"))


def sequences(docs: DataFrame) -> DataFrame:
    """``site, id, lines`` of each document of ``docs`` (``site, id, text``)."""
    return _in_one(_line_ids(docs))


def suffixes(seqs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``site, doc, k0 ... , fresh``: all suffixes, by their first ``depth`` identifiers; bit d of ``fresh`` says that no earlier suffix of the document has the same first d + 1."""
    import pyarrow as pa

    names = [f"k{d}" for d in range(depth)]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            lines = b.column(2)
            flat = lines.flatten().to_numpy(zero_copy_only=False)
            n = np.diff(lines.offsets.to_numpy())
            doc = np.repeat(np.arange(b.num_rows), n)
            m = len(flat)
            keys, fresh, ended = [], np.zeros(m, np.int32), np.zeros(m, bool)
            order_keys = doc.astype(np.int64)
            for d in range(depth):
                k = np.zeros(m, np.int64)
                if m > d:
                    same = doc[: m - d] == doc[d:]
                    k[: m - d] = np.where(same, flat[d:], 0)
                ended |= k == 0
                k[ended] = 0
                keys.append(k)
                with np.errstate(over="ignore"):
                    order_keys = (order_keys ^ (order_keys >> 29)) * np.int64(-0x61C8864680B583EB) + k
                first = np.zeros(m, bool)
                first[np.unique(order_keys, return_index=True)[1]] = True
                fresh |= (first & ~ended).astype(np.int32) << d
            at = np.flatnonzero(keys[0] != 0)
            rows = pa.array(doc[at])
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), *(pa.array(k[at]) for k in keys), pa.array(fresh[at])], ["site", "doc", *names, "fresh"])

    kind = seqs.schema["id"].dataType.simpleString()
    return seqs.select("site", "id", "lines").mapInArrow(run, f"site string, doc {kind}, {', '.join(f'{k} bigint' for k in names)}, fresh int")


def repeated_blocks(seqs: DataFrame, min_ids: int = MIN_IDS, depth: int = DEPTH) -> DataFrame:
    """``site, block`` (line identifiers), ``ids``, ``example`` (a document): blocks of 1 to ``depth`` lines that ``min_ids`` or more documents of the site have."""
    import pyarrow as pa

    names = [f"k{d}" for d in range(depth)]
    seqs = cut(seqs)  # the ranges are fitted on a first pass
    sorted_suffixes = suffixes(seqs, depth).repartitionByRange("site", *names, "doc").sortWithinPartitions("site", *names)
    kind = seqs.schema["id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        # Runs that touch an end of the batch may go on beyond it: they are handed on as they are, and parts of one run
        # are summed up below. Runs inside the batch are complete, and kept only if they are long enough.
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            site = b.column(0).dictionary_encode().indices.to_numpy()
            keys = [b.column(2 + d).to_numpy() for d in range(depth)]
            fresh = b.column(2 + depth).to_numpy()
            differs = np.concatenate(([True], site[1:] != site[:-1]))  # the common prefix with the neighbour is shorter than d + 1
            for d in range(depth):
                differs = differs | np.concatenate(([True], keys[d][1:] != keys[d][:-1]))
                start = np.flatnonzero(differs)
                count = np.add.reduceat((fresh >> d) & 1, start)
                edge = np.zeros(len(start), bool)
                edge[0] = edge[-1] = True
                real = (keys[d][start] != 0) & (count > 0) & (edge | (count >= min_ids))
                start, count = start[real], count[real]
                blocks = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * (d + 1), pa.int32()), pa.array(np.stack([keys[j][start] for j in range(d + 1)], 1).ravel()))
                at = pa.array(start)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), blocks, pa.array(count.astype(np.int64)), b.column(1).take(at)], ["site", "block", "ids", "example"])

    parts = sorted_suffixes.mapInArrow(run, f"site string, block array<bigint>, ids bigint, example {kind}")
    key = F.xxhash64("site", "block")
    merged = parts.withColumn("key", key).groupBy("key").agg(F.sum("ids").alias("ids"), F.min(F.struct("example", "site", "block")).alias("e"))
    return merged.where(F.col("ids") >= min_ids).select("e.site", "e.block", "ids", "e.example")


def blocks_of(docs: DataFrame, min_ids: int = MIN_IDS, depth: int = DEPTH) -> DataFrame:
    """``repeated_blocks`` of ``docs`` (``site, id, text``), whatever the number of texts of an id.

    The texts of an id are one sequence, up to ``TEXTS`` of them. Those of an id
    with more stay apart, and its blocks are made distinct before they count.
    """
    own = cut(_line_ids(docs))
    many = cut(own.groupBy("site", "id").agg(F.count("*").alias("n")).where(F.col("n") > TEXTS).select("site", "id"))
    n = many.count()
    if not n:
        return repeated_blocks(_in_one(own), min_ids, depth)
    few = repeated_blocks(_in_one(own.join(sized(many), ["site", "id"], "left_anti")), max(1, min_ids - n), depth)
    names = [f"k{d}" for d in range(depth)]
    blocks = F.array(*(F.when(F.col(names[d]) != 0, F.array(*names[: d + 1])) for d in range(depth)))
    each = suffixes(own.join(sized(many), ["site", "id"], "left_semi"), depth).select("site", "doc", F.explode(F.array_compact(blocks)).alias("block")).distinct()
    rest = each.groupBy("site", "block").agg(F.count("*").alias("ids"), F.min("doc").alias("example"))
    return few.unionByName(rest).groupBy("site", "block").agg(F.sum("ids").alias("ids"), F.min("example").alias("example")).where(F.col("ids") >= min_ids)


def repeated_lines(docs: DataFrame, min_ids: int = MIN_IDS) -> DataFrame:
    """``site, line`` (common form), ``ids``: lines of repeated blocks of any length, and how many documents have the line. ``docs`` has ``site, id, text``."""
    blocks = blocks_of(docs, min_ids)
    alone = F.when(F.size("block") == 1, F.col("ids"))  # each line of a longer block is a block of its own, too
    single = cut(blocks.select("site", F.explode("block").alias("h"), alone.alias("ids"), F.col("example").alias("id")).groupBy("site", "h").agg(F.max("ids").alias("ids"), F.min("id").alias("id")))
    # The wording of a line is taken from one of its documents.
    wanted = single.select("site", "id").distinct()
    lines = docs.join(sized(cut(wanted)), ["site", "id"], "left_semi").select("site", "id", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), common_form))).alias("line")).where("line <> ''")
    return lines.withColumn("h", F.xxhash64("line")).join(single, ["site", "id", "h"]).select("site", "line", "ids").distinct()


def cover(lines: list[int], known: set[tuple[int, ...]], depth: int = DEPTH) -> list[tuple[int, int]]:
    """``(start, end)`` of the longest repeated blocks in a sequence of line identifiers, without overlap, from the left.

    ``known`` are the repeated blocks of up to ``depth`` lines; one of these goes
    on as long as its last ``depth`` lines are a repeated block.
    """
    out, at, n = [], 0, len(lines)
    while at < n:
        size = next((d for d in range(min(depth, n - at), 0, -1) if tuple(lines[at : at + d]) in known), 0)
        if not size:
            at += 1
            continue
        end = at + size
        if size == depth:
            while end < n and tuple(lines[end - depth + 1 : end + 1]) in known:
                end += 1
        out.append((at, end))
        at = end
    return out


def without_repeated(docs: DataFrame, min_ids: int = MIN_IDS) -> DataFrame:
    """``docs`` with ``text`` rid of the repeated blocks of its site, ``removed_blocks`` and ``removed_lines``; the other lines stay as they are.

    Empty lines neither end a block nor are taken out. The blocks (a few hundred
    per site) are told to every executor if there are at most ``TOLD`` of them;
    else they travel per site with its documents, which are salted, so that a
    site with a third of all rows lies in many tasks.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("removed_blocks", "removed_lines")]  # columns of those names are replaced
    at_site, at_text = keep.index("site"), keep.index("text")
    hashes = F.transform(F.split("text", "\n"), lambda s: F.when(common_form(s) != "", F.xxhash64(common_form(s))))
    marked = docs.select(*keep, hashes.alias("_lines"))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + "removed_blocks int, removed_lines int"
    found = cut(blocks_of(docs, min_ids).select("site", "block"))

    def rid(text: str | None, ids: list | None, known: set) -> tuple[str | None, int, int]:
        if not text or not known:
            return text, 0, 0
        full = [k for k, h in enumerate(ids) if h is not None]
        spans = cover([ids[k] for k in full], known)
        gone = {full[j] for a, e in spans for j in range(a, e)}
        return "\n".join(s for k, s in enumerate(text.split("\n")) if k not in gone), len(spans), len(gone)

    def batch(b, results: list[tuple]):
        texts, blocks, lines = zip(*results) if results else ((), (), ())
        cols = [b.column(k) for k in range(len(keep))]
        cols[at_text] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.array(blocks, pa.int32()), pa.array(lines, pa.int32())], [*keep, "removed_blocks", "removed_lines"])

    if found.count() <= TOLD:
        sites: dict[str, set] = {}
        for r in found.toLocalIterator():
            sites.setdefault(r["site"], set()).add(tuple(r["block"]))
        shared = spark.sparkContext.broadcast(sites)

        def run(batches: Iterator) -> Iterator:
            known = shared.value
            for b in batches:
                yield batch(b, [rid(t, ids, known.get(s, ())) for s, t, ids in zip(b.column(at_site).to_pylist(), b.column(at_text).to_pylist(), b.column(len(keep)).to_pylist())])

        return marked.mapInArrow(run, schema)

    # Too many for every executor: each document gets those repeated blocks of its site that begin with one of its lines.
    salted = marked.withColumn("_row", F.monotonically_increasing_id())
    salted = cut(salted)
    first = salted.select("_row", "site", F.explode(F.array_distinct(F.array_compact("_lines"))).alias("_first"), F.pmod(F.hash("_row"), F.lit(SALTS)).alias("_salt"))
    heads = found.select("site", F.element_at("block", 1).alias("_first"), "block").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = first.join(heads.hint("merge"), ["site", "_first", "_salt"]).groupBy("_row").agg(F.collect_set("block").alias("_known"))

    def run_own(batches: Iterator) -> Iterator:
        for b in batches:
            yield batch(b, [rid(t, ids, {tuple(k) for k in known or ()}) for t, ids, known in zip(b.column(at_text).to_pylist(), b.column(len(keep)).to_pylist(), b.column(len(keep) + 1).to_pylist())])

    return salted.join(own.hint("merge"), "_row", "left").select(*keep, "_lines", "_known").mapInArrow(run_own, schema)
