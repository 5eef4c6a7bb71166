"""Exact and near duplicates: content hashes, SimHash with lossless Hamming tables, embeddings, cascades, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.plans.stage import cut, sized


def keep_first(df: DataFrame, signature: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each signature, in ``order`` (ties: any one of them).

    Only keys are aggregated, with partial steps; the rows that are not first,
    copies mostly, are taken out where they lie, so whole rows don't travel.
    """
    names = [f"_g{k}" for k in range(len(signature))]
    whole = cut(df.withColumns({n: F.md5(c.cast("string")) for n, c in zip(names, signature)}).withColumn("_row", F.monotonically_increasing_id()))  # numbers hold once written
    first = whole.groupBy(*names).agg(F.min(F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)), F.col("_row").alias("row"))).alias("_first"))
    kept = first.select(F.col("_first.row").alias("_kept"))
    gone = cut(whole.select("_row").join(kept.hint("merge"), F.col("_row") == F.col("_kept"), "left_anti"))
    return whole.join(sized(gone.withColumnRenamed("_row", "_gone")), F.col("_row") == F.col("_gone"), "left_anti").select(*df.columns)


def duplicate_members(df: DataFrame, kinds: dict[str, Column], member: str) -> DataFrame:
    """``kind, signature, members, member``: a row for each row of a group of several, by each of the signatures; null ones aside."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("signature")) for k, c in kinds.items())))
    each = df.select(pairs.alias("p"), F.col(member).alias("member")).select("p.kind", "p.signature", "member").where("signature IS NOT NULL")
    groups = each.groupBy("kind", "signature").agg(F.count("*").alias("members")).where("members > 1")
    return each.join(groups, ["kind", "signature"]).select("kind", "signature", "members", "member")


def duplicate_report(df: DataFrame, kinds: dict[str, Column], member: str, title: str, most: int = 5) -> DataFrame:
    """``kind, place, signature, members, first_member, title`` of the largest groups of each kind; titles are cut to 100 characters."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("signature")) for k, c in kinds.items())))
    each = df.select(pairs.alias("p"), F.struct(F.col(member).alias("m"), F.substring(title, 1, 100).alias("t")).alias("x")).select("p.kind", "p.signature", "x").where("signature IS NOT NULL")
    groups = each.groupBy("kind", "signature").agg(F.count("*").alias("members"), F.min("x").alias("x")).where("members > 1")
    w = Window.partitionBy("kind").orderBy(F.desc("members"), "x.m", "signature")
    return groups.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("kind", F.col("place").cast("long").alias("place"), "signature", "members", F.col("x.m").alias("first_member"), F.col("x.t").alias("title"))


def type_rates(cascaded: DataFrame) -> DataFrame:
    """``duplicate_type, documents, share, duplicate_rate, unique_rate`` of a ``cascade``; the two rates are of all documents."""
    by = cascaded.groupBy("duplicate_type").agg(F.count("*").alias("documents"))
    w = Window.partitionBy()  # a row per type
    every, unique = F.sum("documents").over(w), F.sum(F.when(F.col("duplicate_type") == "none", F.col("documents")).otherwise(0)).over(w)
    return by.select("duplicate_type", "documents", F.round(F.col("documents") / every, 6).alias("share"), F.round(1 - unique / every, 6).alias("duplicate_rate"), F.round(unique / every, 6).alias("unique_rate"))


def duplicate_groups(df: DataFrame, signature: Column, member: str) -> DataFrame:
    """``signature, members, first_member`` of signatures that several rows share; null signatures aside."""
    return df.select(signature.alias("signature"), F.col(member).alias("m")).where("signature IS NOT NULL").groupBy("signature").agg(F.count("*").alias("members"), F.min("m").alias("first_member")).where("members > 1")


def known(df: DataFrame, history: DataFrame, key: Column, history_key: str) -> DataFrame:
    """Rows of ``df`` whose key is in the history (each key once)."""
    keys = history.select(F.col(history_key).alias("_k")).where("_k IS NOT NULL").distinct()
    return df.withColumn("_key", key).join(keys, F.col("_key") == F.col("_k"), "left_semi").drop("_key")


def hamming_tables(signature: Column, distance: int, blocks: int = 6) -> Column:
    """Exploded keys: two signatures within ``distance`` bits share at least one of them (pigeonhole over ``blocks`` blocks)."""
    blocks = max(blocks, distance + 1)
    width = [64 // blocks + (k < 64 % blocks) for k in range(blocks)]
    start = np.concatenate(([0], np.cumsum(width)))
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << width[k]) - 1) << int(start[k]) for k in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(number).alias("no"), signature.bitwiseAND(F.lit(mask).cast("long")).alias("bits")))
    return F.explode(F.array(*keys))


def hamming_links(signatures: DataFrame, distance: int = 3) -> DataFrame:
    """``a < b, distance`` of different values of ``signatures`` (a column ``signature``, 64-bit) within ``distance`` bits.

    Copies of a value are one value; join the rows to it by ``signature``.
    """
    values = signatures.select("signature").where("signature IS NOT NULL").distinct()
    keyed = values.select(F.col("signature").alias("a"), hamming_tables(F.col("signature"), distance).alias("key"))
    other = keyed.select(F.col("a").alias("b"), "key")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return keyed.join(other, "key").where((F.col("a") < F.col("b")) & (apart <= distance)).select("a", "b", apart.cast("long").alias("distance")).distinct()


def link_counts(links: DataFrame, signatures: DataFrame) -> DataFrame:
    """``signature, members, links``: rows of each value, and how many other values are near it; values without links too."""
    both = links.select(F.col("a").alias("signature")).union(links.select("b")).groupBy("signature").agg(F.count("*").alias("links"))
    size = signatures.where("signature IS NOT NULL").groupBy("signature").agg(F.count("*").alias("members"))
    return size.join(both, "signature", "left").fillna(0, ["links"]).select("signature", "members", "links")


SALTS = 16


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) of the undirected edges ``a, b``."""
    both = cut(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        # A giant component would send all its nodes to one key: its root is copied to salts.
        tops = hooked.select("component").distinct().join(hooked.select(F.col("node").alias("component"), F.col("component").alias("above")), "component")
        tops = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = hooked.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
        step = cut(spread.join(tops, ["component", "salt"], "left").select("node", "old", F.least("component", F.coalesce("above", "component")).alias("component")))
        labels = step.select("node", "component")
        if step.where("component <> old").isEmpty():
            return labels
    raise RuntimeError(f"components haven't settled in {rounds} rounds")


def cascade(df: DataFrame, key: str, exact: str, signature: str, distance: int = 3, vector: str | None = None, least: float = 0.95) -> DataFrame:
    """``key, duplicate_type, duplicate_of, confidence``: against smaller keys, first by the exact hash, then by the signature, then by the vector (if one is named), else ``none``.

    The smallest key of an equal hash is the original. Near ones are told by the
    most alike, of equally alike ones by the smallest key; the confidence is
    their similarity (1 for exact ones, 0 for none). Null hashes, signatures and
    vectors match nothing.
    """
    cols = [F.col(key).alias("key"), F.col(exact).alias("exact"), F.col(signature).alias("signature"), *([F.col(vector).alias("vector")] if vector else [])]
    base = df.select(*cols)
    first = base.where("exact IS NOT NULL").groupBy("exact").agg(F.min("key").alias("exact_of"))
    # Copies of a signature are told by its smallest key, its holder; a holder by the nearest one of a smaller holder.
    holder = base.where("signature IS NOT NULL").groupBy("signature").agg(F.min("key").alias("holder"))
    links = hamming_links(base.select("signature"), distance)
    both = links.select("a", "b", "distance").union(links.select("b", "a", "distance"))
    met = both.join(holder.select(F.col("signature").alias("a"), F.col("holder").alias("mine")), "a").join(holder.select(F.col("signature").alias("b"), F.col("holder").alias("theirs")), "b")
    nearest_ = met.where("theirs < mine").groupBy(F.col("a").alias("signature")).agg(F.min(F.struct("distance", "theirs")).alias("near"))
    joined = base.join(first, "exact", "left").join(holder.join(nearest_, "signature", "left"), "signature", "left")
    copy = F.col("holder") < F.col("key")
    near = F.when(copy, F.struct(F.lit(0).cast("long").alias("distance"), F.col("holder").alias("theirs"))).otherwise(F.col("near"))
    out = joined.withColumns({"_exact": F.coalesce(F.col("exact_of") < F.col("key"), F.lit(False)), "_near": near})
    kind = F.when(F.col("_exact"), "exact").when(F.col("_near").isNotNull(), "near_simhash")
    of, sure = F.when(F.col("_exact"), F.col("exact_of")).otherwise(F.col("_near.theirs")), F.when(F.col("_exact"), 1.0).otherwise(1 - F.col("_near.distance") / 64)
    if vector:
        rest = cut(out.where(kind.isNull()).select("key", "vector"))
        alike = _vector_originals(base.select("key", "vector"), rest.select("key"), least)
        out = out.join(alike, "key", "left")
        kind, of, sure = F.coalesce(kind, F.when(F.col("vector_of").isNotNull(), "near_embedding")), F.coalesce(of, "vector_of"), F.coalesce(sure, "cosine")
    return out.select("key", F.coalesce(kind, F.lit("none")).alias("duplicate_type"), of.alias("duplicate_of"), F.round(F.coalesce(sure, F.lit(0.0)), 6).alias("confidence"))


def _vector_originals(vectors: DataFrame, wanted: DataFrame, least: float) -> DataFrame:
    """``key, vector_of, cosine``: of the wanted keys, the most alike vector of a smaller key."""
    hashed = vectors.where("vector IS NOT NULL").select("key", F.xxhash64("vector").alias("h"))
    holder = hashed.groupBy("h").agg(F.min("key").alias("holder"))
    links = lsh_links(vectors, "key", "vector", least)  # between holders
    near = links.select(F.col("b").alias("holder"), F.struct((-F.col("cosine")).alias("c"), F.col("a").alias("of")).alias("x")).groupBy("holder").agg(F.min("x").alias("x"))
    joined = hashed.join(holder, "h").join(near, "holder", "left").join(wanted, "key", "left_semi")
    copy = F.col("holder") < F.col("key")
    return joined.select("key", F.when(copy, F.col("holder")).otherwise(F.col("x.of")).alias("vector_of"), F.when(copy, 1.0).otherwise(-F.col("x.c")).alias("cosine")).where("vector_of IS NOT NULL")


#: Words of a text that an embedding sees.
EMBEDDED_WORDS = 512


def embedded(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], into: str = "embedding") -> DataFrame:
    """``df`` with ``into`` (the model's vector of the first ``EMBEDDED_WORDS`` words, as 32-bit numbers of unit length) and ``into_hash`` (SHA-256 of its bytes).

    ``model`` takes a list of texts and gives a matrix; no model is built in.
    Null and blank texts, and vectors without a length, have neither.
    """
    import pyarrow as pa

    keep = [c for c in df.columns if c not in (into, f"{into}_hash")]
    place = keep.index(text)

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        for b in batches:
            heads = [" ".join(t.split(None, EMBEDDED_WORDS)[:EMBEDDED_WORDS]) if t else "" for t in b.column(place).to_pylist()]
            filled = [k for k, t in enumerate(heads) if t]
            found = np.asarray(model([heads[k] for k in filled]), np.float64) if filled else np.zeros((0, 1))
            vectors, hashes = [None] * b.num_rows, [None] * b.num_rows
            for k, v in zip(filled, found):
                size = np.linalg.norm(v)
                if size > 0:
                    unit = (v / size).astype("<f4")
                    vectors[k], hashes[k] = unit.tolist(), sha256(unit.tobytes()).hexdigest()
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(vectors, pa.list_(pa.float32())), pa.array(hashes, pa.string())], [*keep, into, f"{into}_hash"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return df.select(*keep).mapInArrow(run, f"{schema}`{into}` array<float>, `{into}_hash` string")


def newest_candidates(df: DataFrame, order: str, group: str, size: int = 100) -> DataFrame:
    """``df`` with ``candidates``: how many earlier rows of its group, at most ``size``, it is compared with. A large group is numbered in ranges."""
    from lontar.operators.stats import numbered

    return numbered(df, [F.col(order)], [group]).withColumn("candidates", F.least(F.lit(size).cast("long"), F.col("number") - 1)).drop("number")


#: Values of query vectors sent to every executor at once.
QUERY_VALUES = 4_000_000


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int = 10, least: float | None = None) -> DataFrame:
    """``query, neighbour, cosine, place``: the ``k`` nearest vectors of each query by cosine, itself aside; ties by key.

    Queries go in blocks of bounded size to where the vectors lie; each batch
    keeps its best, and only those are shuffled. Null, empty and zero vectors,
    and ones of another length, are neither queries nor neighbours.
    """
    import pyarrow as pa

    spark = queries.sparkSession
    rows = queries.select(key, vector).where(F.col(vector).isNotNull() & (F.size(vector) > 0))
    total = rows.agg(F.sum(F.size(vector)).alias("n")).first()["n"] or 0
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"query {kind}, neighbour {kind}, cosine double"
    blocks, out = int(total // QUERY_VALUES) + 1, None
    for number in range(blocks):
        table = rows.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == number).toArrow()
        by_size: dict[int, list] = {}
        for i, v in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
            if None not in v and any(v):
                by_size.setdefault(len(v), []).append((i, v))
        shared = spark.sparkContext.broadcast({n: ([i for i, _ in x], _unit(np.array([v for _, v in x], np.float64))) for n, x in by_size.items()})

        def run(batches: Iterator, shared=shared) -> Iterator:
            for b in batches:
                by: dict[int, list] = {}
                for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if v and None not in v and any(v):
                        by.setdefault(len(v), []).append((i, v))
                found: list[tuple] = []
                for n, x in by.items():
                    if n not in shared.value:
                        continue
                    ids, unit = shared.value[n]
                    keys = [i for i, _ in x]
                    near = unit @ _unit(np.array([v for _, v in x], np.float64)).T
                    top = min(len(keys), k + 1)
                    for q, row in zip(ids, near):
                        bound = np.partition(row, len(row) - top)[len(row) - top]
                        if least is not None:
                            bound = max(bound, least)
                        found += [(q, keys[j], float(row[j])) for j in np.flatnonzero(row >= bound) if keys[j] != q]
                cols = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], b.schema.field(0).type), pa.array(cols[2], pa.float64())], ["query", "neighbour", "cosine"])

        one = vectors.select(key, vector).mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    w = Window.partitionBy("query").orderBy(F.desc(F.round("cosine", 9)), "neighbour")
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def lsh_links(vectors: DataFrame, key: str, vector: str, least: float = 0.95, tables: int = 12, bits: int = 14, seed: int = 7) -> DataFrame:
    """``a < b, cosine`` of vectors with a cosine of ``least`` or more, by tables of random hyperplanes.

    Two vectors of that cosine agree on a plane with probability
    ``1 - acos(least) / pi``; the defaults find 0.99 and more of the pairs at 0.95.
    Equal vectors are one, told by their hash; join the rows to it.
    """

    size = vectors.where(F.col(vector).isNotNull()).select(F.max(F.size(vector)).alias("n")).first()["n"] or 1
    planes = np.random.default_rng(seed).standard_normal((tables * bits, size))

    @F.pandas_udf("array<bigint>")
    def keys(column):
        import pandas as pd

        out = []
        for v in column:
            if v is None or len(v) != size or not np.any(v):
                out.append(None)
                continue
            side = planes @ np.asarray(v, np.float64) > 0
            out.append([int(t << 32 | int(np.packbits(side[t * bits : (t + 1) * bits], bitorder="little").view(np.uint16)[0] if bits > 8 else np.packbits(side[t * bits : (t + 1) * bits])[0])) for t in range(tables)])
        return pd.Series(out)

    one = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).where("v IS NOT NULL").groupBy(F.xxhash64("v").alias("h")).agg(F.min("id").alias("a"), F.first("v").alias("va"))
    keyed = cut(one.select("a", "va", keys("va").alias("keys")).where("keys IS NOT NULL"))
    left = keyed.select("a", F.explode("keys").alias("k"))
    pairs = left.join(left.select(F.col("a").alias("b"), "k"), "k").where("a < b").select("a", "b").distinct()
    both = pairs.join(keyed.select("a", "va"), "a").join(keyed.select(F.col("a").alias("b"), F.col("va").alias("vb")), "b")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    return both.withColumn("cosine", dot("va", "vb") / F.sqrt(dot("va", "va") * dot("vb", "vb"))).where(F.col("cosine") >= least).select("a", "b", "cosine")
