"""Problem 9: mixing sources to target weights, in tokens of a public tokenizer.

Method: every document gets a hash-random key; within a source the documents
are laid out in ranges of that key, token counts are summed up along them by a
two-level prefix sum (within a range by a window, over the ranges by a window
on their totals), and each source is cut exactly at its budget. A source whose
budget is beyond its size is repeated in whole epochs, at most ``max_repeats``
uses a document in all.

Defined results: null or empty texts count 0 tokens and are never selected;
documents whose source is null or has no target are left out; a target whose
source has no documents is reported with 0 tokens; repeated ``doc_id`` rows are
rows of their own; a null ``max_repeats`` is 1; a null or negative
``target_share`` is 0.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.common import cut, sized

#: Vocabulary of a public byte-level BPE tokenizer, as ranks.
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern published with that vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ranges of the key within a source; a range of a source with n documents holds about n / RANGES of them.
RANGES = 4096


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


#: Characters encoded at once; a longer text is cut before a space that follows a letter, where no token can reach across.
PIECE = 20_000


def _length(encoding, text: str) -> int:
    if len(text) <= PIECE:
        return len(encoding.encode_ordinary(text))
    n, at = 0, 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end += 1
        n += len(encoding.encode_ordinary(text[at:end]))
        at = end
    return n


def count_tokens(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens`` of ``docs`` (``doc_id, source, text``); the text doesn't leave its partition."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        encoding = _encoding(tokenizer)
        for b in batches:
            n = [_length(encoding, t) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), "text").mapInArrow(run, f"doc_id {kind}, source string, n_tokens bigint")


def budgets(counts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per target: the source's size, its budget, and how far it gets there.

    ``total_tokens`` is the size asked for; by default the size of all documents
    that have a target. A budget is rounded down to whole tokens.
    """
    target = targets.groupBy("source").agg(
        F.greatest(F.coalesce(F.max("target_share"), F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(1)), F.lit(0)).cast("long").alias("max_repeats")
    ).where("source IS NOT NULL")
    size = counts.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("documents"))
    joined = target.join(size, "source", "left").fillna(0, ["available_tokens", "documents"])
    joined = cut(joined)  # a row per target
    if total_tokens is None:
        total_tokens = joined.agg(F.sum("available_tokens").alias("n")).first()["n"] or 0
    joined = joined.withColumn("total_tokens", F.lit(int(total_tokens)).cast("long"))
    return (
        joined.withColumn("budget_tokens", F.floor(F.col("target_share") * F.col("total_tokens") + F.lit(1e-6)).cast("long"))
        .withColumn("used_tokens", F.least("budget_tokens", F.col("available_tokens") * F.col("max_repeats")))
        .withColumn("epochs", F.when(F.col("available_tokens") > 0, F.floor(F.col("used_tokens") / F.col("available_tokens"))).otherwise(0).cast("long"))
        .withColumn("rest_tokens", F.col("used_tokens") - F.col("epochs") * F.col("available_tokens"))
    )


def report(plan: DataFrame) -> DataFrame:
    """Target and really reached shares; ``short_tokens`` is what a source lacks to its budget."""
    used = plan.agg(F.sum("used_tokens").alias("n")).first()["n"] or 0
    return plan.withColumn("all_used", F.lit(int(used)).cast("long")).select(
        "source", "target_share", "max_repeats", "documents", "available_tokens", "budget_tokens", "used_tokens",
        (F.col("budget_tokens") - F.col("used_tokens")).alias("short_tokens"),
        F.when(F.col("available_tokens") > 0, F.col("used_tokens") / F.col("available_tokens")).otherwise(0.0).alias("repeats"),
        F.when(F.col("all_used") > 0, F.col("used_tokens") / F.col("all_used")).otherwise(0.0).alias("reached_share"),
    )


def select(counts: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """``doc_id, source, n_tokens, copies, used_tokens``: how often each document is used, and its tokens in all.

    The document at the cut is used in part: its ``used_tokens`` are what is
    left of the budget, so that each source gives its budget to the token.
    """
    keyed = (
        counts.where("n_tokens > 0")
        .join(sized(plan.where("used_tokens > 0").select("source", "epochs", "rest_tokens")), "source")  # a row per target
        .withColumn("mix_key", F.xxhash64(F.lit(seed), "source", "doc_id"))
        .withColumn("mix_range", F.pmod(F.shiftright("mix_key", 52), F.lit(RANGES)).cast("int"))
    )
    within = Window.partitionBy("source", "mix_range").orderBy("mix_key", "doc_id", "n_tokens")
    totals = keyed.groupBy("source", "mix_range").agg(F.sum("n_tokens").alias("range_tokens"))
    start = totals.withColumn("range_start", F.sum("range_tokens").over(Window.partitionBy("source").orderBy("mix_range")) - F.col("range_tokens")).drop("range_tokens")
    before = keyed.withColumn("inside", F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")).join(start, ["source", "mix_range"])
    part = F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest_tokens") - F.col("range_start") - F.col("inside")))
    return (
        before.withColumn("part", part)
        .select("doc_id", "source", "n_tokens", (F.col("epochs") + (F.col("part") > 0).cast("long")).alias("copies"), (F.col("epochs") * F.col("n_tokens") + F.col("part")).alias("used_tokens"))
        .where("copies > 0")
    )
