"""Discussion threads: nested trees to flat rows, replies joined in order, records for a corpus."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import language, thread_text_v1, thread_text_v2
from lontar.functions.urls import absolute_v1, absolute_v2, group_v1, group_v2


def either(*columns: Column) -> Column:
    """The first that is neither null nor empty, else ''."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def flatten_comments(threads: DataFrame, comments: str) -> DataFrame:
    """``threads`` (without its JSON column ``comments``) with ``place, depth, body`` per comment, in reading order from 0.

    The JSON is an array of ``{body, replies}`` of any depth, or a listing of
    ``{kind, data}``, of which only ``t1`` counts. What isn't JSON has no rows.
    """
    import pyarrow as pa

    keep = [c for c in threads.columns if c != comments]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows, places, depths, bodies = [], [], [], []
            for k, text in enumerate(b.column(len(keep)).to_pylist()):
                try:
                    top = json.loads(text) if text else []
                except ValueError:
                    continue
                stack = [(c, 0) for c in reversed(_children(top))]
                n = 0
                while stack:
                    c, depth = stack.pop()
                    rows.append(k), places.append(n), depths.append(depth), bodies.append(c.get("body") if isinstance(c.get("body"), str) else None)
                    n += 1
                    stack.extend((x, depth + 1) for x in reversed(_children(c.get("replies"))))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(j).take(at) for j in range(len(keep))), pa.array(places, pa.int64()), pa.array(depths, pa.int32()), pa.array(bodies, pa.string())], [*keep, "place", "depth", "body"])

    schema = ", ".join(f"`{c}` {threads.schema[c].dataType.simpleString()}" for c in keep)
    return threads.select(*keep, comments).mapInArrow(run, f"{schema}, place bigint, depth int, body string")


def _children(value: object) -> list[dict]:
    if isinstance(value, dict):  # a listing
        value = value.get("data", {}).get("children", []) if isinstance(value.get("data"), dict) else []
    if not isinstance(value, list):
        return []
    return [x["data"] if "kind" in x and isinstance(x.get("data"), dict) else x for x in value if isinstance(x, dict) and x.get("kind", "t1") == "t1"]


def joined_replies(comments: DataFrame, thread: str, body: str, order: list[str], gap: str = "\n\n", into: str = "replies_body") -> DataFrame:
    """``thread, into``: the filled bodies of each thread in order; '' if there are none.

    Comments are sorted in ranges, so a long thread lies in several tasks, each
    of which joins its part; only parts are joined per thread.
    """
    filled = comments.where(F.coalesce(F.col(body), F.lit("")) != "").select(thread, *order, F.col(body).alias("_body"))
    placed = filled.repartitionByRange(thread, *order).withColumn("_part", F.spark_partition_id())
    each = placed.groupBy(thread, "_part").agg(F.array_sort(F.collect_list(F.struct(*order, "_body"))).alias("_s"))
    parts = each.select(thread, "_part", F.array_join(F.transform("_s", lambda s: s["_body"]), gap).alias("_text"))
    whole = parts.groupBy(thread).agg(F.array_sort(F.collect_list(F.struct("_part", "_text"))).alias("_p"))
    joined = whole.select(F.col(thread).alias("_thread"), F.array_join(F.transform("_p", lambda s: s["_text"]), gap).alias("_text"))
    every = comments.select(thread).distinct()
    return every.join(joined, F.col(thread).eqNullSafe(F.col("_thread")), "left").select(thread, F.coalesce("_text", F.lit("")).alias(into))


def nested(comments: str | None) -> str | None:
    """``[{body, replies}]`` of a listing or a nested array of comments, as JSON; None for what isn't JSON."""
    try:
        top = json.loads(comments) if comments else []
    except ValueError:
        return None
    out: list = []
    stack = [(c, out) for c in reversed(_children(top))]
    while stack:
        c, into = stack.pop()
        one = {"body": c.get("body") if isinstance(c.get("body"), str) else None, "replies": []}
        into.append(one)
        stack.extend((x, one["replies"]) for x in reversed(_children(c.get("replies"))))
    return json.dumps(out, ensure_ascii=False)


def nested_comments(threads: DataFrame, comments: str, into: str = "comments") -> DataFrame:
    """``threads`` with the comments rebuilt to ``body`` and ``replies`` only."""
    import pyarrow as pa

    keep = [c for c in threads.columns if c not in (comments, into)]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array([nested(t) for t in b.column(len(keep)).to_pylist()], pa.string())], [*keep, into])

    schema = "".join(f"`{c}` {threads.schema[c].dataType.simpleString()}, " for c in keep)
    return threads.select(*keep, comments).mapInArrow(run, f"{schema}`{into}` string")


def prompt(comments: DataFrame, author: str, group: str, body: str, order: list[str], head: str) -> DataFrame:
    """``author, prompt``: ``head`` and the author's comments, one per line as ``group > body``."""
    line = F.concat(F.coalesce(F.col(group), F.lit("")), F.lit(" > "), F.replace(F.col(body), F.lit("\n"), F.lit(" <newline> ")))
    lines = joined_replies(comments.where(F.col(author).isNotNull()).withColumn("_line", line), author, "_line", order, "\n", "_lines")
    return lines.select(author, F.concat(F.lit(head), F.col("_lines")).alias("prompt"))


def records_v1(threads: DataFrame, title: Column, url: Column, body: Column, replies: Column, base: str = "https://www.reddit.com", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of the first converter, beside the columns ``keep``: everything cleaned to one line."""
    t, b, r = thread_text_v1(title), thread_text_v1(body), thread_text_v1(replies)
    return threads.select(*keep, language(F.concat_ws(" ", t, b, r)).alias("language"), absolute_v1(url, base).alias("source_url"), t.alias("thread_title"), b.alias("thread_body"), r.alias("replies_body"), F.lit("may_contain_spam").alias("clean_status"), group_v1(url).alias("subreddit"))


def records_v2(threads: DataFrame, title: Column, url: Column, body: Column, replies: Column, base: str = "https://www.reddit.com", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of the second converter, beside the columns ``keep``: lines are kept."""
    t, b, r, u = thread_text_v2(title), thread_text_v2(body), thread_text_v2(replies), absolute_v2(url, base)
    return threads.select(*keep, language(F.concat_ws(" ", t, b, r)).alias("language"), u.alias("source_url"), t.alias("thread_title"), b.alias("thread_body"), r.alias("replies_body"), F.lit("may_contain_spam").alias("clean_status"), group_v2(u).alias("subreddit"))
