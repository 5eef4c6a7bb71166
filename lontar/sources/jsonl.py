"""JSON sources: lines, arrays, wrapped and cut-off arrays, listings; all tolerant of broken parts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from lontar.plans.stage import sized


def read_lines(spark: SparkSession, paths: str | list[str], schema: StructType, numbered: bool = False, keep_broken: bool = False) -> DataFrame:
    """JSON lines by ``schema``; lines that are no JSON are left out (or kept, in ``_corrupt_record``).

    ``numbered`` adds ``file`` and ``line_number`` (from 1, broken and empty
    lines count), by which the lines of a folder are in order.
    """
    if not numbered:
        return parse_lines(spark.read.text(paths).where(F.trim("value") != ""), "value", schema, (), keep_broken)
    return parse_lines(numbered_lines(spark, paths).where(F.trim("value") != ""), "value", schema, ("file", "line_number"), keep_broken)


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, line_number, value`` of all lines of text files.

    A large file is read in blocks by several tasks: lines are counted per
    block, and the blocks before are added, so no task sees a whole file.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = blocks.withColumn("_before", F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")).drop("_n")  # a row per block of a file
    known = sized(before.select(F.col("file").alias("_file"), F.col("_block").alias("_b"), "_before", "_first"))
    return lines.join(known, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_b"))).select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_number"), "value")


def read_folder(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.jsonl") -> DataFrame:
    """Lines of all files of a folder in the order of file names, and of lines within a file: ``file, line_number`` and the fields, sorted."""
    return read_lines(spark, f"{folder.rstrip('/')}/{pattern}", schema, numbered=True).orderBy("file", "line_number")


def parse_lines(df: DataFrame, column: str, schema: StructType, extra: tuple[str, ...] = (), keep_broken: bool = False) -> DataFrame:
    """The same for lines in a column; columns of ``extra`` are kept beside the fields."""
    whole = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    parsed = df.withColumn("_r", F.from_json(column, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    if keep_broken:
        return parsed.select("_r.*", *extra)
    return parsed.where("_r IS NOT NULL AND _r._corrupt_record IS NULL").select("_r.*", *extra).drop("_corrupt_record")


def read_array(spark: SparkSession, path: str, schema: StructType, limit: int | None = None) -> DataFrame:
    """Files that are one JSON array each; anything else is an error."""
    other = spark.read.text(path, wholetext=True).where(~F.col("value").rlike("^[\\x{feff}\\s]*\\[")).select(F.col("_metadata.file_path").alias("file")).first()
    if other is not None:
        raise ValueError(f"no JSON array: {other['file']}")
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df if limit is None else df.limit(limit)


def objects_in(text: str) -> Iterator[dict]:
    """Objects of a JSON array that may be cut off or broken: each that can be read, from the first ``[`` on."""
    decoder, at = json.JSONDecoder(), text.find("[")
    while 0 <= at < len(text):
        at = text.find("{", at)
        if at < 0:
            return
        try:
            value, at = decoder.raw_decode(text, at)
        except ValueError:
            at = _after_object(text, at)
            if at is None:
                return
            continue
        if isinstance(value, dict):
            yield value


def _after_object(text: str, at: int) -> int | None:
    """Place after the object that begins at ``at``, by its braces; None if it is cut off."""
    depth, quoted, escaped = 0, False, False
    for k in range(at, len(text)):
        c = text[k]
        if quoted:
            escaped, quoted = (not escaped and c == "\\"), not (c == '"' and not escaped)
        elif c == '"':
            quoted = True
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                return k + 1
    return None


def sniffed(text: str) -> list[dict]:
    """Objects of a text of any of the forms: lines if it begins with ``{`` (each may wrap more in ``data``), else an array, else what can be saved of one."""
    head = text.lstrip()
    if head[:1] == "{":
        out = []
        for line in text.splitlines():
            try:
                value = json.loads(line)
            except ValueError:
                continue
            if isinstance(value, dict):
                out += [x for x in value["data"] if isinstance(x, dict)] if isinstance(value.get("data"), list) else [value]
        return out
    try:
        value = json.loads(text)
        return [x for x in (value if isinstance(value, list) else value.get("data", [])) if isinstance(x, dict)]
    except (ValueError, AttributeError):
        return list(objects_in(text))


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, thread`` (JSON text) of thread files of any form; a file is read as a whole, as an array can't be split."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows, places, found = [], [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                for n, x in enumerate(sniffed(text or "")):
                    rows.append(k), places.append(n), found.append(json.dumps(x, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int64()), pa.array(found, pa.string())], ["file", "place", "thread"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return files.mapInArrow(run, "file string, place bigint, thread string")


def listing_posts(df: DataFrame, column: str) -> DataFrame:
    """Posts of listing JSON: ``title, author, permalink, score, num_comments, created_utc, image_url, thumbnail_url, description``."""
    post = "title string, author string, permalink string, score int, num_comments int, created_utc double, post_hint string, url string, thumbnail string, selftext string, preview struct<images:array<struct<source:struct<url:string>>>>"
    parsed = df.select(F.from_json(column, f"data struct<children:array<struct<kind:string,data:struct<{', '.join(f.replace(' ', ':', 1) for f in post.split(', '))}>>>>").alias("r"))
    rows = parsed.select(F.explode("r.data.children").alias("c")).where(F.coalesce(F.col("c.kind"), F.lit("t3")) == "t3").select("c.data.*")
    image = F.when(F.col("post_hint") == "image", F.col("url")).otherwise(F.try_element_at(F.col("preview.images"), F.lit(1))["source"]["url"])
    return rows.select("title", "author", "permalink", "score", "num_comments", "created_utc", image.alias("image_url"), F.when(F.col("thumbnail") != "self", F.col("thumbnail")).alias("thumbnail_url"), F.substring("selftext", 1, 269).alias("description"))


def cursor(df: DataFrame, column: str) -> DataFrame:
    """``after``: the cursor of each listing, from which the next page is read; null on the last one."""
    return df.select(F.nullif(F.get_json_object(column, "$.data.after"), F.lit("")).alias("after"))


def paged(read: Callable[[str | None], str | None], most: int | None = None) -> Iterator[str]:
    """Listings one after the other, each read from the cursor of the one before, until there is no cursor, nothing is read, or ``most`` posts have come."""
    after, seen, count = None, set(), 0
    while True:
        page = read(after)
        try:
            data = json.loads(page)["data"] if page else None
        except (ValueError, KeyError, TypeError):
            return
        if not data or not data.get("children"):
            return
        yield page
        count += len(data["children"])
        after = data.get("after")
        if not after or after in seen or (most is not None and count >= most):
            return
        seen.add(after)


def post_details(df: DataFrame, column: str) -> DataFrame:
    """``title, body, comments`` of a post's page, which is an array of two listings: the post, and its comments as JSON for ``threads.flatten_comments``; null fields for what isn't one."""
    post = F.get_json_object(column, "$[0].data.children[0].data")
    return df.select(*(c for c in df.columns if c != column), F.get_json_object(post, "$.title").alias("title"), F.coalesce(F.get_json_object(post, "$.selftext"), F.when(post.isNotNull(), F.lit(""))).alias("body"), F.get_json_object(column, "$[1]").alias("comments"))


def user_activity(df: DataFrame, column: str) -> DataFrame:
    """Rows of a user's feed: posts (``t3``) and comments (``t1``) told apart by ``kind``."""
    data = "title:string,subreddit:string,url:string,body:string,created_utc:double,permalink:string"
    parsed = df.select(F.explode(F.from_json(column, f"data struct<children:array<struct<kind:string,data:struct<{data}>>>>")["data"]["children"]).alias("c"))
    kind = F.when(F.col("c.kind") == "t3", "post").when(F.col("c.kind") == "t1", "comment")
    return parsed.withColumn("type", kind).where("type IS NOT NULL").select("type", F.when(F.col("type") == "post", F.col("c.data.title")).alias("title"), F.col("c.data.subreddit").alias("subreddit"), F.when(F.col("type") == "post", F.col("c.data.url")).otherwise(F.col("c.data.permalink")).alias("url"), F.when(F.col("type") == "comment", F.col("c.data.body")).alias("body"), F.col("c.data.created_utc").alias("created_utc"))
