"""Sinks: JSON lines, shards with a manifest, CSV, JSON arrays. All commit by Spark's file protocol."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.operators.stats import shards
from lontar.plans.stage import cut


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in UTF-8; null fields are left out."""
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_shards(df: DataFrame, path: str, order: list[Column], size: int = 10_000) -> None:
    """JSON lines in folders ``shard=n`` of at most ``size`` rows, in order."""
    numbered = shards(df, order, size)
    numbered.repartition("shard").sortWithinPartitions("shard", *order).write.partitionBy("shard").option("ignoreNullFields", True).json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``shard, file, bytes, checksum, entries`` of written shards."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    text = F.decode("content", "UTF-8")
    return files.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("checksum"), F.regexp_count(text, F.lit("\n")).cast("long").alias("entries"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_array(df: DataFrame, path: str, order: list[Column] | None = None, pretty: bool = False, mode: str = "errorifexists") -> None:
    """One JSON array in all, over files to be read in the order of their names: the first one opens it, the last one closes it.

    Rows are sorted in ranges by ``order`` and written where they lie, a row per
    line (or, ``pretty``, a field per line); nothing is collected.
    """
    placed = cut((df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).select(F.to_json(F.struct(*df.columns), {"pretty": str(pretty).lower(), "ignoreNullFields": "false"}).alias("r"), F.monotonically_increasing_id().alias("at")))
    ends = placed.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    if ends["a"] is None:
        df.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode(mode).text(path)
        return
    open_, close = F.when(F.col("at") == ends["a"], "[\n").otherwise(""), F.when(F.col("at") == ends["b"], "\n]").otherwise(",")
    placed.select(F.concat(open_, "r", close).alias("value")).write.mode(mode).text(path)


def write_report(summary: DataFrame, groups: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A duplicate report as one JSON object: the row of ``summary``, and the rows of ``groups`` (bounded: the largest few of each kind) under ``largest``."""
    listed = groups.agg(F.array_sort(F.collect_list(F.struct(*groups.columns))).alias("largest"))
    summary.limit(1).join(F.broadcast(listed)).select(F.to_json(F.struct(*summary.columns, "largest"), {"pretty": "true"}).alias("value")).coalesce(1).write.mode(mode).text(path)


def run_name(prefix: str, at: str | None = None) -> str:
    """``prefix_YYYYMMDD_HHMMSS``, of now or of an ISO time."""
    from datetime import datetime

    return f"{prefix}_{(datetime.fromisoformat(at) if at else datetime.now()).strftime('%Y%m%d_%H%M%S')}"


class State:
    """Keys and values that a run leaves for the next one: each ``put`` is a small file of its own, the last one of a key holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def put(self, **values: object) -> None:
        import json
        import time

        rows = [(k, json.dumps(v), time.time_ns()) for k, v in values.items()]
        self.spark.createDataFrame(rows, "key string, value string, at bigint").coalesce(1).write.mode("append").parquet(self.path)

    def get(self, key: str, default: object = None) -> object:
        import json

        try:
            rows = self.spark.read.schema("key string, value string, at bigint").parquet(self.path)
        except AnalysisException:  # nothing has been put yet
            return default
        row = rows.where(F.col("key") == key).agg(F.max_by("value", "at").alias("value")).first()
        return default if row["value"] is None else json.loads(row["value"])
