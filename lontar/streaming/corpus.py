"""The same operators on streams: incremental cleaning and deduplication, windows with watermarks, rate limits with state.

Offsets, state and progress live in the checkpoint folder a query is given, so
a stopped query goes on where it was; ``available_now`` runs over what there is
and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lontar.functions import ids, text, urls
from lontar.operators import quality


def read_files(spark: SparkSession, path: str, schema: StructType, format: str = "json", files: int | None = None) -> DataFrame:
    """Files of a folder as they come in; a single file is a stream of one."""
    reader = spark.readStream.schema(schema).format(format)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return reader.option("pathGlobFilter", p.getName()).load(p.getParent().toString())
    return reader.load(path)


def clean_articles(stream: DataFrame) -> DataFrame:
    """Stateless part of the news pipeline: cleaned, gated, with its content hash and site."""
    formed = stream.withColumns({"text": text.news_text(F.col("text")), "title": text.news_text(F.col("title"))})
    good = formed.where(quality.clean_status(F.col("title"), F.col("text")) == "clean")
    return good.withColumns({"content_hash": ids.content_hash(F.col("text")), "site": urls.domain(F.col("source_url"))})


def first_seen(stream: DataFrame, key: str, at: str, within: str = "30 days") -> DataFrame:
    """The first row of each key; a key is forgotten when the watermark has passed its time by ``within``."""
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, key: str, at: str, length: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Rows and their span per key and window; rows later than ``late`` are dropped."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("rows")).select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rows")


def sessions(stream: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("rows")).select(key, F.col("w.start").alias("session_start"), "rows")


def limited(stream: DataFrame, key: str, at: str, most: int, seconds: int = 60, late: str = "10 minutes") -> DataFrame:
    """``key, at, allowed``: whether a request is within ``most`` per ``seconds`` of its key, counting allowed ones.

    The state is the times of the allowed requests in the window, at most
    ``most`` of them; it is dropped when the watermark has passed the window of
    a key that has been quiet.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def run(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept = list(state.get[0]) if state.exists else []
        for frame in frames:
            out = []
            for t in sorted(int(x) for x in frame["_at"]):
                kept = [x for x in kept if x >= t - seconds * 1_000_000]
                ok = len(kept) < most
                if ok:
                    kept.append(t)
                out.append((k[0], t, ok))
            yield pd.DataFrame(out, columns=[key, "_at", "allowed"])
        state.update((kept,))
        state.setTimeoutTimestamp(max(kept[-1] // 1000 + seconds * 1000 if kept else 0, state.getCurrentWatermarkMs()) + 1)

    kind = stream.schema[key].dataType.simpleString()
    timed = stream.withWatermark(at, late).select(key, at, F.unix_micros(F.col(at).cast("timestamp")).alias("_at"))
    out = timed.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, _at bigint, allowed boolean", "kept array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(key, F.timestamp_micros("_at").alias(at), "allowed")


def accept(stream: DataFrame, history: str, out: str, checkpoint: str, key: str = "content_hash", available_now: bool = True) -> StreamingQuery:
    """Appends rows of unknown keys to ``out`` and their keys to ``history``, batch by batch.

    Both are written in folders named after the batch, replaced if a batch is
    run again, so a batch counts once even if it fails half-way.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.dropDuplicates([key]).where(F.col(key).isNotNull()).persist()
        try:
            known = spark.read.schema(f"`{key}` string, batch bigint").parquet(history).where(F.col("batch") != number).select(key)
            fresh = batch.join(known, key, "left_anti")
        except Exception as e:  # there is no history before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            fresh = batch
        fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")
        spark.read.parquet(f"{out}/batch={number}").select(key).write.mode("overwrite").parquet(f"{history}/batch={number}")
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()


def loop(stream: DataFrame, folder: str, each: Callable[[DataFrame, int], int], export: Callable[[DataFrame, int], None], checkpoint_rows: int = 1_000, cleanup_rows: int = 10_000, cleanup: Callable[[], None] | None = None, seconds: float = 5, available_now: bool = False) -> StreamingQuery:
    """The endless run: every batch is worked on by ``each`` (which gives the number of rows taken), then exported; the counters are put down after every ``checkpoint_rows`` rows, and old state is cleaned up after every ``cleanup_rows``.

    The counters go on after a restart; a batch that is run again isn't counted twice.
    """
    from lontar.sources.sinks import State

    state = State(stream.sparkSession, f"{folder}/state")
    done = {"rows": 0, "batch": -1, "put": 0, "cleaned": 0} | (state.get("progress") or {})

    def run(batch: DataFrame, number: int) -> None:
        taken = each(batch, number)
        export(batch, number)
        if number <= done["batch"]:
            return
        done["rows"], done["batch"] = done["rows"] + taken, number
        if cleanup and done["rows"] - done["cleaned"] >= cleanup_rows:
            cleanup()
            done["cleaned"] = done["rows"]
        if done["rows"] - done["put"] >= checkpoint_rows:
            done["put"] = done["rows"]
            state.put(progress=done)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")).start()


def until_stopped(query: StreamingQuery, hours: float | None = None, poll: float = 1.0) -> str:
    """Waits for a query; ``interrupt`` and ``terminate`` signals, or the end of ``hours``, stop it once its batch is through. Gives why it ended: ``signal``, ``time`` or ``done``."""
    import signal
    import time

    why: list[str] = []
    old = {s: signal.signal(s, lambda *_: why.append("signal")) for s in (signal.SIGINT, signal.SIGTERM)}
    end = None if hours is None else time.monotonic() + 3600 * hours
    try:
        while query.isActive and not why:
            query.awaitTermination(poll)
            if end is not None and time.monotonic() >= end:
                why.append("time")
        if query.isActive:
            while query.status["isTriggerActive"] and query.isActive:
                time.sleep(poll / 10)
            query.stop()
    finally:
        for s, handler in old.items():
            signal.signal(s, handler)
    return why[0] if why else "done"


def forget(spark: SparkSession, history: str, at: str, days: int = 30, now: str | None = None) -> int:
    """Rewrites a table of keys without those older than ``days``; gives the number of rows kept. The new table is complete before it takes the old one's place."""
    rows = spark.read.parquet(history)
    limit = (F.lit(now).cast("timestamp") if now else F.current_timestamp()) - F.make_dt_interval(F.lit(days))
    rows.where((F.col(at) >= limit) | F.col(at).isNull()).write.mode("overwrite").parquet(f"{history}.new")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = jvm.Path(history), jvm.Path(f"{history}.new")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.rename(new, old)
    return spark.read.parquet(history).count()


def to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs over what there is into an in-memory table, for tests and small results."""
    return stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
