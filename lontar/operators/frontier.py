"""Scheduling of addresses: eligibility, order within a domain, sliding rate limits, politeness, retries, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _micros(column: str) -> Column:
    """Microseconds of a timestamp with or without a zone."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def eligible(status: Column, next_attempt: Column, now: Column) -> Column:
    return (status == "pending") & (next_attempt.isNull() | (next_attempt <= now))


def next_per_domain(df: DataFrame, domain: str, order: list[Column], n: int) -> DataFrame:
    """The ``n`` first rows of each domain, and their ``place``; Spark keeps only ``n`` per group before the shuffle."""
    w = Window.partitionBy(domain).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def within_window(df: DataFrame, key: str, at: str, seconds: int = 60) -> DataFrame:
    """``df`` with ``in_window``: rows of the key in the last ``seconds``, both ends and itself included."""
    t = _micros(at)
    w = Window.partitionBy(key).orderBy("_t").rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("_t", t).withColumn("in_window", F.count(F.lit(1)).over(w)).drop("_t")


def since_previous(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """``df`` with ``gap_seconds`` since the key's row before."""
    w = Window.partitionBy(key).orderBy(at, tie)
    return df.withColumn("gap_seconds", (_micros(at) - F.lag(_micros(at)).over(w)) / 1e6)


def after_failure(df: DataFrame, attempts: str, at: str, most: int = 3, wait: int = 3600) -> DataFrame:
    """State after a failed attempt: tried again after ``wait`` seconds, or ``failed`` after ``most`` attempts."""
    tried = F.col(attempts) + 1
    return df.withColumns({attempts: tried, "status": F.when(tried >= most, "failed").otherwise("pending"), "next_attempt": F.when(tried < most, F.timestamp_micros(_micros(at) + wait * 1_000_000))})


def expired(created: Column, now: Column, days: int = 30) -> Column:
    return created < now - F.make_dt_interval(F.lit(days))


def first_streak(df: DataFrame, group: str, order: str, empty: Column, length: int = 5) -> DataFrame:
    """``group, stop_at``: where the first run of ``length`` empty rows in a row ends (gaps and islands); groups without one have no row."""
    w = Window.partitionBy(group).orderBy(order)
    island = df.withColumn("_e", empty.cast("int")).withColumn("_island", F.sum(1 - F.col("_e")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = island.where("_e = 1").withColumn("_k", F.row_number().over(Window.partitionBy(group, "_island").orderBy(order)))
    return run.where(F.col("_k") == length).groupBy(group).agg(F.min(order).alias("stop_at"))


def round_robin(df: DataFrame, order: list[Column], workers: int) -> DataFrame:
    """``df`` with ``worker``: the rows in order go to the workers 0, 1, 2 ... in turn, and lie in as many partitions."""
    from lontar.operators.stats import numbered

    return numbered(df, order).withColumn("worker", ((F.col("number") - 1) % workers).cast("int")).drop("number").repartition(workers, "worker")


def with_rate(df: DataFrame, rates: DataFrame, key: str, rate: str, default: float) -> DataFrame:
    """``df`` with the ``rate`` of its key, or the default one."""
    from lontar.plans.stage import sized

    known = rates.select(F.col(key).alias("_key"), F.col(rate).alias("_rate")).where("_key IS NOT NULL").groupBy("_key").agg(F.max("_rate").alias("_rate"))
    return df.join(sized(known), F.col(key) == F.col("_key"), "left").withColumn(rate, F.coalesce("_rate", F.lit(default))).drop("_key", "_rate")


def last_page(pages: DataFrame, group: str, page: str, found: str, target: int, empty: int = 5, resume: int = 1) -> DataFrame:
    """``group, stop_at, reason``: the page on which paging from ``resume`` on ends: the target is reached, ``empty`` empty pages in a row, or there are no more.

    ``found`` is the number of new addresses of a page.
    """
    seen = pages.where(F.col(page) >= resume)
    w = Window.partitionBy(group).orderBy(page)
    total = seen.withColumn("_total", F.sum(F.coalesce(found, F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    enough = total.where(F.col("_total") >= target).groupBy(group).agg(F.min(page).alias("_enough"))
    dry = first_streak(seen, group, page, F.coalesce(F.col(found), F.lit(0)) == 0, empty).withColumnRenamed("stop_at", "_dry")
    last = seen.groupBy(group).agg(F.max(page).alias("_last")).join(enough, group, "left").join(dry, group, "left")
    stop = F.least("_enough", "_dry", "_last")
    reason = F.when(stop == F.col("_enough"), "target").when(stop == F.col("_dry"), "empty").otherwise("end")
    return last.select(group, stop.alias("stop_at"), reason.alias("reason"))


def look_ahead(pages: DataFrame, group: str, page: str, found: str, after: int = 10, ahead: int = 3) -> DataFrame:
    """``group, stop_at``: the first page beyond ``after`` that is empty as well as the ``ahead`` - 1 pages behind it; groups without one have no row."""
    w = Window.partitionBy(group).orderBy(page).rowsBetween(0, ahead - 1)
    rest = pages.withColumns({"_found": F.sum(F.coalesce(found, F.lit(0))).over(w), "_pages": F.count(F.lit(1)).over(w)})
    return rest.where((F.col(page) > after) & (F.col("_found") == 0) & (F.col("_pages") == ahead)).groupBy(group).agg(F.min(page).alias("stop_at"))
