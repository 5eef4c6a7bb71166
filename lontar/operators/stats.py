"""Corpus statistics, ratios, histograms and running positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def histograms(df: DataFrame, columns: list[str], text: str, title: str) -> DataFrame:
    """One row per value of each column and one in all (``field`` null): ``field, value, records, text_chars, title_chars, mean_text, mean_title`` (floored means); missing values are ``unknown``."""
    filled = df.select(*(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")).alias(c) for c in columns), F.length(F.coalesce(text, F.lit(""))).alias("_t"), F.length(F.coalesce(title, F.lit(""))).alias("_h"))
    pairs = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")), *(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns))
    out = filled.select(F.explode(pairs).alias("p"), "_t", "_h").groupBy("p.field", "p.value").agg(F.count("*").alias("records"), F.sum("_t").alias("text_chars"), F.sum("_h").alias("title_chars"))
    return out.withColumns({"mean_text": F.floor(F.col("text_chars") / F.col("records")), "mean_title": F.floor(F.col("title_chars") / F.col("records"))})


def duplicate_summary(groups: DataFrame, total: DataFrame) -> DataFrame:
    """One row: ``groups, members, records, unique_records, duplicate_rate`` (per cent); ``groups`` has ``members``, ``total`` one row with ``records``."""
    g = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("members"), F.lit(0)).alias("members"), F.lit(0).cast("long").alias("records"))
    both = g.union(total.select(F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("records")))
    out = both.agg(*(F.sum(c).alias(c) for c in ("groups", "members", "records")))
    return out.withColumns({"unique_records": F.col("records") - (F.col("members") - F.col("groups")), "duplicate_rate": F.when(F.col("records") > 0, F.round(100 * F.col("members") / F.col("records"), 6)).otherwise(0.0)})


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 if there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def per_minute(count: Column, seconds: Column) -> Column:
    return count / F.greatest(seconds / 60, F.lit(1.0))


def per_day(count: Column, seconds: Column) -> Column:
    return count / F.greatest(seconds / 86_400, F.lit(1.0))


def with_percentages(counts: DataFrame, part: str = "records", by: str = "field") -> DataFrame:
    """``histograms`` with ``percent``, of all records of the field."""
    whole = F.sum(part).over(Window.partitionBy(by))  # a row per value: counts, not records
    return counts.withColumn("percent", F.round(100 * ratio(F.col(part), whole), 6))


def increment(totals: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Running totals after ``new``: all other columns are summed up per key, new keys are added."""
    both = new if totals is None else totals.select(*new.columns).unionByName(new)
    return both.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in new.columns if c not in keys))


def export_summary(exported: Column, failed: Column) -> list[Column]:
    """Aggregates ``exported, failed, success_rate`` (0 if there is nothing)."""
    done, lost = F.count_if(exported), F.count_if(failed)
    return [done.alias("exported"), lost.alias("failed"), F.round(done / F.greatest(done + lost, F.lit(1)), 6).alias("success_rate")]


def tally(months: DataFrame, month: str, success: Column, seconds: Column, planned: int) -> DataFrame:
    """One row: ``succeeded, failed, mean_seconds, eta_seconds`` of finished months; the estimate is for what is left of ``planned``."""
    one = months.groupBy(month).agg(F.min(success.cast("int")).alias("_ok"), F.sum(seconds).alias("_s"))
    out = one.agg(F.count_if(F.col("_ok") == 1).alias("succeeded"), F.count_if(F.coalesce(F.col("_ok"), F.lit(0)) == 0).alias("failed"), F.coalesce(F.avg("_s"), F.lit(0.0)).alias("mean_seconds"))
    return out.withColumn("eta_seconds", F.greatest(F.lit(0), planned - F.col("succeeded") - F.col("failed")) * F.col("mean_seconds"))


def numbered(df: DataFrame, order: list[Column], within: list[str] | None = None) -> DataFrame:
    """``df`` with ``number`` (from 1) in the order of all rows, or of those of equal columns ``within``, without one task for all: rows are sorted in ranges, whose sizes are summed up."""
    from lontar.plans.stage import cut, sized

    keys = within or []
    placed = cut(df.repartitionByRange(*(F.col(c) for c in keys), *order).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range", *keys).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_n")).drop("_n")  # a row per range and key
    w = Window.partitionBy("_range", *keys).orderBy(*order)
    ranked = placed.withColumn("_row", F.row_number().over(w))
    on = ranked["_range"].eqNullSafe(before["_range"])
    for c in keys:
        on = on & ranked[c].eqNullSafe(before[c])
    return ranked.join(sized(before), on).select(*(ranked[c] for c in df.columns), (F.col("_before") + F.col("_row")).alias("number"))


def first_seen(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``key, place``: the different values in the order in which they first come."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))).alias("_first"))
    return numbered(first, [F.col("_first")]).select(key, F.col("number").alias("place"))


def shards(df: DataFrame, order: list[Column], size: int = 10_000) -> DataFrame:
    """``df`` with ``shard`` (from 0): ``size`` rows each."""
    return numbered(df, order).withColumn("shard", F.floor((F.col("number") - 1) / size).cast("long")).drop("number")
