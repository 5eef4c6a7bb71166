"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``first_day, last_day, name`` of the months from ``first`` to ``last``, days as MM/dd/yyyy."""
    m = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    day = lambda c, f: F.date_format(c, f)
    end = F.last_day("m")
    name = F.concat(day("m", "MM_dd_yyyy"), F.lit("_to_"), day(end, "MM_dd_yyyy"), F.lit("_output.jsonl"))
    return m.select(day("m", "MM/dd/yyyy").alias("first_day"), day(end, "MM/dd/yyyy").alias("last_day"), name.alias("name"))
