"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lontar.plans.stage import cut, fresh_folder, sized  # noqa: F401

#: Words: runs of letters, digits or "_", compared in lower case.
WORD = re.compile(r"\w+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_of(url: Column) -> Column:
    """Host of an address in lower case, without user, port and a leading ``www.``; null if there is none."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host == "", None).otherwise(host)


def size_checked(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table that has to be small; fails, instead of collecting, beyond ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; raise the limit only if the driver and each executor can hold them")
    return rows
