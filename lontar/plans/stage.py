"""Cutting lineage in the shared folder the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the context has, else the one of ``spark.checkpoint.dir``.

    Where neither is set, a folder of our own is used on one machine only
    (removed at exit); a cluster without a shared folder is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="lontar-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, for a table of one run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Written once to the checkpoint folder, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if it has fewer partitions than there are: for work that costs far more than moving a small input. Inputs of many partitions stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows of a few narrow columns that are broadcast at most.
BROADCAST_ROWS = 200_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, cheap to count and narrow, as a side of a join: broadcast if it has at most ``rows`` rows, else by a sort-merge join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("merge")
