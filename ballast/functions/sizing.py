"""Decisions that depend on how large something is, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of at most ~150 bytes each: about 30 MB in an executor's hash table.
MAX_BROADCAST_ROWS = 200_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Counts the rows; for reference tables a small job over narrow columns."""
    return df.count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the counted rows fit; otherwise leave the join
    to Catalyst and AQE, which shuffle both sides and split skewed partitions."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def sized_lookup(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """As ``sized_broadcast``, but beyond the bound both sides are shuffled for certain.
    For joins that make many rows of few, or whose other side was exploded: Catalyst takes
    that side for small, and would broadcast it and do the work in this side's few tasks."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df.hint("merge")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where that is unset,
    a temporary folder is used in local mode; on a cluster it would not be shared."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ballast-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written to the shared folder, survives executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate once as parquet and read it back, so that several
    outputs share it and its size is known to Catalyst."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
