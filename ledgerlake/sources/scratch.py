"""Durable scratch space: the shared folder the session names for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    root = spark.conf.get(KEY, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set(KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable where only the session setting is there."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root. Nothing is created until something is written."""
    return f"{scratch_root(spark)}/ledgerlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts the lineage and gives the planner the true size."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
