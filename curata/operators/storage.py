"""The folder that driver and executors share, and tables that cut lineage there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a local master gets a folder of its own; on a cluster that
    is an error, as each executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="curata-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fixed(df: DataFrame) -> DataFrame:
    """df, worked out once: what was placed in a partition stays there, whatever executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
