"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, or the context's own checkpoint folder.

    Where neither is set, a local session gets a temporary folder. On a cluster each executor would
    write to a disk of its own, so that raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not runs_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerq-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def runs_local(master: str) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    return master == "local" or master.startswith("local[")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/ledgerq/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write the frame as a table and read it back.

    The plan that follows starts at the table: it is computed once, and a lost executor costs a
    re-read, not the lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
