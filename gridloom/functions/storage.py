"""Shared scratch space: the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder from the session; only where it is unset (tests) a temporary one."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise RuntimeError(f"Set {SETTING} to a folder that all executors share.")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/gridloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
