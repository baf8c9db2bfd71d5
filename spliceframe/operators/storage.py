"""Cuts of lineage in the folder that all executors share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one for tests on a local master, else an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, computed once and held nowhere else: an eager checkpoint runs no other job before it writes."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
