"""Folders for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from wavemeld.sources.staging import file_system

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the session names.

    It is removed when the JVM ends; a table in it can be read until then.

    A session that names none must have its executors on this machine, as in
    tests: elsewhere each would write to its own disk, and that is an error.
    """
    shared = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if not shared and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
    base = shared or tempfile.mkdtemp(prefix="wavemeld-")
    path = f"{base.rstrip('/')}/wavemeld/{name}-{uuid.uuid4().hex}"
    fs, at = file_system(spark, path)
    fs.mkdirs(at)  # only a folder that is there can be put down for removal
    fs.deleteOnExit(at)
    fs.delete(at, False)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read, not the whole history.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
