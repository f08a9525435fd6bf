"""Writing results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wavemeld.functions.names import safe_label

PER_DATASET = "per_dataset"
#: Cells are written so that the readers give them back as they are: quotes doubled, blanks kept.
TEXT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False


def write_table(df: DataFrame, path: str | None, format: str = "csv") -> None:
    """Write a merged table as a folder of part files; no path, no write."""
    if path is None:
        return
    writer = df.write.mode("overwrite").format(format)
    (writer.options(**TEXT) if format == "csv" else writer).save(path)


def write_by_dataset(df: DataFrame, folder: str, name: Column, order: list[Column], columns: list[str]) -> None:
    """``;``-separated logs, one folder ``log=<name>`` per dataset, in one job.

    Rebalancing keeps small datasets in one file and splits a very large one.
    Only the folders of the datasets in ``df`` are replaced.
    """
    (df.withColumn("log", name).hint("rebalance", "log")
     .sortWithinPartitions("log", *order)
     .select(*columns, "log")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log")
     .options(**TEXT).option("sep", ";").csv(f"{folder}/{PER_DATASET}"))


def write_datasets(df: DataFrame, path: str | None, format: str = "csv") -> None:
    """Write tables that share a schema: a folder ``dataset=<label>_clean`` each.

    Rebalancing keeps a small dataset in one file and splits a large one.
    """
    if path is None:
        return
    named = df.withColumn("dataset", F.concat(safe_label("dataset"), F.lit("_clean"))).hint("rebalance", "dataset")
    writer = (named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("dataset").format(format))
    (writer.options(**TEXT) if format == "csv" else writer).save(path)
