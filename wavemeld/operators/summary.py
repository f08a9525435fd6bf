"""Frequency tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavemeld.functions.cells import string_form
from wavemeld.spec import Spec


def sum_up(df: DataFrame, var: str, config: Spec, category: bool = False, digits: int = 1) -> DataFrame:
    """Count and share of each value; ``category`` shows labels in declared order.

    The grand total is a scalar subquery over the counted groups, not a window
    over them, so a variable with very many values stays distributed; the
    subquery reuses the shuffle of the counts, so the table is read once.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("`df` must be a DataFrame.")
    if var not in config or not config[var].values:
        raise ValueError(f"No value_map found for variable '{var}'.")
    counts = df.groupBy(F.col(f"`{var}`")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    table = counts.withColumn("pct", F.bround(F.lit(100.0) * F.col("n") / total, digits))
    return decode_groups(table, var, config) if category else table


def decode_groups(table: DataFrame, var: str, config: Spec) -> DataFrame:
    """Replace codes by labels; an undeclared code has none."""
    codes = config.value_frame(table.sparkSession, var).select(
        F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("ord").alias("_ord"))
    text = string_form(F.col(f"`{var}`"), dict(table.dtypes)[var])
    return (table.join(codes, text == F.col("_code"), "left")
            .orderBy(F.col("_ord").asc_nulls_last())
            .select(F.col("_label").alias(var), *[F.col(f"`{c}`") for c in table.columns if c != var]))


def label_decode(df: DataFrame, var: str, config: Spec, out: str) -> DataFrame:
    """Add the label of a code; undeclared codes get NULL."""
    codes = config.value_frame(df.sparkSession, var).select(F.col("code").alias("_code"), F.col("label").alias(out))
    text = string_form(F.col(f"`{var}`"), dict(df.dtypes)[var])
    return df.join(codes, text == F.col("_code"), "left").drop("_code")


summarise = sum_up
summarize = sum_up
