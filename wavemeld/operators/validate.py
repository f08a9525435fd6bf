"""Checks on a cleaned table: size, missing cells, undeclared codes."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavemeld.functions.cells import is_missing
from wavemeld.operators.profile import conformance_profile, profile_cells, undeclared_codes
from wavemeld.spec import Spec, small_table

HIGH_MISSING = 50  # percent


@dataclass(frozen=True)
class Validation:
    """Report tables; ``data`` is the validated table, unchanged."""

    data: DataFrame
    structure: DataFrame
    missing: DataFrame
    conformance: DataFrame | None
    codes: DataFrame | None


def validate_structure(df: DataFrame) -> DataFrame:
    """Number of rows, and the columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("columns", F.lit(", ".join(df.columns)))


def missingness(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Percent of missing cells per column, all columns in one aggregate."""
    types, names = dict(df.dtypes), [c for c in df.columns if c not in by]
    counts = df.groupBy(*by).agg(F.count("*").alias("_rows"), *[
        F.count_if(is_missing(F.col(f"`{c}`"), types[c])).alias(f"_m{i}") for i, c in enumerate(names)])
    share = [F.bround(F.col(f"_m{i}") * 100.0 / F.nullif(F.col("_rows"), F.lit(0)), 1) for i in range(len(names))]
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("variable"), p.alias("pct_missing"))
                     for i, (c, p) in enumerate(zip(names, share))])
    return counts.select(*by, F.inline(rows)).withColumn("high", F.col("pct_missing") > HIGH_MISSING)


def _coded_cells(df: DataFrame, spec: Spec, check_strings: bool, by: tuple[str, ...]) -> tuple[list[str], DataFrame]:
    coded = [c for c in df.columns if c in spec and spec[c].values]
    return coded, profile_cells(df, spec, coded, by, coerce=False, check_strings=check_strings)


def conformance_codes(df: DataFrame, spec: Spec, check_strings: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, variable, value, n)``: every undeclared code of the coded columns, a row each."""
    return undeclared_codes(_coded_cells(df, spec, check_strings, by)[1], by)


def conformance_report(df: DataFrame, spec: Spec, check_strings: bool = False,
                       by: tuple[str, ...] = ()) -> DataFrame:
    """Per coded column: the first undeclared codes and how many there are, the valid set, passed or not.

    :func:`conformance_codes` has all codes.  With ``by``, only the columns with a finding have a row.
    """
    coded, cells = _coded_cells(df, spec, check_strings, by)
    found = conformance_profile(cells, by).select(*by, "variable", "n_bad", F.col("n_distinct").alias("n_codes"),
                                                  F.col("bad_values").alias("unexpected"))
    listed = small_table(df.sparkSession, [{"variable": c, "valid": ", ".join(spec[c].codes)} for c in coded],
                         pa.schema([("variable", pa.string()), ("valid", pa.string())]))
    return (listed.join(found, "variable", "inner" if by else "left")
            .select(*by, "variable", "valid",
                    F.coalesce("unexpected", F.array().cast("array<string>")).alias("unexpected"),
                    F.coalesce("n_codes", F.lit(0)).alias("n_codes"),
                    F.coalesce("n_bad", F.lit(0)).alias("n_bad"), F.col("n_bad").isNull().alias("passed")))


def validate_dataset(df: DataFrame, spec: Spec | None = None) -> Validation:
    """All checks; without a variable map only structure and missing cells."""
    return Validation(df, validate_structure(df), missingness(df),
                      conformance_report(df, spec) if spec is not None else None,
                      conformance_codes(df, spec) if spec is not None else None)
