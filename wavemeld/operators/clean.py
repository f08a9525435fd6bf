"""Cleaning one table: rename, select, recode, cast, check, stamp, dedupe.

Renames and the choice of columns are plan-time, recodes and casts are
expressions.  Whether a cast is applied depends on the data, so one profile job
runs first; the cleaned table itself stays lazy.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from wavemeld.functions.cells import (MAX_MAP_CODES, as_type, drop_missing_codes, recode, recode_pairs, safe_cast,
                                      string_form, with_numbers)
from wavemeld.operators.catalogue import clean_header, header_catalogue
from wavemeld.operators.matching import match_columns
from wavemeld.operators.profile import issue_table, lost_counts, profile_cells
from wavemeld.spec import Spec, small_table


@dataclass(frozen=True)
class CleanResult:
    """``data`` is the cleaned table, ``issues`` one row per problem column,
    ``cells`` every offending value with its count, ``match`` the match-log rows,
    ``kept`` the columns whose cast was not applied."""

    data: DataFrame
    issues: DataFrame
    cells: DataFrame
    match: list[Row] = field(default_factory=list)
    kept: frozenset[str] = frozenset()


# -- plan-time steps --------------------------------------------------------------

def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed(renames)


def select_canonical(df: DataFrame, spec: Spec) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in spec])


def canonical_layout(header: list[str], matches: dict[str, str], spec: Spec) -> list[tuple[int, str]]:
    """(position, canonical) of the columns that stay, in raw order.

    ``header`` holds clean names.  A column that already bears a canonical name
    stays too, unless a matched column took that name.
    """
    taken = {header.index(raw): c for raw, c in matches.items()}
    used = set(taken.values())
    for i, name in enumerate(header):
        if i not in taken and name in spec and name not in used:
            taken[i] = name
            used.add(name)
    return sorted(taken.items())


def to_canonical(df: DataFrame, header: list[str], matches: dict[str, str], spec: Spec,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """Rename and select in one projection, by position, so names may repeat."""
    positional = [f"_c{i}" for i in range(len(header))]
    named = df.toDF(*positional, *extra)
    return named.select(*[F.col(f"_c{i}").alias(c) for i, c in canonical_layout(header, matches, spec)], *extra)


# -- cell steps -----------------------------------------------------------------

def recode_join(df: DataFrame, column: str, pairs: dict[str, int]) -> DataFrame:
    """Recode by a left join with the code table, for long code lists."""
    dtype = dict(df.dtypes)[column]
    rows = [{"_raw": k, "_new": v} for k, v in pairs.items()]
    codes = small_table(df.sparkSession, rows, pa.schema([("_raw", pa.string()), ("_new", pa.int32())]))
    return (df.withColumn("_key", string_form(F.col(f"`{column}`"), dtype))
            .join(codes, F.col("_key") == F.col("_raw"), "left")
            .withColumn(column, F.coalesce(as_type(F.col("_new"), dtype), F.col(f"`{column}`")))
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def apply_recodes(df: DataFrame, spec: Spec, columns: list[str]) -> DataFrame:
    types, exprs = dict(df.dtypes), {}
    for c in columns:
        pairs = recode_pairs(spec[c])
        if len(pairs) > MAX_MAP_CODES:
            df = recode_join(df, c, pairs)
        elif pairs:
            exprs[c] = recode(F.col(f"`{c}`"), types[c], spec[c])
    return df.withColumns(exprs) if exprs else df


def apply_missing_codes(df: DataFrame, spec: Spec, columns: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    exprs = {c: drop_missing_codes(F.col(f"`{c}`"), types[c], spec[c].missing_integers)
             for c in columns if spec[c].missing_integers}
    return df.withColumns(exprs) if exprs else df


def apply_casts(df: DataFrame, spec: Spec, columns: list[str], kept: frozenset[str] = frozenset()) -> DataFrame:
    """Cast every column but the kept ones and those of unknown target type."""
    types, done = dict(df.dtypes), {}
    parsed, numbers = with_numbers(df, spec, [c for c in columns if c not in kept])
    for c in columns:
        cast = safe_cast(F.col(f"`{c}`"), types[c], spec[c].type, numbers.get(c))
        if cast is not None and c not in kept:
            done[c] = cast
    return parsed.select(*[done[c].alias(c) if c in done else F.col(f"`{c}`") for c in df.columns])


def inject_year(df: DataFrame, year: int | None) -> DataFrame:
    return df if year is None else df.withColumn("year", F.lit(int(year)).cast("int"))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; equal rows are combined before the shuffle, however many copies there are."""
    return df.dropDuplicates()


def drop_empty_rows(df: DataFrame, ignore: tuple[str, ...] = ("year",)) -> DataFrame:
    """Drop rows that are NULL in every column but the ignored stamps."""
    checked = [c for c in df.columns if c not in ignore]
    return df.na.drop("all", subset=checked) if checked else df


# -- whole chain ------------------------------------------------------------------

def match_header(df: DataFrame, spec: Spec, label: str) -> tuple[list[str], list[Row]]:
    """Clean header of a table and its match-log rows."""
    header = clean_header(df.columns)
    catalogue = header_catalogue(df.sparkSession, {label: df.columns})
    return header, match_columns(catalogue, spec, unique=True).log.collect()


def prepare(df: DataFrame, spec: Spec, columns: list[str], apply_missing: bool) -> DataFrame:
    df = apply_recodes(df, spec, columns)
    return apply_missing_codes(df, spec, columns) if apply_missing else df


def finish(df: DataFrame, spec: Spec, columns: list[str], kept: frozenset[str], year: int | None,
           dedupe: bool = True, year_counts_as_value: bool = False) -> DataFrame:
    """Cast, stamp, and drop duplicate and empty rows.

    An applied cast never empties a cell, so empty rows are dropped before the
    casts, where the test is short and runs next to the scan.
    """
    if year is None or not year_counts_as_value:
        df = drop_empty_rows(df, ())
    df = inject_year(apply_casts(df, spec, columns, kept), year)
    return dedupe_rows(df) if dedupe else df


def clean_dataset(df: DataFrame, spec: Spec, year: int | None = None, label: str = "",
                  apply_missing: bool = False, dedupe: bool = True, year_counts_as_value: bool = False,
                  check_strings: bool = False, matches: list[Row] | None = None) -> CleanResult:
    """Clean one table.

    ``year_counts_as_value=True`` keeps a row that holds nothing but its year
    stamp.  ``matches`` passes match-log rows found earlier.
    """
    header = clean_header(df.columns)
    if matches is None:
        header, matches = match_header(df, spec, label)
    raw = to_canonical(df, header, {m["raw_name"]: m["canonical"] for m in matches}, spec)
    columns = [c for c in raw.columns]
    ready = prepare(raw, spec, columns, apply_missing)
    types = dict(ready.dtypes)
    cells = profile_cells(ready, spec, columns, check_strings=check_strings)
    kept = frozenset(r["variable"] for r in lost_counts(ready, spec, columns).collect())
    for c in sorted(kept):
        warnings.warn(f"[{label}] '{c}': cannot coerce to {spec[c].type} without NAs. Kept as is.", stacklevel=2)
    return CleanResult(
        data=finish(ready, spec, columns, kept, year, dedupe, year_counts_as_value),
        issues=issue_table(cells, spec, types, columns),
        cells=cells, match=matches, kept=kept)
