"""Stack cleaned tables by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wavemeld.functions.cells import string_form

# Fixed order: a column that differs between tables takes the widest type.
WIDTH = ("void", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string")


def widest(types: set[str]) -> str:
    if len(types) == 1:
        return next(iter(types))
    if types <= set(WIDTH):
        return max(types, key=WIDTH.index)
    return "string"


def merged_types(schemas: list[dict[str, str]]) -> dict[str, str]:
    """Column -> type of the stacked table, columns in order of first appearance."""
    seen: dict[str, set[str]] = {}
    for schema in schemas:
        for name, dtype in schema.items():
            seen.setdefault(name, set()).add(dtype)
    return {name: widest(types) for name, types in seen.items()}


def widen(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the columns that are narrower than the stacked type.

    A number becomes text through its string form, so that 1.0 and "1" agree;
    a plain union would turn such a column into a number and fail on text.
    """
    have, exprs = dict(df.dtypes), {}
    for name, want in types.items():
        if name in have and have[name] != want:
            cell = F.col(f"`{name}`")
            exprs[name] = string_form(cell, have[name]) if want == "string" else cell.cast(want)
    return df.withColumns(exprs) if exprs else df


def merge_datasets(tables: list[DataFrame]) -> DataFrame:
    """Union by name; missing columns are NULL; ``year`` comes first."""
    types = merged_types([dict(t.dtypes) for t in tables])
    order = [c for c in types if c == "year"] + [c for c in types if c != "year"]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [widen(t, types) for t in tables])
    return stacked.select(*[F.col(f"`{c}`") for c in order])
