"""Cell expressions: string form, safe casts, recodes, missing codes.

Every function takes a column and the name of its Spark type and returns a
plain Column, so a whole table is cleaned inside one generated stage.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.spec import Spec, Variable

# What a number looks like, and the words for true and false.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
BLANKS = " \t\n\r\f\x0b"
TRUE_WORDS = ("T", "TRUE", "true", "True")
FALSE_WORDS = ("F", "FALSE", "false", "False")

# The type names used in issue texts.
CLASS_NAMES = {
    "tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "integer64",
    "float": "numeric", "double": "numeric", "boolean": "logical", "string": "character",
}

INTEGER_RANGE = {"tinyint": (-128, 127), "smallint": (-32768, 32767), "int": (-2147483648, 2147483647),
                 "bigint": (-9223372036854775808, 9223372036854775807)}

MAX_MAP_CODES = 64  # beyond this a recode is a join, not a literal map

_REAL = ("float", "double")


def class_name(dtype: str) -> str:
    return "numeric" if dtype.startswith("decimal") else CLASS_NAMES.get(dtype, dtype)


def is_missing(c: Column, dtype: str) -> Column:
    return (c.isNull() | F.isnan(c)) if dtype in _REAL else c.isNull()


def string_form(c: Column, dtype: str) -> Column:
    """Text a cell is compared by: ``1.0`` is ``"1"``, true is ``"TRUE"``."""
    if dtype == "string":
        return c
    if dtype == "boolean":
        return F.upper(c.cast("string"))
    if dtype in _REAL or dtype.startswith("decimal"):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(is_missing(c, dtype), F.lit(None).cast("string")).when(
            whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def to_double(c: Column, dtype: str) -> Column:
    if dtype == "string":
        # Only what looks like a number is parsed: a failed parse costs far more than the test.
        return F.when(c.rlike(NUMBER), F.btrim(c, F.lit(BLANKS)).try_cast("double"))
    if dtype == "date":
        return F.unix_date(c).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    return c.cast("double")


def to_integer(c: Column, dtype: str, number: Column | None = None) -> Column:
    """Truncating integer cast; what does not fit is NULL.

    ``number`` passes the parsed text of a string cell, so that it is parsed once.
    """
    if dtype in ("tinyint", "smallint", "int", "boolean"):
        return c.cast("int")
    if dtype == "bigint":
        return F.when(c.between(-2147483647, 2147483647), c.cast("int"))
    d = to_double(c, dtype) if number is None else number
    return F.when((d > F.lit(-2147483648.0)) & (d < F.lit(2147483648.0)), d.cast("int"))


def to_logical(c: Column, dtype: str) -> Column:
    if dtype == "boolean":
        return c
    if dtype == "string":
        return F.when(c.isin(*TRUE_WORDS), F.lit(True)).when(c.isin(*FALSE_WORDS), F.lit(False))
    return F.when(~is_missing(c, dtype), to_double(c, dtype) != 0)


def safe_cast(c: Column, dtype: str, target: str, number: Column | None = None) -> Column | None:
    """The cast to a target type, or None if the type is not known."""
    if target == "integer":
        return to_integer(c, dtype, number)
    if target in ("numeric", "double"):
        return to_double(c, dtype) if number is None else number
    if target == "character":
        return string_form(c, dtype)
    if target == "logical":
        return to_logical(c, dtype)
    return None


def with_numbers(df: DataFrame, spec: Spec, columns: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Parse the text columns that are to hold numbers, once, in a projection of their own.

    Returns the table with the hidden columns and how to refer to them.
    """
    types = dict(df.dtypes)
    text = [c for c in columns if types[c] == "string" and (
        spec[c].type in ("integer", "numeric", "double") or spec[c].values)]
    parsed = {f"_number {c}": to_double(F.col(f"`{c}`"), "string") for c in text}
    return (df.withColumns(parsed) if parsed else df), {c: F.col(f"`_number {c}`") for c in text}


def cast_cannot_fail(dtype: str, target: str) -> bool:
    """Whether the cast to a target keeps every cell of a column type."""
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    if target in ("numeric", "double", "logical") and dtype in numbers:
        return True
    return target == "character" or (target == "integer" and dtype in ("tinyint", "smallint", "int", "boolean"))


def target_dtype(target: str) -> str:
    return {"integer": "int", "numeric": "double", "double": "double",
            "character": "string", "logical": "boolean"}[target]


def recode_pairs(var: Variable) -> dict[str, int]:
    """Usable recodes: the first entry for a raw value counts, NULL targets none."""
    pairs: dict[str, int | None] = {}
    for raw, new in var.recodes or ():
        pairs.setdefault(raw, new)
    return {k: v for k, v in pairs.items() if v is not None}


def typed_codes(texts: Collection[str], dtype: str) -> dict[str, object] | None:
    """The cell values whose string form is a given text, or None if only texts can tell.

    Numbers are then compared as numbers, without writing each cell out.
    """
    if dtype == "string":
        return {t: t for t in texts}
    if dtype == "boolean":
        return {t: t == "TRUE" for t in texts if t in ("TRUE", "FALSE")}
    whole = {t: int(t) for t in texts if re.fullmatch(r"0|-?[1-9]\d{0,14}", t)}
    if dtype in INTEGER_RANGE:
        low, high = INTEGER_RANGE[dtype]
        return {t: n for t, n in whole.items() if low <= n <= high}
    if dtype == "double" and len(whole) == len(texts):
        return {t: float(n) for t, n in whole.items()}
    return None


def equals_any(c: Column, dtype: str, texts: Collection[str]) -> Column:
    """Whether the string form of a cell is one of the texts; NULL for a missing cell."""
    codes = typed_codes(texts, dtype)
    if codes is None and texts:
        return string_form(c, dtype).isin(*texts)
    if not codes:
        return F.when(~is_missing(c, dtype), F.lit(False))
    if dtype == "double":
        c = F.nanvl(c, F.lit(None).cast("double"))
    return c.isin(*codes.values())


def recode(c: Column, dtype: str, var: Variable) -> Column:
    """Replace listed cells by their new code; the column keeps its type."""
    pairs = recode_pairs(var)
    codes = typed_codes(pairs, dtype)
    key = c
    if codes is None:
        codes, key = {t: t for t in pairs}, string_form(c, dtype)
    if not codes:
        return c
    lookup = F.create_map(*[x for t, code in codes.items() for x in (F.lit(code), as_type(F.lit(pairs[t]), dtype))])
    return F.coalesce(F.try_element_at(lookup, key), c)


def as_type(code: Column, dtype: str) -> Column:
    """An integer code written into a column of the given type."""
    return code.cast("string") if dtype == "string" else code.try_cast(dtype)


def drop_missing_codes(c: Column, dtype: str, codes: tuple[int, ...]) -> Column:
    if not codes:
        return c
    return F.when(~equals_any(c, dtype, [str(k) for k in codes]), c)
