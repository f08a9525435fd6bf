"""Which cells would be lost by a cast, and which hold undeclared codes.

One pass answers this for all columns and all datasets of a plan: each check is
NULL or the offending value, the checks are unpivoted inside the generated
stage, and equal values are counted with a map-side combine.  The result,
:func:`cell_issues`, is whole: every offending value with its count.  The issue
texts are made from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wavemeld.functions.cells import (cast_cannot_fail, class_name, equals_any, is_missing, safe_cast, string_form,
                                      target_dtype, to_integer, with_numbers)
from wavemeld.spec import TARGET_TYPES, Spec

# Bad values shown in a coercion text, and the texts themselves.
SHOWN_BAD_VALUES = 5
#: Undeclared codes that a text or a report row names; the table of codes has all of them.
SHOWN_CODES = 50

ISSUE_SCHEMA = "variable string, issue_type string, detail string, n_bad bigint, bad_values array<string>"


def undeclared(code: Column, valid: tuple[int, ...]) -> Column:
    """The integer code if it is not declared, else NULL."""
    return F.when(~code.isin(*valid), code) if valid else code


def cell_checks(types: dict[str, str], numbers: dict[str, Column], spec: Spec, columns: list[str],
                coerce: bool = True, check_strings: bool = False) -> list[tuple[str, str, Column]]:
    """(variable, kind, offending value or NULL) for each check on each column.

    Kinds: ``coercion`` – lost by the cast; ``undeclared`` – code outside the
    valid set whatever the cast decides; ``undeclared_cast`` /
    ``undeclared_kept`` – the same where the cast decides the code.
    """
    checks: list[tuple[str, str, Column]] = []
    for name in columns:
        var, dtype, cell, number = spec[name], types[name], F.col(f"`{name}`"), numbers.get(name)
        text = string_form(cell, dtype)
        cast = safe_cast(cell, dtype, var.type, number) if coerce else None
        if cast is not None and not cast_cannot_fail(dtype, var.type):
            lost = is_missing(cast, target_dtype(var.type)) & ~is_missing(cell, dtype)
            checks.append((name, "coercion", F.when(lost, text)))
        if not var.values:
            continue
        kept = undeclared(to_integer(cell, dtype, number), var.valid_integers)
        if cast is not None and (var.type == "logical" or dtype == "boolean"):
            done = undeclared(to_integer(cast, target_dtype(var.type)), var.valid_integers)
            checks.append((name, "undeclared_cast", done.cast("string")))
            checks.append((name, "undeclared_kept", kept.cast("string")))
        elif check_strings and var.code_type == "character":
            checks.append((name, "undeclared", F.when(~equals_any(cell, dtype, var.codes), text)))
        else:
            checks.append((name, "undeclared", kept.cast("string")))
    return checks


def profile_cells(df: DataFrame, spec: Spec, columns: list[str], by: tuple[str, ...] = (), coerce: bool = True,
                  check_strings: bool = False) -> DataFrame:
    """The cells a cast would lose and the undeclared codes, counted by value."""
    types = dict(df.dtypes)
    parsed, numbers = with_numbers(df, spec, columns)
    return cell_issues(parsed, cell_checks(types, numbers, spec, columns, coerce, check_strings), by)


def cell_issues(df: DataFrame, checks: list[tuple[str, str, Column]], by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, variable, kind, value, n)``: every offending value and its count."""
    if not checks:
        empty = df.select(*by, F.lit("").alias("variable"), F.lit("").alias("kind"),
                          F.lit("").alias("value"), F.lit(0).cast("bigint").alias("n"))
        return empty.filter(F.lit(False))
    # Unpivoting keeps every check a column of one projection, so a recoded cell
    # is computed once; a row filter would be pushed down and inline it again.
    names = [f"{kind}:{variable}" for variable, kind, _ in checks]
    wide = df.select(*by, *[bad.alias(name) for name, (_, _, bad) in zip(names, checks)])
    long = wide.unpivot(list(by), [F.col(f"`{n}`") for n in names], "check", "value").filter("value IS NOT NULL")
    return (long.groupBy(*by, "check", "value").agg(F.count("*").alias("n"))
            .select(*by, F.substring_index("check", ":", 1).alias("kind"),
                    F.regexp_replace("check", "^[^:]*:", "").alias("variable"), "value", "n")
            .select(*by, "variable", "kind", "value", "n"))


def lost_counts(df: DataFrame, spec: Spec, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, variable, n)``: cells that a cast would lose, for columns that have any.

    This decides which casts are done.  Each task sends one row of counts for
    each dataset, however many different cells stand in the way.
    """
    types = dict(df.dtypes)
    parsed, numbers = with_numbers(df, spec, columns)
    checks = [(c, bad) for c, kind, bad in cell_checks(types, numbers, spec, columns) if kind == "coercion"]
    if not checks:
        return df.select(*by, F.lit("").alias("variable"), F.lit(0).cast("bigint").alias("n")).filter(F.lit(False))
    counts = parsed.groupBy(*by).agg(*[F.count(bad).alias(f"_n{i}") for i, (_, bad) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"_n{i}").alias("n")) for i, (c, _) in enumerate(checks)])
    return counts.select(*by, F.inline(rows)).filter("n > 0")


def lost_columns(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Columns whose cast would lose a cell."""
    return cells.filter("kind = 'coercion'").select(*by, "variable").distinct()


def _first_values(cells: DataFrame, keys: list[str], limit: int, order: list[Column]) -> DataFrame:
    """Count, number of distinct values and the first values per key.

    The rank filter is a literal limit, which prunes each task's output before
    the shuffle; the totals are combined map-side.  Both need the same columns
    of ``cells``, so they share its shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    head = (cells.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= F.lit(limit))
            .groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "value", "n"))),
                                            lambda e: e["value"]).alias("bad_values")))
    totals = cells.groupBy(*keys).agg(F.sum("n").alias("n_bad"), F.count("*").alias("n_distinct"))
    return totals.join(head, keys)


def coercion_profile(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per column: cells a cast would lose, and the first of their values."""
    lost = cells.filter("kind = 'coercion'").drop("kind")
    found = _first_values(lost, [*by, "variable"], SHOWN_BAD_VALUES, [F.col("value")])
    shown = F.when(F.col("n_distinct") > SHOWN_BAD_VALUES,
                   F.concat("bad_values", F.array(F.lit("...")))).otherwise(F.col("bad_values"))
    return found.select(*by, "variable", "n_bad", "n_distinct", shown.alias("bad_values"))


def undecided_codes(spec: Spec, types: dict[str, str], columns: list[str]) -> bool:
    """Whether some column's codes depend on its cast being applied."""
    return any(spec[c].values and (spec[c].type == "logical" or types[c] == "boolean") for c in columns)


def undeclared_codes(cells: DataFrame, by: tuple[str, ...] = (), undecided: bool = False) -> DataFrame:
    """``(*by, variable, value, n)``: every undeclared code, a row each, with the number of cells that hold it.

    ``undecided`` (see :func:`undecided_codes`) looks up which casts are applied.
    """
    codes = cells.filter("kind <> 'coercion'")
    if undecided:
        lost = lost_columns(cells, by).withColumn("_kept", F.lit(True))
        wanted = F.when(F.col("_kept"), F.lit("undeclared_kept")).otherwise(F.lit("undeclared_cast"))
        codes = (codes.join(lost, [*by, "variable"], "left")
                 .filter((F.col("kind") == "undeclared") | (F.col("kind") == wanted)).drop("_kept"))
    return codes.select(*by, "variable", "value", "n")


def conformance_profile(cells: DataFrame, by: tuple[str, ...] = (), undecided: bool = False) -> DataFrame:
    """Per column: the number of cells with an undeclared code, of different codes, and the first codes, ascending."""
    order = [F.col("value").try_cast("bigint"), F.col("value")]
    found = _first_values(undeclared_codes(cells, by, undecided), [*by, "variable"], SHOWN_CODES, order)
    return found.select(*by, "variable", "n_bad", "n_distinct", "bad_values")


def issue_table(cells: DataFrame, spec: Spec, types: dict[str, str], columns: list[str],
                by: tuple[str, ...] = (), datasets: DataFrame | None = None) -> DataFrame:
    """Coercion, skip and value issues with their texts.

    ``datasets`` (columns ``by``) lists the datasets to report unknown target
    types for; it is not needed without ``by``.
    """
    spark = cells.sparkSession
    lookup = {c: (spec[c], class_name(types[c])) for c in columns}

    def by_variable(value) -> Column:
        pairs = [F.lit(x) for c, (v, k) in lookup.items() for x in (c, value(v, k))]
        return F.try_element_at(F.create_map(*pairs), F.col("variable")) if pairs else F.lit(None).cast("string")

    out = [*by, "variable", "issue_type", "detail", "n_bad", "bad_values"]
    coercion = coercion_profile(cells, by).select(
        *by, "variable", F.lit("coercion_failure").alias("issue_type"),
        F.concat(F.lit("Target: "), by_variable(lambda v, k: v.type), F.lit(". "),
                 F.col("n_bad").cast("string"), F.lit(" value(s) -> NA: "), F.array_join("bad_values", ", "),
                 F.lit(". Column kept as "), by_variable(lambda v, k: k), F.lit(".")).alias("detail"),
        "n_bad", "bad_values").select(*out)
    more = F.when(F.col("n_distinct") > SHOWN_CODES, F.concat(
        F.lit(", ... ("), F.col("n_distinct").cast("string"), F.lit(" different codes, all in undeclared_codes)"))).otherwise(F.lit(""))
    listed = F.concat(F.array_join("bad_values", ", "), more)
    values = conformance_profile(cells, by, undecided_codes(spec, types, columns)).select(
        *by, "variable", F.lit("unexpected_values").alias("issue_type"),
        F.concat(F.lit("Values not declared in YAML: "), listed, F.lit(". Valid set: "),
                 by_variable(lambda v, k: ", ".join(v.codes)), F.lit(".")).alias("detail"),
        "n_bad", "bad_values").select(*out)
    issues = coercion.unionByName(values)
    skipped = [(c, "coercion_skip", f"Unknown target type '{spec[c].type}'; column left as-is.", 0, [])
               for c in columns if spec[c].type not in TARGET_TYPES]
    if skipped:
        skips = spark.createDataFrame(skipped, ISSUE_SCHEMA)
        if by and datasets is not None:
            listed_skips = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(
                row[:4], ("variable", "issue_type", "detail", "n_bad"))]) for row in skipped])
            skips = datasets.select(*by, F.inline(listed_skips)).select(
                *by, "variable", "issue_type", "detail", F.col("n_bad").cast("bigint").alias("n_bad"),
                F.array().cast("array<string>").alias("bad_values"))
        issues = issues.unionByName(skips.select(*out))
    return issues
