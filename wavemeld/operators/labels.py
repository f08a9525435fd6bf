"""Variable and value labels as column metadata, and the codebook."""

from __future__ import annotations

import json
import warnings

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.functions.cells import equals_any, string_form
from wavemeld.operators.profile import SHOWN_CODES, cell_issues
from wavemeld.sources.scratch import scratch_dir
from wavemeld.spec import Spec, Variable, load_config, small_table


def labelled_columns(df: DataFrame, spec: Spec) -> list[str]:
    return [v.name for v in spec.variables if v.values and v.name in df.columns]


def undeclared_labels(df: DataFrame, spec: Spec) -> DataFrame:
    """``(variable, value, n)``: values that are no declared code, by string form."""
    types = dict(df.dtypes)
    checks = []
    for c in labelled_columns(df, spec):
        cell = F.col(f"`{c}`")
        checks.append((c, "label", F.when(~equals_any(cell, types[c], spec[c].codes), string_form(cell, types[c]))))
    return cell_issues(df, checks).select("variable", "value", "n")


def label_cell(cell: Column, dtype: str, var: Variable) -> Column:
    """Declared codes in the type of the codes; anything else is NULL."""
    declared = equals_any(cell, dtype, var.codes)
    if var.code_type != "integer":
        return F.when(declared, string_form(cell, dtype))
    # A declared integer code is a short plain number, so this cast cannot fail.
    return F.when(declared, cell.try_cast("int"))


def label_metadata(var: Variable) -> dict:
    meta: dict = {"label": var.label} if var.label is not None else {}
    if var.values:
        whole = var.code_type == "integer"
        # A JSON text keeps the declared order, which a metadata object would not.
        meta["labels"] = json.dumps([[int(c) if whole else c, label] for c, (_, label) in zip(var.codes, var.values)],
                                    ensure_ascii=False)
    return meta


def attach_metadata(df: DataFrame, spec: Spec) -> DataFrame:
    """Label the columns; the last step, since recomputing a column drops metadata."""
    for v in spec.variables:
        if v.name in df.columns and label_metadata(v):
            df = df.withMetadata(v.name, label_metadata(v))
    return df


def apply_labels(df: DataFrame, config, strict: bool = True) -> DataFrame:
    """Label every variable of the map that the table has.

    Strict: a value that is no declared code is an error, which names the first
    of them and, if there are many, the table that has all.  Otherwise it becomes
    NULL, with a warning.  All columns are checked by one job.
    """
    spec = load_config(config)
    for v in spec.variables:
        if v.name not in df.columns:
            warnings.warn(f"Variable '{v.name}' not found in data frame.", stacklevel=2)
    labelled = labelled_columns(df, spec)
    if labelled:
        _report_undeclared(undeclared_labels(df, spec), spec, strict)
    return attach_metadata(_label_cells(df, spec, labelled), spec)


def _label_cells(df: DataFrame, spec: Spec, labelled: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: label_cell(F.col(f"`{c}`"), types[c], spec[c]) for c in labelled}) if labelled else df


def _report_undeclared(found: DataFrame, spec: Spec, strict: bool) -> None:
    if not strict:
        for r in found.groupBy("variable").agg(F.sum("n").alias("n")).collect():
            warnings.warn(f"Variable '{r['variable']}': {r['n']} value(s) converted to NA.", stacklevel=3)
        return
    bad = {r["variable"]: r for r in found.groupBy("variable").agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("cells")).collect()}
    first = next((v.name for v in spec.variables if v.name in bad), None)
    if first is None:
        return
    place, rest = None, ""
    if bad[first]["values"] > SHOWN_CODES:
        # The values stay in the cluster, as a table that the error names.
        place = scratch_dir(found.sparkSession, "undeclared-labels")
        found.write.parquet(place)
        found = found.sparkSession.read.schema(found.schema).parquet(place)
        rest = f", ... ({bad[first]['values']} different values in {bad[first]['cells']} cells, all in {place})"
    shown = found.filter(F.col("variable") == first).orderBy("value").limit(SHOWN_CODES).collect()
    raise ValueError(f"'{first}' contains values not defined in its value labels: "
                     + ", ".join(r["value"] for r in shown) + rest)


# -- codebook ---------------------------------------------------------------------

def value_label_text(labels: str | None) -> str:
    return "<br>".join(f"{code} {label}" for code, label in json.loads(labels)) if labels else ""


def extract_attr(df: DataFrame) -> DataFrame:
    """``(name, label, value_labels)`` from the metadata of the columns."""
    rows = [{"name": f.name, "label": f.metadata.get("label"),
             "value_labels": value_label_text(f.metadata.get("labels"))} for f in df.schema.fields]
    return small_table(df.sparkSession, rows, pa.schema([
        ("name", pa.string()), ("label", pa.string()), ("value_labels", pa.string())]))


def make_codebook(df: DataFrame, config=None) -> DataFrame:
    """Codebook of a labelled table, or of a table labelled here, strictly."""
    if config is None and not any("labels" in f.metadata for f in df.schema.fields):
        raise ValueError("The table has no labels. Please provide a variable map.")
    return extract_attr(df if config is None else apply_labels(df, config, strict=True))


def value_labels_table(values: DataFrame) -> DataFrame:
    """Codebook text per variable from a long table of codes and labels."""
    return values.groupBy("canonical").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("ord", "code", "label"))),
        lambda e: F.concat_ws(" ", e["code"], e["label"])), "<br>").alias("value_labels"))


def codebook_counts(df: DataFrame, spec: Spec) -> DataFrame:
    """Codebook rows per declared code, with the number of cells that hold it."""
    types = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("canonical"), string_form(F.col(f"`{c}`"), types[c]).alias("code"))
                      for c in labelled_columns(df, spec)])
    counts = df.select(F.inline(cells)).groupBy("canonical", "code").agg(F.count("*").alias("n"))
    return (spec.value_frame(df.sparkSession).join(counts, ["canonical", "code"], "left")
            .select("canonical", "ord", "code", "label", F.coalesce("n", F.lit(0)).alias("n")))
