"""Harmonise every file of a manifest.

Work is grouped, not looped: all headers are matched by one job, and the files
of one header are read, profiled and cleaned by one plan, whatever types and
casts they turn out to have (:mod:`wavemeld.plans.headers`).  Plans follow the
number of different headers, not of files or of bad columns.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wavemeld.operators.catalogue import header_catalogue, clean_header
from wavemeld.operators.clean import canonical_layout
from wavemeld.operators.matching import MatchResult, match_columns
from wavemeld.operators.merge import merge_datasets
from wavemeld.operators.profile import issue_table, lost_counts, profile_cells, undecided_codes, undeclared_codes
from wavemeld.operators.validate import conformance_report, missingness
from wavemeld.plans.audit import MasterSummary, export_match_log, summarise_master_log
from wavemeld.plans.headers import CleanPart, HeaderFiles, Rules, Tables, by_variable, merge_parts, variable_of
from wavemeld.sources.manifest import FileGroup, by_header, group_files, malformed_rows, manifest_table, read_manifest
from wavemeld.sources.separators import MALFORMED_TEXT
from wavemeld.sources.sinks import write_datasets, write_table
from wavemeld.spec import Spec, load_config, small_table


@dataclass(frozen=True)
class Harmonised:
    parts: list[CleanPart]
    issues: DataFrame
    cells: DataFrame
    codes: DataFrame
    match: MatchResult
    years: DataFrame
    spec: Spec
    malformed: DataFrame
    summary: MasterSummary | None = None

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        """The cleaned table of each dataset."""
        return Tables(self.parts)

    def merged(self, keep_dataset: bool = False) -> DataFrame:
        """All datasets stacked, ``year`` first."""
        return merge_datasets(merge_parts(self.parts, keep_dataset))

    def write(self, path: str | None, format: str = "csv") -> None:
        """A folder for each dataset, in its own types; each file is read once."""
        for part in self.parts if path else ():
            for table in part.tables():
                write_datasets(table, path, format)

    def validation(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """Per plan: missing cells per dataset and column, and a report on undeclared codes; ``codes`` has them all."""
        return {", ".join(p.datasets): (missingness(p.data, ("dataset",)),
                                        conformance_report(p.stacked(codes=True), self.spec, by=("dataset",))) for p in self.parts}


def write_validation(done: Harmonised, log_dir: str) -> None:
    """The reports on all cleaned datasets: missing cells, undeclared codes by column, and each such code."""
    write_table(done.codes, f"{log_dir}/undeclared_codes")
    reports = list(done.validation().values())
    if not reports:
        return
    missing = reduce(DataFrame.unionByName, [m for m, _ in reports])
    codes = reduce(DataFrame.unionByName, [c for _, c in reports]).withColumn("unexpected", F.to_json("unexpected"))
    write_table(missing, f"{log_dir}/validation_missing")
    write_table(codes, f"{log_dir}/validation_codes")


# The variable and the text of issues that concern a whole file.
WHOLE_FILE = "(file)"
NO_MATCH = "No column matches the variable map; nothing of this file is kept."


def file_issues(spark: SparkSession, groups: list[FileGroup], renames: list[dict[str, str]], spec: Spec) -> DataFrame:
    """Issues of whole files: records of another width than the header, and headers without a match.

    The driver holds a few rows for each file that has any, as it holds the manifest.
    """
    rows = []
    for g, names in zip(groups, renames):
        for dataset, kind, n in g.malformed:
            rows.append((dataset, kind, MALFORMED_TEXT[kind].format(n=n), n))
        if not any(c in spec for _, c in canonical_layout(clean_header(list(g.header)), names, spec)):
            rows += [(e.dataset, "no_match", NO_MATCH, 0) for e in g.entries]
    for dataset, kind, detail, _ in rows:
        if kind == "no_match":
            warnings.warn(f"[{dataset}] {detail}", stacklevel=3)
    table = small_table(spark, [{"dataset": d, "issue_type": k, "detail": t, "n_bad": n} for d, k, t, n in rows],
                        pa.schema([("dataset", pa.string()), ("issue_type", pa.string()), ("detail", pa.string()),
                                   ("n_bad", pa.int64())]))
    return table.select("dataset", F.lit(WHOLE_FILE).alias("variable"), "issue_type", "detail", "n_bad",
                        F.array().cast("array<string>").alias("bad_values"))


def match_groups(spark: SparkSession, groups: list[FileGroup], spec: Spec) -> tuple[MatchResult, list[dict[str, str]]]:
    """Match each distinct header once; results per dataset, and renames per group."""
    headers: dict[tuple[str, ...], str] = {}
    for g in groups:
        headers.setdefault(g.header, f"header-{len(headers)}")
    found = match_columns(header_catalogue(spark, {h: list(names) for names, h in headers.items()}), spec, unique=True)
    log = found.log
    renames: dict[str, dict[str, str]] = {h: {} for h in headers.values()}
    for r in log.collect():
        renames[r["dataset"]][r["raw_name"]] = r["canonical"]
    members = small_table(spark, [{"dataset": headers[g.header], "_member": e.dataset}
                                  for g in groups for e in g.entries],
                          pa.schema([("dataset", pa.string()), ("_member", pa.string())]))

    def per_dataset(df: DataFrame) -> DataFrame:
        return df.join(members, "dataset").withColumn("dataset", F.col("_member")).select(*df.columns)

    return (MatchResult(per_dataset(log), per_dataset(found.unmatched)),
            [renames[headers[g.header]] for g in groups])


def clean_groups(spark: SparkSession, groups: list[FileGroup], renames: list[dict[str, str]], spec: Spec,
                 years: DataFrame, apply_missing: bool, dedupe: bool = True, year_counts_as_value: bool = False,
                 check_strings: bool = False,
                 **options) -> tuple[list[CleanPart], DataFrame, DataFrame, DataFrame]:
    """Profile and clean, a plan for each header; returns parts, issues, cell histogram and undeclared codes."""
    by = ("dataset",)
    rules = Rules(spec, apply_missing, dedupe, year_counts_as_value, options)
    headers = [HeaderFiles(spark, tuple(groups[i] for i in places), renames[places[0]], rules)
               for places in by_header(groups)]
    cells, codes, issues, lost_cells = [], [], [], []
    for h in headers:
        found = profile_cells(h.ready, h.spec, h.flat, by, check_strings=check_strings)
        undeclared = undeclared_codes(found, by, undecided_codes(h.spec, h.types, h.flat))
        texts = issue_table(found, h.spec, h.types, h.flat, by, years.join(_names(spark, h), "dataset", "left_semi"))
        if h.split:
            found, undeclared, texts = by_variable(found), by_variable(undeclared), by_variable(texts)
            # A type that the map does not know is reported for each column of the variable.
            texts = texts.dropDuplicates([*by, "variable", "issue_type"])
        cells.append(found)
        codes.append(undeclared)
        issues.append(texts)
        lost_cells.append(lost_counts(h.ready, h.spec, h.flat, by))
    kept: dict[str, set[str]] = {}
    for r in reduce(DataFrame.unionByName, lost_cells).collect():
        kept.setdefault(r["dataset"], set()).add(variable_of(r["variable"]))
    lost = {d: frozenset(columns) for d, columns in kept.items()}
    parts = []
    for h in headers:
        # A year in the data stays where the manifest has none, so such files are read apart.
        dated = [[e.dataset for e in h.entries if (e.year is not None) == x] for x in (True, False)]
        for datasets in dated if "year" in h.columns else [[e.dataset for e in h.entries]]:
            if datasets:
                parts.append(CleanPart(replace(h, lost=lost).of(datasets)))
    return (parts, *(reduce(DataFrame.unionByName, x) for x in (issues, cells, codes)))


def _names(spark: SparkSession, files: HeaderFiles) -> DataFrame:
    return small_table(spark, [{"dataset": e.dataset} for e in files.entries], pa.schema([("dataset", pa.string())]))


def run_pipeline(spark: SparkSession, manifest, config, log_dir: str | None = None, output_path: str | None = None,
                 apply_missing: bool = False, merge: bool = False, format: str = "csv",
                 logged_at: str | None = None, dedupe: bool = True, year_counts_as_value: bool = False,
                 check_strings: bool = False, **options) -> Harmonised:
    """Read, match, clean, log, validate and, if a path is given, write every file.

    ``merge=True`` writes one stacked table, otherwise one per dataset.  Options
    go to the readers; ``sep`` is the separator of all delimited files, which
    otherwise is found for each.  Records of another width than their header are
    counted in the issues, and whole in ``malformed``.
    """
    spec = load_config(config)
    if "dataset" in spec:
        raise ValueError("A variable cannot be called 'dataset'")
    entries = read_manifest(manifest)
    sep = options.pop("sep", None)
    groups = group_files(spark, entries, sep, **options)
    years = manifest_table(spark, entries).select("dataset", "year")
    match, renames = match_groups(spark, groups, spec)
    parts, issues, cells, codes = clean_groups(spark, groups, renames, spec, years, apply_missing, dedupe,
                                               year_counts_as_value, check_strings, **options)
    issues = issues.unionByName(file_issues(spark, groups, renames, spec).select(*issues.columns))
    malformed = malformed_rows(spark, groups, **options)
    summary = None
    if log_dir is not None:
        export_match_log(match, log_dir, issues, years, logged_at=logged_at)
        summary = summarise_master_log(spark, log_dir)
    out = Harmonised(parts, issues, cells, codes, match, years, spec, malformed, summary)
    if log_dir is not None:
        write_validation(out, log_dir)
        if any(g.malformed for g in groups):
            write_table(malformed, f"{log_dir}/malformed_rows")
    if merge:
        write_table(out.merged() if output_path else None, output_path, format)
    else:
        out.write(output_path, format)
    return out
