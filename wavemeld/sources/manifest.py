"""A manifest of raw files, read in as few plans as their headers allow."""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wavemeld.functions.names import safe_label_text, unique_header
from wavemeld.sources.readers import (COLUMNAR, RECORD, SEPARATORS, Layout, as_read, cell_kinds, check_extension, delimited,
                                      layouts, owners, positions, text_schema, typed_schema)
from wavemeld.sources.separators import MALFORMED, count_kinds, record_kind
from wavemeld.spec import small_table


@dataclass(frozen=True)
class Entry:
    path: str
    year: int | None

    @property
    def dataset(self) -> str:
        return posixpath.basename(self.path.rstrip("/"))


@dataclass(frozen=True)
class FileGroup:
    """Files of one format, header, separator and schema: one plan reads them all.

    ``malformed`` has (dataset, kind, rows) for records of another width than the header.
    """

    ext: str
    schema: StructType
    header: tuple[str, ...]
    entries: tuple[Entry, ...]
    multi_line: bool = False
    sep: str = ","
    malformed: tuple[tuple[str, str, int], ...] = ()

    def of(self, datasets: Iterable[str]) -> "FileGroup":
        wanted = set(datasets)
        return replace(self, entries=tuple(e for e in self.entries if e.dataset in wanted))


def read_manifest(manifest) -> list[Entry]:
    """Entries of a manifest: pairs (path, year) or a DataFrame ``(path, year_tag)``.

    A dataset is known by its file name, so two files of one name are an error,
    and so are two names that are equal once they are fit for a folder.
    """
    if isinstance(manifest, DataFrame):
        manifest = [(r["path"], r["year_tag"]) for r in manifest.select("path", "year_tag").collect()]
    entries = [Entry(str(p), None if y is None or y != y else int(y)) for p, y in manifest]
    seen: dict[str, str] = {}
    labels: dict[str, str] = {}
    for e in entries:
        if e.dataset in seen:
            raise ValueError(f"Two files are named {e.dataset!r}: {seen[e.dataset]} and {e.path}")
        label = safe_label_text(e.dataset)
        if label in labels:
            raise ValueError(f"{labels[label]!r} and {e.dataset!r} would be written to one folder, {label!r}")
        seen[e.dataset] = e.path
        labels[label] = e.dataset
        check_extension(e.path)
    return entries


def manifest_table(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    """``(dataset, path, year)``, of known size to the optimizer."""
    rows = [{"dataset": e.dataset, "path": e.path, "year": e.year} for e in entries]
    return small_table(spark, rows, pa.schema([
        ("dataset", pa.string()), ("path", pa.string()), ("year", pa.int32())]))


def group_files(spark: SparkSession, entries: list[Entry], sep: str | None = None, **options) -> list[FileGroup]:
    """Group the files by header and separator, then by the types found in each file.

    One job reads the headers of all delimited files of an extension, and one
    aggregate types those of a header, a row for each file.  ``sep`` is the
    separator of all delimited files; without it each file's is found.
    """
    groups: dict[tuple, list[Entry]] = {}
    malformed: dict[str, list[tuple[str, str, int]]] = {}
    for ext in dict.fromkeys(check_extension(e.path) for e in entries):
        members = [e for e in entries if check_extension(e.path) == ext]
        if ext in COLUMNAR:
            for e in members:
                schema = spark.read.format(ext).load(e.path).schema
                groups.setdefault((ext, Layout(tuple(schema.names)), schema.json()), []).append(e)
            continue
        found = layouts(spark, [e.path for e in members], sep=sep or SEPARATORS[ext], **options)
        shapes: dict[Layout, list[Entry]] = {}
        for e in members:
            # A file without a single line has no column.
            shapes.setdefault(found.get(e.path, Layout(())), []).append(e)
        for shape, alike in shapes.items():
            for e, (schema, odd) in zip(alike, _typed(spark, ext, shape, alike, options)):
                groups.setdefault((ext, shape, schema.json()), []).append(e)
                malformed[e.dataset] = [(e.dataset, kind, n) for kind, n in odd.items() if n]
    return [FileGroup(ext, StructType.fromJson(json.loads(schema)), shape.names, tuple(members), shape.multi_line,
                      shape.sep, tuple(x for e in members for x in malformed.get(e.dataset, ())))
            for (ext, shape, schema), members in groups.items()]


def _reader(spark: SparkSession, shape: "Layout | FileGroup", options: dict):
    rest = {k: v for k, v in options.items() if k != "sep"}
    return delimited(spark, sep=shape.sep, **rest).option("multiLine", shape.multi_line)


def _typed(spark: SparkSession, ext: str, shape: Layout, entries: list[Entry],
           options: dict) -> list[tuple[StructType, dict[str, int]]]:
    """Schema, and the numbers of malformed records, of each file; one pass finds both."""
    n = len(shape.names)
    if not n:
        return [(StructType([]), {}) for _ in entries]
    text = with_dataset(_reader(spark, shape, options).option("columnPruning", False).schema(text_schema(n, record=True)), ext, entries)
    counts = cell_kinds(text, ("dataset",), tuple(count_kinds(F.col(RECORD), shape.sep, n)))
    found = {r["dataset"]: r for r in counts.collect()}
    # A file of which only the header is there has no row in the aggregate, and no cell to type.
    out = []
    for e in entries:
        row = found.get(e.dataset)
        kinds = [row[f"_k{i}"] for i in range(n)] if row else [0] * n
        out.append((typed_schema(positions(n), kinds), {k: row[k] for k in MALFORMED} if row else {}))
    return out


#: A path without a host, which is written with one slash or with three.
NO_HOST = "^([A-Za-z][A-Za-z0-9+.-]*):///"


def _no_host(file: str) -> str:
    return re.sub(NO_HOST, r"\1:/", file)


def with_dataset(reader, ext: str, entries: Iterable[Entry]) -> DataFrame:
    """Read files together, columns by place; ``dataset`` is the manifest's name of a row's file.

    A row finds its dataset by a join with the listing of the files, so the plan
    is the same for any number of them; a file that no entry holds is an error.
    """
    names = {e.path: e.dataset for e in entries}
    df = reader.format("csv" if ext in SEPARATORS else ext).load(list(names))
    owner = owners(df.inputFiles(), list(names))
    listing = small_table(df.sparkSession, [{"_file": _no_host(f), "_dataset": names[p]} for f, p in owner.items()],
                          pa.schema([("_file", pa.string()), ("_dataset", pa.string())]))
    columns = [c for c in df.columns if c != RECORD]
    file = F.col("_metadata.file_path")
    file = F.when(file.contains(":///"), F.regexp_replace(file, NO_HOST, "$1:/")).otherwise(file)
    rows = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(columns, positions(len(columns)))],
                     *([RECORD] if RECORD in df.columns else []), file.alias("_file"))
    unknown = F.raise_error(F.concat(F.lit("No dataset was listed for the file "), F.col("_file")))
    return (rows.join(listing, "_file", "left")
            .withColumn("dataset", F.coalesce("_dataset", unknown)).drop("_file", "_dataset"))


def scan(spark: SparkSession, group: FileGroup, **options) -> DataFrame:
    """All rows of a group, columns by place (``_c0``, ...), with their ``dataset``, as one lazy plan."""
    if not group.schema.names:
        return spark.createDataFrame([], "dataset string")
    reader = _reader(spark, group, options) if group.ext in SEPARATORS else spark.read
    return with_dataset(reader.schema(group.schema), group.ext, group.entries)


#: Parts the name of a column from the type that it has in some of the files.
KIND = "\t"


def by_header(groups: list[FileGroup]) -> list[list[int]]:
    """The places of the groups that one plan can read: delimited files of one header, whatever their types."""
    alike: dict[tuple, list[int]] = {}
    for i, g in enumerate(groups):
        typed = None if g.ext in SEPARATORS else g.schema.json()
        alike.setdefault((g.ext, g.header, g.sep, g.multi_line, len(g.schema.names), typed), []).append(i)
    return list(alike.values())


def column_kinds(groups: Sequence[FileGroup]) -> list[list[str]]:
    """By column, what its types add to its name: nothing where the files agree, else a suffix for each type."""
    found = [list(dict.fromkeys(g.schema[i].dataType.simpleString() for g in groups))
             for i in range(len(groups[0].schema.names))]
    return [[""] if len(kinds) == 1 else [KIND + k for k in kinds] for kinds in found]


def scan_header(spark: SparkSession, groups: Sequence[FileGroup], **options) -> DataFrame:
    """All rows of groups of one header as one plan, columns by place, with their ``dataset``.

    A column whose files differ in type is read as text and becomes a column
    for each type (``_c0<tab>int``), NULL in the rows of the other files.  The
    types of a row's file come by a join, so the plan does not grow with them.
    """
    if len(groups) == 1:
        return scan(spark, groups[0], **options)
    kinds = column_kinds(groups)
    varied = [i for i, k in enumerate(kinds) if len(k) > 1]
    schema = StructType([StructField(f.name, StringType()) if i in varied else f
                         for i, f in enumerate(groups[0].schema)])
    df = with_dataset(_reader(spark, groups[0], options).schema(schema), groups[0].ext,
                      [e for g in groups for e in g.entries])
    types = f"{KIND}types"
    rows = [{"dataset": e.dataset, types: held} for g in groups
            for held in [[g.schema[i].dataType.simpleString() for i in varied]] for e in g.entries]
    df = df.join(small_table(spark, rows, pa.schema([("dataset", pa.string()), (types, pa.list_(pa.string()))])),
                 "dataset", "left")

    def cells(i: int) -> list[Column]:
        if i not in varied:
            return [F.col(f"_c{i}")]
        held = F.element_at(F.col(f"`{types}`"), varied.index(i) + 1)
        return [F.when(held == k.lstrip(KIND), as_read(F.col(f"_c{i}"), k.lstrip(KIND))).alias(f"_c{i}{k}")
                for k in kinds[i]]

    return df.select(*[c for i in range(len(kinds)) for c in cells(i)], "dataset")


MALFORMED_SCHEMA = "dataset string, kind string, cells int, columns int, first_cell string, record string"


def malformed_rows(spark: SparkSession, groups: list[FileGroup], **options) -> DataFrame:
    """The whole text of every record of another width than its header; only files that have any are read."""
    out = spark.createDataFrame([], MALFORMED_SCHEMA)
    for g in groups:
        odd = g.of(d for d, _, _ in g.malformed)
        if not odd.entries:
            continue
        n = len(g.header)
        # A reader that skips columns does not see how many there are.
        reader = _reader(spark, g, options).option("columnPruning", False)
        rows = with_dataset(reader.schema(text_schema(n, record=True)), g.ext, odd.entries)
        kind, cells = record_kind(F.col(RECORD), g.sep, n)
        out = out.unionByName(rows.filter(F.col(RECORD).isNotNull()).select(
            "dataset", kind.alias("kind"), cells.alias("cells"), F.lit(n).alias("columns"),
            F.col("_c0").alias("first_cell"), F.col(RECORD).alias("record")))
    return out


def named(df: DataFrame, group: FileGroup) -> DataFrame:
    """The rows of :func:`scan` under the names of the header, made unique."""
    names = unique_header(list(group.header))
    if "dataset" in names:
        raise ValueError("A column is called 'dataset'; use the columns by place")
    return df.toDF(*names, "dataset")
