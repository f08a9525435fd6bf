"""Reading raw files."""

from __future__ import annotations

import csv
import posixpath
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wavemeld.functions.cells import BLANKS, NUMBER
from wavemeld.sources.separators import Vote, choose, heads

#: None: the lines of the file vote.
SEPARATORS = {"csv": None, "tsv": "\t"}
#: Column in which the reader leaves the whole text of a record of another width than the header.
RECORD = "_record"
COLUMNAR = ("parquet", "orc", "json")

# Words a delimited file uses for true and false, and for missing.
LOGICAL_WORDS = ("TRUE", "True", "true", "FALSE", "False", "false")
MISSING_WORD = "NA"
WHOLE = r"^\s*[+-]?\d+\s*$"

# What kinds of cells a column holds, as bits.
LOGICAL, INTEGER, LONG, REAL, TEXT = 1, 2, 4, 8, 16


def extension(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lstrip(".").lower()


def check_extension(path: str) -> str:
    ext = extension(path)
    if ext not in SEPARATORS and ext not in COLUMNAR:
        raise ValueError(f"Unsupported file type: .{ext}")
    return ext


def read_raw(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """Read one file or folder by its extension."""
    ext = check_extension(path)
    if ext in SEPARATORS:
        return read_delimited(spark, [path], schema, **{"sep": SEPARATORS[ext], **options})
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).format(ext).load(path)


def delimited(spark: SparkSession, sep: str = ",", encoding: str = "UTF-8", header: bool = True, **options):
    return spark.read.options(header=header, sep=sep, encoding=encoding, nullValue=MISSING_WORD, escape='"',
                              ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
                              columnNameOfCorruptRecord=RECORD, **options)


@dataclass(frozen=True)
class Layout:
    """What a delimited file looks like: its column names as written, its separator, and whether a quoted cell spans lines."""

    names: tuple[str, ...]
    multi_line: bool = False
    sep: str = ","


def place(path: str) -> str:
    """A path without scheme, host and encoding, to compare a listed file with a manifest's path."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)
    return "/" + unquote(bare).strip("/")


def owners(files: list[str], paths: list[str]) -> dict[str, str]:
    """Which of ``paths`` each listed file belongs to: the longest that is the file or a folder above it."""
    by_place = {}
    for p in paths:
        # A path on this machine may be written with a scheme or without, plain or encoded.
        bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", p)
        for form in (place(p), "/" + bare.strip("/")):
            by_place.setdefault(form, p)
    out = {}
    for f in files:
        at = place(f)
        while at not in by_place and at != "/":
            at = posixpath.dirname(at)
        if at in by_place:
            out[f] = by_place[at]
            continue
        # A path that is not absolute is the end of the place it names.
        tails = [p for form, p in by_place.items() if place(f).endswith(form) or f"{form}/" in place(f)]
        if not tails:
            raise ValueError(f"The file {f} belongs to none of the paths that were listed")
        out[f] = max(tails, key=len)
    return out


def layouts(spark: SparkSession, paths: list[str], sep: str | None = None, encoding: str = "UTF-8",
            **_) -> dict[str, Layout]:
    """The layout of each delimited file or folder, by one job over the raw lines of all of them.

    The names come from the first line as it stands, so none is changed for
    being there twice.  A line with an odd number of quotes opens a cell that
    goes on in the next line.  Without ``sep`` the lines of a file or folder
    vote for its separator.
    """
    found = heads(spark, paths, sep, encoding)
    owner = owners([h.file for h in found], paths)
    votes: dict[str, dict[str, Vote]] = {}
    for h in found:
        have = votes.setdefault(owner[h.file], {})
        for s, v in h.votes.items():
            have[s] = have[s] + v if s in have else v
    odd = {owner[h.file] for h in found if h.odd}
    out: dict[str, Layout] = {}
    for h in sorted(found, key=lambda h: h.file):
        path = owner[h.file]
        by = sep or (out[path].sep if path in out else choose(path, votes[path], path in odd))
        names = _names(h.line, by)
        if names is None:
            # The header itself spans lines, or its separator has many letters: the reader takes it from the file.
            row = delimited(spark, by, encoding, header=False, multiLine=True).csv(h.file).first()
            names = tuple("" if c is None else c for c in row)
        if path in out and out[path].names != names:
            raise ValueError(f"{path}: its files have different headers")
        out[path] = Layout(names, path in odd, by)
    return out


def _names(line: str, sep: str) -> tuple[str, ...] | None:
    """The cells of a header line; None if its last cell is not closed, or only the reader can tell them apart."""
    if line.count('"') % 2 or len(sep) > 1:
        return None
    cells = next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")], delimiter=sep, skipinitialspace=True), [])
    return tuple(c.strip(" ") for c in cells)


def positions(n: int) -> list[str]:
    """Column names by place, which no repeated header name can disturb."""
    return [f"_c{i}" for i in range(n)]


def text_schema(n: int, record: bool = False) -> StructType:
    return StructType([StructField(c, StringType()) for c in [*positions(n), *([RECORD] if record else [])]])


def read_delimited(spark: SparkSession, paths: list[str], schema: StructType | str | None = None,
                   **options) -> DataFrame:
    """Read delimited files of one header; without a schema, types are found first.

    Columns bear the names of the header as written, also where they repeat.
    """
    found = layouts(spark, paths, **options)
    shapes = {(x.names, x.sep) for x in found.values()}
    if len(shapes) > 1:
        raise ValueError("The files have different headers or separators")
    names, sep = next(iter(shapes), ((), options.get("sep") or ","))
    reader = delimited(spark, **{**options, "sep": sep}).option("multiLine", any(x.multi_line for x in found.values()))
    if schema is not None:
        return reader.schema(schema).csv(paths)
    if not names:
        return spark.createDataFrame([], StructType([]))
    kinds = cell_kinds(reader.schema(text_schema(len(names))).csv(paths)).first()
    return reader.schema(typed_schema(positions(len(names)), list(kinds))).csv(paths).toDF(*names)


def cell_kinds(text: DataFrame, by: tuple[str, ...] = (), also: tuple[Column, ...] = ()) -> DataFrame:
    """Which kinds of cells each column holds: one aggregate for all columns.

    With ``by``, one row per dataset, so many files are typed in one job;
    ``also`` are further aggregates of the same pass.
    """
    def kind(name: str):
        c = F.col(f"`{name}`")
        size = F.abs(F.btrim(c, F.lit(BLANKS)).try_cast("double"))
        whole = (F.when(size < F.lit(2147483648.0), F.lit(INTEGER))
                 .when(c.try_cast("bigint").isNotNull(), F.lit(LONG)).otherwise(F.lit(REAL)))
        return (F.when(c.isNull(), F.lit(0)).when(c.isin(*LOGICAL_WORDS), F.lit(LOGICAL))
                .when(c.rlike(WHOLE), whole).when(c.rlike(NUMBER), F.lit(REAL)).otherwise(F.lit(TEXT)))

    names = [c for c in text.columns if c not in by and c != RECORD]
    return text.groupBy(*by).agg(*[F.bit_or(kind(c)).alias(f"_k{i}") for i, c in enumerate(names)], *also)


def as_read(text: Column, dtype: str) -> Column:
    """The cell that the reader makes of a text in a column of a type that :func:`cell_kinds` found for it."""
    return text if dtype == "string" else F.btrim(text, F.lit(BLANKS)).try_cast(dtype)


def kind_type(bits: int | None) -> str:
    bits = bits or 0
    if bits & TEXT or (bits & LOGICAL and bits != LOGICAL):
        return "string"
    if bits & REAL:
        return "double"
    if bits & LONG:
        return "bigint"
    return "int" if bits & INTEGER else "boolean"


def typed_schema(names: list[str], kinds: list[int | None]) -> StructType:
    from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType
    types = {"string": StringType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType(),
             "boolean": BooleanType()}
    return StructType([StructField(n, types[kind_type(k)]) for n, k in zip(names, kinds)])


def spread(df: DataFrame) -> DataFrame:
    """Spread a small file that would be read by few tasks over all cores.

    A table of at least as many splits as the cluster has cores is returned as
    it is, so nothing large is ever shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
