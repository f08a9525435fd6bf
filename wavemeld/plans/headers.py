"""The files of one header as one plan, whatever types their cells have and whatever casts are done.

Two things differ between the files of a header: the type that is found for a
column, and whether its cast would lose a cell.  Neither makes a plan of its
own.  A column whose files differ in type is read once, as text, and becomes a
column for each type, NULL in the rows of other files; the decision on a cast
comes with a row by a join.  Results of one type are put together again, so a
variable has as many columns as there are result types, five at most for text
files, however many files there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wavemeld.functions.cells import safe_cast, string_form, target_dtype, with_numbers
from wavemeld.operators.catalogue import clean_header
from wavemeld.operators.clean import canonical_layout, dedupe_rows, drop_empty_rows, prepare
from wavemeld.operators.merge import merged_types, widen
from wavemeld.sources.manifest import KIND, Entry, FileGroup, column_kinds, scan_header
from wavemeld.spec import Spec, small_table

#: Hidden columns: the year of a row's file, and the variables whose cast is not done there.
YEAR, LOST = f"{KIND}year", f"{KIND}lost"


def variable_of(column: str) -> str:
    return column.split(KIND)[0]


def by_variable(df: DataFrame) -> DataFrame:
    """Findings on columns as findings on variables; a dataset has one column of each variable."""
    return df.withColumn("variable", F.substring_index("variable", KIND, 1))


@dataclass(frozen=True)
class Rules:
    """What is done to every table of a run."""

    spec: Spec
    apply_missing: bool = False
    dedupe: bool = True
    year_counts_as_value: bool = False
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class HeaderFiles:
    """Files of one header; ``lost`` has the variables of a dataset whose cast is not done."""

    spark: SparkSession
    groups: tuple[FileGroup, ...]
    renames: dict[str, str]
    rules: Rules
    lost: dict[str, frozenset[str]] = field(default_factory=dict)

    @property
    def entries(self) -> list[Entry]:
        return [e for g in self.groups for e in g.entries]

    def of(self, datasets: Iterable[str]) -> "HeaderFiles":
        wanted = set(datasets)
        parts = (g.of(wanted) for g in self.groups)
        return replace(self, groups=tuple(g for g in parts if g.entries))

    @cached_property
    def layout(self) -> list[tuple[int, str]]:
        return canonical_layout(clean_header(list(self.groups[0].header)), self.renames, self.rules.spec)

    @cached_property
    def columns(self) -> dict[str, list[str]]:
        """The columns of each variable."""
        kinds = column_kinds(self.groups)
        return {c: [c + suffix for suffix in kinds[i]] for i, c in self.layout}

    @property
    def flat(self) -> list[str]:
        return [v for columns in self.columns.values() for v in columns]

    @property
    def split(self) -> bool:
        return any(len(columns) > 1 for columns in self.columns.values())

    @cached_property
    def spec(self) -> Spec:
        """The map with an entry for each column."""
        return Spec(tuple(replace(self.rules.spec[variable_of(v)], name=v) for v in self.flat))

    @cached_property
    def ready(self) -> DataFrame:
        """The rows of all files, recoded, before the casts; with their ``dataset``."""
        kinds = column_kinds(self.groups)
        raw = scan_header(self.spark, self.groups, **self.rules.options).select(
            *[F.col(f"`_c{i}{s}`").alias(c + s) for i, c in self.layout for s in kinds[i]], "dataset")
        return prepare(raw, self.spec, self.flat, self.rules.apply_missing)

    @cached_property
    def types(self) -> dict[str, str]:
        return dict(self.ready.dtypes)

    def column_in(self, group: FileGroup) -> dict[str, str]:
        """The column that holds a variable in the files of a group."""
        return {c: c if len(self.columns[c]) == 1 else f"{c}{KIND}{group.schema[i].dataType.simpleString()}"
                for i, c in self.layout}

    @cached_property
    def targets(self) -> dict[str, str]:
        """The type of each column once its cast is done; its own where there is no cast."""
        out = {}
        for v in self.flat:
            cast = safe_cast(F.col(f"`{v}`"), self.types[v], self.spec[v].type)
            out[v] = self.types[v] if cast is None else target_dtype(self.spec[v].type)
        return out

    def shapes(self) -> dict[str, tuple]:
        """By dataset: the types of its cleaned columns and whether it has a year; equal for tables of one schema."""
        out = {}
        for g in self.groups:
            held = self.column_in(g)
            kinds: dict[frozenset[str], tuple[str, ...]] = {}
            for e in g.entries:
                lost = self.lost.get(e.dataset, frozenset())
                if lost not in kinds:
                    kinds[lost] = tuple((self.types if c in lost else self.targets)[v] for c, v in held.items())
                out[e.dataset] = kinds[lost], e.year is not None
        return out

    def cleaned(self) -> DataFrame:
        """All datasets: a column for each result type of a variable, ``dataset``, ``year`` if any has one.

        An applied cast never empties a cell, so empty rows go before the casts.
        """
        df, rules = self.ready, self.rules
        decided: dict[str, set[bool]] = {v: set() for v in self.flat}  # whether the cast is done, over the files
        for g in self.groups:
            held = self.column_in(g)
            for e in g.entries:
                lost = self.lost.get(e.dataset, frozenset())
                for c, v in held.items():
                    decided[v].add(c not in lost)
        years = {e.year for e in self.entries}
        mixed = any(len(x) > 1 for x in decided.values())
        if not rules.year_counts_as_value:
            df = drop_empty_rows(df, ("dataset",))
        if mixed or len(years) > 1:
            rows = [{"dataset": e.dataset, YEAR: e.year, LOST: sorted(self.lost.get(e.dataset, ()))} for e in self.entries]
            df = df.join(small_table(self.spark, rows, pa.schema([
                ("dataset", pa.string()), (YEAR, pa.int32()), (LOST, pa.list_(pa.string()))])), "dataset", "left")
        else:
            df = df.withColumn(YEAR, F.lit(next(iter(years), None)).cast("int"))
        if rules.year_counts_as_value:
            df = drop_empty_rows(df, ("dataset", LOST))
        parsed, numbers = with_numbers(df, self.spec, self.flat)
        out: list[Column] = []
        for c, columns in self.columns.items():
            cells: dict[str, list[Column]] = {}
            for v in columns:
                cell = F.col(f"`{v}`")
                cast = safe_cast(cell, self.types[v], self.spec[v].type, numbers.get(v))
                here = F.array_contains(F.col(f"`{LOST}`"), c)
                for done in sorted(decided[v]) if cast is not None else [False]:
                    value, dtype = (cast, self.targets[v]) if done else (cell, self.types[v])
                    if cast is not None and len(decided[v]) > 1:
                        value = F.when(~here if done else here, value)
                    cells.setdefault(dtype, []).append(value)
            out += [F.coalesce(*found).alias(c if len(cells) == 1 else f"{c}{KIND}{dtype}")
                    for dtype, found in cells.items()]
        stamped = years != {None}
        out = [x for x, n in zip(out, parsed.select(*out).columns) if not (stamped and variable_of(n) == "year")]
        df = parsed.select(*out, "dataset", *([F.col(f"`{YEAR}`").alias("year")] if stamped else []))
        return dedupe_rows(df) if rules.dedupe else df


@dataclass(frozen=True)
class CleanPart:
    """Datasets cleaned by one plan."""

    files: HeaderFiles

    @property
    def datasets(self) -> tuple[str, ...]:
        return tuple(e.dataset for e in self.files.entries)

    @cached_property
    def cleaned(self) -> DataFrame:
        return self.files.cleaned()

    @cached_property
    def schemas(self) -> list[dict[str, str]]:
        """Types of the variables; as many schemas as a variable has types."""
        found: dict[str, list[str]] = {}
        for name, dtype in self.cleaned.dtypes:
            found.setdefault(variable_of(name), []).append(dtype)
        most = max(map(len, found.values()))
        return [{c: kinds[min(i, len(kinds) - 1)] for c, kinds in found.items()} for i in range(most)]

    def stacked(self, types: dict[str, str] | None = None, codes: bool = False) -> DataFrame:
        """All datasets with one column for each variable, of the given type or the widest it has.

        ``codes`` writes true and false as 1 and 0 where they become text, as a check of codes sees them.
        """
        types = types or merged_types(self.schemas)
        have = dict(self.cleaned.dtypes)
        out = []
        for c in self.schemas[0]:
            columns = [n for n in have if variable_of(n) == c]
            out.append(F.coalesce(*[self._as(n, have[n], types[c], codes) for n in columns]).alias(c)
                       if len(columns) > 1 else F.col(f"`{columns[0]}`"))
        return self.cleaned.select(*out)

    @staticmethod
    def _as(name: str, dtype: str, want: str, codes: bool) -> Column:
        cell = F.col(f"`{name}`")
        if want == dtype:
            return cell
        if want == "string":
            return cell.cast("int").cast("string") if codes and dtype == "boolean" else string_form(cell, dtype)
        return cell.cast(want)

    @property
    def data(self) -> DataFrame:
        """All datasets, with a ``dataset`` column."""
        return self.stacked()

    def tables(self) -> Iterator[DataFrame]:
        """The datasets with a ``dataset`` column and their own types: a plan for each schema, that reads only its files."""
        alike: dict[tuple, list[str]] = {}
        for dataset, shape in self.files.shapes().items():
            alike.setdefault(shape, []).append(dataset)
        for datasets in alike.values():
            yield CleanPart(self.files.of(datasets)).data

    def table(self, dataset: str) -> DataFrame:
        """One dataset; only its file is read."""
        return CleanPart(self.files.of([dataset])).data.drop("dataset")


class Tables(Mapping):
    """The cleaned table of each dataset; a plan is made when a table is asked for."""

    def __init__(self, parts: list[CleanPart]):
        self._parts = {d: p for p in parts for d in p.datasets}

    def __getitem__(self, dataset: str) -> DataFrame:
        return self._parts[dataset].table(dataset)

    def __iter__(self) -> Iterator[str]:
        return iter(self._parts)

    def __len__(self) -> int:
        return len(self._parts)


def merge_parts(parts: list[CleanPart], keep_dataset: bool = False) -> list[DataFrame]:
    """The parts in the types of their stack."""
    types = merged_types([s for p in parts for s in p.schemas])
    tables = [widen(p.stacked(types), types) for p in parts]
    return tables if keep_dataset else [t.drop("dataset") for t in tables]
