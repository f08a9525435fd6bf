"""The variable map: what each target variable is called, holds and means.

A :class:`Spec` is read once on the driver (it is a hand-written file of some
hundred variables) and is used in two ways: as literals while plans are built,
and as long-form spec tables that joins can use.  The table builders at the
end compile such tables from *any* DataFrame of definitions.  A map kept in a
table is a :class:`TableSpec`: its codes are a table made from that one, and
its variables visit the driver only if a plan needs them as literals.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path
from typing import Any

import pyarrow as pa
import yaml
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wavemeld.functions.names import normalise, normalise_text

# Target types, keywords that mean "none", shortest keyword,
# and the characters a keyword has to escape inside a pattern.
TARGET_TYPES = ("integer", "numeric", "double", "character", "logical")
EMPTY_KEYWORDS = ("", "na", "null", "none")
MIN_KEYWORD = 3
KEYWORD_META = r"([.^$*+?()\[{\\|])"
KEYWORD_PREFIX, KEYWORD_SUFFIX = "(?<![a-z0-9])(", ")(?![a-z0-9])"
# Text-coded variables that are named when a table is loaded; the others are counted.
SHOWN = 50

_NUMBER = re.compile(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*")


def whole_number(text: Any) -> int | None:
    """Integer value of a code, truncating as the integer cast does."""
    if text is None or isinstance(text, bool):
        return None if text is None else int(text)
    if not isinstance(text, str):
        text = repr(text)
    if not _NUMBER.fullmatch(text):
        return None
    n = math.trunc(float(text))
    return n if abs(n) < 2**31 else None


@dataclass(frozen=True)
class Variable:
    """One canonical variable."""

    name: str
    aliases: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    type: str = "character"
    label: str | None = None
    values: tuple[tuple[str, str], ...] | None = None  # (code, label), declared order
    recodes: tuple[tuple[str, int | None], ...] | None = None  # (raw, new)
    missing: tuple[str, ...] | None = None

    @property
    def code_type(self) -> str:
        """``integer`` if every declared code is one, else ``character``."""
        return "integer" if all(whole_number(c) is not None for c, _ in self.values or ()) else "character"

    @property
    def codes(self) -> tuple[str, ...]:
        """String form of the declared codes."""
        if self.code_type == "integer":
            return tuple(str(whole_number(c)) for c, _ in self.values or ())
        return tuple(c for c, _ in self.values or ())

    @property
    def valid_integers(self) -> tuple[int, ...]:
        """Declared codes an integer cell can equal."""
        return tuple(dict.fromkeys(int(c) for c in self.codes if re.fullmatch(r"0|-?[1-9]\d{0,9}", c)))

    @property
    def missing_integers(self) -> tuple[int, ...]:
        found = (whole_number(c) for c in self.missing or ())
        return tuple(dict.fromkeys(c for c in found if c is not None))

    @property
    def alias_forms(self) -> tuple[str, ...]:
        """Aliases as written, then normalised, each once."""
        return tuple(dict.fromkeys((*self.aliases, *map(normalise_text, self.aliases))))

    @property
    def pattern(self) -> str | None:
        """Regular expression that finds a whole keyword in a name."""
        words = (k.strip(" \t\n\r\x0b\x0c").lower() for k in self.keywords)
        words = [k for k in words if k not in EMPTY_KEYWORDS and len(k) >= MIN_KEYWORD]
        if not words:
            return None
        escaped = dict.fromkeys(re.sub(KEYWORD_META, r"\\\1", k) for k in words)
        return KEYWORD_PREFIX + "|".join(escaped) + KEYWORD_SUFFIX

    @property
    def plain_keywords(self) -> tuple[str, ...]:
        return tuple(k for k in self.keywords if len(k) >= MIN_KEYWORD)


def _text(value: Any) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return str(value)


def _texts(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    items = value if isinstance(value, (list, tuple)) else [value]
    return tuple(_text(v) for v in items if v is not None)


def _text_coded(name: str) -> str:
    return f"The codes of `{name}` are text; whole numbers are safer where the data allow them."


def _pairs(value: Any) -> list[tuple[str, Any]] | None:
    return [(_text(k), v) for k, v in value.items()] if value else None


@dataclass(frozen=True)
class Spec:
    """All canonical variables in declared order."""

    variables: tuple[Variable, ...]

    @classmethod
    def from_dict(cls, var_map: Mapping[str, Mapping[str, Any] | None]) -> "Spec":
        out = []
        for name, d in var_map.items():
            d = d or {}
            values, recodes = _pairs(d.get("value")), _pairs(d.get("recode"))
            missing = tuple(m for m in _texts(d.get("missing")) if m != "NA")
            var = Variable(
                name=str(name),
                aliases=_texts(d.get("colnames")),
                keywords=_texts(d.get("keywords")),
                type=d.get("type") or "character",
                label=d.get("label"),
                values=tuple((k, _text(v)) for k, v in values) if values else None,
                recodes=tuple((k, whole_number(v)) for k, v in recodes) if recodes else None,
                missing=missing or None,
            )
            if var.values and var.code_type == "character":
                warnings.warn(_text_coded(name), stacklevel=2)
            out.append(var)
        return cls(tuple(out))

    @classmethod
    def from_table(cls, definitions: DataFrame) -> "TableSpec":
        """A map kept as a table like :meth:`definitions`; it has a row per variable."""
        return TableSpec(definitions)

    @classmethod
    def from_yaml(cls, path: str | Path) -> "Spec":
        p = Path(path)
        if not p.exists():
            raise FileNotFoundError(f"Config file not found:\n{path}")
        return cls.from_dict(yaml.safe_load(p.read_text(encoding="utf-8")) or {})

    def __contains__(self, name: str) -> bool:
        return name in self.by_name

    def __getitem__(self, name: str) -> Variable:
        return self.by_name[name]

    @property
    def by_name(self) -> dict[str, Variable]:
        return {v.name: v for v in self.variables}

    @property
    def names(self) -> list[str]:
        return [v.name for v in self.variables]

    @property
    def aliases(self) -> list[tuple[int, str, str]]:
        """(ord, alias, canonical); the first variable to name an alias owns it."""
        owner: dict[str, str] = {}
        for v in self.variables:
            for a in v.alias_forms:
                owner.setdefault(a, v.name)
        return [(i, a, c) for i, (a, c) in enumerate(owner.items())]

    @property
    def patterns(self) -> list[tuple[str, str]]:
        return [(v.name, v.pattern) for v in self.variables if v.pattern]

    # -- spec tables ------------------------------------------------------
    def definitions(self, spark: SparkSession) -> DataFrame:
        """One row per variable: the input of the table builders below."""
        pair = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))
        rows = [{
            "ord": i, "canonical": v.name, "aliases": list(v.aliases),
            "keywords": list(v.keywords), "type": v.type, "label": v.label,
            "values": [{"key": k, "value": x} for k, x in v.values or ()],
            "recodes": [{"key": k, "value": None if x is None else str(x)} for k, x in v.recodes or ()],
            "missing": list(v.missing or ()),
        } for i, v in enumerate(self.variables)]
        strings = pa.list_(pa.string())
        return small_table(spark, rows, pa.schema([
            ("ord", pa.int32()), ("canonical", pa.string()), ("aliases", strings),
            ("keywords", strings), ("type", pa.string()), ("label", pa.string()),
            ("values", pair), ("recodes", pair), ("missing", strings)]))

    def alias_frame(self, spark: SparkSession) -> DataFrame:
        rows = [{"ord": i, "alias": a, "canonical": c} for i, a, c in self.aliases]
        return small_table(spark, rows, pa.schema([
            ("ord", pa.int32()), ("alias", pa.string()), ("canonical", pa.string())]))

    def keyword_frame(self, spark: SparkSession) -> DataFrame:
        rows = [{"canonical": v.name, "keywords": list(v.plain_keywords)} for v in self.variables]
        return small_table(spark, rows, pa.schema([
            ("canonical", pa.string()), ("keywords", pa.list_(pa.string()))]))

    def value_frame(self, spark: SparkSession, variable: str | None = None) -> DataFrame:
        rows = [{"canonical": v.name, "ord": i, "code": code, "label": label}
                for v in self.variables if v.values and variable in (None, v.name)
                for i, (code, (_, label)) in enumerate(zip(v.codes, v.values))]
        return small_table(spark, rows, pa.schema([
            ("canonical", pa.string()), ("ord", pa.int32()),
            ("code", pa.string()), ("label", pa.string())]))


class TableSpec(Spec):
    """A map kept as a table.

    Loading names the variables whose codes are text, the first ``SHOWN`` of
    them; the value table is made by Spark, so a map of any size can be loaded.
    Whoever asks for ``variables`` reads the table onto the driver, once.
    """

    def __init__(self, definitions: DataFrame) -> None:
        object.__setattr__(self, "table", definitions)
        text_coded = _declared(definitions).filter(~F.col("whole")).select("ord", "canonical")
        found = text_coded.orderBy("ord", "canonical").take(SHOWN + 1)
        for r in found[:SHOWN]:
            warnings.warn(_text_coded(r["canonical"]), stacklevel=3)
        if len(found) > SHOWN:
            warnings.warn(f"The codes of {text_coded.count() - SHOWN} more variables are text.", stacklevel=3)

    @cached_property
    def variables(self) -> tuple[Variable, ...]:
        def pairs(entries):
            return {e["key"]: e["value"] for e in entries or ()}

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # said when the table was loaded
            return Spec.from_dict({r["canonical"]: {
                "colnames": r["aliases"], "keywords": r["keywords"], "type": r["type"], "label": r["label"],
                "value": pairs(r["values"]), "recode": pairs(r["recodes"]), "missing": r["missing"],
            } for r in self.table.orderBy("ord").collect()}).variables

    def __eq__(self, other: object) -> bool:
        return self.variables == other.variables if isinstance(other, Spec) else NotImplemented

    __hash__ = Spec.__hash__

    def value_frame(self, spark: SparkSession, variable: str | None = None) -> DataFrame:
        declared = _declared(self.table)
        if variable is not None:
            declared = declared.filter(F.col("canonical") == variable)
        return _value_rows(declared).select("canonical", "ord", "code", "label")


def load_config(config: "str | Path | Mapping | DataFrame | Spec") -> Spec:
    """Read a variable map from a YAML file, a mapping, a table or a ready Spec."""
    if isinstance(config, Spec):
        return config
    if isinstance(config, DataFrame):
        return Spec.from_table(config)
    if isinstance(config, Mapping):
        return Spec.from_dict(config)
    return Spec.from_yaml(config)


def small_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A driver-held table as a local relation.

    Its true size is known to Catalyst, so joins broadcast it only while it is
    under ``spark.sql.autoBroadcastJoinThreshold``; no hint forces it.
    """
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


# -- table builders: definitions(ord, canonical, …) -> long-form spec tables ----

def _as_integer(c: Column) -> Column:
    from wavemeld.functions.cells import to_integer
    return to_integer(c, "string")


def alias_table(definitions: DataFrame) -> DataFrame:
    """alias -> canonical, raw and normalised form; the first definition wins.

    The order key is (definition, position), not a running number, so nothing
    has to be counted across the whole table.
    """
    forms = F.array_distinct(F.concat("aliases", F.transform("aliases", normalise)))
    return (definitions
            .select("ord", "canonical", F.posexplode(forms).alias("pos", "alias"))
            .groupBy("alias")
            .agg(F.min(F.struct("ord", "pos", "canonical")).alias("first"))
            .select("alias", "first.canonical", "first.ord", "first.pos"))


def type_table(definitions: DataFrame) -> DataFrame:
    return definitions.select("canonical", F.coalesce("type", F.lit("character")).alias("type"))


def label_table(definitions: DataFrame) -> DataFrame:
    return definitions.select("canonical", "label")


def value_table(definitions: DataFrame) -> DataFrame:
    """Codes and labels; one non-integer code makes the variable string-coded."""
    return _value_rows(definitions.filter(F.size("values") > 0).select("canonical", _whole().alias("whole"), "values"))


def _whole() -> Column:
    return F.forall("values", lambda e: _as_integer(e["key"]).isNotNull())


def _value_rows(declared: DataFrame) -> DataFrame:
    return (declared.select("canonical", "whole", F.posexplode("values").alias("ord", "e"))
            .select("canonical", "ord",
                    F.when(F.col("whole"), _as_integer(F.col("e.key")).cast("string"))
                    .otherwise(F.col("e.key")).alias("code"),
                    F.when(F.col("whole"), F.lit("integer")).otherwise(F.lit("character")).alias("code_type"),
                    F.col("e.value").alias("label")))


def _declared(definitions: DataFrame) -> DataFrame:
    """``(ord, canonical, whole, values)`` of the variables that declare codes, as :meth:`Spec.from_dict` holds them.

    Of several definitions of a variable the last one holds, of several labels
    of a code the last one, and what is null is called ``None``.
    """
    keys = F.array_distinct(F.transform("values", lambda e: e["key"]))
    once = F.transform(keys, lambda k: F.element_at(F.filter("values", lambda e: e["key"].eqNullSafe(k)), -1))
    named = F.transform(F.when(F.size(keys) < F.size("values"), once).otherwise(F.col("values")), lambda e: F.struct(
        F.coalesce(e["key"], F.lit("None")).alias("key"), F.coalesce(e["value"], F.lit("None")).alias("value")))
    return (definitions.select("ord", "canonical", "values").withColumn("_row", F.monotonically_increasing_id())
            .groupBy("canonical").agg(F.max_by("values", F.struct("ord", "_row")).alias("values"), F.max("ord").alias("ord"))
            .filter(F.size("values") > 0)
            .select("ord", F.coalesce("canonical", F.lit("None")).alias("canonical"), named.alias("values"))
            .select("ord", "canonical", _whole().alias("whole"), "values"))


def recode_table(definitions: DataFrame) -> DataFrame:
    return (definitions.select("canonical", F.explode("recodes").alias("e"))
            .select("canonical", F.col("e.key").alias("raw_value"), _as_integer(F.col("e.value")).alias("new_value")))


def missing_table(definitions: DataFrame) -> DataFrame:
    return (definitions.select("canonical", F.explode("missing").alias("m"))
            .select("canonical", _as_integer(F.col("m")).alias("code"))
            .filter("code IS NOT NULL").distinct())


def keyword_table(definitions: DataFrame) -> DataFrame:
    """canonical -> keyword pattern, for definitions with a usable keyword."""
    words = F.transform("keywords", lambda k: F.lower(F.btrim(k, F.lit(" \t\n\r\x0b\x0c"))))
    usable = F.filter(words, lambda k: ~k.isin(*EMPTY_KEYWORDS) & (F.length(k) >= MIN_KEYWORD))
    escaped = F.array_distinct(F.transform(usable, lambda k: F.regexp_replace(k, KEYWORD_META, r"\\$1")))
    return (definitions.select("ord", "canonical", escaped.alias("words")).filter(F.size("words") > 0)
            .select("ord", "canonical",
                    F.concat(F.lit(KEYWORD_PREFIX), F.array_join("words", "|"),
                             F.lit(KEYWORD_SUFFIX)).alias("pattern")))
