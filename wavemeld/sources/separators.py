"""Which separator a delimited file uses, voted for by all of its lines.

Cells are counted outside of quotes.  A separator fits a file if its header has
it and at least half of the other lines do; of those that fit, the one with most
lines as wide as the header is taken, then the one with most columns.  A file
without any is a file of one column.  A header and rows that are split by
different separators are an error, as nothing of such a file would be matched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Separators that are tried; the last two only if every line has as many of them as the header.
USUAL = (",", "\t", "|", ";")
RARE = (":", " ")


@dataclass(frozen=True)
class Vote:
    """How a separator splits a file: in the header, and how many lines are as wide, are split, are there."""

    header: int
    agree: int
    split: int
    lines: int

    def __add__(self, other: "Vote") -> "Vote":
        return Vote(self.header, self.agree + other.agree, self.split + other.split, self.lines + other.lines)


@dataclass(frozen=True)
class Head:
    """The first line of a file, whether a quoted cell spans lines, and the votes by separator."""

    file: str
    line: str
    odd: bool
    votes: dict[str, Vote]


def unquoted(text: Column) -> Column:
    """A line without its quoted parts; a doubled quote ends one part and begins the next."""
    return F.when(text.contains('"'), F.regexp_replace(text, '"[^"]*"', "")).otherwise(text)


def times(text: Column, sep: str) -> Column:
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))) / len(sep)).cast("int")


def heads(spark: SparkSession, paths: list[str], sep: str | None = None, encoding: str = "UTF-8") -> list[Head]:
    """Header, quotes and votes of each file, by one job over the lines of all of them.

    Lines are first counted by how often each separator is in them, so what is
    shuffled are the different counts of a file and not its lines.
    """
    tried = [sep] if sep else [*USUAL, *RARE]
    value = F.decode(F.col("value").cast("binary"), encoding)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    at = F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), value.alias("value"),
                                          at.alias("first"), (quotes % 2 != 0).alias("odd"))
    bare = lines.withColumn("bare", unquoted(F.col("value")))
    # A blank line has no vote, nor has one that opens or closes a cell of several lines.
    silent = F.col("odd") | (F.btrim("value", F.lit(" \t\r")) == "")
    counts = F.array(*[F.when(silent, F.lit(-1)).otherwise(times(F.col("bare"), s)) for s in tried])
    alike = (bare.groupBy("file", counts.alias("counts"))
             .agg(F.count(F.lit(1)).alias("lines"), F.min("first").alias("first"),
                  F.min_by("value", "first").alias("value"), F.max("odd").alias("odd")))
    by_count = (alike.select("file", "lines", "first", "value", "odd", F.posexplode("counts").alias("which", "n"))
                .groupBy("file", "which", "n").agg(F.sum("lines").alias("lines"), F.min("first").alias("first"),
                                                   F.min_by("value", "first").alias("value"), F.max("odd").alias("odd")))
    votes = by_count.groupBy("file", "which").agg(
        F.min_by("n", "first").alias("header"), F.min_by("lines", "first").alias("agree"),
        F.sum(F.when(F.col("n") > 0, F.col("lines")).otherwise(0)).alias("split"),
        F.sum(F.when(F.col("n") >= 0, F.col("lines")).otherwise(0)).alias("lines"),
        F.min("first").alias("first"), F.min_by("value", "first").alias("value"), F.max("odd").alias("odd"))
    # One vote for each separator that is tried: a fixed number.
    rows = votes.groupBy("file").agg(F.min_by("value", "first").alias("line"), F.max("odd").alias("odd"),
                                     F.collect_list(F.struct("which", "header", "agree", "split", "lines")).alias("votes"))
    return [Head(r["file"], r["line"], bool(r["odd"]),
                 {tried[v["which"]]: Vote(*v[1:]) for v in r["votes"]}) for r in rows.collect()]


def choose(name: str, votes: dict[str, Vote], spans_lines: bool = False) -> str:
    """The separator that fits; ``spans_lines`` says that lines inside of cells have voted too."""
    usual = {s: v for s, v in votes.items() if s in USUAL}

    def fits(v: Vote) -> bool:
        body = v.lines - 1
        return v.header > 0 and (spans_lines or 2 * (v.split - 1) >= body)

    fit = [s for s, v in usual.items() if fits(v)]
    if fit:
        return max(fit, key=lambda s: (votes[s].agree, votes[s].header, -USUAL.index(s)))
    if all(v.header < 0 for v in usual.values()):
        # The header itself spans lines.
        return max(USUAL, key=lambda s: (votes[s].split, -USUAL.index(s)))
    torn = [s for s, v in usual.items() if v.header > 0 or (not spans_lines and 2 * v.split > v.lines - 1 > 0)]
    if torn:
        listed = ", ".join("tab" if s == "\t" else s for s in torn)
        raise ValueError(f"{name}: no separator splits both its header and its rows (tried {listed}); give sep")
    rare = [s for s in RARE if votes[s].header > 0 and votes[s].agree == votes[s].lines > 1]
    return max(rare, key=lambda s: votes[s].header) if rare else USUAL[0]


def record_kind(record: Column, sep: str, columns: int) -> tuple[Column, Column]:
    """(kind, cells) of a record that the reader found malformed."""
    cells = times(unquoted(record), sep) + 1
    kind = (F.when(cells > columns, F.lit("extra_cells")).when(cells < columns, F.lit("missing_cells"))
            .otherwise(F.lit("broken_quotes")))
    return kind, cells


def count_kinds(record: Column, sep: str, columns: int) -> list[Column]:
    """Counts of the malformed records by kind, to be added to an aggregate."""
    kind, _ = record_kind(record, sep, columns)
    return [F.count_if(record.isNotNull() & (kind == k)).alias(k) for k in MALFORMED]


MALFORMED = ("extra_cells", "missing_cells", "broken_quotes")
# What the issues log says of them.
MALFORMED_TEXT = {
    "extra_cells": "{n} row(s) with more cells than the header; the extra cells are kept in malformed_rows only.",
    "missing_cells": "{n} row(s) with fewer cells than the header; the missing ones are read as NA.",
    "broken_quotes": "{n} row(s) with quotes that do not match; see malformed_rows.",
}
