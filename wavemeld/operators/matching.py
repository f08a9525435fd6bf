"""Match raw column names to canonical variables: exact, fuzzy, keyword.

All datasets are matched by one job.  What a name *could* match depends on the
name alone; who *gets* a canonical depends on column order within a dataset,
because each canonical is given out once.  So a name first gets its candidates
(literal patterns, a hash join, a similarity join on distinct names) and only
then are the claims of a dataset settled, in order.

Settling needs few rows.  Let m be the number of canonicals.  In one layer, walk
the columns that have canonical c among their candidates: each has already won
or wins something, which happens at most m times per dataset, or finds all its
candidates of this layer, c included, taken.  Hence after the first m of them c
is taken, and no later wish for c comes true.  At most 3*m*m wishes per dataset
are kept (:func:`contenders`), pruned before the shuffle, so one huge dataset
costs no more than a small one and nothing is lost.  They are settled as a
sorted stream (:func:`settle_claims`): no row or task holds them together.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from wavemeld.operators.catalogue import first_positions, further_columns
from wavemeld.operators.running import running_rank
from wavemeld.sources.scratch import settle
from wavemeld.spec import Spec, small_table

LAYERS = ("exact", "fuzzy", "keyword")
MATCH_COLUMNS = ["dataset", "ordinal", "raw_name", "canonical", "method", "confidence", "needs_review"]
#: Rows of a piece index that is surely broadcast, and pieces of a name that are written out one by one.
INDEX_ROWS, FEW_PIECES = 50_000, 12


@dataclass(frozen=True)
class MatchResult:
    """``log`` has the matched columns, ``unmatched`` the others; both keep what else the catalogue has."""

    log: DataFrame
    unmatched: DataFrame

    @property
    def renames(self) -> DataFrame:
        """Matches that change the name."""
        return self.log.filter("raw_name <> canonical").select("dataset", "raw_name", "canonical")


# -- candidates ---------------------------------------------------------------

def exact_candidates(columns: DataFrame, spec: Spec) -> DataFrame:
    """Add ``exact``: the variable one of whose aliases equals the name."""
    aliases = spec.alias_frame(columns.sparkSession).select(
        F.col("alias").alias("raw_name"), F.col("canonical").alias("exact"))
    return columns.join(aliases, "raw_name", "left")


def keyword_candidates(name: Column, spec: Spec) -> Column:
    """Variables whose keyword pattern is found in the name, in declared order.

    The patterns are literals, compiled once; most names are settled by one
    test against all of them together.
    """
    none = F.array().cast("array<string>")
    if not spec.patterns:
        return none
    any_of = "(?i)" + "|".join(f"(?:{p})" for _, p in spec.patterns)
    found = F.array_compact(F.array(*[
        F.when(name.rlike("(?i)" + p), F.lit(c)) for c, p in spec.patterns]))
    return F.when(name.rlike(any_of), found).otherwise(none)


def allowed_edits(length: Column, max_distance: float) -> Column:
    """A share of the name's length, rounded up, or a whole number of edits."""
    if max_distance >= 1:
        return F.lit(int(max_distance))
    return F.ceil(length * F.lit(Decimal(str(max_distance)))).cast("int")


def fuzzy_candidates(names: DataFrame, spec: Spec, max_distance: float = 0.15, at: str | None = None,
                     also: tuple[str, ...] = ()) -> DataFrame:
    """``(raw_name, fuzzy)``: the first alias that approximately contains the name.

    ``names`` holds distinct names, or names that are distinct together with the
    columns ``also``, which the result keeps.  With k edits allowed, a name cut into k+1
    pieces has at least one piece unharmed inside the alias, so names and
    aliases meet in an equi-join on pieces.  Where a piece lies is known on both
    sides: what is left and right of it has to fit there too.  In front of the
    first unharmed piece, number i from 0, there are i edits at least, which the
    rest after it cannot have.  Only pairs that pass this are
    measured, and only at that place: the edits left and right of the piece.

    ``at`` is a column that is never negative and that the names have from an
    aggregate.  Reading the name through it keeps all tests on the name, also those
    that the optimizer adds, above that aggregate, so that whoever else uses it
    shares its shuffle.
    """
    longest = _longest_alias(spec)
    name = F.col("raw_name") if at is None else F.when(F.col(at) >= 0, F.col("raw_name"))
    size, edits = F.length(F.lower(name)), allowed_edits(F.length(name), max_distance)
    cut = (names.filter((name != "") & (size - edits <= longest))
           .withColumn("low", F.lower(name))
           .withColumn("n", size).withColumn("k", edits)
           .select("raw_name", *also, "low", "n", "k", F.inline(_pieces(F.col("low"), F.col("n"), F.col("k"),
                                                                             _reach(longest, max_distance)[1]))))
    at_place = F.col("place")
    near = F.when(_fits_at(at_place), _edits(_side("left", at_place)) + _edits(_side("right", at_place)) <= F.col("k"))
    return (cut.join(piece_index(names.sparkSession, spec, _reach(longest, max_distance)[0]), "piece")
            .filter(_fits_at(at_place)).filter(near)
            .groupBy(*also, "raw_name").agg(F.min(F.struct("ord", "canonical")).alias("hit"))
            .select("raw_name", *also, F.col("hit.canonical").alias("fuzzy")))


def _longest_alias(spec: Spec) -> int:
    return max((len(a) for _, a, _ in spec.aliases), default=0)


def _pieces(low: Column, n: Column, k: Column, most: int) -> Column:
    """(piece, number, start) of the k+1 pieces of a name, at most ``most``; NULL for those that a name has not."""
    def start(i: Column) -> Column:
        return F.floor(i * n / (k + 1)).cast("int")

    def piece(i: Column) -> Column:
        return F.struct(F.substring(low, start(i) + 1, start(i + 1) - start(i)).alias("piece"), i.alias("number"),
                        start(i).alias("start"))

    if most > FEW_PIECES:
        return F.transform(F.sequence(F.lit(0), k), piece)
    return F.array(*[F.when(F.lit(i) <= k, piece(F.lit(i))) for i in range(most)])


def piece_index(spark: SparkSession, spec: Spec, longest: int) -> DataFrame:
    """``(piece, ord, canonical, alias, place)``: where each piece of up to ``longest`` letters lies in an alias.

    Made on the driver, where the map is, so that the optimizer knows its true
    size and no hint has to keep it from being broadcast.
    """
    rows = [{"piece": alias[p:p + size], "ord": order, "canonical": canonical, "alias": alias, "place": p}
            for order, alias, canonical in ((i, a.lower(), c) for i, a, c in spec.aliases)
            for size in range(min(longest, len(alias)) + 1) for p in range(len(alias) - size + 1)]
    return small_table(spark, rows, pa.schema([
        ("piece", pa.string()), ("ord", pa.int32()), ("canonical", pa.string()), ("alias", pa.string()),
        ("place", pa.int32())]))


def _fits_at(p: Column) -> Column:
    """Whether the edits that are certain with the piece at ``p`` are allowed: letters the alias has no room for, and
    on the left one in each piece."""
    held = F.length("piece")
    before = F.col("start") - p
    after = (F.col("n") - F.col("start") - held) - (F.length("alias") - p - held)
    return F.greatest(F.col("number"), before) + F.greatest(F.lit(0), after) <= F.col("k")


def _side(side: str, p: Column) -> tuple[Column, Column, Column]:
    """(rest of the name, its length, what the alias has on that side); reversed on the left, so both begin at the piece."""
    held = F.length("piece")
    if side == "left":
        return (F.reverse(F.substring(F.col("low"), F.lit(1), F.col("start"))), F.col("start"),
                F.reverse(F.substring(F.col("alias"), F.lit(1), p)))
    begin = F.col("start") + held
    return F.substring(F.col("low"), begin + 1, F.col("n")), F.col("n") - begin, F.substring(
        F.col("alias"), p + held + 1, F.length("alias"))


def _edits(side: tuple[Column, Column, Column]) -> Column:
    """Least edits that turn the rest of a name into some beginning of what the alias has; NULL if more than ``k``."""
    rest, size, text = side
    k = F.col("k")
    least = F.greatest(F.lit(0), size - k)
    found = F.transform(F.sequence(least, F.greatest(least, F.least(F.length(text), size + k))),
                        lambda n: F.call_function("levenshtein", rest, F.substring(text, F.lit(1), n), k))
    return F.array_min(F.filter(found, lambda x: x >= 0))


def _reach(longest_alias: int, max_distance: float) -> tuple[int, int]:
    """(longest piece, most pieces) of any name that could still fit the longest alias."""
    best, most, n = 1, 1, 1
    while True:
        k = int(max_distance) if max_distance >= 1 else math.ceil(Decimal(str(max_distance)) * n)
        if n - k > longest_alias:
            return best, most
        best, most = max(best, -(-n // (k + 1))), max(most, k + 1)
        n += 1


def _index_rows(spec: Spec, max_distance: float) -> int:
    """Rows that the piece index has at most."""
    size = _reach(_longest_alias(spec), max_distance)[0]
    return sum((min(size, len(a)) + 1) * (len(a) + 1) for _, a, _ in spec.aliases)


def name_candidates(columns: DataFrame, spec: Spec, layers: tuple[str, ...] = LAYERS,
                    max_distance: float = 0.15) -> DataFrame:
    """Add the arrays ``exact``, ``fuzzy``, ``keyword`` (empty where a layer is left out).

    A column with a fuzzy candidate has another row for it: names are held
    against the index of pieces where they are, so no column moves for this.
    Only an index too large to be broadcast is asked once for each name.
    """
    def listed(c: str) -> Column:
        return F.array_compact(F.array(F.col(c)))

    none = F.array().cast("array<string>")
    here = columns.columns
    every = columns
    if "exact" in layers:
        columns = exact_candidates(columns, spec).withColumn("exact", listed("exact"))
    else:
        columns = columns.withColumn("exact", none)
    keyword = keyword_candidates(F.col("raw_name"), spec) if "keyword" in layers else none
    if "fuzzy" in layers and _index_rows(spec, max_distance) > INDEX_ROWS:
        names = columns.groupBy("raw_name").agg(F.min("ordinal").alias("at"))
        hits = fuzzy_candidates(names, spec, max_distance, "at")
        columns = columns.join(hits, "raw_name", "left").withColumn("fuzzy", listed("fuzzy"))
    else:
        columns = columns.withColumn("fuzzy", none)
    columns = columns.withColumn("keyword", keyword)
    if "fuzzy" not in layers or _index_rows(spec, max_distance) > INDEX_ROWS:
        return columns
    hits = fuzzy_candidates(every, spec, max_distance, "ordinal", tuple(c for c in here if c != "raw_name"))
    return columns.unionByName(hits.select(
        *here, none.alias("exact"), F.array("fuzzy").alias("fuzzy"), none.alias("keyword")))


def hopeful_columns(columns: DataFrame, spec: Spec, layers: tuple[str, ...] = LAYERS,
                    max_distance: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """The names that have a candidate, and the columns of these names with ``exact``, ``fuzzy``, ``keyword``; both written.

    A name occurs in very many datasets, and asking costs far more than reading a
    column, so each name is asked once.  What is written has a size that the
    optimizer knows when it joins.
    """
    names = settle(columns.groupBy("raw_name").agg(F.min("ordinal").alias("ordinal")), "names")
    found = name_candidates(names, spec, layers, max_distance)
    # One row of a name has its fuzzy candidate, another one the rest.
    asked = settle(found.filter(" or ".join(f"size({x}) > 0" for x in LAYERS)).groupBy("raw_name")
                   .agg(*[F.flatten(F.collect_list(x)).alias(x) for x in LAYERS]), "candidates")
    return asked.select("raw_name"), settle(columns.join(asked, "raw_name"), "hopeful")


# -- claims -------------------------------------------------------------------

def contenders(candidates: DataFrame, limit: int) -> DataFrame:
    """Wishes that can still come true: the first ``limit`` per dataset, layer and canonical.

    A row is one wish: ``layer`` counts from 0, ``place`` is the canonical's
    place among the candidates of the column.
    """
    def wishes(number: int, layer: str) -> Column:
        return F.transform(layer, lambda c, i: F.struct(
            F.lit(number).alias("layer"), i.alias("place"), c.alias("canonical")))

    by_canonical = Window.partitionBy("dataset", "layer", "canonical").orderBy("ordinal", "raw_name")
    return (candidates.select("dataset", F.col("ordinal").cast("bigint").alias("ordinal"), "raw_name",
                              *further_columns(candidates, LAYERS), F.inline(F.concat(*[wishes(i, x) for i, x in enumerate(LAYERS)])))
            .withColumn("_rank", F.row_number().over(by_canonical))
            .filter(F.col("_rank") <= F.lit(limit))
            .drop("_rank"))


def _grant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wishes that come true; those of a dataset come in order, one dataset after the other."""
    current: object = _grant  # no dataset is called this
    taken: set[str] = set()
    won: set[int] = set()
    for batch in batches:
        granted = []
        for i, (dataset, ordinal, canonical) in enumerate(zip(
                *(batch.column(c).to_pylist() for c in ("dataset", "ordinal", "canonical")))):
            if dataset != current:
                current, taken, won = dataset, set(), set()
            if ordinal not in won and canonical not in taken:
                taken.add(canonical)
                won.add(ordinal)
                granted.append(i)
        yield batch.take(pa.array(granted, pa.int64()))


def settle_claims(candidates: DataFrame, limit: int) -> DataFrame:
    """``(dataset, ordinal, raw_name, canonical, layer)`` of the winning columns.

    The wishes of a dataset pass through a task in sorted order; it keeps who
    has won so far, at most ``limit`` columns, and no list of the wishes.
    """
    wishes = contenders(candidates, limit)
    schema = StructType([StructField(f.name, f.dataType) for f in wishes.schema])
    granted = (wishes.repartition("dataset").sortWithinPartitions("dataset", "layer", "ordinal", "raw_name", "place")
               .mapInArrow(_grant, schema))
    layer = F.element_at(F.array(*map(F.lit, LAYERS)), F.col("layer") + 1)
    return granted.select("dataset", "ordinal", "raw_name", *further_columns(candidates, LAYERS), "canonical",
                          layer.alias("layer"))


def fired_keyword(name: Column, keywords: Column) -> Column:
    """The longest plain keyword inside the name, the first of equals."""
    inside = F.filter(F.transform(keywords, lambda k, i: F.struct(
        F.length(k).alias("length"), (-i).alias("order"), k.alias("keyword"))),
        lambda e: F.contains(F.lower(name), F.lower(e["keyword"])))
    return F.coalesce(F.array_max(inside)["keyword"], F.lit("(pattern)"))


def describe_matches(winners: DataFrame, spec: Spec) -> DataFrame:
    """Winners as match-log rows."""
    keywords = spec.keyword_frame(winners.sparkSession)
    layer = F.col("layer")
    method = F.when(layer == "keyword", F.concat(
        F.lit("keyword ["), fired_keyword(F.col("raw_name"), F.col("keywords")), F.lit("]"))).otherwise(layer)
    confidence = (F.when(layer == "exact", F.lit("high")).when(layer == "fuzzy", F.lit("medium"))
                  .otherwise(F.lit("low")))
    return (winners.join(keywords, "canonical", "left")
            .withColumns({"method": method, "confidence": confidence, "needs_review": layer != "exact"})
            .select(*MATCH_COLUMNS, *further_columns(winners, ("canonical", "layer"))))


# -- public -------------------------------------------------------------------

def match_columns(catalogue: DataFrame, spec: Spec, fuzzy_max_distance: float = 0.15,
                  layers: tuple[str, ...] = LAYERS, unique: bool = False) -> MatchResult:
    """Match the columns of every dataset in the catalogue.

    ``unique`` states that no name repeats within a dataset, as in a catalogue
    of clean headers; it saves a shuffle.  What else the catalogue has, numbers
    that belong to a dataset, goes along into the result.

    Otherwise the columns are shuffled once and written, whoever reads the
    result.  A column whose name has no candidate is unmatched, without a join
    with the winners; only the others, as a rule few, are dealt again for it.
    """
    if not spec.aliases:
        warnings.warn("the variable map has no aliases: exact and fuzzy matching will be skipped", stacklevel=2)
        layers = tuple(x for x in layers if x == "keyword")
    keys = ["dataset", "raw_name"]
    if unique:
        columns = catalogue
        winners = settle_claims(name_candidates(columns, spec, layers, fuzzy_max_distance), len(spec.variables))
        unmatched = columns.join(winners.select(*keys), keys, "left_anti")
    else:
        columns = settle(first_positions(catalogue), "columns")
        names, hopeful = hopeful_columns(columns, spec, layers, fuzzy_max_distance)
        winners = settle_claims(hopeful, len(spec.variables))
        losers = hopeful.select(*columns.columns).repartition(*keys).join(
            winners.select(*keys).repartition(*keys), keys, "left_anti")
        unmatched = columns.join(names, "raw_name", "left_anti").unionByName(losers)
    return MatchResult(describe_matches(winners, spec),
                       unmatched.select("dataset", "ordinal", "raw_name", *further_columns(columns)))


def tier(method: Column) -> Column:
    return F.when(method.startswith("keyword"), F.lit("keyword")).otherwise(method)


def report_entries(result: MatchResult) -> DataFrame:
    """``(dataset, ordinal, tier, entry)``: what the report says of each column."""
    entry = (F.when(F.col("method").startswith("keyword"), F.concat_ws(
        " ", F.col("raw_name"), F.lit("->"), F.col("canonical"), F.lit("matched by"), F.col("method")))
        .otherwise(F.concat_ws(" ", F.col("raw_name"), F.lit("->"), F.col("canonical"))))
    return (result.log.select("dataset", "ordinal", tier(F.col("method")).alias("tier"), entry.alias("entry"))
            .unionByName(result.unmatched.select(
                "dataset", "ordinal", F.lit("unmatched").alias("tier"), F.col("raw_name").alias("entry"))))


def match_report(result: MatchResult, per_line: int = 5) -> DataFrame:
    """The whole report: for each dataset and tier the number of columns ``n``, and a row for each of its lines."""
    counts = report_entries(result).groupBy("dataset", "tier").agg(F.count("*").alias("n"))
    return (match_report_lines(result, per_line).join(counts, ["dataset", "tier"])
            .select("dataset", "tier", "n", "line", "text"))


def match_report_lines(result: MatchResult, per_line: int = 5) -> DataFrame:
    """Report text: a line per match, unmatched names in lines of five.

    Lines are numbered within a dataset and tier by a sliced rank, so no line
    and no task holds more than its share of a long list.  A line is put together
    where its slice is; only those that are not full there, at the borders of
    slices, are moved again.
    """
    rows = report_entries(result)
    width = F.when(F.col("tier") == "unmatched", F.lit(per_line)).otherwise(F.lit(1))
    numbered = (running_rank(rows, ["dataset", "tier"], "ordinal", "_nth", keep_slice=True)
                .withColumn("line", F.floor((F.col("_nth") - 1) / width) + 1))
    parts = numbered.groupBy("dataset", "tier", "_slice", "line").agg(F.collect_list(F.struct("_nth", "entry")).alias("entries"))
    full = F.size("entries") == width
    rest = (parts.filter(~full).groupBy("dataset", "tier", "line")
            .agg(F.flatten(F.collect_list("entries")).alias("entries")))
    return (parts.filter(full).select("dataset", "tier", "line", "entries").unionByName(rest)
            .select("dataset", "tier", "line",
                    F.array_join(F.transform(F.sort_array("entries"), lambda e: e["entry"]), ", ").alias("text")))
