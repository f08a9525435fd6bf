"""Catalogue of columns: one row ``(dataset, ordinal, raw_name)`` per column of every file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wavemeld.functions.names import normalise, unique_header, normalise_text
from wavemeld.operators.running import SLICE, running_rank, running_total, slices_for
from wavemeld.spec import small_table


def header_catalogue(spark: SparkSession, headers: dict[str, list[str]]) -> DataFrame:
    """Catalogue of headers the driver has read, names normalised and unique."""
    rows = [{"dataset": d, "ordinal": i, "raw_name": n}
            for d, names in headers.items()
            for i, n in enumerate(clean_header(names))]
    return small_table(spark, rows, pa.schema([
        ("dataset", pa.string()), ("ordinal", pa.int64()), ("raw_name", pa.string())]))


def clean_header(names: list[str]) -> list[str]:
    return unique_header([normalise_text(n) for n in names])


def normalise_names(catalogue: DataFrame) -> DataFrame:
    return catalogue.withColumn("raw_name", normalise("raw_name"))


#: A name that a repeat of its first group may be given.
NUMBERED = r"^(.*)_([1-9][0-9]{0,8})$"


def unique_names(catalogue: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """Number the repeats of a name within a dataset ``_1``, ``_2``, ….

    A number is skipped if the dataset already has a column of that name.  The
    j-th repeat of ``b`` therefore gets the j-th number that is not taken:
    with the taken numbers sorted as t(1) < t(2) < …, that is j plus the count
    of those i with t(i) - i < j.  Both counts are running totals, so nothing
    depends on the size of a dataset.

    Where no dataset is longer than a slice, as is asked first, the columns are
    shuffled once (:func:`_unique_in_short_datasets`).
    """
    keys = ["dataset", "raw_name"]
    slices = slices_for(catalogue, "ordinal", slice_size)
    if slices is None:
        return _unique_in_short_datasets(catalogue)
    sizes = catalogue.groupBy(*keys).agg(F.count("*").alias("_size"))
    repeated = sizes.filter("_size > 1").select(*keys)
    taken = running_rank(
        sizes.filter(F.col("raw_name").rlike(NUMBERED))
        .select("dataset", F.regexp_extract("raw_name", NUMBERED, 1).alias("raw_name"),
                F.regexp_extract("raw_name", NUMBERED, 2).cast("bigint").alias("_taken"))
        .join(repeated, keys),  # only bases that repeat can collide
        keys, "_taken", "_i", slice_size)
    events = (taken.groupBy(*keys, (F.col("_taken") - F.col("_i") + 1).alias("_nth"))
              .agg(F.count("*").alias("_skip"))
              .select(*keys, "_nth", "_skip", F.lit(None).cast("bigint").alias("ordinal"), F.lit(0).alias("_row")))
    colliding = taken.select(*keys).distinct().hint("shuffle_hash")

    def rows(ranked: DataFrame) -> DataFrame:
        return ranked.select(*keys, (F.col("_nth") - 1).alias("_nth"), F.lit(0).cast("bigint").alias("_skip"),
                             F.col("ordinal").cast("bigint").alias("ordinal"), F.lit(1).alias("_row"))

    steps = events.unionByName(rows(running_rank(
        catalogue.join(colliding, keys, "left_semi"), keys, "ordinal", "_nth", slices)))
    shifted = running_total(steps, keys, "_nth", "_skip", "_skipped", ("_row",), slice_size).filter("_row = 1")
    free = catalogue.join(colliding, keys, "left_anti")
    plain = rows(running_rank(free, keys, "ordinal", "_nth", slices)).withColumn("_skipped", F.lit(0).cast("bigint"))
    number = (F.col("_nth") + F.col("_skipped")).cast("string")
    return plain.unionByName(shifted.select(*plain.columns)).select(
        "dataset", "ordinal",
        F.when(F.col("_nth") == 0, F.col("raw_name")).otherwise(F.concat_ws("_", "raw_name", number)).alias("raw_name"))


def _unique_in_short_datasets(catalogue: DataFrame) -> DataFrame:
    """The rule of :func:`unique_names` where a plain window holds the columns of a name.

    A column ``b_3`` goes to the group of ``b``, too, as the number 3 that is
    taken there.  So the numbers lie with the repeats, in front of them, and one
    shuffle by name serves the count of both.  Only groups that have both are
    sorted a second time.
    """
    keys = ["dataset", "raw_name"]
    taken = F.when(F.col("dataset").isNotNull() & F.col("raw_name").rlike(NUMBERED), F.struct(
        F.regexp_extract("raw_name", NUMBERED, 1).alias("raw_name"), F.lit(0).alias("_row"),
        F.regexp_extract("raw_name", NUMBERED, 2).cast("bigint").alias("_at")))
    column = F.struct("raw_name", F.lit(1).alias("_row"), F.col("ordinal").cast("bigint").alias("_at"))
    in_order = Window.partitionBy(*keys).orderBy("_row", "_at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A name of the dataset that occurs twice takes its number once.
    fresh = F.when((F.col("_row") == 0) & ~F.lag("_at").over(in_order).eqNullSafe(F.col("_at")), 1).otherwise(0)
    counted = (catalogue.select("dataset", F.inline(F.array_compact(F.array(column, taken))))
               .withColumns({"_skip": fresh.cast("bigint"), "_i": F.dense_rank().over(in_order),
                             "_n": F.sum("_row").over(so_far), "_taken": F.sum(1 - F.col("_row")).over(so_far)}))
    plain = counted.filter("_row = 1 and (_taken = 0 or _n = 1)").withColumn("_number", F.col("_n") - 1)
    nth = F.when(F.col("_row") == 1, F.col("_n") - 1).otherwise(F.col("_at") - F.col("_i") + 1)
    by_number = Window.partitionBy(*keys).orderBy("_nth", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifted = (counted.filter("_taken > 0").withColumn("_nth", nth)
               .withColumn("_number", F.col("_nth") + F.sum("_skip").over(by_number))
               .filter("_row = 1 and _n > 1"))
    return plain.unionByName(shifted.select(*plain.columns)).select(
        "dataset", F.col("_at").alias("ordinal"), F.when(F.col("_number") == 0, F.col("raw_name")).otherwise(
            F.concat_ws("_", "raw_name", F.col("_number").cast("string"))).alias("raw_name"))


def further_columns(catalogue: DataFrame, known: tuple[str, ...] = ()) -> list[str]:
    """What a catalogue has beside the columns of one, and beside those that are ``known``."""
    return [c for c in catalogue.columns if c not in ("dataset", "ordinal", "raw_name", *known)]


def _once_a_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row once, at the first position that it has in its batch."""
    for batch in batches:
        keys = [c for c in batch.schema.names if c != "ordinal"]
        once = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("ordinal", "min")])
        yield from once.rename_columns([*keys, "ordinal"]).select(batch.schema.names).cast(batch.schema).to_batches()


def first_positions(catalogue: DataFrame) -> DataFrame:
    """Each name of a dataset once, at its first position (matching sees names as a set).

    The columns are dealt by dataset and name before they are grouped: a task of
    the scan then holds no table of the names it has met, which it would spill,
    and whoever uses the result shares this one shuffle.  Repeats that lie close
    together, in a batch, are left out of it.  The keys are stated to
    be there, as a join would; a test on the position that always holds keeps
    the position for those who do not look at it.  (Without the cast, the optimizer
    sees that it always holds for a number of another type.)
    """
    further = further_columns(catalogue)
    columns = catalogue.select("dataset", "raw_name", "ordinal", *further)
    named = (columns.mapInArrow(_once_a_batch, columns.schema)
             .filter(F.col("dataset").isNotNull() & F.col("raw_name").isNotNull()))
    first = (named.repartition("dataset", "raw_name").groupBy("dataset", "raw_name")
             .agg(F.min("ordinal").alias("ordinal"), *[F.min(c).alias(c) for c in further]))
    return first.filter(" and ".join(f"coalesce(cast({c} as bigint), 0L) > {-2**63 + 1}L" for c in ["ordinal", *further]))
