"""Helpers of the operators: written tables, ranks in groups of any size, connected components."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wavemeld.sources.scratch import settle

#: Rows a rank bucket should hold; the number of buckets follows the table.
BUCKET_ROWS = 20_000


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the table does not have, whatever columns it brings."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def same(a: list[Column], b: list[Column]) -> Column:
    """Equality of keys where null equals null."""
    return reduce(lambda x, y: x & y, [x.eqNullSafe(y) for x, y in zip(a, b)])


def rank_in_groups(df: DataFrame, keys: list[str], order: str, ties: list[str], out: str, rows: int,
                   lead: str | None = None) -> DataFrame:
    """Add ``out`` = 0, 1, ... by (``lead``, ``order``, ``ties``) within ``keys``.

    ``order`` is a 64-bit hash.  Rows are ranked inside buckets of the hash, and
    each bucket starts where the counts of those before it end, so that no task
    holds a whole group.  ``df`` should be a written table: it is read twice.
    """
    n_buckets = max(1, -(-rows // BUCKET_ROWS))
    # The bucket follows the order of the hash: its upper 31 bits, scaled.
    upper = F.shiftright(F.col(order), 33) + F.lit(1 << 30)
    bucket = F.floor(upper * F.lit(n_buckets) / F.lit(float(1 << 31))).cast("long")
    lead_col = F.col(lead).cast("long") if lead else F.lit(0).cast("long")
    marked = df.withColumn("_bucket", lead_col * F.lit(n_buckets) + bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (marked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"),
                      F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order, *ties)
    on = same([F.col(k) for k in keys] + [F.col("_bucket")],
              [F.col(f"_k{i}") for i in range(len(keys))] + [F.col("_b")])
    return (marked.withColumn("_row", F.row_number().over(inside))
            .join(starts, on)
            .withColumn(out, F.col("_start") + F.col("_row") - 1)
            .drop("_bucket", "_row", "_b", "_start", *[f"_k{i}" for i in range(len(keys))]))


def fit_in_task(sample: DataFrame, fit):
    """What ``fit`` makes of the rows of a bounded sample, as lists by column, computed in a task."""
    names = sample.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in names]
        for batch in batches:
            for have, more in zip(columns, batch.columns):
                have.extend(more.to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(*columns))], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(work, "model binary").first()
    return pickle.loads(bytes(row[0])) if row else fit(*[[] for _ in names])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): root is the smallest node reachable over the undirected edges.

    Alternates hooking every node to the smallest label next to it with
    shortcutting labels, so long chains take a logarithmic number of rounds.
    Each round is a written table; only one count reaches the driver.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    both = settle(both.union(both.select("y", "x")).distinct(), "edges")
    labels = settle(both.groupBy("x").agg(F.min("y").alias("y"))
                    .select(F.col("x").alias("node"), F.least("x", "y").alias("root")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("y"), F.col("root").alias("near")), "y")
                .groupBy("x").agg(F.min("near").alias("near")))
        hooked = (labels.join(near, F.col("node") == F.col("x"))
                  .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        # A root that has found something smaller takes all its nodes along.
        moved = hooked.filter("root < old").groupBy("old").agg(F.min("root").alias("to")).withColumnRenamed("old", "was")
        lifted = (hooked.join(moved, F.col("root") == F.col("was"), "left")
                  .select("node", "old", F.least("root", F.coalesce("to", "root")).alias("root")))
        jumps = lifted.select(F.col("node").alias("via"), F.col("root").alias("far"))
        shorter = (lifted.join(jumps, F.col("root") == F.col("via"), "left")
                   .select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")))
        step = settle(shorter, "labels")
        labels = step.select("node", "root")
        if step.filter("root <> old").isEmpty():
            return labels
