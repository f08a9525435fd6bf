"""Chat formatting: snapshots of one conversation collapse to the longest, which is rendered.

A log that saves a conversation after each turn holds every prefix of it.  Each
turn gets a fingerprint of the prefix that it ends: the exclusive or of hashes
of (place, role, text), twice 64 bits.  A conversation whose whole fingerprint
is a proper prefix of another is dropped by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wavemeld.llm.common import settle

#: Turns in a rendered part; a longer conversation has several parts.
PART_TURNS = 256


def _prefixes(turns: DataFrame) -> DataFrame:
    """Add pos (0, 1, ...) and the prefix fingerprints a, b.

    A conversation of any length is cut into slices of turn numbers; slices are
    totalled first, so no task sees more than a slice of a conversation.
    """
    turns = turns.withColumn("slice", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / F.lit(PART_TURNS)))
    inside = Window.partitionBy("key", "slice").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (turns.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("rows"))
              .select("key", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    placed = (turns.withColumn("row", F.row_number().over(inside)).join(starts, ["key", "slice"])
              .withColumn("pos", F.col("start") + F.col("row") - 1).drop("start", "row")
              # Null and empty are told apart by a mark.
              .withColumn("ha", F.xxhash64("pos", F.isnull("role"), "role", F.isnull("text"), "text"))
              .withColumn("hb", F.xxhash64(F.lit("b"), F.col("text"), F.isnull("text"), F.col("role"),
                                           F.isnull("role"), F.col("pos"))))
    placed = settle(placed, "turns")
    sums = placed.groupBy("key", "slice").agg(F.bit_xor("ha").alias("sa"), F.bit_xor("hb").alias("sb"))
    sums = sums.select("key", "slice", F.coalesce(F.bit_xor("sa").over(before), F.lit(0)).alias("pa"),
                       F.coalesce(F.bit_xor("sb").over(before), F.lit(0)).alias("pb"))
    running = Window.partitionBy("key", "slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (placed.withColumn("ra", F.bit_xor("ha").over(running)).withColumn("rb", F.bit_xor("hb").over(running))
            .join(sums, ["key", "slice"])
            .withColumn("a", F.col("ra").bitwiseXOR(F.col("pa"))).withColumn("b", F.col("rb").bitwiseXOR(F.col("pb")))
            .select("key", "pos", "role", "text", "a", "b"))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Render the conversations that are no prefix of a longer one; of equal ones the smallest id.

    Returns ``id_col``, part, n_turns, n_copies (conversations equal to it),
    rendered: turns as ``<|im_start|>role\\ntext<|im_end|>\\n``, 256 in a part
    (the parts of a conversation in order are its text).  Turns are ordered by
    number, then role, then text (null first); repeated rows are turns of their
    own.  Null roles are ``unknown`` and null texts empty when rendered, but
    differ from these when compared.  Rows of a null id are one conversation.
    Other columns are not looked at; an empty table gives no rows.
    """
    base = turns.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"),
                        F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"))
    ids = base.groupBy("key").agg(F.max("id").alias("id"))
    at = settle(_prefixes(base.drop("id")), "prefixes")
    lengths = at.groupBy("key").agg((F.max("pos") + 1).alias("n"))
    ends = at.join(lengths, "key").select("key", "n", "pos", "a", "b")
    whole = settle(ends.filter("pos = n - 1").drop("pos").join(ids, "key"), "whole")
    # The smallest id of equal conversations; null last.
    kept = whole.groupBy("n", "a", "b").agg(
        F.min_by("key", F.struct(F.isnull("id"), F.col("id"), F.col("key"))).alias("key"),
        F.count(F.lit(1)).alias("copies"))
    inner = (ends.filter("pos < n - 1").select((F.col("pos") + 1).alias("n"), "a", "b")).distinct()
    kept = settle(kept.join(inner, ["n", "a", "b"], "left_anti").join(whole.select("key", "id"), "key")
                  .select("key", "id", F.col("n").cast("long").alias("n"), "copies"), "kept")
    segment = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                       F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    part = F.floor(F.col("pos") / F.lit(PART_TURNS)).cast("long")
    parts = (at.select("key", "pos", part.alias("part"), segment.alias("segment"))
             .join(kept.select("key"), "key", "left_semi")
             .groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("turns")))
    return (parts.join(kept, "key")
            .select(F.col("id").alias(id_col), "part", F.col("n").alias("n_turns"), F.col("copies").alias("n_copies"),
                    F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("rendered")))


#: The same rows in SQL, over the table conversations.
ORACLE = """
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos
           FROM conversations),
p AS (SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n,
             '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
             string_agg(chr(1) || role || chr(2) || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM t),
w AS (SELECT conv_id, prefix, n FROM p WHERE pos = n - 1),
k AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, any_value(n) AS n FROM w
      WHERE prefix NOT IN (SELECT prefix FROM p WHERE pos < n - 1) GROUP BY prefix)
SELECT p.conv_id, p.pos // 256 AS part, k.n AS n_turns, k.copies AS n_copies,
       string_agg(p.segment, '' ORDER BY p.pos) AS rendered
FROM p JOIN k USING (conv_id) GROUP BY ALL
"""
