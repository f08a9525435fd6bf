"""Shards by balanced label propagation.

Documents of equal text are linked.  Every document starts in a shard drawn by
a hash; in each round the linked ones may move to the shard that holds most of
their neighbours, as far as that shard's quota admits, so that fewer and fewer
links are cut.  At the end shards that hold too many rows give up those that
no link holds, and each shard has its exact number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavemeld.llm.common import BUCKET_ROWS, rank_in_groups, settle

ROUNDS = 6


def _pick(shard: str, values: list) -> F.Column:
    """The value of a row's shard, from one value for each shard."""
    return F.element_at(F.array(*[F.lit(v).cast("double" if isinstance(v, float) else "long") for v in values]),
                        (F.col(shard) + 1).cast("int"))


def _sizes(parts: list[DataFrame], shards: int) -> list[int]:
    """Rows in each shard: as many numbers as there are shards."""
    out = [0] * shards
    for part in parts:
        for row in part.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
            out[row["shard"]] += row["n"]
    return out


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """Put every row into one of ``shards`` shards whose row counts differ by one at most.

    Returns ``id_col``, size (bytes + 1; 1 for a null text), text_crc32, law
    (``rows``), shard, slot (0, 1, ... in the shard), grown_shard (null).
    Null and empty texts are equal texts.  A group of equal texts stays in one
    shard unless it is larger than a shard or than what the others leave room
    for; a larger one is spread over the shards.  Rows equal in id and text go
    anywhere near each other; other columns are not looked at.  An empty table
    gives no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = settle(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("crc"),
        F.md5(body).alias("group"), F.xxhash64(F.col(id_col), F.md5(body)).alias("draw")), "rows")
    total = rows.count()
    groups = settle(rows.groupBy("group").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "groups")
    start = F.pmod(F.col("draw"), F.lit(shards)).cast("int")
    joined = rows.withColumn("shard", start).join(groups, "group", "left")
    target = total / shards
    # A group that no shard can hold is cut anyway: its rows make way like those without a link.
    held_whole = F.col("copies").isNotNull() & (F.col("copies") <= F.lit(max(1.0, target)))
    alone = settle(joined.filter(~held_whole).drop("copies"), "alone")
    linked = settle(joined.filter(held_whole), "linked")
    for turn in range(rounds):
        votes = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("votes"))
        wish = votes.groupBy("group").agg(
            F.max_by("shard", F.struct("votes", F.xxhash64("group", "shard"))).alias("to"),
            F.sum("votes").alias("members"), F.max("votes").alias("there"))
        wish = settle(wish, "wish")
        # What would come to a shard against what it can take: groups are admitted up to that part.
        held = _sizes([linked], shards)
        coming = [0] * shards
        for row in wish.groupBy("to").agg(F.sum(F.col("members") - F.col("there")).alias("n")).collect():
            coming[row["to"]] = row["n"]
        leaving = [0] * shards
        away = linked.join(wish.select("group", "to"), "group").filter("shard <> to")
        for row in away.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
            leaving[row["shard"]] = row["n"]
        # Rows without links make way, so the quota is what linked rows may fill.
        room = [max(0.0, target - held[s] + leaving[s]) for s in range(shards)]
        part = [min(1.0, room[s] / coming[s]) if coming[s] else 1.0 for s in range(shards)]
        lot = F.pmod(F.xxhash64("group", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        fits = lot < _pick("to", [float(p) for p in part])
        admitted = wish.filter(fits).select("group", F.col("to").alias("next"))
        linked = settle(linked.join(admitted, "group", "left")
                        .withColumn("shard", F.coalesce("next", "shard")).drop("next"), "linked")
    # Linked rows come first in a shard, so that those beyond the quota are unlinked where possible.
    whole = F.col("copies") <= F.lit(BUCKET_ROWS)
    placed = linked.select("id", "size", "crc", "group", "draw", "shard", F.lit(0).alias("late"),
                           F.when(whole, F.xxhash64("group")).otherwise(F.col("draw")).alias("order"))
    placed = settle(placed.unionAll(alone.select("id", "size", "crc", "group", "draw", "shard", F.lit(1).alias("late"),
                                                 F.col("draw").alias("order"))), "placed")
    sizes = _sizes([placed], shards)
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    excess = [max(0, sizes[s] - quota[s]) for s in range(shards)]
    lack = [max(0, quota[s] - sizes[s]) for s in range(shards)]
    excess_before = [sum(excess[:s]) for s in range(shards)]
    lack_before = [sum(lack[:s]) for s in range(shards)]
    ranked = rank_in_groups(placed, ["shard"], "order", ["group", "draw", "id"], "rank", max(total // shards, 1), "late")
    over = F.col("rank") - _pick("shard", quota) + _pick("shard", excess_before)
    spilled = F.col("rank") >= _pick("shard", quota)
    moved = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        moved = F.when(F.col("over") < F.lit(lack_before[s + 1]), F.lit(s)).otherwise(moved)
    out = (ranked.withColumn("over", F.when(spilled, over))
           .withColumn("moved", F.when(F.col("over").isNotNull(), moved)))
    slot = F.when(F.col("moved").isNull(), F.col("rank")).otherwise(
        _pick("moved", sizes) + F.col("over") - _pick("moved", lack_before))
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").cast("long").alias("text_crc32"),
                      F.lit("rows").alias("law"), F.coalesce("moved", "shard").cast("int").alias("shard"),
                      slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
