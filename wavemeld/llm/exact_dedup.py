"""Exact duplicates by deterministic naming of blocks.

A text is cut into blocks of fixed size.  Distinct blocks are sorted, and the
place of a block in that order is its integer name.  Then names of adjacent
pairs are sorted and named again, until one name is left for each text: two
texts have one name if and only if they are equal, with no hash to collide.

A block whose hash occurs once differs from all others without being compared,
so its text is alone and needs no name; only the others move their bytes.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.llm.common import fresh, same, settle

BLOCK_BYTES = 4096
#: Bytes of a block that place it among the others; those that agree in them are sorted in one task.
LEAD_BYTES = 128


def normalised(text: Column) -> Column:
    """Null is empty; A-Z become a-z, and nothing else changes."""
    whole = F.coalesce(text, F.lit(""))
    return F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)


def _named(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct keys with integer names in their sorted order.

    Splitters are sampled from the keys' beginnings, so that the sample that
    the driver sees does not hold whole blocks.
    """
    lead = [F.substring(c, 1, LEAD_BYTES) if dict(keys.dtypes)[c] == "binary" else F.col(c) for c in columns]
    ordered = keys.select(*columns).distinct().repartitionByRange(*lead).sortWithinPartitions(*columns)
    return settle(ordered.withColumn("name", F.monotonically_increasing_id()), name)


def _identities(texts: DataFrame, block_bytes: int) -> DataFrame:
    """(key, n_blocks, name) of texts (key, body, n_blocks), of which each block's hash occurs elsewhere too."""
    blocks = texts.select("key", "n_blocks", F.posexplode(_blocks("body", block_bytes)).alias("pos", "block"))
    blocks = settle(blocks.withColumn("pos", F.col("pos").cast("long")), "blocks")
    names = _named(blocks, ["block"], "block_names")
    level = settle(blocks.join(names, "block").select("key", "n_blocks", "pos", "name"), "names")
    longest = level.agg(F.max("n_blocks")).first()[0] or 0
    done, width = [], longest
    while True:
        done.append(level.filter("left = 1") if "left" in level.columns else level.filter("n_blocks = 1"))
        if width <= 1:
            break
        open_ = level.filter("left > 1") if "left" in level.columns else level.filter("n_blocks > 1")
        left = F.col("left") if "left" in level.columns else F.col("n_blocks")
        pairs = (open_.groupBy("key", "n_blocks", left.alias("was"), F.floor(F.col("pos") / 2).alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
                 .withColumn("left", F.ceil(F.col("was") / 2)).drop("was"))
        pairs = settle(pairs, "pairs")
        names = _named(pairs, ["a", "b"], "pair_names")
        level = settle(pairs.join(names, ["a", "b"]).select("key", "n_blocks", "pos", "left", "name"), "names")
        width = -(-width // 2)
    out = done[0].select("key", "n_blocks", "name")
    for more in done[1:]:
        out = out.unionAll(more.select("key", "n_blocks", "name"))
    return out


def _blocks(body: str, block_bytes: int) -> Column:
    """The blocks of a binary column; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(body) / F.lit(block_bytes)) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")),
                       lambda i: F.substring(F.col(body), (i * block_bytes + 1).cast("int"), F.lit(block_bytes)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Group rows of equal text (A-Z lower-cased, null as empty); the largest id stays.

    Returns, for each row, ``id_col``, keep_id, group_size, kept, text_sha256.
    A null id is smaller than any other.  Of rows that are equal in id and text,
    one is kept.  Other columns of the input are not looked at; an empty table
    gives an empty result.  Texts of any length are cut into blocks; the
    number of naming rounds is the logarithm of the longest group's blocks.
    """
    body = normalised(F.col(text_col)).cast("binary")
    base = docs.select(F.col(id_col).alias("id"), body.alias("body"))
    sha = F.sha2("body", 256)
    # A row is known by its id and text; rows equal in both are counted.
    key = F.concat(sha, F.lit(":"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    hashes = F.transform(_blocks("body", block_bytes), lambda block, i: F.xxhash64(block, i))
    rows = settle(base.select("id", sha.alias("sha"), key.alias("key"), hashes.alias("hashes")), "rows")
    each = rows.groupBy("id", "sha", "key").agg(F.count(F.lit(1)).alias("copies"), F.first("hashes").alias("hashes"))
    each = settle(each, "each")
    # The number of blocks belongs to the hash, so that a text meets texts of its length only.
    posed = each.select("key", "copies", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"),
                        F.size("hashes").alias("n_blocks"))
    shared = (posed.groupBy("hash", "n_blocks").agg(F.count(F.lit(1)).alias("texts"))
              .filter("texts > 1").select(F.col("hash").alias("h"), F.col("n_blocks").alias("n2")))
    # Only texts whose blocks all occur elsewhere can have an equal.
    maybe = (posed.join(shared, (F.col("hash") == F.col("h")) & (F.col("n_blocks") == F.col("n2")))
             .groupBy("key", "n_blocks").agg(F.count(F.lit(1)).alias("found")).filter("found = n_blocks"))
    maybe = settle(maybe.select("key", "n_blocks"), "maybe")
    texts = (base.select(key.alias("key"), "body").join(maybe, "key")
             .dropDuplicates(["key"]))
    named = settle(_identities(texts, block_bytes).select("key", "n_blocks", "name"), "identities")
    members = named.join(each.select("key", "id", "copies"), "key")
    groups = members.groupBy("n_blocks", "name").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    found = (members.select("key", "n_blocks", "name").join(groups, ["n_blocks", "name"])
             .select(F.col("key").alias("k"), "keep_id", "group_size"))
    out = (each.join(found, F.col("key") == F.col("k"), "left")
           .withColumn("whole", F.coalesce("group_size", "copies"))
           .withColumn("stays", F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("keep_id"))))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return (out.select("id", "stays", "whole", "sha", copy)
            .select(F.col("id").alias(id_col), F.col("stays").alias("keep_id"), F.col("whole").alias("group_size"),
                    (F.col("id").eqNullSafe(F.col("stays")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Of rows that agree in id and text (A-Z lower-cased), one is taken.
    """
    sha_col = fresh(docs, "row_sha")
    marked = docs.withColumn(sha_col, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias(fresh(marked, "kept_id")), F.col("text_sha256").alias(fresh(marked, "kept_sha")))
    stay = marked.join(kept, same([marked[id_col], marked[sha_col]], [kept[c] for c in kept.columns]), "left_semi")
    return stay.dropDuplicates([id_col, sha_col]).drop(sha_col)
