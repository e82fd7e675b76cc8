"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of ``BLOCK`` bytes.  Distinct blocks are sorted
and numbered: a block's number is its name, and equal names mean equal bytes,
so there are no collisions.  Then adjacent names are paired, distinct pairs
are sorted and numbered in turn, and so on, until one name is left for each
document: after level k a name stands for up to 2^k blocks.  A document is
done at the level where it has one name; (level, name) is its identity.

The text itself is shuffled once, and equal blocks are combined before that
shuffle.  A block's name is looked up by a 64-bit hash of the block; blocks
whose hash stands for several contents (found while numbering) are looked up
by their bytes instead, so the identity does not rest on the hash.

Defined results: a null text is the empty text, which is one empty block; of
equal texts the row with the largest doc_id stays (a null id counts as less
than any); of repeated rows (same doc_id and text) one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import packed, stage
from tickline.operators.joins import Measured

BLOCK = 2048


def _blocks(data: Column, size: int) -> Column:
    count = F.greatest(F.lit(1), F.ceil(F.length(data) / F.lit(float(size)))).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, size))


def _hash(block: Column, bits: int) -> Column:
    """The lookup hash of a block, of ``bits`` bits (tests make it narrow)."""
    return F.shiftright(F.xxhash64(block), 64 - bits)


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys, sorted within each partition and numbered there."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _block_names(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """(h, name, block): one row per distinct block; ``block`` only where the
    hash h stands for several contents."""
    each = docs.select(F.explode(_blocks(F.col("data"), size)).alias("block")).select(_hash(F.col("block"), bits).alias("h"), "block")
    names = _numbered(each.groupBy("h", "block").agg(F.lit(1).alias("one")).select("h", "block"), "h", "block")
    short = stage(names.select("h", "name"), "block-names")
    crowded = short.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    if crowded.isEmpty():
        return short.withColumn("block", F.lit(None).cast("binary"))
    # Number the blocks of crowded hashes by their bytes, past all other names.
    some = _numbered(each.join(crowded, "h", "left_semi").distinct(), "h", "block").withColumn("name", -1 - F.col("name"))
    return stage(short.join(crowded, "h", "left_anti").withColumn("block", F.lit(None).cast("binary")).unionByName(some), "block-names")


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """One row per different (doc_id, text): doc_id, text_sha256, rows (how
    often it occurs), level, name.  Texts are equal where (level, name) is."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data"))
    names = _block_names(docs, block, hash_bits)
    crowded = names.where("block is not null")
    some = not crowded.isEmpty()
    parts = _blocks(F.col("data"), block)
    listed = docs.select("doc_id", F.sha2("data", 256).alias("text_sha256"), F.transform(parts, lambda b: _hash(b, hash_bits)).alias("hs"),
                         (parts if some else F.lit(None).cast("array<binary>")).alias("blocks"))
    if some:
        side = Measured(crowded.select("h").distinct(), crowded.count()).side()
        listed = (listed.withColumn("i", F.monotonically_increasing_id()).select("*", F.posexplode("hs").alias("pos", "h")).join(side.withColumn("many", F.lit(True)), "h", "left")
                        .withColumn("b", F.when(F.col("many"), F.col("blocks")[F.col("pos")]))
                        .groupBy("i", "doc_id", "text_sha256").agg(F.sort_array(F.collect_list(F.struct("pos", "h", "b"))).alias("parts")))
    else:
        listed = listed.select("doc_id", "text_sha256", F.transform("hs", lambda h, i: F.struct(i.alias("pos"), h.alias("h"), F.lit(None).cast("binary").alias("b"))).alias("parts"))
    rows = stage(listed.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"), F.first("parts").alias("parts"))
                       .withColumn("rid", F.monotonically_increasing_id()), "rows")
    each = rows.select("rid", F.size("parts").alias("left"), F.explode("parts").alias("p")).select("rid", "left", "p.pos", "p.h", "p.b")
    level = each.join(names.where("block is null").select("h", "name"), "h", "left" if some else "inner")
    if some:
        level = (level.join(crowded.select(F.col("h").alias("h2"), F.col("block").alias("b2"), F.col("name").alias("name2")), (F.col("h") == F.col("h2")) & (F.col("b") == F.col("b2")), "left")
                      .withColumn("name", F.coalesce("name", "name2")))
    now = stage(level.select("rid", "left", "pos", "name"), "level")
    done, k = None, 0
    while True:
        ready = now.where("left = 1").select("rid", F.lit(k).alias("level"), "name")
        done = ready if done is None else done.unionByName(ready)
        now = now.where("left > 1")
        if now.isEmpty():
            break
        k += 1
        pairs = now.groupBy("rid", "left", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"))
        # No name beside the last one of an odd row: a pair with null, which is no block's name.
        pairs = stage(pairs.select("rid", ((F.col("left") + 1) / 2).cast("int").alias("left"), "pos", "a", "b"), "pairs")
        named = stage(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "pair-names").select(F.col("a").alias("a2"), F.col("b").alias("b2"), "name")
        now = stage(pairs.join(named, F.col("a").eqNullSafe(F.col("a2")) & F.col("b").eqNullSafe(F.col("b2"))).select("rid", "left", "pos", "name"), "level")
    return stage(rows.select("rid", "doc_id", "text_sha256", "rows").join(done, "rid").drop("rid"), "identities")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    found = identities(docs, doc_id, text, block, hash_bits)
    groups = found.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    # Most groups have one row; only the others are joined.
    groups = stage(groups.where("group_size > 1"), "groups")
    return (found.join(groups, ["level", "name"], "left")
                 .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_copy"))
                 .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"), "text_sha256"))


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row of each text."""
    groups = stage(exact_groups(docs, doc_id, text).where("group_size > 1"), "copies")
    gone = groups.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    # The rows go as one column, so that no name of theirs clashes with the keys.
    row = packed(docs)
    rows = row.select("row", F.col("row")[doc_id].cast("long").alias("id"),
                      F.sha2(F.coalesce(F.col("row")[text].cast("string"), F.lit("")).cast("binary"), 256).alias("sha"))
    key = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))

    def side(df):
        return Measured(df.select("doc_id", "text_sha256"), df.count()).side()

    out = rows.join(side(gone.where("not kept")), key, "left_anti")
    again = gone.where("kept and rows > 1")
    if not again.isEmpty():
        # Repeated rows (same doc_id and text): one of them, whatever else they hold.
        twice = side(again)
        out = out.join(twice, key, "left_anti").unionByName(out.join(twice, key, "left_semi").dropDuplicates(["id", "sha"]))
    return out.select("row.*")
