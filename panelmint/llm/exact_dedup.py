"""Exact duplicates by deterministic block naming, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import land, unused

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def name_blocks(blocks: DataFrame) -> DataFrame:
    """Integer names of distinct block contents. Input (bucket, size, block), output (bucket, size, block, name).

    Contents meet by bucket, are sorted and numbered in that order, so equal contents get one name and different
    ones different names. Copies meet before the shuffle already (partial aggregation): a block that a third of
    all rows share costs one row per map task.
    """
    contents = blocks.groupBy("bucket", "size", "block").agg(F.count(F.lit(1)).alias("n")).drop("n")
    return contents.sortWithinPartitions("bucket", "size", "block").withColumn("name", F.monotonically_increasing_id())


def name_pairs(level: DataFrame) -> DataFrame:
    """One level up: names of adjacent pairs. Input and output: (row, pos, name); an odd last name pairs with -1."""
    pairs = level.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
    )
    pairs = land(pairs, "pairs")
    names = pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n"))
    names = names.sortWithinPartitions("left", "right").withColumn("name", F.monotonically_increasing_id()).drop("n")
    return land(pairs.join(land(names, "pair-names"), ["left", "right"]).select("row", "pos", "name"), "level")


def exact_groups(docs: DataFrame, block_bytes: int = 8192, buckets: int | None = None) -> DataFrame:
    """Which rows of `docs` have equal normalised texts, and which row of each group stays.

    Texts are cut into blocks of `block_bytes` bytes. Distinct blocks get integer names; adjacent names are
    paired and named again, level by level, until each row has one name of one level: its identity. Texts of
    different block counts are never equal, so an identity is (number of blocks, name). Names come from
    comparing contents, never from a digest alone: a hash only chooses where contents meet, and contents that
    share a hash (`buckets` forces that in tests) are told apart by their bytes.

    Returns one row per input row: doc_id, keep_id (smallest doc_id of the group), group_size, kept,
    text_sha256. The row with the smallest doc_id stays; of rows that repeat that doc_id with the same text one
    does (kept is true for one of them). Rows without doc_id count in their group and stay only if no other
    row of it has one. Null text equals empty text. An empty table gives an empty result.
    """
    text = normalised(F.col("text")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("body") / block_bytes).cast("int") - 1)),
        lambda k: F.struct(k.cast("long").alias("pos"), F.substring("body", k * block_bytes + 1, F.lit(block_bytes)).alias("block")),
    )

    # What every later step reads: narrow rows, written once, so that row numbers are settled.
    narrow = rows.withColumn("row", F.monotonically_increasing_id()).select(
        "row",
        "doc_id",
        F.sha2("body", 256).alias("text_sha256"),
        F.transform(pieces, lambda p: F.struct(p["pos"].alias("pos"), _bucket(p["block"], buckets).alias("bucket"), F.length(p["block"]).alias("size"))).alias("blocks"),
    )
    narrow = land(narrow, "rows")
    places = narrow.select("row", F.inline("blocks"))

    blocks = rows.select(F.explode(pieces).alias("p")).select("p.block")
    blocks = blocks.select(_bucket(F.col("block"), buckets).alias("bucket"), F.length("block").alias("size"), "block")
    names = land(name_blocks(blocks).drop("block"), "block-names")
    crowds = land(names.groupBy("bucket", "size").count().where("count > 1").drop("count"), "crowds")
    level = places.join(names, ["bucket", "size"])
    if not crowds.isEmpty():  # different contents under one hash: these few find their name by content
        apart = land(name_blocks(blocks.join(crowds, ["bucket", "size"], "left_semi")), "crowded-names")
        numbered = rows.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode(pieces).alias("p"))
        again = numbered.select("row", "p.pos", "p.block", _bucket(F.col("p.block"), buckets).alias("bucket"), F.length("p.block").alias("size"))
        found = again.join(apart, ["bucket", "size", "block"]).withColumn("name", -2 - F.col("name"))
        level = level.join(crowds, ["bucket", "size"], "left_anti").unionByName(found.drop("block"))
    level = land(level.select("row", "pos", "name"), "level")

    sizes = narrow.select("row", F.size("blocks").alias("n_blocks"))
    longest = sizes.agg(F.max("n_blocks")).first()[0] or 0
    identity, depth = level.join(sizes.where("n_blocks = 1"), "row").select("row", "name", F.lit(0).alias("depth")), 0
    level = level.join(sizes.where("n_blocks > 1").select("row"), "row", "left_semi")
    while longest > 1:
        level, depth, longest = name_pairs(level), depth + 1, (longest + 1) // 2
        done = F.col("n_blocks").between((1 << (depth - 1)) + 1, 1 << depth)
        ready = sizes.where(done).select("row")
        identity = identity.union(level.join(ready, "row").select("row", "name", F.lit(depth).alias("depth")))
        if longest > 1:
            level = level.join(sizes.where(F.col("n_blocks") > (1 << depth)).select("row"), "row", "left_semi")

    member = land(narrow.select("row", "doc_id", "text_sha256").join(identity, "row"), "members")
    groups = member.groupBy("depth", "name").agg(
        F.min("doc_id").alias("keep_id"),
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))).alias("best"),
    )
    return member.join(groups, ["depth", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "row"
    )


def _bucket(block: Column, buckets: int | None) -> Column:
    return F.xxhash64(block) if buckets is None else F.pmod(F.xxhash64(block), F.lit(buckets))


def drop_exact(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs`, all columns, without exact copies. `docs` must be read from a table, so that row numbers hold."""
    (row,) = unused(docs, "__row")
    kept = exact_groups(docs, **options).where("kept").select(F.col("row").alias(row))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(kept, row, "left_semi").drop(row)
