"""Blocks of return series, written once, and their meetings.

A block is one row with all cells and statistics of its series. Blocks meet in a Cartesian product whose tasks read the two blocks where they
are written, so no cell is copied and what is shuffled and written grows with the cells. A block's width follows from the length of the
matrix: all months of a block number together hold at most `block_cells` positions, whatever the number of symbols or their history.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.kernels import PACKED, pack
from panelmint.session import written_once

# Blocks a side that a matrix is cut into before its blocks grow wider than the least width asked for.
SIDES = 16


def width_for(rows: DataFrame, size: int, settings: Settings, least: int) -> int:
    """Symbols in a block: `least`, or more of that for at most `SIDES` blocks, as far as `block_cells` positions allow. `rows` has `month, t`."""
    stretch = rows.agg(F.sum("t")).first()[0] or 1
    fitting = max(1, settings.block_cells // stretch)
    if fitting < least:
        return fitting
    return least * min(fitting // least, max(1, math.ceil(size / (least * SIDES))))


def largest_size(chosen: DataFrame) -> int:
    return chosen.agg(F.max("size")).first()[0] or 0


def packed_blocks(cells: DataFrame, series: DataFrame, statistics: tuple[str, ...]) -> DataFrame:
    """One row per month and block, from cells `month, block, slot, timestamp, ret` and series `month, block, slot, ord` with statistics.

    The blocks of a number are one partition.
    """
    count = (series.agg(F.max("block")).first()[0] or 0) + 1
    body = cells.select(
        "month", "block", F.lit(0).alias("kind"), "slot", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("stamp"), "ret"
    )
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("double").alias("ret")) for k, c in enumerate(statistics, start=1)])
    head = series.withColumn("of", F.explode(kinds)).select(
        "month", "block", "of.kind", "slot", F.col("ord").cast("long").alias("stamp"), "of.ret"
    )
    # Numbers travel as bytes: large arrays in Arrow batches were seen to end the JVM (Spark 4.1.2).
    dealt = body.unionByName(head).repartitionById(count, F.col("block"))
    return written_once(dealt.mapInPandas(pack, PACKED))


def sided(packed: DataFrame, side: str) -> DataFrame:
    return packed.select([F.col(c).alias(f"{side}_{c}") for c in packed.columns])


def meetings(packed: DataFrame) -> DataFrame:
    """Every pair of blocks of a month, a block with itself included: columns of both with `l_` and `r_`."""
    met = (F.col("l_month") == F.col("r_month")) & (F.col("l_block") <= F.col("r_block"))
    return sided(packed, "l").join(sided(packed, "r").hint("shuffle_replicate_nl"), met)
