"""Strongly correlated pairs without the matrix: bounds on some coordinates first, exact products where they leave a doubt.

Symbols are dealt into blocks that are written once (blocks.py). A task reads two blocks, multiplies them strip by strip and emits the pairs
above the threshold only, so no table has a row for each pair and no cell is copied for the blocks it meets.

For thresholds that are high enough, a screen comes first. Let S be a share of the timestamps, drawn by a digest. By the inequality of
Cauchy and Schwarz, the sum of products outside S is at most the product of the two series' norms outside S, so

    |rho| <= (|sum over S - t * mean * mean'| + rest * rest') / (spread * spread')

for each pair, whatever the data. Only block pairs with a pair that this bound cannot rule out are multiplied in full. Symbols are
dealt to blocks by `rest / spread`, so series with few observations in S share blocks and do not keep all others in doubt.

The tournament needs fewer pairs than these: `staged_pairs` gives them block by block in matrix order, without the symbols that earlier
blocks have dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.expressions import finite
from panelmint.functions.kernels import PACKED, block_pairs, dead_bits, lost_rows, pairs_beyond, walk_inside
from panelmint.operators.blocks import largest_size, meetings, packed_blocks, sided, width_for
from panelmint.operators.ranking import distributed_rank
from panelmint.session import written_once

STATISTICS = ("mean", "spread", "rest", "t")
PAIRS = "month int, i int, j int, rho double"


def screen_share(theta: float) -> float | None:
    """Share of the timestamps to screen on: what is left of an even series then correlates at most 0.8 theta. None where
    that asks for more than half of them, and a screen saves less than it costs."""
    share = 1 - 0.8 * theta
    return share if share <= 0.5 else None


def _sampled(share: float) -> Column:
    return F.pmod(F.xxhash64("timestamp"), F.lit(1 << 20)) < int(share * (1 << 20))


def varying_series(chosen: DataFrame, rows: DataFrame, share: float | None) -> DataFrame:
    """`month, ord, t, mean, spread, rest`: one row per varying series; `spread` is the norm of the centred series, `rest` the norm of its
    values outside the screen."""
    square = F.col("ret") * F.col("ret")
    outside = F.lit(0.0) if share is None else F.sum(F.when(~_sampled(share), square).otherwise(0.0))
    sums = chosen.groupBy("month", "ord").agg(F.sum("ret").alias("sx"), F.sum(square).alias("sxx"), outside.alias("out"))
    t = F.col("t")
    term = t * F.col("sxx") - F.col("sx") * F.col("sx")
    # Rounding leaves a tiny residue for a constant column; it counts as no variance and correlates with nothing.
    varying = sums.join(F.broadcast(rows), "month").filter(term > F.lit(1e-12) * t * F.col("sxx"))  # `rows` has one line per month
    return varying.select("month", "ord", "t", (F.col("sx") / t).alias("mean"), F.sqrt(term / t).alias("spread"), F.sqrt("out").alias("rest"))


def series_table(chosen: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """The varying series with their `block` and `slot` in it, dealt by `rest / spread`."""
    series = varying_series(chosen, rows, screen_share(settings.theta))
    ranked = distributed_rank(series, [F.desc(F.col("rest") / F.col("spread")), F.asc("ord")], ("month",), "place")
    place, width = F.col("place") - 1, width_for(rows, largest_size(chosen), settings, 4 * settings.gram_block)
    return ranked.select("*", F.floor(place / width).cast("int").alias("block"), (place % width).cast("int").alias("slot")).drop("place")


def _packed(chosen: DataFrame, series: DataFrame, settings: Settings, sampled: float | None) -> DataFrame:
    """The blocks of the series, with the sampled cells only or with all."""
    cells = chosen if sampled is None else chosen.filter(_sampled(sampled))
    placed = cells.join(series.select("month", "ord", "block", "slot"), ["month", "ord"])
    return packed_blocks(placed, series, STATISTICS)


def _met(packed: DataFrame, series: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """All pairs of blocks, or the wanted ones: at most one line for each two blocks."""
    met = meetings(packed)
    if wanted is None:
        return met
    keys = wanted.select(F.col("month").alias("l_month"), F.col("left").alias("l_block"), F.col("right").alias("r_block"))
    return met.join(F.broadcast(keys), ["l_month", "l_block", "r_block"], "left_semi")


def strong_pairs(chosen: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """`month, i, j, rho` (i < j) of all pairs with |rho| > theta, the same as `correlations` filtered."""
    series = series_table(chosen, rows, settings).persist()
    wanted, share = None, screen_share(settings.theta)
    if share is not None:
        sample = _met(_packed(chosen, series, settings, share), series, None)
        # Written: the products below do not repeat the screen.
        wanted = written_once(sample.mapInPandas(block_pairs(settings.theta, screen=True), "month int, left int, right int"))
    met = _met(_packed(chosen, series, settings, None), series, wanted)
    return met.mapInPandas(block_pairs(settings.theta, screen=False), PAIRS)


@dataclass(frozen=True)
class StagedPairs:
    """Strong pairs among the members with a known Sharpe ratio, block by block in matrix order."""

    packed: DataFrame
    blocks: int
    width: int
    theta: float

    def stages(self) -> Iterator[Stage]:
        return (Stage(self, k) for k in range(self.blocks))


@dataclass(frozen=True)
class Stage:
    pairs: StagedPairs
    block: int

    def _with_dead(self, blocks: DataFrame, gone: DataFrame) -> DataFrame:
        """Blocks with the bits of who has lost: one bit per series, so they are broadcast."""
        losers = gone.withColumn("block", F.floor(F.col("ord") / self.pairs.width).cast("int"))
        bits = losers.groupBy("month", "block").applyInPandas(dead_bits(self.pairs.width), "month int, block int, dead binary")
        return blocks.join(F.broadcast(bits), ["month", "block"], "left")

    def inside(self, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The walk within the block, one task for at most `block_cells` positions: its survivors, and `month, ord` of who lost.

        No pair outside the block bears on it: its pairs come first in each of its rows, and earlier rows are done.
        """
        own = self._with_dead(self.pairs.packed.filter(F.col("block") == self.block), gone)
        walked = written_once(own.mapInPandas(walk_inside(self.pairs.theta, self.pairs.width), PACKED + ", lost binary"))
        return walked.drop("lost"), walked.select("month", "lost").mapInPandas(lost_rows, "month int, ord int")

    def beyond(self, heads: DataFrame, gone: DataFrame) -> DataFrame:
        """Pairs of the survivors with the live symbols of later blocks: `month, i, j, rho`, as far as the walk can come to them."""
        later = sided(self._with_dead(self.pairs.packed.filter(F.col("block") > self.block), gone), "r")
        # At most `block_cells` positions: the survivors of one block.
        met = later.join(F.broadcast(sided(heads, "l")), F.col("l_month") == F.col("r_month"))
        return met.mapInPandas(pairs_beyond(self.pairs.theta, self.pairs.width), PAIRS)


def staged_pairs(chosen: DataFrame, rows: DataFrame, members: DataFrame, settings: Settings) -> StagedPairs:
    """The strong pairs that a tournament of the members can come to. Blocks are as wide as `block_cells` allows: few stages."""
    known = members.filter(finite(F.col("sharpe"))).select("month", "ord", "sharpe")
    size = largest_size(chosen)
    width = width_for(rows, size, settings, max(1, size))
    place = [F.floor(F.col("ord") / width).cast("int").alias("block"), (F.col("ord") % width).cast("int").alias("slot")]
    # Read twice; slots without gaps, in matrix order, are the packing's.
    series = varying_series(chosen, rows, None).join(known, ["month", "ord"]).select("*", *place).persist()
    cells = chosen.join(series.select("month", "ord", "block", "slot"), ["month", "ord"])
    packed = packed_blocks(cells, series, (*STATISTICS, "sharpe"))
    series.unpersist()
    return StagedPairs(packed, (size + width - 1) // width, width, settings.theta)
