"""Correlation tournament: of each strongly correlated pair, drop the weaker symbol.

Pairs are walked in matrix order. A pair counts only while both its symbols are alive and both
have a known Sharpe ratio; the lower Sharpe loses, a tie drops the later symbol.

Pairs that are given block by block (`StagedPairs`) are walked in stages. A block of the matrix order is walked within itself by one task;
only its survivors meet the live symbols behind it, and those pairs are walked in rounds. So the pairs that are written follow the
symbols that drop out, not the strong pairs: of a family of n look-alikes a symbol or two ever meet the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.expressions import bounded_broadcast, finite
from panelmint.operators.strong_pairs import StagedPairs
from panelmint.session import ensure_checkpoint_dir, written_once


# Partitions of the losers so far, two numbers each, that every stage reads.
FEW = 16


def contests(edges: DataFrame, members: DataFrame, settings: Settings, months: int = 1) -> DataFrame:
    """Pairs above the threshold with their loser: `month, i, j, loser`."""
    bound = None if settings.max_symbols is None else months * settings.max_symbols
    strong = edges.filter(F.abs("rho") > settings.theta)
    for side in ("i", "j"):
        known = members.filter(finite(F.col("sharpe"))).select(
            "month", F.col("ord").alias(side), F.col("sharpe").alias(f"sharpe_{side}")
        )
        strong = strong.join(bounded_broadcast(known, bound), ["month", side])
    loser = F.when(F.col("sharpe_i") < F.col("sharpe_j"), F.col("i")).otherwise(F.col("j"))
    return strong.select("month", "i", "j", loser.alias("loser"))


def losers(pairs: DataFrame) -> DataFrame:
    """The walk over all pairs of a month in parallel rounds: `month, ord`.

    A pair waits for the earlier pairs of its two symbols. A symbol that no earlier symbol still
    contests can walk its own row of pairs, up to its first defeat or to the first opponent whom an
    earlier symbol still contests. Each round settles all such stretches at once, and pairs that
    touch a loser leave. A clique takes one round when its order is that of the ratios, and one
    per new best ratio otherwise. Each round is written to the checkpoint folder.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    live = pairs.checkpoint()
    gone = live.select("month", F.col("loser").alias("ord")).limit(0)
    row = Window.partitionBy("month", "i").orderBy("j")
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    while not live.isEmpty():
        contested = live.groupBy("month", F.col("j").alias("ord")).agg(F.min("i").alias("first"))
        own = contested.select("month", F.col("ord").alias("i"), F.lit(True).alias("waits"))
        other = contested.select("month", F.col("ord").alias("j"), "first")
        walked = (
            live.join(own, ["month", "i"], "left")
            .filter(F.col("waits").isNull())
            .join(other, ["month", "j"])
            .withColumn("halt", F.max((F.col("first") != F.col("i")).cast("int")).over(row.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("lost", F.coalesce(F.max((F.col("loser") == F.col("i")).cast("int")).over(before), F.lit(0)))
        )
        settled = walked.filter("halt = 0 AND lost = 0").select("month", F.col("loser").alias("ord")).distinct().checkpoint()
        gone = gone.unionByName(settled).checkpoint()
        for side in ("i", "j"):
            live = live.join(settled.withColumnRenamed("ord", side), ["month", side], "left_anti")
        live = live.checkpoint()
    return gone


def staged_losers(pairs: StagedPairs, members: DataFrame, settings: Settings, months: int = 1) -> DataFrame:
    """The losers of all stages: `month, ord`."""
    gone = members.select("month", "ord").limit(0)
    for stage in pairs.stages():
        heads, lost = stage.inside(gone)
        gone = written_once(gone.unionByName(lost).coalesce(FEW))
        if stage.block + 1 < pairs.blocks:
            met = contests(stage.beyond(heads, gone), members, settings, months)
            gone = written_once(gone.unionByName(losers(met)).coalesce(FEW))
    return gone


def tournament(edges: DataFrame | StagedPairs, members: DataFrame, settings: Settings, months: int = 1) -> DataFrame:
    """Members that survive: `members` without the losers."""
    if isinstance(edges, StagedPairs):
        out = staged_losers(edges, members, settings, months)
    else:
        out = losers(contests(edges, members, settings, months))
    return members.join(out, ["month", "ord"], "left_anti")
