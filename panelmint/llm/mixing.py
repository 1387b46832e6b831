"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import unused

STEP = 16.0
STEPS = 96
DIGITS = 12


def uniform(*parts: Column) -> Column:
    """Uniform in (0, 1), from a digest of the parts: the same on every engine, whatever the partitioning."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, alpha: float = 0.5, total: float | None = None) -> DataFrame:
    """(source, n, rate): mean repetitions that bring each source to its share of `total` documents (default: as many
    as there are). Shares follow `weights` (sources without one get none), or n to the power `alpha`: below 1,
    small sources are repeated and large ones thinned. Counts are exact and partially aggregated before their shuffle.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        if any(not w >= 0 for w in weights.values()):
            raise ValueError("weights must be numbers of 0 or more")
        share = F.coalesce(*[F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(float(w))) for s, w in weights.items()], F.lit(0.0))
    counts = counts.withColumn("share", share)
    sums = counts.agg(F.sum("share").alias("shares"), F.sum("n").alias("rows")).first()
    goal = float((sums["rows"] or 0) if total is None else total)
    rate = F.col("share") / sums["shares"] * goal / F.col("n") if sums["shares"] else F.lit(0.0)
    return counts.select("source", "n", rate.alias("rate"))


def _draws(rates: DataFrame) -> DataFrame:
    """Adds `parts` and `cdf`: a Poisson variable of mean `rate` is the sum of `parts` ones of equal mean, at most STEP."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP).cast("int"))
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("c"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        start,
        lambda s, k: F.struct(
            (s["p"] * F.col("mean") / k).alias("p"),
            F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * F.col("mean") / k)).alias("c"),
        ),
    )
    return rates.withColumn("parts", parts).withColumn("mean", mean).withColumn("cdf", grown["c"]).drop("mean")


def poisson_mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    alpha: float = 0.5,
    total: float | None = None,
    seed: int = 0,
    max_sources: int = 10_000,
    shuffle: bool = True,
) -> DataFrame:
    """All columns of `docs`, each row repeated Poisson(rate of its source) times, in a seeded global order.

    The count inverts the Poisson distribution at a uniform number hashed from (seed, doc_id), so it depends on the row alone:
    it survives lost executors and repartitioning. Adds `copy` (0, 1, ...). The shuffle deals rows by a hash of (seed, doc_id, copy)
    and orders each partition by it.

    Rows that repeat a doc_id get the same count each. A null source is a source of its own; a null doc_id hashes as
    one value; null texts are kept. A column named `copy` is replaced. Rates are joined by broadcast where no more than `max_sources` exist (one
    row each), else by an ordinary join, whose hot sources adaptive execution splits. An empty table gives an empty result.
    """
    rates = _draws(source_rates(docs, weights, alpha, total))
    # The bound of the broadcast is proven before the hint is given.
    few = docs.select("source").distinct().limit(max_sources + 1).count() <= max_sources
    source, parts, cdf, n, order = unused(docs, "__source", "__parts", "__cdf", "__n", "__order")
    rates = rates.select(F.col("source").alias(source), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    joined = docs.join(F.broadcast(rates) if few else rates, docs["source"].eqNullSafe(F.col(source)))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)),
        F.lit(0),
        lambda s, k: s + F.size(F.filter(cdf, lambda c: c < uniform(F.lit(seed), F.col("doc_id"), k))),
    )
    counted = joined.withColumn(n, count).where(F.col(n) > 0)
    out = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(n) - 1))).drop(source, parts, cdf, n)
    if not shuffle:
        return out
    lot = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("copy"))
    ties = [c for c in ("text", "source") if c in docs.columns]
    return out.withColumn(order, lot).repartition(order).sortWithinPartitions(order, "doc_id", "copy", *ties).drop(order)
