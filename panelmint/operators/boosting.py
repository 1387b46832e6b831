"""Boosted regression trees for all groups of a table in one fit: histograms by DataFrame aggregation."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmint.session import written_once

STATE = ["group", "key", "bins", "target", "is_train", "score"]


@dataclass(frozen=True)
class Boosting:
    """Squared loss; a first tree of weight 1, then trees of weight `step` on twice the residual."""

    trees: int
    depth: int
    step: float
    bins: int = 32
    rows_per_task: int = 100_000

    def fit_predict(self, rows: DataFrame, group: str, keys: list[str], features: list[str]) -> DataFrame:
        """Fit one model per `group` on the rows with `is_train`, score the others: `group, keys, target, prediction`.

        `rows` holds the features and `target` (both never null), `is_train`, the group and the keys. A group without training
        rows has no model and gives no rows.

        Cost: one scan of the binned rows per tree level, for all groups together, and `groups x 2^depth x features x bins` cells
        after the map-side sums; a group of any size is spread over all tasks. The driver holds the trees of one round
        only: at most `groups x 2^(depth + 1)` nodes, whatever the rows.
        """
        state = written_once(self._binned(rows, group, keys, features))
        tasks = max(1, math.ceil(state.count() / self.rows_per_task))
        trained = [r["group"] for r in state.filter("is_train").select("group").distinct().collect()]
        state = state.coalesce(tasks)
        for k in range(self.trees):
            trees = self._grow(state, k)
            if not trees:
                break
            grown = state.join(F.broadcast(_table(state.sparkSession, trees)), "group")  # a row per group
            value = F.get("value", _node(self.depth) - 1) * (1.0 if k == 0 else self.step)
            # Written, so that a plan holds one tree whatever their number.
            state = written_once(grown.select(*STATE[:-1], (F.col("score") + value).alias("score")))
        named = [F.col("key")[c].alias(c) for c in keys]
        scored = state.filter(~F.col("is_train") & F.col("group").isin(trained))
        return scored.select(F.col("group").alias(group), *named, "target", F.col("score").alias("prediction"))

    def _binned(self, rows: DataFrame, group: str, keys: list[str], features: list[str]) -> DataFrame:
        """Features as bin numbers: how many of the group's training quantiles lie below the value.
        A value that more than 1 / `bins` of the group's training rows share has a bin of its own."""
        shares = [k / self.bins for k in range(1, self.bins)]
        cuts = rows.filter("is_train").groupBy(F.col(group).alias("group")).agg(
            F.array(*[F.array_distinct(F.percentile_approx(c, shares, 10_000)) for c in features]).alias("cuts")
        )
        placed = rows.select(
            F.col(group).alias("group"), F.struct(*keys).alias("key"), F.array(*features).alias("x"), "target", "is_train"
        ).join(F.broadcast(cuts), "group")  # a row per group, `features x bins` numbers each

        def place(x: Column, k: Column) -> Column:
            return F.size(F.filter(F.get("cuts", k), lambda cut: cut < x))

        return placed.select("group", "key", F.transform("x", place).alias("bins"), "target", "is_train", F.lit(0.0).alias("score"))

    def _grow(self, state: DataFrame, round_: int) -> dict[int, Tree]:
        """One tree per group, level by level."""
        label = F.col("target") if round_ == 0 else 2 * (F.col("target") - F.col("score"))
        train = state.filter("is_train")
        trees: dict[int, Tree] = defaultdict(Tree)
        for level in range(self.depth):
            met = train.join(F.broadcast(_table(state.sparkSession, trees)), "group") if level else train
            node = _node(level) if level else F.lit(1)
            at = met.select("group", node.alias("node"), "bins", label.alias("label"))
            splits = best_splits(at.filter(F.col("node") >= 1 << level) if level else at).collect()
            for r in splits:
                trees[r["group"]].take(r)
            if not any(r["feature"] is not None for r in splits):
                break
        return trees


@dataclass
class Tree:
    """Nodes by heap number: the children of n are 2n and 2n + 1; a node without a cut is a leaf."""

    feature: dict[int, int] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def take(self, split) -> None:
        node = split["node"]
        self.value[node] = split["mean"]
        if split["feature"] is not None:
            self.feature[node], self.cut[node] = split["feature"], split["cut"]
            self.value[2 * node], self.value[2 * node + 1] = split["left"], split["right"]


def best_splits(rows: DataFrame) -> DataFrame:
    """`group, node, mean` and, where a cut lowers the squared error, `feature, cut, left, right` (means of the sides).

    `rows` are `group, node, bins, label`; a cut sends bins up to it to the left. Ties go to the first feature, then the lowest cut.
    """
    cells = (
        rows.select("group", "node", "label", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("group", "node", "feature", "bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("s"))
    )
    # A node has `features x bins` cells at most. Each feature's cells hold all rows of the node, so one running
    # sum over all features serves: earlier features contribute the node's total each.
    node = Window.partitionBy("group", "node")
    so_far = node.orderBy("feature", "bin").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("feature") == 0
    first = F.col("feature") == 0
    total_n, total_s = F.sum(F.when(first, F.col("n"))).over(node), F.sum(F.when(first, F.col("s"))).over(node)
    sums = cells.select(
        "group", "node", "feature", "bin", total_n.alias("n"), total_s.alias("s"),
        (F.sum("n").over(so_far) - F.col("feature") * total_n).alias("nl"), (F.sum("s").over(so_far) - F.col("feature") * total_s).alias("sl"),
    )
    left, right = F.try_divide("sl", "nl"), F.try_divide(F.col("s") - F.col("sl"), F.col("n") - F.col("nl"))
    sides = F.col("sl") * left + (F.col("s") - F.col("sl")) * right
    gain = sides - F.col("s") * F.col("s") / F.col("n")
    option = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), left.alias("left"), right.alias("right"))
    best = sums.groupBy("group", "node").agg(F.max(F.when(gain > 1e-12 * sides, option)).alias("best"), F.first(F.col("s") / F.col("n")).alias("mean"))
    return best.select("group", "node", "mean", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("cut"), "best.left", "best.right")


def _node(levels: int) -> Column:
    """Where a row with `bins` stands after `levels` steps down the tree (`feature`, `cut`) beside it.

    A fold over the levels: steps written out one inside the other would repeat each step's expression in the next.
    """

    def down(node: Column, _: Column) -> Column:
        cut = F.get("cut", node - 1)
        met = F.get("bins", F.get("feature", node - 1))
        return F.when(cut.isNull(), node).otherwise(2 * node + (met > cut).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), down)


def _table(spark: SparkSession, trees: dict[int, Tree]) -> DataFrame:
    """One row per group: arrays by node number."""

    def dense(values: dict, size: int) -> list:
        return [values.get(k) for k in range(1, size + 1)]

    size = max((max(t.value) for t in trees.values()), default=0)
    kinds = {"feature": pa.int32(), "cut": pa.int32(), "value": pa.float64()}
    columns = {name: pa.array([dense(getattr(t, name), size) for t in trees.values()], pa.list_(kind)) for name, kind in kinds.items()}
    return spark.createDataFrame(pa.table({"group": pa.array(list(trees), pa.int32()), **columns}))
