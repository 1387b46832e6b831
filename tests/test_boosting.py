"""Grouped boosted trees against MLlib's, a fit in plain numpy, and odd groups."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panelmint.operators.boosting import Boosting, best_splits
from panelmint.operators.models import vectors

SCHEMA = "month int, symbol string, a double, b double, target double, is_train boolean"


def made_rows(months=(3, 7), n=900, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for m in months:
        a, b = rng.normal(size=n), rng.uniform(-1, 1, n)
        y = np.sin(2 * a) * m + (b > 0.2) * 2 + rng.normal(0, 0.3, n)
        rows += [(m, f"S{k}", float(a[k]), float(b[k]), float(y[k]), k % 4 != 0) for k in range(n)]
    return rows


def errors(scored):
    found = scored.groupBy("month").agg(F.sqrt(F.avg((F.col("target") - F.col("prediction")) ** 2)).alias("rmse"), F.count("*").alias("n"))
    return {r["month"]: (r["rmse"], r["n"]) for r in found.collect()}


def test_as_good_as_mllib_per_group(spark):
    rows = spark.createDataFrame(made_rows(), SCHEMA).persist()
    ours = errors(Boosting(6, 3, 0.1).fit_predict(rows, "month", ["symbol"], ["a", "b"]))
    model = GBTRegressor(featuresCol="features", labelCol="target", maxIter=6, maxDepth=3, stepSize=0.1, seed=1)
    for month in (3, 7):
        one = vectors(rows.filter(F.col("month") == month), ["a", "b"])
        theirs = errors(model.fit(one.filter("is_train")).transform(one.filter("not is_train")))[month]
        assert ours[month][1] == theirs[1] == 225
        assert ours[month][0] <= 1.02 * theirs[0]


def plain_tree(x, y, depth):
    """Exact greedy tree on values, first feature and lowest cut on ties: (x) -> prediction."""
    options = []
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            options.append((left.sum() * y[left].mean() ** 2 + (~left).sum() * y[~left].mean() ** 2 - len(y) * y.mean() ** 2, -f, -cut))
    if depth == 0 or not options or max(options)[0] <= 1e-12 * len(y) * max(y.mean() ** 2, 1e-9):
        return lambda _: y.mean()
    _, f, cut = max(options)
    f, cut, left = -f, -cut, x[:, -f] <= -cut
    low, high = plain_tree(x[left], y[left], depth - 1), plain_tree(x[~left], y[~left], depth - 1)
    return lambda v: low(v) if v[f] <= cut else high(v)


def test_equals_plain_boosting_on_few_values(spark):
    """Where each value fills a share of 1 / bins every cut is at hand, and trees are the exact greedy ones."""
    rng = np.random.default_rng(3)
    drawn = lambda n: rng.permutation(np.arange(150) // 3 % n * 1.5)
    rows = []
    for m in (1, 2, 4):
        a, b, y = drawn(6), drawn(4), rng.normal(size=150)
        rows += [(m, f"S{k}", float(a[k]), float(b[k]), float(y[k]), k % 3 > 0) for k in range(150)]
    got = Boosting(3, 3, 0.1).fit_predict(spark.createDataFrame(rows, SCHEMA), "month", ["symbol"], ["a", "b"])
    for month in (1, 2, 4):
        train = [r for r in rows if r[0] == month and r[5]]
        x, y = np.array([r[2:4] for r in train]), np.array([r[4] for r in train])
        trees, score = [], np.zeros(len(y))
        for k in range(3):
            tree = plain_tree(x, y if k == 0 else 2 * (y - score), 3)
            trees.append((1.0 if k == 0 else 0.1, tree))
            score += trees[-1][0] * np.array([tree(v) for v in x])
        want = {r[1]: sum(w * t(np.array(r[2:4])) for w, t in trees) for r in rows if r[0] == month and not r[5]}
        found = {r["symbol"]: r["prediction"] for r in got.filter(F.col("month") == month).collect()}
        assert found == pytest.approx(want)


def test_odd_groups(spark):
    """No training rows: no rows out. One training row, or equal targets: their mean. No held-out rows: none out. Repeated rows count twice."""
    rows = [(1, "A", 1.0, 2.0, 5.0, False), (2, "A", 1.0, 2.0, 5.0, True), (2, "B", 9.0, 9.0, 1.0, False), (2, "B", 9.0, 9.0, 1.0, False)]
    rows += [(3, f"S{k}", float(k), 0.0, 2.5, k < 6) for k in range(8)] + [(4, "A", 0.0, 0.0, 1.0, True)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = Boosting(4, 2, 0.1).fit_predict(frame, "month", ["symbol"], ["a", "b"])
    assert sorted((r["month"], r["symbol"], r["prediction"]) for r in got.collect()) == [(2, "B", 5.0), (2, "B", 5.0), (3, "S6", 2.5), (3, "S7", 2.5)]
    assert Boosting(4, 2, 0.1).fit_predict(frame.limit(0), "month", ["symbol"], ["a", "b"]).count() == 0


def test_best_cut_and_ties(spark):
    rows = [(1, 1, [0, 0], 0.0), (1, 1, [0, 0], 0.0), (1, 1, [1, 1], 6.0), (1, 1, [2, 1], 6.0), (1, 2, [0, 3], 1.0)]
    got = {r["node"]: r for r in best_splits(spark.createDataFrame(rows, "group int, node int, bins array<int>, label double")).collect()}
    assert tuple(got[1]) == (1, 1, 3.0, 0, 0, 0.0, 6.0)
    assert got[2]["feature"] is None and got[2]["mean"] == 1.0
