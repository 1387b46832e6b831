"""Leading principal components of many symbols, without their covariance matrix.

Block Krylov iteration with Rayleigh-Ritz: a few start vectors are multiplied by the covariance again and again, each product is made
orthogonal to all before it, and the components are those of the covariance seen in that basis. A product takes two aggregations of
the returns (scores by timestamp, then loadings by symbol). Only products of basis vectors, a few hundred by a few, reach the driver;
vectors stay in tables with one row per symbol. All months run in the same jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmint.config import Settings
from panelmint.functions.kernels import basis_products, combined
from panelmint.session import written_once

VECTOR = "month int, ord int, v binary"


def _covariance_times(chosen: DataFrame, vectors: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """`month, ord, v`: C v for the last `width` numbers of each symbol's vector, C the covariance of zero-imputed returns."""
    columns = [f"v{k}" for k in range(width)]
    unpacked = vectors.mapInPandas(_unpacked(width), "month int, ord int, " + ", ".join(f"{c} double" for c in columns))
    scores = chosen.join(unpacked, ["month", "ord"]).groupBy("month", "timestamp").agg(*[F.sum(F.col("ret") * F.col(c)).alias(c) for c in columns])
    scores = written_once(scores)  # one row per timestamp; read for the products and for their mean
    total = scores.groupBy("month").agg(*[F.sum(c).alias(f"sum_{c}") for c in columns]).join(rows, "month")
    loads = chosen.join(scores, ["month", "timestamp"]).groupBy("month", "ord").agg(
        F.sum("ret").alias("sx"), *[F.sum(F.col("ret") * F.col(c)).alias(c) for c in columns]
    )
    # `total` has one line per month.
    centred = [((F.col(c) - F.col("sx") * F.col(f"sum_{c}") / F.col("t")) / (F.col("t") - 1)).alias(c) for c in columns]
    product = loads.join(F.broadcast(total), "month").select("month", "ord", *centred)
    return product.mapInPandas(_packed(columns), VECTOR)


def _unpacked(width: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                last = np.stack([np.frombuffer(v, "<f8")[-width:] for v in frame["v"]])
                yield pd.concat([frame[["month", "ord"]].reset_index(drop=True), pd.DataFrame(last, columns=[f"v{k}" for k in range(width)])], axis=1)

    return work


def _packed(columns: list[str]):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"month": frame["month"], "ord": frame["ord"], "v": [r.astype("<f8").tobytes() for r in frame[columns].to_numpy()]})

    return work


def _products(paired: DataFrame) -> dict[int, np.ndarray]:
    """Sum over a month's symbols of (basis, product) outer products; one small matrix per task and month reaches the driver."""
    sums: dict[int, np.ndarray] = {}
    for r in paired.mapInPandas(basis_products, "month int, n int, product binary").collect():
        part = np.frombuffer(bytes(r["product"]), "<f8").reshape(r["n"], -1)
        sums[r["month"]] = sums.get(r["month"], 0) + part
    return sums


def _whitener(gram: np.ndarray, scale: float) -> np.ndarray:
    """W with W' gram W = 1 on the directions that are more than rounding, 0 on the others."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(scale, 1e-300) * 1e-20 + values.max(initial=0.0) * 1e-24
    return vectors * np.where(keep, 1 / np.sqrt(np.where(keep, values, 1.0)), 0.0)


def leading_components(
    chosen: DataFrame, rows: DataFrame, settings: Settings, oversampling: int = 6, tolerance: float = 1e-7, most_rounds: int = 60
) -> DataFrame:
    """`month, component, explained_variance, ord, loading`, like `principal_components`, from the returns themselves.

    `chosen` has `month, ord, timestamp, ret`, `rows` the matrix rows per month. The iteration stops when each wanted component has a
    residual ||C v - lambda v|| below `tolerance` times the largest eigenvalue, or when a basis holds the whole space that
    the returns span. RuntimeError if `most_rounds` do not suffice.
    """
    # A covariance needs two observations.
    chosen = chosen.join(F.broadcast(rows.filter(F.col("t") > 1).select("month", "t")), "month").drop("t").persist()
    rows = rows.filter(F.col("t") > 1)
    sums = chosen.groupBy("month", "ord").agg(F.sum("ret").alias("sx"), F.sum(F.col("ret") * F.col("ret")).alias("sxx"))
    spread = sums.join(F.broadcast(rows), "month").groupBy("month").agg(F.sum((F.col("sxx") - F.col("sx") * F.col("sx") / F.col("t")) / (F.col("t") - 1)).alias("v"), F.count("*").alias("n"))
    variance = {r["month"]: (max(r["v"], 0.0), r["n"]) for r in spread.collect()}
    if not variance:
        chosen.unpersist()
        return chosen.sparkSession.createDataFrame([], "month int, component int, explained_variance double, ord int, loading double")
    width = settings.components + oversampling

    series = written_once(sums.select("month", "ord"))
    start = [
        (F.pmod(F.xxhash64("ord", F.lit(settings.seed + k)), F.lit(2_000_003)).cast("double") / 2_000_003 - 0.5).alias(f"v{k}") for k in range(width)
    ]
    fresh = series.select("month", "ord", *start).mapInPandas(_packed([f"v{k}" for k in range(width)]), VECTOR)
    months = sorted(variance)
    fresh = written_once(fresh)
    gram = _products(fresh.select("month", "ord", "v", F.col("v").alias("w")))
    basis = written_once(fresh.mapInPandas(combined({m: (None, _whitener(gram[m], np.trace(gram[m]))) for m in months}), VECTOR))
    seen = {m: np.zeros((0, 0)) for m in months}
    answer: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for _ in range(most_rounds):
        product = written_once(_covariance_times(chosen, basis, rows, width))
        paired = written_once(basis.join(product.withColumnRenamed("v", "w"), ["month", "ord"]))
        inside = _products(paired)
        for m in months:
            # The covariance in the basis: its last columns are new, the rest is known.
            size = len(inside[m])
            grown = np.zeros((size, size))
            grown[: len(seen[m]), : len(seen[m])] = seen[m]
            grown[:, size - width :] = inside[m]
            grown[size - width :, :] = inside[m].T
            seen[m] = grown
        # What the basis does not hold of the product, made orthogonal twice against rounding.
        rest = written_once(paired.mapInPandas(combined({m: (inside[m], None) for m in months}, append=False), "month int, ord int, v binary, w binary"))
        again = _products(rest)
        rest = written_once(rest.mapInPandas(combined({m: (again[m], None) for m in months}, append=False), "month int, ord int, v binary, w binary"))
        gram = _products(rest.select("month", "ord", F.col("w").alias("v"), "w"))
        done = True
        for m in months:
            values, vectors = np.linalg.eigh((seen[m] + seen[m].T) / 2)
            order = np.argsort(values)[::-1][: min(settings.components, variance[m][1])]
            last = vectors[-width:, order]
            residual = np.sqrt(np.maximum(np.einsum("ik,ij,jk->k", last, gram[m], last), 0))
            answer[m] = values[order], vectors[:, order]
            done &= bool((residual <= tolerance * max(values.max(), 1e-300)).all())
        if done:
            break
        turns = {m: (None, _whitener(gram[m], float(np.square(seen[m]).sum()) * 1e-8)) for m in months}
        basis = written_once(rest.mapInPandas(combined(turns), VECTOR))
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    loadings = basis.mapInPandas(_loadings(answer, variance), "month int, component int, explained_variance double, ord int, loading double")
    loadings = written_once(loadings)
    chosen.unpersist()
    # The sign of a component is fixed by making its largest entry positive.
    sign = loadings.groupBy("month", "component").agg(F.signum(F.max_by("loading", F.struct(F.abs("loading"), -F.col("ord")))).alias("sign"))
    turned = loadings.join(F.broadcast(sign), ["month", "component"])  # `components` lines per month
    return turned.select("month", "component", "explained_variance", "ord", (F.col("loading") * F.when(F.col("sign") == 0, 1.0).otherwise(F.col("sign"))).alias("loading"))


def _loadings(answer: dict, variance: dict):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for month, own in frame.groupby("month"):
                values, vectors = answer[month]
                total = variance[month][0]
                loading = np.stack([np.frombuffer(v, "<f8") for v in own["v"]]) @ vectors
                for k, value in enumerate(values):
                    yield pd.DataFrame(
                        {"month": np.int32(month), "component": np.int32(k + 1), "explained_variance": value / total if total > 0 else 0.0, "ord": own["ord"].to_numpy("int32"), "loading": loading[:, k]}
                    )

    return work
