"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from panelmint.checks import QUERIES
from panelmint.operators.metrics import panel_totals
from panelmint.session import local_session
from panelmint.sources.lake import CANDLE, read_lake, write_lake
from panelmint.sources.tables import event_bars

HEADLINE = [
    "log_returns",
    "asset_metrics",
    "rolling_features",
    "correlation_edges",
    "smart_basket",
    "windowed_metrics",
    "walk_forward",
    "performance",
    "kmeans_clusters",
    "pca_variance",
    "gbt_evaluation",
    "walk_forward_ml",
]


def lake_times(spark, folder: str) -> dict[str, float]:
    """Writing the lake from the event panel, and verifying what was written."""
    path = tempfile.mkdtemp(prefix="panelmint-bench-")
    bars = event_bars(spark, folder)
    candles = bars.select("timestamp", "symbol", *[F.col("close").alias(c) for c in CANDLE[2:6]], F.lit(1.0).alias("volume"))
    start = time.perf_counter()
    write_lake(candles, f"{path}/lake")
    written = time.perf_counter()
    panel_totals(read_lake(spark, f"{path}/lake")).collect()
    return {"lake_write": round(written - start, 3), "lake_verify": round(time.perf_counter() - written, 3)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "16g"))
    names = sys.argv[1:] or HEADLINE
    QUERIES["bars"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up cost
    QUERIES["walk_forward"](spark, folder).collect()  # compiled code and loaded classes count for no query
    took = lake_times(spark, folder)
    for name in names:
        spark.catalog.clearCache()  # nothing kept by one query may serve the next
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
