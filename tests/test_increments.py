from datetime import datetime, timedelta

import pytest

from panelmint.operators.metrics import panel_totals
from panelmint.sources import increments, lake

SCHEMA = "timestamp timestamp_ntz, symbol string, open double, high double, low double, close double, volume double"


def bars(spark, first, n, close=1.0, symbols=("A", "B")):
    rows = [(first + timedelta(days=d), s, 1.0, 2.0, 0.5, close, 3.0) for d in range(n) for s in symbols]
    return spark.createDataFrame(rows, SCHEMA)


def files(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def totals(frame):
    return sorted(tuple(r) for r in frame.select("year", "month", "rows", "symbols").collect())


def agrees(spark, path):
    assert increments.manifest_faults(spark, path).count() == 0
    assert totals(increments.manifest_totals(spark, path)) == totals(panel_totals(lake.read_lake(spark, path).select("symbol", "timestamp")))


def test_overlapping_loads_give_each_bar_once(spark, tmp_path):
    path = tmp_path / "lake"
    assert increments.merge_lake(bars(spark, datetime(2025, 1, 1), 59), str(path)) == [(2025, 1), (2025, 2)]
    agrees(spark, str(path))
    before = files(path)
    # Ten days from 24 February: five are stored already, and get their new close.
    again = bars(spark, datetime(2025, 2, 24), 10, close=7.0, symbols=("B", "C"))
    assert increments.merge_lake(again.unionByName(again), str(path)) == [(2025, 2), (2025, 3)]
    agrees(spark, str(path))
    after = files(path)
    assert {f: t for f, t in after.items() if "month=1/" in f} == {f: t for f, t in before.items() if "month=1/" in f}
    stored = lake.read_lake(spark, str(path))
    assert set(stored.columns) == {*lake.CANDLE, "year", "month"}
    assert stored.count() == stored.select("symbol", "timestamp").distinct().count() == 2 * 59 + 10 + 5
    assert {(r["symbol"], r["close"]) for r in stored.filter("timestamp >= '2025-02-24'").select("symbol", "close").collect()} == {("A", 1.0), ("B", 7.0), ("C", 7.0)}
    first, last = increments.read_manifest(spark, str(path)).filter("symbol = 'C'").selectExpr("min(first_bar)", "max(last_bar)").head()
    assert (first, last) == (datetime(2025, 2, 24), datetime(2025, 3, 5))


def test_a_plan_reads_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "lake")
    increments.merge_lake(bars(spark, datetime(2025, 1, 1), 90), path)
    february = lake.read_lake(spark, path).filter(increments._within([(2025, 2)])).select("close")
    scan = february._jdf.queryExecution().executedPlan().toString()
    filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "year" in filters and "month" in filters and "202502" in filters
    assert "DataFilters: []" in scan and february.count() == 56


def test_empty_odd_and_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "lake")
    none = bars(spark, datetime(2025, 1, 1), 0 + 1).limit(0)
    assert increments.merge_lake(none, path) == []
    odd = spark.createDataFrame(
        [(None, "A", 1.0, 1.0, 1.0, 1.0, 1.0), (datetime(2025, 1, 1), "A", 1.0, 1.0, 1.0, None, 1.0)]
        + [(datetime(2025, 1, 2), "A", o, 1.0, 1.0, 4.0, 1.0) for o in (None, 3.0, 2.0)]
        + [(datetime(2025, 1, 3), None, 1.0, 1.0, 1.0, 5.0, None)],
        SCHEMA,
    )
    for _ in range(2):
        assert increments.merge_lake(odd, path) == [(2025, 1)]
        assert sorted((r["symbol"] or "", r["open"], r["close"]) for r in lake.read_lake(spark, path).collect()) == [("", 1.0, 5.0), ("A", 3.0, 4.0)]
    assert increments.merge_lake(none, path) == [] and lake.read_lake(spark, path).count() == 2


@pytest.mark.parametrize("how", ["rewritten", "never described"])
def test_manifest_that_does_not_fit_is_told_and_mended(spark, tmp_path, how):
    path = str(tmp_path / "lake")
    if how == "rewritten":
        increments.merge_lake(bars(spark, datetime(2025, 1, 1), 40), path)
    lake.write_lake(bars(spark, datetime(2025, 1, 1), 35), path)
    if how == "rewritten":
        assert {r["fault"] for r in increments.manifest_faults(spark, path).collect()} == {"missing", "unknown"}
        increments.write_manifest(spark, path)
    else:
        increments.merge_lake(bars(spark, datetime(2025, 2, 1), 3), path)
    agrees(spark, path)
