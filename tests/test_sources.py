from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelmint.operators.returns import time_range
from panelmint.sources import exports, klines, lake

NEW_YEAR = datetime(2025, 1, 1)
TAIL = "1,2,0.5,1.5,10,0,15,7,4,6,0"


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "AUSDT-4h-2025-01.csv").write_text(
        f"open_time,{TAIL}\n1735689600,{TAIL}\n\n1735704000000,{TAIL}\n1735718400000000,{TAIL}\n1735732800,1,2,0.5,1.5,10,0,15,7,4,6\n"
    )
    (folder / "BUSDT-4h-2025-01.csv").write_text(
        "datetime,open,high,low,close,volume,quote_volume,trades,taker_buy_base,taker_buy_quote,ignore\n"
        "2025-01-01 00:00:00,1,2,0.5,1.5,10,15,7,4,6,0\n"
    )
    (folder / "CEUR-4h-2025-01.csv").write_text(f"1735689600,{TAIL[:-1]}\n")
    (folder / "notes.csv").write_text(f"1735689600,{TAIL}\n")
    return folder


def test_raw_files_are_normalised(spark, raw):
    got = klines.normalise_raw(spark, str(raw)).orderBy("symbol", "datetime").collect()
    assert [(r["symbol"], r["datetime"]) for r in got] == [
        ("AUSDT", "2025-01-01 00:00:00"),
        ("AUSDT", "2025-01-01 04:00:00"),
        ("AUSDT", "2025-01-01 08:00:00"),
        ("BUSDT", "2025-01-01 00:00:00"),
        ("CEUR", "2025-01-01 00:00:00"),
    ]
    a, b = got[0].asDict(), got[3].asDict()
    for r in (a, b):
        assert (r["close"], r["volume"], r["quote_volume"], r["trades"], r["taker_buy_quote"], r["ignore"]) == (1.5, 10, 15, 7, 6, 0)
    assert got[4]["ignore"] is None  # an empty last field still is a twelfth field
    assert {r["symbol"] for r in klines.normalise_raw(spark, str(raw), "USDT").collect()} == {"AUSDT", "BUSDT"}


def test_file_without_rows_is_an_error(spark, raw):
    good = [str(raw / f"{s}-4h-2025-01.csv") for s in ("AUSDT", "BUSDT")]
    klines.require_converted(spark, klines.normalise_raw(spark, good), good)
    bad = raw / "DUSDT-4h-2025-01.csv"
    bad.write_text("open_time,open\n1,2\n")
    with pytest.raises(ValueError, match="DUSDT"):
        klines.require_converted(spark, klines.normalise_raw(spark, [*good, str(bad)]), [*good, str(bad)])


def test_lake_round_trip_replaces_and_prunes(spark, raw, tmp_path):
    path = str(tmp_path / "lake")
    candles = klines.with_timestamp(klines.normalise_raw(spark, str(raw)))
    february = candles.withColumn("timestamp", F.col("timestamp") + F.expr("interval 31 days"))
    lake.write_lake(candles, path)
    lake.write_lake(candles.unionByName(february), path)
    stored = lake.read_lake(spark, path)
    assert stored.count() == 10 and set(stored.columns) == {*lake.CANDLE, "year", "month"}
    panel = lake.price_panel(stored, keep=("year", "month"))
    window = time_range(panel, datetime(2025, 2, 1), datetime(2025, 3, 1)).select("symbol", "close")
    assert window.count() == 5
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "open" not in plan.split("ReadSchema")[1]


def test_source_fallback(spark, raw, tmp_path):
    path, csv = str(tmp_path / "lake"), str(raw / "BUSDT-4h-2025-01.csv")
    (row,) = lake.load_candles(spark, path, csv).collect()
    assert (row["symbol"], row["timestamp"]) == ("BUSDT", NEW_YEAR)
    lake.write_lake(klines.with_timestamp(klines.normalise_raw(spark, str(raw))), path)
    assert lake.load_candles(spark, path, csv).count() == 5
    with pytest.raises(FileNotFoundError):
        lake.load_candles(spark, str(tmp_path / "none"), str(tmp_path / "nothing"))


def test_panel_keeps_all_bars_with_a_close(spark):
    rows = [(NEW_YEAR, "A", 1.0), (NEW_YEAR, "B", 0.0), (NEW_YEAR, "C", -1.0), (NEW_YEAR, "D", None)]
    candles = spark.createDataFrame(rows, "timestamp timestamp, symbol string, close double")
    panel = lake.price_panel(candles)
    assert sorted(r["symbol"] for r in panel.collect()) == ["A", "B", "C"]
    assert panel.schema["timestamp"].dataType.simpleString() == "timestamp_ntz"


def test_union_of_many_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"S{k}USDT-4h-2025-01.csv").write_text(
            "datetime,open,high,low,close,volume,quote_volume,trades,taker_buy_base,taker_buy_quote,ignore\n"
            f"2025-01-01 0{k}:00:00,1,2,0.5,1.5,10,15,7,4,6,0\nbad,1,2,0.5,1.5,10,15,7,4,6,0\n"
        )
    got = klines.read_processed(spark, str(tmp_path / "*.csv"), "USDT").collect()
    assert sorted(r["symbol"] for r in got if r["timestamp"]) == ["S0USDT", "S1USDT", "S2USDT"]
    assert sum(r["timestamp"] is None for r in got) == 3


@pytest.mark.parametrize(
    "values, unit",
    [
        ([10**15 - 2, 10**15 + 2], "us"),  # the mean of the two middle values decides
        ([10**15 - 4, 10**15 + 2], "ms"),
        ([1, 10**12, 10**16], "ms"),
        ([1, 2, 10**16], "s"),
        ([10**12 - 1] * 3 + [10**12] * 3, "s"),
    ],
)
def test_unit_follows_the_median(spark, values, unit):
    rows = spark.createDataFrame([("k", str(v)) for v in values], "key string, text string")
    assert {r["unit"] for r in klines.times_by_column(rows, "key", "text").select("unit").collect()} == {unit}


def test_text_times_and_bad_values(spark):
    rows = [("t", "2025-01-01 00:00:00"), ("t", "what"), ("n", "what")] + [("n", "1735689600")] * 30
    got = klines.times_by_column(spark.createDataFrame(rows, "key string, text string"), "key", "text").collect()
    assert {r["unit"] for r in got if r["key"] == "n"} == {"s"}
    assert {r["timestamp"] for r in got} == {NEW_YEAR, None}


def test_reports(spark, tmp_path):
    path = str(tmp_path / "report")
    table = spark.createDataFrame([(2, 0.2, 0.9), (1, 0.7, 0.7)], "component int, explained_variance double, cumulative_variance double")
    exports.write_report(exports.component_report(table), path)
    exports.write_report(exports.component_report(table), path, ["component", "cumulative_variance"])
    assert [p.read_text().split() for p in (tmp_path / "report").glob("*.csv")] == [["component,cumulative_variance", "PC1,0.7", "PC2,0.9"]]
