import random

import pytest
from pyspark.sql import functions as F

from panelmint.functions.expressions import is_leveraged, month_index
from panelmint.operators import universe
from panelmint.sources import listings

QUOTE = "USDT"


def names(frame):
    return [r["symbol"] for r in frame.collect()]


def symbols(spark, values):
    return spark.createDataFrame([(v,) for v in values], "symbol string")


def test_leveraged_names(spark):
    rng = random.Random(2)
    given = ["BTCUPUSDT", "UPUSDT", "JUPUSDT", "SUPERUSDT", "BTCUPEUR", "ADADOWNUSDT", "XBULLUSDT"]
    given += ["".join(rng.choice("UPDOWNBLEARX") for _ in range(rng.randint(1, 7))) + QUOTE for _ in range(2000)]

    def expected(s):
        if not s.endswith(QUOTE):
            return False
        base = s[: -len(QUOTE)]
        return any(base == t or (base.endswith(t) and len(base) - len(t) >= 2) for t in ("UP", "DOWN", "BULL", "BEAR"))

    got = symbols(spark, given).select("symbol", is_leveraged(F.col("symbol"), QUOTE).alias("l")).collect()
    assert [r["l"] for r in got] == [expected(s) for s in given]
    assert [expected(s) for s in given[:4]] == [True, True, False, False]


def test_month_index(spark):
    rows = spark.createDataFrame([(2024, 10), (2024, 12), (2025, 1), (2025, 12)], "y int, m int")
    assert [r[0] for r in rows.select(month_index(F.col("y"), F.col("m"), 2025)).collect()] == [-2, 0, 1, 12]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("listings")
    (folder / "info.json").write_text(
        """{"symbols": [
        {"symbol": "AUSDT", "status": "TRADING", "isSpotTradingAllowed": true, "quoteAsset": "USDT"},
        {"symbol": "BUSDT", "status": "TRADING", "isSpotTradingAllowed": true, "quoteAsset": "USDT"},
        {"symbol": "CUSDT", "status": "TRADING", "isSpotTradingAllowed": true, "quoteAsset": "USDT"},
        {"symbol": "DUSDT", "status": "TRADING", "isSpotTradingAllowed": true, "quoteAsset": "USDT"},
        {"symbol": "HALT", "status": "BREAK", "isSpotTradingAllowed": true, "quoteAsset": "USDT"},
        {"symbol": "NOSPOT", "status": "TRADING", "isSpotTradingAllowed": false, "quoteAsset": "USDT"},
        {"symbol": "AEUR", "status": "TRADING", "isSpotTradingAllowed": true, "quoteAsset": "EUR"}]}"""
    )
    (folder / "ticker.json").write_text(
        """[{"symbol": "BUSDT", "quoteVolume": "5.5"}, {"symbol": "CUSDT", "quoteVolume": "7"},
        {"symbol": "AUSDT", "quoteVolume": "x"}, {"symbol": "GONEUSDT", "quoteVolume": "99"},
        {"symbol": "AEUR", "quoteVolume": "100"}, {"symbol": "DUSDT"}]"""
    )
    (folder / "listing.txt").write_text("data/klines/AUSDT/\ndata/klines/OLDUSDT/\ndata/klines/OLDUSDT/\ndata/klines/BTCUPUSDT/\ndata/klines/AEUR/\n")
    return dict(
        exchange_info=listings.read_exchange_info(spark, str(folder / "info.json")),
        ticker=listings.read_ticker(spark, str(folder / "ticker.json")),
        listing=listings.read_listing(spark, str(folder / "listing.txt")),
        fallback=symbols(spark, ["XUSDT", "XEUR"]),
        seeds=spark.createDataFrame(
            [(1, 1, "DUSDT"), (1, 2, "GONEUSDT"), (2, 1, "DUSDT")], "cat_pos int, pos int, symbol string"
        ),
    )


def test_listings(sources):
    assert sorted(names(universe.active_symbols(sources["exchange_info"], QUOTE))) == ["AUSDT", "BUSDT", "CUSDT", "DUSDT"]
    assert sorted(names(universe.listing_symbols(sources["listing"], QUOTE))) == ["AUSDT", "OLDUSDT"]
    assert "BTCUPUSDT" in names(universe.listing_symbols(sources["listing"], QUOTE, include_leveraged=True))


def test_volume_rank_with_unreadable_volumes(sources):
    ticker = sources["ticker"]
    order = lambda **k: names(universe.volume_positions(universe.volume_ranked(ticker, QUOTE, **k)).orderBy("position"))
    assert order() == ["GONEUSDT", "CUSDT", "BUSDT", "DUSDT"]
    assert order(zero_unparsed=True) == ["GONEUSDT", "CUSDT", "BUSDT", "AUSDT", "DUSDT"]


@pytest.mark.parametrize(
    "target, want", [(1, ["DUSDT"]), (3, ["DUSDT", "CUSDT", "BUSDT"]), (9, ["DUSDT", "CUSDT", "BUSDT", "AUSDT"])]
)
def test_diversified_order(sources, target, want):
    active = universe.active_symbols(sources["exchange_info"], QUOTE)
    ranked = universe.volume_ranked(sources["ticker"], QUOTE)
    got = universe.diversified_universe(sources["seeds"], ranked, active, target).orderBy("position")
    assert names(got) == want


def test_modes_and_fallbacks(sources):
    def resolve(mode, **changes):
        return sorted(names(universe.resolve_universe(mode, QUOTE, **{**sources, **changes})))

    assert resolve("top100") == ["XUSDT"]
    assert resolve("historical-usdt") == ["AUSDT", "OLDUSDT"]
    assert resolve("historical-usdt", listing=None, exchange_info=None) == ["XUSDT"]
    assert resolve("ALL-usdt") == ["AUSDT", "BUSDT", "CUSDT", "DUSDT"]
    assert resolve("diversified", target=2) == ["CUSDT", "DUSDT"]
    assert resolve("diversified", exchange_info=None) == ["XUSDT"]
    with pytest.raises(ValueError):
        resolve("other")
