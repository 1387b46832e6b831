import zipfile

import pytest
from pyspark.sql import functions as F

from panelmint.sources import archives, klines, lake

TAIL = "1,2,0.5,1.5,10,0,15,7,4,6,0"
JANUARY, FEBRUARY = 1735689600000, 1738368000000
STEP = 4 * 3600 * 1000


@pytest.fixture
def folder(tmp_path):
    """Three symbols, two months; files that are no archives of candles beside them."""
    for symbol in ("AUSDT", "BUSDT", "CEUR"):
        for month, start in (("2025-01", JANUARY), ("2025-02", FEBRUARY)):
            name = f"{symbol}-4h-{month}"
            with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"{name}.csv", f"open_time,{TAIL}\r\n" + "".join(f"{start + k * STEP},{TAIL}\r\n" for k in range(5)) + "\n1,2\n")
                z.writestr("CHECKSUM", "abc")
    with zipfile.ZipFile(tmp_path / "DUSDT-4h-2025-01.zip", "w"):
        pass  # an archive without files
    (tmp_path / "notes.zip").write_text("not an archive")
    (tmp_path / "AUSDT-4h-2025-01.csv").write_text(f"{JANUARY},{TAIL}\n")
    return tmp_path


def opened(frame):
    """Archives that a plan opens."""
    return frame.rdd.getNumPartitions()


def test_archives_equal_unpacked_files(spark, folder, tmp_path):
    flat = tmp_path / "flat"
    flat.mkdir()
    for path in folder.glob("*-4h-*.zip"):
        with zipfile.ZipFile(path) as z:
            for member in z.namelist():
                if member.endswith(".csv"):
                    (flat / member).write_bytes(z.read(member))
    lines = archives.read_archives(spark, str(folder))
    got = archives.normalise_archives(lines).drop("file")
    want = klines.normalise_raw(spark, str(flat)).drop("file")
    assert got.columns == want.columns and got.count() == 30
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    usdt = archives.normalise_archives(lines, "USDT")
    assert {r["symbol"] for r in usdt.select("symbol").distinct().collect()} == {"AUSDT", "BUSDT"}
    candles = klines.with_timestamp(usdt)
    lake.write_lake(candles, str(tmp_path / "lake"))
    assert lake.read_lake(spark, str(tmp_path / "lake")).count() == 20


def test_names_prune_archives(spark, folder):
    read = lambda **given: archives.read_archives(spark, str(folder), **given)
    cases = [({}, 7), ({"symbols": ["AUSDT"]}, 2), ({"symbols": ["AUSDT", "CEUR"], "first": "2025-02"}, 2), ({"first": "2025-02", "last": "2025-03"}, 3), ({"last": "2025-01"}, 4)]
    for given, archives_left in cases:
        assert opened(read(**given)) == archives_left
    one = read(symbols=["BUSDT"], first="2025-01", last="2025-01")
    assert one.filter(F.col("value").startswith(str(JANUARY))).count() == 1 and one.count() == 8
    assert read(symbols=["NONE"]).count() == 0 and read(symbols=[]).count() == 0
    # A frame read with a filter and then without one gives all rows.
    everything = read()
    assert everything.filter("symbol = 'AUSDT'").count() == 16 and everything.count() == 48


def test_long_archive_comes_in_batches_and_a_broken_one_is_an_error(spark, tmp_path):
    n = 2 * archives.LINES_PER_BATCH + 1
    with zipfile.ZipFile(tmp_path / "AUSDT-1m-2025-01.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "".join(f"{JANUARY + k},{TAIL}\n" for k in range(n)))
    reader = archives.ArchiveReader(str(tmp_path))
    sizes = [b.num_rows for b in reader.read(reader.partitions()[0])]
    assert sizes == [archives.LINES_PER_BATCH] * 2 + [1]
    (tmp_path / "BUSDT-1m-2025-01.zip").write_text("broken")
    assert archives.read_archives(spark, str(tmp_path), ["AUSDT"]).count() == n
    with pytest.raises(Exception, match="not a zip file"):
        archives.read_archives(spark, str(tmp_path)).count()
