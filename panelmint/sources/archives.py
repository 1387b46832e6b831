"""Zipped monthly candle files as a Spark data source: one partition per archive, pruned by name."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from panelmint.sources.klines import normalise_lines

NAME = re.compile(r"^([A-Z0-9]+)-\d+[a-z]+-(\d{4}-\d{2})\.zip$")
LINES_PER_BATCH = 20_000


@dataclass
class Archive(InputPartition):
    path: str
    symbol: str
    month: str


class ArchiveSource(DataSource):
    """Lines of the CSV files inside archives named `BTCUSDT-4h-2025-01.zip`: `symbol, month, file, value`.

    `path` is a folder that the driver and all executors see. Files with other names are left out. The options `symbols` (comma-separated),
    `first` and `last` (months such as `2025-01`, both included) are answered by the names: other archives are never opened. They are
    options and not pushed filters: with those (Spark 4.1.2), an unfiltered read of a frame after a filtered one saw the filtered archives only.
    """

    @classmethod
    def name(cls) -> str:
        return "candle_archives"

    def schema(self) -> str:
        return "symbol string, month string, file string, value string"

    def reader(self, schema) -> ArchiveReader:
        if not self.options.get("path"):
            raise ValueError("load() needs the folder of the archives")
        wanted = self.options.get("symbols")
        return ArchiveReader(
            self.options["path"], None if wanted is None else set(wanted.split(",")), self.options.get("first", ""), self.options.get("last", "9999-99")
        )


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, symbols: set[str] | None = None, first: str = "", last: str = "9999-99"):
        self.folder = folder.removeprefix("file:")
        self.symbols, self.first, self.last = symbols, first, last

    def partitions(self) -> list[Archive]:
        named = ((entry.path, NAME.match(entry.name)) for entry in os.scandir(self.folder) if entry.is_file())
        archives = [Archive(path, *found.groups()) for path, found in named if found]
        kept = [a for a in archives if self.first <= a.month <= self.last and (self.symbols is None or a.symbol in self.symbols)]
        return sorted(kept, key=lambda a: (a.month, a.symbol, a.path))

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        """One batch of lines at a time; an archive is never unpacked whole."""
        if partition is None:  # Spark asks for one read where no archive is left
            return
        with zipfile.ZipFile(partition.path) as archive:
            for member in sorted(archive.namelist()):
                if not member.lower().endswith(".csv"):
                    continue
                with archive.open(member) as raw:
                    lines: list[str] = []
                    for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace"):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == LINES_PER_BATCH:
                            yield _batch(partition, lines)
                            lines = []
                    if lines:
                        yield _batch(partition, lines)


def _batch(origin: Archive, lines: list[str]) -> pa.RecordBatch:
    fixed = (origin.symbol, origin.month, os.path.basename(origin.path))
    columns = [pa.array([value] * len(lines), pa.string()) for value in fixed]
    return pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.string())], names=["symbol", "month", "file", "value"])


def read_archives(
    spark: SparkSession, folder: str, symbols: Iterable[str] | None = None, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Lines of the archives of a folder, of these symbols and of the months from `first` to `last` only where given."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(ArchiveSource.name())
    given = {"symbols": None if symbols is None else ",".join(symbols), "first": first, "last": last}
    return reader.options(**{k: v for k, v in given.items() if v is not None}).load(folder)


def normalise_archives(lines: DataFrame, quote: str | None = None) -> DataFrame:
    """Lines of archives to processed columns plus `file, symbol`. `quote` keeps symbols that end with it."""
    if quote is not None:
        lines = lines.filter(F.endswith("symbol", F.lit(quote)) & (F.length("symbol") > len(quote)))
    return normalise_lines(lines.select("file", "symbol", "value"))
