"""Readers for raw and processed candle files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmint.functions.expressions import MICROS_FROM, MILLIS_FROM, epoch_to_timestamp

# Field order of the raw files and of the processed files.
RAW_FIELDS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_volume", "trades", "taker_buy_base", "taker_buy_quote", "ignore",
]
PROCESSED_SCHEMA = (
    "datetime string, open double, high double, low double, close double, volume double, "
    "quote_volume double, trades bigint, taker_buy_base double, taker_buy_quote double, ignore double"
)
# A processed row keeps all values but the close time.
VALUE_FIELDS = [f for f in RAW_FIELDS if f not in ("open_time", "close_time")]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ANY_QUOTE = "[A-Z0-9]+"


def file_symbol(quote: str | None = None) -> Column:
    """Symbol from the file name, e.g. `BTCUSDT-4h-2025-01.csv`; rows of other files get ''."""
    name = f"({ANY_QUOTE}{quote})" if quote else f"({ANY_QUOTE})"
    return F.regexp_extract(F.col("_metadata.file_name"), name + r"-\d+h-", 1)


def read_processed(spark: SparkSession, paths: str | list[str], quote: str | None = None) -> DataFrame:
    """Processed CSVs with header, one symbol per file; files with other names are left out."""
    rows = spark.read.schema(PROCESSED_SCHEMA).option("header", True).csv(paths)
    return with_timestamp(rows.select("*", file_symbol(quote).alias("symbol")).filter(F.col("symbol") != ""))


def with_timestamp(processed: DataFrame) -> DataFrame:
    parsed = F.try_to_timestamp("datetime", F.lit(TIME_FORMAT))
    return processed.withColumn("timestamp", parsed.cast("timestamp_ntz"))


def normalise_raw(spark: SparkSession, paths: str | list[str], quote: str | None = None) -> DataFrame:
    """Raw headerless files to processed columns plus `file, symbol`, in one distributed pass.

    Short rows, blank lines and rows whose first field holds a letter are skipped. Rows of a file
    that was already processed carry a text time in the first of eleven fields and pass through.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"), file_symbol(quote).alias("symbol"))
    return normalise_lines(lines.filter(F.col("symbol") != ""))


def normalise_lines(lines: DataFrame) -> DataFrame:
    """`file, symbol, value` (a line of a raw file) to processed columns; see normalise_raw()."""
    named = lines.select("file", "symbol", F.split(F.trim("value"), ",").alias("fields"))
    fields = F.col("fields")
    first = F.trim(fields[0])
    raw = named.filter((F.size(fields) >= len(RAW_FIELDS)) & first.rlike("^-?[0-9]+$"))
    places = {name: F.get(fields, F.lit(RAW_FIELDS.index(name))) for name in VALUE_FIELDS}
    opened = F.date_format(epoch_to_timestamp(first.cast("bigint")), TIME_FORMAT)
    fresh = raw.select("file", "symbol", opened.alias("datetime"), *_typed(places))
    done = named.filter((F.size(fields) == 1 + len(VALUE_FIELDS)) & first.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} "))
    places = {name: F.get(fields, F.lit(1 + k)) for k, name in enumerate(VALUE_FIELDS)}
    passed = done.select("file", "symbol", first.alias("datetime"), *_typed(places))
    return fresh.unionByName(passed)


def _typed(places: dict[str, Column]) -> list[Column]:
    kinds = dict(field.strip().split(" ") for field in PROCESSED_SCHEMA.split(","))
    return [place.try_cast(kinds[name]).alias(name) for name, place in places.items()]


def require_converted(spark: SparkSession, normalised: DataFrame, paths: str | list[str]) -> None:
    """Raise if one of the input files gave no row."""
    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_name").alias("file"))
    empty = files.join(normalised.select("file").distinct(), "file", "left_anti")
    failed = [r["file"] for r in empty.orderBy("file").limit(20).collect()]
    if failed:
        raise ValueError(f"no rows converted from: {', '.join(failed)}")


SALTS = 64


def times_by_column(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Read a time column whose unit is common to all rows of a file (or other key).

    When more than 95 % of a key's values are numbers, the unit follows from their median;
    otherwise the values are read as text. Adds `timestamp`, null for what cannot be read.

    "The median reaches a bound" is decided from counts and the two values around the bound, so
    the values of a key are never gathered in one place.
    """
    number = F.col(text).try_cast("double")
    keyed = rows.withColumn("number", number)

    def reaches(bound: int) -> tuple[Column, Column, Column]:
        above = F.col("number") >= bound
        return (
            F.count_if(above),
            F.max(F.when(~above, F.col("number"))),
            F.min(F.when(above, F.col("number"))),
        )

    names = [f"{unit}_{part}" for unit in ("us", "ms") for part in ("above", "below_max", "above_min")]
    parts = [*reaches(MICROS_FROM), *reaches(MILLIS_FROM)]
    stats = keyed.groupBy(key).agg(
        F.count("*").alias("n"),
        F.count("number").alias("n_number"),
        *[p.alias(name) for p, name in zip(parts, names)],
    )

    def median_reaches(unit: str, bound: int) -> Column:
        twice = 2 * F.col(f"{unit}_above")
        middle = (F.col(f"{unit}_below_max") + F.col(f"{unit}_above_min")) / 2
        return (twice > F.col("n_number")) | ((twice == F.col("n_number")) & (middle >= bound))

    unit = (
        F.when(~(F.col("n_number") > 0.95 * F.col("n")), "text")
        .when(median_reaches("us", MICROS_FROM), "us")
        .when(median_reaches("ms", MILLIS_FROM), "ms")
        .otherwise("s")
    )
    whole = F.col("number").cast("bigint")
    stamp = (
        F.when(F.col("unit") == "us", F.timestamp_micros(whole))
        .when(F.col("unit") == "ms", F.timestamp_millis(whole))
        .when(F.col("unit") == "s", F.timestamp_seconds(F.col("number")))
        .otherwise(F.try_to_timestamp(text))
        .cast("timestamp_ntz")
    )
    # A few keys may own all rows: each meets its unit in SALTS places.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    units = stats.select(key, unit.alias("unit")).withColumn("salt", salts)
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
    return salted.join(units, [key, "salt"]).withColumn("timestamp", stamp).drop("number", "salt")
