"""Landed exchange payloads: arrays of twelve-element klines, one file per symbol and interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kandela.functions.scalars import (
    canonical_symbol, from_epoch_ms, interval_of_file, symbol_of_file, to_number,
)
from kandela.operators.series import candle_bucket
from kandela.schemas import CANDLE, CLEAN_CANDLE, KLINE_FIELDS, PRICES, conform


def _field(kline: Column, name: str) -> Column:
    return F.get(kline, KLINE_FIELDS.index(name))


def _explode_pages(pages: DataFrame, raw: str) -> DataFrame:
    """One row per kline of each page; numbers and strings both arrive as strings."""
    keep = [c for c in pages.columns if c != raw]
    return pages.select(*keep, F.explode(F.from_json(raw, "array<array<string>>")).alias("kline"))


def decode_klines(pages: DataFrame, raw: str = "value") -> DataFrame:
    """Kline pages (JSON text in column ``raw``) to the seven typed candle columns."""
    keep = [c for c in pages.columns if c != raw]
    kline = F.col("kline")
    times = [
        from_epoch_ms(_field(kline, name).try_cast("long")).alias(name) for name in ("open_time", "close_time")
    ]
    numbers = [to_number(_field(kline, name)).alias(name) for name in PRICES]
    return _explode_pages(pages, raw).select(*keep, *times, *numbers).select(*keep, *CLEAN_CANDLE.names)


def read_kline_files(spark: SparkSession, folder: str, whole_file: bool = False) -> DataFrame:
    """A folder of ``{symbol}_{interval}.json`` files or ``name={symbol}_{interval}`` subfolders.

    A file holds one page per line, so its lines split across tasks; ``whole_file`` reads a page
    that is spread over several lines.
    """
    path = F.col("_metadata.file_path")
    pages = spark.read.text(folder, wholetext=whole_file, recursiveFileLookup=True).select(
        canonical_symbol(symbol_of_file(path)).alias("symbol"), interval_of_file(path).alias("interval"), "value"
    )
    return conform(decode_klines(pages), CANDLE)


def read_kline_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed one per line with their request: ``{"symbol", "interval", "page": [[...]]}``.

    The scalable landing form: lines split across tasks, whole files do not.
    """
    lines = spark.read.text(folder).select(
        F.from_json("value", "symbol string, interval string, page array<array<string>>").alias("r"))
    pages = lines.select(
        canonical_symbol(F.col("r.symbol")).alias("symbol"), F.col("r.interval").alias("interval"),
        F.to_json("r.page").alias("value"),
    )
    return conform(decode_klines(pages), CANDLE)


def assemble_pages(candles: DataFrame) -> DataFrame:
    """Candles of overlapping pages without the repeated border rows."""
    return candles.dropDuplicates(["symbol", "interval", "open_time"])


def encode_klines(candles: DataFrame, page_rows: int = 1000) -> DataFrame:
    """Candles as kline pages of up to ``page_rows`` grid positions: (symbol, interval, value)."""
    ms = lambda c: F.unix_millis(c).cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    kline = F.concat(
        F.lit("["),
        F.concat_ws(
            ",", ms("open_time"), *[quoted(F.col(c)) for c in PRICES], ms("close_time"),
            F.lit('"0"'), F.lit("0"), F.lit('"0"'), F.lit('"0"'), F.lit('"0"'),
        ),
        F.lit("]"),
    )
    return (
        candles.groupBy("symbol", "interval", candle_bucket(page_rows).alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(kline), ","), F.lit("]")).alias("value"))
        .drop("page")
    )
