"""Candle CSV files named ``{symbol}_{interval}.csv`` or below ``name={symbol}_{interval}`` folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kandela.functions.scalars import canonical_symbol, interval_of_file, symbol_of_file, to_number
from kandela.schemas import CANDLE, CLEAN_CANDLE, PRICES, conform

# Everything is read as text first: times may be date-only, and a bad cell must not drop its row.
_TEXT = T.StructType([T.StructField(n, T.StringType()) for n in CLEAN_CANDLE.names])


def parse_time(text: Column) -> Column:
    """A timestamp from text with or without time of day and milliseconds."""
    return F.try_to_timestamp(text)


def typed_candles(rows: DataFrame) -> DataFrame:
    """Text candle columns to their types; other columns pass through."""
    typed = rows
    for name in PRICES:
        typed = typed.withColumn(name, to_number(F.col(name)))
    for name in ("open_time", "close_time"):
        typed = typed.withColumn(name, parse_time(F.col(name)))
    return typed


def read_candle_csv(spark: SparkSession, path: str) -> DataFrame:
    """Candle CSV files with symbol and interval taken from each file or folder name."""
    file = F.col("_metadata.file_path")
    rows = spark.read.schema(_TEXT).csv(path, header=True, enforceSchema=False, recursiveFileLookup=True).select(
        canonical_symbol(symbol_of_file(file)).alias("symbol"), interval_of_file(file).alias("interval"), "*"
    )
    return conform(typed_candles(rows), CANDLE)


def read_partitioned_csv(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    """CSV export laid out in ``column=value`` folders."""
    schema = T.StructType([
        *[T.StructField(n, T.StringType()) for n in CANDLE.names if n not in partitions],
        *[T.StructField(n, T.StringType()) for n in partitions],
    ])
    return conform(typed_candles(spark.read.schema(schema).csv(path, header=True)), CANDLE)
