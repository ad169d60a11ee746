"""Row-level cleaning: harmonised ticks, filters, null handling, validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from kandela.functions.scalars import canonical_symbol, lookup
from kandela.schemas import CANDLE_KEY, PRICES, TICK, conform


def history_as_ticks(candles: DataFrame) -> DataFrame:
    """Candles renamed to the tick shape: close is the price, volume the quantity."""
    return conform(
        candles.select(
            "symbol", F.col("close").alias("price"), F.col("volume").alias("quantity"),
            F.col("open_time").alias("timestamp"),
        ),
        TICK,
    )


def stream_as_ticks(messages: DataFrame) -> DataFrame:
    """Stream candles in the tick shape; a textual timestamp is parsed."""
    when = F.col("timestamp")
    if isinstance(messages.schema["timestamp"].dataType, T.StringType):
        when = F.try_to_timestamp(when)
    return conform(
        messages.select(
            canonical_symbol(F.col("symbol")).alias("symbol"), F.col("close").alias("price"),
            F.col("volume").alias("quantity"), when.alias("timestamp"),
        ),
        TICK,
    )


def union_ticks(history: DataFrame, stream: DataFrame) -> DataFrame:
    return history.unionByName(stream)


def closed_only(messages: DataFrame) -> DataFrame:
    return messages.where("closed")


def select_series(candles: DataFrame, symbols: Sequence[str] = (),
                  intervals: Sequence[str] = ()) -> DataFrame:
    if symbols:
        candles = candles.where(F.col("symbol").isin(*symbols))
    if intervals:
        candles = candles.where(F.col("interval").isin(*intervals))
    return candles


def between_times(candles: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    return candles.where(
        F.col("open_time").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    )


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in ``subset`` (all columns by default)."""
    return df.na.drop(subset=list(subset)) if subset else df.na.drop()


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    keep = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
    return df.select(*keep)


def map_labels(df: DataFrame, column: str, values: Mapping, into: str) -> DataFrame:
    return df.withColumn(into, lookup(F.col(column), values))


def split_valid(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): a valid candle has its key and all five numbers."""
    complete = F.lit(True)
    for name in [*CANDLE_KEY, *PRICES]:
        if name in candles.columns:
            complete = complete & F.col(name).isNotNull()
    return candles.where(complete), candles.where(~complete)
