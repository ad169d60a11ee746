"""Candle roll-up, geometry and per-candle columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kandela.functions.scalars import candle_end, floor_time
from kandela.schemas import CANDLE, INTERVAL_SECONDS, conform


def roll_up_ticks(ticks: DataFrame, interval: str, unique_times: bool = False) -> DataFrame:
    """First / max / min / last price and total quantity per symbol and candle.

    ``ticks`` has symbol, ts, seq, price, quantity; equal times are ordered by seq. Every aggregate
    combines before the shuffle, so a hot symbol or candle costs one row per task.

    Time and seq are ordered as one number, so Spark aggregates by hashing instead of sorting all ticks;
    it holds times up to the year 5138 and any long seq. ``unique_times`` orders by time alone.
    """
    order = F.col("ts") if unique_times else F.expr(
        "CAST(CAST(unix_micros(ts) AS DECIMAL(17,0)) * CAST(100000000000000000000 AS DECIMAL(21,0)) + seq AS DECIMAL(38,0))")
    return conform(
        ticks
        .groupBy("symbol", floor_time(F.col("ts"), interval).alias("open_time"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").alias("volume"),
        )
        .withColumn("interval", F.lit(interval))
        .withColumn("close_time", candle_end(F.col("open_time"), interval)),
        CANDLE,
    )


def nests(source: str, target: str) -> bool:
    """Whether candles of ``source`` fill those of ``target`` without a rest."""
    fine, coarse = INTERVAL_SECONDS.get(source), INTERVAL_SECONDS.get(target)
    if target in ("1M", "1y"):
        return source == "1M" and target == "1y" or bool(fine) and 86400 % fine == 0
    return bool(fine and coarse) and fine < coarse and coarse % fine == 0


def roll_up_candles(candles: DataFrame, interval: str, source: str) -> DataFrame:
    """Candles of the ``source`` interval to a coarser one; those of other intervals are not read.

    A source that does not nest in the target is refused.
    """
    if not nests(source, interval):
        raise ValueError(f"{source} candles do not roll up to {interval}")
    return conform(
        candles.where(F.col("interval") == source)
        .groupBy("symbol", floor_time(F.col("open_time"), interval).alias("start"))
        .agg(
            F.min_by("open", "open_time").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "open_time").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumnRenamed("start", "open_time")
        .withColumn("interval", F.lit(interval))
        .withColumn("close_time", candle_end(F.col("open_time"), interval)),
        CANDLE,
    )


def with_direction(candles: DataFrame) -> DataFrame:
    return candles.withColumn("direction", F.when(F.col("close") >= F.col("open"), "up").otherwise("down"))


def with_geometry(candles: DataFrame) -> DataFrame:
    """Body and wick lengths; the body is signed, wicks are never negative."""
    return candles.select(
        "*",
        (F.col("close") - F.col("open")).alias("body"),
        (F.col("high") - F.greatest("open", "close")).alias("upper_wick"),
        (F.least("open", "close") - F.col("low")).alias("lower_wick"),
    )


def with_mid_price(candles: DataFrame) -> DataFrame:
    return candles.withColumn("mid_price", (F.col("high") + F.col("low")) / 2)
