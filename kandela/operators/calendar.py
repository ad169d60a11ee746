"""Generated rows: backfill slices and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kandela.schemas import DIM_DATE, conform


SLICES_PER_ARRAY = 512


def backfill_slices(bounds: DataFrame, step: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cut each (start_time, end_time) into slices of ``step``; the last one is clipped to the end.

    ``step`` is a fixed length, as "4 HOURS". A long span unfolds in two steps, so no cell holds all its slices.
    """
    width = F.expr(f"INTERVAL {step}")
    run, last = (F.expr(f"INTERVAL {step} * {n}") for n in (SLICES_PER_ARRAY, SLICES_PER_ARRAY - 1))
    return (
        bounds.where("start_time < end_time")
        .select(*keys, "end_time", F.explode(F.sequence("start_time", "end_time", run)).alias("_from"))
        .select(*keys, "end_time", F.explode(
            F.sequence("_from", F.least(F.col("end_time"), F.col("_from") + last), width)).alias("slice_start"))
        .where("slice_start < end_time")
        .select(*keys, "slice_start", F.least(F.col("slice_start") + width, "end_time").alias("slice_end"))
    )


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day between first_day and last_day."""
    day: Column = F.col("date")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return conform(
        days.select(
            "date", F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
            F.weekofyear(day).alias("week"), F.quarter(day).alias("quarter"),
            F.date_format(day, "EEEE").alias("day_name"), F.date_format(day, "MMMM").alias("month_name"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        ),
        DIM_DATE,
    )
