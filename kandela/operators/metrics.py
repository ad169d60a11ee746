"""Monitoring queries over a table of metric samples (name, labels, ts, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from kandela.operators.series import over_series
from kandela.session import materialise

# Fixed value: a value this old no longer stands for its series.
STALE_SECONDS = 300


def label(name: str) -> Column:
    return F.col("labels")[name]


def select_metric(samples: DataFrame, name: str, **where: str) -> DataFrame:
    rows = samples.where(F.col("name") == name)
    for key, value in where.items():
        rows = rows.where(label(key) == value)
    return rows


def counter_rate(samples: DataFrame, by: Sequence[str], window_seconds: int) -> DataFrame:
    """Per-second increase of each counter in tumbling windows, tolerating resets.

    Every sample counts. A step between two samples belongs to the window of the later one, also when
    it crosses a window's edge, so windows add up to the whole increase. A drop in value is a restart,
    so the new value itself is the increase. Of several values of a series at one time the largest
    holds. Windows without a step have no row; nothing is extrapolated.
    """
    seconds = F.unix_seconds("ts")
    stepped = _steps(samples, by, window_seconds)
    start = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(window_seconds)))
    return (
        stepped.where("_inc IS NOT NULL").groupBy(*by, start.alias("window_start"))
        .agg((F.sum("_inc") / window_seconds).alias("rate"))
    )


def _steps(samples: DataFrame, by: Sequence[str], window_seconds: int) -> DataFrame:
    """``by, ts, value`` once per series and time, the increase ``_inc`` since the sample before and that one's ``_before``."""
    # Unique per series and time, which bounds a chunk; stored because counts and windows both read it.
    unique = materialise(samples.groupBy(*by, "ts").agg(F.max("value").alias("value")), "samples")

    def steps(df: DataFrame, w: WindowSpec) -> DataFrame:
        step = F.col("value") - F.lag("value").over(w)
        return df.withColumn("_inc", F.when(step < 0, F.col("value")).otherwise(step)).withColumn("_before", F.lag("ts").over(w))

    return over_series(unique, steps, back=1, keys=list(by), time="ts", bucket=F.floor(F.unix_seconds("ts") / window_seconds))


def _grid(window: int, step: int) -> Column:
    """Evaluation times in microseconds, multiples of ``step``, at which a sample at ``ts`` is at most ``window`` old."""
    at = F.unix_micros("ts")
    first = at + F.pmod(-at, F.lit(step))
    return F.when(first < at + window, F.sequence(first, at + window - 1, F.lit(step)))


def sliding_rate(samples: DataFrame, by: Sequence[str], window_seconds: int, step_seconds: int) -> DataFrame:
    """``by, at, rate``: per-second increase of each counter over the window that ends at each evaluation time.

    Evaluation times are multiples of the step in UTC; the window is open at its start and closed at its end, and gives a
    row if it holds two samples or more. Resets are added up inside the window, so a step across its start does not count. The
    increase is extrapolated to the window's edges, as collectors do: fully where an edge is nearer than 1.1 average sample
    distances, else by half a distance, and at the start never further than to where the counter was zero. Each sample is
    copied to the window / step evaluation times that see it and combined before the shuffle.
    """
    window = window_seconds * 1_000_000
    seen = _steps(samples, by, window_seconds).withColumn("_at", F.explode(_grid(window, step_seconds * 1_000_000)))
    opened = F.col("_at") - window
    held = seen.groupBy(*by, "_at").agg(
        F.count("*").alias("n"), F.min(F.unix_micros("ts")).alias("first"), F.max(F.unix_micros("ts")).alias("last"),
        F.min_by("value", "ts").alias("value"),
        F.sum(F.when(F.unix_micros("_before") > opened, F.col("_inc"))).alias("increase")).where("n > 1")
    covered = F.col("last") - F.col("first")
    distance = covered / (F.col("n") - 1)
    reach = lambda edge: F.when(edge >= distance * 1.1, distance / 2).otherwise(edge)
    to_zero = F.when((F.col("increase") > 0) & (F.col("value") >= 0), covered * (F.col("value") / F.col("increase")))
    whole = covered + F.least(reach(F.col("first") - opened), to_zero) + reach(F.col("_at") - F.col("last"))
    return held.select(*by, F.timestamp_micros("_at").alias("at"),
                       (F.col("increase") * (whole / covered) / window_seconds).alias("rate"))


def value_at(samples: DataFrame, by: Sequence[str], step_seconds: int, stale_seconds: int = STALE_SECONDS) -> DataFrame:
    """``by, at, value``: each series' newest value at every evaluation time; none when it is ``stale_seconds`` old.

    Of several values at one time the largest holds.
    """
    seen = samples.withColumn("_at", F.explode(_grid(stale_seconds * 1_000_000, step_seconds * 1_000_000)))
    newest = F.max(F.struct("ts", "value"))
    return seen.groupBy(*by, F.timestamp_micros("_at").alias("at")).agg(newest["value"].alias("value"))


def utilisation(idle_rate: DataFrame, by: str = "instance", at: str = "window_start") -> DataFrame:
    """100 - average idle rate * 100 per instance and window."""
    return idle_rate.groupBy(by, at).agg((100 - F.avg("rate") * 100).alias("utilisation"))


def gauge_difference(samples: DataFrame, minuend: str, subtrahend: str, by: Sequence[str]) -> DataFrame:
    """First gauge minus second where both were sampled; one pass, no self-join."""
    value = lambda name: F.max(F.when(F.col("name") == name, F.col("value")))
    return (
        samples.where(F.col("name").isin(minuend, subtrahend))
        .groupBy(*by, "ts")
        .agg((value(minuend) - value(subtrahend)).alias("difference"))
        .where("difference IS NOT NULL")
    )


def histogram_quantile(bucket_rates: DataFrame, q: float, by: Sequence[str] = ("window_start",)) -> DataFrame:
    """Quantile from cumulative bucket rates (column ``le`` is the upper bound, infinity last).

    Interpolates linearly inside the bucket that crosses the rank; a rank in the open last bucket
    gives the highest finite bound.
    """
    summed = bucket_rates.groupBy(*by, "le").agg(F.sum("rate").alias("rate"))
    in_order = Window.partitionBy(*by).orderBy("le")
    total = F.max("rate").over(Window.partitionBy(*by))
    placed = summed.select(
        *by, "le", "rate", (total * q).alias("rank"),
        F.coalesce(F.lag("le").over(in_order), F.lit(0.0)).alias("lower"),
        F.coalesce(F.lag("rate").over(in_order), F.lit(0.0)).alias("before"),
    ).where(F.col("rank") > 0)
    hit = placed.where(F.col("rate") >= F.col("rank"))
    estimate = F.when(F.col("le") == float("inf"), F.col("lower")).otherwise(
        F.col("lower") + (F.col("le") - F.col("lower"))
        * F.try_divide(F.col("rank") - F.col("before"), F.col("rate") - F.col("before")))
    return hit.groupBy(*by).agg(F.min_by(estimate, "le").alias("quantile"))


def active_series(samples: DataFrame, by: Sequence[str], window_seconds: int) -> DataFrame:
    """Number of different series seen per window."""
    at = F.unix_seconds("ts")
    start = F.timestamp_seconds(at - F.pmod(at, F.lit(window_seconds)))
    return samples.groupBy(start.alias("window_start")).agg(F.count_distinct(*by).alias("active"))
