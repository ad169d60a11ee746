"""Indicator columns over an ordered series.

Every function takes the window ``w`` (partitioned and ordered, no frame) and returns a column.
A rolling value is NULL until its frame is full.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F


def _full(frame: WindowSpec, x: Column, n: int, value: Column) -> Column:
    return F.when(F.count(x).over(frame) == n, value)


def rolling_mean(x: Column, n: int, w: WindowSpec) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    return _full(frame, x, n, F.avg(x).over(frame))


def rolling_std(x: Column, n: int, w: WindowSpec) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    return _full(frame, x, n, F.stddev_samp(x).over(frame))


def difference(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def percent_change(x: Column, w: WindowSpec) -> Column:
    return F.try_divide(x, F.lag(x).over(w)) - 1


def forward_return(close: Column, horizon: int, w: WindowSpec) -> Column:
    return F.try_divide(F.lead(close, horizon).over(w), close) - 1


def clip_below(x: Column) -> Column:
    """max(x, 0), keeping NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def clip_above(x: Column) -> Column:
    """min(x, 0), keeping NULL."""
    return F.when(x.isNotNull(), F.least(x, F.lit(0.0)))


def rsi(delta: Column, period: int, w: WindowSpec) -> Column:
    """100*g/(g+l) over the mean gain g and mean loss l; NULL for a flat stretch.

    g + l is the mean absolute step, so two running means are enough.
    """
    frame = w.rowsBetween(1 - period, 0)
    gain, swing = F.avg(clip_below(delta)).over(frame), F.avg(F.abs(delta)).over(frame)
    return _full(frame, delta, period, F.try_divide(100 * gain, swing))


def three_way_label(change: Column, threshold: float) -> Column:
    """1 above the threshold, 0 below its negative, NULL in between."""
    return F.when(change > threshold, 1).when(change < -threshold, 0)
