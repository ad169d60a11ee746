"""Column functions: casts, names, times and lookups."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from kandela.schemas import INTERVAL_SECONDS


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def to_epoch_ms(when: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds of a formatted string."""
    return F.unix_millis(F.try_to_timestamp(when, F.lit(pattern)))


def to_number(text: Column) -> Column:
    """String to double; anything that is not a number, or is not finite, becomes NULL."""
    number = text.try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def base_asset(symbol: Column) -> Column:
    return F.when(F.length(symbol) > 4, F.substring(symbol, F.lit(1), F.length(symbol) - 4)).otherwise("")


def quote_asset(symbol: Column) -> Column:
    return F.right(symbol, F.lit(4))


def canonical_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


def lookup(key: Column, values: Mapping) -> Column:
    """Value of a small constant mapping; NULL for keys it lacks."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])[key]


def interval_seconds(interval: Column) -> Column:
    return lookup(interval, INTERVAL_SECONDS)


def interval_minutes(interval: Column) -> Column:
    return (interval_seconds(interval) / 60).cast("int")


def signal_name(prediction: Column) -> Column:
    return F.when(prediction == 1, "BUY").otherwise("SELL")


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def line_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def series_name(symbol: Column, interval: Column) -> Column:
    return F.concat_ws("_", symbol, interval)


def csv_name(json_name: Column) -> Column:
    return F.regexp_replace(json_name, r"\.json$", ".csv")


# {symbol}_{interval}.ext as the file name, or name={symbol}_{interval} as its folder.
_NAMED_FILE = r"(?:/|^|name=)([^/_=]+)_([^/_.=]+)(?:\.[^/]+|/[^/]+)$"


def symbol_of_file(path: Column) -> Column:
    return F.regexp_extract(path, _NAMED_FILE, 1)


def interval_of_file(path: Column) -> Column:
    return F.regexp_extract(path, _NAMED_FILE, 2)


def floor_time(ts: Column, interval: str) -> Column:
    """Start of the candle that holds ``ts``; weeks start on Monday."""
    if interval in ("1w", "1M", "1y"):
        unit = {"1w": "week", "1M": "month", "1y": "year"}[interval]
        return F.date_trunc(unit, ts)
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(INTERVAL_SECONDS[interval])))


def candle_end(open_time: Column, interval: str) -> Column:
    """Last millisecond of the candle that opens at ``open_time``."""
    step = {"1M": "1 MONTH", "1y": "1 YEAR"}.get(interval)
    step = step or f"{INTERVAL_SECONDS[interval]} SECONDS"
    return open_time + F.expr(f"INTERVAL {step}") - F.expr("INTERVAL 0.001 SECONDS")
