"""The read queries an application asks of the candle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kandela.operators.candles import with_mid_price
from kandela.operators.series import last_rows, newest_months, recent_part
from kandela.schemas import PRICES, SERIES


def with_symbol(klines: DataFrame, symbols: DataFrame) -> DataFrame:
    """Facts joined to the symbol dimension by id."""
    return klines.join(symbols.select("symbol_id", "symbol"), on="symbol_id")


def historical(klines: DataFrame, symbols: DataFrame, intervals: DataFrame, symbol: str,
               interval: str, limit: int = 10) -> DataFrame:
    """The newest ``limit`` candles of a symbol and interval, newest first; none for unknown names.

    The filters sit on the dimensions; over a fact table laid out by id they prune its folders when
    the query runs. With a ``month`` column, row counts from file footers tell the first month needed,
    and older folders are not read. Each task keeps its own newest ``limit`` rows.
    """
    names = intervals.where(F.col("interval_name") == interval).select("interval_id")
    series = with_symbol(klines, symbols.where(F.col("symbol") == symbol)).join(names, on="interval_id")
    if "month" in klines.columns:
        needed = newest_months(series, limit, ["symbol_id", "interval_id"])
        series = series.where(F.col("month") >= needed.agg(F.min("month")).scalar())
    return (
        series
        .select("symbol", "open_time", "close_time", *PRICES)
        .orderBy(F.col("open_time").desc())
        .limit(limit)
    )


def series_status(klines: DataFrame, symbols: DataFrame, intervals: DataFrame, symbol: str, interval: str) -> DataFrame:
    """One row that says why ``historical`` answers or does not: ok, unknown symbol, unknown interval or no data."""
    some = lambda df: df.limit(1).agg(F.count("*")).scalar() > 0
    status = (
        F.when(~some(symbols.where(F.col("symbol") == symbol)), "unknown symbol")
        .when(~some(intervals.where(F.col("interval_name") == interval)), "unknown interval")
        .when(~some(historical(klines, symbols, intervals, symbol, interval, 1)), "no data").otherwise("ok")
    )
    return klines.sparkSession.range(1).select(
        F.lit(symbol).alias("symbol"), F.lit(interval).alias("interval"), status.alias("status"))


def latest(documents: DataFrame) -> DataFrame:
    """The newest document of every series, by close time, then load number, then open time.

    Only the newest months or buckets of each series are read in full.
    """
    rest = [c for c in documents.columns if c not in SERIES]
    return (
        recent_part(documents, 1).groupBy(*SERIES)
        .agg(F.max_by(F.struct(*rest), F.struct("close_time", "load_seq", "open_time")).alias("_last"))
        .select(*SERIES, "_last.*").select(*documents.columns)
    )


def recent_window(documents: DataFrame, n: int = 60, all_closed: bool = False) -> DataFrame:
    """The newest ``n`` closed candles of every series in ascending order.

    A store that takes closed candles only says so with ``all_closed``: its months can then be counted
    without reading a column.
    """
    rows = documents if all_closed else documents.where("closed")
    return last_rows(rows, n, time="close_time").orderBy(*SERIES, "close_time")


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def head(df: DataFrame, n: int = 5, by: str = "open_time") -> DataFrame:
    return df.orderBy(by, "symbol").limit(n)


def tail(df: DataFrame, n: int = 5, by: str = "open_time") -> DataFrame:
    """The last ``n`` rows in ascending order."""
    return df.orderBy(F.col(by).desc(), F.col("symbol").desc()).limit(n).orderBy(by, "symbol")


def dashboard(klines: DataFrame, symbols: DataFrame, intervals: DataFrame, symbol: str,
              interval: str, limit: int = 100) -> DataFrame:
    return with_mid_price(historical(klines, symbols, intervals, symbol, interval, limit))


def close_series(candles: DataFrame) -> DataFrame:
    return candles.select("symbol", "close_time", "close").orderBy("symbol", "close_time")
