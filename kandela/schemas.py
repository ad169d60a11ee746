"""Table contracts. Every layer has one fixed schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The twelve positions of an exchange kline array.
KLINE_FIELDS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume", "ignore",
]

# Candle interval names and their length in seconds.
INTERVAL_SECONDS = {
    "1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "1d": 86400, "1w": 604800,
}

# Surrogate interval ids of the training export, in minutes.
EXPORT_INTERVAL_MINUTES = {2: 60, 3: 240, 4: 1440}

# The traded symbols of the training export by surrogate id.
EXPORT_SYMBOLS = {1: "BTCUSDT", 2: "ETHUSDT", 3: "BNBUSDT", 4: "SOLUSDT"}

# Model inputs, in vector order.
FEATURE_COLUMNS = [
    "open", "high", "low", "close", "volume",
    "RSI", "MA_10", "MA_50", "STD_20", "RET", "VOLAT",
    "close_lag1", "close_lag2", "close_lag3",
    "volume_lag1", "volume_lag2", "volume_lag3",
]

# Price columns of every table contract.
PRICES = ["open", "high", "low", "close", "volume"]
SERIES = ["symbol", "interval"]
CANDLE_KEY = ["symbol", "interval", "open_time"]
KLINE_KEY = ["symbol_id", "interval_id", "open_time"]


# The table contracts below, names and types.
_STRING, _DOUBLE, _INT, _TIME = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_OHLCV = {name: _DOUBLE for name in PRICES}
_MONEY = T.DecimalType(18, 3)

CLEAN_CANDLE = _table(open_time=_TIME, **_OHLCV, close_time=_TIME)
CANDLE = _table(symbol=_STRING, interval=_STRING, open_time=_TIME, **_OHLCV, close_time=_TIME)
STREAM_CANDLE = _table(symbol=_STRING, **_OHLCV, timestamp=_TIME, closed=T.BooleanType())
DIM_SYMBOL = _table(symbol_id=_INT, symbol=_STRING, base_asset=_STRING, quote_asset=_STRING)
DIM_INTERVAL = _table(interval_id=_INT, interval_name=_STRING, seconds=_INT)
KLINES = _table(
    klines_id=T.LongType(), symbol_id=_INT, interval_id=_INT, open_time=_TIME, **_OHLCV, close_time=_TIME, created_at=_TIME)
GRAIN_PRICES = _table(date=T.DateType(), **{name: _MONEY for name in PRICES})
DIM_DATE = _table(
    date=T.DateType(), year=_INT, month=_INT, day=_INT, week=_INT, quarter=_INT,
    day_name=_STRING, month_name=_STRING, is_weekend=T.BooleanType())
TICK = _table(symbol=_STRING, price=_DOUBLE, quantity=_DOUBLE, timestamp=_TIME)
PREDICTION = _table(
    symbol=_STRING, prediction=_STRING, prob_buy=_DOUBLE, prob_sell=_DOUBLE, timestamp=_TIME, status=_STRING)
BACKTEST = _table(datetime=_TIME, close=_DOUBLE, target=_INT, prediction=_INT, proba=_DOUBLE)
RUNS = _table(
    run_name=_STRING, symbol=_STRING, model_type=_STRING, horizon=_INT, threshold=_DOUBLE,
    accuracy=_DOUBLE, f1=_DOUBLE, artifact=_STRING)
SCORES = _table(symbol=_STRING, model=_STRING, n=T.LongType(), accuracy=_DOUBLE, f1=_DOUBLE)
METRIC_SAMPLE = _table(name=_STRING, labels=T.MapType(_STRING, _STRING), ts=_TIME, value=_DOUBLE)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project and cast ``df`` to a table contract, in contract order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
