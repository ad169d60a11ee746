"""Query registry: each entry is a Spark callable and, where SQL can state it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kandela.schemas import FEATURE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def publish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Zone-free times, rounded doubles, plain dates and decimals: two engines print the same values."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, digits)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, digits: int = 6) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return publish(build(spark, folder), digits)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# -- SQL fragments shared by the oracles ---------------------------------------------------------

TICKS = """ticks AS (SELECT upper(event_type) AS symbol, ts, event_id AS seq, value AS price,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity FROM events)"""

_STEPS = {"15m": "15 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day", "1w": "7 days"}


def candles_sql(interval: str = "1h", name: str = "candles", ticks: str = "ticks") -> str:
    if interval in _STEPS:
        start, step = f"time_bucket(INTERVAL '{_STEPS[interval]}', ts)", _STEPS[interval]
    else:
        unit = {"1M": "month", "1y": "year"}[interval]
        start, step = f"date_trunc('{unit}', ts)::TIMESTAMP", f"1 {unit}"
    return f"""{name} AS (SELECT symbol, '{interval}' AS "interval", {start} AS open_time,
  first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY ts, seq) AS close, sum(quantity) AS volume,
  {start} + INTERVAL '{step}' - INTERVAL '1 millisecond' AS close_time
  FROM {ticks} GROUP BY ALL)"""


BASE = f"WITH {TICKS}, {candles_sql()}"
SERIES_SQL = 'symbol, "interval"'
W = f"PARTITION BY {SERIES_SQL} ORDER BY open_time"


def rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


PRICES_SQL = rounded("open", "high", "low", "close", "volume")
CANDLE_SQL = f'symbol, "interval", open_time, {PRICES_SQL}, close_time'


def frame(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def features_sql(source: str = "candles", part: str = SERIES_SQL, prefix: str = "") -> str:
    """CTEs d and feat: all twelve indicators of ``source``, series cut by ``part``."""
    w = f"PARTITION BY {part} ORDER BY open_time"
    full = lambda x, n, expr: f"CASE WHEN count({x}) OVER ({w} {frame(n)}) = {n} THEN {expr} END"
    over = lambda agg, n: f"{agg} OVER ({w} {frame(n)})"
    gain, loss = over("avg(greatest(delta, 0))", 14), over("avg(greatest(-delta, 0))", 14)
    lags = ", ".join(
        f"lag({c}, {k}) OVER ({w}) AS {c}_lag{k}" for k in (1, 2, 3) for c in ("close", "volume"))
    return f"""{prefix}d AS (SELECT *, close - lag(close) OVER ({w}) AS delta,
    close / nullif(lag(close) OVER ({w}), 0) - 1 AS RET FROM {source}),
  {prefix}feat AS (SELECT *,
    {full('delta', 14, f'100 * {gain} / nullif({gain} + {loss}, 0)')} AS RSI,
    {full('close', 10, over('avg(close)', 10))} AS MA_10,
    {full('close', 50, over('avg(close)', 50))} AS MA_50,
    {full('close', 20, over('stddev_samp(close)', 20))} AS STD_20,
    {full('RET', 10, over('stddev_samp(RET)', 10))} AS VOLAT,
    {lags} FROM {prefix}d)"""


def label_sql(source: str = "candles", horizon: int = 10, threshold: float = 0.01, name: str = "labelled") -> str:
    return f"""fwd AS (SELECT *, lead(close, {horizon}) OVER ({W}) / nullif(close, 0) - 1 AS future_return FROM {source}),
  {name} AS (SELECT *, CASE WHEN future_return > {threshold} THEN 1 WHEN future_return < -{threshold} THEN 0 END AS target FROM fwd)"""


FEATURE_NAMES = FEATURE_COLUMNS
COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)
FEATURES_SQL = rounded(*FEATURE_NAMES)
