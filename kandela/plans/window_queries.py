"""Registered window-function queries (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kandela.functions import indicators as ind
from kandela.operators import features as ft
from kandela.operators.series import last_rows, over_series
from kandela.plans.registry import (
    BASE, CANDLE_SQL, COMPLETE_SQL, FEATURES_SQL, PRICES_SQL, W, features_sql, frame, label_sql, query, rounded,
)
from kandela.schemas import CANDLE_KEY, FEATURE_COLUMNS
from kandela.sources.tables import stored_candle_table, stored_event_candles

KEY_SQL = 'symbol, "interval", open_time'


def _each(spark, folder, back, *columns, ahead=0):
    """One small indicator query over the 1h candles; ``columns`` are functions of the window."""
    candles = stored_event_candles(spark, folder)
    return over_series(
        candles, lambda df, w: df.select("*", *[make(w).alias(name) for name, make in columns]),
        back=back, ahead=ahead,
    ).select(*CANDLE_KEY, *[name for name, _ in columns])


_LAGS = [f"{c}_lag{k}" for k in (1, 2, 3) for c in ("close", "volume")]


@query("w1_lags", f"""{BASE} SELECT {KEY_SQL},
  {", ".join(f"round(lag({c}, {k}) OVER ({W}), 6) AS {c}_lag{k}" for k in (1, 2, 3) for c in ("close", "volume"))}
  FROM candles""")
def lags(spark, folder):
    return _each(spark, folder, 3, *[
        (f"{c}_lag{k}", lambda w, c=c, k=k: F.lag(c, k).over(w)) for k in (1, 2, 3) for c in ("close", "volume")])


@query("w2_forward_return", f"""{BASE} SELECT {KEY_SQL},
  round(lead(close, 10) OVER ({W}) / nullif(close, 0) - 1, 6) AS future_return FROM candles""")
def forward_return(spark, folder):
    return _each(spark, folder, 0, ("future_return", lambda w: ind.forward_return(F.col("close"), 10, w)), ahead=10)


@query("w3_first_difference", f"""{BASE} SELECT {KEY_SQL},
  round(close - lag(close) OVER ({W}), 6) AS delta FROM candles""")
def first_difference(spark, folder):
    return _each(spark, folder, 1, ("delta", lambda w: ind.difference(F.col("close"), w)))


@query("w4_percent_change", f"""{BASE} SELECT {KEY_SQL},
  round(close / nullif(lag(close) OVER ({W}), 0) - 1, 6) AS RET FROM candles""")
def percent_change(spark, folder):
    return _each(spark, folder, 1, ("RET", lambda w: ind.percent_change(F.col("close"), w)))


@query("w5_rolling_means", f"""{BASE} SELECT {KEY_SQL},
  round(CASE WHEN count(close) OVER ({W} {frame(10)}) = 10 THEN avg(close) OVER ({W} {frame(10)}) END, 6) AS MA_10,
  round(CASE WHEN count(close) OVER ({W} {frame(50)}) = 50 THEN avg(close) OVER ({W} {frame(50)}) END, 6) AS MA_50
  FROM candles""")
def rolling_means(spark, folder):
    return _each(spark, folder, 49,
                 ("MA_10", lambda w: ind.rolling_mean(F.col("close"), 10, w)),
                 ("MA_50", lambda w: ind.rolling_mean(F.col("close"), 50, w)))


@query("w6_rolling_std", f"""{BASE} SELECT {KEY_SQL},
  round(CASE WHEN count(close) OVER ({W} {frame(20)}) = 20 THEN stddev_samp(close) OVER ({W} {frame(20)}) END, 6)
  AS STD_20 FROM candles""")
def rolling_std(spark, folder):
    return _each(spark, folder, 19, ("STD_20", lambda w: ind.rolling_std(F.col("close"), 20, w)))


@query("w7_volatility", f"""{BASE}, {features_sql()} SELECT {KEY_SQL}, {rounded('VOLAT')} FROM feat""")
def volatility(spark, folder):
    candles = stored_event_candles(spark, folder)
    return over_series(
        candles,
        lambda df, w: df.withColumn("RET", ind.percent_change(F.col("close"), w))
        .withColumn("VOLAT", ind.rolling_std(F.col("RET"), 10, w)),
        back=10,
    ).select(*CANDLE_KEY, "VOLAT")


@query("w8_rsi14", f"""{BASE}, {features_sql()} SELECT {KEY_SQL}, {rounded('RSI')} FROM feat""")
def rsi14(spark, folder):
    candles = stored_event_candles(spark, folder)
    return over_series(
        candles,
        lambda df, w: df.withColumn("_delta", ind.difference(F.col("close"), w))
        .withColumn("RSI", ind.rsi(F.col("_delta"), 14, w)),
        back=14,
    ).select(*CANDLE_KEY, "RSI")


@query("w9_three_way_label", f"""{BASE}, {label_sql()}
  SELECT {KEY_SQL}, {rounded('future_return')}, CAST(target AS DOUBLE) AS target FROM labelled""")
def three_way_label(spark, folder):
    return ft.with_label(stored_event_candles(spark, folder)).select(
        *CANDLE_KEY, "future_return", F.col("target").cast("double").alias("target"))


@query("w9_label_tracked_threshold", f"""{BASE}, {label_sql(threshold=0.05)}
  SELECT {KEY_SQL}, {rounded('future_return')}, CAST(target AS DOUBLE) AS target FROM labelled""")
def label_tracked_threshold(spark, folder):
    return ft.with_label(stored_event_candles(spark, folder), threshold=0.05).select(
        *CANDLE_KEY, "future_return", F.col("target").cast("double").alias("target"))


@query("w10_feature_bundle", f"""{BASE}, {features_sql()}
  SELECT {KEY_SQL}, {FEATURES_SQL} FROM feat WHERE {COMPLETE_SQL}""")
def feature_bundle(spark, folder):
    return ft.features(stored_event_candles(spark, folder)).select(*CANDLE_KEY, *FEATURE_COLUMNS)


@query("w10_training_frame", f"""{BASE}, {features_sql()}, {label_sql("feat")}
  SELECT {KEY_SQL}, {FEATURES_SQL}, {rounded('future_return')}, target FROM labelled
  WHERE target IS NOT NULL AND {COMPLETE_SQL}""")
def training_frame(spark, folder):
    return ft.training_frame(stored_event_candles(spark, folder)).select(
        *CANDLE_KEY, *FEATURE_COLUMNS, "future_return", "target")


@query("w10_training_frame_label_first", f"""{BASE}, {label_sql()},
  kept AS (SELECT * FROM labelled WHERE target IS NOT NULL), {features_sql("kept")}
  SELECT {KEY_SQL}, {FEATURES_SQL}, {rounded('future_return')}, target FROM feat WHERE {COMPLETE_SQL}""")
def training_frame_label_first(spark, folder):
    return ft.training_frame(stored_event_candles(spark, folder), label_first=True).select(
        *CANDLE_KEY, *FEATURE_COLUMNS, "future_return", "target")


_NEWEST = f"row_number() OVER (PARTITION BY symbol, \"interval\" ORDER BY open_time DESC)"


@query("w11_last_240", f"""{BASE} SELECT {CANDLE_SQL} FROM candles QUALIFY {_NEWEST} <= 240""")
def last_240(spark, folder):
    return last_rows(stored_candle_table(spark, folder), 240).drop("month")


@query("w12_every_fifth", f"""{BASE}
  SELECT {CANDLE_SQL} FROM candles QUALIFY (row_number() OVER ({W}) - 1) % 5 = 0""")
def every_fifth(spark, folder):
    return ft.every_kth(stored_event_candles(spark, folder), 5)


_SPLIT = f"""numbered AS (SELECT *, row_number() OVER ({W}) AS rn,
  count(*) OVER (PARTITION BY symbol, "interval") AS n FROM labelled WHERE target IS NOT NULL),
  split_rows AS (SELECT *, CASE WHEN rn <= n - (3 * n + 9) // 10 THEN 'train' ELSE 'test' END AS split FROM numbered)"""


@query("w13_split_70_30", f"""{BASE}, {label_sql()}, {_SPLIT}
  SELECT {KEY_SQL}, rn, n, split, CASE WHEN rn <= 7 * n // 10 THEN 'train' ELSE 'test' END AS split_int
  FROM split_rows""")
def split_70_30(spark, folder):
    split = ft.with_split(ft.labelled_rows(stored_event_candles(spark, folder)))
    by_int = F.when(F.col("rn") <= F.floor(7 * F.col("n") / 10), "train").otherwise("test")
    return split.select(*CANDLE_KEY, "rn", "n", "split", by_int.alias("split_int"))


@query("w14_features_per_split", f"""{BASE}, {label_sql()}, {_SPLIT},
  {features_sql("split_rows", 'symbol, "interval", split')}
  SELECT {KEY_SQL}, split, {FEATURES_SQL}, target FROM feat WHERE {COMPLETE_SQL}""")
def features_per_split(spark, folder):
    return ft.features_per_split(stored_event_candles(spark, folder)).select(
        *CANDLE_KEY, "split", *FEATURE_COLUMNS, "target")


@query("w14_features_then_split", f"""{BASE}, {features_sql()}, {label_sql("feat")},
  kept AS (SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol, "interval") AS n FROM labelled
    WHERE target IS NOT NULL AND {COMPLETE_SQL})
  SELECT {KEY_SQL}, rn, CASE WHEN rn <= 7 * n // 10 THEN 'train' ELSE 'test' END AS split, {FEATURES_SQL}, target FROM kept""")
def features_then_split(spark, folder):
    return ft.features_then_split(stored_event_candles(spark, folder)).select(
        *CANDLE_KEY, "rn", "split", *FEATURE_COLUMNS, "target")


@query("w15_latest_features", f"""{BASE}, recent AS (SELECT * FROM candles QUALIFY {_NEWEST} <= 60),
  {features_sql("recent")} SELECT {KEY_SQL}, {FEATURES_SQL} FROM feat WHERE {COMPLETE_SQL} QUALIFY {_NEWEST} = 1""")
def latest_features(spark, folder):
    return ft.latest_features(stored_candle_table(spark, folder)).select(*CANDLE_KEY, *FEATURE_COLUMNS)
