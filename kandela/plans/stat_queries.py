"""Registered aggregation, statistics and metric queries (A, M table forms, N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kandela.operators import candles as cd, clean, drift, evaluate as ev, features as ft, metrics as mt, profile as pr
from kandela.plans.registry import (
    BASE, CANDLE_SQL, COMPLETE_SQL, FEATURE_NAMES, FEATURES_SQL, PRICES_SQL, TICKS, candles_sql, features_sql,
    label_sql, query, rounded,
)
from kandela.plans.window_queries import KEY_SQL, _SPLIT
from kandela.schemas import CANDLE_KEY, FEATURE_COLUMNS, PRICES, SERIES
from kandela.sources import metric_samples as samples, tables as tb
from kandela.session import materialise

_LONG = " UNION ALL ".join(f"SELECT symbol, '{c}' AS \"column\", {c} AS value FROM candles" for c in PRICES)


@query("a1_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return pr.row_count(tb.read_table(spark, folder, "lineitem"))


@query("a2_distinct_values", "SELECT DISTINCT upper(event_type) AS symbol FROM events")
def distinct_values(spark, folder):
    return pr.distinct_values(tb.event_ticks(spark, folder), "symbol")


_DESCRIBE = """count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75"""


@query("a3_describe", f"""{BASE}, long AS ({_LONG})
  SELECT symbol, "column", {_DESCRIBE} FROM long GROUP BY symbol, "column" """)
def describe(spark, folder):
    return pr.describe(tb.stored_event_candles(spark, folder))


# The numeric columns of lineitem beside its keys.
_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a3_describe_lineitem", f"""WITH long AS ({" UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM lineitem" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_LINE_NUMBERS])})
  SELECT l_returnflag, "column", {_DESCRIBE.replace(", 6)", ", 4)")} FROM long GROUP BY l_returnflag, "column" """, digits=4)
def describe_lineitem(spark, folder):
    """All numeric columns."""
    rows = tb.read_table(spark, folder, "lineitem")
    numbers = clean.numeric_columns(rows).columns
    return pr.describe(rows.select("l_returnflag", *[F.col(c).cast("double").alias(c) for c in numbers]), ["l_returnflag"], numbers)


_WARMUP = ["RSI", "MA_10", "MA_50", "STD_20", "RET", "VOLAT", "close_lag1", "volume_lag3"]


@query("a4_null_counts", f"""{BASE}, {features_sql()}
  {" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count FROM feat" for c in _WARMUP)}""")
def null_counts(spark, folder):
    return pr.null_counts(ft.with_indicators(tb.stored_event_candles(spark, folder)).select(*_WARMUP))


# Column types of the candle table.
_TYPES = {"symbol": "string", "interval": "string", "open_time": "timestamp", "open": "double", "high": "double",
          "low": "double", "close": "double", "volume": "double", "close_time": "timestamp"}


@query("a5_frame_profile", f"{BASE} " + " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count(*) AS n_rows, count("{c}") AS non_null FROM candles"""
    for i, (c, t) in enumerate(_TYPES.items())))
def frame_profile(spark, folder):
    return pr.frame_profile(tb.event_candles(spark, folder))


@query("a6_histogram", f"""{BASE}, long AS ({_LONG}),
  span AS (SELECT symbol, "column", min(value) AS lo0, max(value) AS hi0 FROM long GROUP BY ALL),
  edges AS (SELECT symbol, "column", CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo,
    CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi FROM span),
  placed AS (SELECT symbol, "column", lo, hi, least(floor((value - lo) * 10 / (hi - lo)), 9)::INTEGER AS bin
    FROM long JOIN edges USING (symbol, "column")),
  bins AS (SELECT symbol, "column", lo, hi, unnest(range(10))::INTEGER AS bin FROM edges)
  SELECT symbol, "column", bins.bin, round(bins.lo + (bins.hi - bins.lo) * bins.bin / 10, 6) AS bin_start,
    count(placed.bin) AS count
  FROM bins LEFT JOIN placed USING (symbol, "column", bin) GROUP BY symbol, "column", bins.bin, bins.lo, bins.hi""")
def histogram(spark, folder):
    return pr.histogram(tb.stored_event_candles(spark, folder))


_LABELLED = f"{BASE}, {label_sql()}, kept AS (SELECT * FROM labelled WHERE target IS NOT NULL)"
_WEIGHTS = """weights AS (SELECT symbol, "interval", target, count(*) AS n_class FROM kept GROUP BY ALL),
  balance AS (SELECT *, sum(n_class) OVER s / (count(*) OVER s * n_class) AS weight,
    sum(n_class) FILTER (target = 0) OVER s AS n0, sum(n_class) FILTER (target = 1) OVER s AS n1
    FROM weights WINDOW s AS (PARTITION BY symbol, "interval"))"""


def _labelled(spark, folder):
    return ft.labelled_rows(tb.stored_event_candles(spark, folder))


@query("a7_class_weights", f"""{_LABELLED}, {_WEIGHTS} SELECT symbol, "interval", target, n_class,
  round(weight, 6) AS weight, round(n0 / n1, 6) AS pos_weight_usual, round(n1 / n0, 6) AS pos_weight_balanced FROM balance""")
def class_weights(spark, folder):
    return ev.class_weights(_labelled(spark, folder))


@query("a8_enough_history", f"""{_LABELLED} SELECT {KEY_SQL}, target FROM kept
  QUALIFY count(*) OVER (PARTITION BY symbol, "interval") >= 300""")
def enough_history(spark, folder):
    return ft.enough_history(_labelled(spark, folder)).select(*CANDLE_KEY, "target")


_GRAINS = ["15m", "1h", "4h", "1d", "1w", "1M", "1y"]


@query("a9_ohlcv_rollup", f"""WITH {TICKS}, {", ".join(candles_sql(g, f"c{g}") for g in _GRAINS)}
  {" UNION ALL ".join(f"SELECT {CANDLE_SQL} FROM c{g}" for g in _GRAINS)}""")
def ohlcv_rollup(spark, folder):
    """Every grain from one scan of the ticks: the finest from ticks, the others from the finest."""
    return tb.stored_candle_grid(spark, folder, tuple(_GRAINS))


@query("a9_ticks_to_hourly", f"{BASE} SELECT {CANDLE_SQL} FROM candles")
def ticks_to_hourly(spark, folder):
    return tb.event_candles(spark, folder)


_ORDERS = """ticks AS (SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS seq,
  o_totalprice AS price, 1.0::DOUBLE AS quantity FROM orders)"""


@query("a9_orders_weekly", f"WITH {_ORDERS}, {candles_sql('1w')} SELECT {CANDLE_SQL} FROM candles")
def orders_weekly(spark, folder):
    return cd.roll_up_candles(tb.daily_order_candles(spark, folder), "1w", "1d")


_RULES = f"""{BASE}, {features_sql()}, {label_sql("feat")},
  rows_ AS (SELECT * FROM labelled WHERE target IS NOT NULL AND {COMPLETE_SQL}),
  ruled AS (SELECT symbol, target, 'low_rsi' AS model, CASE WHEN RSI < 50 THEN 1 ELSE 0 END AS prediction FROM rows_
    UNION ALL SELECT symbol, target, 'above_mean', CASE WHEN close > MA_10 THEN 1 ELSE 0 END FROM rows_
    UNION ALL SELECT symbol, target, 'below_mean', CASE WHEN close < MA_50 THEN 1 ELSE 0 END FROM rows_),
  counts AS (SELECT symbol, model, count(*) AS n,
    count(*) FILTER (target = 1 AND prediction = 1) AS tp, count(*) FILTER (target = 0 AND prediction = 0) AS tn,
    count(*) FILTER (target = 0 AND prediction = 1) AS fp, count(*) FILTER (target = 1 AND prediction = 0) AS fn
    FROM ruled GROUP BY ALL),
  scored AS (SELECT *, (tp + tn) / n AS accuracy, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::DOUBLE AS f1 FROM counts)"""


def rule_predictions(spark, folder):
    """Three fixed rules in the role of models; each row unfolds into one row per rule."""
    rows = ft.training_frame(tb.stored_event_candles(spark, folder))
    rule = lambda name, hit: F.struct(F.lit(name).alias("model"), hit.cast("int").alias("prediction"))
    return rows.select("symbol", "target", F.inline(F.array(
        rule("low_rsi", F.col("RSI") < 50),
        rule("above_mean", F.col("close") > F.col("MA_10")),
        rule("below_mean", F.col("close") < F.col("MA_50")),
    )))


@query("a10_accuracy_f1", f"""{_RULES} SELECT symbol, model, n, tp, tn, fp, fn, {rounded('accuracy', 'f1')} FROM scored""")
def accuracy_f1(spark, folder):
    return ev.scores(rule_predictions(spark, folder), "symbol", "model")


@query("a11_best_model", f"""{_RULES} SELECT symbol, model, {rounded('accuracy', 'f1')} FROM scored
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY f1 DESC, model) = 1""")
def best_model(spark, folder):
    return ev.best_model(ev.scores(rule_predictions(spark, folder), "symbol", "model")).select(
        "symbol", "model", "accuracy", "f1")


@query("a12_result_summary", f"""{_RULES} SELECT symbol, model AS best_model, {rounded('accuracy', 'f1', digits=3)} FROM scored
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY f1 DESC, model) = 1""")
def result_summary(spark, folder):
    return ev.summary(ev.scores(rule_predictions(spark, folder), "symbol", "model"))


@query("a13_any_true", f"{BASE} SELECT symbol, bool_or(high - low > 100) AS wide_candle FROM candles GROUP BY symbol")
def any_true(spark, folder):
    return ev.any_true(
        tb.event_candles(spark, folder), F.col("high") - F.col("low") > 100, "symbol", name="wide_candle")


@query("a14_signal_counts", f"{_RULES} SELECT symbol, model, target, prediction, count(*) AS n FROM ruled GROUP BY ALL")
def signal_counts(spark, folder):
    return ev.signal_counts(rule_predictions(spark, folder), "symbol", "model")


# -- statistics ----------------------------------------------------------------------------------

_PER_SPLIT = f"""{BASE}, {label_sql()}, {_SPLIT}, {features_sql("split_rows", 'symbol, "interval", split')},
  kept AS (SELECT * FROM feat WHERE {COMPLETE_SQL})"""


@query("m1_standardise", f"""{_PER_SPLIT},
  fitted AS (SELECT symbol, "interval", {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURE_NAMES)}
    FROM kept WHERE split = 'train' GROUP BY ALL)
  SELECT {KEY_SQL}, split, {", ".join(f"round((kept.{c} - m_{c}) / nullif(s_{c}, 0), 6) AS {c}" for c in FEATURE_NAMES)}
  FROM kept JOIN fitted USING (symbol, "interval")""")
def standardise(spark, folder):
    rows = materialise(ft.features_per_split(tb.stored_event_candles(spark, folder)), "features")
    return ev.standardise(rows, FEATURE_COLUMNS).select(*CANDLE_KEY, "split", *FEATURE_COLUMNS)


@query("m2_row_weights", f"""{_LABELLED}, {_WEIGHTS}
  SELECT {KEY_SQL}, target, round(weight, 6) AS weight FROM kept JOIN balance USING (symbol, "interval", target)""")
def row_weights(spark, folder):
    return ev.with_row_weights(_labelled(spark, folder)).select(*CANDLE_KEY, "target", "weight")


_NEWEST = 'row_number() OVER (PARTITION BY symbol, "interval" ORDER BY open_time DESC)'


def _significant(c: str) -> str:
    """``c`` to ten significant digits."""
    unit = f"pow(10.0, floor(log10(abs({c}))))"
    return f"CASE WHEN {c} = 0 THEN {c} ELSE round({c} / {unit}, 9) * {unit} END"


_KS = f"""{BASE}, old AS (SELECT * FROM candles QUALIFY {_NEWEST} <= 1000),
  young AS (SELECT * FROM candles QUALIFY {_NEWEST} <= 60),
  {features_sql("old", prefix="h_")}, {features_sql("young", prefix="r_")},
  long AS ({" UNION ALL ".join(
      f"SELECT symbol, \"interval\", '{c}' AS feature, {side} AS h, {_significant(c)} AS value FROM {table} WHERE {COMPLETE_SQL}"
      for c in FEATURE_NAMES for side, table in ((1, "h_feat"), (0, "r_feat")))}),
  per_value AS (SELECT symbol, "interval", feature, value, sum(h)::BIGINT AS h, sum(1 - h)::BIGINT AS r FROM long GROUP BY ALL),
  steps AS (SELECT symbol, "interval", feature, sum(h) OVER p AS n_history, sum(r) OVER p AS n_recent,
    sum(h) OVER o AS ch, sum(r) OVER o AS cr FROM per_value
    WINDOW p AS (PARTITION BY symbol, "interval", feature),
    o AS (PARTITION BY symbol, "interval", feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
  ks AS (SELECT symbol, "interval", feature, n_history::BIGINT AS n_history, n_recent::BIGINT AS n_recent,
    max(abs(ch / n_history - cr / n_recent)) AS ks_stat FROM steps GROUP BY ALL),
  lam AS (SELECT *, ks_stat * sqrt(n_history * n_recent / (n_history + n_recent)) AS l FROM ks),
  tested AS (SELECT symbol, "interval", feature, n_history, n_recent, ks_stat, CASE WHEN l < 0.2 THEN 1.0 ELSE
    least(greatest((SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * l * l))
      FROM range(1, 101) t(k)), 0), 1) END::DOUBLE AS p_asymptotic FROM lam)"""


# The exact p-value counts the sample orders whose distance stays below the observed one.
_KS_EXACT = f"""{_KS.replace("WITH", "WITH RECURSIVE", 1)},
  grid AS (SELECT symbol, "interval", feature, ks_stat, n_history AS n, n_recent AS m,
    round(ks_stat * n_history * n_recent)::BIGINT AS gap FROM ks),
  path AS (SELECT grid.*, 0::BIGINT AS j, i, CASE WHEN i * m < gap THEN 1.0 ELSE 0.0 END::DOUBLE AS ways
      FROM grid, LATERAL (SELECT unnest(range(n + 1)) AS i)
    UNION ALL SELECT symbol, "interval", feature, ks_stat, n, m, gap, j + 1, i,
      CASE WHEN abs(i * m - (j + 1) * n) < gap THEN sum(CASE WHEN abs(i * m - (j + 1) * n) < gap THEN ways ELSE 0.0 END)
        OVER (PARTITION BY symbol, "interval", feature ORDER BY i) ELSE 0.0 END FROM path WHERE j < m),
  exact AS (SELECT symbol, "interval", feature, ks_stat, CASE WHEN gap <= 0 THEN 1.0 ELSE
    1 - ways / exp(lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1)) END::DOUBLE AS p_value
    FROM path WHERE j = m AND i = n)"""


def _drift_stats(spark, folder):
    candles = tb.stored_candle_table(spark, folder)
    return drift.ks_statistic(drift.drift_samples(candles, candles))


def _verdict(spark, folder, method):
    candles = tb.stored_candle_table(spark, folder)
    tested = drift.with_p_value(drift.ks_statistic(drift.drift_samples(candles, candles)), method)
    return drift.drift_verdict(tested, candles)


def _verdict_sql(tested: str, p: str) -> str:
    return f"""verdict AS (SELECT symbol, "interval", bool_or({p} < 0.05) AS drift_detected, count(*) AS n_features FROM {tested} GROUP BY ALL)
  SELECT symbol, "interval", CASE WHEN n_features IS NULL THEN 'too few rows' ELSE 'ok' END AS status, drift_detected,
    coalesce(n_features, 0) AS n_features, 'ks_2samp' AS metric, 60 AS "window"
  FROM (SELECT DISTINCT symbol, "interval" FROM candles) LEFT JOIN verdict USING (symbol, "interval")"""


@query("m12_ks_statistic", f'{_KS} SELECT symbol, "interval", feature, n_history, n_recent, {rounded("ks_stat")} FROM ks')
def ks_statistic(spark, folder):
    return _drift_stats(spark, folder)


@query("m13_ks_p_asymptotic", f'{_KS} SELECT symbol, "interval", feature, {rounded("ks_stat", "p_asymptotic")} FROM tested')
def ks_p_asymptotic(spark, folder):
    return drift.with_asymptotic_p(_drift_stats(spark, folder)).select(*SERIES, "feature", "ks_stat", "p_asymptotic")


@query("m13_ks_p_value", f'{_KS_EXACT} SELECT symbol, "interval", feature, {rounded("ks_stat", "p_value")} FROM exact')
def ks_p_value(spark, folder):
    """Exact small-sample p-values."""
    return drift.with_p_value(_drift_stats(spark, folder)).select(*SERIES, "feature", "ks_stat", "p_value")


@query("m14_drift_verdict_asymptotic", f"{_KS}, {_verdict_sql('tested', 'p_asymptotic')}")
def drift_verdict_asymptotic(spark, folder):
    return _verdict(spark, folder, "asymptotic")


@query("m14_drift_verdict", f"{_KS_EXACT}, {_verdict_sql('exact', 'p_value')}")
def drift_verdict(spark, folder):
    return _verdict(spark, folder, "exact")


# -- monitoring ----------------------------------------------------------------------------------

def _scraped(seconds: int) -> str:
    return f"hourly AS (SELECT time_bucket(INTERVAL '{seconds} seconds', ts) AS ts, event_type, value, user_id FROM events)"


_HOURLY = _scraped(3600)


def _rate_sql(source: str, by: str, where: str = "true", seconds: int = 21600) -> str:
    """CTEs stepped and rates; a step belongs to the window of its later sample."""
    return f"""stepped AS (SELECT *, time_bucket(INTERVAL '{seconds} seconds', ts) AS window_start,
    value - lag(value) OVER (PARTITION BY {by} ORDER BY ts) AS step FROM {source} WHERE {where}),
  rates AS (SELECT {by}, window_start, sum(CASE WHEN step < 0 THEN value ELSE step END) / {seconds}.0 AS rate
    FROM stepped WHERE step IS NOT NULL GROUP BY ALL)"""


_COUNTED_CPU = """counted AS (SELECT (user_id % 4)::VARCHAR AS instance,
    CASE WHEN event_type = 'view' THEN 'idle' ELSE 'user' END AS mode, ts, count(*) AS hits FROM hourly GROUP BY ALL),
  cpu AS (SELECT instance, mode, ts, sum(hits) OVER (PARTITION BY instance, mode, date_trunc('week', ts) ORDER BY ts)::DOUBLE
    AS value FROM counted)"""
_SIX_HOURS, _MINUTE, _SCRAPE = 21600, 60, 15


def _utilisation(spark, folder, window, scrape):
    idle = mt.select_metric(samples.cpu_seconds(spark, folder, scrape), "node_cpu_seconds_total", mode="idle")
    rows = idle.select(mt.label("instance").alias("instance"), "ts", "value")
    return mt.utilisation(mt.counter_rate(rows, ["instance"], window))


def _utilisation_sql(window: int, scrape: int) -> str:
    return f"""WITH {_scraped(scrape)}, {_COUNTED_CPU}, {_rate_sql("cpu", "instance", "mode = 'idle'", window)}
  SELECT instance, window_start, round(100 - avg(rate) * 100, 6) AS utilisation FROM rates GROUP BY ALL"""


@query("n1_utilisation", _utilisation_sql(_SIX_HOURS, 3600))
def utilisation(spark, folder):
    return _utilisation(spark, folder, _SIX_HOURS, 3600)


@query("n1_utilisation_minute", _utilisation_sql(_MINUTE, _SCRAPE))
def utilisation_minute(spark, folder):
    """The dashboard's one-minute windows over 15-second scrapes."""
    return _utilisation(spark, folder, _MINUTE, _SCRAPE)


def _sliding_sql(source: str, by: str, where: str, window: int, step: int) -> str:
    """CTEs seen and rates; edges are extrapolated."""
    return f"""stepped AS (SELECT {by}, epoch(ts)::BIGINT AS s, value, value - lag(value) OVER w AS step, lag(epoch(ts)::BIGINT) OVER w AS before
    FROM {source} WHERE {where} WINDOW w AS (PARTITION BY {by} ORDER BY ts)),
  points AS (SELECT *, unnest(range((s + {step - 1}) // {step} * {step}, s + {window}, {step})) AS t FROM stepped),
  seen AS (SELECT {by}, t, count(*) AS n, min(s) AS s0, max(s) AS s1, arg_min(value, s) AS v0, (max(s) - min(s)) / (count(*) - 1) AS gap,
    sum(CASE WHEN before > t - {window} THEN CASE WHEN step < 0 THEN value ELSE step END END) AS inc
    FROM points GROUP BY {by}, t HAVING count(*) > 1),
  edges AS (SELECT *, CASE WHEN s0 - (t - {window}) >= gap * 1.1 THEN gap / 2 ELSE s0 - (t - {window}) END AS lead,
    CASE WHEN t - s1 >= gap * 1.1 THEN gap / 2 ELSE t - s1 END AS trail,
    CASE WHEN inc > 0 AND v0 >= 0 THEN (s1 - s0) * (v0 / inc) END AS zero FROM seen),
  rates AS (SELECT {by}, to_timestamp(t)::TIMESTAMP AS "at",
    inc * ((s1 - s0 + coalesce(least(lead, zero), lead) + trail) / (s1 - s0)) / {window} AS rate FROM edges)"""


@query("n1_utilisation_sliding", f"""WITH {_HOURLY}, {_COUNTED_CPU}, {_sliding_sql("cpu", "instance", "mode = 'idle'", _SIX_HOURS, 3600)}
  SELECT instance, "at", round(100 - avg(rate) * 100, 6) AS utilisation FROM rates GROUP BY ALL""")
def utilisation_sliding(spark, folder):
    """Six-hour windows that end at every hour."""
    idle = mt.select_metric(samples.cpu_seconds(spark, folder), "node_cpu_seconds_total", mode="idle")
    rows = idle.select(mt.label("instance").alias("instance"), "ts", "value")
    return mt.utilisation(mt.sliding_rate(rows, ["instance"], _SIX_HOURS, 3600), at="at")


@query("n2_gauge_difference", f"""WITH {_HOURLY} SELECT (user_id % 4)::VARCHAR AS instance, ts,
  round(sum(value) - max(value), 6) AS difference FROM hourly GROUP BY ALL""")
def gauge_difference(spark, folder):
    rows = samples.memory(spark, folder).withColumn("instance", mt.label("instance"))
    return mt.gauge_difference(rows, "node_memory_MemTotal_bytes", "node_memory_MemAvailable_bytes", ["instance"])


@query("n3_counter_by_label", f"""WITH {_HOURLY}, counted AS (SELECT event_type AS endpoint, ts, count(*) AS hits FROM hourly GROUP BY ALL)
  SELECT endpoint, ts, sum(hits) OVER (PARTITION BY endpoint, date_trunc('week', ts) ORDER BY ts)::DOUBLE AS value FROM counted""")
def counter_by_label(spark, folder):
    rows = mt.select_metric(samples.api_requests(spark, folder), "api_requests_total")
    return rows.select(mt.label("endpoint").alias("endpoint"), "ts", "value")


_BOUNDS = [*samples.BUCKETS, "'inf'::DOUBLE"]
_LATENCY = f"""bounds AS (SELECT unnest([{", ".join(map(str, _BOUNDS))}]) AS le),
  counted AS (SELECT event_type AS endpoint, ts, le, count(*) FILTER (value <= le) AS hits FROM hourly, bounds GROUP BY ALL),
  buckets AS (SELECT endpoint, le, ts, sum(hits) OVER (PARTITION BY endpoint, le, date_trunc('week', ts) ORDER BY ts)::DOUBLE
    AS value FROM counted)"""


def _crossing_sql(at: str) -> str:
    """The 95 % quantile of bucket rates."""
    return f"""summed AS (SELECT {at}, le, sum(rate) AS rate FROM rates GROUP BY ALL),
  placed AS (SELECT *, max(rate) OVER (PARTITION BY {at}) * 0.95 AS rank,
    coalesce(lag(le) OVER w, 0) AS lower, coalesce(lag(rate) OVER w, 0) AS before
    FROM summed WINDOW w AS (PARTITION BY {at} ORDER BY le)),
  hit AS (SELECT * FROM placed WHERE rank > 0 AND rate >= rank
    QUALIFY row_number() OVER (PARTITION BY {at} ORDER BY le) = 1)
  SELECT {at}, round(CASE WHEN isinf(le) THEN lower ELSE lower + (le - lower) * (rank - before) / (rate - before) END, 6)
    AS quantile FROM hit"""


def _quantile_sql(window: int, scrape: int) -> str:
    return f"""WITH {_scraped(scrape)}, {_LATENCY}, {_rate_sql("buckets", "endpoint, le", "true", window)},
{_crossing_sql("window_start")}"""


def _quantile(spark, folder, window, scrape):
    buckets = mt.select_metric(samples.latency_buckets(spark, folder, scrape), "api_request_latency_seconds_bucket")
    rows = buckets.select(
        mt.label("endpoint").alias("endpoint"), mt.label("le").cast("double").alias("le"), "ts", "value")
    return mt.histogram_quantile(mt.counter_rate(rows, ["endpoint", "le"], window), 0.95)


@query("n4_histogram_quantile", _quantile_sql(_SIX_HOURS, 3600))
def histogram_quantile(spark, folder):
    return _quantile(spark, folder, _SIX_HOURS, 3600)


@query("n4_histogram_quantile_minute", _quantile_sql(_MINUTE, _SCRAPE))
def histogram_quantile_minute(spark, folder):
    return _quantile(spark, folder, _MINUTE, _SCRAPE)


@query("n4_histogram_quantile_sliding", f"""WITH {_HOURLY}, {_LATENCY}, {_sliding_sql("buckets", "endpoint, le", "true", _SIX_HOURS, 3600)},
  {_crossing_sql('"at"')}""")
def histogram_quantile_sliding(spark, folder):
    """Six-hour windows that end at every hour."""
    buckets = mt.select_metric(samples.latency_buckets(spark, folder), "api_request_latency_seconds_bucket")
    rows = buckets.select(
        mt.label("endpoint").alias("endpoint"), mt.label("le").cast("double").alias("le"), "ts", "value")
    return mt.histogram_quantile(mt.sliding_rate(rows, ["endpoint", "le"], _SIX_HOURS, 3600), 0.95, ["at"])


@query("n5_gauge_by_label", f"""WITH {_HOURLY} SELECT event_type AS state, ts, count(*)::DOUBLE AS value FROM hourly
  WHERE user_id % 3 = 1 GROUP BY ALL""")
def gauge_by_label(spark, folder):
    rows = mt.select_metric(samples.connections(spark, folder), "pg_stat_activity_count", datname="db_1")
    return rows.select(mt.label("state").alias("state"), "ts", "value")


@query("n6_active_series", f"""WITH {_HOURLY} SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start,
  count(DISTINCT user_id) AS active FROM hourly WHERE user_id % 5 <> 0 GROUP BY ALL""")
def active_series(spark, folder):
    rows = mt.select_metric(samples.containers(spark, folder), "container_start_time_seconds")
    named = rows.where(mt.label("image") != "").withColumn("container", mt.label("name"))
    return mt.active_series(named, ["container"], _SIX_HOURS)
