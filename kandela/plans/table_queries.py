"""Registered source, sink, generator, scalar, join and serving queries (S, K, G, P, J, U, O)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from kandela.functions import indicators as ind, scalars as sc
from kandela.operators import calendar, candles as cd, clean, serving, store
from kandela.operators.series import last_rows, over_series
from kandela.plans.registry import (
    BASE, CANDLE_SQL, PRICES_SQL, TICKS, W, candles_sql, query, rounded,
)
from kandela.schemas import (
    CANDLE, CANDLE_KEY, DIM_SYMBOL, EXPORT_INTERVAL_MINUTES, EXPORT_SYMBOLS, GRAIN_PRICES, KLINES, PRICES, SERIES, STREAM_CANDLE, conform,
)
from kandela.session import materialise, scratch_path
from kandela.sources import csv_candles, klines as kl, messages as ms, tables as tb

KEY_SQL = 'symbol, "interval", open_time'
GRID = f"""WITH {TICKS}, {candles_sql('15m', 'c15')}, {candles_sql('1h', 'c60')}, {candles_sql('1d', 'c1440')},
  grid AS (SELECT * FROM c15 UNION ALL SELECT * FROM c60 UNION ALL SELECT * FROM c1440)"""
_ID_ORDER = "row_number() OVER (ORDER BY symbol_id, open_time) AS klines_id"
DIMS = """dim_symbol AS (SELECT row_number() OVER (ORDER BY symbol)::INTEGER AS symbol_id, symbol
  FROM (SELECT DISTINCT symbol FROM candles))"""
# A candle is closed once a later one of the feed has closed.
CLOSED = "docs AS (SELECT *, close_time < (SELECT max(close_time) FROM candles) AS closed FROM candles)"


def documents(candles):
    """Candles with the closed flag: everything before the newest close of the feed."""
    newest = candles.agg(F.max("close_time")).scalar()
    return candles.withColumn("closed", F.col("close_time") < newest)


def revised(candles):
    """Second load: every sixth hour comes again with a corrected close."""
    again = candles.where(F.hour("open_time") % 6 == 0).withColumn("close", F.col("close") + 1)
    return candles.withColumn("load_seq", F.lit(1)), again.withColumn("load_seq", F.lit(2))


REVISED = """first_load AS (SELECT *, 1 AS load_seq FROM candles),
  second_load AS (SELECT * REPLACE (close + 1 AS close), 2 AS load_seq FROM candles WHERE hour(open_time) % 6 = 0),
  merged AS (SELECT * FROM (SELECT * FROM first_load UNION ALL SELECT * FROM second_load)
    QUALIFY row_number() OVER (PARTITION BY symbol, "interval", open_time ORDER BY load_seq DESC) = 1)"""


def fact_tables(spark, folder):
    """(klines, symbol dimension, interval dimension) as stored tables."""
    candles = tb.stored_event_candles(spark, folder)
    symbols, intervals = store.build_dimensions(spark, candles)
    found, _ = store.resolve_ids(candles, symbols, intervals)
    return store.store_klines(store.as_klines(found)), symbols, intervals


# -- sources -------------------------------------------------------------------------------------

@query("s1_rest_decode", f"{BASE} SELECT {CANDLE_SQL} FROM candles")
def rest_decode(spark, folder):
    return kl.decode_klines(kl.encode_klines(tb.event_candles(spark, folder)))


@query("s2_raw_json_folder", f"{GRID} SELECT {CANDLE_SQL} FROM grid")
def raw_json_folder(spark, folder):
    path = scratch_path(spark, "raw")
    pages = kl.encode_klines(tb.stored_candle_grid(spark, folder))
    pages.select(sc.series_name(F.col("symbol"), F.col("interval")).alias("name"), "value").write.partitionBy(
        "name").text(path)
    return kl.read_kline_files(spark, path)


@query("s2_raw_json_lines", f"{GRID} SELECT {CANDLE_SQL} FROM grid")
def raw_json_lines(spark, folder):
    path = scratch_path(spark, "raw-lines")
    pages = kl.encode_klines(tb.stored_candle_grid(spark, folder))
    pages.select(F.to_json(F.struct(
        F.lower("symbol").alias("symbol"), "interval",
        F.from_json("value", "array<array<string>>").alias("page"))).alias("value")).write.text(path)
    return kl.read_kline_lines(spark, path)


def _csv_folder(spark, folder):
    """Daily candles with date-only open times and hourly ones, a folder per symbol and interval."""
    path = scratch_path(spark, "csv")
    grid = tb.stored_candle_grid(spark, folder, ("1h", "1d"))
    opened = F.when(F.col("interval") == "1d", sc.day_text(F.col("open_time"))).otherwise(
        sc.line_time(F.col("open_time")))
    grid.select(
        sc.series_name(F.col("symbol"), F.col("interval")).alias("name"), opened.alias("open_time"), *PRICES,
        F.date_format("close_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("close_time"),
    ).write.partitionBy("name").option("header", True).csv(path)
    return path


_TWO = f"""WITH {TICKS}, {candles_sql('1h', 'c60')}, {candles_sql('1d', 'c1440')},
  grid AS (SELECT * FROM c60 UNION ALL SELECT * FROM c1440)"""


@query("s3_candle_csv", f"{_TWO} SELECT {CANDLE_SQL} FROM grid")
def candle_csv(spark, folder):
    return csv_candles.read_candle_csv(spark, _csv_folder(spark, folder))


@query("s4_names_from_files", f'{_TWO} SELECT symbol, "interval", count(*) AS n_rows FROM grid GROUP BY ALL')
def names_from_files(spark, folder):
    rows = csv_candles.read_candle_csv(spark, _csv_folder(spark, folder))
    return rows.groupBy("symbol", "interval").agg(F.count("*").alias("n_rows"))


def broken_messages(spark, folder):
    """Messages of all candles; at 03h the object k is missing, at 05h the open is no number."""
    docs = documents(tb.stored_event_candles(spark, folder))
    hour = F.hour("open_time")
    opened = F.when(hour == 5, "n/a").otherwise(F.col("open").cast("string"))
    fine = ms.encode_messages(docs.where(hour != 3).withColumn("open", opened))
    missing = ms.encode_messages(docs.where(hour == 3)).select(
        F.regexp_replace("value", '^\\{"k"', '{"data"').alias("value"))
    return fine.unionByName(missing)


@query("s5_message_decode", f"""{BASE}, {CLOSED}
  SELECT {CANDLE_SQL}, closed FROM docs WHERE hour(open_time) NOT IN (3, 5)""")
def message_decode(spark, folder):
    return ms.accepted(ms.decode_messages(broken_messages(spark, folder)))


@query("s6_scan_all", f"""{BASE}, {DIMS}
  SELECT {_ID_ORDER}, symbol_id, 1 AS interval_id, open_time, {PRICES_SQL}, close_time FROM candles JOIN dim_symbol USING (symbol)""")
def scan_all(spark, folder):
    klines, _, _ = fact_tables(spark, folder)
    return klines.drop("created_at", "month")


@query("s7_scan_filtered", f"""{GRID}, ids AS (SELECT row_number() OVER (ORDER BY "interval")::INTEGER AS interval_id,
  "interval" FROM (SELECT DISTINCT "interval" FROM grid))
  SELECT symbol, interval_id, open_time, {PRICES_SQL} FROM grid JOIN ids USING ("interval") WHERE interval_id IN (2, 3)""")
def scan_filtered(spark, folder):
    grid = tb.stored_candle_grid(spark, folder)
    _, intervals = store.build_dimensions(spark, grid)
    known = intervals.select(F.col("interval_name").alias("interval"), "interval_id")
    rows = materialise(grid.join(known, on="interval"), "grid")
    return tb.scan_intervals(rows, 2, 3).select("symbol", "interval_id", "open_time", *PRICES)


@query("s8_scan_projected_ordered", f"""{BASE}
  SELECT symbol, open_time, {rounded('open', 'high', 'low', 'close')} FROM candles ORDER BY symbol, open_time""")
def scan_projected_ordered(spark, folder):
    return tb.scan_prices(tb.event_candles(spark, folder))


@query("s9_symbol_documents", f"{BASE} SELECT {CANDLE_SQL} FROM candles WHERE symbol = 'CLICK'")
def symbol_documents(spark, folder):
    path = scratch_path(spark, "documents")
    store.append_documents(tb.event_candles(spark, folder), path)
    return conform(tb.scan_symbol(tb.read_stored(spark, path), "CLICK"), CANDLE)


@query("s10_training_csv", f"""{BASE}, {DIMS}
  SELECT {_ID_ORDER}, symbol_id, 1 AS interval_id, open_time, {PRICES_SQL}, close_time FROM candles JOIN dim_symbol USING (symbol)""")
def training_csv(spark, folder):
    path = scratch_path(spark, "training")
    klines, _, _ = fact_tables(spark, folder)
    klines.select(*KLINES.names).write.option("header", True).csv(path)
    return tb.read_training_csv(spark, path).drop("created_at")


@query("s11_explicit_schema", f"""{BASE}, {CLOSED}
  SELECT symbol, {PRICES_SQL}, close_time AS "timestamp", closed FROM docs WHERE hour(open_time) NOT IN (3, 5)""")
def explicit_schema(spark, folder):
    rows = ms.accepted(ms.decode_messages(broken_messages(spark, folder)))
    return conform(rows.withColumnRenamed("close_time", "timestamp"), STREAM_CANDLE)


# -- sinks ---------------------------------------------------------------------------------------

@query("k1_csv_export", f"{BASE} SELECT {CANDLE_SQL} FROM candles")
def csv_export(spark, folder):
    path = scratch_path(spark, "export")
    store.export_csv(tb.event_candles(spark, folder), path)
    return csv_candles.read_partitioned_csv(spark, path, ["symbol"])


@query("k2_json_lines", f"""{BASE} SELECT symbol, {PRICES_SQL}, strftime(open_time, '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM candles""")
def json_lines(spark, folder):
    path = scratch_path(spark, "lines")
    rows = tb.stored_event_candles(spark, folder).select("symbol", *PRICES, F.col("open_time").alias("timestamp"))
    late = F.hour("timestamp") >= 12
    store.append_json_lines(rows.where(~late), path)
    store.append_json_lines(rows.where(late), path)
    schema = T.StructType([T.StructField("symbol", T.StringType()), *CANDLE.fields[3:8],
                           T.StructField("timestamp", T.StringType())])
    return spark.read.schema(schema).json(path)


_HALVES = """halves AS (SELECT *, hour(open_time) % 2 AS half FROM candles JOIN dim_symbol USING (symbol)),
  numbered AS (SELECT *, row_number() OVER (ORDER BY half, symbol_id, open_time) AS klines_id FROM halves)"""


def _halves(spark, folder):
    """Candles with ids in two loads: even hours, then odd ones."""
    candles = tb.stored_event_candles(spark, folder)
    found = materialise(store.resolve_ids(candles, *store.build_dimensions(spark, candles))[0], "found")
    return found.where("hour(open_time) % 2 = 0"), found.where("hour(open_time) % 2 = 1")


@query("k3_append_audit", f"""{BASE}, {DIMS}, {_HALVES}
  SELECT klines_id, symbol_id, 1 AS interval_id, open_time, {PRICES_SQL}, close_time, true AS audited FROM numbered""")
def append_audit(spark, folder):
    """A second load appended to a filled table: ids go on where the first load ended."""
    path = scratch_path(spark, "klines")
    for part in _halves(spark, folder):
        store.append_klines(path, part)
    return store.read_klines(spark, path).drop("month").withColumn("audited", F.col("created_at").isNotNull()).drop("created_at")


@query("k4_load_klines", f"""{BASE}, {DIMS}, {_HALVES}
  SELECT klines_id, symbol, open_time, round(close + CASE WHEN hour(open_time) % 6 = 0 THEN 1 ELSE 0 END, 6) AS close, true AS audited
  FROM numbered""")
def load_klines(spark, folder):
    """Even hours are loaded, loaded again, then everything with corrected closes: ids stay, values follow."""
    root, candles = scratch_path(spark, "base"), tb.stored_event_candles(spark, folder)
    even = candles.where("hour(open_time) % 2 = 0")
    corrected = candles.withColumn("close", F.col("close") + F.when(F.hour("open_time") % 6 == 0, 1).otherwise(0))
    for part in (even, even, corrected.unionByName(corrected.where("hour(open_time) = 1"))):
        store.load_candles(root, part)
    symbols = tb.read_stored(spark, f"{root}/symbol", DIM_SYMBOL)
    return serving.with_symbol(store.read_klines(spark, f"{root}/klines"), symbols).select(
        "klines_id", "symbol", "open_time", "close", F.col("created_at").isNotNull().alias("audited"))


@query("k4_load_rejects", f"""{GRID} SELECT "interval", CASE WHEN "interval" = '1d' THEN 'unknown interval' ELSE 'missing field' END AS reason,
  count(*) AS n FROM grid WHERE "interval" = '1d' OR hour(open_time) = 5 GROUP BY ALL""")
def load_rejects(spark, folder):
    """Daily candles under an unknown name and candles without a price are rejected with their reason."""
    grid = tb.stored_candle_grid(spark, folder)
    broken = grid.withColumn("close", F.when((F.col("interval") == "1d") | (F.hour("open_time") != 5), F.col("close")))
    named = broken.withColumn("interval", F.when(F.col("interval") == "1d", "1 day").otherwise(F.col("interval")))
    rejected = store.load_candles(scratch_path(spark, "base"), named)
    return rejected.groupBy(F.when(F.col("interval") == "1 day", "1d").otherwise(F.col("interval")).alias("interval"), "reason").agg(
        F.count("*").alias("n"))


@query("k4_upsert", f"{BASE}, {REVISED} SELECT {CANDLE_SQL}, load_seq FROM merged")
def upsert(spark, folder):
    stored, incoming = revised(tb.stored_event_candles(spark, folder))
    return store.upsert(stored, incoming)


@query("k4_upsert_table", f"{BASE}, {REVISED} SELECT {CANDLE_SQL}, load_seq FROM merged")
def upsert_table(spark, folder):
    path = scratch_path(spark, "candle-table")
    stored, incoming = revised(tb.stored_event_candles(spark, folder))
    store.write_candles(stored, path)
    store.upsert_into(path, incoming)
    return store.read_candles(spark, path, stored.schema).drop("month").select(*stored.columns)


@query("k5_insert_if_absent", f"""{BASE}, old AS (SELECT row_number() OVER (ORDER BY symbol) AS id, symbol FROM
    (SELECT DISTINCT symbol FROM candles WHERE symbol > 'E')),
  fresh AS (SELECT DISTINCT symbol FROM candles WHERE symbol NOT IN (SELECT symbol FROM old)),
  all_ids AS (SELECT id, symbol FROM old UNION ALL
    SELECT row_number() OVER (ORDER BY symbol) + (SELECT max(id) FROM old), symbol FROM fresh)
  SELECT id::INTEGER AS symbol_id, symbol, CASE WHEN length(symbol) > 4 THEN left(symbol, length(symbol) - 4) ELSE '' END
  AS base_asset, right(symbol, 4) AS quote_asset FROM all_ids""")
def insert_if_absent(spark, folder):
    candles = tb.stored_event_candles(spark, folder)
    some = store.symbol_rows(candles.where("symbol > 'E'"))
    stored = materialise(conform(store.insert_if_absent(
        spark.createDataFrame([], DIM_SYMBOL), some, "symbol", "symbol_id"), DIM_SYMBOL), "dim")
    return store.insert_if_absent(stored, store.symbol_rows(candles), "symbol", "symbol_id")


@query("k6_document_append", f'{BASE} SELECT {CANDLE_SQL} FROM candles')
def document_append(spark, folder):
    path = scratch_path(spark, "documents")
    candles = tb.stored_event_candles(spark, folder)
    store.append_documents(candles.where("open < close"), path)
    store.append_documents(candles.where("open >= close"), path)
    return conform(tb.read_stored(spark, path), CANDLE)


@query("k7_load_once", f"""{BASE}, {DIMS} SELECT true AS loaded, count(*) AS n_rows FROM candles""")
def load_once(spark, folder):
    """A second load of a filled table is skipped."""
    path = scratch_path(spark, "once")
    candles = tb.stored_event_candles(spark, folder)
    spark.createDataFrame([], CANDLE).write.parquet(path)
    for _ in range(2):
        if not store.is_loaded(tb.read_stored(spark, path)):
            candles.write.mode("append").parquet(path)
    stored = tb.read_stored(spark, path)
    return stored.agg((F.count("*") > 0).alias("loaded"), F.count("*").alias("n_rows"))


_ORDERS = """ticks AS (SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS seq,
  o_totalprice AS price, 1.0::DOUBLE AS quantity FROM orders)"""


@query("k8_table_contract", f"""WITH {_ORDERS}, {candles_sql('1d')}
  SELECT symbol, strftime(open_time, '%Y-%m-%d') AS date,
  {", ".join(f"CAST(CAST({c} AS DECIMAL(18,3)) AS DOUBLE) AS {c}" for c in PRICES)} FROM candles""")
def table_contract(spark, folder):
    daily = tb.daily_order_candles(spark, folder).withColumn("date", F.col("open_time").cast("date"))
    contract = T.StructType([T.StructField("symbol", T.StringType()), *GRAIN_PRICES.fields])
    return conform(daily, contract)


# The constraints of the three tables.
_CONSTRAINTS = [
    ("symbol", "primary key symbol_id"), ("symbol", "unique symbol"), ("symbol", "not null"),
    ("intervals", "primary key interval_id"), ("intervals", "unique interval_name"), ("intervals", "not null"),
    ("klines", "primary key klines_id"), ("klines", "unique symbol_id, interval_id, open_time"), ("klines", "not null"),
    ("klines", "foreign key symbol_id"), ("klines", "foreign key interval_id")]


@query("k8_constraints", f"""{BASE}, report("table", "constraint") AS (VALUES {", ".join(map(str, _CONSTRAINTS))})
  SELECT "table", "constraint", CASE WHEN "constraint" = 'foreign key symbol_id'
    THEN (SELECT count(*) FROM candles WHERE symbol = 'CLICK') ELSE 0 END AS violations FROM report""")
def constraints(spark, folder):
    """The report over tables that lack one symbol."""
    klines, symbols, intervals = fact_tables(spark, folder)
    return store.constraint_report(klines, symbols.where("symbol <> 'CLICK'"), intervals)


_GRAINS = ["1d", "1w", "1M", "1y"]


@query("k8_grain_contracts", f"""WITH {_ORDERS}, {", ".join(candles_sql(g, f"c{g}") for g in _GRAINS)},
  grains AS ({" UNION ALL ".join(f"SELECT * FROM c{g}" for g in _GRAINS)})
  SELECT symbol, "interval", strftime(open_time, '%Y-%m-%d') AS date,
  {", ".join(f"CAST(CAST({c} AS DECIMAL(18,3)) AS DOUBLE) AS {c}" for c in PRICES)} FROM grains""")
def grain_contracts(spark, folder):
    """The per-grain price tables; coarse grains come from the stored daily one."""
    daily = materialise(tb.daily_order_candles(spark, folder), "daily")
    grains = daily
    for grain in _GRAINS[1:]:
        grains = grains.unionByName(cd.roll_up_candles(daily, grain, "1d"))
    names = [T.StructField(n, T.StringType()) for n in ("symbol", "interval")]
    return conform(grains.withColumn("date", F.col("open_time").cast("date")), T.StructType([*names, *GRAIN_PRICES.fields]))


# -- generators ----------------------------------------------------------------------------------

@query("g1_backfill_slices", f"""WITH {TICKS}, bounds AS (SELECT symbol, date_trunc('hour', min(ts))::TIMESTAMP AS s,
    max(ts) AS e FROM ticks GROUP BY symbol),
  starts AS (SELECT symbol, e, unnest(generate_series(s, e, INTERVAL '4 hours')) AS slice_start FROM bounds)
  SELECT symbol, slice_start, least(slice_start + INTERVAL '4 hours', e) AS slice_end FROM starts WHERE slice_start < e""")
def backfill_slices(spark, folder):
    bounds = tb.event_ticks(spark, folder).groupBy("symbol").agg(
        F.date_trunc("hour", F.min("ts")).alias("start_time"), F.max("ts").alias("end_time"))
    return calendar.backfill_slices(bounds, "4 HOURS", ("symbol",))


@query("g2_date_dimension", """WITH days AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate),
    INTERVAL '1 day'))::DATE AS date FROM orders)
  SELECT strftime(date, '%Y-%m-%d') AS date, year(date)::INTEGER AS year, month(date)::INTEGER AS month, day(date)::INTEGER AS day,
    week(date)::INTEGER AS week, quarter(date)::INTEGER AS quarter, dayname(date) AS day_name,
    monthname(date) AS month_name, isodow(date) >= 6 AS is_weekend FROM days""")
def date_dimension(spark, folder):
    orders = tb.read_table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return calendar.date_dimension(orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))


@query("g3_page_assembly", f"{BASE} SELECT {CANDLE_SQL} FROM candles")
def page_assembly(spark, folder):
    """Two sets of pages that overlap by a few hours of every day."""
    candles = tb.stored_event_candles(spark, folder)
    pages = kl.encode_klines(candles.where("hour(open_time) <= 13"), 24).unionByName(
        kl.encode_klines(candles.where("hour(open_time) >= 10"), 24))
    return kl.assemble_pages(kl.decode_klines(pages))


_WORK = f"""{GRID} SELECT symbol, "interval", CASE "interval" WHEN '15m' THEN 900 WHEN '1h' THEN 3600 ELSE 86400 END AS seconds
  FROM (SELECT DISTINCT symbol FROM grid), (SELECT DISTINCT "interval" FROM grid)"""


@query("g4_work_list", _WORK)
def work_list(spark, folder):
    symbols, intervals = store.build_dimensions(spark, tb.stored_candle_grid(spark, folder))
    return store.work_list(symbols, intervals)


# -- scalars, projections, filters ---------------------------------------------------------------

@query("p1_epoch_ms", "SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts FROM events")
def epoch_ms(spark, folder):
    ticks = tb.event_ticks(spark, folder)
    return ticks.select(F.col("seq").alias("event_id"), sc.from_epoch_ms(F.unix_millis("ts")).alias("ts"))


@query("p2_string_to_double", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
  TRY_CAST(event_type AS DOUBLE) AS no_number FROM events""")
def string_to_double(spark, folder):
    events = tb.read_table(spark, folder, "events")
    return events.select(
        "event_id", sc.to_number(F.get_json_object("props", "$.k")).alias("quantity"),
        sc.to_number(F.col("event_type")).alias("no_number"))


@query("p3_history_as_ticks", f"""{BASE} SELECT symbol, round(close, 6) AS price, round(volume, 6) AS quantity,
  open_time AS "timestamp" FROM candles""")
def history_as_ticks(spark, folder):
    return clean.history_as_ticks(tb.event_candles(spark, folder))


@query("p4_stream_as_ticks", f"""{BASE} SELECT symbol, round(close, 6) AS price, round(volume, 6) AS quantity,
  date_trunc('second', close_time)::TIMESTAMP AS "timestamp" FROM candles""")
def stream_as_ticks(spark, folder):
    rows = tb.event_candles(spark, folder).select(
        F.lower("symbol").alias("symbol"), *PRICES, sc.line_time(F.col("close_time")).alias("timestamp"))
    return clean.stream_as_ticks(rows)


@query("p5_base_quote", f"""WITH {TICKS} SELECT seq, CASE WHEN length(symbol) > 4 THEN left(symbol, length(symbol) - 4)
  ELSE '' END AS base_asset, right(symbol, 4) AS quote_asset FROM ticks""")
def base_quote(spark, folder):
    symbol = F.col("symbol")
    return tb.event_ticks(spark, folder).select(
        "seq", sc.base_asset(symbol).alias("base_asset"), sc.quote_asset(symbol).alias("quote_asset"))


@query("p6_case", "SELECT event_id, upper(trim(event_type)) AS upper_name, lower(event_type) AS lower_name FROM events")
def case(spark, folder):
    return tb.read_table(spark, folder, "events").select(
        "event_id", sc.canonical_symbol(F.col("event_type")).alias("upper_name"),
        F.lower("event_type").alias("lower_name"))


def _case(values) -> str:
    return " ".join(f"WHEN {k} THEN {v!r}" for k, v in values.items())


@query("p7_id_to_label", f"""SELECT event_id, CASE user_id % 6 {_case(EXPORT_SYMBOLS)} END AS symbol_label,
  CAST(CASE user_id % 6 {_case(EXPORT_INTERVAL_MINUTES)} END AS DOUBLE) AS interval_min FROM events""")
def id_to_label(spark, folder):
    events = tb.read_table(spark, folder, "events").withColumn("id", (F.col("user_id") % 6).cast("int"))
    named = clean.map_labels(events, "id", EXPORT_SYMBOLS, "symbol_label")
    return clean.map_labels(named, "id", EXPORT_INTERVAL_MINUTES, "interval_min").select(
        "event_id", "symbol_label", F.col("interval_min").cast("double").alias("interval_min"))


@query("p8_interval_length", f"""{GRID} SELECT {KEY_SQL}, CASE "interval" WHEN '15m' THEN 900 WHEN '1h' THEN 3600 ELSE 86400 END
  AS seconds, CASE "interval" WHEN '15m' THEN 15 WHEN '1h' THEN 60 ELSE 1440 END AS minutes FROM grid""")
def interval_length(spark, folder):
    name = F.col("interval")
    return tb.stored_candle_grid(spark, folder).select(
        *CANDLE_KEY, sc.interval_seconds(name).alias("seconds"), sc.interval_minutes(name).alias("minutes"))


@query("p9_closed_only", f"{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed")
def closed_only(spark, folder):
    return clean.closed_only(documents(tb.stored_event_candles(spark, folder))).select(*CANDLE.names)


@query("p10_equality_in", f"""{GRID} SELECT {CANDLE_SQL} FROM grid
  WHERE symbol IN ('CLICK', 'VIEW') AND "interval" = '15m'""")
def equality_in(spark, folder):
    return clean.select_series(tb.stored_candle_grid(spark, folder), ["CLICK", "VIEW"], ["15m"])


@query("p11_time_range", f"""{BASE} SELECT {CANDLE_SQL} FROM candles
  WHERE open_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-19 12:00:00'""")
def time_range(spark, folder):
    return clean.between_times(tb.event_candles(spark, folder), "2024-01-05 00:00:00", "2024-01-19 12:00:00")


@query("p12_projection", f"{BASE} SELECT symbol, open_time, {rounded('close', 'volume')} FROM candles")
def projection(spark, folder):
    return tb.event_candles(spark, folder).select("symbol", "open_time", "close", "volume")


@query("p13_drop_incomplete", f"""{BASE}, r AS (SELECT *, close / nullif(lag(close) OVER ({W}), 0) - 1 AS RET FROM candles)
  SELECT {KEY_SQL}, {rounded('RET')} FROM r WHERE RET IS NOT NULL""")
def drop_incomplete(spark, folder):
    rows = over_series(
        tb.stored_event_candles(spark, folder),
        lambda df, w: df.withColumn("RET", ind.percent_change(F.col("close"), w)), back=1)
    return clean.drop_incomplete(rows, ["RET"]).select(*CANDLE_KEY, "RET")


@query("p14_numeric_columns", """SELECT l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def numeric_columns(spark, folder):
    return clean.numeric_columns(tb.read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("p15_up_down", f"{BASE} SELECT {KEY_SQL}, CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction FROM candles")
def up_down(spark, folder):
    return cd.with_direction(tb.event_candles(spark, folder)).select(*CANDLE_KEY, "direction")


@query("p16_geometry", f"""{BASE} SELECT {KEY_SQL}, round(close - open, 6) AS body,
  round(high - greatest(open, close), 6) AS upper_wick, round(least(open, close) - low, 6) AS lower_wick FROM candles""")
def geometry(spark, folder):
    return cd.with_geometry(tb.event_candles(spark, folder)).select(*CANDLE_KEY, "body", "upper_wick", "lower_wick")


@query("p17_mid_price", f"{BASE} SELECT {KEY_SQL}, round((high + low) / 2, 6) AS mid_price FROM candles")
def mid_price(spark, folder):
    return cd.with_mid_price(tb.event_candles(spark, folder)).select(*CANDLE_KEY, "mid_price")


@query("p18_signal_name", f"{BASE} SELECT {KEY_SQL}, CASE WHEN close > open THEN 'BUY' ELSE 'SELL' END AS signal FROM candles")
def signal_name(spark, folder):
    up = (F.col("close") > F.col("open")).cast("int")
    return tb.event_candles(spark, folder).select(*CANDLE_KEY, sc.signal_name(up).alias("signal"))


@query("p19_time_text", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS line,
  strftime(ts, '%Y-%m-%d') AS day FROM events""")
def time_text(spark, folder):
    ts = F.col("ts")
    return tb.event_ticks(spark, folder).select(
        F.col("seq").alias("event_id"), sc.iso_time(ts).alias("iso"), sc.line_time(ts).alias("line"),
        sc.day_text(ts).alias("day"))


@query("p20_text_to_epoch_ms", "SELECT event_id, epoch_ms(date_trunc('second', ts)::TIMESTAMP) AS ms FROM events")
def text_to_epoch_ms(spark, folder):
    return tb.event_ticks(spark, folder).select(
        F.col("seq").alias("event_id"), sc.to_epoch_ms(sc.line_time(F.col("ts"))).alias("ms"))


@query("p21_validity_split", f"""{BASE} SELECT CASE WHEN hour(open_time) = 3 THEN 'k missing' WHEN hour(open_time) = 5
  THEN 'bad number' ELSE 'valid' END AS outcome, count(*) AS n FROM candles GROUP BY ALL""")
def validity_split(spark, folder):
    decoded = materialise(ms.decode_messages(broken_messages(spark, folder)), "decoded")
    why = F.when(F.get_json_object("raw", "$.k").isNull(), "k missing").otherwise("bad number")
    return (
        ms.accepted(decoded).select(F.lit("valid").alias("outcome"))
        .unionByName(ms.quarantined(decoded).select(why.alias("outcome")))
        .groupBy("outcome").agg(F.count("*").alias("n"))
    )


@query("p22_clip_at_zero", f"""{BASE}, r AS (SELECT *, close - lag(close) OVER ({W}) AS delta FROM candles)
  SELECT {KEY_SQL}, round(CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END, 6) AS gain,
  round(CASE WHEN delta IS NOT NULL THEN -least(delta, 0) END, 6) AS loss FROM r""")
def clip_at_zero(spark, folder):
    def both(df, w):
        steps = df.withColumn("delta", ind.difference(F.col("close"), w))
        return steps.select(*df.columns, ind.clip_below(F.col("delta")).alias("gain"),
                            (-ind.clip_above(F.col("delta"))).alias("loss"))

    return over_series(tb.stored_event_candles(spark, folder), both, back=1).select(*CANDLE_KEY, "gain", "loss")


@query("p23_derived_names", f"""{GRID} SELECT DISTINCT symbol || '_' || "interval" AS name,
  symbol || '_' || "interval" || '.csv' AS csv, symbol, "interval" FROM grid""")
def derived_names(spark, folder):
    names = tb.stored_candle_grid(spark, folder).select("symbol", "interval").distinct().select(
        sc.series_name(F.col("symbol"), F.col("interval")).alias("name"))
    files = names.select("name", F.concat("name", F.lit(".json")).alias("file"))
    return files.select(
        "name", sc.csv_name(F.col("file")).alias("csv"), sc.symbol_of_file(F.col("file")).alias("symbol"),
        sc.interval_of_file(F.col("file")).alias("interval"))


# -- joins and unions ----------------------------------------------------------------------------

@query("j1_fact_dimension", f"{BASE}, {DIMS} SELECT symbol, symbol_id, open_time, {PRICES_SQL} FROM candles JOIN dim_symbol USING (symbol)")
def fact_dimension(spark, folder):
    klines, symbols, _ = fact_tables(spark, folder)
    return serving.with_symbol(klines, symbols).select("symbol", "symbol_id", "open_time", *PRICES)


@query("j1_lineitem_dimensions", """SELECT n_name, p_brand, count(*) AS n, round(sum(l_quantity), 4) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""", digits=4)
def lineitem_dimensions(spark, folder):
    """The same star join on the large fact table.

    Facts are summed per pair of foreign keys first, so a hot part or supplier is one row per task
    before any join shuffles it.
    """
    fact = (
        tb.read_table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    )
    part = tb.read_table(spark, folder, "part").select("p_partkey", "p_brand")
    supplier = tb.read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nation = tb.read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        fact.join(part, fact.l_partkey == part.p_partkey)
        .join(supplier, fact.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .groupBy("n_name", "p_brand")
        .agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))
    )


@query("j2_lookup_with_rejects", f"""{GRID} SELECT symbol, "interval", CASE WHEN symbol = 'ERROR' THEN 'unknown symbol'
  WHEN "interval" = '1d' THEN 'unknown interval' ELSE 'found' END AS outcome, count(*) AS n FROM grid GROUP BY ALL""")
def lookup_with_rejects(spark, folder):
    grid = tb.stored_candle_grid(spark, folder)
    symbols, intervals = store.build_dimensions(spark, grid)
    found, rejected = store.resolve_ids(
        grid, symbols.where("symbol <> 'ERROR'"), intervals.where("interval_name <> '1d'"))
    return (
        found.select("symbol", "interval", F.lit("found").alias("outcome"))
        .unionByName(rejected.select("symbol", "interval", F.col("reason").alias("outcome")))
        .groupBy("symbol", "interval", "outcome").agg(F.count("*").alias("n"))
    )


@query("j3_not_yet_stored", f"{BASE} SELECT {CANDLE_SQL} FROM candles WHERE hour(open_time) % 2 = 1")
def not_yet_stored(spark, folder):
    """All of a batch against a stored table of the even hours."""
    batch = tb.stored_event_candles(spark, folder)
    stored = tb.stored_candle_table(spark, folder).where("hour(open_time) % 2 = 0")
    return store.not_yet_stored(batch, stored).select(*CANDLE.names)


@query("j3_not_yet_stored_last", f"""{BASE}, stored AS (SELECT symbol, close_time FROM candles WHERE hour(open_time) % 2 = 0
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY close_time DESC) <= 240),
  batch AS (SELECT * FROM candles QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY close_time DESC) <= 240)
  SELECT {CANDLE_SQL} FROM batch ANTI JOIN stored USING (symbol, close_time)""")
def not_yet_stored_last(spark, folder):
    """The 240-candle rule on request."""
    candles = tb.stored_event_candles(spark, folder)
    return store.not_yet_stored(candles, candles.where("hour(open_time) % 2 = 0"), last=240).select(*CANDLE.names)


@query("j4_dimension_product", _WORK)
def dimension_product(spark, folder):
    grid = tb.stored_candle_grid(spark, folder)
    return store.work_list(
        grid.select("symbol").distinct(), store.interval_rows(grid))


@query("u1_history_and_stream", f"""{BASE} SELECT symbol, round(close, 6) AS price, round(volume, 6) AS quantity, open_time
  AS "timestamp" FROM candles UNION ALL SELECT symbol, round(close, 6), round(volume, 6),
  date_trunc('second', close_time)::TIMESTAMP FROM candles WHERE hour(open_time) >= 12""")
def history_and_stream(spark, folder):
    candles = tb.stored_event_candles(spark, folder)
    live = candles.where("hour(open_time) >= 12").select(
        F.lower("symbol").alias("symbol"), *PRICES, sc.line_time(F.col("close_time")).alias("timestamp"))
    return clean.union_ticks(clean.history_as_ticks(candles), clean.stream_as_ticks(live))


# -- serving -------------------------------------------------------------------------------------

@query("o1_historical", f"""{BASE} SELECT symbol, open_time, close_time, {PRICES_SQL} FROM candles
  WHERE symbol = 'CLICK' ORDER BY open_time DESC LIMIT 10""")
def historical(spark, folder):
    klines, symbols, intervals = fact_tables(spark, folder)
    return serving.historical(klines, symbols, intervals, "CLICK", "1h", 10)


@query("o1_status", f"""{BASE}, asked(symbol, "interval") AS (VALUES ('CLICK', '1h'), ('CLICK', '1d'), ('NOPE', '1h'), ('VIEW', '1h'))
  SELECT symbol, "interval", CASE WHEN symbol NOT IN (SELECT symbol FROM candles) THEN 'unknown symbol'
    WHEN "interval" NOT IN (SELECT "interval" FROM candles) THEN 'unknown interval' WHEN symbol = 'VIEW' THEN 'no data' ELSE 'ok' END AS status
  FROM asked""")
def historical_status(spark, folder):
    """Answers for names that are not there and for a series whose candles are missing."""
    klines, symbols, intervals = fact_tables(spark, folder)
    view = symbols.where("symbol = 'VIEW'").select("symbol_id")
    rows = klines.join(view, on="symbol_id", how="left_anti")
    asked = [("CLICK", "1h"), ("CLICK", "1d"), ("NOPE", "1h"), ("VIEW", "1h")]
    answers = [serving.series_status(rows, symbols, intervals, *names) for names in asked]
    return answers[0].unionByName(answers[1]).unionByName(answers[2]).unionByName(answers[3])


@query("o2_latest", f"""{BASE}, {REVISED}, every AS (SELECT * FROM first_load UNION ALL SELECT * FROM second_load)
  SELECT {CANDLE_SQL}, load_seq FROM every
  QUALIFY row_number() OVER (PARTITION BY symbol, "interval" ORDER BY close_time DESC, load_seq DESC) = 1""")
def latest(spark, folder):
    first, second = revised(tb.stored_candle_table(spark, folder))
    both = materialise(first.unionByName(second), "documents", partition_by=[*SERIES, "month"])
    return serving.latest(both).select(*CANDLE.names, "load_seq")


@query("o2_latest_per_interval", f"""{GRID} SELECT {CANDLE_SQL} FROM grid
  QUALIFY row_number() OVER (PARTITION BY symbol, "interval" ORDER BY close_time DESC) = 1""")
def latest_per_interval(spark, folder):
    """Candles of several intervals end at the same time; each interval has its own newest one."""
    grid = materialise(tb.stored_candle_grid(spark, folder).withColumn("load_seq", F.lit(1)), "grid")
    return serving.latest(grid).select(*CANDLE.names)


@query("o3_recent_window", f"""{BASE}, {CLOSED} SELECT {CANDLE_SQL}, closed FROM docs WHERE closed
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY close_time DESC) <= 60""")
def recent_window(spark, folder):
    """The store takes closed candles only and is laid out by month."""
    closed = documents(tb.stored_candle_table(spark, folder)).where("closed")
    stored = materialise(closed, "documents", partition_by=[*SERIES, "month"])
    return serving.recent_window(stored, all_closed=True).drop("month")


@query("o4_ordered_scan", f"{BASE} SELECT {CANDLE_SQL} FROM candles ORDER BY close_time, symbol")
def ordered_scan(spark, folder):
    return serving.ordered(tb.event_candles(spark, folder), "close_time", "symbol")


@query("o5_head_tail", f"""{BASE} SELECT 'head' AS part, * FROM (SELECT {CANDLE_SQL} FROM candles
  ORDER BY open_time, symbol LIMIT 5) UNION ALL SELECT 'tail', * FROM (SELECT {CANDLE_SQL} FROM candles
  ORDER BY open_time DESC, symbol DESC LIMIT 5)""")
def head_tail(spark, folder):
    candles = tb.stored_event_candles(spark, folder)
    first = serving.head(candles).select(F.lit("head").alias("part"), "*")
    return first.unionByName(serving.tail(candles).select(F.lit("tail").alias("part"), "*"))


@query("o6_dashboard", f"""{BASE} SELECT symbol, open_time, close_time, {PRICES_SQL}, round((high + low) / 2, 6) AS mid_price
  FROM candles WHERE symbol = 'VIEW' ORDER BY open_time DESC LIMIT 100""")
def dashboard(spark, folder):
    klines, symbols, intervals = fact_tables(spark, folder)
    return serving.dashboard(klines, symbols, intervals, "VIEW", "1h", 100)


@query("o7_close_series", f"{BASE} SELECT symbol, close_time, {rounded('close')} FROM candles ORDER BY symbol, close_time")
def close_series(spark, folder):
    return serving.close_series(tb.event_candles(spark, folder))
