"""Roll-up, decoding, stores, dimensions and scalars."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kandela.functions import scalars as sc
from kandela.operators import calendar, candles as cd, clean, serving, store
from kandela.schemas import CANDLE, DIM_SYMBOL, GRAIN_PRICES, conform
from kandela.session import scratch_path, shared_folder
from kandela.sources import csv_candles, klines as kl, messages as ms, tables as tb

TICK_DDL = "symbol string, ts timestamp, seq long, price double, quantity double"


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICK_DDL)


def test_first_and_last_price_break_ties_by_sequence(spark):
    at = datetime(2024, 1, 1, 10, 5)
    rows = [("A", at, 3, 30.0, 1.0), ("A", at, 1, 10.0, 1.0), ("A", at, 2, 99.0, 1.0)]
    c = cd.roll_up_ticks(ticks(spark, rows), "1h").first()
    assert (c.open, c.high, c.low, c.close, c.volume) == (10.0, 99.0, 10.0, 30.0, 3.0)
    assert c.open_time == datetime(2024, 1, 1, 10) and c.close_time == datetime(2024, 1, 1, 10, 59, 59, 999000)


def test_weeks_start_on_monday(spark):
    rows = [("A", datetime(2017, 11, 8, 3), 1, 1.5, 1.0), ("A", datetime(2017, 11, 12, 23), 2, 1.6, 1.0)]
    c = cd.roll_up_ticks(ticks(spark, rows), "1w").collect()
    assert len(c) == 1 and c[0].open_time == datetime(2017, 11, 6)
    assert c[0].close_time == datetime(2017, 11, 12, 23, 59, 59, 999000)


def test_roll_up_of_roll_up_and_invariants(spark):
    rows = [("A", datetime(2024, 1, 1 + i // 600, (i // 25) % 24, i % 60), i, float((i * 37) % 101), 1.0)
            for i in range(1200)]
    source = ticks(spark, rows)
    quarter = cd.roll_up_ticks(source, "15m")
    for grain in ("1h", "1d", "1w", "1M", "1y"):
        direct = cd.roll_up_ticks(source, grain).orderBy("open_time").collect()
        assert cd.roll_up_ticks(source, grain, unique_times=True).orderBy("open_time").collect() == direct
        assert cd.roll_up_candles(quarter, grain, "15m").orderBy("open_time").collect() == direct
        assert all(r.low <= r.open <= r.high and r.low <= r.close <= r.high for r in direct)


def test_candle_geometry(spark, candles):
    rows = candles([5.0]).withColumn("open", F.lit(4.5)).withColumn("high", F.lit(7.0)).withColumn("low", F.lit(4.0))
    g = cd.with_mid_price(cd.with_geometry(cd.with_direction(rows))).first()
    assert (g.direction, g.body, g.upper_wick, g.lower_wick, g.mid_price) == ("up", 0.5, 2.0, 0.5, 5.5)


def test_kline_payload_numbers_and_strings(spark):
    page = [[1700000000000, "1.5", "2", "1", "1.75", "10", 1700003599999, "0", 7, "0", "0", "0"],
            [1700003600000, "x", "2", "1", "1.75", "NaN", 1700007199999, "0", 7, "0", "0", "0"],
            [1700007200000, "1"]]
    got = kl.decode_klines(spark.createDataFrame([(json.dumps(page),)], "value string")).orderBy("open_time").collect()
    assert got[0].open == 1.5 and got[0].open_time == datetime(2023, 11, 14, 22, 13, 20)
    assert got[1].open is None and got[1].volume is None
    assert got[2].close_time is None


def test_kline_files_by_name(spark, tmp_path):
    page = [[1700000000000, "1.5", "2", "1", "1.75", "10", 1700003599999, "0", 7, "0", "0", "0"]]
    (tmp_path / "BTCUSDT_1h.json").write_text(json.dumps(page))
    (tmp_path / "ethusdt_15m.json").write_text(json.dumps(page, indent=1))
    whole = kl.read_kline_files(spark, str(tmp_path), whole_file=True).orderBy("symbol").collect()
    assert [(r.symbol, r.interval, r.close) for r in whole] == [("BTCUSDT", "1h", 1.75), ("ETHUSDT", "15m", 1.75)]
    lines = kl.read_kline_files(spark, str(tmp_path / "BTCUSDT_1h.json")).collect()
    assert [(r.symbol, r.interval) for r in lines] == [("BTCUSDT", "1h")]


def test_csv_with_date_only_times(spark, tmp_path):
    (tmp_path / "BNBUSDT_1w.csv").write_text(
        "open_time,open,high,low,close,volume,close_time\n"
        "2017-11-06,1.5,2.2,0.5,1.49,2089729.52,2017-11-12 23:59:59.999\n"
        "2017-11-13,oops,1.7,1.49,1.6,1610933.24,2017-11-19 23:59:59.999\n")
    rows = csv_candles.read_candle_csv(spark, str(tmp_path)).orderBy("open_time").collect()
    assert rows[0].open_time == datetime(2017, 11, 6) and rows[0].close_time.microsecond == 999000
    assert (rows[0].symbol, rows[0].interval) == ("BNBUSDT", "1w")
    assert rows[1].open is None and rows[1].close == 1.6


def message(**k):
    base = {"s": "BtcUsdt", "o": "1", "h": "2", "l": "0.5", "c": "1.5", "v": "3", "t": 1700000000000,
            "T": 1700000059999, "x": True}
    base.update(k)
    return json.dumps({"k": {key: v for key, v in base.items() if v is not None}})


def test_messages_accept_and_quarantine(spark):
    raw = [message(), message(x=False), message(o="abc"), message(c=None), "{}", "no json", message(T="x")]
    decoded = ms.decode_messages(spark.createDataFrame([(r,) for r in raw], "value string"))
    good = ms.accepted(decoded).collect()
    assert len(good) == 2 and {r.symbol for r in good} == {"BTCUSDT"} and good[0].interval == "1m"
    assert good[0].open_time != good[0].close_time
    assert sorted(r.raw for r in ms.quarantined(decoded).collect()) == sorted(raw[2:])


def test_split_valid(spark, candles):
    rows = candles([1.0, 2.0]).withColumn("close", F.when(F.col("volume") == 1, F.lit(None)).otherwise(F.col("close")))
    valid, rejected = clean.split_valid(rows)
    assert valid.count() == 1 and rejected.count() == 1


def test_upsert_is_idempotent_and_last_write_wins(spark, candles):
    stored = candles([1.0, 2.0, 3.0]).withColumn("load_seq", F.lit(1))
    incoming = candles([9.0, 8.0, 7.0, 6.0], skip={0}).withColumn("load_seq", F.lit(2))
    copies = incoming
    for _ in range(4):
        copies = copies.unionByName(copies)
    once = store.upsert(stored, copies)
    twice = store.upsert(once, incoming)
    values = lambda df: [(r.open_time, r.close) for r in df.orderBy("open_time").collect()]
    assert [c for _, c in values(once)] == [1.0, 8.0, 7.0, 6.0]
    assert values(once) == values(twice)


def test_upsert_into_rewrites_touched_months_only(spark, candles):
    path = scratch_path(spark, "upsert")
    table = candles([float(i) for i in range(40)], interval="1d").withColumn("load_seq", F.lit(1))
    store.write_candles(table, path)
    before = {r.f for r in spark.read.parquet(path).where("month = '2024-01'").select(F.input_file_name().alias("f")).collect()}
    fresh = table.where("month(open_time) = 2").withColumn("close", F.col("close") + 100).withColumn("load_seq", F.lit(2))
    for _ in range(2):
        store.upsert_into(path, fresh)
        rows = store.read_candles(spark, path, table.schema).collect()
        assert len(rows) == 40 and sum(r.close >= 100 for r in rows) == 9
    after = {r.f for r in spark.read.parquet(path).where("month = '2024-01'").select(F.input_file_name().alias("f")).collect()}
    assert before == after


def test_insert_if_absent_keeps_ids(spark):
    empty = spark.createDataFrame([], DIM_SYMBOL)
    names = lambda *s: spark.createDataFrame([(x, x[:-4], x[-4:]) for x in s], "symbol string, base_asset string, quote_asset string")
    first = store.insert_if_absent(empty, names("ETHUSDT", "BTCUSDT", "BTCUSDT"), "symbol", "symbol_id")
    second = store.insert_if_absent(first, names("ETHUSDT", "AAAUSDT", "ZZZUSDT"), "symbol", "symbol_id")
    assert {r.symbol: r.symbol_id for r in second.collect()} == {"BTCUSDT": 1, "ETHUSDT": 2, "AAAUSDT": 3, "ZZZUSDT": 4}
    again = store.insert_if_absent(second, names("ETHUSDT"), "symbol", "symbol_id")
    assert again.count() == 4


def test_lookup_rejects_unknown_names(spark, candles):
    rows = candles([1.0], "AAAUSDT").unionByName(candles([1.0], "NEWUSDT")).unionByName(candles([1.0], "AAAUSDT", "1d"))
    symbols = spark.createDataFrame([(7, "AAAUSDT", "AAA", "USDT")], DIM_SYMBOL)
    intervals = spark.createDataFrame([(2, "1h", 3600)], "interval_id int, interval_name string, seconds int")
    found, rejected = store.resolve_ids(rows, symbols, intervals)
    assert [(r.symbol_id, r.interval_id) for r in found.collect()] == [(7, 2)]
    assert {(r.symbol, r.reason) for r in rejected.collect()} == {
        ("NEWUSDT", "unknown symbol"), ("AAAUSDT", "unknown interval")}
    klines = store.as_klines(found)
    assert klines.first().created_at is not None
    assert serving.historical(klines, symbols, intervals, "NOPE", "1h").count() == 0
    assert serving.historical(klines, symbols, intervals, "AAAUSDT", "1d").count() == 0
    assert serving.historical(klines, symbols, intervals, "AAAUSDT", "1h").count() == 1
    assert store.is_loaded(klines) and not store.is_loaded(klines.where("false"))


def test_json_lines_append(spark, candles):
    path = scratch_path(spark, "lines")
    rows = candles([1.0, 2.0]).select("symbol", "close", F.col("close_time").alias("timestamp"))
    store.append_json_lines(rows, path)
    store.append_json_lines(rows, path)
    text = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(text) == 4 and text[0]["timestamp"].endswith(":59:59")


def test_contract_rounds_to_three_places(spark, candles):
    row = conform(candles([1.23456]).withColumn("date", F.to_date("open_time")), GRAIN_PRICES).first()
    assert str(row.close) == "1.235"


def test_ticks_from_history_and_stream(spark, candles):
    rows = candles([1.0, 2.0])
    live = rows.select(F.lower("symbol").alias("symbol"), "close", "volume", F.lit("2024-01-01 05:00:00").alias("timestamp"))
    both = clean.union_ticks(clean.history_as_ticks(rows), clean.stream_as_ticks(live))
    assert both.count() == 4 and {r.symbol for r in both.collect()} == {"AAAUSDT"}
    assert both.columns == ["symbol", "price", "quantity", "timestamp"]


def test_scalars(spark):
    row = spark.createDataFrame([("btcusdt", "1h", "2024-01-02 03:04:05", 3)], "s string, i string, t string, k int").select(
        sc.canonical_symbol(F.col("s")).alias("u"), sc.base_asset(F.col("s")).alias("b"), sc.quote_asset(F.col("s")).alias("q"),
        sc.interval_seconds(F.col("i")).alias("sec"), sc.interval_minutes(F.col("i")).alias("m"),
        sc.to_epoch_ms(F.col("t")).alias("ms"), sc.to_epoch_ms(F.col("s")).alias("bad"),
        sc.lookup(F.col("k"), {1: "a"}).alias("missing"),
        sc.symbol_of_file(F.lit("file:/x/BTC_1h.csv")).alias("f1"), sc.interval_of_file(F.lit("/x/name=BTC_1h/part-0.csv")).alias("f2"),
    ).first()
    assert row == ("BTCUSDT", "btc", "usdt", 3600, 60, 1704164645000, None, None, "BTC", "1h")


def test_backfill_slices_clip_the_last(spark):
    bounds = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1, 9, 30))], "start_time timestamp, end_time timestamp")
    got = calendar.backfill_slices(bounds, "4 HOURS").orderBy("slice_start").collect()
    assert [(r.slice_start.hour, r.slice_end.hour, r.slice_end.minute) for r in got] == [(0, 4, 0), (4, 8, 0), (8, 9, 30)]


def test_long_backfills_have_every_slice_once(spark):
    bounds = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 12, 31, 5))], "start_time timestamp, end_time timestamp")
    got = [r.slice_start for r in calendar.backfill_slices(bounds, "1 HOURS").orderBy("slice_start").collect()]
    assert len(got) == len(set(got)) == 365 * 24 + 5 and got[-1] == datetime(2024, 12, 31, 4)


def test_date_dimension(spark):
    bounds = spark.sql("SELECT DATE'2025-12-28' AS first_day, DATE'2026-01-01' AS last_day")
    days = calendar.date_dimension(bounds).orderBy("date").collect()
    assert [d.week for d in days] == [52, 1, 1, 1, 1]
    assert days[0].is_weekend and days[0].day_name == "Sunday" and not days[1].is_weekend


def test_head_tail_order(spark, candles):
    rows = candles([float(i) for i in range(8)])
    assert [r.close for r in serving.head(rows, 2).collect()] == [0.0, 1.0]
    assert [r.close for r in serving.tail(rows, 2).collect()] == [6.0, 7.0]


def test_roll_ups_hash_where_the_order_is_one_column(spark, candles):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    empty = ticks(spark, [])
    assert "SortAggregate" not in plan(cd.roll_up_candles(candles([1.0]), "1d", "1h"))
    for unique in (False, True):
        assert "SortAggregate" not in plan(cd.roll_up_ticks(empty, "1h", unique_times=unique))


def test_upsert_limits_copies_before_the_shuffle(spark, candles):
    rows = candles([1.0]).withColumn("load_seq", F.lit(1))
    plan = store.newest_version(rows)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]


def test_dimension_filters_prune_fact_folders(spark, candles):
    rows = candles([1.0, 2.0], "AAAUSDT").unionByName(candles([3.0], "BBBUSDT"))
    symbols, intervals = store.build_dimensions(spark, rows)
    klines = store.store_klines(store.as_klines(store.resolve_ids(rows, symbols, intervals)[0]))
    query = serving.historical(klines, symbols, intervals, "BBBUSDT", "1h")
    assert [r.close for r in query.collect()] == [3.0]
    assert "dynamicpruning" in query._jdf.queryExecution().executedPlan().toString()


def test_latest_prefers_time_then_load(spark, candles):
    rows = candles([float(i) for i in range(600)]).withColumn("load_seq", F.lit(1))
    again = rows.where("volume = 599").withColumn("close", F.lit(-1.0)).withColumn("load_seq", F.lit(2))
    older = rows.where("volume = 3").withColumn("load_seq", F.lit(9))
    daily = candles([7.0], "BBBUSDT", interval="1d").withColumn("load_seq", F.lit(1))
    got = serving.latest(rows.unionByName(again).unionByName(older).unionByName(daily)).collect()
    assert {(r.symbol, r.close) for r in got} == {("AAAUSDT", -1.0), ("BBBUSDT", 7.0)}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partition_pruning_and_pushdown(spark, candles):
    path = scratch_path(spark, "pruned")
    store.append_documents(candles([1.0], "AAAUSDT").unionByName(candles([2.0], "BBBUSDT")), path)
    plan = tb.scan_symbol(tb.read_stored(spark, path), "AAAUSDT").select("close")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "ReadSchema: struct<close:double>" in plan
    assert CANDLE.names[0] == "symbol"


@pytest.mark.parametrize("n", [1, 15])
def test_kline_round_trip(spark, candles, n):
    rows = candles([0.1 + i for i in range(n)])
    back = kl.decode_klines(kl.encode_klines(rows, 4)).select(*CANDLE.names)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_negative_sequence_numbers_keep_their_order(spark):
    at = datetime(2024, 1, 1, 10, 5)
    c = cd.roll_up_ticks(ticks(spark, [("A", at, -5, 1.0, 1.0), ("A", at, 2**62, 3.0, 1.0), ("A", at, -(2**62), 2.0, 1.0)]), "1h").first()
    assert (c.open, c.close) == (2.0, 3.0)


def test_mixed_intervals_count_once(spark, candles):
    """A symbol with 1m and 5m candles of the same two hours trades 60 per hour, not 120."""
    one, five = candles([1.0] * 120, interval="1m"), candles([1.0] * 24, interval="5m")
    both = one.withColumn("volume", F.lit(1.0)).unionByName(five.withColumn("volume", F.lit(5.0)))
    assert [r.volume for r in cd.roll_up_candles(both, "1h", "1m").collect()] == [60.0, 60.0]
    assert [r.volume for r in cd.roll_up_candles(both, "1h", "5m").collect()] == [60.0, 60.0]
    for source, target in (("1h", "1h"), ("1d", "1h"), ("1w", "1M"), ("7m", "1h")):
        with pytest.raises(ValueError):
            cd.roll_up_candles(both, target, source)


def test_latest_keeps_intervals_apart(spark, candles):
    """An hourly and a daily candle end at the same millisecond with the same load number."""
    hourly, daily = candles([float(i) for i in range(24)]), candles([99.0], interval="1d")
    got = serving.latest(hourly.unionByName(daily).withColumn("load_seq", F.lit(1))).collect()
    assert {(r.interval, r.close) for r in got} == {("1h", 23.0), ("1d", 99.0)}


def test_unknown_intervals_raise(spark, candles):
    from kandela.operators.series import last_rows

    odd = candles([1.0, 2.0]).withColumn("interval", F.lit("1s"))
    with pytest.raises(Exception, match="no grid is known for interval 1s"):
        last_rows(odd, 1).collect()


def test_newest_rows_read_the_newest_months_only(spark, candles):
    """Forty daily months; the last ten rows need one or two of them."""
    from kandela.operators.series import last_rows
    from kandela.session import materialise

    rows = candles([float(i) for i in range(1200)], interval="1d").unionByName(candles([float(i) for i in range(1190)], "BBBUSDT", "1d"))
    stored = materialise(rows.withColumn("month", F.date_format("open_time", "yyyy-MM")), "months", partition_by=["symbol", "interval", "month"])
    newest = last_rows(stored, 10)
    assert sorted(r.close for r in newest.where("symbol = 'AAAUSDT'").collect()) == [float(i) for i in range(1190, 1200)]
    assert newest.count() == 20
    plan = newest._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "ReadSchema" in line]
    assert any("month" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans)
    assert len(newest.inputFiles()) > 60 and files_read(spark, newest) <= 6


def files_read(spark, df):
    """Files the scans of ``df`` read when it runs, without those of its scalar subqueries."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = df.select("*")
        fresh.collect()
        nodes, total = [fresh._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
            if node.metrics().contains("numFiles"):
                total += node.metrics().apply("numFiles").value()
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_historical_reads_the_newest_months_only(spark, candles):
    rows = candles([float(i) for i in range(400)], interval="1d")
    symbols, intervals = store.build_dimensions(spark, rows)
    klines = store.store_klines(store.as_klines(store.resolve_ids(rows, symbols, intervals)[0]))
    found = serving.historical(klines, symbols, intervals, "AAAUSDT", "1d", 10)
    assert [r.close for r in found.collect()] == [float(i) for i in range(399, 389, -1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("month" in part.split("]")[0] for part in plan.split("PartitionFilters:")[1:])
    assert len(klines.inputFiles()) >= 13 and files_read(spark, found) <= 5


def test_load_is_repeatable_and_touches_its_folders_only(spark, candles):
    root, rows = scratch_path(spark, "base"), candles([float(i) for i in range(90)], interval="1d")
    bad = rows.where("volume < 2").withColumn("interval", F.lit("2d")).unionByName(rows.where("volume < 3").withColumn("close", F.lit(None).cast("double")))
    rejected = store.load_candles(root, rows.unionByName(rows.where("volume < 7")).unionByName(bad))
    assert {(r.reason, r["count"]) for r in rejected.groupBy("reason").count().collect()} == {("unknown interval", 2), ("missing field", 3)}
    table = lambda: store.read_klines(spark, f"{root}/klines")
    files = lambda month: {r.f for r in table().where(F.col("month") == month).select(F.input_file_name().alias("f")).collect()}
    first, january = table().orderBy("klines_id").collect(), files("2024-01")
    assert [r.klines_id for r in first] == list(range(1, 91)) and [r.close for r in first] == [float(i) for i in range(90)]
    march = rows.where("month(open_time) = 3")
    store.load_candles(root, march)
    assert table().orderBy("klines_id").collect() == first and files("2024-01") == january
    store.load_candles(root, march.withColumn("close", F.lit(7.0)).unionByName(candles([1.0], "NEWUSDT", "1d")))
    after = table().orderBy("klines_id").collect()
    assert [r.klines_id for r in after] == list(range(1, 92)) and sum(r.close == 7.0 for r in after) == 31
    assert [r.created_at for r in after[:90]] == [r.created_at for r in first]
    symbols = spark.read.parquet(f"{root}/symbol")
    assert {r.symbol: r.symbol_id for r in symbols.collect()} == {"AAAUSDT": 1, "NEWUSDT": 2}
    report = store.constraint_report(table(), symbols, spark.read.parquet(f"{root}/intervals"))
    assert report.count() == 11 and {r.violations for r in report.collect()} == {0}


def test_constraint_report_counts_violations(spark, candles):
    rows = candles([1.0, 2.0])
    symbols, intervals = store.build_dimensions(spark, rows)
    klines = store.as_klines(store.resolve_ids(rows, symbols, intervals)[0])
    broken = klines.unionByName(klines.where("close = 1.0")).withColumn("close", F.when(F.col("close") == 2.0, None).otherwise(F.col("close")))
    found = {(r.table, r.constraint): r.violations for r in store.constraint_report(broken, symbols.where("false"), intervals).collect()}
    assert found["klines", "primary key klines_id"] == 1 and found["klines", "not null"] == 1
    assert found["klines", "foreign key symbol_id"] == 3 and found["klines", "foreign key interval_id"] == 0


def test_names_with_one_prefix_are_numbered_in_order(spark):
    from kandela.operators.series import number_in_order

    names = [f"XXXXX{i:05d}" for i in range(3000)]
    rows = spark.createDataFrame([(n,) for n in reversed(names)], "symbol string").repartition(5)
    assert [r.symbol for r in number_in_order(rows, ["symbol"]).orderBy("rn").collect()] == names
    ranges = number_in_order(rows, ["symbol"])
    assert ranges.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (1, 3000, 3000)


def test_work_list_raises_beyond_its_limit(spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    intervals = spark.createDataFrame([(f"{i}m", i) for i in range(5)], "interval_name string, seconds int")
    assert store.work_list(symbols, intervals).count() == 5
    with pytest.raises(Exception, match="more than 4 intervals"):
        store.work_list(symbols, intervals, most_intervals=4).collect()


def test_not_yet_stored_keeps_the_whole_backlog(spark, candles):
    stored = candles([float(i) for i in range(700)]).where("volume % 2 = 0").withColumn("month", F.date_format("open_time", "yyyy-MM"))
    batch = candles([float(i) for i in range(700)])
    fresh = store.not_yet_stored(batch.unionByName(batch), stored)
    assert sorted(r.volume for r in fresh.collect()) == [float(i) for i in range(1, 700, 2)]
    assert store.not_yet_stored(batch, stored.drop("month"), last=240).count() < 350


def test_jdbc_reads_must_be_partitioned(spark):
    with pytest.raises(ValueError, match="numPartitions"):
        tb.read_jdbc(spark, "jdbc:none", "klines", partitionColumn="id", lowerBound="0", upperBound="1")


def test_a_late_row_opens_its_month_and_no_month_between(spark, candles, tmp_path):
    """Forty months are stored; a batch holds one new row of the second month and one of the last."""
    path = str(tmp_path / "candles")
    daily = candles(range(1200), interval="1d", start=datetime(2020, 1, 1)).withColumn("load_seq", F.lit(0))
    store.write_candles(daily, path)
    stored = store.read_candles(spark, path, daily.schema)
    months = stored.select("month").distinct().count()
    late = daily.where("open_time = '2020-02-10' OR open_time = '2023-04-02'")
    moved = late.withColumn("close_time", F.col("close_time") + F.expr("INTERVAL 1 SECOND"))
    fresh = store.not_yet_stored(moved, stored)
    assert fresh.count() == 2 and store.not_yet_stored(late, stored).count() == 0
    assert months == 40 and files_read(spark, fresh) == 2

    store.upsert_into(path, late.withColumn("close", F.lit(-1.0)).withColumn("load_seq", F.lit(1)))
    now = store.read_candles(spark, path, daily.schema)
    assert now.count() == 1200 and now.where("close = -1").count() == 2
