"""Streaming jobs agree with the batch operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kandela.operators import store
from kandela.operators.candles import roll_up_candles
from kandela.plans.stream_queries import land
from kandela.schemas import CANDLE
from kandela.session import scratch_path
from kandela.sources.messages import encode_messages
from kandela.streaming import jobs


@pytest.fixture
def paths(spark):
    return lambda: (scratch_path(spark, "landing"), scratch_path(spark, "out"), scratch_path(spark, "progress"))


def closed(df):
    return df.withColumn("closed", F.lit(True))


def run(spark, start, landing, out, progress, **options):
    start(jobs.message_stream(spark, landing), out=out, checkpoint=progress, **options).awaitTermination()


def test_ingest_takes_closed_candles_only(spark, candles, paths):
    landing, out, progress = paths()
    land(closed(candles([1.0, 2.0, 3.0])), landing)
    run(spark, jobs.start_ingest, landing, out, progress)
    run(spark, jobs.start_ingest, landing, out, progress)  # restart: nothing is read twice
    assert sorted(r.close for r in spark.read.parquet(out).collect()) == [1.0, 2.0, 3.0]


def test_unreadable_messages_are_quarantined(spark, candles, paths):
    landing, out, progress = paths()
    encode_messages(closed(candles([1.0, 2.0]))).write.mode("append").text(landing)
    spark.createDataFrame([("{}",), ("oops",)], "value string").write.mode("append").text(landing)
    jobs.start_quarantine(jobs.decoded_stream(spark, landing, 1), out, progress).awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["oops", "{}"]


def test_dedup_inside_and_across_batches(spark, candles, paths):
    landing, out, progress = paths()
    first = closed(candles([float(i) for i in range(6)]))
    for frame in (first, first):
        encode_messages(frame).write.mode("append").text(landing)
    run(spark, jobs.start_dedup_ingest, landing, out, progress)
    later = closed(candles([float(i) for i in range(10)], skip={0, 1, 2}))
    encode_messages(later).write.mode("append").text(landing)
    run(spark, jobs.start_dedup_ingest, landing, out, progress)
    assert sorted(r.close for r in spark.read.parquet(out).collect()) == [float(i) for i in range(10)]


def test_late_rows_are_kept_and_repair_the_table(spark, candles, paths):
    """Ingest plus the upsert of the late folder equals the batch, also for a symbol that lags all others."""
    landing, out, progress = paths()
    late_out, late_progress, table = scratch_path(spark, "late"), scratch_path(spark, "progress"), scratch_path(spark, "table")
    every = candles([float(i) for i in range(60)]).unionByName(candles([float(100 + i) for i in range(20)], "LAGUSDT"))
    parts = [every.where("symbol = 'AAAUSDT' AND volume NOT IN (2, 40)"), every.where("symbol = 'LAGUSDT'"), every.where("volume IN (2, 40, 59)")]
    for part in parts:
        encode_messages(closed(part)).write.mode("append").text(landing)
        run(spark, jobs.start_dedup_ingest, landing, out, progress)
        run(spark, jobs.start_late_rows, landing, late_out, late_progress)
    first = spark.read.schema(CANDLE).parquet(out).withColumn("load_seq", F.lit(1))
    assert first.count() < 80
    store.write_candles(first, table)
    late = jobs.read_late(spark, late_out)
    for _ in range(2):
        jobs.repair_candles(table, late, load_seq=2)
        got = store.read_candles(spark, table, first.schema).select(*CANDLE.names)
        assert sorted(got.collect()) == sorted(every.collect())
    hourly = store.read_candles(spark, table, first.schema)
    repaired = jobs.repaired_windows(hourly, late, "1d", "1h")
    whole = {(r.symbol, r.open_time): r for r in roll_up_candles(every, "1d", "1h").collect()}
    assert repaired.count() > 0 and all(whole[r.symbol, r.open_time] == r for r in repaired.collect())


def test_store_dedup_loses_nothing_of_a_long_backlog(spark, candles, paths):
    landing, out, progress = paths()
    rows = candles([float(i) for i in range(900)])
    for part in (rows.where("volume >= 300"), rows.where("volume < 350"), rows):
        encode_messages(closed(part)).write.mode("append").text(landing)
        run(spark, jobs.start_store_dedup, landing, out, progress)
    assert sorted(r.close for r in spark.read.parquet(f"{out}/rows").collect()) == [float(i) for i in range(900)]


def test_tail_dedup_keeps_the_newest(spark, candles, paths):
    landing, out, progress = paths()
    encode_messages(closed(candles([float(i) for i in range(8)]))).write.mode("append").text(landing)
    run(spark, jobs.start_tail_dedup, landing, out, progress, last=5)
    encode_messages(closed(candles([float(i) for i in range(10)]))).write.mode("append").text(landing)
    run(spark, jobs.start_tail_dedup, landing, out, progress, last=5)
    assert sorted(r.close for r in spark.read.parquet(f"{out}/rows").collect()) == [3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]


@pytest.mark.parametrize("interval", ["1d", "1w"])
def test_streamed_roll_up_equals_batch_for_closed_windows(spark, candles, paths, interval):
    landing, out, progress = paths()
    rows = candles([float((i * 31) % 17) for i in range(24 * 17)], start=datetime(2024, 1, 3))
    for _ in range(2):
        encode_messages(closed(rows)).write.mode("append").text(landing)
    run(spark, jobs.start_roll_up, landing, out, progress, interval=interval, source="1h")
    got = spark.read.schema(CANDLE).parquet(out).orderBy("open_time").collect()
    want = roll_up_candles(rows, interval, "1h").orderBy("open_time").collect()
    assert 0 < len(got) < len(want) and got == want[: len(got)]
    if interval == "1w":
        assert {r.open_time.weekday() for r in got} == {0}


def test_latest_view_follows_the_stream(spark, candles, paths):
    landing, out, progress = paths()
    encode_messages(closed(candles([1.0, 2.0]))).write.mode("append").text(landing)
    run(spark, jobs.start_latest, landing, out, progress)
    encode_messages(closed(candles([7.0, 8.0, 9.0], "BBBUSDT").unionByName(candles([1.0, 2.0, 3.0])))).write.mode("append").text(landing)
    run(spark, jobs.start_latest, landing, out, progress)
    assert {r.symbol: r.close for r in jobs.read_latest(spark, out).collect()} == {"AAAUSDT": 3.0, "BBBUSDT": 9.0}


def test_streamed_roll_up_reads_one_interval(spark, candles, paths):
    landing, out, progress = paths()
    one, five = candles([1.0] * 600, interval="1m"), candles([1.0] * 120, interval="5m")
    encode_messages(closed(one.withColumn("volume", F.lit(1.0)).unionByName(five.withColumn("volume", F.lit(5.0))))).write.mode("append").text(landing)
    run(spark, jobs.start_roll_up, landing, out, progress, interval="1h", source="1m")
    assert {r.volume for r in spark.read.schema(CANDLE).parquet(out).collect()} == {60.0}
    with pytest.raises(ValueError):
        jobs.rolled_up(jobs.message_stream(spark, landing), "1h", "1d")


def test_latest_view_keeps_intervals_apart(spark, candles, paths):
    landing, out, progress = paths()
    encode_messages(closed(candles([float(i) for i in range(24)]).unionByName(candles([99.0], interval="1d")))).write.mode("append").text(landing)
    run(spark, jobs.start_latest, landing, out, progress)
    assert {(r.interval, r.close) for r in jobs.read_latest(spark, out).collect()} == {("1h", 23.0), ("1d", 99.0)}


def test_a_corrected_candle_replaces_the_scored_one(spark, candles, paths):
    landing, out, progress = paths()
    walk = [100.0 + (i * 7 % 13) for i in range(70)]
    score = lambda rows: rows.select("symbol", "close", "MA_10")
    encode_messages(closed(candles(walk))).write.mode("append").text(landing)
    run(spark, jobs.start_scoring, landing, out, progress, score=score)
    for value in (500.0, 50.0):
        encode_messages(closed(candles(walk[:69] + [value], skip=set(range(69))))).write.mode("append").text(landing)
        run(spark, jobs.start_scoring, landing, out, progress, score=score)
    rows = spark.read.parquet(f"{out}/predictions").orderBy("batch").collect()
    assert [r.close for r in rows] == [walk[69], 500.0, 50.0]
    assert rows[2].MA_10 == pytest.approx((sum(walk[60:69]) + 50.0) / 10)


def test_scoring_sees_one_row_per_touched_series(spark, candles, paths):
    landing, out, progress = paths()
    walk = [100.0 + (i * 7 % 13) for i in range(80)]
    both = candles(walk[:70], "AAAUSDT").unionByName(candles(walk[:70], "BBBUSDT")).unionByName(candles(walk[:20], "CCCUSDT"))
    encode_messages(closed(both)).write.mode("append").text(landing)
    score = lambda rows: rows.select("symbol", "open_time", "MA_50")
    run(spark, jobs.start_scoring, landing, out, progress, score=score)
    encode_messages(closed(candles(walk[:71], "AAAUSDT", skip=set(range(70))))).write.mode("append").text(landing)
    run(spark, jobs.start_scoring, landing, out, progress, score=score)
    rows = spark.read.parquet(f"{out}/predictions").orderBy("batch", "symbol").collect()
    assert [(r.batch, r.symbol) for r in rows] == [(0, "AAAUSDT"), (0, "BBBUSDT"), (1, "AAAUSDT")]
    assert rows[2].MA_50 == pytest.approx(sum(walk[21:71]) / 50)
