"""Registered streaming queries (T): drain landed messages, return the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from kandela.operators import logistic, ml, store
from kandela.operators.features import features_per_split
from kandela.plans.registry import BASE, CANDLE_SQL, TICKS, candles_sql, label_sql, query
from kandela.plans.table_queries import CLOSED, broken_messages, documents
from kandela.schemas import CANDLE, conform
from kandela.session import materialise, scratch_path
from kandela.sources import messages as ms, tables as tb
from kandela.streaming import jobs


def land(docs, path: str) -> None:
    """Write candles as message files, each closed one after an early update that is still open."""
    early = docs.where("closed").select(
        "symbol", "interval", "open_time", *[F.col("open").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(0.0).alias("volume"), "close_time", F.lit(False).alias("closed"))
    ms.encode_messages(docs.unionByName(early)).write.mode("append").text(path)


def drain(spark, start, landed, **options):
    """Run a streaming job over everything landed; returns its output folder."""
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    start(jobs.message_stream(spark, landed), out=out, checkpoint=checkpoint, **options).awaitTermination()
    return out


def _landed(spark, folder, interval="1h", times=1):
    path = scratch_path(spark, "landing")
    docs = materialise(documents(tb.stored_event_candles(spark, folder, interval)), "documents")
    for _ in range(times):
        land(docs, path)
    return path


@query("t1_closed_ingest", f"{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed")
def closed_ingest(spark, folder):
    out = drain(spark, jobs.start_ingest, _landed(spark, folder))
    return tb.read_stored(spark, out)


@query("t1_quarantine", f"""{BASE} SELECT CASE WHEN hour(open_time) = 3 THEN 'k missing' ELSE 'bad number' END AS outcome,
  count(*) AS n FROM candles WHERE hour(open_time) IN (3, 5) GROUP BY ALL""")
def quarantine(spark, folder):
    landed, out = scratch_path(spark, "landing"), scratch_path(spark, "quarantine")
    broken_messages(spark, folder).write.text(landed)
    jobs.start_quarantine(
        jobs.decoded_stream(spark, landed), out, scratch_path(spark, "progress")).awaitTermination()
    why = F.when(F.get_json_object("value", "$.k").isNull(), "k missing").otherwise("bad number")
    return spark.read.text(out).groupBy(why.alias("outcome")).agg(F.count("*").alias("n"))


@query("t2_dedup_ingest", f"{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed")
def dedup_ingest(spark, folder):
    """Every message arrives twice."""
    out = drain(spark, jobs.start_dedup_ingest, _landed(spark, folder, times=2))
    return tb.read_stored(spark, out)


@query("t2_late_rows", f"{BASE}, {CLOSED} SELECT {CANDLE_SQL}, 1 AS load_seq FROM docs WHERE closed")
def late_rows(spark, folder):
    """The second half of the series arrives first; ingest, late folder and upsert give the whole table."""
    path, docs = scratch_path(spark, "landing"), materialise(documents(tb.stored_event_candles(spark, folder)), "documents")
    middle = docs.agg(F.timestamp_micros(F.avg(F.unix_micros("open_time")).cast("long"))).scalar()
    out, late, progress, table = (scratch_path(spark, n) for n in ("stream", "late", "progress", "candle-table"))
    for part in (F.col("open_time") >= middle, F.col("open_time") < middle):
        land(docs.where(part), path)
        jobs.start_dedup_ingest(jobs.message_stream(spark, path), out, f"{progress}/a").awaitTermination()
        jobs.start_late_rows(jobs.message_stream(spark, path), late, f"{progress}/b").awaitTermination()
    first = tb.read_stored(spark, out).withColumn("load_seq", F.lit(1))
    store.write_candles(first, table)
    jobs.repair_candles(table, jobs.read_late(spark, late), load_seq=1)
    return store.read_candles(spark, table, first.schema).drop("month").select(*first.columns)


@query("t2_store_dedup", f"{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed")
def store_dedup(spark, folder):
    """Every message arrives twice, in two landings over the same progress; no candle is lost however long the backlog."""
    path, out, progress = _landed(spark, folder), scratch_path(spark, "stream"), scratch_path(spark, "progress")
    docs = materialise(documents(tb.stored_event_candles(spark, folder)), "documents")
    for again in (False, True):
        if again:
            land(docs, path)
        jobs.start_store_dedup(jobs.message_stream(spark, path), out, progress).awaitTermination()
    return conform(spark.read.parquet(f"{out}/rows"), CANDLE)


@query("t2_tail_dedup", f"""{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY close_time DESC) <= 240""")
def tail_dedup(spark, folder):
    """The 240-candle rule on request, run twice over the same progress: the second landing adds nothing."""
    path, out, progress = _landed(spark, folder), scratch_path(spark, "stream"), scratch_path(spark, "progress")
    docs = materialise(documents(tb.stored_event_candles(spark, folder)), "documents")
    for again in (False, True):
        if again:
            land(docs, path)
        jobs.start_tail_dedup(jobs.message_stream(spark, path), out, progress).awaitTermination()
    return conform(spark.read.parquet(f"{out}/rows"), CANDLE)


@query("t3_fan_in", f"{BASE}, {CLOSED} SELECT symbol, count(*) AS n FROM docs WHERE closed GROUP BY symbol")
def fan_in(spark, folder):
    out = drain(spark, jobs.start_ingest, _landed(spark, folder))
    return tb.read_stored(spark, out).groupBy("symbol").agg(F.count("*").alias("n"))


@query("t4_streaming_rollup", f"""WITH {TICKS}, {candles_sql('15m')}, {CLOSED},
  ticks15 AS (SELECT * FROM docs WHERE closed),
  hours AS (SELECT symbol, '1h' AS "interval", time_bucket(INTERVAL '1 hour', open_time) AS start,
    first(open ORDER BY open_time) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY open_time) AS close,
    sum(volume) AS volume FROM ticks15 GROUP BY ALL)
  SELECT symbol, "interval", start AS open_time, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
    round(close, 6) AS close, round(volume, 6) AS volume, start + INTERVAL '1 hour' - INTERVAL '1 millisecond' AS close_time
  FROM hours WHERE start + INTERVAL '1 hour' <= (SELECT max(open_time) FROM ticks15) - INTERVAL '2 hours'""")
def streaming_rollup(spark, folder):
    """Windows the watermark has passed; later ones stay open. Every message arrives twice."""
    out = drain(spark, jobs.start_roll_up, _landed(spark, folder, "15m", times=2), interval="1h", source="15m")
    return tb.read_stored(spark, out)


@query("t5_latest_view", f"""{BASE}, {CLOSED} SELECT {CANDLE_SQL} FROM docs WHERE closed
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY close_time DESC) = 1""")
def latest_view(spark, folder):
    out = drain(spark, jobs.start_latest, _landed(spark, folder))
    return jobs.read_latest(spark, out).select(*CANDLE.names)


@query("t6_online_scoring", f"""{BASE}, {CLOSED}, {label_sql()},
  trained AS (SELECT DISTINCT symbol FROM labelled WHERE target IS NOT NULL AND symbol <> 'ERROR')
  SELECT symbol, max(close_time) AS "timestamp", CASE WHEN symbol IN (SELECT symbol FROM trained) THEN 'ok' ELSE 'no model' END AS status,
    CASE WHEN symbol IN (SELECT symbol FROM trained) THEN true END AS valid FROM docs WHERE closed GROUP BY symbol""")
def online_scoring(spark, folder):
    """Models per symbol from the stored candles, newest closed candle scored from the stream; one symbol has no model."""
    candles = tb.stored_event_candles(spark, folder)
    table = ml.training_table(materialise(features_per_split(candles.where("symbol <> 'ERROR'")), "features"))
    score = ml.score_each(logistic.fit(table.where("split = 'train'")))
    out = drain(spark, jobs.start_scoring, _landed(spark, folder), score=score)
    rows = spark.read.parquet(f"{out}/predictions")
    chance = F.col("prob_buy").between(0, 1) & (F.abs(F.col("prob_buy") + F.col("prob_sell") - 1) < 1e-9)
    return rows.select("symbol", "timestamp", "status", chance.alias("valid"))
