"""Structured Streaming jobs over landed message files.

Each ``start_*`` returns a running query. ``available_now`` drains what is there and stops;
otherwise the given period drives it. Progress lives in the checkpoint folder, so a restarted job
continues where it stopped; file sinks are exactly-once, and the ``foreachBatch`` jobs write per
batch number so that a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kandela.functions.scalars import floor_time
from kandela.operators.candles import nests, roll_up_candles
from kandela.operators.clean import closed_only
from kandela.operators.features import latest_features
from kandela.operators.series import rank_last
from kandela.operators.store import newest_version, not_yet_stored, upsert_into
from kandela.schemas import CANDLE, INTERVAL_SECONDS, SERIES
from kandela.sources.messages import accepted, decode_messages, quarantined

LATENESS = "2 hours"
STORED_TAIL = 240


def decoded_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Every landed message decoded, readable or not, with its raw text."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_messages(reader.text(folder))


def message_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Accepted messages of every symbol in one stream; the symbol is a column."""
    return accepted(decoded_stream(spark, folder, files_per_trigger))


def _start(writer: DataStreamWriter, checkpoint: str, period: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()


def start_ingest(messages: DataFrame, out: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Append closed candles as they arrive."""
    rows = closed_only(messages)
    return _start(rows.writeStream.format("parquet").option("path", out), checkpoint, period)


def start_quarantine(decoded: DataFrame, out: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Keep the raw text of messages that could not be read."""
    rows = quarantined(decoded)
    return _start(rows.writeStream.format("text").option("path", out), checkpoint, period)


def deduplicated(messages: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Closed candles, one per natural key; state is kept for ``lateness`` only."""
    return (
        closed_only(messages)
        .withWatermark("close_time", lateness)
        .dropDuplicatesWithinWatermark([*SERIES, "close_time"])
    )


def start_dedup_ingest(messages: DataFrame, out: str, checkpoint: str, period: str | None = None,
                       lateness: str = LATENESS) -> StreamingQuery:
    """Append closed candles once each; rows later than ``lateness`` are not here but with ``start_late_rows``."""
    rows = deduplicated(messages, lateness)
    return _start(rows.writeStream.format("parquet").option("path", out), checkpoint, period)


def start_late_rows(messages: DataFrame, out: str, checkpoint: str, period: str | None = None,
                    lateness: str = LATENESS, time: str = "close_time") -> StreamingQuery:
    """Keep every closed candle that a watermark of ``lateness`` may drop, over the same messages in the same order.

    A row counts as late when it lies more than ``lateness`` behind the newest time up to its own batch. A job
    with a watermark only drops rows behind the newest time of earlier messages, so this folder
    holds all of them, whatever its batches were; rows it holds besides are removed again by the upsert
    (``repair_candles``).
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max(time).alias("newest"))
        seen = _previous(spark, out, "newest", number, newest).unionByName(newest).agg(F.max("newest").alias("newest"))
        seen.write.mode("overwrite").parquet(_slot(out, "newest", number))
        limit = spark.read.schema(newest.schema).parquet(_slot(out, "newest", number))
        behind = F.col(time) < limit.select(F.col("newest") - F.expr(f"INTERVAL {lateness}")).scalar()
        batch.where(behind).write.mode("overwrite").parquet(_batch_folder(out, "late", number))

    return _start(closed_only(messages).writeStream.foreachBatch(write), checkpoint, period)


def read_late(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/late").drop("batch")


def repair_candles(path: str, late: DataFrame, load_seq: int) -> None:
    """Upsert late candles into the stored table; ``load_seq`` decides against what is stored."""
    columns = [c for c in late.columns if c != "closed"]
    upsert_into(path, late.select(*columns).withColumn("load_seq", F.lit(load_seq)))


def repaired_windows(fine: DataFrame, late: DataFrame, interval: str, source: str) -> DataFrame:
    """The coarse candles that late fine ones belong to, rolled up anew from the repaired fine table."""
    start = lambda df: df.withColumn("_start", floor_time(F.col("open_time"), interval))
    touched = start(late.where(F.col("interval") == source)).select("symbol", "_start").distinct()
    return roll_up_candles(start(fine).join(touched, on=["symbol", "_start"], how="left_semi").drop("_start"), interval, source)


def _batch_folder(out: str, kind: str, batch: int) -> str:
    return f"{out}/{kind}/batch={batch}"


def _slot(out: str, kind: str, batch: int) -> str:
    """One of two folders used in turn: a batch reads the previous state and writes its own."""
    return f"{out}/{kind}/slot={batch % 2}"


def _previous(spark: SparkSession, out: str, kind: str, batch: int, like: DataFrame) -> DataFrame:
    if batch == 0:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(_slot(out, kind, batch - 1))


def start_store_dedup(messages: DataFrame, out: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Per batch, all closed candles the store lacks, however old or many; nothing is dropped as late.

    The store is laid out by batch and month, and a batch looks its keys up in its own span of months only.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("month", F.date_format("open_time", "yyyy-MM")).persist()
        stored = spark.createDataFrame([], rows.schema)
        if number:
            schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.IntegerType())])
            stored = spark.read.schema(schema).parquet(f"{out}/rows").where(F.col("batch") < number)
        not_yet_stored(rows, stored).write.mode("overwrite").partitionBy("month").parquet(_batch_folder(out, "rows", number))
        rows.unpersist()

    return _start(closed_only(messages).writeStream.foreachBatch(write), checkpoint, period)


def start_tail_dedup(messages: DataFrame, out: str, checkpoint: str, period: str | None = None,
                     last: int = STORED_TAIL) -> StreamingQuery:
    """The source system's narrower rule, on request: per batch, the newest ``last`` candles per series minus
    those among the ``last`` stored ones. A backlog of more than ``last`` candles per series loses the rest;
    ``start_store_dedup`` keeps it.

    The stored tail is a small table of its own, rewritten per batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([*SERIES, "close_time"])
        tail = _previous(spark, out, "tail", number, rows)
        not_yet_stored(rows, tail, last).write.mode("overwrite").parquet(_batch_folder(out, "rows", number))
        fresh = spark.read.schema(rows.schema).parquet(_batch_folder(out, "rows", number))
        rank_last(tail.unionByName(fresh), last, time="close_time").write.mode("overwrite").parquet(
            _slot(out, "tail", number))

    return _start(closed_only(messages).writeStream.foreachBatch(write), checkpoint, period)


def window_of(time: Column, interval: str) -> Column:
    """Tumbling window of a candle interval; weeks start on Monday, not on the epoch's Thursday."""
    if interval == "1w":
        return F.window(time, "7 days", startTime="4 days")
    return F.window(time, f"{INTERVAL_SECONDS[interval]} seconds")


def rolled_up(messages: DataFrame, interval: str, source: str, lateness: str = LATENESS) -> DataFrame:
    """Closed candles of the ``source`` interval rolled up per window; a repeated one counts once.

    Candles of other intervals are not read, and a source that does not nest in the target is refused.
    """
    if not nests(source, interval):
        raise ValueError(f"{source} candles do not roll up to {interval}")
    return (
        closed_only(messages).where(F.col("interval") == source)
        .withWatermark("open_time", lateness)
        .dropDuplicatesWithinWatermark([*SERIES, "open_time"])
        .groupBy("symbol", window_of(F.col("open_time"), interval).alias("w"))
        .agg(
            F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"),
            F.min("low").alias("low"), F.max_by("close", "open_time").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select(
            "symbol", F.lit(interval).alias("interval"), F.col("w.start").alias("open_time"),
            "open", "high", "low", "close", "volume",
            (F.col("w.end") - F.expr("INTERVAL 0.001 SECONDS")).alias("close_time"),
        )
    )


def start_roll_up(messages: DataFrame, interval: str, source: str, out: str, checkpoint: str,
                  period: str | None = None, lateness: str = LATENESS) -> StreamingQuery:
    """Append each coarse candle once the watermark has passed its end.

    Fine candles later than that are kept by ``start_late_rows(time="open_time")``; ``repaired_windows`` gives
    the coarse candles they change.
    """
    rows = rolled_up(messages, interval, source, lateness).select(*CANDLE.names)
    return _start(rows.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint, period)


def start_latest(messages: DataFrame, out: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Keep the newest closed candle of every series, equal close times decided by the open time.

    Each batch writes the full small result, with its number, to one of two folders.
    """
    rest = [c for c in messages.columns if c not in SERIES]
    newest = (
        closed_only(messages).groupBy(*SERIES)
        .agg(F.max_by(F.struct(*rest), F.struct("close_time", "open_time")).alias("_last"))
        .select(*SERIES, "_last.*")
    )

    def write(view: DataFrame, number: int) -> None:
        view.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(_slot(out, "latest", number))

    return _start(newest.writeStream.outputMode("complete").foreachBatch(write), checkpoint, period)


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """The view of the newest finished batch."""
    views = spark.read.parquet(f"{out}/latest")
    newest = views.agg(F.max("batch")).scalar()
    return views.where(F.col("batch") == newest).drop("batch", "slot")


def start_scoring(messages: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                  period: str | None = None, window: int = 60) -> StreamingQuery:
    """Score the newest candle of each series that a batch touches.

    A table with the last ``window`` candles per series stands in for the store: each batch merges
    into it, computes features from it alone, and hands the newest row to ``score``. A candle that comes again
    replaces its earlier version: the batch number is the load number.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = newest_version(batch.withColumn("load_seq", F.lit(number)), [*SERIES, "close_time"]).persist()
        tail = _previous(spark, out, "tail", number, rows)
        merged = newest_version(tail.unionByName(rows), [*SERIES, "close_time"])
        rank_last(merged, window, time="close_time").write.mode("overwrite").parquet(
            _slot(out, "tail", number))
        stored = spark.read.schema(rows.schema).parquet(_slot(out, "tail", number))
        touched = rows.select(*SERIES).distinct()
        newest = latest_features(stored, window).join(touched, on=SERIES, how="left_semi")
        newest.write.mode("overwrite").parquet(_slot(out, "newest", number))
        newest = spark.read.schema(newest.schema).parquet(_slot(out, "newest", number))
        score(newest).write.mode("overwrite").parquet(_batch_folder(out, "predictions", number))
        rows.unpersist()

    return _start(closed_only(messages).writeStream.foreachBatch(write), checkpoint, period)
