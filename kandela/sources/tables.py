"""Tick and candle views over the supplied Parquet tables, and scans of stored candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kandela.operators.candles import roll_up_candles, roll_up_ticks
from kandela.schemas import CANDLE, KLINES, SERIES
from kandela.session import materialise


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """events as ticks: the event type is the symbol, props.k the quantity."""
    return read_table(spark, folder, "events").select(
        F.upper("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("quantity"),
    )


def order_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """orders as ticks: the priority is the symbol, each order trades one unit."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
    )


def event_candles(spark: SparkSession, folder: str, interval: str = "1h") -> DataFrame:
    return roll_up_ticks(event_ticks(spark, folder), interval)


def stored_event_candles(spark: SparkSession, folder: str, interval: str = "1h") -> DataFrame:
    """Event candles written once, so that the ticks are scanned once however often they are used."""
    return materialise(event_candles(spark, folder, interval), f"candles-{interval}")


def stored_candle_table(spark: SparkSession, folder: str, interval: str = "1h") -> DataFrame:
    """Event candles as a table laid out by series and month, with its ``month`` column."""
    rows = event_candles(spark, folder, interval).withColumn("month", F.date_format("open_time", "yyyy-MM"))
    return materialise(rows.repartition(*SERIES, "month"), f"table-{interval}", partition_by=[*SERIES, "month"])


def stored_candle_grid(spark: SparkSession, folder: str, intervals: tuple[str, ...] = ("15m", "1h", "1d")) -> DataFrame:
    """Several intervals from one tick scan: the finest from ticks, each coarser one from it."""
    finest = stored_event_candles(spark, folder, intervals[0])
    grid = finest
    for interval in intervals[1:]:
        grid = grid.unionByName(roll_up_candles(finest, interval, intervals[0]))
    return grid


def daily_order_candles(spark: SparkSession, folder: str) -> DataFrame:
    return roll_up_ticks(order_ticks(spark, folder), "1d")


def read_stored(spark: SparkSession, path: str, schema: T.StructType = CANDLE) -> DataFrame:
    """All columns of a stored table."""
    return spark.read.schema(schema).parquet(path)


JDBC_PARTITIONING = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table; Spark pushes filters and projections to the database.

    partitionColumn, lowerBound, upperBound and numPartitions are required: without them one task
    would read the whole table.
    """
    missing = [name for name in JDBC_PARTITIONING if name not in options]
    if missing:
        raise ValueError(f"read_jdbc needs {', '.join(missing)}")
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def scan_intervals(klines: DataFrame, *interval_ids: int) -> DataFrame:
    return klines.where(F.col("interval_id").isin(*interval_ids))


def scan_prices(candles: DataFrame, where: Column | None = None) -> DataFrame:
    """Time and prices only, in time order."""
    rows = candles if where is None else candles.where(where)
    return rows.select("symbol", "open_time", "open", "high", "low", "close").orderBy("symbol", "open_time")


def scan_symbol(documents: DataFrame, symbol: str) -> DataFrame:
    """One symbol of a table laid out by symbol; the others' folders are not read."""
    return documents.where(F.col("symbol") == symbol)


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """The training export: klines as CSV with surrogate ids; a header in another order is refused."""
    return spark.read.schema(KLINES).csv(path, header=True, enforceSchema=False)
