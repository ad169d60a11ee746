"""Keeping tables: dimensions, upsert, insert-if-absent, lookups and file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from kandela.functions.scalars import base_asset, interval_seconds, line_time, quote_asset
from kandela.operators.series import number_in_order, rank_last
from kandela.schemas import CANDLE, CANDLE_KEY, DIM_INTERVAL, DIM_SYMBOL, KLINE_KEY, KLINES, SERIES, conform
from kandela.session import materialise


# -- dimensions ----------------------------------------------------------------------------------

def absent_rows(stored: DataFrame, incoming: DataFrame, key: str, id_column: str) -> DataFrame:
    """The incoming keys that ``stored`` lacks, with ids continuing in key order."""
    fresh = incoming.dropDuplicates([key]).join(stored.select(key), on=key, how="left_anti")
    top = F.coalesce(stored.agg(F.max(id_column)).scalar(), F.lit(0))
    numbered = number_in_order(fresh, [key])
    return numbered.withColumn(id_column, (top + F.col("rn")).cast("int")).select(*stored.columns)


def insert_if_absent(stored: DataFrame, incoming: DataFrame, key: str, id_column: str) -> DataFrame:
    """Stored rows plus the incoming keys they lack, with ids continuing in key order."""
    return stored.unionByName(absent_rows(stored, incoming, key, id_column))


def symbol_rows(candles: DataFrame) -> DataFrame:
    """One row per symbol with its base and quote asset; ids are assigned on insert."""
    symbol = F.col("symbol")
    return candles.select("symbol").distinct().select(
        "symbol", base_asset(symbol).alias("base_asset"), quote_asset(symbol).alias("quote_asset")
    )


def interval_rows(candles: DataFrame) -> DataFrame:
    return candles.select(F.col("interval").alias("interval_name")).distinct().withColumn(
        "seconds", interval_seconds(F.col("interval_name"))
    )


def build_dimensions(spark: SparkSession, candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(symbol, interval) dimension tables from one scan of the candles' names.

    They are stored, so later joins know their exact size.
    """
    series = materialise(candles.select(*SERIES).distinct(), "series")
    symbols = insert_if_absent(
        spark.createDataFrame([], DIM_SYMBOL), symbol_rows(series), "symbol", "symbol_id")
    intervals = insert_if_absent(
        spark.createDataFrame([], DIM_INTERVAL), interval_rows(series), "interval_name", "interval_id")
    return (
        materialise(conform(symbols, DIM_SYMBOL), "dim-symbol"),
        materialise(conform(intervals, DIM_INTERVAL), "dim-interval"),
    )


def resolve_ids(candles: DataFrame, symbols: DataFrame, intervals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with both ids, rows naming an unknown symbol or interval, with the reason).

    The joins carry no hint: stored dimensions have an exact size, so they are broadcast below
    Spark's threshold, and above it the adaptive skew join splits a hot symbol.
    """
    known = intervals.select(F.col("interval_name").alias("interval"), "interval_id")
    looked_up = (
        candles.join(symbols.select("symbol", "symbol_id"), on="symbol", how="left")
        .join(known, on="interval", how="left")
    )
    found = looked_up.where("symbol_id IS NOT NULL AND interval_id IS NOT NULL")
    reason = F.when(F.col("symbol_id").isNull(), "unknown symbol").otherwise("unknown interval")
    rejected = looked_up.where("symbol_id IS NULL OR interval_id IS NULL")
    return found, rejected.select(*candles.columns, reason.alias("reason"))


def as_klines(found: DataFrame, last_id: Column | int = 0) -> DataFrame:
    """Fact rows with ids after ``last_id`` in key order and the load time as audit column.

    The key (symbol, interval, open time) must be unique: see ``newest_version``.
    """
    numbered = number_in_order(found, KLINE_KEY)
    top = last_id if isinstance(last_id, Column) else F.lit(last_id)
    return conform(numbered.withColumn("klines_id", F.col("rn") + top).withColumn("created_at", F.current_timestamp()), KLINES)


_KLINE_FOLDERS = ["symbol_id", "interval_id", "month"]


def _month() -> Column:
    return F.date_format("open_time", "yyyy-MM").alias("month")


def _in_months(touched: DataFrame) -> Column:
    """Whether a folder's month is one of ``touched``: a late row of an old month does not open what lies between."""
    return F.array_contains(touched.agg(F.collect_set("month")).scalar(), F.col("month"))


def _by_id_and_month(klines: DataFrame) -> DataFrame:
    """One task writes a whole (symbol, interval, month) folder; a month of one series is bounded by its grid."""
    return klines.withColumn("month", _month()).repartition(*_KLINE_FOLDERS)


def store_klines(klines: DataFrame) -> DataFrame:
    """The stored fact table, laid out by the two ids and month: joined dimension filters prune folders."""
    return materialise(_by_id_and_month(klines), "klines", partition_by=_KLINE_FOLDERS)


def read_klines(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact table with its month column; empty where nothing was loaded yet."""
    schema = T.StructType([*KLINES.fields, T.StructField("month", T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_klines(path: str, found: DataFrame) -> None:
    """Append rows with ids that continue the stored ones, and the load time."""
    last = F.coalesce(read_klines(found.sparkSession, path).agg(F.max("klines_id")).scalar(), F.lit(0))
    rows = materialise(as_klines(found, last), "klines-in")
    _by_id_and_month(rows).write.mode("append").partitionBy(*_KLINE_FOLDERS).parquet(path)


def upsert_klines(path: str, found: DataFrame) -> None:
    """Upsert into the stored fact table in place, rewriting only the (symbol, interval, month) folders it touches.

    A stored key keeps its id and load time and gets the incoming values; a new key is numbered after all
    stored ones. Only folders of incoming months are read, and the merged folders are written
    aside first, so a repeated run gives the same table.
    """
    spark = found.sparkSession
    incoming = materialise(found.withColumn("month", _month()), "upsert-in")
    stored = read_klines(spark, path)
    touched = incoming.select(*_KLINE_FOLDERS).distinct()
    near = materialise(stored.where(_in_months(touched)).join(touched, on=_KLINE_FOLDERS, how="left_semi"), "upsert-old")
    known = near.select(*KLINE_KEY, "klines_id", "created_at")
    kept = near.join(incoming.select(*KLINE_KEY), on=KLINE_KEY, how="left_anti")
    revised = incoming.join(known, on=KLINE_KEY)
    last = F.coalesce(stored.agg(F.max("klines_id")).scalar(), F.lit(0))
    fresh = as_klines(incoming.join(known.select(*KLINE_KEY), on=KLINE_KEY, how="left_anti"), last)
    merged = materialise(conform(kept, KLINES).unionByName(conform(revised, KLINES)).unionByName(fresh), "upsert-merged")
    (
        _by_id_and_month(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_KLINE_FOLDERS).parquet(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _extend_dimension(spark: SparkSession, path: str, contract: T.StructType, incoming: DataFrame, key: str) -> DataFrame:
    """Append the names a stored dimension lacks; gives the whole dimension."""
    stored = spark.read.schema(contract).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], contract)
    fresh = materialise(conform(absent_rows(stored, incoming, key, contract.names[0]), contract), "dim-new")
    fresh.write.mode("append").parquet(path)
    return spark.read.schema(contract).parquet(path)


def load_candles(root: str, candles: DataFrame) -> DataFrame:
    """Load decoded candles into the tables below ``root`` (symbol, intervals, klines); gives the rejects with a reason.

    Rows with a missing field or an interval without a known length are rejected. Pages may overlap: of a
    key's rows one is taken. New symbols and intervals get the next ids. Loading the same rows again changes
    nothing, and corrected rows replace theirs.
    """
    spark = candles.sparkSession
    rows = materialise(candles.select(*CANDLE.names), "landed")
    whole = F.lit(True)
    for name in CANDLE.names:
        whole = whole & F.col(name).isNotNull()
    known = rows.where(whole & interval_seconds(F.col("interval")).isNotNull())
    series = materialise(known.select(*SERIES).distinct(), "series")
    symbols = _extend_dimension(spark, f"{root}/symbol", DIM_SYMBOL, symbol_rows(series), "symbol")
    intervals = _extend_dimension(spark, f"{root}/intervals", DIM_INTERVAL, interval_rows(series), "interval_name")
    found, _ = resolve_ids(newest_version(known, CANDLE_KEY, "close_time"), symbols, intervals)
    upsert_klines(f"{root}/klines", found.drop(*SERIES))
    reason = F.when(whole, "unknown interval").otherwise("missing field")
    return rows.where(~whole | interval_seconds(F.col("interval")).isNull()).withColumn("reason", reason)


def constraint_report(klines: DataFrame, symbols: DataFrame, intervals: DataFrame) -> DataFrame:
    """``table, constraint, violations`` of the primary keys, required columns, unique names and foreign keys."""
    spark, counts = klines.sparkSession, []

    def add(table: str, name: str, rows: DataFrame) -> None:
        counts.append(rows.agg(F.count("*").alias("violations")).select(
            F.lit(table).alias("table"), F.lit(name).alias("constraint"), "violations"))

    repeated = lambda df, *by: df.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 1")
    for table, df, key, unique in (("symbol", symbols, "symbol_id", ["symbol"]), ("intervals", intervals, "interval_id", ["interval_name"]),
                                   ("klines", klines, "klines_id", KLINE_KEY)):
        add(table, f"primary key {key}", repeated(df, key))
        add(table, "unique " + ", ".join(unique), repeated(df, *unique))
        missing = F.lit(False)
        for column in (f for f in df.columns if f != "month"):
            missing = missing | F.col(column).isNull()
        add(table, "not null", df.where(missing))
    add("klines", "foreign key symbol_id", klines.join(symbols, on="symbol_id", how="left_anti"))
    add("klines", "foreign key interval_id", klines.join(intervals, on="interval_id", how="left_anti"))
    report = counts[0]
    for more in counts[1:]:
        report = report.unionByName(more)
    return report


def work_list(symbols: DataFrame, intervals: DataFrame, most_intervals: int = 1000) -> DataFrame:
    """Every symbol with every interval.

    The intervals are a fixed handful, so each symbol row unfolds an array of them and no cross
    join is planned. More than ``most_intervals`` raise instead of growing the array.
    """
    listed = F.array_sort(F.collect_list(F.struct("interval_name", "seconds")))
    limited = intervals.limit(most_intervals + 1)
    names = limited.agg(F.when(F.count("*") > most_intervals, F.raise_error(F.lit(f"more than {most_intervals} intervals")))
                        .otherwise(listed)).scalar()
    return (
        symbols.select("symbol", F.explode(names).alias("i"))
        .select("symbol", F.col("i.interval_name").alias("interval"), F.col("i.seconds").alias("seconds"))
    )


# -- candle table --------------------------------------------------------------------------------

def newest_version(rows: DataFrame, key: Sequence[str] = CANDLE_KEY, order: str = "load_seq") -> DataFrame:
    """One row per key: the one loaded last, equal load numbers decided by the values.

    The rank limit also runs before the shuffle, so a key with very many copies sends one row per task.
    """
    rest = sorted(c for c in rows.columns if c not in key and c != order)
    latest = Window.partitionBy(*key).orderBy(F.col(order).desc(), *[F.col(c).desc() for c in rest])
    return rows.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, incoming: DataFrame, key: Sequence[str] = CANDLE_KEY,
           order: str = "load_seq") -> DataFrame:
    """Stored rows replaced or extended by incoming ones; the last write wins."""
    return newest_version(stored.unionByName(incoming), key, order)


def _by_month(candles: DataFrame) -> DataFrame:
    """Candles with their month, gathered so that one task writes a whole (series, month) folder.

    A month of one series is bounded by its grid, so a hot symbol spreads over its months.
    """
    return candles.withColumn("month", F.date_format("open_time", "yyyy-MM")).repartition(*SERIES, "month")


def write_candles(candles: DataFrame, path: str) -> None:
    """First load of a candle table, laid out by symbol / interval / month."""
    _by_month(candles).write.partitionBy(*SERIES, "month").parquet(path)


def read_candles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored candles; filters on symbol, interval or month prune folders."""
    fields = [f for f in schema.fields if f.name != "month"]
    return spark.read.schema(T.StructType([*fields, T.StructField("month", T.StringType())])).parquet(path)


def upsert_into(path: str, incoming: DataFrame) -> None:
    """Upsert into a stored candle table, rewriting only the (series, month) folders it touches.

    Only folders of incoming months are read. The merged partitions are written aside
    first, so the table is never read and overwritten in one plan, and a repeated run gives the same
    table.
    """
    spark = incoming.sparkSession
    incoming = materialise(_by_month(incoming), "upsert-in")
    touched = incoming.select(*SERIES, "month").distinct()
    stored = read_candles(spark, path, incoming.schema).where(_in_months(touched))
    stored = stored.join(touched, on=[*SERIES, "month"], how="left_semi")
    merged = materialise(upsert(stored, incoming, [*SERIES, "month", "open_time"]), "upsert-merged")
    (
        merged.repartition(*SERIES, "month")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SERIES, "month").parquet(path)
    )


def not_yet_stored(batch: DataFrame, stored: DataFrame, last: int | None = None) -> DataFrame:
    """The batch rows whose (series, close time) the store lacks; repeats inside the batch count once.

    A stored table with a ``month`` column is read for the batch's months only. ``last`` is the
    source system's narrower rule, on request: the newest ``last`` rows per series of the batch against the
    ``last`` newest of ``stored``; what is older is then neither kept nor recognised.
    """
    key = [*SERIES, "close_time"]
    batch = batch.dropDuplicates(key)
    if last is not None:
        seen = rank_last(stored, last, time="close_time")
        return rank_last(batch, last, time="close_time").join(seen.select(*key), on=key, how="left_anti")
    if "month" in stored.columns:
        stored = stored.where(_in_months(batch.select(_month())))
    return batch.join(stored.select(*key), on=key, how="left_anti")


def is_loaded(table: DataFrame) -> bool:
    """Load-once guard: whether a table already holds a row."""
    return not table.isEmpty()


# -- file sinks ----------------------------------------------------------------------------------

def _few_files(candles: DataFrame, time: str = "open_time") -> DataFrame:
    """Rows gathered by symbol and month: few files per symbol folder, and no task holds a symbol."""
    return candles.repartition("symbol", F.date_trunc("month", time))


def export_csv(candles: DataFrame, path: str) -> None:
    """One folder of CSV files per symbol."""
    _few_files(candles).write.partitionBy("symbol").option("header", True).csv(path)


def append_json_lines(candles: DataFrame, path: str, time: str = "timestamp") -> None:
    """One JSON object per line, times as text, appending to earlier batches."""
    candles.withColumn(time, line_time(F.col(time))).write.mode("append").json(path)


def append_documents(documents: DataFrame, path: str) -> None:
    _few_files(documents).write.mode("append").partitionBy("symbol").parquet(path)
