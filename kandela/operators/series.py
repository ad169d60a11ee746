"""Ordered-series computing that does not tie a series to one task.

A window partitioned by (symbol, interval) sends a whole series through one task, so one hot
series limits the job. Every frame used here is bounded, so a series can be cut into chunks
that carry a few neighbouring rows along:

1. rows are counted per small time bucket (one pre-aggregated pass over the key columns);
2. the bucket table gives each bucket its row offset, its chunk, and the neighbouring chunks whose
   frames reach into it; offsets count rows rather than clock time, so gaps do not matter;
3. rows join that table and are copied to those chunks; only rows near a chunk edge are copied;
4. windows run per (series, chunk), and copies are dropped afterwards.

The result equals the plain window exactly. A chunk holds ``chunk_rows`` rows plus at most one
bucket and the copied edge. A bucket is bounded because (series, time) is unique: candles are
deduplicated on their natural key before they are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from kandela.functions.scalars import interval_seconds
from kandela.schemas import SERIES
from kandela.session import materialise

SLOTS_PER_BUCKET = 256
CHUNK_ROWS = 16384

_BUCKET, _CHUNK, _HOME, _START, _ROWS = "_bucket", "_chunk", "_home", "_start", "_rows"


def candle_bucket(slots: int = SLOTS_PER_BUCKET) -> Column:
    """Time bucket of a candle: ``slots`` grid positions of its own interval; an unknown interval raises.

    Calendar months and years count with their shortest length, so a bucket never holds more positions.
    """
    name = F.col("interval")
    calendar = F.when(name == "1M", 28 * 86400).when(name == "1y", 365 * 86400)
    unknown = F.raise_error(F.concat(F.lit("no grid is known for interval "), F.coalesce(name, F.lit("null")))).cast("int")
    width = F.coalesce(interval_seconds(name), calendar, unknown) * slots
    return F.floor(F.unix_seconds("open_time") / width)


def bucket_table(
    rows: DataFrame, keys: Sequence[str], bucket: Column, chunk_rows: int, back: int, ahead: int
) -> DataFrame:
    """(keys, bucket) -> first row offset, series length, own chunk, chunks to be copied to.

    Its windows run over bucket counts, which are bounded by the calendar span of a series.
    """
    counts = rows.groupBy(*keys, bucket.alias(_BUCKET)).agg(F.count("*").alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy(_BUCKET)
    placed = (
        counts
        .withColumn("_end", F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(_ROWS, F.sum("_n").over(Window.partitionBy(*keys)))
        .withColumn(_START, F.col("_end") - F.col("_n"))
        .withColumn(_CHUNK, F.floor(F.col(_START) / chunk_rows))
        # The chunk that starts where this bucket ends, and the one that ends where it starts.
        .withColumn("_after", F.lead(_CHUNK).over(in_order))
        .withColumn("_before", F.lag(_CHUNK).over(in_order))
        .withColumn("_after", F.when(F.col("_after") != F.col(_CHUNK), F.col("_after")))
        .withColumn("_before", F.when(F.col("_before") != F.col(_CHUNK), F.col("_before")))
    )
    targets = [F.array(F.col(_CHUNK))]
    if back:
        # Chunks that start fewer than ``back`` rows after this bucket ends.
        reach = Window.partitionBy(*keys).orderBy("_end").rangeBetween(0, back - 1)
        targets.append(F.collect_list("_after").over(reach))
    if ahead:
        # Chunks that end fewer than ``ahead`` rows before this bucket starts.
        reach = Window.partitionBy(*keys).orderBy(_START).rangeBetween(1 - ahead, 0)
        targets.append(F.collect_list("_before").over(reach))
    return placed.select(
        *keys, _BUCKET, F.col(_CHUNK).alias("_own"), F.col(_START), F.col(_ROWS),
        F.array_distinct(F.concat(*targets)).alias("_targets"),
    )


def _chunked(
    rows: DataFrame, keys: Sequence[str], bucket: Column, back: int, ahead: int, chunk_rows: int
) -> DataFrame:
    table = bucket_table(rows, keys, bucket, chunk_rows, back, ahead)
    return (
        rows.withColumn(_BUCKET, bucket)
        .join(table, on=[*keys, _BUCKET])
        .withColumn(_CHUNK, F.explode("_targets"))
        .withColumn(_HOME, F.col(_CHUNK) == F.col("_own"))
        .drop("_targets", "_own")
    )


_HELPERS = [_BUCKET, _CHUNK, _HOME, _START, _ROWS]


def over_series(
    rows: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    back: int = 0,
    ahead: int = 0,
    keys: Sequence[str] = SERIES,
    time: str = "open_time",
    bucket: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
    numbered: bool = False,
) -> DataFrame:
    """Apply ``compute(df, window)`` along each series.

    ``compute`` must look back at most ``back`` rows and ahead at most ``ahead`` rows. ``numbered``
    gives it rn (1-based position in the series) and n (series length) as columns.

    ``rows`` feeds both the bucket counts and the windows, so it should be a stored table.
    """
    bucket = candle_bucket() if bucket is None else bucket
    chunks = _chunked(rows, keys, bucket, back, ahead, chunk_rows)
    window = chunk_window(keys, time)
    if numbered:
        # Buckets are copied whole, so a chunk starts where its first bucket does.
        first = F.min(_START).over(Window.partitionBy(*keys, _CHUNK))
        chunks = chunks.withColumn("rn", first + F.row_number().over(window)).withColumn("n", F.col(_ROWS))
    return compute(chunks, window).where(_HOME).drop(*_HELPERS)


def chunk_window(keys: Sequence[str], time: str, *within: str) -> WindowSpec:
    """The window inside ``over_series``; ``within`` cuts a series into runs that do not see each other."""
    return Window.partitionBy(*keys, *within, _CHUNK).orderBy(time)


def number_rows(
    rows: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    time: str = "open_time",
    bucket: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``rn`` (1-based position in the series) and ``n`` (series length)."""
    return over_series(
        rows, lambda df, w: df, keys=keys, time=time, bucket=bucket, chunk_rows=chunk_rows, numbered=True)


def number_in_order(rows: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Add ``name``: the 1-based position of each row in the order of columns whose values differ per row.

    Rows are range-partitioned by the whole key, counted per range and numbered inside, so no task sees
    them all and a prefix that all keys share does not matter.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, inside).join(counts, on="_range").withColumn(
        name, F.col(name) + F.col("_before")).drop("_range", "_before")


def newest_months(rows: DataFrame, n: int, keys: Sequence[str] = SERIES) -> DataFrame:
    """(keys, month) of the months that hold the newest ``n`` rows of each series.

    On a table laid out by month the counts come from file footers: no column is read. The window runs
    over months, which the calendar bounds.
    """
    counts = rows.groupBy(*keys, "month").agg(F.count("*").alias("_n"))
    newer = Window.partitionBy(*keys).orderBy(F.col("month").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = F.coalesce(F.sum("_n").over(newer), F.lit(0))
    return counts.withColumn("_later", later).where(F.col("_later") < n).select(*keys, "month")


def _newest_buckets(rows: DataFrame, n: int) -> DataFrame:
    """(series, first bucket to read) so that the buckets from there on hold the newest ``n`` rows."""
    counts = rows.groupBy(*SERIES, candle_bucket().alias(_BUCKET)).agg(F.count("*").alias("_n"))
    newer = Window.partitionBy(*SERIES).orderBy(F.col(_BUCKET).desc())
    later = F.sum("_n").over(newer.rowsBetween(Window.unboundedPreceding, -1))
    needed = counts.withColumn("_later", F.coalesce(later, F.lit(0))).where(F.col("_later") < n)
    return needed.groupBy(*SERIES).agg(F.min(_BUCKET).alias("_from"))


def recent_part(rows: DataFrame, n: int) -> DataFrame:
    """What holds the newest ``n`` rows of each series.

    A stored table laid out by month (column ``month``) is read from the first month any series needs:
    the month filter prunes folders before the scan, and the join keeps each series' own months. Other frames
    are cut at the time bucket from which on each series is needed; they are scanned whole.
    """
    if "month" in rows.columns:
        needed = materialise(newest_months(rows, n), "newest-months")
        first = needed.agg(F.min("month")).scalar()
        return rows.where(F.col("month") >= first).join(needed, on=[*SERIES, "month"], how="left_semi").select(*rows.columns)
    start = materialise(_newest_buckets(rows, n), "newest")
    return rows.join(start, on=SERIES).where(candle_bucket() >= F.col("_from")).drop("_from")


def last_rows(rows: DataFrame, n: int, *, time: str = "open_time") -> DataFrame:
    """The newest ``n`` candles of each series, ranked on at most ``n`` rows plus one month or bucket each."""
    return rank_last(recent_part(rows, n), n, time=time)


def rank_last(rows: DataFrame, n: int, *, time: str = "open_time") -> DataFrame:
    """As ``last_rows`` for a frame that is already short per series."""
    newest = Window.partitionBy(*SERIES).orderBy(F.col(time).desc())
    return rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")
