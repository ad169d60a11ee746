"""events as monitoring samples: scraped counters, gauges and histogram buckets.

Counts are first taken per scrape slot, so the running totals are windows over the small scraped
table. Counters restart every week, as a restarted process would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kandela.schemas import METRIC_SAMPLE, conform
from kandela.sources.tables import read_table

SCRAPE_SECONDS = 3600
# Upper bounds of the latency buckets.
BUCKETS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


def _events(spark: SparkSession, folder: str, scrape_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return read_table(spark, folder, "events").select(
        F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(scrape_seconds))).alias("ts"), "event_type", "value", "user_id")


def _labels(**columns: Column) -> Column:
    return F.create_map(*[x for name, col in columns.items() for x in (F.lit(name), col.cast("string"))])


def _running(counts: DataFrame, by: list[str], value: str) -> Column:
    week = F.date_trunc("week", "ts")
    return F.sum(value).over(
        Window.partitionBy(*by, week).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0))


def _samples(rows: DataFrame, name: str, labels: Column, value: Column) -> DataFrame:
    return conform(rows.select(F.lit(name).alias("name"), labels.alias("labels"), "ts", value.alias("value")),
                   METRIC_SAMPLE)


def cpu_seconds(spark: SparkSession, folder: str, scrape_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    """Counter per instance and mode; views count as idle time."""
    by = ["instance", "mode"]
    hourly = _events(spark, folder, scrape_seconds).groupBy(
        (F.col("user_id") % 4).alias("instance"),
        F.when(F.col("event_type") == "view", "idle").otherwise("user").alias("mode"), "ts",
    ).agg(F.count("*").alias("hits"))
    return _samples(hourly, "node_cpu_seconds_total",
                    _labels(instance=F.col("instance"), mode=F.col("mode")), _running(hourly, by, "hits"))


def memory(spark: SparkSession, folder: str) -> DataFrame:
    """Two gauges per instance: the sum of values as total, the largest value as available."""
    hourly = _events(spark, folder).groupBy((F.col("user_id") % 4).alias("instance"), "ts").agg(
        F.sum("value").alias("total"), F.max("value").alias("available"))
    labels = _labels(instance=F.col("instance"))
    return _samples(hourly, "node_memory_MemTotal_bytes", labels, F.col("total")).unionByName(
        _samples(hourly, "node_memory_MemAvailable_bytes", labels, F.col("available")))


def api_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Counter per endpoint."""
    hourly = _events(spark, folder).groupBy(F.col("event_type").alias("endpoint"), "ts").agg(
        F.count("*").alias("hits"))
    return _samples(hourly, "api_requests_total", _labels(endpoint=F.col("endpoint")),
                    _running(hourly, ["endpoint"], "hits"))


def latency_buckets(spark: SparkSession, folder: str, scrape_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    """Cumulative bucket counters of the event value per endpoint."""
    bounds = [*BUCKETS, float("inf")]
    hourly = _events(spark, folder, scrape_seconds).groupBy(F.col("event_type").alias("endpoint"), "ts").agg(
        F.array(*[
            F.struct(F.lit(b).alias("le"), F.count_if(F.col("value") <= b).alias("hits")) for b in bounds
        ]).alias("buckets"))
    rows = hourly.select("endpoint", "ts", F.inline("buckets"))
    return _samples(rows, "api_request_latency_seconds_bucket",
                    _labels(endpoint=F.col("endpoint"), le=F.col("le")), _running(rows, ["endpoint", "le"], "hits"))


def connections(spark: SparkSession, folder: str) -> DataFrame:
    """Gauge per database and state."""
    hourly = _events(spark, folder).groupBy(
        (F.col("user_id") % 3).alias("db"), F.col("event_type").alias("state"), "ts").agg(F.count("*").alias("open"))
    return _samples(hourly, "pg_stat_activity_count",
                    _labels(datname=F.concat(F.lit("db_"), F.col("db").cast("string")), state=F.col("state")),
                    F.col("open"))


def containers(spark: SparkSession, folder: str) -> DataFrame:
    """Start time per container; every fifth one has no image."""
    hourly = _events(spark, folder).groupBy("user_id", "ts").agg(F.count("*").alias("n"))
    image = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.concat(F.lit("img_"), F.col("user_id").cast("string")))
    return _samples(hourly, "container_start_time_seconds",
                    _labels(name=F.col("user_id"), image=image), F.unix_seconds("ts"))
