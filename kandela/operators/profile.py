"""Descriptive statistics of candle tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kandela.schemas import PRICES
from kandela.session import materialise

# A double's fraction steps, its exponents and its code of infinity.
_FRACTION = 1 << 52
_LOW_EXPONENT, _TOP_EXPONENT = -1022, 1023
_INFINITE = 2047 << 52
_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, column, value), without missing values."""
    return df.unpivot(list(keys), list(columns), "column", "value").where("value IS NOT NULL")


def ordered_code(value: Column) -> Column:
    """A double as a long of the same order: 63 bits of exponent and fraction, negated below zero; NaN is the largest.

    All steps are exact, as they scale by powers of two only. Both zeros get the same code.
    """
    size = F.abs(value)
    guess = F.least(F.floor(F.log2(size)), F.lit(_TOP_EXPONENT))  # the logarithm may be off by one next to a power of two
    unit = F.pow(F.lit(2.0), guess)
    exponent = F.greatest(F.when(size < unit, guess - 1).when(size / unit >= 2, guess + 1).otherwise(guess), F.lit(_LOW_EXPONENT))
    finite = (exponent - _LOW_EXPONENT) * _FRACTION + (size / F.pow(F.lit(2.0), exponent) * float(_FRACTION)).cast("long")
    code = F.when(size == 0, 0).when(F.isnan(value), _INFINITE + 1).when(size == float("inf"), _INFINITE).otherwise(finite)
    return F.when(value < 0, -code).otherwise(code)


def decoded(code: Column) -> Column:
    """The double of an ``ordered_code``."""
    size = F.abs(code)
    exponent, fraction = F.shiftright(size, 52), size % _FRACTION
    normal = (1 + fraction / float(_FRACTION)) * F.pow(F.lit(2.0), exponent + (_LOW_EXPONENT - 1))
    small = fraction / float(_FRACTION) * F.pow(F.lit(2.0), F.lit(_LOW_EXPONENT))
    value = F.when(size > _INFINITE, float("nan")).when(size == _INFINITE, float("inf")).when(exponent > 0, normal).otherwise(small)
    return F.when(code < 0, -value).otherwise(value)


def exact_percentiles(values: DataFrame, keys: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per group, without one task holding a group.

    Radix selection: values become integers of the same order, written once. Each pass counts 16 bits of those that share
    the bits already known of a wanted rank, which combines before the shuffle, and picks the bin that holds the rank. Four
    passes name the value whatever the distribution; a bin of equal values ends earlier. Nulls do not count, NaN is the
    largest value, groups with a null key or without values have no row.
    """
    keys, names = list(keys), list(probabilities)
    codes = materialise(values.where("value IS NOT NULL").select(
        *keys, ordered_code(F.col("value").cast("double")).alias("_code")), "codes")
    counts = [F.count("*").alias("_here"), F.min("_code").alias("_low"), F.max("_code").alias("_high")]
    position = lambda p: (F.col("_n") - 1) * F.lit(float(p))
    ranks = F.array(*[F.struct(F.lit(f"{x}_{end}").alias("_of"), near(position(p)).cast("long").alias("_rank"))
                      for x, p in probabilities.items() for end, near in enumerate((F.floor, F.ceil))])
    first = _placed(codes.groupBy(*keys, F.shiftright("_code", 48).alias("_bin")).agg(*counts), keys)
    first = first.withColumn("_n", F.sum("_here").over(Window.partitionBy(*keys)))
    holding = F.filter(ranks, lambda r: (r["_rank"] >= F.col("_from")) & (r["_rank"] < F.col("_from") + F.col("_here")))
    columns = [*keys, "_n", "_of", F.expr("_rank - _from").alias("_rank"), "_bin", "_low", "_high"]
    wanted = materialise(first.select("*", F.inline(holding)).select(*columns), "ranks")
    found = [wanted.where("_low = _high")]
    for shift in (32, 16, 0):
        wanted = wanted.where("_low < _high").drop("_low", "_high").withColumnRenamed("_bin", "_parent")
        if wanted.isEmpty():
            break
        inside = codes.withColumn("_parent", F.shiftright("_code", shift + 16)).join(
            wanted.select(*keys, "_parent").distinct(), [*keys, "_parent"])
        bins = _placed(inside.groupBy(*keys, "_parent", F.shiftright("_code", shift).alias("_bin")).agg(*counts), [*keys, "_parent"])
        held = bins.join(wanted, [*keys, "_parent"]).where("_rank >= _from AND _rank < _from + _here")
        wanted = materialise(held.select(*columns), "ranks")
        found.append(wanted.where("_low = _high"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    at = every.groupBy(*keys).agg(F.first("_n").alias("_n"), *[
        F.max(F.when(F.col("_of") == f"{x}_{end}", decoded(F.col("_low")))).alias(f"_{x}_{end}") for x in names for end in (0, 1)])
    between = lambda x, p: F.when(F.col(f"_{x}_0") == F.col(f"_{x}_1"), F.col(f"_{x}_0")).otherwise(
        F.col(f"_{x}_0") + (F.col(f"_{x}_1") - F.col(f"_{x}_0")) * (position(p) - F.floor(position(p))))
    return at.select(*keys, *[between(x, p).alias(x) for x, p in probabilities.items()])


def _placed(bins: DataFrame, within: list[str]) -> DataFrame:
    """``_from``: rows in earlier bins; at most 65,536 bins share a window."""
    before = Window.partitionBy(*within).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("_from", F.coalesce(F.sum("_here").over(before), F.lit(0)))


def _dealt(df: DataFrame) -> DataFrame:
    """``df``, over all tasks if it comes from fewer files than there are."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if 0 < len(df.inputFiles()) < tasks else df


def describe(df: DataFrame, keys: Sequence[str] = ("symbol",),
             columns: Sequence[str] = tuple(PRICES)) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column per group."""
    by = [*keys, "column"]
    rows = _dealt(df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]))
    moments = rows.groupBy(*keys).agg(*[F.struct(
        F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max")).alias(f"_{i}") for i, c in enumerate(columns)])
    moments = materialise(moments.select(*keys, F.inline(F.array(*[f"_{i}" for i in range(len(columns))]))).where("count > 0"), "moments")
    return moments.join(exact_percentiles(unpivot(rows, keys, columns), by, _QUARTILES), on=by)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column", "null_count")


def frame_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count and non-null count."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    places = F.create_map(*[F.lit(x) for i, name in enumerate(df.columns) for x in (name, i)])
    return counts.unpivot(["_rows"], df.columns, "column", "non_null").select(
        places[F.col("column")].alias("position"), "column", types[F.col("column")].alias("type"),
        F.col("_rows").alias("n_rows"), "non_null",
    )


def histogram(df: DataFrame, keys: Sequence[str] = ("symbol",),
              columns: Sequence[str] = tuple(PRICES), bins: int = 10) -> DataFrame:
    """Equal-width bins per group and column, empty bins included; the last bin is closed."""
    by = [*keys, "column"]
    values = unpivot(df, keys, columns)
    span = values.groupBy(*by).agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        *by,
        F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )
    span = materialise(span, "span")
    place = F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    counts = values.join(span, on=by).groupBy(*by, "lo", "hi").agg(
        F.array(*[F.count_if(place == i) for i in range(bins)]).alias("counts"))
    return (
        counts.select(*by, "lo", "hi", F.posexplode("counts").alias("bin", "count"))
        .withColumn("bin_start", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins)
        .drop("lo", "hi")
    )
