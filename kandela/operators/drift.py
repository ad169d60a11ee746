"""Feature drift: two-sample Kolmogorov-Smirnov between history and the newest candles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from kandela.operators.features import recent_features
from kandela.schemas import FEATURE_COLUMNS, SERIES
from kandela.session import materialise

ALPHA = 0.05
SIGNIFICANT_DIGITS = 10


def significant(value: Column, digits: int = SIGNIFICANT_DIGITS) -> Column:
    """``value`` to ``digits`` significant decimal digits, whatever its size; 0, NaN and infinity stay."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))))
    return F.when((value == 0) | F.isnan(value) | (F.abs(value) == float("inf")), value).otherwise(
        F.round(value / unit, digits - 1) * unit)


def drift_samples(history: DataFrame, recent: DataFrame, history_rows: int = 1000,
                  window: int = 60) -> DataFrame:
    """(symbol, interval, feature, sample, value) of the newest candles on both sides.

    Both sides are cut to a fixed number of rows per series before any feature is computed. Values are
    cut to ten significant digits, so a candle present on both sides ties with itself however a
    rolling sum was rounded, and small prices keep their differences.
    """
    sides = []
    for name, candles, rows in (("history", history, history_rows), ("recent", recent, window)):
        side = recent_features(candles, rows).withColumn("sample", F.lit(name))
        long = side.unpivot([*SERIES, "sample"], FEATURE_COLUMNS, "feature", "value")
        sides.append(long.withColumn("value", significant(F.col("value"))))
    return sides[0].unionByName(sides[1])


def ks_statistic(samples: DataFrame) -> DataFrame:
    """Largest distance of the two empirical distributions per series and feature.

    Ties are summed per value before accumulating. Values are range-partitioned within their feature and accumulated
    range by range, so a sample of any size spreads over the tasks.
    """
    by = [*SERIES, "feature"]
    per_value = samples.groupBy(*by, "value").agg(
        F.count_if(F.col("sample") == "history").alias("h"),
        F.count_if(F.col("sample") == "recent").alias("r"),
    )
    parts = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(per_value.repartitionByRange(parts, *by, "value").withColumn("_range", F.spark_partition_id()), "ks-ranges")
    sums = ranged.groupBy(*by, "_range").agg(F.sum("h").alias("rh"), F.sum("r").alias("rr"))  # one row per feature and range
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by, "_range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in ("rh", "rr")],
        F.sum("rh").over(whole).alias("n_history"), F.sum("rr").over(whole).alias("n_recent"),
    ).where("n_history > 0 AND n_recent > 0")
    upto = Window.partitionBy(*by, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    distances = (
        ranged.select(*by, "_range", F.sum("h").over(upto).alias("ch"), F.sum("r").over(upto).alias("cr"))
        .join(offsets, on=[*by, "_range"])
    )
    history = (F.col("ch") + F.col("before_rh")) / F.col("n_history")
    recent = (F.col("cr") + F.col("before_rr")) / F.col("n_recent")
    return distances.groupBy(*by, "n_history", "n_recent").agg(F.max(F.abs(history - recent)).alias("ks_stat"))


def with_asymptotic_p(stats: DataFrame, terms: int = 100) -> DataFrame:
    """P-value of the limiting Kolmogorov distribution; rough when a side has few rows."""
    n, m = F.col("n_history"), F.col("n_recent")
    lam = F.col("ks_stat") * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # Below 0.2 the probability is 1 to within 1e-12 and the alternating sum has not settled.
    return stats.withColumn(
        "p_asymptotic", F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    )


def exact_ks_p(n: int, m: int, gap: int) -> float:
    """P(D >= gap / (n * m)) for sample sizes n and m without ties.

    A random order of both samples is a grid path from (0, 0) to (n, m). The probability that it ever
    reaches the distance is summed over the first cells that do, diagonal by diagonal; nothing is
    subtracted, so small probabilities keep their digits. Only the cells nearer than the distance are carried: about
    2 * gap / (n + m) of a diagonal.
    """
    if gap <= 0:
        return 1.0
    both, low, reached = n + m, 0, 0.0
    inside = np.ones(1)  # cells (i, k - i) from i = low on that are nearer than the distance
    for k in range(both):
        i = np.arange(low, low + len(inside))
        left = float(both - k)
        moved = np.zeros(len(inside) + 1)
        moved[1:] = inside * ((n - i) / left)
        moved[:-1] += inside * ((m - k + i) / left)
        # |i * m - (k + 1 - i) * n| < gap holds from the first of these to the second.
        first = max(((k + 1) * n - gap) // both + 1, low)
        last = min(-((-(k + 1) * n - gap) // both) - 1, low + len(inside))
        reached += float(moved[:max(first - low, 0)].sum() + moved[max(last + 1, first) - low:].sum())
        inside, low = moved[first - low:last + 1 - low], first
        if not len(inside):
            break
    return min(reached, 1.0)


def _exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(p_value=[
            exact_ks_p(int(n), int(m), int(gap)) for n, m, gap in zip(frame["n_history"], frame["n_recent"], frame["gap"])])


def with_p_value(stats: DataFrame, method: str = "exact") -> DataFrame:
    """``p_value`` by the caller's choice of method, never by size.

    "exact" counts grid paths: n + m diagonals of the cells nearer than the distance, once for each different pair of
    sizes and distance. "asymptotic" is the limit formula.
    """
    both = with_asymptotic_p(stats)
    if method == "asymptotic":
        return both.withColumn("p_value", F.col("p_asymptotic"))
    if method != "exact":
        raise ValueError("method is 'exact' or 'asymptotic'")
    # The distance is a multiple of 1/(n*m), so it has a whole number that says it exactly.
    case = ["n_history", "n_recent", "gap"]
    cases = materialise(both.withColumn("gap", F.round(F.col("ks_stat") * F.col("n_history") * F.col("n_recent")).cast("long")), "ks")
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in case], T.StructField("p_value", T.DoubleType())])
    solved = cases.select(*case).distinct().mapInPandas(_exact, schema)
    return cases.join(materialise(solved, "ks-p"), on=case).drop("gap")


def drift_verdict(tested: DataFrame, series: DataFrame, p_column: str = "p_value", alpha: float = ALPHA,
                  window: int = 60) -> DataFrame:
    """Whether any feature has a p-value below ``alpha``, for every series asked for.

    A series without enough complete rows on either side answers with the status "too few rows" and no
    verdict. ``metric`` and ``window`` say what was compared.
    """
    found = tested.groupBy(*SERIES).agg(
        F.bool_or(F.col(p_column) < alpha).alias("drift_detected"),
        F.count("*").alias("n_features"),
    )
    asked = series.select(*SERIES).distinct()
    return asked.join(found, on=SERIES, how="left").select(
        *SERIES, F.when(F.col("n_features").isNull(), "too few rows").otherwise("ok").alias("status"),
        "drift_detected", F.coalesce("n_features", F.lit(0)).cast("long").alias("n_features"),
        F.lit("ks_2samp").alias("metric"), F.lit(window).alias("window"))
