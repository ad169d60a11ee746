"""Indicators, labels and splits along candle series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from kandela.functions import indicators as ind
from kandela.operators.series import CHUNK_ROWS, chunk_window, last_rows, number_rows, over_series, rank_last
from kandela.schemas import FEATURE_COLUMNS, SERIES
from kandela.session import materialise

HORIZON = 10
THRESHOLD = 0.01
LOOK_BACK = 50
RSI_PERIOD = 14
MIN_ROWS = 300


def _indicators(df: DataFrame, w: WindowSpec) -> DataFrame:
    close = F.col("close")
    # The first differences come first so that the nested frames share one sort.
    steps = df.select(
        "*",
        ind.difference(close, w).alias("_delta"),
        ind.percent_change(close, w).alias("RET"),
    )
    return steps.select(
        "*",
        ind.rsi(F.col("_delta"), RSI_PERIOD, w).alias("RSI"),
        ind.rolling_mean(close, 10, w).alias("MA_10"),
        ind.rolling_mean(close, 50, w).alias("MA_50"),
        ind.rolling_std(close, 20, w).alias("STD_20"),
        ind.rolling_std(F.col("RET"), 10, w).alias("VOLAT"),
        *[F.lag(name, k).over(w).alias(f"{name}_lag{k}")
          for k in (1, 2, 3) for name in ("close", "volume")],
    ).drop("_delta")


def _label(df: DataFrame, w: WindowSpec, horizon: int, threshold: float) -> DataFrame:
    forward = df.withColumn("future_return", ind.forward_return(F.col("close"), horizon, w))
    return forward.withColumn("target", ind.three_way_label(F.col("future_return"), threshold))


def with_indicators(candles: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """All twelve indicator columns; warm-up rows keep NULLs."""
    return over_series(candles, _indicators, back=LOOK_BACK, chunk_rows=chunk_rows)


def features(candles: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The 17 model inputs, without rows whose frames are not full."""
    return with_indicators(candles, chunk_rows).na.drop(subset=FEATURE_COLUMNS)


def with_label(candles: DataFrame, horizon: int = HORIZON, threshold: float = THRESHOLD,
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``future_return`` and ``target`` (1 / 0 / NULL)."""
    return over_series(
        candles, lambda df, w: _label(df, w, horizon, threshold), ahead=horizon, chunk_rows=chunk_rows
    )


def labelled_rows(candles: DataFrame, horizon: int = HORIZON, threshold: float = THRESHOLD,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Candles with a label, stored: what follows reads them several times."""
    labelled = with_label(candles, horizon, threshold, chunk_rows).where("target IS NOT NULL")
    return materialise(labelled, "labelled")


def training_frame(candles: DataFrame, horizon: int = HORIZON, threshold: float = THRESHOLD,
                   label_first: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Features and label of every labelled candle.

    By default indicators see the whole series, as they do when serving, and unlabelled rows are
    dropped last; both come out of one pass. ``label_first`` drops them before the indicators.
    """
    if label_first:
        return features(labelled_rows(candles, horizon, threshold, chunk_rows), chunk_rows=chunk_rows)
    both = over_series(
        candles, lambda df, w: _label(_indicators(df, w), w, horizon, threshold),
        back=LOOK_BACK, ahead=horizon, chunk_rows=chunk_rows,
    )
    return both.na.drop(subset=[*FEATURE_COLUMNS, "target"])


def _split_column(rule: str) -> Column:
    """'train' or 'test' from rn and n; integer arithmetic keeps the border free of float rounding."""
    n = F.col("n")
    train_rows = n - F.floor((3 * n + 9) / 10) if rule == "ceil" else F.floor(7 * n / 10)
    return F.when(F.col("rn") <= train_rows, "train").otherwise("test")


def with_split(rows: DataFrame, rule: str = "ceil", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chronological 70/30 split: adds rn, n and split ('train' / 'test').

    ``ceil`` gives the test side ceil(0.3 n) rows; ``int`` gives the train side floor(0.7 n).
    """
    return number_rows(rows, chunk_rows=chunk_rows).withColumn("split", _split_column(rule))


def features_per_split(candles: DataFrame, horizon: int = HORIZON, threshold: float = THRESHOLD,
                       min_rows: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Label, keep labelled rows, split, then compute indicators afresh inside each split.

    Series with fewer than ``min_rows`` labelled rows are left out: see ``short_series``. Numbering, split and indicators
    share one pass over the labelled rows.
    """
    labelled = labelled_rows(candles, horizon, threshold, chunk_rows)
    if min_rows:
        labelled = enough_history(labelled, min_rows)

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        split = df.withColumn("split", _split_column("ceil"))
        return _indicators(split, chunk_window(SERIES, "open_time", "split"))

    rows = over_series(labelled, compute, back=LOOK_BACK, chunk_rows=chunk_rows, numbered=True)
    return rows.drop("rn", "n").na.drop(subset=FEATURE_COLUMNS)


def features_then_split(candles: DataFrame, horizon: int = HORIZON, threshold: float = THRESHOLD,
                        chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Indicators once over each whole series, then the first floor(0.7 n) rows as train."""
    frame = materialise(training_frame(candles, horizon, threshold, chunk_rows=chunk_rows), "frame")
    return with_split(frame, "int", chunk_rows)


def recent_features(candles: DataFrame, window: int = 60) -> DataFrame:
    """Features of the newest ``window`` candles of each series, computed from those alone.

    A series is at most ``window`` rows by then, so one plain window per series is enough.
    """
    in_order = Window.partitionBy(*SERIES).orderBy("open_time")
    return _indicators(last_rows(candles, window), in_order).na.drop(subset=FEATURE_COLUMNS)


def latest_features(candles: DataFrame, window: int = 60) -> DataFrame:
    """Feature row of the newest candle of each series, from its last ``window`` candles only."""
    return rank_last(recent_features(candles, window), 1)


def every_kth(candles: DataFrame, k: int = 5, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows 1, k+1, 2k+1, ... of each series."""
    numbered = number_rows(candles, chunk_rows=chunk_rows)
    return numbered.where(F.pmod(F.col("rn") - 1, F.lit(k)) == 0).drop("rn", "n")


def short_series(labelled: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Series with fewer than ``min_rows`` labelled rows, which training leaves out, with their count and a status."""
    counts = labelled.groupBy(*SERIES).agg(F.count("target").alias("n_rows"))
    return counts.where(F.col("n_rows") < min_rows).withColumn("status", F.lit("too few rows"))


def enough_history(rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Series with at least ``min_rows`` rows.

    Counts combine before the shuffle, and the stored list of series has an exact size, so the rows
    themselves are not shuffled by series.
    """
    large = rows.groupBy(*SERIES).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_rows)
    return rows.join(materialise(large.select(*SERIES), "large"), on=SERIES, how="left_semi")
