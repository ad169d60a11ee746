"""Chunked series computing equals plain windows."""

import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from kandela.operators import features as ft
from kandela.operators.series import bucket_table, last_rows, number_rows, over_series
from kandela.schemas import FEATURE_COLUMNS, SERIES


def gappy(candles, seed=1):
    rng = random.Random(seed)
    walk = np.round(100 + np.cumsum([rng.uniform(-1, 1) for _ in range(700)]), 2).tolist()
    dense = candles(walk, "AAAUSDT")
    holes = candles(walk[:400], "BBBUSDT", skip={i for i in range(400) if rng.random() < 0.7})
    far = candles(walk[:60], "BBBUSDT", interval="1d")
    lone = candles([5.0], "CCCUSDT")
    return dense.unionByName(holes).unionByName(far).unionByName(lone)


def small_bucket():
    return F.floor(F.unix_seconds("open_time") / (3 * 3600))


@pytest.mark.parametrize("chunk_rows", [1, 3, 10, 64, 5000])
def test_over_series_equals_plain_window(candles, chunk_rows):
    rows = gappy(candles)

    def compute(df, w):
        return df.select(
            "*", F.sum("close").over(w.rowsBetween(-20, 0)).alias("s"), F.lag("close", 20).over(w).alias("b"),
            F.lead("close", 7).over(w).alias("f"), F.count("*").over(w.rowsBetween(-20, 7)).alias("c"))

    plain = compute(rows, Window.partitionBy(*SERIES).orderBy("open_time"))
    chunked = over_series(rows, compute, back=20, ahead=7, bucket=small_bucket(), chunk_rows=chunk_rows)
    key = [*SERIES, "open_time"]
    a = plain.toPandas().sort_values(key).reset_index(drop=True)
    b = chunked.select(*plain.columns).toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def test_chunks_are_bounded_and_copies_stay_near_edges(candles):
    rows = gappy(candles).where("symbol = 'AAAUSDT'")
    table = bucket_table(rows, SERIES, small_bucket(), 50, 20, 7)
    joined = rows.withColumn("_bucket", small_bucket()).join(table, on=[*SERIES, "_bucket"])
    sizes = joined.select(F.explode("_targets").alias("c")).groupBy("c").count().toPandas()
    assert len(sizes) == 14
    assert sizes["count"].max() <= 50 + 3 + 20 + 7 + 2 * 3  # chunk, one bucket, both edges in whole buckets


def test_number_rows(candles):
    rows = gappy(candles)
    got = number_rows(rows, bucket=small_bucket(), chunk_rows=10).toPandas()
    for _, part in got.groupby(SERIES):
        part = part.sort_values("open_time")
        assert list(part["rn"]) == list(range(1, len(part) + 1))
        assert set(part["n"]) == {len(part)}


def test_features_equal_pandas(candles):
    rows = gappy(candles, seed=5)
    got = ft.features(rows, chunk_rows=40).toPandas()
    for key, part in rows.toPandas().groupby(SERIES):
        df = part.sort_values("open_time").reset_index(drop=True)
        step = df["close"].diff()
        up, down = step.clip(lower=0).rolling(14).mean(), (-step.clip(upper=0)).rolling(14).mean()
        df["RSI"] = 100 - 100 / (1 + up / down)
        df["MA_10"], df["MA_50"] = df["close"].rolling(10).mean(), df["close"].rolling(50).mean()
        df["STD_20"], df["RET"] = df["close"].rolling(20).std(), df["close"].pct_change()
        df["VOLAT"] = df["RET"].rolling(10).std()
        for k in (1, 2, 3):
            df[f"close_lag{k}"], df[f"volume_lag{k}"] = df["close"].shift(k), df["volume"].shift(k)
        want = df.dropna().sort_values("open_time").reset_index(drop=True)
        mine = got[(got.symbol == key[0]) & (got.interval == key[1])].sort_values("open_time").reset_index(drop=True)
        pd.testing.assert_frame_equal(mine[FEATURE_COLUMNS], want[FEATURE_COLUMNS], rtol=1e-7, atol=1e-7)


def test_no_feature_sees_the_future(candles):
    walk = [100 + (i * 7 % 13) for i in range(200)]
    base = ft.features(candles([float(x) for x in walk]), chunk_rows=30)
    changed = ft.features(candles([float(x) for x in walk[:120]] + [500.0 + i for i in range(80)]), chunk_rows=30)
    cut = F.col("open_time") < F.lit(datetime(2024, 1, 6))  # row 120 opens on the 6th
    a = base.where(cut).select("open_time", *FEATURE_COLUMNS).orderBy("open_time").collect()
    b = changed.where(cut).select("open_time", *FEATURE_COLUMNS).orderBy("open_time").collect()
    assert len(a) == 71 and a == b


def test_labels_do_not_cross_series(candles):
    rows = candles([1.0] * 15, "AAAUSDT").unionByName(candles([9.0] * 15, "BBBUSDT"))
    got = ft.with_label(rows).where("future_return IS NOT NULL").toPandas()
    assert len(got) == 10 and (got["future_return"] == 0).all() and got["target"].isna().all()


def test_label_borders(candles):
    closes = [100.0] * 10 + [101.0, 99.0, 101.5, 98.5] + [100.0] * 6
    got = ft.with_label(candles(closes), threshold=0.01).orderBy("open_time").limit(4).toPandas()
    # +-1 % exactly (up to the rounding of the division) is no signal; beyond it is
    assert got["target"].iloc[2] == 1 and got["target"].iloc[3] == 0
    exact = ft.with_label(candles([1.0] * 10 + [1.5, 0.5]), threshold=0.5).orderBy("open_time").limit(2).toPandas()
    assert exact["target"].isna().all()


def test_flat_rising_short_and_zero_price(candles):
    flat = ft.with_indicators(candles([5.0] * 60)).orderBy("open_time").toPandas()
    assert flat["RSI"].isna().all() and flat["STD_20"].iloc[-1] == 0
    rising = ft.with_indicators(candles([float(i + 1) for i in range(60)])).orderBy("open_time").toPandas()
    assert rising["RSI"].iloc[13:14].isna().all() and (rising["RSI"].iloc[14:] == 100).all()
    assert ft.features(candles([float(i + 1) for i in range(49)])).count() == 0
    assert ft.features(candles([float(i + 1) for i in range(50)])).count() == 1
    zero = ft.with_indicators(candles([1.0, 0.0, 2.0])).orderBy("open_time").toPandas()
    assert zero["RET"].iloc[1] == -1 and np.isnan(zero["RET"].iloc[2])


@pytest.mark.parametrize("n", [1, 3, 10, 33, 330, 340])
def test_split_sizes(candles, n):
    rows = candles([float(i) for i in range(n)])
    by_ceil = ft.with_split(rows, chunk_rows=7).groupBy("split").count().toPandas().set_index("split")["count"]
    assert by_ceil.get("test", 0) == -(-3 * n // 10) and by_ceil.sum() == n
    by_int = ft.with_split(rows, rule="int", chunk_rows=7).where("split = 'train'").count()
    assert by_int == 7 * n // 10


def test_every_kth_and_last_rows(candles):
    rows = candles([float(i) for i in range(23)])
    assert [r.volume for r in ft.every_kth(rows, 5, chunk_rows=4).orderBy("open_time").collect()] == [0, 5, 10, 15, 20]
    assert [r.volume for r in last_rows(rows, 3).orderBy("open_time").collect()] == [20, 21, 22]


def test_latest_features_use_sixty_rows_only(candles):
    rows = candles([100 + (i * 7 % 13) for i in range(100)])
    newest = ft.latest_features(rows).collect()
    whole = ft.features(rows).orderBy(F.col("open_time").desc()).first()
    assert len(newest) == 1
    for name in FEATURE_COLUMNS:
        assert newest[0][name] == pytest.approx(whole[name])


def test_enough_history(candles):
    rows = candles([1.0] * 300, "AAAUSDT").unionByName(candles([1.0] * 299, "BBBUSDT"))
    assert {r.symbol for r in ft.enough_history(rows).select("symbol").distinct().collect()} == {"AAAUSDT"}


def test_label_first_skips_flat_rows(candles):
    closes = [100.0 + (5 * (i % 3) if (i // 20) % 2 else 0) for i in range(200)]
    rows = candles(closes)
    first = ft.training_frame(rows, label_first=True, chunk_rows=16).count()
    last = ft.training_frame(rows, chunk_rows=16).count()
    assert 0 < first < last


def test_results_do_not_depend_on_broadcast(spark, candles):
    """Above the broadcast threshold the bucket table is joined by sort-merge."""
    rows = gappy(candles, seed=9)
    small = ft.features(rows, chunk_rows=50).orderBy("symbol", "interval", "open_time").collect()
    newest = sorted(last_rows(rows, 30).collect())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = ft.features(rows, chunk_rows=50)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert large.orderBy("symbol", "interval", "open_time").collect() == small
        assert sorted(last_rows(rows, 30).collect()) == newest
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_features_once_then_split(candles):
    closes = [100.0 + (i * 7 % 13) for i in range(200)]
    got = ft.features_then_split(candles(closes), chunk_rows=20).groupBy("split").count().toPandas()
    sizes = got.set_index("split")["count"]
    assert sizes["train"] == 7 * sizes.sum() // 10
