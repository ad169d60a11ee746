"""Profiles, drift, evaluation and metric queries."""

from datetime import datetime, timedelta
from itertools import combinations
from math import comb
from time import perf_counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kandela.operators import drift, evaluate as ev, metrics as mt, profile as pr


def test_exact_percentiles_with_ties_and_outliers(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=900), np.full(600, 0.25), [1e12, -1e12], rng.integers(0, 5, 500)])
    df = spark.createDataFrame([("a", float(x)) for x in values] + [("b", 1.0)], "g string, value double")
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in pr.exact_percentiles(df, ["g"], wanted).collect()}
    for name, p in wanted.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p))
        assert got["b"][name] == 1.0


def test_codes_keep_order_and_value(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2047 << 52, 4000).view(np.float64)
    powers = np.array([m * 2.0 ** e for e in range(-1074, 1024) for m in (1.0, 1 - 2.0 ** -53, 1 + 2.0 ** -52)])
    edges = np.array([0.0, np.inf, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308])
    values = np.concatenate([bits, -bits, powers, -powers, edges, -edges])
    df = spark.createDataFrame(pd.DataFrame({"value": values})).select("value", pr.ordered_code(F.col("value")).alias("code"))
    got = df.select("value", "code", pr.decoded(F.col("code")).alias("back")).toPandas()
    assert (got.back == got.value).all()
    plain = np.abs(got.value.to_numpy()).view(np.int64)
    assert (got.code == np.where(got.value < 0, -plain, plain)).all()
    nan = spark.createDataFrame([(float("nan"),)], "value double").select(pr.ordered_code(F.col("value")).alias("code"))
    assert nan.first().code > got.code.max() and np.isnan(nan.select(pr.decoded(F.col("code"))).first()[0])


def test_percentiles_of_odd_values(spark):
    """NaN is the largest value, infinities count, nulls do not; a third of group "h" is one value; bits differ late in "l"."""
    rng = np.random.default_rng(5)
    inf, nan = float("inf"), float("nan")
    rows = {"o": [nan, inf, -inf, 0.0, -0.0, 1.0, 2.0, -3.0], "h": [7.5] * 500 + list(rng.lognormal(0, 40, 1000)),
            "l": list(1.0 + np.arange(999) * 2.0 ** -52), "e": [-inf] * 3, "t": [3.0, 3.0, 4.0, 4.0]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in rows.items() for x in xs] + [("o", None), ("none", None)], "g string, value double")
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    got = {r.g: r for r in pr.exact_percentiles(df.repartition(5), ["g"], wanted).collect()}
    assert got.keys() == rows.keys()
    for g in ("h", "l", "t"):
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(rows[g], p), rel=1e-15)
    assert got["o"].p0 == -inf and got["o"].p50 == 0.5 and np.isnan(got["o"].p100) and got["e"].p50 == -inf
    assert pr.exact_percentiles(df.limit(0), ["g"], wanted).count() == 0


def test_describe_matches_pandas(spark, candles):
    rows = candles([float((i * 31) % 17) for i in range(50)])
    got = {r["column"]: r for r in pr.describe(rows).collect()}
    want = rows.toPandas()[["open", "high", "low", "close", "volume"]].describe()
    for column in want.columns:
        for mine, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert got[column][mine] == pytest.approx(want[column][theirs])


def test_histogram_matches_numpy(spark, candles):
    closes = [float((i * 31) % 17) for i in range(50)]
    got = pr.histogram(candles(closes), columns=["close"]).orderBy("bin").collect()
    counts, edges = np.histogram(closes, bins=10)
    assert [r["count"] for r in got] == list(counts)
    assert [r.bin_start for r in got] == pytest.approx(list(edges[:-1]))
    flat = pr.histogram(candles([3.0] * 4), columns=["close"]).orderBy("bin").collect()
    assert [r["count"] for r in flat] == list(np.histogram([3.0] * 4, bins=10)[0])


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert {r["column"]: r.null_count for r in pr.null_counts(df).collect()} == {"a": 0, "b": 1}
    rows = pr.frame_profile(df).orderBy("position").collect()
    assert [(r["column"], r.type, r.n_rows, r.non_null) for r in rows] == [("a", "int", 2, 2), ("b", "string", 2, 1)]


def whole_lattice_ks_p(n, m, gap):
    """The same sum over every cell of every diagonal."""
    inside, reached = {0: 1.0}, 0.0
    for k in range(n + m):
        moved = {}
        for i, p in inside.items():
            for to, free in ((i + 1, n - i), (i, m - k + i)):
                moved[to] = moved.get(to, 0.0) + p * free / (n + m - k)
        out = {i for i in moved if abs(i * m - (k + 1 - i) * n) >= gap}
        reached += sum(moved[i] for i in out)
        inside = {i: p for i, p in moved.items() if i not in out and p}
    return min(reached, 1.0)


@pytest.mark.parametrize("n, m", [(1, 1), (1, 9), (9, 1), (12, 12), (17, 31), (40, 25), (60, 7)])
def test_band_equals_the_whole_lattice(n, m):
    for gap in {1, 2, n, m, n + m, n * m // 5, n * m // 3, n * m // 2, n * m - 1, n * m}:
        if 0 < gap <= n * m:
            assert drift.exact_ks_p(n, m, gap) == pytest.approx(whole_lattice_ks_p(n, m, gap), rel=1e-13)


def test_band_of_large_samples_is_quick():
    n, d = 20_000, 0.0163
    started = perf_counter()
    p = drift.exact_ks_p(n, n, round(d * n * n))
    assert perf_counter() - started < 5
    assert p == pytest.approx(2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * d * d * n / 2) for j in range(1, 9)), rel=0.05) and 0.005 < p < 0.02


def brute_force_ks_p(n, m, d):
    hits = 0
    for chosen in combinations(range(n + m), n):
        i = j = 0
        top = 0.0
        for k in range(n + m):
            if k in chosen:
                i += 1
            else:
                j += 1
            top = max(top, abs(i / n - j / m))
        hits += top >= d - 1e-12
    return hits / comb(n + m, n)


@pytest.mark.parametrize("n,m", [(1, 1), (5, 3), (6, 4), (4, 4), (7, 2)])
def test_exact_ks_p_by_brute_force(n, m):
    for step in range(n * m + 1):
        d = step / (n * m)
        assert drift.exact_ks_p(n, m, step) == pytest.approx(brute_force_ks_p(n, m, d), rel=1e-13)


def test_exact_p_is_symmetric_and_near_the_limit_for_large_samples():
    gap = round(0.4 * 951 * 11)
    assert drift.exact_ks_p(951, 11, gap) == pytest.approx(drift.exact_ks_p(11, 951, gap), rel=1e-10)
    lam = 0.05 * np.sqrt(2000 * 2000 / 4000)
    limit = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert drift.exact_ks_p(2000, 2000, round(0.05 * 2000 * 2000)) == pytest.approx(limit, rel=0.05)


def test_ks_statistic_with_ties(spark):
    history, recent = [1.0, 1.0, 2.0, 3.0, 5.0], [1.0, 4.0, 4.0]
    rows = [("A", "1h", "f", "history", x) for x in history] + [("A", "1h", "f", "recent", x) for x in recent]
    samples = spark.createDataFrame(rows, "symbol string, interval string, feature string, sample string, value double")
    got = drift.with_p_value(drift.ks_statistic(samples)).first()
    points = sorted(set(history + recent))
    want = max(abs(np.mean(np.array(history) <= x) - np.mean(np.array(recent) <= x)) for x in points)
    assert got.ks_stat == pytest.approx(want) and (got.n_history, got.n_recent) == (5, 3)
    assert got.p_value == pytest.approx(brute_force_ks_p(5, 3, want), abs=1e-9)


def test_ks_statistic_over_many_ranges(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for feature, shift in (("f", 0.0), ("g", 0.4)):
        history, recent = rng.normal(size=700).round(2), (rng.normal(size=300) + shift).round(2)
        rows += [("A", "1h", feature, "history", float(x)) for x in history] + [("A", "1h", feature, "recent", float(x)) for x in recent]
        want[feature] = max(abs((history <= x).mean() - (recent <= x).mean()) for x in np.concatenate([history, recent]))
    samples = spark.createDataFrame(rows, "symbol string, interval string, feature string, sample string, value double")
    got = {r.feature: (r.ks_stat, r.n_history, r.n_recent) for r in drift.ks_statistic(samples).collect()}
    assert got == {f: (pytest.approx(d), 700, 300) for f, d in want.items()}


def test_no_distance_means_p_one(spark):
    rows = [("A", "1h", "f", side, float(x)) for side in ("history", "recent") for x in range(4)]
    samples = spark.createDataFrame(rows, "symbol string, interval string, feature string, sample string, value double")
    tested = drift.with_p_value(drift.ks_statistic(samples))
    row = tested.first()
    assert row.ks_stat == 0 and row.p_value == 1 and row.p_asymptotic == 1
    verdict = drift.drift_verdict(tested, samples).first()
    assert verdict.drift_detected is False and (verdict.status, verdict.metric, verdict.window) == ("ok", "ks_2samp", 60)


def test_drift_of_a_shifted_series(spark, candles):
    walk = [100 + (i * 7 % 13) for i in range(400)]
    calm = candles([float(x) for x in walk])
    jumped = candles([float(x) + (300 if i >= 340 else 0) for i, x in enumerate(walk)])
    samples = drift.drift_samples(calm, jumped)
    assert drift.drift_verdict(drift.with_p_value(drift.ks_statistic(samples)), calm).first().drift_detected


def test_tiny_p_values_keep_their_digits():
    """The largest distance has one path on either side; far distances differ by many orders."""
    assert drift.exact_ks_p(9, 7, 63) == pytest.approx(2 / comb(16, 7), rel=1e-13)
    assert drift.exact_ks_p(951, 60, 951 * 60) == pytest.approx(2 / comb(1011, 60), rel=1e-10)
    assert drift.exact_ks_p(951, 60, round(0.9 * 951 * 60)) < 1e-10 * drift.exact_ks_p(951, 60, round(0.75 * 951 * 60))


def test_small_prices_keep_their_distance(spark):
    rng = np.random.default_rng(5)
    history, recent = rng.normal(2e-8, 1e-9, 400), rng.normal(2.1e-8, 1e-9, 60)
    rows = [("A", "1h", "f", "history", float(x)) for x in history] + [("A", "1h", "f", "recent", float(x)) for x in recent]
    samples = spark.createDataFrame(rows, "symbol string, interval string, feature string, sample string, value double")
    cut = samples.withColumn("value", drift.significant(F.col("value")))
    points = np.concatenate([history, recent])
    want = max(abs((history <= x).mean() - (recent <= x).mean()) for x in points)
    assert drift.ks_statistic(cut).first().ks_stat == pytest.approx(want, abs=1e-12)
    odd = spark.createDataFrame([(0.0,), (-1.5,), (float("inf"),), (123456789012.0,)], "v double").select(drift.significant(F.col("v")).alias("v"))
    assert [r.v for r in odd.collect()] == pytest.approx([0.0, -1.5, float("inf"), 123456789000.0], rel=1e-14)


def test_the_method_is_the_callers_choice(spark):
    rows = [("A", "1h", "f", side, float(x + 3 * (side == "recent"))) for side in ("history", "recent") for x in range(9)]
    samples = spark.createDataFrame(rows, "symbol string, interval string, feature string, sample string, value double")
    stats = drift.ks_statistic(samples)
    exact, rough = (drift.with_p_value(stats, m).first() for m in ("exact", "asymptotic"))
    assert exact.p_value == pytest.approx(brute_force_ks_p(9, 9, 1 / 3)) and rough.p_value == rough.p_asymptotic != exact.p_value
    with pytest.raises(ValueError):
        drift.with_p_value(stats, "auto")


def test_series_without_enough_rows_say_so(spark, candles):
    both = candles([100.0 + i * 7 % 13 for i in range(200)]).unionByName(candles([1.0] * 20, "SHORTUSDT"))
    tested = drift.with_p_value(drift.ks_statistic(drift.drift_samples(both, both)))
    got = {r.symbol: (r.status, r.n_features, r.drift_detected) for r in drift.drift_verdict(tested, both).collect()}
    assert got["SHORTUSDT"] == ("too few rows", 0, None) and got["AAAUSDT"][:2] == ("ok", 17)


def test_scores_and_best_model(spark):
    rows = [("A", "m1", 1, 1), ("A", "m1", 0, 1), ("A", "m1", 1, 0), ("A", "m1", 0, 0), ("A", "m2", 1, 1), ("A", "m2", 0, 0),
            ("B", "m1", 0, 0), ("B", "m2", 0, 0)]
    scored = ev.scores(spark.createDataFrame(rows, "symbol string, model string, target int, prediction int"), "symbol", "model")
    got = {(r.symbol, r.model): (r.accuracy, r.f1) for r in scored.collect()}
    assert got[("A", "m1")] == (0.5, 0.5) and got[("A", "m2")] == (1.0, 1.0) and got[("B", "m1")] == (1.0, 0.0)
    assert {r.symbol: r.model for r in ev.best_model(scored).collect()} == {"A": "m2", "B": "m1"}


def test_class_weights(spark):
    rows = [("A", "1h", 1)] * 3 + [("A", "1h", 0)] * 1
    got = {r.target: r for r in ev.class_weights(spark.createDataFrame(rows, "symbol string, interval string, target int")).collect()}
    assert got[1].weight == pytest.approx(4 / 6) and got[0].weight == pytest.approx(2.0)
    assert got[1].pos_weight_usual == pytest.approx(1 / 3) and got[1].pos_weight_balanced == pytest.approx(3.0)


def test_standardise_uses_train_rows_only(spark):
    rows = [("A", "1h", "train", 1.0, 7.0), ("A", "1h", "train", 3.0, 7.0), ("A", "1h", "test", 5.0, 8.0)]
    df = spark.createDataFrame(rows, "symbol string, interval string, split string, x double, c double")
    got = ev.standardise(df, ["x", "c"]).where("split = 'test'").first()
    assert got.x == 3.0 and got.c == 1.0


T0 = datetime(2024, 1, 1)


SAMPLES = "instance string, ts timestamp, value double"


def test_counter_rate_of_one_per_second_is_one(spark):
    """Scraped every 15 seconds, one-minute windows: steps over window edges count."""
    rows = [("a", T0 + timedelta(seconds=15 * i), 15.0 * i) for i in range(4 * 30)]
    got = mt.counter_rate(spark.createDataFrame(rows, SAMPLES), ["instance"], 60).orderBy("window_start").collect()
    assert len(got) == 30 and got[0].rate == pytest.approx(0.75) and {round(r.rate, 9) for r in got[1:]} == {1.0}
    busy = mt.utilisation(mt.counter_rate(spark.createDataFrame(rows, SAMPLES), ["instance"], 60)).orderBy("window_start").collect()
    assert all(abs(r.utilisation) < 1e-9 for r in busy[1:])


def test_counter_rate_with_reset_and_jittered_scrapes(spark):
    values = [10, 20, 30, 5, 15, 25]
    rows = [("a", T0 + timedelta(seconds=10 * i + i % 3), float(v)) for i, v in enumerate(values)]
    got = mt.counter_rate(spark.createDataFrame(rows, SAMPLES), ["instance"], 60).collect()
    assert len(got) == 1 and got[0].rate == pytest.approx((10 + 10 + 5 + 10 + 10) / 60)


def test_every_sample_counts_however_close(spark):
    """A reset between two close scrapes: 100 up, restart, 20 up, 120 more."""
    rows = [("a", T0, 0.0), ("a", T0 + timedelta(seconds=14), 100.0), ("a", T0 + timedelta(seconds=15), 20.0),
            ("a", T0 + timedelta(seconds=16), 140.0), ("a", T0 + timedelta(seconds=16), 139.0)]
    got = mt.counter_rate(spark.createDataFrame(rows, SAMPLES), ["instance"], 60).collect()
    assert len(got) == 1 and got[0].rate * 60 == pytest.approx(100 + 20 + 120)


def test_single_sample_has_no_rate(spark):
    assert mt.counter_rate(spark.createDataFrame([("a", T0, 5.0)], SAMPLES), ["instance"], 60).count() == 0


def test_histogram_quantile_interpolates(spark):
    rows = [(T0, 1.0, 10.0), (T0, 2.0, 90.0), (T0, float("inf"), 100.0)]
    df = spark.createDataFrame(rows, "window_start timestamp, le double, rate double")
    assert mt.histogram_quantile(df, 0.5).first()["quantile"] == pytest.approx(1 + 40 / 80)
    assert mt.histogram_quantile(df, 0.05).first()["quantile"] == pytest.approx(0.5)
    assert mt.histogram_quantile(df, 0.95).first()["quantile"] == pytest.approx(2.0)


def test_gauges_and_active_series(spark):
    rows = [("t", T0, 8.0), ("v", T0, 3.0), ("t", T0 + timedelta(hours=1), 9.0)]
    got = mt.gauge_difference(spark.createDataFrame(rows, "name string, ts timestamp, value double").withColumn("i", F.lit("x")), "t", "v", ["i"]).collect()
    assert [(r.ts, r.difference) for r in got] == [(T0, 5.0)]
    seen = spark.createDataFrame([("a", T0), ("a", T0), ("b", T0), ("a", T0 + timedelta(hours=2))], "c string, ts timestamp")
    assert [r.active for r in mt.active_series(seen, ["c"], 3600).orderBy("window_start").collect()] == [2, 1]


def _counter(spark, seconds_and_values):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([("a", start + timedelta(seconds=t), float(v)) for t, v in seconds_and_values], "g string, ts timestamp, value double")


def _by_second(rows, value):
    return {int((r["at"] - datetime(2024, 1, 1)).total_seconds()): r[value] for r in rows}


def test_sliding_rate_by_hand(spark):
    """Scrapes every 15 s with a restart at 45 s, windows of 60 s each 30 s; then a gap, then two late samples."""
    rows = [(0, 100), (15, 115), (30, 130), (45, 6), (60, 21), (300, 30), (315, 90)]
    got = _by_second(mt.sliding_rate(_counter(spark, rows), ["g"], 60, 30).collect(), "rate")
    # at: increase * (covered + start + end) / covered / 60. A start edge 30 s away counts for half a distance.
    assert got.pop(30) == pytest.approx(30 * (30 + 7.5 + 0) / 30 / 60)  # 0..30; the window opens 30 s before
    assert got.pop(60) == pytest.approx(36 * (45 + 15 + 0) / 45 / 60)  # 15..60, as 0 s is outside; 15 + 6 + 15
    assert got.pop(90) == pytest.approx(15 * (15 + 6 / 15 * 15 + 7.5) / 15 / 60)  # 45, 60; zero is 6 s back, nearer than the edge
    assert got.pop(330) == pytest.approx(60 * (15 + 7.5 + 15) / 15 / 60)  # 300, 315
    assert got == {}  # at 0, 120, 300 and 360 a window holds one sample, its start being open


def test_sliding_rate_of_flat_single_and_repeated_samples(spark):
    flat = _by_second(mt.sliding_rate(_counter(spark, [(0, 5), (0, 3), (20, 5)]), ["g"], 60, 60).collect(), "rate")
    assert flat == {}  # at 0 one time, at 60 only the sample of 20 s
    flat = _by_second(mt.sliding_rate(_counter(spark, [(1, 5), (1, 3), (21, 5)]), ["g"], 60, 60).collect(), "rate")
    assert flat == {60: 0.0}
    assert mt.sliding_rate(_counter(spark, [(7, 1)]), ["g"], 60, 15).count() == 0
    assert mt.sliding_rate(_counter(spark, [(7, 1), (8, 2)]), ["g"], 1, 30).count() == 0  # no evaluation time sees both


def test_value_at_is_stale_after_a_while(spark):
    got = _by_second(mt.value_at(_counter(spark, [(0, 1), (50, 2), (50, 3), (700, 4)]), ["g"], 60).collect(), "value")
    assert got == {0: 1.0, **{t: 3.0 for t in (60, 120, 180, 240, 300)}, **{t: 4.0 for t in (720, 780, 840, 900, 960)}}
