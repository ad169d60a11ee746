"""Model training, tuning, storing and scoring on a small separable series."""

import pytest
from pyspark.ml.classification import RandomForestClassifier

from kandela.operators import ml
from kandela.operators.features import features_per_split, short_series, with_label
from kandela.schemas import BACKTEST, PREDICTION, RUNS
from kandela.session import materialise, scratch_path


@pytest.fixture(scope="module")
def table(spark):
    from datetime import datetime, timedelta

    from kandela.schemas import CANDLE

    rows = []
    for symbol, shift in (("AAAUSDT", 0), ("BBBUSDT", 5)):
        for i in range(500):
            close = 100.0 + 20.0 * (((i + shift) // 15) % 2) + (i * 7 % 5)
            at = datetime(2024, 1, 1) + timedelta(hours=i)
            rows.append((symbol, "1h", at, close, close + 1, close - 1, close, float(i % 9), at + timedelta(minutes=59)))
    return ml.training_table(materialise(features_per_split(spark.createDataFrame(rows, CANDLE)), "features"))


def small_forest(rows=0):
    return RandomForestClassifier(numTrees=5, maxDepth=3, seed=1, labelCol="target", featuresCol="scaled", weightCol="weight")


def test_weights_balance_the_classes(table):
    train = table.where("split = 'train'").groupBy("symbol", "target").sum("weight").toPandas()
    for _, part in train.groupby("symbol"):
        assert part["sum(weight)"].iloc[0] == pytest.approx(part["sum(weight)"].iloc[1])


def test_fit_is_deterministic_and_probabilities_are_valid(table):
    data = ml.prepare(table, "AAAUSDT")
    rows = table.where("symbol = 'AAAUSDT' AND split = 'test'")
    runs = []
    for _ in range(2):
        scored = ml.score(ml.fit(data, small_forest), rows).orderBy("open_time").toPandas()
        assert scored["prob_buy"].between(0, 1).all()
        assert ((scored["prob_buy"] + scored["prob_sell"]) - 1).abs().max() < 1e-9
        runs.append(list(scored["prob_buy"]))
    assert runs[0] == runs[1] and len(runs[0]) == rows.count()


def test_saved_model_scores_the_same(table, spark):
    data = ml.prepare(table, "BBBUSDT")
    model = ml.fit(data, ml.logistic_regression)
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    rows = table.where("symbol = 'BBBUSDT'")
    a = ml.predictions(model, rows).orderBy("timestamp").collect()
    b = ml.predictions(ml.load_model(path), rows).orderBy("timestamp").collect()
    assert a == b and ml.predictions(model, rows).schema.names == PREDICTION.names
    assert {r.prediction for r in a} <= {"BUY", "SELL"}
    assert ml.backtest(model, rows).schema.names == BACKTEST.names


def test_scaled_train_rows_have_mean_zero(table):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    data = ml.prepare(table, "AAAUSDT")
    mean, std = data.train.select(vector_to_array("scaled")[3].alias("x")).agg(F.avg("x"), F.stddev_samp("x")).first()
    assert abs(mean) < 1e-9 and std == pytest.approx(1.0)


def test_draws_are_seeded_and_unique():
    grid = {"a": [1, 2, 3], "b": [4, 5], "c": [6, 7]}
    one, two = ml.draw_settings(grid, 5), ml.draw_settings(grid, 5)
    assert one == two and len({tuple(sorted(p.items())) for p in one}) == 5
    assert len(ml.draw_settings(grid, 50)) == 12


def test_grids_name_real_parameters():
    for name, grid in [*ml.SEARCH_GRIDS.items(), *ml.WIDE_GRIDS.items()]:
        estimator = ml.BASE_MODELS[name](10)
        for parameter in grid:
            assert estimator.hasParam(parameter)


def test_search_picks_one_of_the_drawn_settings(table):
    data = ml.prepare(table, "AAAUSDT")
    grid = {"numTrees": [2, 4], "maxDepth": [1, 3]}
    model, best = ml.random_search(data, small_forest, grid, draws=2, folds=2, parallelism=2)
    assert best in ml.draw_settings(grid, 2)
    assert model.stages[-1].getNumTrees == best["numTrees"]


def test_train_evaluate_and_log(table, spark):
    scored = ml.train_and_evaluate(table, {"Forest": small_forest})
    rows = {r.symbol: r for r in scored.collect()}
    assert set(rows) == {"AAAUSDT", "BBBUSDT"} and all(0 <= r.f1 <= 1 and r.n > 0 for r in rows.values())
    path = scratch_path(spark, "runs")
    ml.append_runs(ml.run_log(scored, 10, 0.01, "models"), path)
    ml.append_runs(ml.run_log(scored, 10, 0.05, "models"), path)
    log = ml.read_runs(spark, path)
    assert log.schema.names == RUNS.names and log.count() == 4


def test_symbols_without_model_say_so(table):
    model = ml.fit(ml.prepare(table, "AAAUSDT"), small_forest)
    scored = ml.score_each({"AAAUSDT": model})(table)
    assert scored.count() == table.count()
    got = {(r.symbol, r.status, r.prediction is None) for r in scored.select("symbol", "status", "prediction").distinct().collect()}
    assert got == {("AAAUSDT", "ok", False), ("BBBUSDT", "no model", True)}


def test_full_run_stores_logs_and_backtests_every_model(table, spark):
    from pyspark.ml.classification import DecisionTreeClassifier

    def stump(rows=0):
        return DecisionTreeClassifier(maxDepth=0, labelCol="target", featuresCol="scaled")

    cached = lambda: set(spark.sparkContext._jsc.getPersistentRDDs())
    root, before = scratch_path(spark, "run"), cached()
    search = {"RandomForest": {"numTrees": [2, 3], "maxDepth": [1, 2]}}
    log = ml.full_run(table, root, {"Forest": small_forest, "Stump": stump}, search, draws=2).collect()
    names = {"Forest_BASE", "Stump_BASE", "RandomForest_OPT"}
    assert {(r.symbol, r.model_type) for r in log} == {(s, n) for s in ("AAAUSDT", "BBBUSDT") for n in names}
    best = {s: max((r for r in log if r.symbol == s), key=lambda r: (r.f1, [-ord(c) for c in r.model_type])) for s in ("AAAUSDT", "BBBUSDT")}
    tests = {r.symbol: r["count"] for r in table.where("split = 'test'").groupBy("symbol").count().collect()}
    back = ml.read_backtest(spark, root)
    assert {r.symbol: r["count"] for r in back.groupBy("symbol").count().collect()} == tests
    for symbol, run in best.items():
        rows = table.where((table.symbol == symbol) & (table.split == "test"))
        again = ml.score(ml.load_model(run.artifact), rows).select("open_time", "prediction").collect()
        stored = back.where(back.symbol == symbol).select("datetime", "prediction").collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, stored))
    assert cached() <= before


def test_logistic_models_sit_at_their_optimum(table):
    data = ml.prepare(table, "AAAUSDT")
    assert ml.gradient_norm(ml.fit(data, ml.logistic_regression), data.train) < 1e-4
    assert ml.gradient_norm(ml.fit(data, lambda n: ml.logistic_regression(n).setMaxIter(0)), data.train) > 1e-2
    data.release()


def test_trees_do_not_depend_on_the_input_partitions(table):
    rows = table.where("split = 'test' AND symbol = 'AAAUSDT'")
    scored = []
    for parts in (2, 7):
        data = ml.prepare(table.repartition(parts), "AAAUSDT", tasks=2)
        scored.append(sorted(r.prob_buy for r in ml.score(ml.fit(data, small_forest), rows).collect()))
        data.release()
    assert scored[0] == pytest.approx(scored[1], abs=1e-12)


def test_no_series_with_enough_history_gives_no_rows(table):
    none = table.where("false")
    assert ml.train_and_evaluate(none, {"Forest": small_forest}).count() == 0
    assert ml.read_backtest(none.sparkSession, "/nowhere/at/all").count() == 0
    assert {r.status for r in ml.score_each({})(table).select("status").distinct().collect()} == {"no model"}


def test_short_series_are_left_out(spark, candles):
    rows = candles([100.0 + 20 * ((i // 15) % 2) + i % 5 for i in range(280)])
    assert features_per_split(rows, min_rows=300).count() == 0 < features_per_split(rows).count()
    (left,) = short_series(with_label(rows)).collect()
    assert (left.symbol, left.status) == ("AAAUSDT", "too few rows") and 0 < left.n_rows < 300


def test_a_row_without_a_symbol_answers_no_model(table):
    from pyspark.sql import functions as F

    model = ml.fit(ml.prepare(table, "AAAUSDT"), ml.logistic_regression)
    row = table.where("symbol = 'AAAUSDT'").limit(1)
    found = ml.score_each({"AAAUSDT": model})(row.unionByName(row.withColumn("symbol", F.lit(None).cast("string")))).collect()
    assert sorted((r.symbol or "", r.status) for r in found) == [("", "no model"), ("AAAUSDT", "ok")]


def test_every_fit_deals_its_rows_to_the_given_tasks(table, spark, monkeypatch):
    seen, whole = [], ml.fit

    def noting(data, make):
        seen.append(data.train.rdd.getNumPartitions())
        return whole(data, make)

    monkeypatch.setattr(ml, "fit", noting)
    ml.fit_each(table, small_forest)
    ml.train_and_evaluate(table, {"Forest": small_forest})
    assert ml.TRAIN_TASKS > 1 and seen == [ml.TRAIN_TASKS] * 4
    ml.fit_each(table, small_forest, tasks=3)
    ml.full_run(table, scratch_path(spark, "run"), {"Forest": small_forest}, tasks=3)
    assert seen[4:] == [3] * 4


def test_models_grown_together_take_no_job_per_symbol(table, spark, monkeypatch):
    def looped(*_):
        raise AssertionError("a loop over symbols")

    monkeypatch.setattr(ml, "symbols_of", looped)
    root, search = scratch_path(spark, "run"), {"RandomForest": {"numTrees": [2, 3], "maxDepth": [1, 2]}}
    log = ml.full_run(table, root, {"LogisticRegression": ml.BASE_MODELS["LogisticRegression"]}, search, draws=2).collect()
    assert {(r.symbol, r.model_type) for r in log} == {
        (s, m) for s in ("AAAUSDT", "BBBUSDT") for m in ("LogisticRegression_BASE", "RandomForest_OPT")}
    for run in log:
        assert run.artifact == f"{root}/models/{run.symbol}/{run.model_type}"
        model = ml.load_model(run.artifact)
        assert {r.symbol for r in model.select("symbol").collect()} == {run.symbol}
        rows = table.where((table.symbol == run.symbol) & (table.split == "test"))
        scored = ml.score(model, rows).select("prediction", "target").collect()
        assert sum(r.prediction == r.target for r in scored) / rows.count() == pytest.approx(run.accuracy)
    tests = table.where("split = 'test'").groupBy("symbol").count().collect()
    back = ml.read_backtest(spark, root).groupBy("symbol").count().collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, tests))
