"""Logistic regressions of all symbols together: against MLlib, their optimum, storage, plans and odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kandela.operators import logistic, ml
from kandela.schemas import FEATURE_COLUMNS, PREDICTION
from kandela.session import scratch_path

SYMBOLS = ["AAA", "BBB", "CCC"]


def rows_of(symbols, n=160, seed=3):
    """Rows with 17 features of different size; the classes overlap."""
    draw, rows = np.random.default_rng(seed), []
    for s, symbol in enumerate(symbols):
        x = draw.normal(size=(n, len(FEATURE_COLUMNS))) * np.logspace(-3, 3, len(FEATURE_COLUMNS)) + s
        chance = 1 / (1 + np.exp(-(draw.normal(size=n) + (x[:, 3] - s) / np.logspace(-3, 3, 17)[3] - (x[:, 9] - s) / np.logspace(-3, 3, 17)[9])))
        y = (chance > 0.4).astype(int)
        for i in range(n):
            rows.append((symbol, i, int(y[i]), 1.0 + 0.5 * int(y[i]), "train" if i < n * 0.7 else "test", *map(float, x[i])))
    return rows


def frame(spark, rows):
    schema = "symbol string, open_time long, target int, weight double, split string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, schema).withColumn("close_time", F.timestamp_seconds("open_time")).withColumn("_other", F.lit("x"))


@pytest.fixture(scope="module")
def table(spark):
    return frame(spark, rows_of(SYMBOLS)).repartition(5)


@pytest.fixture(scope="module")
def models(table):
    return logistic.fit(table.where("split = 'train'"))


def test_coefficients_equal_a_plain_newton_solver(table, models):
    for model in models.collect():
        part = table.where((F.col("symbol") == model.symbol) & (F.col("split") == "train")).toPandas()
        x = part[FEATURE_COLUMNS].to_numpy()
        x = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0, ddof=1)])
        y, w, penalty = part["target"].to_numpy(), part["weight"].to_numpy(), np.array([0.0] + [1 / len(x)] * 17)
        beta = np.zeros(18)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ beta))
            g = x.T @ (w * (p - y)) / w.sum() + penalty * beta
            beta = beta - np.linalg.solve((x.T * (w * p * (1 - p))) @ x / w.sum() + np.diag(penalty), g)
        assert [model.intercept, *model.coefficients] == pytest.approx(list(beta), abs=1e-7)
        assert model.rows == len(x) and model.gradient <= logistic.TOLERANCE


def test_gradient_vanishes_at_the_models_and_nowhere_else(table, models):
    train = table.where("split = 'train'")
    assert max(r.gradient for r in logistic.gradients(train, models).collect()) < 1e-8
    moved = models.withColumn("intercept", F.col("intercept") + 0.5)
    assert min(r.gradient for r in logistic.gradients(train, moved).collect()) > 1e-2


def test_probabilities_equal_those_of_mllib(spark, table):
    train = table.where("split = 'train' AND symbol = 'AAA'")
    data = ml.prepare(train.unionByName(table.where("split = 'test' AND symbol = 'AAA'")), "AAA", 2)
    pipeline = ml.fit(data, lambda n: ml.logistic_regression(n).setTol(1e-13))
    rows = table.where("symbol = 'AAA'")
    key = lambda r: r.open_time
    theirs = sorted(ml.score(pipeline, rows).collect(), key=key)
    same = sorted(ml.score(logistic.from_pipelines(spark, {"AAA": pipeline}), rows).collect(), key=key)
    ours = sorted(ml.score(logistic.fit(train), rows).collect(), key=key)
    assert len(theirs) == len(same) == len(ours) > 100
    for a, b, c in zip(theirs, same, ours):
        assert b.prob_buy == pytest.approx(a.prob_buy, abs=1e-12) and b.prediction == a.prediction
        assert c.prob_buy == pytest.approx(a.prob_buy, abs=1e-4)
    data.release()


def test_stored_models_come_back_as_they_were(spark, table, models):
    path = scratch_path(spark, "logistic")
    logistic.save(models, path)
    stages = logistic.read_stages(spark, path).collect()
    assert sorted((r.symbol, r.position) for r in stages) == [(s, i) for s in SYMBOLS for i in range(3)]
    assert {tuple(r.inputs) for r in stages} == {tuple(FEATURE_COLUMNS)}
    order = lambda m: [(r.symbol, r.intercept, r.coefficients, r.means, r.deviations, r.rows) for r in m.orderBy("symbol").collect()]
    assert order(logistic.load(spark, path)) == order(models)


def test_models_of_other_inputs_are_refused(spark, models):
    path = scratch_path(spark, "logistic")
    logistic.save(models, path)
    other = logistic.read_stages(spark, path).withColumn("inputs", F.reverse("inputs"))
    other.write.parquet(f"{path}-other")
    with pytest.raises(Exception, match="other inputs"):
        logistic.load(spark, f"{path}-other").collect()


def test_plan_and_jobs_do_not_grow_with_the_symbols(spark, models):
    def plan(n):
        many = models.limit(1).crossJoin(spark.range(n).select(F.concat(F.lit("S"), "id").alias("name"))).withColumn("symbol", F.col("name"))
        many.select(models.columns).write.parquet(path := scratch_path(spark, "many"))
        stored = spark.read.parquet(path)
        scored = ml.score_each(stored)(frame(spark, rows_of(["S1"], 20)))
        return len(scored._jdf.queryExecution().optimizedPlan().toString().splitlines())

    def jobs(n):
        context, group = spark.sparkContext, f"fit-{n}"
        context.setJobGroup(group, group)
        try:
            found = logistic.fit(frame(spark, rows_of([f"S{i}" for i in range(n)], 60)), rounds=3)
            assert found.count() == n
            return len(context.statusTracker().getJobIdsForGroup(group))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    assert plan(5) == plan(500)
    assert abs(jobs(2) - jobs(40)) <= 3  # a stage may end early; not 20 times as many


def test_each_row_gets_an_answer(spark, table, models):
    kept = models.where("symbol <> 'CCC'")
    rows = table.unionByName(table.limit(1).withColumn("symbol", F.lit(None).cast("string")))
    rows = rows.unionByName(table.where("symbol = 'AAA'").limit(1).withColumn("RSI", F.lit(None).cast("double")))
    found = ml.score_each(kept)(rows)
    assert found.schema.names == PREDICTION.names and found.count() == rows.count()
    got = {(r.symbol, r.status): r["count"] for r in found.groupBy("symbol", "status").count().collect()}
    assert got == {("AAA", "ok"): 160, ("BBB", "ok"): 160, ("CCC", "no model"): 160, (None, "no model"): 1, ("AAA", "incomplete"): 1}
    assert found.where("status <> 'ok' AND (prediction IS NOT NULL OR prob_buy IS NOT NULL)").count() == 0


def test_odd_series(spark):
    whole = rows_of(["ONE", "FLAT", "NAN", "TWICE"], 60)
    rows = []
    for r in whole:
        if r[0] == "ONE":  # one class only
            r = (r[0], r[1], 1, *r[3:])
        if r[0] == "FLAT":  # a constant feature
            r = (*r[:5], 7.0, *r[6:])
        rows += [r, r] if r[0] == "TWICE" else [r]
    broken = [("NAN", 100, 1, 1.0, "train", float("nan"), *[1.0] * 16), ("NAN", 101, 0, 1.0, "train", float("inf"), *[1.0] * 16),
              ("NAN", 102, None, 1.0, "train", *[1.0] * 17), (None, 103, 1, 1.0, "train", *[1.0] * 17),
              ("ZERO", 104, 1, 0.0, "train", *[1.0] * 17)]
    found = {r.symbol: r for r in logistic.fit(frame(spark, rows + broken)).collect()}
    clean = {r.symbol: r for r in logistic.fit(frame(spark, rows)).collect()}
    assert set(found) == {"ONE", "FLAT", "NAN", "TWICE"} and all(r.gradient <= logistic.TOLERANCE for r in found.values())
    assert found["ONE"].intercept > 10 and abs(found["FLAT"].coefficients[0]) < 1e-12
    assert found["NAN"].coefficients == pytest.approx(clean["NAN"].coefficients, abs=1e-9) and found["NAN"].rows == 60
    assert found["TWICE"].rows == 120
    assert logistic.fit(frame(spark, rows).where("false")).count() == 0


def test_partitions_do_not_change_the_models(spark, table, models):
    train = table.where("split = 'train'")
    again = {r.symbol: r for r in logistic.fit(train.repartition(1)).collect()}
    for r in models.collect():
        assert again[r.symbol].coefficients == pytest.approx(r.coefficients, abs=1e-9)


def test_sums_are_handed_on_before_a_task_holds_too_many(spark, table, models, monkeypatch):
    monkeypatch.setattr(logistic, "SYMBOLS_PER_PART", 1)
    again = {r.symbol: r for r in logistic.fit(table.where("split = 'train'")).collect()}
    for r in models.collect():
        assert again[r.symbol].coefficients == pytest.approx(r.coefficients, abs=1e-9)


def test_full_run_fits_logistic_models_together(spark, table):
    root = scratch_path(spark, "run")
    table = table.withColumn("interval", F.lit("1h"))
    log = ml.full_run(table, root, {"LogisticRegression": ml.logistic_regression}).collect()
    assert {(r.symbol, r.model_type) for r in log} == {(s, "LogisticRegression_BASE") for s in SYMBOLS}
    assert all(r.accuracy > 0.6 for r in log)
    run = next(r for r in log if r.symbol == "BBB")
    rows = table.where("symbol = 'BBB' AND split = 'test'")
    assert ml.score(ml.load_model(run.artifact), rows).count() == rows.count()
