"""Registered machine-learning queries (M3-M11, K9, K10).

What the input fixes is compared with SQL: symbols, models, row counts, times, names. What a fit decides is checked as
far as it must hold: scores in their range, probabilities that add up, the gradient at the optimum.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kandela.operators import evaluate as ev, logistic, ml
from kandela.operators.features import HORIZON, MIN_ROWS, THRESHOLD, features_per_split, short_series, training_frame, with_label
from kandela.operators.store import path_exists
from kandela.plans.registry import BASE, COMPLETE_SQL, features_sql, label_sql, query
from kandela.plans.window_queries import _SPLIT
from kandela.session import materialise, scratch_path
from kandela.sources import tables as tb

_ENOUGH = f"""{BASE}, {label_sql()}, enough AS (SELECT * FROM labelled WHERE target IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY symbol, "interval") >= {MIN_ROWS})"""
_KEPT = f"""{_ENOUGH}, {_SPLIT.replace("labelled WHERE target IS NOT NULL", "enough")},
  {features_sql("split_rows", 'symbol, "interval", split')}, kept AS (SELECT * FROM feat WHERE {COMPLETE_SQL}),
  tests AS (SELECT symbol, count(*) AS n FROM kept WHERE split = 'test' GROUP BY symbol)"""


def _names_sql(names) -> str:
    return f"(SELECT unnest({list(names)}) AS model)"


_FEATURES: dict[tuple[str, str], tuple[str, object]] = {}


def split_features(spark, folder):
    """Weighted features per split of the series with enough history, stored once per session and folder for all fits."""
    key = spark.sparkContext.applicationId, folder
    if key not in _FEATURES or not path_exists(spark, _FEATURES[key][0]):
        path = scratch_path(spark, "split-features")
        candles = tb.stored_event_candles(spark, folder)
        table = ml.training_table(materialise(features_per_split(candles, min_rows=MIN_ROWS), "features"))
        table.hint("rebalance", "symbol").write.partitionBy("symbol").parquet(path)
        _FEATURES[key] = path, table.schema
    path, schema = _FEATURES[key]
    return spark.read.schema(schema).parquet(path)


def _in_range(scored):
    """Scores without their fitted digits: whether both lie between 0 and 1."""
    valid = lambda c: F.col(c).between(0, 1).alias(f"{c}_valid")
    return scored.select("symbol", "model", "n", valid("accuracy"), valid("f1"))


def _scores_sql(*names: str) -> str:
    return f"""{_KEPT} SELECT symbol, model, n, true AS accuracy_valid, true AS f1_valid FROM tests, {_names_sql(names)}"""


def logistic_models(table):
    """Logistic models of all symbols from a training table."""
    return logistic.fit(table.where("split = 'train'"))


@query("m3_logistic_regression", _scores_sql("LogisticRegression_BASE"))
def logistic_regression(spark, folder):
    table = split_features(spark, folder)
    scored = logistic.score(table.where("split = 'test'").drop("weight"), logistic_models(table))
    return _in_range(ev.scores(scored.withColumn("model", F.lit("LogisticRegression_BASE")), "symbol", "model"))


@query("m3_optimum", f"{_KEPT} SELECT symbol, true AS at_optimum FROM tests")
def logistic_optimum(spark, folder):
    """The loss's gradient at every fitted logistic model is zero to within 1e-7, computed anew from the train rows."""
    table = split_features(spark, folder)
    found = logistic.gradients(table.where("split = 'train'"), logistic_models(table))
    return found.select("symbol", (F.col("gradient") < 1e-7).alias("at_optimum"))


_PROBABILITIES = "true AS valid"


def _checked(scored):
    """Predictions without their fitted digits: probabilities that add up to 1 and a name that follows them."""
    buy, sell = F.col("prob_buy"), F.col("prob_sell")
    named = F.when(F.col("prediction") == "BUY", buy >= sell).otherwise(sell >= buy)
    return scored.select("symbol", "timestamp", "status", (buy.between(0, 1) & (F.abs(buy + sell - 1) < 1e-9) & named).alias("valid"))


@query("m9_score", f"""{_KEPT} SELECT symbol, close_time AS "timestamp", 'ok' AS status, {_PROBABILITIES} FROM kept WHERE split = 'test'""")
def score(spark, folder):
    rows = split_features(spark, folder)
    return _checked(ml.score_each(logistic_models(rows))(rows.where("split = 'test'")))


@query("m11_reload_and_score", f"""{_KEPT}, {features_sql(prefix="all_")}, {label_sql("all_feat", name="all_labelled").replace("fwd", "all_fwd")}
  SELECT symbol, close_time AS "timestamp", 'ok' AS status, {_PROBABILITIES} FROM all_labelled
  WHERE target IS NOT NULL AND {COMPLETE_SQL} AND symbol IN (SELECT symbol FROM tests)
  UNION ALL SELECT symbol, close_time, 'no model', NULL FROM all_labelled
  WHERE target IS NOT NULL AND {COMPLETE_SQL} AND symbol NOT IN (SELECT symbol FROM tests)""")
def reload_and_score(spark, folder):
    """Save the models, load them again and score every labelled candle; symbols without a model say so."""
    candles = tb.stored_event_candles(spark, folder)
    rows = ml.training_table(materialise(features_per_split(candles, min_rows=MIN_ROWS), "features"))
    everything = materialise(training_frame(candles), "training")
    path = scratch_path(spark, "models")
    logistic.save(logistic_models(rows), path)
    return _checked(ml.score_each(logistic.load(spark, path))(everything))


@query("m8_left_out", f"""{BASE}, {label_sql()} SELECT symbol, "interval", count(target) AS n_rows, 'too few rows' AS status
  FROM labelled GROUP BY ALL HAVING count(target) < 1500""")
def left_out(spark, folder):
    """Series that a run asking for 1,500 labelled rows leaves out, as rows with a status."""
    return short_series(with_label(tb.stored_event_candles(spark, folder)), 1500)


@query("k9_model_sink", f"""{_KEPT} SELECT symbol, unnest([0, 1, 2]) AS position,
  unnest(['VectorAssembler', 'StandardScalerModel', 'LogisticRegressionModel']) AS stage FROM tests""")
def model_sink(spark, folder):
    """Stages of every stored model, read from where they are kept."""
    path = scratch_path(spark, "models")
    logistic.save(logistic_models(split_features(spark, folder)), path)
    return logistic.read_stages(spark, path).select("symbol", "position", "stage")


# The long fits come last. The run is made in parts, each once per session and folder, and the queries read what they left.

PARTS = {
    "base": (["LogisticRegression", "RandomForest"], []), "boosted-a": (["BoostedTreesA"], []),
    "boosted-b": (["BoostedTreesB"], []), "tuned": ([], ["RandomForest", "BoostedTreesA", "BoostedTreesB"])}
RUN_NAMES = [f"{name}_BASE" for models, _ in PARTS.values() for name in models] + [
    f"{name}_OPT" for _, tuned in PARTS.values() for name in tuned]
_ROOTS: dict[tuple[str, str, str], str] = {}


def run_part(spark, folder, part):
    """Root folder of one part of the run; a tuned family takes ten draws with three folds."""
    key = spark.sparkContext.applicationId, folder, part
    if key not in _ROOTS or not path_exists(spark, f"{_ROOTS[key]}/runs"):
        root, (models, tuned) = scratch_path(spark, "run"), PARTS[part]
        log = ml.full_run(
            split_features(spark, folder), root, {name: ml.BASE_MODELS[name] for name in models},
            {name: ml.SEARCH_GRIDS[name] for name in tuned}, horizon=HORIZON, threshold=THRESHOLD)
        ml.append_runs(log, f"{root}/runs")
        _ROOTS[key] = root
    return _ROOTS[key]


def _part_scores(spark, folder, part):
    return ml.read_scores(spark, run_part(spark, folder, part))


def whole_log(spark, folder):
    """Every run of every symbol, read from the stored logs."""
    log = None
    for part in PARTS:
        rows = ml.read_runs(spark, f"{run_part(spark, folder, part)}/runs")
        log = rows if log is None else log.unionByName(rows)
    return log


@query("m4_random_forest", _scores_sql("RandomForest_BASE"))
def random_forest(spark, folder):
    return _in_range(_part_scores(spark, folder, "base").where("model = 'RandomForest_BASE'"))


@query("m5_boosted_trees_a", _scores_sql("BoostedTreesA_BASE"))
def boosted_trees_a(spark, folder):
    return _in_range(_part_scores(spark, folder, "boosted-a"))


@query("m6_boosted_trees_b", _scores_sql("BoostedTreesB_BASE"))
def boosted_trees_b(spark, folder):
    return _in_range(_part_scores(spark, folder, "boosted-b"))


@query("m7_random_search", _scores_sql(*[f"{name}_OPT" for name in PARTS["tuned"][1]]))
def random_search(spark, folder):
    """Ten drawn settings of each tree family per symbol with three time folds each, the best refitted."""
    return _in_range(_part_scores(spark, folder, "tuned"))


@query("k10_run_log", f"""{_KEPT} SELECT symbol || '_' || model AS run_name, symbol, model AS model_type, {HORIZON} AS horizon,
  {THRESHOLD}::DOUBLE AS threshold, true AS accuracy_valid, true AS f1_valid, 'models/' || symbol || '/' || model AS artifact
  FROM tests, {_names_sql(RUN_NAMES)}""")
def run_log(spark, folder):
    """Every run of every symbol with the place of its stored model."""
    valid = lambda c: F.col(c).between(0, 1).alias(f"{c}_valid")
    return whole_log(spark, folder).select(
        "run_name", "symbol", "model_type", "horizon", "threshold", valid("accuracy"), valid("f1"),
        F.regexp_extract("artifact", r"models/.*$", 0).alias("artifact"))


@query("m8_per_symbol_training", f"{_KEPT} SELECT symbol, true AS is_best, true AS known FROM tests")
def per_symbol_training(spark, folder):
    """The best model of every symbol is one of the run's and has its highest F1."""
    scored = materialise(whole_log(spark, folder).withColumnRenamed("model_type", "model"), "log")
    top = scored.groupBy("symbol").agg(F.max("f1").alias("top"))
    return ev.best_model(scored).join(top, on="symbol").select(
        "symbol", (F.col("f1") == F.col("top")).alias("is_best"), F.col("model").isin(*RUN_NAMES).alias("known"))


@query("m10_backtest_export", f"""{_KEPT} SELECT symbol, open_time AS datetime, round(close, 6) AS close, target, true AS valid
  FROM kept WHERE split = 'test'""")
def backtest_export(spark, folder):
    """One CSV folder per symbol with the test rows scored by the best model of the whole run, loaded from its place."""
    root = scratch_path(spark, "backtests")
    ml.export_backtests(split_features(spark, folder), whole_log(spark, folder), root)
    sane = F.col("proba").between(0, 1) & F.col("prediction").isin(0, 1)
    return ml.read_backtest(spark, root).select("symbol", "datetime", "close", "target", sane.alias("valid"))
