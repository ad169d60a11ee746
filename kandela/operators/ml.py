"""Per-symbol classifiers with Spark MLlib: train, tune, evaluate, store, score."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kandela.functions.scalars import signal_name
from kandela.operators import boosting, forests, logistic
from kandela.operators.evaluate import best_model, scores, with_row_weights
from kandela.operators.series import number_rows
from kandela.operators.store import path_exists
from kandela.schemas import BACKTEST, FEATURE_COLUMNS, PREDICTION, RUNS, SCORES, conform
from kandela.session import materialise, scratch_path

SEED = 42
TRAIN_TASKS = 4  # fixed value: partitions of one symbol's train rows in every registered fit
_COLUMNS = {"labelCol": "target", "featuresCol": "scaled", "weightCol": "weight"}


def logistic_regression(rows: int) -> LogisticRegression:
    """L2 with unit inverse strength: with weights that sum to ``rows`` the penalty is 1/rows."""
    return LogisticRegression(maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False, **_COLUMNS)


def random_forest(rows: int = 0) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=150, maxDepth=6, featureSubsetStrategy="sqrt", seed=SEED, **_COLUMNS)


def boosted_trees_a(rows: int = 0) -> GBTClassifier:
    return GBTClassifier(
        maxIter=150, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        seed=SEED, **_COLUMNS)


def boosted_trees_b(rows: int = 0) -> GBTClassifier:
    return GBTClassifier(
        maxIter=200, maxDepth=5, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        seed=SEED, **_COLUMNS)


BASE_MODELS: dict[str, Callable[[int], Estimator]] = {
    "LogisticRegression": logistic_regression,
    "RandomForest": random_forest,
    "BoostedTreesA": boosted_trees_a,
    "BoostedTreesB": boosted_trees_b,
}

GROWN_TREES, GROWN_LOGISTIC = "grown/trees", "grown/logistic"  # tables of a run's models that were made for all symbols together
LOGISTIC = "LogisticRegression"  # its base model is fitted for all symbols together (operators/logistic.py)

# Families that are grown for all symbols together (operators/forests.py, boosting.py) instead of fitted one by one: how, the
# base model, and what a point of a grid means.
TOGETHER = {
    "RandomForest": (forests.FOREST, forests.Fit(trees=150, depth=6), forests.as_fit),
    "BoostedTreesA": (boosting.BOOSTED, boosting.Boost(trees=150, depth=4), boosting.as_fit),
    "BoostedTreesB": (boosting.BOOSTED, boosting.Boost(trees=200, depth=5), boosting.as_fit),
}

# Search grids per model family. MLlib names differ from the source system's libraries: the least
# number of rows per leaf (minInstancesPerNode) stands for the least number of rows per split, with values of its
# own, and the number of leaves of the second boosted family has no counterpart and is left out.
SEARCH_GRIDS: dict[str, dict[str, list]] = {
    "RandomForest": {
        "numTrees": [100, 200, 300], "maxDepth": [3, 5, 6, 8], "minInstancesPerNode": [1, 2],
        "featureSubsetStrategy": ["sqrt", "log2"],
    },
    "BoostedTreesA": {
        "maxIter": [100, 200], "maxDepth": [3, 4, 5], "stepSize": [0.01, 0.05],
        "subsamplingRate": [0.7, 0.8], "featureSubsetStrategy": ["0.7", "0.8"],
    },
    "BoostedTreesB": {
        "maxIter": [100, 200], "maxDepth": [3, 5], "stepSize": [0.01, 0.05],
        "subsamplingRate": [0.7, 0.8], "featureSubsetStrategy": ["0.7", "0.8"],
    },
}

# The wider grids of the second experiment; depth 30 stands for no limit.
WIDE_GRIDS: dict[str, dict[str, list]] = {
    "RandomForest": {
        "numTrees": [100, 300, 500], "maxDepth": [5, 10, 15, 30], "minInstancesPerNode": [1, 2, 5],
        "featureSubsetStrategy": ["sqrt", "log2"],
    },
    "BoostedTreesA": {
        "maxIter": [200, 400], "maxDepth": [3, 5, 8], "stepSize": [0.01, 0.05, 0.1],
        "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.8", "1.0"],
    },
    "BoostedTreesB": {
        "maxIter": [200, 400], "maxDepth": [3, 6, 9, 30], "stepSize": [0.01, 0.05, 0.1],
        "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.8", "1.0"],
    },
}


@dataclass
class Prepared:
    """One symbol's scaled train and test rows and the fitted stages that made them."""

    symbol: str
    train: DataFrame
    test: DataFrame
    stages: list
    train_rows: int

    def release(self) -> None:
        self.train.unpersist()


def training_table(split_rows: DataFrame) -> DataFrame:
    """Feature rows with class weights, stored once, one folder per symbol.

    Rows are dealt by symbol before they are written, a hot symbol to several tasks, so files do not multiply tasks by symbols. Train rows get the balanced weight of their class, test rows weight 1.
    """
    train = with_row_weights(split_rows.where("split = 'train'"))
    test = split_rows.where("split = 'test'").withColumn("weight", F.lit(1.0))
    return materialise(train.unionByName(test).hint("rebalance", "symbol"), "training", partition_by=["symbol"])


def prepare(table: DataFrame, symbol: str, tasks: int = 1) -> Prepared:
    """Scale one symbol of a training table; the scaler is fitted on its train rows.

    ``tasks`` is a model parameter: MLlib draws bags and subsamples per partition, so rows are dealt to that
    many partitions by a hash of their time, and the fitted trees do not depend on the cluster. The scaled train rows
    are kept for the fits that follow, until ``release``; a lost block is recomputed from the stored table.
    """
    rows = table.where(F.col("symbol") == symbol)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="vector")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="vector", outputCol="scaled")
    assembled = assembler.transform(train.repartition(tasks, "open_time").sortWithinPartitions("open_time"))
    fitted = scaler.fit(assembled)
    scaled = fitted.transform(assembled).persist()
    return Prepared(symbol, scaled, fitted.transform(assembler.transform(test)), [assembler, fitted], scaled.count())


def fit(prepared: Prepared, make: Callable[[int], Estimator]) -> PipelineModel:
    """Assembler, scaler and classifier as one model that scores raw feature rows."""
    model = make(prepared.train_rows).fit(prepared.train)
    return PipelineModel([*prepared.stages, model])


def draw_settings(grid: Mapping[str, Sequence], draws: int, seed: int = SEED) -> list[dict]:
    """A seeded choice of grid points without repeats; the whole grid when it is smaller."""
    names = sorted(grid)
    points = [dict(zip(names, values)) for values in product(*(grid[n] for n in names))]
    return points if len(points) <= draws else random.Random(seed).sample(points, draws)


def random_search(prepared: Prepared, make: Callable[[int], Estimator], grid: Mapping[str, Sequence],
                  draws: int = 10, folds: int = 3, parallelism: int = 4) -> tuple[PipelineModel, dict]:
    """Best of ``draws`` settings by cross-validated F1 of class 1, refitted on all train rows.

    Folds are blocks of time rather than random rows.
    """
    estimator = make(prepared.train_rows)
    settings = draw_settings(grid, draws)
    maps = [{estimator.getParam(name): value for name, value in point.items()} for point in settings]
    rows = number_rows(prepared.train).withColumn(
        "fold", F.least(F.floor((F.col("rn") - 1) * folds / F.col("n")), F.lit(folds - 1)).cast("int"))
    evaluator = MulticlassClassificationEvaluator(
        labelCol="target", metricName="fMeasureByLabel", metricLabel=1.0)
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
        foldCol="fold", parallelism=parallelism, seed=SEED)
    rows = rows.persist()
    found = search.fit(rows)
    rows.unpersist()
    best = settings[max(range(len(settings)), key=lambda i: found.avgMetrics[i])]
    return PipelineModel([*prepared.stages, found.bestModel]), best


def score(model: PipelineModel | DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with the predicted class and both probabilities; a forest is a table of nodes, a logistic model one of coefficients."""
    if isinstance(model, DataFrame):
        return forests.score(rows, model).drop("model") if "node" in model.columns else logistic.score(rows, model)
    scored = model.transform(rows)
    chance = vector_to_array("probability")
    return scored.select(
        *rows.columns, F.col("prediction").cast("int").alias("prediction"),
        chance[1].alias("prob_buy"), chance[0].alias("prob_sell"),
    )


def predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Scored rows as the service answers them."""
    return conform(
        score(model, rows).select(
            "symbol", signal_name(F.col("prediction")).alias("prediction"), "prob_buy", "prob_sell",
            F.col("close_time").alias("timestamp"), F.lit("ok").alias("status")),
        PREDICTION,
    )


def score_each(models: Mapping[str, PipelineModel] | DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A scorer that sends each symbol's rows to its own model; rows of other symbols answer "no model".

    Logistic models as a table (``logistic.MODELS``) meet the rows in one join, so the plan is the same for any number of symbols;
    rows with a missing feature then answer "incomplete". MLlib models add a branch of the plan for each.
    """
    if isinstance(models, DataFrame):
        return lambda rows: _score_by_table(rows, models)

    def run(rows: DataFrame) -> DataFrame:
        parts = [predictions(model, rows.where(F.col("symbol") == symbol)) for symbol, model in models.items()]
        others = rows.where(~F.coalesce(F.col("symbol").isin(*models), F.lit(False))) if models else rows  # a null symbol too
        none = others.select("symbol", F.col("close_time").alias("timestamp"), F.lit("no model").alias("status"),
                             *[F.lit(None).alias(c) for c in ("prediction", "prob_buy", "prob_sell")])
        return _union([*parts, none], rows.sparkSession, PREDICTION)

    return run


def _score_by_table(rows: DataFrame, models: DataFrame) -> DataFrame:
    scored = logistic.with_models(rows, models, "left").withColumn("prob_buy", logistic.chance_of_one())
    buy, known = F.col("prob_buy"), F.col("_model").isNotNull()
    return conform(
        scored.select(
            "symbol", F.when(buy.isNotNull(), signal_name((buy > 0.5).cast("int"))).alias("prediction"), "prob_buy",
            (1 - buy).alias("prob_sell"), F.col("close_time").alias("timestamp"),
            F.when(~known, "no model").when(buy.isNull(), "incomplete").otherwise("ok").alias("status")),
        PREDICTION,
    )


def backtest(model: PipelineModel | DataFrame, test: DataFrame) -> DataFrame:
    return _backtest_rows(score(model, test))


def _backtest_rows(scored: DataFrame, *more: str) -> DataFrame:
    """Scored rows as a backtest keeps them, with the columns named in ``more`` at the end."""
    rows = scored.select(
        F.col("open_time").alias("datetime"), "close", "target", "prediction", F.col("prob_buy").alias("proba"), *more)
    return conform(rows, T.StructType([*BACKTEST.fields, *[scored.schema[c] for c in more]]))


def evaluate(model: PipelineModel, test: DataFrame, symbol: str, name: str) -> DataFrame:
    plain = test.drop("vector", "scaled", "weight")
    return scores(score(model, plain), "symbol").select(
        F.lit(symbol).alias("symbol"), F.lit(name).alias("model"), "n", "accuracy", "f1")


def symbols_of(rows: DataFrame) -> list[str]:
    """The distinct symbols; the one small list that comes to the driver, to loop over fits."""
    return [r.symbol for r in rows.select("symbol").distinct().orderBy("symbol").collect()]


def per_symbol(rows: DataFrame, work: Callable[[str], object], parallelism: int = 8) -> list:
    """Run ``work(symbol)`` for every symbol, several at a time; each fit is a distributed job."""
    symbols = symbols_of(rows)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(work, symbols))


def _union(tables: Sequence[DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    result = spark.createDataFrame([], schema)
    for table in tables:
        result = result.unionByName(conform(table, schema))
    return result


def _fit_all(data: Prepared, models: Mapping[str, Callable[[int], Estimator]],
             search: Mapping[str, Mapping[str, Sequence]] | None, draws: int) -> dict[str, PipelineModel]:
    """Base models and, for every family in ``search``, its tuned model."""
    fitted = {f"{name}_BASE": fit(data, make) for name, make in models.items()}
    for name, grid in (search or {}).items():
        fitted[f"{name}_OPT"], _ = random_search(data, BASE_MODELS[name], grid, draws)
    return fitted


def fit_each(table: DataFrame, make: Callable[[int], Estimator], parallelism: int = 8,
             tasks: int = TRAIN_TASKS) -> dict[str, PipelineModel]:
    """One model per symbol; nothing stays cached."""

    def work(symbol: str) -> tuple[str, PipelineModel]:
        data = prepare(table, symbol, tasks)
        try:
            return symbol, fit(data, make)
        finally:
            data.release()

    return dict(per_symbol(table, work, parallelism))


def full_run(table: DataFrame, root: str, models: Mapping[str, Callable[[int], Estimator]],
             search: Mapping[str, Mapping[str, Sequence]] | None = None, draws: int = 10, horizon: int = 10,
             threshold: float = 0.01, parallelism: int = 8, tasks: int = TRAIN_TASKS) -> DataFrame:
    """Train, tune, evaluate, store and log every model of every symbol below ``root``; gives the run log.

    Logistic models and families of ``TOGETHER`` are fitted, tuned, stored and backtested for all symbols at once, the others per
    symbol, each writing its scores to a folder of its own. The log names every model ``root/models/symbol/name``, where MLlib models lie;
    the others are rows of the tables ``root/grown``, laid out by model, in which ``load_model`` finds them by that name. The best
    one's scored test rows go to ``root/backtest``.
    """
    spark = table.sparkSession
    together = [name for name in (LOGISTIC, *TOGETHER) if models.get(name) is BASE_MODELS[name]]
    tuned = [name for name in TOGETHER if name in (search or {})]
    _grow_all(table, root, together, {name: search[name] for name in tuned}, draws)
    models = {name: make for name, make in models.items() if name not in together}
    search = {name: grid for name, grid in (search or {}).items() if name not in tuned}

    def work(symbol: str) -> None:
        data = prepare(table, symbol, tasks)
        try:
            fitted = _fit_all(data, models, search, draws)
        finally:
            data.release()
        scored = [evaluate(model, data.test, symbol, name) for name, model in fitted.items()]
        path = f"{root}/scores/of={symbol}"
        _union(scored, spark, SCORES).coalesce(1).write.mode("overwrite").parquet(path)
        for name, model in fitted.items():
            save_model(model, f"{root}/models/{symbol}/{name}")

    if models or search:
        per_symbol(table, work, parallelism)
    log = run_log(read_scores(spark, root), horizon, threshold, f"{root}/models")
    export_backtests(table, log, root, parallelism)
    return log


def _grow_all(table: DataFrame, root: str, base: Sequence[str], tuned: Mapping[str, Mapping[str, Sequence]], draws: int) -> None:
    """Fit, evaluate and store logistic models and the families of ``TOGETHER``; an empty table leaves nothing."""
    train, test = table.where("split = 'train'"), table.where("split = 'test'").drop("weight")
    if not (base or tuned) or table.isEmpty():
        return
    found = [logistic.fit(train).withColumn("model", F.lit(f"{LOGISTIC}_BASE"))] if LOGISTIC in base else []
    for family in (forests.FOREST, boosting.BOOSTED):
        fits = {f"{name}_BASE": TOGETHER[name][1] for name in base if name in TOGETHER and TOGETHER[name][0] is family}
        found += [forests.fit_forests(train, fits, family=family)] if fits else []
    for name, grid in tuned.items():
        family, first, as_fit = TOGETHER[name]
        settings = [as_fit(point, first) for point in draw_settings(grid, draws)]
        found.append(forests.search(train, settings, f"{name}_OPT", family=family)[0])
    for i, grown in enumerate(found):
        tested = forests.score(test, grown) if "node" in grown.columns else logistic.score(test, grown).withColumn("model", F.lit(f"{LOGISTIC}_BASE"))
        scored = scores(tested, "symbol", "model").select("symbol", "model", "n", "accuracy", "f1")
        conform(scored, SCORES).coalesce(1).write.mode("overwrite").parquet(f"{root}/scores/of=together-{i}")
    for kind, of in ((GROWN_TREES, [m for m in found if "node" in m.columns]), (GROWN_LOGISTIC, [m for m in found if "node" not in m.columns])):
        if of:
            kept = reduce(DataFrame.unionByName, of)
            kept.repartition("model", "symbol").sortWithinPartitions("model", "symbol").write.mode("overwrite").partitionBy("model").parquet(f"{root}/{kind}")


def read_scores(spark: SparkSession, root: str) -> DataFrame:
    """The scores of a run; empty where no symbol had enough rows."""
    if not path_exists(spark, f"{root}/scores"):
        return spark.createDataFrame([], SCORES)
    return spark.read.schema(SCORES).parquet(f"{root}/scores")


def _grown(spark: SparkSession, run: str, kind: str) -> DataFrame:
    """A run's models that were grown together, of all symbols."""
    schema = forests.MODELS if kind == GROWN_TREES else f"{logistic.MODELS}, model string"
    stored = spark.read.schema(schema).parquet(f"{run}/{kind}")
    return stored.select(*T.StructType.fromDDL(schema).names)


def export_backtests(table: DataFrame, log: DataFrame, root: str, parallelism: int = 8) -> None:
    """Per symbol, the test rows scored by the best model of a run log, as CSV below ``root/backtest``.

    Models grown together are joined with the rows for all symbols at once; only MLlib models take jobs per symbol.
    """
    spark, key = table.sparkSession, ["symbol", "model", "run"]
    best = best_model(log.withColumnRenamed("model_type", "model")).withColumn("run", F.regexp_extract("artifact", "^(.*)/models/", 1))
    best = materialise(best, "best")
    test = table.where("split = 'test'").drop("weight")
    runs = [r.run for r in best.select("run").distinct().collect()]  # one value for each run, whatever the number of symbols
    for kind, score_with in ((GROWN_TREES, forests.score), (GROWN_LOGISTIC, logistic.score)):
        parts = [_grown(spark, run, kind).withColumn("run", F.lit(run)) for run in runs if path_exists(spark, f"{run}/{kind}")]
        if not parts:
            continue
        models = materialise(reduce(DataFrame.unionByName, parts).join(best.select(*key), key, "left_semi"), "best-models")
        rows = test.join(models.select("symbol").distinct(), "symbol", "left_semi")
        _backtest_rows(score_with(rows, models), "symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
            "header", True).partitionBy("symbol").csv(f"{root}/backtest")
        best = materialise(best.join(models.select("symbol").distinct(), "symbol", "left_anti"), "best")
    if best.isEmpty():
        return

    def work(symbol: str) -> None:
        chosen = best.where(F.col("symbol") == symbol).first()
        backtest(load_model(chosen.artifact), test.where(F.col("symbol") == symbol)).write.mode("overwrite").option("header", True).csv(
            f"{root}/backtest/symbol={symbol}")

    per_symbol(table.join(best.select("symbol"), "symbol", "left_semi"), work, parallelism)


def read_backtest(spark: SparkSession, root: str) -> DataFrame:
    """The exported backtests; empty where no symbol had a model."""
    schema = T.StructType([*BACKTEST.fields, T.StructField("symbol", T.StringType())])
    if not path_exists(spark, f"{root}/backtest"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).csv(f"{root}/backtest", header=True)


def train_and_evaluate(table: DataFrame, models: Mapping[str, Callable[[int], Estimator]],
                       search: Mapping[str, Mapping[str, Sequence]] | None = None, draws: int = 10,
                       parallelism: int = 8, tasks: int = TRAIN_TASKS) -> DataFrame:
    """(symbol, model, n, accuracy, f1) of every base and tuned model on its symbol's test rows."""
    root = scratch_path(table.sparkSession, "run")
    full_run(table, root, models, search, draws, parallelism=parallelism, tasks=tasks)
    return read_scores(table.sparkSession, root)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | DataFrame:
    """The model ``root/models/symbol/name`` of a run: an MLlib pipeline, or its rows in the run's table of models grown together."""
    spark = SparkSession.builder.getOrCreate()
    if path_exists(spark, f"{path}/metadata"):
        return PipelineModel.load(path)
    if path_exists(spark, path):
        return spark.read.parquet(path)
    run, _, of = path.rpartition("/models/")
    symbol, _, name = of.rpartition("/")
    kind = GROWN_TREES if path_exists(spark, f"{run}/{GROWN_TREES}/model={name}") else GROWN_LOGISTIC
    return _grown(spark, run, kind).where((F.col("symbol") == symbol) & (F.col("model") == name))


def run_log(scored: DataFrame, horizon: int, threshold: float, models: str) -> DataFrame:
    """Scores as run-log rows with the place of each stored model."""
    return conform(
        scored.select(
            F.concat_ws("_", "symbol", "model").alias("run_name"), "symbol", F.col("model").alias("model_type"),
            F.lit(horizon).alias("horizon"), F.lit(threshold).alias("threshold"), "accuracy", "f1",
            F.concat_ws("/", F.lit(models), "symbol", "model").alias("artifact")),
        RUNS,
    )


def gradient_norm(model: PipelineModel, train: DataFrame) -> float:
    """Largest component of the regularised loss's gradient at a fitted logistic model; 0 at its optimum."""
    found = model.stages[-1]
    scored = found.transform(train)
    x, weight = vector_to_array("scaled"), F.col("weight")
    error = weight * (vector_to_array("probability")[1] - F.col("target"))
    sums = scored.agg(F.sum(weight), F.sum(error), *[F.sum(error * x[i]) for i in range(len(FEATURE_COLUMNS))]).first()
    penalty = found.getRegParam()
    parts = [sums[1] / sums[0], *[s / sums[0] + penalty * float(c) for s, c in zip(sums[2:], found.coefficients)]]
    return max(map(abs, parts))


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)
