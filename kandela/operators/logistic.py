"""Logistic regressions of many series fitted together by Newton steps; models are rows of one table.

Each step is one pass over the scaled train rows: tasks add up loss, gradient and normal equations of every series they
meet, one aggregate adds the parts, and each series solves its own equations. So the number of jobs follows the Newton
steps, not the series, and a series that holds a third of all rows is added up in as many tasks as its rows lie in.
Series that have met their optimum are not read again.

The objective is the weighted mean log-loss plus 1 / (2 rows) times the squared coefficients of the standardised
features; the intercept is not penalised. Scoring is one join and built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kandela.schemas import FEATURE_COLUMNS
from kandela.session import materialise

ROUNDS = 64
TOLERANCE = 1e-9  # largest component of the gradient at which a series is done
SYMBOLS_PER_PART = 2_000  # series whose sums a task holds before it hands them on
WIDTH = len(FEATURE_COLUMNS)
_SIZE = WIDTH + 1
_UPPER = np.triu_indices(_SIZE)
_ADDED = f"array({', '.join(f'sum(sums[{i}])' for i in range(1 + _SIZE + len(_UPPER[0])))})"  # adds vectors place by place

MODELS = ("symbol string, intercept double, coefficients array<double>, means array<double>, deviations array<double>, "
          "rows long, gradient double")
STAGES = ("symbol string, position int, stage string, inputs array<string>, offsets array<double>, factors array<double>, "
          "rows long, gradient double")
_STATE = ("symbol string, rows long, total double, base array<double>, base_loss double, direction array<double>, slope double, "
          "scale double, trial array<double>, gradient double, done boolean")


def fit(train: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One model per symbol from rows with features, ``target`` (0 or 1) and ``weight``, as a stored table of ``MODELS``.

    Rows without a symbol, target, weight or finite feature are left out, as are series whose weights add up to nothing. A constant
    feature gets the coefficient 0 up to rounding. Train rows of one class only give an intercept so large that the gradient
    vanishes. ``gradient`` is the largest component at the end: above ``TOLERANCE`` only where ``rounds`` did not suffice.
    An empty table gives no models.
    """
    used = _usable(train)
    moments = materialise(
        used.groupBy("symbol").agg(
            F.count("*").alias("rows"), F.sum("weight").alias("total"),
            F.expr(f"array({', '.join(f'avg({c})' for c in FEATURE_COLUMNS)})").alias("means"),
            F.expr(f"array({', '.join(f'coalesce(stddev_samp({c}), 0D)' for c in FEATURE_COLUMNS)})").alias("deviations"),
        ).where("total > 0"), "moments")
    scaled = materialise(
        used.join(moments.select("symbol", "means", "deviations"), "symbol").selectExpr(
            "symbol", "CAST(target AS double) AS y", "CAST(weight AS double) AS w",
            *[f"{_scaled(i)} AS x{i}" for i in range(WIDTH)]), "scaled")
    zero, none = f"array_repeat(0D, {_SIZE})", "CAST(NULL AS double)"
    state = moments.selectExpr("symbol", "rows", "total", f"{zero} AS base", f"{none} AS base_loss", f"{zero} AS direction", "0D AS slope",
                               "1D AS scale", f"{zero} AS trial", f"{none} AS gradient", "false AS done")
    for _ in range(rounds):
        open_ones = state.where("NOT done")
        stepped = open_ones.join(_sums(scaled, open_ones.select("symbol", "trial")), "symbol").mapInArrow(_step, _STATE)
        state = materialise(stepped.unionByName(state.where("done")), "newton")
        if state.where("NOT done").isEmpty():
            break
    return materialise(state.join(moments.select("symbol", "means", "deviations"), "symbol").select(
        "symbol", F.col("base")[0].alias("intercept"), F.slice("base", 2, WIDTH).alias("coefficients"), "means", "deviations",
        "rows", "gradient"), "logistic")


def _usable(train: DataFrame) -> DataFrame:
    """Rows with everything a fit reads; null, NaN and infinity do not compare below infinity or are it."""
    return train.dropna(subset=["symbol", "target", "weight"]).where(" AND ".join(f"abs({c}) < double('infinity')" for c in FEATURE_COLUMNS))


def _scaled(i: int, model: str = "") -> str:
    """SQL of a standardised feature beside ``means`` and ``deviations``; a constant one is 0."""
    x, mean, deviation = f"CAST({FEATURE_COLUMNS[i]} AS double)", f"{model}means[{i}]", f"{model}deviations[{i}]"
    return f"CASE WHEN {deviation} > 0 THEN ({x} - {mean}) / {deviation} ELSE {x} * 0 END"


def _sums(scaled: DataFrame, trials: DataFrame) -> DataFrame:
    """``symbol, sums``: loss, gradient and upper triangle of the Hessian of every series at its trial point, unpenalised."""
    margin = " + ".join(["trial[0]", *[f"trial[{i + 1}] * x{i}" for i in range(WIDTH)]])
    rows = scaled.join(trials, "symbol").selectExpr("symbol", "y", "w", f"{margin} AS z", *[f"x{i}" for i in range(WIDTH)])
    parts = rows.mapInArrow(_add_up, "symbol string, sums array<double>")
    return parts.groupBy("symbol").agg(F.expr(_ADDED).alias("sums"))


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        kinds = [pa.string(), pa.list_(pa.float64())]
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((list(known), list(known.values())), kinds)], names=["symbol", "sums"])
        known.clear()
        return made

    for batch in batches:
        codes = batch.column("symbol").dictionary_encode()
        of, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
        y, w, z, *x = (batch.column(i).to_numpy() for i in range(1, batch.num_columns))
        a = np.column_stack([np.ones(len(y)), *x])
        chance = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        error, curve = w * (chance - y), w * chance * (1 - chance)
        loss = w * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)
        for code, name in enumerate(names):
            mine = of == code if len(names) > 1 else slice(None)
            m = a[mine]
            sums = np.concatenate([[loss[mine].sum()], m.T @ error[mine], (m.T @ (m * curve[mine][:, None]))[_UPPER]])
            known[name] = known[name] + sums if name in known else sums
        if len(known) > SYMBOLS_PER_PART:
            yield flush()
    if known:
        yield flush()


def _step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The next trial point of every series: a Newton step where the last one lowered the objective enough, else half of it."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            sums, penalty = np.array(row.pop("sums")) / row["total"], np.array([0.0] + [1.0 / row["rows"]] * WIDTH)
            trial = np.array(row["trial"])
            loss = sums[0] + (penalty * trial * trial).sum() / 2
            enough = row["base_loss"] is None or loss <= (
                row["base_loss"] + 1e-4 * row["scale"] * row["slope"] + 1e-12 * (1 + abs(row["base_loss"])))
            if enough:
                gradient = sums[1:_SIZE + 1] + penalty * trial
                hessian = np.zeros((_SIZE, _SIZE))
                hessian[_UPPER] = sums[_SIZE + 1:]
                hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
                direction = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
                largest = float(np.abs(gradient).max())
                row |= {"base": trial.tolist(), "base_loss": float(loss), "direction": direction.tolist(),
                        "slope": float(gradient @ direction), "scale": 1.0, "trial": (trial + direction).tolist(),
                        "gradient": largest, "done": largest <= TOLERANCE}
            else:
                scale = row["scale"] / 2
                row |= {"scale": scale, "done": scale < 1e-9,
                        "trial": (np.array(row["base"]) + scale * np.array(row["direction"])).tolist()}
            out.append(row)
        names = ["symbol", "rows", "total", "base", "base_loss", "direction", "slope", "scale", "trial", "gradient", "done"]
        kinds = {"symbol": pa.string(), "rows": pa.int64(), "done": pa.bool_()}
        arrays = ("base", "direction", "trial")
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in out], kinds.get(n, pa.list_(pa.float64()) if n in arrays else pa.float64())) for n in names], names=names)


def with_models(rows: DataFrame, models: DataFrame, how: str = "inner") -> DataFrame:
    """Rows beside their symbol's model as a struct ``_model``; one join, whatever the number of symbols."""
    side = models.select(F.col("symbol").alias("_of"), F.struct("intercept", "coefficients", "means", "deviations", "rows").alias("_model"))
    return rows.join(side, F.col("symbol") == F.col("_of"), how).drop("_of")


def chance_of_one() -> Column:
    """Probability of class 1 of a row that carries its model; null where a feature is null."""
    terms = [f"_model.coefficients[{i}] * ({_scaled(i, '_model.')})" for i in range(WIDTH)]
    return F.expr(f"1 / (1 + exp(-(_model.intercept + {' + '.join(terms)})))")


def score(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Rows whose symbol has a model, with ``prediction, prob_buy, prob_sell`` (null where a feature is null)."""
    names = [c for c in rows.columns if c not in ("prediction", "prob_buy", "prob_sell")]
    scored = with_models(rows, models).withColumn("prob_buy", chance_of_one())
    return scored.select(*names, (F.col("prob_buy") > 0.5).cast("int").alias("prediction"), "prob_buy",
                         (1 - F.col("prob_buy")).alias("prob_sell"))


def gradients(train: DataFrame, models: DataFrame) -> DataFrame:
    """``symbol, gradient``: largest component of the objective's gradient at each model, by one plain aggregate over the train rows."""
    used = with_models(_usable(train), models).withColumn("_error", F.col("weight") * (chance_of_one() - F.col("target")))
    summed = ", ".join(f"sum(_error * ({_scaled(i, '_model.')}))" for i in range(WIDTH))
    sums = used.groupBy("symbol").agg(F.expr(f"array(sum(weight), sum(_error), {summed})").alias("s"), F.first("_model").alias("_model"))
    parts = ["abs(s[1] / s[0])", *[f"abs(s[{i + 2}] / s[0] + _model.coefficients[{i}] / _model.rows)" for i in range(WIDTH)]]
    return sums.selectExpr("symbol", f"greatest({', '.join(parts)}) AS gradient")


def save(models: DataFrame, path: str) -> None:
    """Store models as rows per stage: inputs in order, scaler (means, deviations), classifier (intercept, coefficients)."""
    none = F.lit(None).cast("array<double>")
    stage = lambda i, name, offsets, factors: F.struct(
        F.lit(i).alias("position"), F.lit(name).alias("stage"), offsets.alias("offsets"), factors.alias("factors"))
    stages = F.array(
        stage(0, "VectorAssembler", none, none), stage(1, "StandardScalerModel", F.col("means"), F.col("deviations")),
        stage(2, "LogisticRegressionModel", F.array("intercept"), F.col("coefficients")))
    rows = models.select("symbol", "rows", "gradient", F.explode(stages).alias("s")).select(
        "symbol", "s.position", "s.stage", F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("inputs"), "s.offsets", "s.factors",
        "rows", "gradient")
    rows.write.mode("overwrite").parquet(path)


def read_stages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGES).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Stored models as a table of ``MODELS``; models of other input columns than ``FEATURE_COLUMNS`` are refused."""
    at = lambda i, c: F.first(F.when(F.col("position") == i, F.col(c)), ignorenulls=True)
    fits = F.col("inputs") == F.array(*[F.lit(c) for c in FEATURE_COLUMNS])
    checked = read_stages(spark, path).where(F.when(fits, True).otherwise(F.raise_error(F.lit("the model has other inputs"))))
    return checked.groupBy("symbol").agg(
        at(2, "offsets")[0].alias("intercept"), at(2, "factors").alias("coefficients"), at(1, "offsets").alias("means"),
        at(1, "factors").alias("deviations"), F.first("rows").alias("rows"), F.first("gradient").alias("gradient"))


def from_pipelines(spark: SparkSession, models: Mapping[str, PipelineModel], rows: int = 0) -> DataFrame:
    """MLlib pipelines (assembler, scaler, logistic regression) of a few symbols as a table of ``MODELS``."""
    found = []
    for symbol, pipeline in models.items():
        _, scaler, last = pipeline.stages
        found.append((symbol, float(last.intercept), [float(c) for c in last.coefficients], [float(c) for c in scaler.mean],
                      [float(c) for c in scaler.std], rows, None))
    return spark.createDataFrame(found, MODELS)
