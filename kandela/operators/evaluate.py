"""Class balance, scores, best model and signal comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kandela.schemas import SERIES
from kandela.session import materialise


def class_weights(labelled: DataFrame) -> DataFrame:
    """Balanced weight n / (k * n_c) per series and class, with the plain count ratios.

    ``pos_weight_usual`` is n0/n1; ``pos_weight_balanced`` is w0/w1 = n1/n0.
    """
    counts = labelled.groupBy(*SERIES, "target").agg(F.count("*").alias("n_class"))
    series = Window.partitionBy(*SERIES)
    n0 = F.sum(F.when(F.col("target") == 0, F.col("n_class"))).over(series)
    n1 = F.sum(F.when(F.col("target") == 1, F.col("n_class"))).over(series)
    return counts.select(
        *SERIES, "target", "n_class",
        (F.sum("n_class").over(series) / (F.count("*").over(series) * F.col("n_class"))).alias("weight"),
        F.try_divide(n0, n1).alias("pos_weight_usual"),
        F.try_divide(n1, n0).alias("pos_weight_balanced"),
    )


def with_row_weights(labelled: DataFrame) -> DataFrame:
    """Every row with the weight of its class; the stored weights are a few rows per series."""
    weights = materialise(class_weights(labelled).select(*SERIES, "target", "weight"), "weights")
    return labelled.join(weights, on=[*SERIES, "target"])


def scores(predictions: DataFrame, *by: str) -> DataFrame:
    """Accuracy and F1 of class 1 per group; F1 is 0 when there is nothing to find."""
    hit = lambda t, p: F.count_if((F.col("target") == t) & (F.col("prediction") == p))
    counts = predictions.groupBy(*by).agg(
        F.count("*").alias("n"), hit(1, 1).alias("tp"), hit(0, 0).alias("tn"),
        hit(0, 1).alias("fp"), hit(1, 0).alias("fn"),
    )
    return counts.select(
        *by, "n", "tp", "tn", "fp", "fn",
        ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
        F.coalesce(
            F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)
        ).alias("f1"),
    )


def best_model(scored: DataFrame) -> DataFrame:
    """The model with the highest F1 per symbol; equal scores go to the first name."""
    first = Window.partitionBy("symbol").orderBy(F.col("f1").desc(), "model")
    return scored.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def summary(scored: DataFrame, digits: int = 3) -> DataFrame:
    return best_model(scored).select(
        "symbol", F.col("model").alias("best_model"),
        F.round("accuracy", digits).alias("accuracy"), F.round("f1", digits).alias("f1"),
    )


def any_true(df: DataFrame, condition, *by: str, name: str = "any_true") -> DataFrame:
    return df.groupBy(*by).agg(F.bool_or(condition).alias(name))


def signal_counts(predictions: DataFrame, *by: str) -> DataFrame:
    """How often each pair of true class and predicted class occurs."""
    return predictions.groupBy(*by, "target", "prediction").agg(F.count("*").alias("n"))


def standardise(split_rows: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population std with both taken from the train split of the same series."""
    fitted = split_rows.where("split = 'train'").groupBy(*SERIES).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns],
    )
    joined = split_rows.join(materialise(fitted, "scaler"), on=SERIES)
    centred = lambda c: F.col(c) - F.col(f"_mean_{c}")
    # A constant column is only centred, as the usual scaler does.
    scaled = lambda c: F.when(F.col(f"_std_{c}") == 0, centred(c)).otherwise(
        F.try_divide(centred(c), F.col(f"_std_{c}")))
    return joined.select(*[scaled(c).alias(c) if c in columns else c for c in split_rows.columns])
