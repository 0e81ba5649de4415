"""Proofs that a model is the fitted one, each from one distributed pass over its training rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Optimum(NamedTuple):
    """`slope`: the largest component of the loss's gradient; `loss` at the coefficients and `idle_loss` without any."""

    slope: float
    loss: float
    idle_loss: float


def _cell(name: str):
    return F.col(f"`{name}`").cast("double")


def logistic_optimum(
    model: PipelineModel, train: DataFrame, label: str, features: Sequence[str], labels: Sequence[str], penalty: float,
) -> Optimum:
    """How far a multinomial regression without intercept is from its optimum.

    The loss is the mean cross-entropy plus half the penalty times the squares of the coefficients, features
    being divided by their sample deviation. At its optimum the gradient is zero, and since the loss is convex
    nothing else has a zero gradient. The gradient is a sum over rows: one value for each label and feature.
    """
    coefficients = model.stages[1].coefficientMatrix.toArray()
    deviation = train.agg(*[F.stddev_samp(_cell(f)).alias(f"d{j}") for j, f in enumerate(features)]).first()
    margins = [sum((F.lit(float(b)) * _cell(f) for b, f in zip(row, features)), F.lit(0.0)) for row in coefficients]
    rows = train.select(F.col(label).alias("__label"), *[_cell(f).alias(f"x{j}") for j, f in enumerate(features)],
                        *[m.alias(f"m{k}") for k, m in enumerate(margins)])
    top = F.greatest(*[F.col(f"m{k}") for k in range(len(labels))])
    rows = rows.withColumn("top", top)
    rows = rows.withColumn("total", sum((F.exp(F.col(f"m{k}") - F.col("top")) for k in range(len(labels))), F.lit(0.0)))
    rows = rows.withColumns({f"p{k}": F.exp(F.col(f"m{k}") - F.col("top")) / F.col("total") for k in range(len(labels))})
    rows = rows.withColumns({f"y{k}": (F.col("__label") == name).cast("double") for k, name in enumerate(labels)})
    own = sum((F.col(f"y{k}") * F.col(f"m{k}") for k in range(len(labels))), F.lit(0.0))
    sums = rows.agg(
        F.avg(F.col("top") + F.log("total") - own).alias("loss"),
        *[F.avg((F.col(f"p{k}") - F.col(f"y{k}")) * F.col(f"x{j}")).alias(f"g{k}_{j}")
          for k in range(len(labels)) for j in range(len(features))]).first()
    slope, squares = 0.0, 0.0
    for k, row in enumerate(coefficients):
        for j, b in enumerate(row):
            d = deviation[f"d{j}"] or 0.0
            if d:
                slope = max(slope, abs(sums[f"g{k}_{j}"] / d + penalty * d * b))
                squares += (d * b) ** 2
    idle = train.select(F.log(F.lit(float(len(labels))))).first()
    return Optimum(slope, sums["loss"] + penalty / 2 * squares, idle[0] if idle else 0.0)


def beats_mean(scored: DataFrame, label: str, prediction: str) -> bool:
    """Whether the squared error is below that of always guessing the labels' mean."""
    error = F.col(prediction) - F.col(label)
    mine, idle = scored.agg(F.avg(error * error), F.var_pop(label)).first()
    return mine is not None and mine < idle


def beats_majority(scored: DataFrame, label: str, prediction: str = "prediction") -> bool:
    """Whether more rows are right than by always guessing the most frequent label, or as many where all are right."""
    counts = scored.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(label) == F.col(prediction), 1)).alias("right"))
    rows, right, most = counts.agg(F.sum("rows"), F.sum("right"), F.max("rows")).first()
    return bool(rows) and (right > most or right == rows)
