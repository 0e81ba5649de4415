"""Training, scoring and rating of models, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numeric import round_half_even
from tallyfold.plans.trees import Tree, votes

# Sizes of the forests.
REGRESSION_FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1}
CLASSIFICATION_FOREST = {"numTrees": 100, "maxDepth": 4, "minInstancesPerNode": 5}
MOST_LEAVES = 8
PENALTY = 0.01
# A fit ends when a step changes the loss by less than this share.
NARROW = 1e-8


def _assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def _fit(estimator, ready: DataFrame):
    # Training goes over its rows several times, so they are kept while it runs.
    kept = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


def fit_forest_regressor(
    train: DataFrame, label: str, features: Sequence[str], seed: int = 1, **sizes
) -> PipelineModel:
    """Random forest for a number."""
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, predictionCol="raw_prediction", seed=seed,
        **{**REGRESSION_FOREST, **sizes},
    )
    assemble = _assembler(features)
    model = _fit(forest, assemble.transform(train).select("features", label))
    return PipelineModel(stages=[assemble, model])


def _fit_classifier(classifier, train, label, features, labels) -> PipelineModel:
    # The labels are fixed beforehand, so a label that only the validation rows have is
    # known to the model, and no pass is needed to find them.
    index = StringIndexerModel.from_labels(
        list(labels), inputCol=label, outputCol="label_index", handleInvalid="error"
    )
    name = IndexToString(inputCol="predicted_index", outputCol="prediction", labels=list(labels))
    classifier.setParams(
        featuresCol="features", labelCol="label_index", predictionCol="predicted_index",
        rawPredictionCol="votes", probabilityCol="probability",
    )
    assemble = _assembler(features)
    ready = index.transform(assemble.transform(train)).select("features", "label_index")
    return PipelineModel(stages=[assemble, _fit(classifier, ready), name])


def fit_forest_classifier(
    train: DataFrame, label: str, features: Sequence[str], labels: Sequence[str],
    seed: int = 42, **sizes,
) -> PipelineModel:
    """Random forest for a text label."""
    forest = RandomForestClassifier(seed=seed, **{**CLASSIFICATION_FOREST, **sizes})
    return _fit_classifier(forest, train, label, features, labels)


def fit_logistic_regression(
    train: DataFrame, label: str, features: Sequence[str], labels: Sequence[str],
    penalty: float = PENALTY, iterations: int = 100,
) -> PipelineModel:
    """Multinomial logistic regression without intercept."""
    model = LogisticRegression(
        family="multinomial", fitIntercept=False, regParam=penalty, maxIter=iterations, tol=NARROW,
    )
    return _fit_classifier(model, train, label, features, labels)


def score_numbers(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Rows with the prediction, rounded to a whole number, ties to the even one."""
    scored = model.transform(frame).drop("features")
    return scored.withColumn("prediction", round_half_even(F.col("raw_prediction")))


def score_labels(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Rows with the predicted label."""
    helpers = ("features", "predicted_index", "votes", "probability")
    return model.transform(frame).drop(*helpers)


def votes_differ(model: PipelineModel, trees: Sequence[Tree], frame: DataFrame, features: Sequence[str]) -> float:
    """The largest distance between a forest's votes and those of its trees as column expressions, over all rows."""
    classes = model.stages[1].numClasses
    voted = frame.withColumn("__compiled", votes(trees, features, classes))
    both = PipelineModel(stages=model.stages[:2]).transform(voted).withColumn("__model", vector_to_array("probability"))
    apart = [F.abs(F.col("__compiled")[k] - F.col("__model")[k]) for k in range(classes)]
    return both.agg(F.max(F.greatest(*apart))).first()[0] or 0.0


def confusion(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted label."""
    pairs = scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted"))
    return pairs.agg(F.count(F.lit(1)).alias("rows"))


def label_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per label, and the accuracy over all.

    Worked out from the few rows of the confusion table, after one aggregation.
    """
    cells = confusion(scored, label, prediction)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.col("rows").alias("support"),
                 F.lit(0).cast("long").alias("claimed"), F.lit(0).cast("long").alias("right")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("rows").alias("claimed"),
                 F.when(F.col("label") == F.col("predicted"), F.col("rows"))
                 .otherwise(0).alias("right")),
    )).alias("side")).select("side.*")
    totals = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"),
        F.sum("right").alias("right"),
    )
    precision = F.try_divide("right", "claimed")
    recall = F.try_divide("right", "support")
    return totals.select(
        "label", "support",
        precision.alias("precision"), recall.alias("recall"),
        F.try_divide(2 * F.col("right"), F.col("claimed") + F.col("support")).alias("f1"),
    )


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction is right."""
    right = F.count(F.when(F.col(label).eqNullSafe(F.col(prediction)), 1))
    return scored.agg((right / F.count(F.lit(1))).alias("accuracy"))


def number_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Root mean squared error, mean absolute error and R2, in one pass."""
    error = F.col(label) - F.col(prediction)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.avg(error * error) / F.var_pop(label)).alias("r2"),
    )
