import random

import pytest
from pyspark.sql import functions as F

from tallyfold.plans import certificates, models, trees
from tallyfold.plans.trees import Node

FEATURES, LABELS = ["x", "y-z", "flag"], ("low", "mid", "high")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(400):
        x, y, flag = rng.uniform(0, 10), rng.uniform(-3, 3), rng.randrange(2)
        score = x + y * flag + rng.gauss(0, 0.3)
        data.append((i, x, y, flag, score, "low" if score < 3 else "mid" if score < 7 else "high"))
    return spark.createDataFrame(data, "id long, x double, `y-z` double, flag int, score double, label string")


@pytest.fixture(scope="module")
def forest(rows):
    return models.fit_forest_classifier(rows, "label", FEATURES, LABELS, numTrees=12)


def tree(*splits, stats=None):
    """Nodes given as (id, weight, left, right)."""
    nodes = {n: Node(n, float(n), (1.0, float(n)), 0.0) for n in range(1 + 2 * len(splits))}
    for n, weight, left, right in splits:
        nodes[n] = Node(n, float(n), (2.0, float(n)), weight, left, right, 0, float(n))
    return nodes


def test_weakest_last_splits_go_first():
    full = tree((0, 9, 1, 2), (1, 1, 3, 4), (2, 5, 5, 6), (6, 2, 7, 8))
    assert [n.id for n in trees.leaves(full)] == [3, 4, 5, 7, 8]
    assert [n.id for n in trees.leaves(trees.pruned(full, 4))] == [1, 5, 7, 8]
    assert [n.id for n in trees.leaves(trees.pruned(full, 3))] == [1, 5, 6]
    assert [n.id for n in trees.leaves(trees.pruned(full, 1))] == [0]
    assert trees.pruned(full, 5) == full
    equal = tree((0, 9, 1, 2), (1, 1, 3, 4), (2, 1, 5, 6))
    assert [n.id for n in trees.leaves(trees.pruned(equal, 3))] == [3, 4, 2]
    with pytest.raises(ValueError, match="one leaf"):
        trees.pruned(full, 0)


def test_compiled_trees_vote_as_the_model(spark, rows, forest, plan_of):
    full = trees.trees_of(spark, forest.stages[1])
    assert len(full) == 12 and max(len(trees.leaves(t)) for t in full) > 8
    assert models.votes_differ(forest, full, rows, FEATURES) <= 1e-9
    mine = trees.score_by_votes(rows, full, FEATURES, LABELS)
    both = mine.join(models.score_labels(forest, rows).select("id", F.col("prediction").alias("other")), "id")
    assert both.where("prediction <> other").isEmpty()
    assert "Python" not in plan_of(mine) and mine.columns == [*rows.columns, "prediction"]


def test_pruned_forest_has_few_leaves_and_still_tells_labels(spark, rows, forest):
    small = [trees.pruned(t, 8) for t in trees.trees_of(spark, forest.stages[1])]
    assert all(len(trees.leaves(t)) <= 8 for t in small)
    assert models.votes_differ(forest, small, rows, FEATURES) > 1e-6
    assert certificates.beats_majority(trees.score_by_votes(rows, small, FEATURES, LABELS), "label")
    stumps = [trees.pruned(t, 1) for t in small]
    assert not certificates.beats_majority(trees.score_by_votes(rows, stumps, FEATURES, LABELS), "label")


def test_logistic_regression_is_at_its_optimum(rows):
    fitted = models.fit_logistic_regression(rows, "label", FEATURES, LABELS)
    found = certificates.logistic_optimum(fitted, rows, "label", FEATURES, LABELS, models.PENALTY)
    assert found.slope < 1e-4 and found.loss < found.idle_loss
    untrained = models.fit_logistic_regression(rows, "label", FEATURES, LABELS, iterations=0)
    idle = certificates.logistic_optimum(untrained, rows, "label", FEATURES, LABELS, models.PENALTY)
    assert idle.slope > 1e-2 and idle.loss == pytest.approx(idle.idle_loss)
    other = rows.withColumn("label", F.when(F.col("label") == "low", "high").otherwise(F.col("label")))
    assert certificates.logistic_optimum(fitted, other, "label", FEATURES, LABELS, models.PENALTY).slope > 1e-2


def test_leaves_of_a_regression_forest_hold_their_rows(rows):
    model = models.fit_forest_regressor(rows, "score", FEATURES, numTrees=8)
    spans = trees.leaf_spans(model, rows, "score")
    assert trees.unsound_leaves(spans) == 0
    totals = spans.groupBy("tree").agg(F.sum("rows").alias("rows"))
    assert {r["rows"] for r in totals.collect()} == {400}
    assert certificates.beats_mean(models.score_numbers(model, rows), "score", "raw_prediction")
    shuffled = rows.withColumn("score", F.col("score") + F.when(F.col("id") % 2 == 0, 50).otherwise(-50))
    assert trees.unsound_leaves(trees.leaf_spans(model, shuffled, "score")) > 0
    assert not certificates.beats_mean(rows.withColumn("p", F.lit(1000.0)), "score", "p")
