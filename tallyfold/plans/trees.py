"""Trees of a trained forest as column expressions, cut back to a number of leaves.

A forest's trees are bounded by its depth and number, so the node table is a short list,
whatever it was trained on. Scoring by expressions needs no vector of features and no model
on the executors: each tree is nested conditions on the frame's own columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.session import scratch_path

LEAF = -1


@dataclass(frozen=True)
class Node:
    """`stats` are the rows of each class; `weight` is what the split lowers the impurity by, times its rows."""

    id: int
    prediction: float
    stats: tuple[float, ...]
    weight: float
    left: int = LEAF
    right: int = LEAF
    feature: int = LEAF
    threshold: float = 0.0

    @property
    def is_leaf(self) -> bool:
        return self.left == LEAF


Tree = Mapping[int, Node]


def node_table(spark: SparkSession, forest) -> DataFrame:
    """Rows (tree, id, prediction, stats, rows, gain, left, right, feature, threshold) of a forest on number columns."""
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    node = "nodeData"
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), f"{node}.id", f"{node}.prediction", F.col(f"{node}.impurityStats").alias("stats"),
        F.col(f"{node}.rawCount").alias("rows"), f"{node}.gain", F.col(f"{node}.leftChild").alias("left"),
        F.col(f"{node}.rightChild").alias("right"), F.col(f"{node}.split.featureIndex").alias("feature"),
        F.element_at(F.col(f"{node}.split.leftCategoriesOrThreshold"), 1).alias("threshold"),
        F.col(f"{node}.split.numCategories").alias("categories"))


def trees_of(spark: SparkSession, forest) -> list[Tree]:
    """The trees by their nodes. Splits into categories are refused, as columns here hold numbers."""
    inner = (F.col("left") >= 0)
    table = node_table(spark, forest).select(
        "tree", "id", "prediction", "stats", "rows", "gain", "left", "right", "feature",
        F.when(inner, F.col("threshold")).alias("threshold"), F.when(inner, F.col("categories")).alias("categories"))
    trees: dict[int, dict[int, Node]] = {}
    for r in table.collect():
        if r["categories"] is not None and r["categories"] >= 0:
            raise ValueError("a split into categories has no threshold")
        split = {} if r["left"] < 0 else {
            "left": r["left"], "right": r["right"], "feature": r["feature"], "threshold": r["threshold"]}
        trees.setdefault(r["tree"], {})[r["id"]] = Node(
            r["id"], r["prediction"], tuple(r["stats"]), max(r["gain"], 0.0) * r["rows"], **split)
    return [trees[t] for t in sorted(trees)]


def leaves(tree: Tree) -> list[Node]:
    """The leaves that are reached from the root, from left to right."""
    found, open_ = [], [tree[0]]
    while open_:
        node = open_.pop()
        if node.is_leaf:
            found.append(node)
        else:
            open_ += [tree[node.right], tree[node.left]]
    return found


def pruned(tree: Tree, most_leaves: int) -> Tree:
    """The tree with its weakest last splits undone until it has at most that many leaves.

    Weakest is the split that lowers impurity times rows least, at a tie that of the later
    node. What stays is what a tree grown strongest split first would keep, as far as
    a strong split below a weak one allows.
    """
    if most_leaves < 1:
        raise ValueError("a tree has one leaf at least")
    kept = dict(tree)
    while len(leaves(kept)) > most_leaves:
        last = [n for n in kept.values() if not n.is_leaf and kept[n.left].is_leaf and kept[n.right].is_leaf]
        weakest = min(last, key=lambda n: (n.weight, -n.id))
        del kept[weakest.left], kept[weakest.right]
        kept[weakest.id] = replace(weakest, left=LEAF, right=LEAF, feature=LEAF)
    return kept


def compiled(tree: Tree, features: Sequence[str], value: Callable[[Node], Column]) -> Column:
    """The value of the leaf that a row falls into, as nested conditions on its columns."""

    def under(node: Node) -> Column:
        if node.is_leaf:
            return value(node)
        goes_left = F.col(f"`{features[node.feature]}`").cast("double") <= F.lit(node.threshold)
        return F.when(goes_left, under(tree[node.left])).otherwise(under(tree[node.right]))

    return under(tree[0])


def _shares(node: Node) -> Column:
    total = sum(node.stats)
    return F.array(*[F.lit(n / total if total else 0.0) for n in node.stats])


def votes(trees: Sequence[Tree], features: Sequence[str], classes: int) -> Column:
    """For each class the mean over the trees of its share in the row's leaf.

    A tree gives all its classes' shares at once, and a loop over the trees adds them, so the generated
    code does not grow with trees times classes beyond what a method may hold.
    """
    every = F.array(*[compiled(tree, features, _shares) for tree in trees])
    none = F.array(*[F.lit(0.0)] * classes)
    total = F.aggregate(every, none, lambda held, one: F.zip_with(held, one, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.lit(float(len(trees))))


def score_by_votes(frame: DataFrame, trees: Sequence[Tree], features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Rows with the label of most votes as `prediction`, the first of equals, by expressions alone."""
    voted = frame.withColumn("__votes", votes(trees, features, len(labels)))
    best = F.array_position("__votes", F.array_max("__votes")).cast("int")
    return voted.withColumn("prediction", F.element_at(F.array(*map(F.lit, labels)), best)).drop("__votes")


def leaf_spans(model: PipelineModel, train: DataFrame, label: str) -> DataFrame:
    """What the training rows say of every leaf: (tree, leaf, prediction, rows, low, high, mean).

    One pass sends each row to its leaves and sums them up on the map side. A forest's leaf is the mean
    of a draw of the rows that fall into it, so it lies between the least and the greatest of their labels;
    for a model that was not trained on these rows and labels it need not.
    """
    from pyspark.ml.functions import vector_to_array

    assemble, forest = model.stages[0], model.stages[1]
    spark = train.sparkSession
    by_place = Window.partitionBy("tree").orderBy("id")
    known = node_table(spark, forest).where(F.col("left") < 0).select(
        "tree", (F.row_number().over(by_place) - 1).alias("leaf"), "prediction")
    placed = forest.copy({forest.leafCol: "__leaves"}).transform(assemble.transform(train))
    cells = placed.select(F.col(label).cast("double").alias("label"), F.posexplode(vector_to_array("__leaves")).alias("tree", "leaf"))
    spans = cells.groupBy("tree", F.col("leaf").cast("int").alias("leaf")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"), F.avg("label").alias("mean"))
    return known.join(spans, ["tree", "leaf"], "left")


def unsound_leaves(spans: DataFrame, slack: float = 1e-9) -> int:
    """Leaves that no training row reaches or whose value is not among their rows' labels."""
    sound = (F.col("prediction") >= F.col("low") - slack) & (F.col("prediction") <= F.col("high") + slack)
    return spans.where(~F.coalesce(sound, F.lit(False))).count()
