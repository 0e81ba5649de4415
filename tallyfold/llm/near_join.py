"""N-gram Jaccard join: near copies by chosen paths.

A document is its set of shingles, five words each, lower-cased and cut at white space; a
document with fewer words is one shingle of all of them. Two documents are linked if the
Jaccard similarity of their sets is 0.8 or more, and a class is what links connect.

Chosen path: in each of several runs all sets begin in one node. A set goes on to the
child nodes of the few of its tokens that the node's hash chooses, so sets that
share many tokens share children. All sets take two steps, as sets with a passage in common
would often meet after one. Nodes with one set are dropped, small ones are compared
by brute force, others are split again. Every run finds a linked pair with a known chance,
and the number of runs follows from the target recall. Runs are independent and made together.

Equal sets are one member from the start, so copies are never expanded into pairs. A node
that a split leaves large holds near copies of each other, or a passage that many
documents share: its members are compared in cells of bounded size. Brute force emits a
spanning forest of the links, never all pairs. Within the classes that result, all
links are then counted exactly, so links that no path met count as well.

Token hashes have 32 bits: two sets of a thousand tokens differ from their texts by one
token with a chance below 1 in 4,000.

Defined cases: a null text is empty; texts without words are one set, and so copies of each other;
a null id sorts last; repeated rows are copies and share class and links; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.joins import is_small, keyed_join
from tallyfold.session import materialise

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
# Tokens that a node chooses of a set, on average: at the first step, the second, and further ones.
FIRST, SECOND, FURTHER = 6.0, 0.5, 2.5
# Nodes up to this size are compared by brute force; larger ones are split, at most to this depth.
SMALL, DEPTH = 64, 3
# Members of a block of a node or class that stays large; two blocks make a cell.
BLOCK = 2048
# Sets that one group of small nodes or classes holds, as an order of magnitude.
GROUP = 1000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SETS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_id", pa.binary()),
                   ("tokens", pa.binary()), ("nodes", pa.list_(pa.int64()))])


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_tokens(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    found = (text or "").lower().split()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in found] or [0], np.uint64)
    width = min(words, len(hashes))
    total = np.full(len(hashes) - width + 1, len(found) < words, np.uint64)
    for i in range(width):
        total = _mixed(total + hashes[i:len(hashes) - width + 1 + i])
    return np.unique((total >> np.uint64(32)).astype(np.uint32))


def children(tokens: np.ndarray, nodes: np.ndarray, chosen: float = FURTHER) -> np.ndarray:
    """Child nodes of a set in each of `nodes`, by the tokens that the node's hash chooses."""
    drawn = _mixed(tokens.astype(np.uint64)[None, :] ^ nodes.astype(np.uint64)[:, None])
    limit = min(chosen / max(1, len(tokens)), 1.0) * 2.0**32
    return np.unique(_mixed(drawn[(drawn >> np.uint64(32)) < limit])).astype(np.int64)


def runs_for(recall: float, threshold: float = THRESHOLD) -> int:
    """Runs until a pair at the threshold is met with the target recall.

    Two linked sets share at least `threshold` of the larger one's tokens, so a node
    chooses that share of its tokens for both of them on average. Reckoned for pairs whose
    nodes are large after two steps and are split once more.
    """
    met = 1.0
    for chosen in (FURTHER, SECOND, FIRST):
        met = 1 - math.exp(-chosen * threshold * met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def document_sets(docs: DataFrame, id: str, text: str, recall: float, threshold: float) -> DataFrame:
    """doc_id, text_hash, set_id, tokens and first nodes of each document. Written once."""
    roots = _mixed(np.arange(1, runs_for(recall, threshold) + 1, dtype=np.uint64))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_tokens(t.as_py()) for t in part.column(2)]
                raw = [s.tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(raw, pa.binary()),
                    pa.array([children(s, children(s, roots, FIRST), SECOND) for s in sets], pa.list_(pa.int64())),
                ], schema=_SETS)

    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    sets = slim.mapInArrow(build, "doc_id long, text_hash long, set_id binary, tokens binary, nodes array<long>")
    return materialise(sets, "near-sets")


def _token_lists(tokens: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint32) for t in tokens]


class _Index:
    """Intersections of one set with all sets of a list, by marks over their shared vocabulary."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self._starts = np.concatenate([[0], np.cumsum(self.sizes)])
        vocabulary, self._places = np.unique(np.concatenate(sets), return_inverse=True)
        self._mark = np.zeros(len(vocabulary), np.int32)

    def linked(self, i: int, threshold: Fraction) -> np.ndarray:
        """Whether each set is linked to set i; exact in whole numbers."""
        own = self._places[self._starts[i]:self._starts[i + 1]]
        self._mark[own] = 1
        shared = np.add.reduceat(self._mark[self._places], self._starts[:-1])
        self._mark[own] = 0
        union = self.sizes[i] + self.sizes - shared
        return shared * threshold.denominator >= union * threshold.numerator


def link_forest(sets: list[np.ndarray], threshold: Fraction, blocks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all that links connect, at most one fewer than sets.

    A set is compared with all later ones, unless all of them are known to be
    connected to it. With `blocks`, only pairs from unlike blocks count.
    """
    index, links = _Index(sets), []
    group = np.arange(len(sets))
    for i in range(len(sets) - 1):
        if (group[i + 1:] == group[i]).all():
            continue
        hits = index.linked(i, threshold)
        hits[:i + 1] = False
        if blocks is not None:
            hits &= blocks != blocks[i]
        for j in np.flatnonzero(hits):
            if group[j] != group[i]:
                links.append((i, int(j)))
                group[group == group[j]] = group[i]
    return links


def _edges(ids: list[bytes], links: list[tuple[int, int]]) -> pa.Table:
    sides = list(zip(*links)) or [(), ()]
    return pa.table({"a": pa.array([ids[i] for i in sides[0]], pa.binary()),
                     "b": pa.array([ids[i] for i in sides[1]], pa.binary())})


def _small_links(nodes: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Links within small nodes. A set goes once to each group of nodes, not to each node.

    Nodes with the same members are one node: the paths of a pair of copies all end in
    nodes of just these two.
    """
    lists = nodes.groupBy("node").agg(F.sort_array(F.collect_set("set_id")).alias("members")).select("members").distinct()
    lists = materialise(lists, "near-nodes")
    groups = max(1, math.ceil(lists.count() / GROUP))
    lists = lists.withColumn("at", F.pmod(F.xxhash64(F.col("members")[0]), F.lit(groups)))
    needed = lists.select(F.col("at").alias("group"), F.explode("members").alias("set_id")).distinct()
    needed = needed.join(sets, "set_id").select("group", "set_id", "tokens")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right["set_id"].to_pylist()
        tokens, place = _token_lists(right["tokens"]), {s: i for i, s in enumerate(ids)}
        links, seen = [], set()
        for members in left["members"].to_pylist():
            own = [place[m] for m in members]
            for i, j in link_forest([tokens[x] for x in own], threshold):
                if (pair := (own[i], own[j])) not in seen:
                    seen.add(pair)
                    links.append(pair)
        return _edges(ids, links)

    return lists.groupBy("at").cogroup(needed.groupBy("group")).applyInArrow(compare, "a binary, b binary")


def _cells(members: DataFrame, key: str, *kept: str) -> DataFrame:
    """Members of keys of `n` members, dealt into blocks, and each sent to the cells of its block.

    Adds `i`, `j` (the cell's blocks, i <= j) and `own` (the member's block).
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        key, "set_id", *kept, "own", F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"))


def _large_links(nodes: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Links within nodes that splitting leaves large, cell by cell."""
    cells = _cells(nodes, "node").join(sets, "set_id").select("node", "i", "j", "set_id", "tokens", "own")

    def compare(key: tuple, cell: pa.Table) -> pa.Table:
        ids = cell["set_id"].to_pylist()
        blocks = cell["own"].to_numpy() if key[1] != key[2] else None
        return _edges(ids, link_forest(_token_lists(cell["tokens"]), threshold, blocks))

    return cells.groupBy("node", "i", "j").applyInArrow(compare, "a binary, b binary")


def _split(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of the children of large nodes: node, set_id, parent_n."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for set_id, tokens, parents in zip(batch["set_id"].to_pylist(), _token_lists(batch["tokens"]), batch["parents"].to_pylist()):
                for parent in parents:
                    root = np.array([parent["node"]], np.int64)
                    out += [(int(c), set_id, parent["n"]) for c in children(tokens, root)]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
                                              pa.array(columns[2], pa.int64())], names=["node", "set_id", "parent_n"])

    parents = nodes.groupBy("set_id").agg(F.collect_list(F.struct("node", "n")).alias("parents"))
    return parents.join(sets, "set_id").select("set_id", "tokens", "parents").mapInArrow(
        step, "node long, set_id binary, parent_n long")


def candidate_links(sets: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all classes, and the token sets of those that met another set."""
    exact = Fraction(threshold).limit_denominator(1000)

    def met(members: DataFrame) -> DataFrame:
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return keyed_join(members, materialise(sizes, "near-sizes"), ["node"])

    # Equal sets have equal nodes, and are one member from here on.
    unique = materialise(sets.groupBy("set_id").agg(F.first("nodes").alias("nodes")), "near-unique")
    first = unique.select("set_id", F.explode("nodes").alias("node"))
    members = materialise(met(first).withColumn("parent_n", F.lit(2**62)), "near-members")
    needed = materialise(members.select("set_id").distinct(), "near-needed")
    tokens = keyed_join(sets.select("set_id", "tokens"), needed, ["set_id"])
    tokens = materialise(tokens.dropDuplicates(["set_id"]), "near-tokens")
    small, large = [], []
    for depth in range(1, DEPTH + 1):
        small.append(members.where(F.col("n") <= SMALL))
        # A node that its parent's split did not halve would not fall apart later either.
        stuck = (F.col("n") * 2 > F.col("parent_n")) | F.lit(depth == DEPTH)
        crowded = members.where(F.col("n") > SMALL)
        if crowded.isEmpty():
            break
        large.append(crowded.where(stuck))
        if depth < DEPTH:
            split = materialise(_split(crowded.where(~stuck), tokens), "near-split")
            members = materialise(met(split), "near-members")
    links = _small_links(reduce(DataFrame.unionByName, [m.select("node", "set_id") for m in small]), tokens, exact)
    if large:
        nodes = reduce(DataFrame.unionByName, [m.select("node", "set_id", "n") for m in large])
        links = links.unionByName(_large_links(nodes, tokens, exact))
    return materialise(links, "near-links"), tokens


def connected_classes(links: DataFrame) -> DataFrame:
    """set_id and its class, the smallest set that links lead to; sets without links are absent.

    Each round a set takes the smallest class around it and then the class of that
    class, so paths shrink to half their length or less.
    """
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-pairs")
    classes = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("set_id"), F.least("a", "b").alias("class"))
    classes = materialise(classes, "near-classes")
    while True:
        around = keyed_join(both, classes.withColumnRenamed("set_id", "b"), ["b"])
        around = around.groupBy(F.col("a").alias("set_id")).agg(F.min("class").alias("near"))
        lower = keyed_join(around, classes, ["set_id"]).select(
            "set_id", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        jump = classes.select(F.col("set_id").alias("class"), F.col("class").alias("further"))
        moved = keyed_join(lower, jump, ["class"], "left").select(
            "set_id", "old", F.least("class", "further").alias("class"))
        moved = materialise(moved, "near-classes")
        classes = moved.select("set_id", "class")
        if moved.where("class <> old").isEmpty():
            return classes


def count_links(classes: DataFrame, tokens: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Exact number of linked documents of each set in a class: set_id, links.

    `classes` has set_id, class and copies. Every set is compared with its class, in
    cells; a set's own copies are not counted here.
    """
    exact = Fraction(threshold).limit_denominator(1000)
    sizes = materialise(classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")), "near-sizes")
    sized = keyed_join(classes, sizes, ["class"])
    groups = max(1, math.ceil(classes.count() / GROUP))
    cells = keyed_join(tokens, materialise(_cells(sized, "class", "copies"), "near-cells"), ["set_id"])
    alone = (F.col("i") == 0) & (F.col("j") == 0)
    # Cells of large classes are groups of their own, classes of one block share groups.
    at = F.when(alone, F.pmod(F.xxhash64("class"), F.lit(groups))).otherwise(F.xxhash64("class", "i", "j"))
    cells = cells.select(at.alias("at"), "class", "i", "j", "own", "set_id", "copies", "tokens")

    def count(group: pa.Table) -> pa.Table:
        keys = list(zip(*(group[c].to_pylist() for c in ("class", "i", "j"))))
        tokens, copies, own = _token_lists(group["tokens"]), group["copies"].to_numpy(), group["own"].to_numpy()
        rows: dict[tuple, list[int]] = {}
        for place, key in enumerate(keys):
            rows.setdefault(key, []).append(place)
        links = np.zeros(len(keys), np.int64)
        for (_, i, j), places in rows.items():
            at, index = np.array(places), _Index([tokens[p] for p in places])
            for x, place in enumerate(places):
                hits = index.linked(x, exact)
                hits[x] = False
                if i != j:
                    hits &= own[at] != own[place]
                links[place] = copies[at][hits].sum()
        return pa.table({"set_id": group["set_id"], "links": pa.array(links)})

    return cells.groupBy("at").applyInArrow(count, "set_id binary, links long").groupBy("set_id").agg(
        F.sum("links").alias("links"))


def near_classes(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, class_size, n_links, kept.

    `class_id` is the smallest id of the class, and the row kept is that document; `n_links`
    counts the other documents it is linked to, copies included.
    """
    sets = document_sets(docs, id, text, recall, threshold)
    links, tokens = candidate_links(sets, threshold)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    by_set = sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"), F.min(first).alias("first"))
    by_set = materialise(by_set, "near-copies")
    classes = connected_classes(links)
    classed = materialise(keyed_join(by_set, classes, ["set_id"]), "near-classed")
    counted = count_links(classed.select("set_id", "class", "copies"), tokens, threshold)
    of_class = classed.groupBy("class").agg(F.min("first").alias("class_first"), F.sum("copies").alias("class_size"))
    linked = keyed_join(counted.join(classed, "set_id"), materialise(of_class, "near-firsts"), ["class"]).select(
        "set_id", "class_first", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    copied = by_set.where("copies > 1").join(classed.select("set_id"), "set_id", "left_anti").select(
        "set_id", F.col("first").alias("class_first"), F.col("copies").alias("class_size"), (F.col("copies") - 1).alias("n_links"))
    groups = materialise(linked.unionByName(copied), "near-groups")
    rows = sets.select("doc_id", "text_hash", "set_id")
    joined = keyed_join(rows, groups, ["set_id"], "left")
    alone = F.col("class_first").isNull()
    return joined.select(
        "doc_id", "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_first.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_first.doc_id"))
                  & (F.col("text_hash") == F.col("class_first.text_hash")))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text",
                     recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` of which one stays for each class. Equal rows count as one document."""
    found = near_classes(docs, id, text, recall, threshold)
    dropped = materialise(found.where(~F.col("kept")).select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__unknown"),
        F.col("text_hash").alias("__hash")).distinct(), "near-dropped")
    if is_small(dropped):
        dropped = F.broadcast(dropped)
    key = F.col(id).cast("long")
    same = (F.coalesce(key, F.lit(0)) == F.col("__id")) & (key.isNull() == F.col("__unknown")) & (
        F.xxhash64(text) == F.col("__hash"))
    return docs.join(dropped, same, "left_anti")
