"""Exact top-k search by inner product: MaxScore over shards of quantised vectors.

A component x becomes floor(256 * x). The dimensions are the query's terms, and a
shard's vectors have a posting for each. Over a span of a shard, a term's contribution lies
between two bounds, from the smallest and the largest value in its postings. Terms are
ordered by the distance of their bounds, for a block of queries at once; the first ones,
which together cannot lift a vector above the k-th best score so far of any of the
queries, are non-essential. The postings of the essential terms are traversed, then the
non-essential ones are probed, the widest first, only for vectors that are still
competitive. Shards give k rows for each query, and these are merged.

Tasks pack vectors and queries into blocks, which cross an exchange once; every task then reads
a part of either kind and no block is copied for each block of the other kind. Queries are
held, up to `QUERY_PART` at a time, and vectors stream past them. The query set is stated by
the caller; work and reads grow with the product of queries and vectors, disk and memory do not.

Scores are summed as float32, float64 or int64, the first that holds every sum exactly.

Defined cases: vectors that are null or hold null or non-finite components take no
part, nor do rows without an id; a shorter vector has zeros after its end; a query's own id is
never among its results; of repeated query ids the smallest vector asks; repeated
candidates are each a result; equal scores go to the smaller id; fewer than k
candidates are all returned; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
VECTOR_BLOCK, QUERY_BLOCK = 4096, 1024
# A block has no more values than this, counted as if all its vectors were as long as the longest.
BLOCK_VALUES = 1 << 20
# Queries that a task holds.
QUERY_PART = 16 * 1024
# Pairs of a query and a vector that a task compares, and tasks that even a small search is cut into.
TASK_PAIRS, LEAST_TASKS = 1 << 28, 8
# Vectors of a block that are looked at together: the first ones give the later ones a threshold.
STRIDE = 256
# Non-essential terms probed before the competitive vectors are counted anew.
PROBES = 8
# Share of a span's pairs from which on they are probed one by one.
SPARSE = 1 / 64
# No sum of products is pruned beyond this.
_MOST = 1 << 61
_RESULT = "query_id long, vec_id long, score long"
_BLOCK = "ids binary, sizes binary, kind string, v binary"


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and whole-number components of the vectors that take part."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.where(F.col(vector).isNotNull() & usable & F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("v"))


class Best:
    """The k best (score, id) so far of each query of a block, in rows sorted by query, score and id."""

    def __init__(self, queries: int, k: int):
        self.queries, self.k = queries, k
        self.rows, self.scores, self.ids = (np.empty(0, np.int64) for _ in range(3))

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        rows, scores, ids = (np.concatenate(p) for p in ((self.rows, rows), (self.scores, scores), (self.ids, ids)))
        # ~x falls as x grows, for every x.
        order = np.lexsort((ids, ~scores, rows))
        rows = rows[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < self.k
        self.rows, self.scores, self.ids = rows[first], scores[order][first], ids[order][first]

    def thresholds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which queries have k rows, and of these the last row's score and id; others have zeros."""
        counts = np.bincount(self.rows, minlength=self.queries)
        full, last = counts == self.k, np.cumsum(counts) - 1
        scores, ids = np.zeros(self.queries, np.int64), np.zeros(self.queries, np.int64)
        scores[full], ids[full] = self.scores[last[full]], self.ids[last[full]]
        return full, scores, ids


def _exact_kind(queries: np.ndarray, vectors: np.ndarray) -> tuple[type, bool]:
    """The fastest type that holds all sums of products and distances of bounds exactly, and whether int64 does."""
    most = [np.abs(m.astype(np.float64)).max(0, initial=0) for m in (queries, vectors)]
    bound = float(most[0] @ most[1])
    return next((kind for kind, bits in ((np.float32, 22), (np.float64, 51)) if bound < 2.0**bits), np.int64), bound < _MOST


def _competitive(queries: np.ndarray, vectors: np.ndarray, prune: bool, full: np.ndarray, threshold: np.ndarray):
    """(query, vector, score) of the pairs of a span that may reach the queries' thresholds, by MaxScore."""
    asking, others = np.arange(len(queries)), np.empty(0, np.int64)
    terms = np.arange(queries.shape[1])
    if prune and full.all() and queries.shape[1]:
        least, most = vectors.min(0), vectors.max(0)
        low, high = np.minimum(queries * least, queries * most), np.maximum(queries * least, queries * most)
        terms = np.argsort((high - low).sum(0, dtype=np.float64), kind="stable")
        # The most that a vector can get beyond all lower bounds, by the first terms alone.
        reach = np.cumsum((high - low)[:, terms], 1)
        split = (reach < (threshold - low.sum(1))[:, None]).sum(1)
        asking = np.flatnonzero(split < len(terms))
        if not len(asking):
            return (np.empty(0, np.int64),) * 3
        split = int(split[asking].min())
        terms, others = terms[split:], terms[:split][::-1]
    full, threshold = full[asking], threshold[asking]
    part = queries if len(asking) == len(queries) else queries[asking]
    score = part[:, terms] @ vectors[:, terms].T if len(others) else part @ vectors.T
    # While many pairs are competitive all are probed at once, by products of matrices.
    step = PROBES
    while True:
        rest = high[asking][:, others].sum(1) if len(others) else np.zeros(len(asking), score.dtype)
        keep = score >= (threshold - rest)[:, None]
        keep[~full] = True
        if not len(others) or np.count_nonzero(keep) <= SPARSE * keep.size:
            break
        probed, others, step = others[:step], others[step:], 2 * step
        score += part[:, probed] @ vectors[:, probed].T
    row, vector = np.nonzero(keep)
    score = score[row, vector]
    for at in range(0, len(others), PROBES):
        probed = others[at:at + PROBES]
        score = score + (part[row[:, None], probed] * vectors[vector[:, None], probed]).sum(1)
        rest = high[asking][:, others[at + PROBES:]].sum(1)
        keep = score + rest[row] >= threshold[row]
        row, vector, score = row[keep], vector[keep], score[keep]
    return asking[row], vector, score.astype(np.int64)


def search_shard(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, best: Best | None = None,
) -> Best:
    """The k best vectors for each query, by MaxScore, of a shard and of the ones that `best` comes from."""
    best = best or Best(len(query_ids), k)
    width = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :width], vectors[:, :width]
    kind, prune = _exact_kind(queries, vectors)
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    at = 0
    while at < len(ids):
        full, threshold, last = best.thresholds()
        # Without thresholds all vectors of a span compete, with them few do.
        span = slice(at, at := at + (len(ids) if full.all() else STRIDE))
        bar = np.clip(threshold, -_MOST, _MOST) if prune else threshold
        row, vector, score = _competitive(queries, vectors[span], prune, full, bar.astype(kind))
        found = ids[span][vector]
        wins = (found != query_ids[row]) & (~full[row] | (score > threshold[row]) | ((score == threshold[row]) & (found < last[row])))
        if wins.any():
            best.add(row[wins], score[wins], found[wins])
    return best


def _packed(batch: pa.RecordBatch, size: int, most: int) -> Iterator[tuple]:
    """A batch's rows as blocks of at most `size` vectors and `most` values, counting all as long as the longest."""
    lists = batch.column("v")
    ids, values = batch.column("vec_id").to_numpy(), lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(ids):
        longest = np.maximum.accumulate(sizes[at:at + size])
        to = at + max(1, int((np.arange(1, len(longest) + 1) * longest <= most).sum()))
        held = values[ends[at]:ends[to]]
        least, greatest = held.min(initial=0), held.max(initial=0)
        kind = next(t for t in map(np.iinfo, (np.int16, np.int32, np.int64)) if t.min <= least and greatest <= t.max).dtype
        yield ids[at:to].tobytes(), sizes[at:to].astype(np.int32).tobytes(), kind.name, held.astype(kind).tobytes()
        at = to


def _blocks(rows: DataFrame, size: int, count: int, parts: int, prefix: str) -> DataFrame:
    """Rows packed into blocks of up to `size` by the tasks that have them; blocks are dealt to `parts` partitions.

    Few tasks pack, so that blocks get full, and rows are sorted, so that a task run again makes the same blocks.
    """
    most = BLOCK_VALUES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= size:
                yield from out(waiting)
                waiting = []
        if waiting:
            yield from out(waiting)

    def out(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _packed(pa.concat_batches(waiting), size, most):
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in block], names=["ids", "sizes", "kind", "v"])

    few = rows.coalesce(max(1, math.ceil(count / size))).sortWithinPartitions("vec_id", "v")
    packed = few.mapInArrow(pack, _BLOCK).repartition(parts)
    return packed.select([F.col(c).alias(f"{prefix}_{c}") for c in packed.columns])


def _matrix(block: list[pa.Scalar]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a matrix of a block, as wide as its longest vector."""
    ids, sizes = np.frombuffer(block[0].as_buffer(), np.int64), np.frombuffer(block[1].as_buffer(), np.int32)
    values = np.frombuffer(block[3].as_buffer(), block[2].as_py())
    matrix = np.zeros((len(ids), int(sizes.max())), np.int64)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = values
    return ids, matrix


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query.

    Both frames are of `quantised` vectors; `queries` is the stated query set.
    """
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_queries, n_vectors = asked.count(), vectors.count()
    query_parts = max(1, math.ceil(n_queries / QUERY_PART))
    tasks = max(LEAST_TASKS, math.ceil(n_queries * n_vectors / TASK_PAIRS))
    vector_parts = max(1, min(math.ceil(tasks / query_parts), math.ceil(n_vectors / VECTOR_BLOCK)))
    asked = _blocks(asked, QUERY_BLOCK, n_queries, query_parts, "asked")
    held = _blocks(vectors, VECTOR_BLOCK, n_vectors, vector_parts, "held")
    # A join that sends one side to all, or copies it, would take memory or disk that grow with the product.
    cells = held.crossJoin(asked.hint("shuffle_replicate_nl"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The queries of a task, by their block's first id, with what the vectors so far gave.
        best: dict[int, tuple[np.ndarray, Best]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                cell = [column[i] for column in batch.columns]
                (ids, shard), (query_ids, asks) = _matrix(cell[:4]), _matrix(cell[4:])
                _, found = best.get(int(query_ids[0]), (None, None))
                best[int(query_ids[0])] = query_ids.copy(), search_shard(asks, query_ids, shard, ids, k, found)
        for query_ids, found in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (query_ids[found.rows], found.ids, found.scores)],
                                             names=["query_id", "vec_id", "score"])

    found = cells.mapInArrow(search, _RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
