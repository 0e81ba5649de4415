"""Sharding by histogram sort: equal bytes per shard, keys in order, one exchange.

Rows are ordered by a key (the id, then a row number that tells equal ids apart). The
splitters between shards are found before any row moves: every round counts the exact
bytes and rows below candidate boundaries, which are the prefixes of keys, and refines
only the prefixes in which a splitter falls. It stops when every splitter is within
the tolerance, or sits on a single row. Then the documents are exchanged once, texts
and all. Keys are written beside the documents before, so that the rows exchanged have the
very keys that the splitters were found on.

The law is `bytes`: a shard's size is within the tolerance, or one row, of its share.

Defined cases: a null text has no bytes and counts `ROW_BYTES`; a null id sorts first;
rows alike in id and text are told apart by their place, so they spread over shards; fewer
rows than shards leave shards empty; an empty table gives no rows; `shard_documents` ignores
other columns, `place_documents` and `write_shards` keep them, and replace those named shard or slot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import keyed_join
from tallyfold.session import materialise

# What a row costs besides its text.
ROW_BYTES = 8
# Hex digits that one round refines a prefix by: 256 candidate boundaries for each splitter.
STEP = 2
KEY_DIGITS = 32
# Rows of a sorted piece, a task's share of a shard, as an order of magnitude.
PIECE_ROWS = 4096


def size_of(text: str = "text") -> Column:
    return (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + ROW_BYTES).cast("long")


def keyed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their size and their sort key as 32 hex digits, `__size` and `__key`. Written once."""
    # Flipping the sign bit makes the order of the digits that of the signed ids.
    signed = F.coalesce(F.col(id).cast("long"), F.lit(-2**63))
    digits = [F.lpad(F.hex(signed.bitwiseXOR(F.lit(-2**63))), 16, "0"),
              F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")]
    return materialise(docs.withColumns({"__size": size_of(text), "__key": F.concat(*digits)}), "shard-keys")


def histogram(keyed: DataFrame, prefixes: list[str], digits: int) -> list:
    """Bytes and rows by prefix of `digits` digits, of the keys under `prefixes`.

    Comes to the driver: at most 256 rows for each prefix, and one prefix per splitter.
    """
    under = keyed
    if prefixes:
        under = keyed.where(F.substring("key", 1, len(prefixes[0])).isin(prefixes))
    counted = under.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return sorted(counted.collect())


def find_splitters(keyed: DataFrame, shards: int, tolerance: float = 0.001) -> list[str]:
    """`shards - 1` prefixes; a row belongs to the shard numbered by those at or below its key."""
    total = keyed.agg(F.sum("size"), F.min("key"), F.max("key")).first()
    if total[0] is None or shards < 2:
        return []
    size, low, high = total
    shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), KEY_DIGITS)
    targets = [size * s / shards for s in range(1, shards)]
    slack = tolerance * size / shards
    splitters: dict[int, str] = {}
    # The splitters to be found, by the prefix they fall under and the bytes below it.
    open_under: dict[str, tuple[int, list[int]]] = {low[:shared]: (0, list(range(shards - 1)))}
    digits = shared
    while open_under:
        above, digits = digits, min(digits + STEP, KEY_DIGITS)
        found = histogram(keyed, [p for p in open_under if p], digits)
        refined: dict[str, tuple[int, list[int]]] = {}
        below, parent = 0, None
        for prefix, weight, rows in found:
            if prefix[:above] != parent:
                parent = prefix[:above]
                below = open_under[parent][0]
            for s in open_under[parent][1]:
                if s in splitters or not below <= targets[s] <= below + weight:
                    continue
                near = min((abs(targets[s] - below), prefix), (abs(below + weight - targets[s]), _after(prefix)))
                if near[0] <= slack or rows == 1 or digits == KEY_DIGITS:
                    splitters[s] = near[1]
                elif not any(s in pending for _, pending in refined.values()):
                    refined.setdefault(prefix, (below, []))[1].append(s)
            below += weight
        open_under = {p: (b, [s for s in pending if s not in splitters]) for p, (b, pending) in refined.items()}
        open_under = {p: v for p, v in open_under.items() if v[1]}
    return [splitters[s] for s in range(shards - 1)]


def _after(prefix: str) -> str:
    """The smallest prefix of the same length above this one; `G` sorts above all digits."""
    number = int(prefix, 16) + 1
    return f"{number:0{len(prefix)}X}" if number < 16 ** len(prefix) else "G"


def shard_of(key: Column, splitters: list[str]) -> Column:
    """Number of the shard: how many splitters are at or below the key."""
    shard = F.lit(0)
    for splitter in splitters:
        shard = shard + (key >= F.lit(splitter)).cast("int")
    return shard


def _piece_of(digits: list[int]) -> Column:
    by_shard = F.array(*[F.lit(n) for n in digits])
    return F.substring(F.col("__key"), F.lit(1), F.element_at(by_shard, F.col("shard") + 1))


def _piece_digits(placed: DataFrame, shards: int) -> list[int]:
    """Digits of a key that name its piece, by shard: more until the shard's largest piece is small.

    Keys that lie far from the others, or on both sides of a round number, share few
    digits. Comes to the driver: one row for each shard and step.
    """
    digits = [KEY_DIGITS] * shards
    for shard, rows, low, high in placed.groupBy("shard").agg(F.count(F.lit(1)), F.min("__key"), F.max("__key")).collect():
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), KEY_DIGITS)
        digits[shard] = min(KEY_DIGITS, shared + max(1, math.ceil(math.log(rows / PIECE_ROWS + 1, 16))))
    while True:
        counted = placed.groupBy("shard", _piece_of(digits).alias("piece")).agg(F.count(F.lit(1)).alias("n"))
        large = [r.shard for r in counted.groupBy("shard").agg(F.max("n").alias("n")).collect()
                 if r.n > PIECE_ROWS and digits[r.shard] < KEY_DIGITS]
        if not large:
            return digits
        for shard in large:
            digits[shard] += 1


def place_documents(docs: DataFrame, shards: int = 24, tolerance: float = 0.001,
                    id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, moved to their shards: all columns of `docs`, then shard and slot.

    `slot` numbers a shard's rows in key order without gaps. A shard is numbered in
    pieces, ranges of keys with a few thousand rows: each piece is one group of the one
    exchange, and starts where the exact counts of the pieces before it say.
    """
    keyed = keyed_documents(docs.drop("shard", "slot"), id, text)
    splitters = find_splitters(keyed.select(F.col("__key").alias("key"), F.col("__size").alias("size")), shards, tolerance)
    placed = keyed.withColumn("shard", shard_of(F.col("__key"), splitters))
    placed = placed.withColumn("__piece", _piece_of(_piece_digits(placed, shards)))
    pieces = placed.groupBy("shard", "__piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("shard", "__piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    in_piece = Window.partitionBy("shard", "__piece").orderBy("__key")
    ranked = placed.withColumn("__at", F.row_number().over(in_piece) - 1)
    joined = keyed_join(ranked, materialise(pieces, "shard-pieces"), ["shard", "__piece"], hot_rows=None)
    return joined.withColumn("slot", F.col("__first") + F.col("__at")).drop("__size", "__key", "__piece", "__first", "__at")


def shard_documents(docs: DataFrame, shards: int = 24, tolerance: float = 0.001,
                    id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text, size, text_crc32, shard, slot; both figures are of the text that was moved."""
    plain = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    digest = F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))
    return place_documents(plain, shards, tolerance).select(
        "doc_id", "text", size_of().alias("size"), digest.alias("text_crc32"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 24, tolerance: float = 0.001,
                 id: str = "doc_id", text: str = "text") -> None:
    """Write whole documents with their slots to `path`, a folder per shard, each file in the order of slots."""
    placed = place_documents(docs, shards, tolerance, id, text)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
