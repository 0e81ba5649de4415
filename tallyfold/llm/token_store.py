"""Token ids on disk: one zstandard frame per document, a shared dictionary, an offset index.

The format is a folder with two Parquet tables:

* `dictionary`: one row, the zstandard dictionary, its SHA-256 and the width of an id;
* `blocks`: rows of at most `BLOCK_BYTES` of frames, in ascending document order. A
  block has its shard and number, the hash of its dictionary, the first and last document,
  the sum of tokens, the frames one after another, and the index: document ids, the offset of
  each frame and the number of ids in it. One document is read by one frame.

The dictionary is trained on the serialized ids of a bounded sample: documents whose hash
falls in a share that gives about `SAMPLE` of them, at most twice that, and of these the
first `SAMPLE_IDS` ids. It only affects the size of the files, never what is read.

Documents are exchanged once, as texts, ranged by id. Rows with the same id are ordered by
a hash of their text and may spread over tasks.

Defined cases: a null or empty text holds its end id alone; a null id sorts first; repeated rows are
stored each; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.tokens import encoder
from tallyfold.operators.joins import keyed_join

END_ID = 1
SAMPLE, SAMPLE_IDS = 1_000, 2_048
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES = 4 * 1024 * 1024
BLOCK_DOCS = 4096
LEVEL = 3
_BLOCKS = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("dictionary", pa.string()),
    ("first_id", pa.int64()), ("last_id", pa.int64()), ("tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("frames", pa.binary()),
])
_BLOCKS_SQL = ("shard int, block int, dictionary string, first_id long, last_id long, tokens long, "
               "doc_ids array<long>, offsets array<long>, counts array<long>, frames binary")


def train_dictionary(docs: DataFrame, tokenizer: str, id: str, text: str, dtype: str) -> bytes:
    """A dictionary for ids of this corpus; empty where the sample is too small to train one."""
    rows = docs.count()
    share = max(1, rows // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64(id), F.lit(share)) == 0).select(F.substring(text, 1, 4 * SAMPLE_IDS))
    texts = [r[0] for r in sample.limit(2 * SAMPLE).collect()]
    width = np.dtype(dtype).itemsize
    arrays = [ids[:SAMPLE_IDS * width] for ids in encoder(tokenizer, dtype).encode(texts) if ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def write_store(docs: DataFrame, path: str, tokenizer: str, vocabulary: int,
                id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every document and write the store at `path`."""
    spark = docs.sparkSession
    dtype = "<u2" if vocabulary <= 2**16 else "<u4"
    raw = train_dictionary(docs, tokenizer, id, text, dtype)
    name = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(name, dtype, bytearray(raw))], "dictionary string, dtype string, bytes binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, dtype).encode_parts, np.array([end_id], dtype).tobytes()
        width = np.dtype(dtype).itemsize
        compress = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(raw)).compress
        shard, block, held = TaskContext.get().partitionId(), 0, []
        size = 0

        def cut() -> pa.RecordBatch:
            ids, counts, frames = zip(*held)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])[:-1]])
            values = [shard, block, name, ids[0], ids[-1], sum(counts), list(ids), offsets.tolist(),
                      list(counts), b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCKS)], schema=_BLOCKS)

        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for part in encode(batch.column(1)):
                for ids, doc_id in zip(part, doc_ids):
                    ids += end
                    frame = compress(ids)
                    held.append((doc_id, len(ids) // width, frame))
                    size += len(frame)
                    if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCS:
                        yield cut()
                        block, held, size = block + 1, [], 0
        if held:
            yield cut()

    # All columns are computed before the exchange, so that what is sampled to find the ranges is cheap.
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(F.col(text)).alias("hash"))
    ordered = slim.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash")
    ordered.select("doc_id", "text").mapInArrow(store, _BLOCKS_SQL).write.parquet(f"{path}/blocks")


def _opened(spark: SparkSession, path: str) -> tuple[str, str, bytes]:
    name, dtype, raw = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(raw)
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError("the dictionary does not have the hash it is stored under")
    return name, dtype, raw


def _decode(row: dict, name: str, dtype: str, decompress, wanted=None):
    """(doc_id, ids) of a block's documents, as arrays of `dtype`."""
    if row["dictionary"] != name:
        raise ValueError(f"block {row['shard']}/{row['block']} was written with another dictionary")
    ends = [*row["offsets"][1:], len(row["frames"])]
    for doc_id, start, stop, count in zip(row["doc_ids"], row["offsets"], ends, row["counts"]):
        if wanted is None or doc_id == wanted:
            ids = np.frombuffer(decompress(row["frames"][start:stop]), dtype)
            if len(ids) != count:
                raise ValueError(f"document {doc_id} has {len(ids)} ids, its index says {count}")
            yield doc_id, ids


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """Ids of one document: only the blocks whose range holds it are read, and one frame."""
    name, dtype, raw = _opened(spark, path)
    decompress = zstandard.ZstdDecompressor(**_dictionary(raw)).decompress
    rows = spark.read.parquet(f"{path}/blocks").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    for row in rows.orderBy("shard", "block").toLocalIterator():
        for _, ids in _decode(row.asDict(), name, dtype, decompress, doc_id):
            return ids.tolist()
    raise KeyError(doc_id)


def block_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each block: sums within its shard, and over the shards before it.

    Shards are as many as tasks wrote the store, so their sums are one small window.
    """
    shards = blocks.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("shard", "block", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("in_shard")) \
        .join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("block_start"))


def read_store(spark: SparkSession, path: str, digest: bool = True) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, and its ids.

    `digest` gives ids_crc32, of the ids as little-endian unsigned 32-bit integers, in
    place of `ids` array<int>.
    """
    name, dtype, raw = _opened(spark, path)
    kind = pa.int64() if digest else pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("block", pa.int32()),
                        ("in_block", pa.int64()), ("n_tokens", pa.int64()), ("ids", kind)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(**_dictionary(raw)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                out, at = [], 0
                for doc_id, ids in _decode(row, name, dtype, decompress):
                    held = zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype("<i4").tolist()
                    out.append((doc_id, row["shard"], row["block"], at, len(ids), held))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    blocks = spark.read.parquet(f"{path}/blocks")
    slim = blocks.select("shard", "block", "dictionary", "doc_ids", "offsets", "counts", "frames")
    ids = "ids long" if digest else "ids array<int>"
    found = slim.mapInArrow(decode, f"doc_id long, shard int, block int, in_block long, n_tokens long, {ids}")
    starts = block_starts(blocks.select("shard", "block", "tokens"))
    return keyed_join(found, starts, ["shard", "block"], hot_rows=None).select(
        "doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens",
        F.col("ids").alias("ids_crc32" if digest else "ids"))
