"""Harmonic packing of documents into sequences of fixed capacity.

A piece of length r belongs to class k = capacity // r: the lengths of which k fit, but
not k + 1. Each bin of class k gets exactly k pieces, so bins need no search and no
look at other bins, and every worker fills its own bins in one pass over its rows.

Documents may be cut. Full sequences are cut off first. What is left is kept whole where
its class wastes little; else the largest whole share of the capacity below it is cut
off and the rest is treated alike, so few pieces fill their places almost fully.
At the end of a partition, the pieces of bins that are not full (at most k - 1 for each
of about 90 classes, a constant) are joined and cut at the capacity, which leaves one
padded sequence for each partition.

No row is shuffled. Sequence numbers hold the partition's number, so a task that runs
again writes the same sequences; read documents from a written table.

Defined cases: a null or empty text is packed as its end id alone; null and repeated ids are
packed row by row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyfold.llm.tokens import encoder
from tallyfold.llm.worker import give_back

CAPACITY = 2048
END_ID = 1
# A piece is cut further if its place would stay empty by more than this share of it.
WASTE = 64
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
                   + [("ids", pa.binary())])


def cut_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of so many tokens, in order."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        share = capacity // rest
        if (capacity // share - rest) * WASTE > rest:
            lengths.append(capacity // (share + 1))
        else:
            lengths.append(rest)
        rest -= lengths[-1]
    return lengths


class HarmonicPacker:
    """Bins of one worker. A piece is (doc_id, start, ids, doc_tokens), ids as bytes."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY):
        self._next, self._capacity = first_sequence, capacity
        self._open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        kind = self._capacity // (len(ids) // 4)
        bin = self._open.setdefault(kind, [])
        bin.append((doc_id, start, ids, doc_tokens))
        if len(bin) == kind:
            self._close(self._open.pop(kind))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, doc_tokens, self._next, offset, ids))
            offset += length
        self._next += 1

    def finish(self) -> None:
        """Join what open bins hold, cutting pieces where a sequence is full."""
        bin, room = [], self._capacity
        for _, pieces in sorted(self._open.items()):
            for doc_id, start, ids, doc_tokens in pieces:
                while ids:
                    fits, ids = ids[:4 * room], ids[4 * room:]
                    bin.append((doc_id, start, fits, doc_tokens))
                    start += len(fits) // 4
                    room -= len(fits) // 4
                    if not room:
                        self._close(bin)
                        bin, room = [], self._capacity
        if bin:
            self._close(bin)
        self._open = {}

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * len(_ARROW)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def pack_documents(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it comes from, where it lies, and its ids.

    `ids` are little-endian unsigned 32-bit; `start` counts the document's ids before the
    piece, `doc_tokens` all of them with the end id, `offset` the ids before it in its sequence.
    """
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_parts
        packer = HarmonicPacker(TaskContext.get().partitionId() << 36, capacity)
        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for part in encode(batch.column(1)):
                for ids, doc_id in zip(part, doc_ids):
                    ids += end
                    tokens, start = len(ids) // 4, 0
                    for length in cut_lengths(tokens, capacity):
                        packer.add(doc_id, start, ids[4 * start:4 * (start + length)], tokens)
                        start += length
                yield packer.take()
            give_back()
        packer.finish()
        yield packer.take()

    return docs.select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(pack, SCHEMA)
