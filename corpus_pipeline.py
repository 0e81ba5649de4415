"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of
documents and work on every row that the stage before kept.

Defined cases, for all stages: a null text is the empty text, a null id an id like any other; whole texts
are read, however long; an empty table stays empty; further columns are carried along as they
are, also those named as columns that a stage works with, such as `score` or `tokens`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import exact_dedup, mixing, near_join, packing, toxicity
from tallyfold.llm.queries import table, vocabulary
from tallyfold.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def beside(docs: DataFrame, added: set[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `work` returns, with the columns of `docs`; those named as a column it adds keep their values."""
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in added}
    names = [F.col(aside.get(c, f"`{c}`")).alias(c) for c in docs.columns]
    return work(docs.withColumnsRenamed(aside)).select(*names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of its input.

    An empty text scores like no words at all and stays; repeated rows score alike; without labels nothing goes.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return beside(docs, {"score", "predicted"}, lambda rows: toxicity.score_toxicity(rows, model).where("predicted = 0"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id, a null id being the smallest.

    Null and empty texts are one group. Of rows alike in all columns one stays.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id, a null id being the largest.

    Texts of fewer than five words are compared as a whole.
    """
    return near_join.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of source, language and kind of text.

    Null sources and languages are values of their own. A text without words counts as one token. Rows
    of the same id are drawn alike where their cells are.
    """
    work = {"topic", "tokens", "probability", "kept"}
    return beside(docs, work, lambda rows: mixing.mix_documents(rows, unmet=mixing.UNMET).where("kept"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens, with their ids.

    An empty text is its end mark alone; repeated rows are packed each; further columns are left out.
    """
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

# A trained model, sampled paths and a tokenizer are beyond SQL: stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; ids come back as a checksum of each piece."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
