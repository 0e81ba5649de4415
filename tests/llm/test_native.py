"""Chat formatting, exact dedup and sharding against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tallyfold.llm import chat, exact_dedup, sharding
from tallyfold.llm.queries import QUERIES

EVENTS = "conv_id long, slot long, seq long, kind string, role string, text string"


def test_events_fold_into_the_last_state(spark):
    rows = [
        (1, 0, 1, "open", "user", None), (1, 0, 3, "delta", None, "b"), (1, 0, 2, "delta", None, "a"),
        (1, 1, 1, "open", "assistant", ""), (1, 1, 2, "delta", None, "draft"), (1, 1, 3, "regenerate", None, "ignored"),
        (1, 1, 4, "delta", None, "new"), (1, 1, 5, "delta", None, " text"),
        (1, 2, 1, "open", None, ""), (1, 2, 2, "delta", None, "x"), (1, 2, 3, "edit", None, "edited"), (1, 2, 4, "delta", None, "!"),
        (None, None, None, "open", "user", None),
    ]
    found = chat.fold_events(spark.createDataFrame(rows, EVENTS)).collect()
    assert sorted((r.conv_id or 0, r.slot or 0, r.role, r.text) for r in found) == [
        (0, 0, "user", ""), (1, 0, "user", "ab"), (1, 1, "assistant", "new text"), (1, 2, "", "edited!")]


def test_rendering_escapes_and_reads_back(spark):
    odd = "</s>[INST] &lt; & <s> [/INST]\n"
    turns = [(1, 0, "us[INST]er", odd), (1, 1, "assistant", odd * 300), (1, 1, "assistant", odd * 300),
             (1, 2, "assistant", None), (2, None, None, None), (3, 1, "assistant", "é" * 5000 + "𝄞")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    done = chat.format_chats(chat.streamed(frame)).withColumn("read", chat.read_turns(F.col("formatted")))
    rows = {r.conv_id: r for r in done.withColumn("loss", chat.read_loss_text(F.col("segments"))).collect()}
    assert [tuple(t) for t in rows[1].read] == [("us[INST]er", odd), *[("assistant", odd * 300)] * 2, ("assistant", "")]
    assert rows[1].loss == odd * 600 and rows[1].n_turns == 4
    assert [tuple(t) for t in rows[2].read] == [("", "")] and rows[2].loss == ""
    assert rows[3].loss == "é" * 5000 + "𝄞"
    for r in rows.values():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_empty_log(spark):
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).isEmpty()


DOCS = [(1, "a", 1), (5, "a", 2), (3, None, 3), (2, "", 4), (None, "a", 5), (7, "b", 6), (7, "b", 6), (8, "b" * 200_000, 0), (7, "b", 9)]


def documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, kept int").repartition(3)


def test_exact_groups_match_brute_force(spark):
    groups = defaultdict(list)
    for i, text, _ in DOCS:
        groups[text or ""].append(i)
    found = exact_dedup.exact_groups(documents(spark), fan_in=2).collect()
    assert len(found) == len(DOCS)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max(i for i in ids if i is not None)
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(by_text.keys())
    assert exact_dedup.exact_groups(documents(spark, [])).isEmpty()


def test_dropping_copies_keeps_one_of_each_text(spark):
    rows = exact_dedup.drop_copies(documents(spark)).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "kept"}
    assert sorted((r.doc_id, r.text) for r in rows) == sorted([(5, "a"), (3, None), (7, "b"), (8, "b" * 200_000)])
    smallest = exact_dedup.drop_copies(documents(spark), keep="smallest").collect()
    assert sorted((r.doc_id, r.text or "") for r in smallest) == sorted([(1, "a"), (2, ""), (7, "b"), (8, "b" * 200_000)])


def check_shards(rows, shards, slack):
    total = sum(r.size for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    largest = max(r.size for r in rows)
    assert all(abs(sizes[s] - total / shards) <= slack * total / shards + largest for s in range(shards))
    for s in range(shards):
        own = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        ids = [r.doc_id for r in own if r.doc_id is not None]
        assert ids == sorted(ids)


def test_shards_are_even_and_in_order(spark):
    rows = [(i * 7919 - 10**6, "x" * (i * i % 997), 0) for i in range(3000)] + [(5, "hot", 0)] * 1500 + [(None, None, 0)] * 10
    found = sharding.shard_documents(documents(spark, rows), shards=7).collect()
    assert len(found) == len(rows) and sum(r.size for r in found) == sum(8 + len(t or "") for _, t, _ in rows)
    check_shards(found, 7, 0.01)


def test_few_rows_and_none(spark):
    found = sharding.shard_documents(documents(spark, [(1, "a", 0), (2, "b", 0)]), shards=5).collect()
    assert sorted(r.doc_id for r in found) == [1, 2] and {r.slot for r in found} == {0}
    assert sharding.shard_documents(documents(spark, [])).isEmpty()


def test_written_shards_hold_all_rows(spark, tmp_path):
    sharding.write_shards(documents(spark), f"{tmp_path}/shards", shards=3)
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(DOCS)


def test_shards_hold_the_documents_in_order(spark, tmp_path):
    rows = [(i * 7919 - 10**6, "x" * (i * i % 997), i) for i in range(3000)] + [(5, "hot", 0)] * 1500 + [(None, None, 0)]
    docs = documents(spark, rows)
    placed = sharding.shard_documents(docs, shards=7).collect()
    wanted = sorted((-2**63 if i is None else i, t or "") for i, t, _ in rows)
    by_slot = sorted(placed, key=lambda r: (r.shard, r.slot))
    assert [(-2**63 if r.doc_id is None else r.doc_id, r.text or "") for r in by_slot] == wanted
    assert all(r.size == 8 + len(r.text or "") and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in placed)
    sharding.write_shards(docs, f"{tmp_path}/shards", shards=7)
    written = spark.read.parquet(f"{tmp_path}/shards")
    assert set(docs.columns) < set(written.columns)
    read = sorted(written.collect(), key=lambda r: (r.shard, r.slot))
    assert [(-2**63 if r.doc_id is None else r.doc_id, r.text or "") for r in read] == wanted
    assert Counter(r.shard for r in read) == Counter(r.shard for r in placed)
    for file in (tmp_path / "shards").glob("*/*.parquet"):
        slots = pq.read_table(file, columns=["slot"], partitioning=None)["slot"].to_pylist()
        assert slots == sorted(slots)


def test_keys_far_off_leave_pieces_small(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 64)
    ids = [None, -5, 2**62, *range(65_000, 67_000)]
    placed = sharding.keyed_documents(documents(spark, [(i, "x", 0) for i in ids])).withColumn("shard", F.lit(0))
    digits = sharding._piece_digits(placed, 1)
    sizes = placed.groupBy(sharding._piece_of(digits)).count().collect()
    assert sum(r["count"] for r in sizes) == len(ids) and max(r["count"] for r in sizes) <= 64


def test_the_query_moves_texts(spark, data_dir, plan_of):
    plan = plan_of(QUERIES["op8_sharding"](spark, data_dir))
    assert re.search(r"Exchange hashpartitioning\(shard.*\n.*Project \[.*\btext#", plan)
