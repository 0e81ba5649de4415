"""Packing and the token store against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import packing, token_store
from tallyfold.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ENCODERS = {path: (Encoder(path), Tokenizer.from_file(path)) for path in (BYTE, WORD)}
PIECES = ["the", "The", "Ä", "ß", "É", "é", "́", " ", "  ", "\n", "\n\n", "\t", "\r", " ", "\x1c", " ", ".", ",", "..", ".,",
          "'s", "'", "don't", "3.5", "1,000", "<|endoftext|>", "<|startoftext|>", "Σ", "ΑΣ", "İ", "ﬁ", "字", "😀", "_", "²", "½", "·", ":)", "a-b"]


def library(path, text):
    return ENCODERS[path][1].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), st.text(max_size=40)))
def test_ids_are_those_of_the_library(path, text):
    assert np.frombuffer(ENCODERS[path][0].encode([text])[0], "<u4").tolist() == library(path, text)


def test_cut_lengths():
    for n in range(1, 5000):
        lengths = packing.cut_lengths(n)
        assert sum(lengths) == n and max(lengths) <= 2048
        assert lengths[:n // 2048] == [2048] * (n // 2048)


def texts():
    rng = random.Random(3)
    long = " ".join(rng.choice(PIECES) for _ in range(20_000))
    rows = [(i, " ".join(rng.choice(PIECES[:10]) for _ in range(rng.randrange(900)))) for i in range(300)]
    return [*rows, (300, None), (301, ""), (302, long), (7, "again"), (7, "again"), (None, "no id")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").selectExpr(
        "doc_id", "text", "1 AS start", "'x' AS ids").repartition(3)


def test_packing_is_an_exact_cover(spark):
    rows = texts()
    pieces = packing.pack_documents(frame(spark, rows), BYTE).collect()
    expected = sorted((i or -1, [*library(BYTE, t or ""), 1]) for i, t in rows if i != 7)
    by_doc, by_sequence = defaultdict(dict), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_sequence[p.sequence_id].append(p)
        if p.doc_id != 7:
            assert p.start not in by_doc[p.doc_id]
            by_doc[p.doc_id][p.start] = p
    found = []
    for doc, parts in by_doc.items():
        ids = b"".join(bytes(parts[s].ids) for s in sorted(parts))
        assert all(p.doc_tokens == len(ids) // 4 for p in parts.values())
        found.append((doc or -1, np.frombuffer(ids, "<u4").tolist()))
    assert sorted(found) == expected
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    tokens = sum(p.length for p in pieces)
    assert len(by_sequence) * 2048 < tokens * 1.02 + 3 * 2048
    assert packing.pack_documents(frame(spark, []), BYTE).isEmpty()


def test_store_round_trip(spark, tmp_path, monkeypatch):
    rows, path = texts(), f"file://{tmp_path}/store"
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 50)
    token_store.write_store(frame(spark, rows), path, WORD, 49_408)
    found = token_store.read_store(spark, path).collect()
    plain = {(i, t): [*library(WORD, t or ""), 1] for i, t in rows}
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (i or -1, len(ids := plain[i, t]), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in rows)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order)
    assert token_store.read_document(spark, path, 302) == plain[rows[302]]
    with pytest.raises(KeyError):
        token_store.read_document(spark, path, 10**9)
    ids = token_store.read_store(spark, path, digest=False).where("doc_id = 5").first().ids
    assert ids == plain[rows[5]]


def test_empty_store(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(frame(spark, []), path, WORD, 49_408)
    assert token_store.read_store(spark, path).isEmpty()


def test_long_pieces_are_not_kept():
    from tallyfold.llm.queries import vocabulary
    from tallyfold.llm.tokens import LONGEST_KEPT, Encoder

    found = Encoder(vocabulary("byte_bpe_50k.json"), "<u4")
    texts = ["\u6f22" * 5_000, "a" * 5_000, "plain words " * 50]
    assert found.encode(texts) == Encoder(vocabulary("byte_bpe_50k.json"), "<u4").encode(texts)
    assert found._pieces and max(map(len, found._pieces)) <= LONGEST_KEPT


def test_other_work_drops_what_a_worker_holds():
    import weakref

    import pyarrow as pa
    from pyspark.sql.types import LongType, StructField, StructType, StringType

    from tallyfold.llm import toxicity
    from tallyfold.llm.tokens import encoder

    class Rows:
        schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
        columns = schema.names

        def drop(self, *names):
            return self

        def mapInArrow(self, work, schema):
            return work

    kept = weakref.ref(encoder(BYTE))
    assert encoder(BYTE) is kept()
    scored = list(toxicity.score_toxicity(Rows(), None)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a"]})])))
    assert scored[0].num_rows == 1
    assert kept() is None
    kept = weakref.ref(encoder(BYTE))
    encoder(WORD)
    assert kept() is None


def test_training_holds_a_block_beside_its_sample(monkeypatch):
    import tracemalloc

    from tallyfold.llm import toxicity

    rng = random.Random(1)
    monkeypatch.setattr(toxicity, "BUCKETS", 2**12)
    texts = [" ".join(f"{rng.randrange(10**9):x}" for _ in range(300)) for _ in range(300)]
    sample = toxicity.sample_from_texts(texts, [i % 2 for i in range(len(texts))])
    monkeypatch.setattr(toxicity, "EPOCHS", 2)

    def trained(block):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        tracemalloc.start()
        model = toxicity.train(sample)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return model, peak

    (small, less), (whole, more) = trained(2**10), trained(2**40)
    assert np.array_equal(small.vectors, whole.vectors) and np.array_equal(small.weights, whole.weights)
    assert (small.slope, small.shift) == (whole.slope, whole.shift)
    assert less < 0.8 * more


def _distinct_words(n):
    return ["".join("abcdefghijklmnop"[i >> 4 * k & 15] for k in range(5)) for i in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_worker_keeps_a_bounded_number_of_ids(path):
    found = Encoder(path)
    words = _distinct_words(260_000)
    for at in range(0, len(words), 20_000):
        some = words[at:at + 20_000]
        found.encode([" ".join(some), ", ".join(some), " ".join(w + "!?" for w in some)])
    assert sum(len(x) for x in vars(found).values() if isinstance(x, dict) and x is not found._letters) <= 200_000


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_encoded_once_whatever_marks_end_it(path, monkeypatch):
    found, words = Encoder(path), _distinct_words(500)
    texts = ["x " + " ".join(w + mark for w in words) for mark in ("", ".", "##", "!!", ",%%", "_")]
    seen = []
    plain = found._encode
    monkeypatch.setattr(found, "_encode", lambda pieces: seen.extend(pieces) or plain(pieces))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found.encode(texts)] == [library(path, t) for t in texts]
    assert len(seen) < 20


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_parts_of_a_column_have_the_ids_of_its_rows(path, monkeypatch):
    import pyarrow as pa

    from tallyfold.llm import tokens

    rows = [None, "", "plain words", "two  spaces \n here", "word!\n", " a", "Ärger. so\nweiter", "a" * 500, *texts()[0][1:], None]
    monkeypatch.setattr(tokens, "PART_BYTES", 100)
    column = pa.array(["before", *rows], pa.string()).slice(1)
    parts = list(ENCODERS[path][0].encode_parts(column))
    assert len(parts) > 3
    assert [np.frombuffer(ids, "<u4").tolist() for part in parts for ids in part] == [library(path, t or "") for t in rows]
    assert list(ENCODERS[path][0].encode_parts(column.slice(0, 0))) == []
    assert ENCODERS[path][0].encode([]) == []
    large = column.cast(pa.large_string())
    assert ENCODERS[path][0].encode(large) == ENCODERS[path][0].encode(column)


@pytest.mark.parametrize("gap", ["  ", "\n    ", "\n\n ", " \t ", "\u3000 "])
def test_words_between_wide_gaps_are_encoded_once(gap, monkeypatch):
    found, words = Encoder(BYTE), _distinct_words(500)
    texts = [f"x{gap}y " + " ".join(w + mark for w in words) + gap for mark in ("", ".", "##", "!!", ",%%")]
    seen = []
    plain = found._encode
    monkeypatch.setattr(found, "_encode", lambda pieces: seen.extend(pieces) or plain(pieces))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found.encode(texts)] == [library(BYTE, t) for t in texts]
    assert len(seen) < 30
