"""Top-k search, near join, WARC, mixing and toxicity against brute force, and the pipeline."""

import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyfold.llm import mixing, near_join, topk, toxicity, warc
from tallyfold.llm.queries import vocabulary
from tallyfold.session import materialise

VECTORS = "vec_id long, embedding array<float>, score int"


def vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).round(1 if i % 3 else 3)], 1) for i in range(1500)]
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 1),
             (None, [1.0] * 8, 1), (2004, [], 1), (2005, [0.5], 1), (3, [0.25] * 8, 2)]
    return rows, spark.createDataFrame(rows, VECTORS).repartition(4)


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_is_exact(spark, monkeypatch, k):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 300)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rows, frame = vectors(spark)
    plain = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in plain:
        if i % 50 == 0 or i in (3, 2004):
            asked[i] = min(asked.get(i, v), v)
    quantised = topk.quantised(frame)
    found = topk.top_k(quantised, quantised.where("vec_id % 50 = 0 or vec_id in (3, 2004)"), k).collect()
    by_query = defaultdict(list)
    for r in sorted(found, key=lambda r: r.rank):
        by_query[r.query_id].append((r.rank, r.vec_id, r.score))
    assert by_query.keys() == asked.keys()
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in plain if i != q)[:k]
        assert by_query[q] == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


def test_top_k_of_few_or_none(spark):
    few = topk.quantised(spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], VECTORS))
    assert [tuple(r) for r in topk.top_k(few, few.where("vec_id = 1")).collect()] == [(1, 1, 2, 256 * 512)]
    none = topk.quantised(spark.createDataFrame([], VECTORS))
    assert topk.top_k(none, none).isEmpty()


def test_top_k_neither_broadcasts_nor_copies_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 4)], 1) for i in range(60)]
    quantised = topk.quantised(spark.createDataFrame(rows, VECTORS))
    found = topk.top_k(quantised, quantised.where("vec_id % 5 = 0"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


@pytest.mark.parametrize("scale", [3, 2_000, 20_000_000, 900_000_000])
def test_search_of_shards_is_exact_at_every_scale(monkeypatch, scale):
    # Small numbers are summed as float32, larger ones as float64 and int64; there are ties, and repeated ids.
    monkeypatch.setattr(topk, "STRIDE", 16)
    rng = np.random.default_rng(scale)
    queries = rng.integers(-scale, scale + 1, (30, 24)) * rng.integers(0, 2, (30, 24))
    shards = [(rng.integers(0, 200, n), rng.integers(-s, s + 1, (n, w))) for n, w, s in
              ((100, 24, scale), (1, 30, scale), (90, 20, 2), (200, 24, scale), (7, 1, 1))]
    best = None
    for ids, vectors in shards:
        best = topk.search_shard(queries, np.arange(30), vectors, ids, 5, best)
    wide = np.vstack([np.pad(v[:, :24], ((0, 0), (0, 24 - min(24, v.shape[1])))) for _, v in shards]).tolist()
    all_ids = np.concatenate([ids for ids, _ in shards]).tolist()
    for q, query in enumerate(queries.tolist()):
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for v, i in zip(wide, all_ids) if i != q)[:5]
        mine = best.rows == q
        assert [(-s, i) for s, i in zip(best.scores[mine].tolist(), best.ids[mine].tolist())] == scores


def test_blocks_of_vectors_are_bounded_by_their_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 100)
    rows = [(i, [0.5] * (90 if i == 7 else i % 9), 1) for i in range(50)]
    vectors = topk.quantised(spark.createDataFrame(rows, VECTORS))
    blocks = topk._blocks(vectors, 20, 50, 2, "held").toArrow().to_pylist()
    matrices = [topk._matrix([pa.scalar(b[f"held_{c}"]) for c in ("ids", "sizes", "kind", "v")]) for b in blocks]
    assert sorted(np.concatenate([ids for ids, _ in matrices]).tolist()) == list(range(50))
    assert all(m.size <= 100 and len(m) <= 20 for _, m in matrices)
    assert sum(m.sum() for _, m in matrices) == 128 * (90 + sum(i % 9 for i in range(50) if i != 7))


def near_documents():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(3, 150)))) for i in range(150)]
    for base, size in ((200, 40), (300, 3), (400, 2), (500, 90)):
        text = [rng.choice(words) for _ in range(200)]
        for i in range(size):
            edited = list(text)
            for _ in range(rng.randrange(0, 8)):
                edited[rng.randrange(200)] = rng.choice(words)
            rows.append((base + i, " ".join(edited)))
    rows += [(600 + i, passage + " " + " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    rows += [(700, None), (701, ""), (702, " \n"), (703, "one two"), (704, "One  TWO"), (705, "one"), (None, rows[0][1]),
             (0, rows[0][1]), (706, rows[0][1]), (707, "lange " * 50_000)]
    return rows


@pytest.mark.parametrize("small, block", [(64, 1024), (3, 8)])
def test_near_classes_match_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_join, "SMALL", small)
    monkeypatch.setattr(near_join, "BLOCK", block)
    monkeypatch.setattr(near_join, "GROUP", 20)
    rows = near_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"kept": F.lit(0), "class_id": F.lit("x")}).repartition(4)
    found = near_join.near_classes(docs).collect()
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            if 9 * len(a & sets[j]) >= 4 * (len(a) + len(sets[j])):
                links[i].add(j)
                links[j].add(i)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        stack = [i]
        while stack:
            x = stack.pop()
            for y in links[x]:
                if group[y] != group[i]:
                    group[y] = group[i]
                    stack.append(y)
    members = defaultdict(list)
    for i, g in enumerate(group):
        members[g].append(i)
    key = lambda i: (i is None, i or 0)
    expected = Counter()
    for i, (doc, _) in enumerate(rows):
        own = members[group[i]]
        expected[doc, min((rows[m][0] for m in own), key=key), len(own), len(links[i])] += 1
    assert Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in found) == expected
    kept = {r.doc_id for r in found if r.kept}
    assert kept == {min((rows[m][0] for m in own), key=key) for own in members.values()}
    left = near_join.drop_near_copies(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_near_classes_of_nothing(spark):
    assert near_join.near_classes(spark.createDataFrame([], "doc_id long, text string")).isEmpty()
    one = near_join.near_classes(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert [(r.class_id, r.n_links, r.kept) for r in one] == [(1, 0, True)]


def test_more_recall_takes_more_runs():
    assert near_join.runs_for(0.9) < near_join.runs_for(0.9999) <= 8


PAGES = [(1, "http://a/b", "x" * 200), (4, "http://a\r\nWARC-Type: response/", "x" * 200), (3, None, None), (2, "u", "x" * 99),
         (9, "u", "x" * 99), (8, "v", "WARC/1.0\r\nContent-Length: 3\r\n\r\n" * 20 + "é\n\n"), (None, "w", "x" * 200),
         (1, "http://a/b", "x" * 200), (11, "big", "ß\r\n\r\n" * 100_000)]


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_PAGES", 2)
    path = f"file://{tmp_path}/warc"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(2)
    warc.write_archives(pages, path)
    captures = warc.read_captures(spark, path)
    rows = captures.collect()
    assert len(rows) == len(PAGES) and all(r.request.record_id and r.metadata.record_id for r in rows)
    payloads = sorted(bytes(r.response.block).split(b"\r\n\r\n", 1)[1] for r in rows if r.response.kind == "response")
    assert payloads == sorted((h or "").encode() for i, (_, _, h) in enumerate(PAGES) if i not in (1, 6, 7))
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.capture_pages(captures).collect())
    assert found == Counter([
        (1, 200, "response", None), (1, 200, "revisit", 1), (4, 200, "revisit", 1), (None, 200, "revisit", 1),
        (3, 0, "response", None), (2, 99, "response", None), (9, 99, "response", None),
        (8, len(PAGES[5][2].encode()), "response", None), (11, len(PAGES[8][2].encode()), "response", None)])
    files = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").rglob("part-*")]
    assert all(f.startswith(b"WARC/1.0\r\n") and f.count(b"WARC-Type: metadata\r\n") <= 2 for f in files)


def test_large_pages_have_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_PAGE", 150)
    monkeypatch.setattr(warc, "FILE_BYTES", 500_000)
    path = f"file://{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1), path)
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "warc/large").glob("part-*")]
    assert max(sizes) > 500_000 and len(sizes) == sum(len(p[2] or "") > 150 for p in PAGES)
    found = warc.capture_pages(warc.read_captures(spark, path)).collect()
    assert sorted((r.record_type, r.payload_bytes) for r in found) == sorted(
        ("revisit" if i in (1, 6, 7) else "response", len((p[2] or "").encode())) for i, p in enumerate(PAGES))


@pytest.mark.parametrize("lost", ["request", "metadata", "response"])
def test_a_lost_record_shows(spark, tmp_path, lost):
    path = f"file://{tmp_path}/warc"
    pages = [(i, f"http://a/{i}", f"page {i} " * 20) for i in range(1, 6)]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    records = warc.read_records(spark, path)
    gone = (F.col("kind") == lost) & (F.col("target_uri") == "http://a/3")
    captures = warc.assemble(records.where(~gone))
    rows = {r.target_uri: r for r in captures.collect()}
    assert len(rows) == 5 and [u for u, r in rows.items() if r[lost] is None] == ["http://a/3"]
    found = sorted((r.page_id or 0, r.payload_bytes or 0, r.record_type) for r in warc.capture_pages(captures).collect())
    plain = {i: (i, 140, "response") for i in range(1, 6)}
    plain[3] = {"request": plain[3], "metadata": (0, 140, "response"), "response": (3, 0, None)}[lost]
    assert found == sorted(plain.values())


def test_no_pages_no_captures(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.capture_pages(warc.read_captures(spark, path)).isEmpty()


def mixed_documents(spark):
    rng = random.Random(2)
    rows = [(i, "word " * rng.choice([1, 30, 300, 3000]), rng.choice(["en", "en", "de", None]), rng.choice("aaab") if i % 50 else None)
            for i in range(4000)]
    rows += [(5000, None, "en", "a"), (5001, "", "fr", "rare"), (None, "x", "en", "a"), (1, "again", "en", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("weight", F.lit(3))


def test_raked_margins_meet_their_targets(spark):
    docs = mixed_documents(spark)
    targets = {
        "source": spark.createDataFrame([("a", 0.3), ("b", 0.5), (None, 0.1), ("rare", 0.1), ("absent", 9.0)], "source string, target double"),
        "lang": spark.createDataFrame([("en", 0.2), ("de", 0.4), (None, 0.3), ("fr", 0.1)], "lang string, target double"),
        "topic": spark.createDataFrame([("note", 0.25), ("page", 0.25), ("article", 0.25), ("book", 0.25)], "topic string, target double"),
    }
    two = {k: targets[k] for k in ("source", "lang")} | {"topic": targets["topic"].where("topic <> 'article'")}
    raked = mixing.rake(mixing.mix_documents(docs, targets=two).groupBy("source", "lang", "topic").agg(
        F.sum("tokens").alias("tokens")).where("source <> 'rare' or source is null"), two, rounds=60).toPandas()
    assert abs(raked.weight.sum() - 1) < 1e-6
    by = raked.groupby("source", dropna=False).weight.sum()
    assert abs(by["a"] - 0.3 / 0.9) < 1e-3 and abs(by["b"] - 0.5 / 0.9) < 1e-3
    kinds = raked.groupby("topic").weight.sum()
    assert np.allclose(kinds, 1 / len(kinds), atol=1e-6)


def test_contradicting_targets_are_told(spark):
    cells = spark.createDataFrame([("a", "en", "note", 100), ("b", "de", "note", 100)], "source string, lang string, topic string, tokens long")
    targets = {
        "source": spark.createDataFrame([("a", 0.7), ("b", 0.3)], "source string, target double"),
        "lang": spark.createDataFrame([("en", 0.3), ("de", 0.7)], "lang string, target double"),
        "topic": spark.createDataFrame([("note", 1.0)], "topic string, target double"),
    }
    with pytest.warns(UserWarning, match="off its target"):
        mixing.rake(cells, targets, rounds=2)
    with pytest.warns(UserWarning, match="contradict"):
        mixing.rake_within(cells, targets, rounds=2)


@pytest.mark.filterwarnings("ignore:targets contradict")
def test_few_cells_are_raked_without_exchanges(spark, plan_of, monkeypatch):
    plans = []

    def seen(frame, label):
        plans.append(plan_of(frame))
        return materialise(frame, label)

    monkeypatch.setattr(mixing, "materialise", seen)
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 16)
    rng = random.Random(4)
    rows = [(a, b, c, rng.randint(1, 9) ** 5) for a in ["a", "b", "c", None] for b in ["en", "de", None] for c in ["note", "page"]
            if rng.random() < 0.8]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {d: mixing.tempered_targets(cells, d, 0.5) for d in mixing.DIMENSIONS}

    def found():
        plans.clear()
        return {tuple(r[:3]): r.probability for r in mixing.rake_within(cells, targets).collect()}

    few = found()
    assert len(few) == len(rows) and any("Window" in p for p in plans)
    assert not any("Window" in p and "Exchange" in p for p in plans)
    written = len(plans)
    # Many cells stay spread, and are raked to the same mark.
    monkeypatch.setattr(mixing, "FEW_BYTES", 0)
    assert few == pytest.approx(found(), rel=1e-9)
    assert any("Window" in p and "Exchange" in p for p in plans) and written < len(plans)


def test_mixing_keeps_rows_and_draws_by_probability(spark):
    docs = mixed_documents(spark)
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == docs.count() and all(0 < r.probability <= 1 + 1e-12 for r in rows)
    assert max(r.probability for r in rows) == pytest.approx(1)
    expected = sum(r.probability for r in rows)
    assert abs(sum(r.kept for r in rows) - expected) < 5 * expected**0.5
    assert mixing.mix_documents(docs.limit(0)).isEmpty()


def test_an_odd_row_changes_only_its_own_cell(spark):
    rng = random.Random(3)
    rows = [(i, "word " * rng.choice([10, 100, 500]), rng.choice(["en", "en", "en", "de"]), rng.choice("aaab")) for i in range(4000)]
    schema = "doc_id long, text string, lang string, source string"
    plain = spark.createDataFrame(rows, schema)
    kept = {r.doc_id for r in corpus_pipeline.mix(spark, plain, "").collect()}
    odd = spark.createDataFrame([*rows, (5000, "one", None, None)], schema)
    assert len(kept ^ ({r.doc_id for r in corpus_pipeline.mix(spark, odd, "").collect()} - {5000})) < 0.01 * len(kept)
    mixed = mixing.mix_documents(spark.createDataFrame([*rows, (5000, "one", "en", "new")], schema), unmet=mixing.UNMET).collect()
    assert len(kept ^ ({r.doc_id for r in mixed if r.kept} - {5000})) < 0.01 * len(kept)
    assert all(0 < r.probability <= 1 for r in mixed)
    expected = {d: Counter() for d in mixing.DIMENSIONS}
    present = {d: Counter() for d in mixing.DIMENSIONS}
    for r in mixed:
        for d in mixing.DIMENSIONS:
            expected[d][r[d]] += r.tokens * r.probability
            present[d][r[d]] += r.tokens
    for d in mixing.DIMENSIONS:
        goal = {v: (n / sum(present[d].values())) ** mixing.TEMPER for v, n in present[d].items()}
        scale = sum(expected[d].values()) / sum(goal.values())
        for v, n in expected[d].items():
            assert n == pytest.approx(min(goal[v] * scale, present[d][v]), rel=0.01)


def test_toxicity_on_rows_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text", F.lit("x").alias("score")), model)
    rows = scored.join(labels.where(toxicity.held_out("doc_id")), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) > 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.02 * len(clean)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 500_000), (4, "!?"), (5, "you idiotic stuupid scumm " * 5)], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score_toxicity(odd, model).collect()}
    assert found[1].score == found[2].score == found[4].score and found[1].predicted == 0
    assert found[5].predicted == 1 and 0 <= found[3].score <= 1
    untaught = toxicity.score_toxicity(odd, toxicity.fit(docs, labels.limit(0))).collect()
    assert {r.score for r in untaught} == {0.0}


def test_toxicity_training_follows_the_slope_of_the_loss(monkeypatch):
    """One small step of the descent against differences of the loss, worked out plainly."""
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "DECAY", 0.0)
    texts, labels = ["good day to you all", "awful rotten scum", "a fine day", "rotten awful day"], [0, 1, 0, 1]
    sample = toxicity.sample_from_texts(texts, labels)
    rng = np.random.default_rng(toxicity.SEED)
    vectors = rng.normal(0, 0.1, (toxicity.BUCKETS, toxicity.DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.5, (toxicity.DIMENSIONS, 2)).astype(np.float32)

    def loss(v, w):
        total = 0.0
        for text, label in zip(texts, labels):
            mean = sum(v[toxicity.features(x)].astype(float).mean(axis=0) for x in dict.fromkeys(text.split())) / toxicity.PASSAGE
            logits = mean @ w.astype(float)
            total -= logits[label] - np.log(np.exp(logits).sum())
        return total / len(texts)

    trained = toxicity.train(sample)
    for i, k in np.ndindex(*weights.shape):
        moved = weights.astype(float)
        moved[i, k] += 1e-4
        slope = loss(vectors, moved) - loss(vectors, weights)
        assert np.sign(trained.weights[i, k] - weights[i, k]) == -np.sign(slope)
    for bucket in toxicity.features("rotten")[:5]:
        moved = vectors.astype(float)
        moved[bucket, 0] += 1e-3
        slope = loss(moved, weights) - loss(vectors, weights)
        assert np.sign(trained.vectors[bucket, 0] - vectors[bucket, 0]) == -np.sign(slope)


def test_evidence_is_that_of_the_worst_section():
    rng = np.random.default_rng(1)
    for n in (1, 5, toxicity.SECTION, toxicity.SECTION + 1, 500):
        logits = rng.normal(size=n)
        step, size = toxicity.SECTION // 2, min(n, toxicity.SECTION)
        starts = {*range(0, n - size + 1, step), n - size}
        top = max(1, round(size * toxicity.TOP))
        assert toxicity.evidence(logits) == pytest.approx(max(sorted(logits[s:s + size])[-top:] and
                                                              float(np.mean(sorted(logits[s:s + size])[-top:])) for s in starts))
    calm, section = np.full(3000, -3.0), np.full(toxicity.SECTION, 4.0)
    assert toxicity.evidence(np.concatenate([calm, section, calm])) == pytest.approx(4.0)


def test_pipeline_stages_keep_the_columns_of_documents(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, data_dir)
        assert after.schema.names == docs.schema.names
        docs = spark.createDataFrame(after.collect(), docs.schema)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_runs(spark, data_dir):
    assert corpus_pipeline.run(spark, data_dir).where("ids_crc32 IS NULL OR length < 1").isEmpty()


def pipeline_documents(spark, data_dir):
    """Documents with odd rows, and columns named as those that stages work with."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    odd = spark.createDataFrame([
        (900_001, None, "en", "web"), (900_002, "", None, "web"), (900_003, "one", None, None), (900_003, "one", None, None),
        (900_004, "lange " * 20_000, "de", "web"), (None, "no id here", "en", "book")], "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    return docs.withColumns({c: F.concat(F.lit("own "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
                             for c in ("score", "Tokens", "kept", "predicted", "topic", "class_id")})


def test_pipeline_stages_match_plain_python(spark, data_dir):
    docs = pipeline_documents(spark, data_dir)
    stages = dict(corpus_pipeline.STAGES)

    def after(name, frame):
        found = stages[name](spark, frame, data_dir)
        assert found.columns == frame.columns
        rows = found.collect()
        assert all(r["score"] == r["Tokens"] == r["kept"] == f"own {'-' if r.doc_id is None else r.doc_id}" for r in rows)
        return rows, spark.createDataFrame(rows, frame.schema)

    def ids(rows):
        return Counter((r.doc_id, r.text) for r in rows)

    # Toxicity: every row whose text the model's scorer puts below one half, and no other.
    model = toxicity.fit(docs, spark.read.parquet(f"{data_dir}/labels.parquet"))
    of = model.scorer()
    rows, calm = after("toxicity", docs)
    assert ids(rows) == ids(r for r in docs.collect() if of(r.text) < 0.5) and len(rows) < docs.count()

    # Exact copies: the largest id of each text.
    rows, unlike = after("exact_dedup", calm)
    largest = {}
    for r in calm.collect():
        largest[r.text or ""] = max(largest.get(r.text or "", -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in rows) == Counter(
        {(i, t): 1 for t, i in largest.items()})

    # Near copies: the smallest id of each class of texts that share 4 of 5 runs of five words, directly or through others.
    sets = []
    for r in rows:
        w = (r.text or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and 9 * len(a & sets[j]) >= 4 * (len(a) + len(sets[j])):
                group = [group[j] if g == group[i] else g for g in group]
    smallest = {}
    for g, r in zip(group, rows):
        smallest[g] = min(smallest.get(g, r), r, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    rows, single = after("near_dedup", unlike)
    assert ids(rows) == ids(smallest.values()) and len(rows) < unlike.count()

    # Mixing: each cell keeps the rows whose draw lies below one bound, its probability.
    rows, _ = after("mixing", single)
    kept = ids(rows)
    bounds = defaultdict(lambda: ([0.0], [1.0]))
    for r in single.collect():
        n = len(re.findall(mixing.WORD, r.text or ""))
        kind = next((name for name, below in mixing.KINDS if n < below), mixing.LONGEST_KIND)
        draw = int(hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        bounds[r.source, r.lang, kind][0 if kept[r.doc_id, r.text] else 1].append(draw)
    assert all(max(below) <= min(above) for below, above in bounds.values())
    assert 0 < len(rows) < single.count()

    # Packing: the pieces of each document are its ids and the end mark, each once.
    packed = defaultdict(list)
    pieces = stages["packing"](spark, single, data_dir).collect()
    for p in pieces:
        packed[p.doc_id].append((p.start, bytes(p.ids)))
    encoder = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in single.collect():
        whole = np.array([*encoder.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(ids for _, ids in sorted(packed[r.doc_id])) == whole
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:]))
    assert max(o + n for _, o, n in places) <= 2048


def test_pipeline_of_nothing(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, data_dir)
        assert after.isEmpty() and (name == "packing" or after.columns == docs.columns)
