"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    chat,
    collocation,
    divergence,
    exact_dedup,
    mixing,
    near_join,
    packing,
    sharding,
    token_store,
    topk,
    toxicity,
    urls,
    warc,
)
from tallyfold.session import scratch_path

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    """Path of a public vocabulary, a parameter of the operators that encode."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_CONTROL = "</s>[INST] ok [/INST]"


@query("op1_chat_formatting", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}'),
folded AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<s>[INST]' || '[/INST]' || '</s>')
           + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))
           + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))) AS formatted
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars FROM folded""")
def _(spark, folder):
    control = spark.sql(
        "SELECT -1L AS conv_id, CAST(i AS BIGINT) AS turn, r AS role, t AS text FROM VALUES "
        f"(0, 'user', '{_CONTROL}'), (1, 'assistant', '{_CONTROL}') AS rows(i, r, t)")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(chat.streamed(turns.unionByName(control)))
    read = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.read_loss_text(F.col("segments"))
    return chats.select(
        "conv_id", "n_turns", F.sha2(F.array_join(read, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op6_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(text) AS text_sha256
FROM d""")
def _(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query("op8_sharding")
def _(spark, folder):
    placed = sharding.shard_documents(table(spark, folder, "documents"))
    return placed.drop("text").withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op2_packing")
def _(spark, folder):
    pieces = packing.pack_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op3_toxicity")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op4_exact_top_k", """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM pairs
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5""")
def _(spark, folder):
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op5_mixing", mixing.raking_sql() + """
SELECT doc_id, source, lang, topic, tokens, round(probability, 6) AS probability, kept FROM mixed""")
def _(spark, folder):
    return mixing.mix_documents(table(spark, folder, "documents")).select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept")


@query("op7_token_store")
def _(spark, folder):
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"), 49_408)
    return token_store.read_store(spark, path)


@query("op9_near_join")
def _(spark, folder):
    found = near_join.near_classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links", "class_size", "kept")


@query("op10_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id) AS place,
        min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first END AS refers_to FROM g""")
def _(spark, folder):
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.capture_pages(warc.read_captures(spark, path))


# Fixed values of the two queries below: A-Z and their lower case.
_LOWERED = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"


@query("op11_collocations", rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS ({" UNION ALL ".join(
    f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k} + 2), lambda s: array_to_string(w[s:s + {k} - 1], ' '))) AS phrase FROM words WHERE len(w) >= {k}"
    for k in (1, 2, 3, 4))}),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
parted AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
cuts AS (SELECT x.lang, x.k, x.phrase, x.a, x.p, x.c, l.f AS l, r.f AS r,
           CAST(2000000::HUGEINT * x.a // (l.f + r.f) AS BIGINT) AS score
  FROM parted x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.p[1:x.c], ' ')
    JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.p[x.c + 1:x.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(p[s:s + z - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - z + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS z FROM candidates WHERE k > 2))),
covered AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY lang, phrase),
best AS (SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS rank
  FROM lowest o LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN totals USING (lang) WHERE rank <= 2000""")
def _(spark, folder):
    return collocation.mine_collocations(table(spark, folder, "documents"))


@query("op12_divergence", rf"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT i, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         CAST(1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 2) // (coalesce(s.n, 0) + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (k.whole + 2) // (l.n + 2 * l.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM cells WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10""")
def _(spark, folder):
    return divergence.audit_sources(table(spark, folder, "documents"))


# Fixed values of the query: its rules.
URL_RULES = (
    urls.Rule("com", "/", "allow"), urls.Rule("example.com", "/en/", "block"), urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"), urls.Rule("net", "/fr/", "block"),
)


@query("op13_url_filter")
def _(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = urls.fit(urls.labels_by_rules(pages, URL_RULES))
    return urls.judge_urls(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")
