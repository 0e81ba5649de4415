"""Source divergence audit: how unlike the sources of a language are, term by term, by count-level bitmaps.

Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. A language keeps the V terms
that at least `LEAST_DOCS` of its documents hold. In a group (language and source) a kept term
with `count` occurrences weighs p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being the group's
occurrences of kept terms; p depends on the count alone. Two weights differ by
f(p, q) = floor((p - q)^2 / (p + q)), and two sources by the sum of f over all kept terms.

For each group and count there is a bitset of the ids of the terms with that count, in blocks
of 64 ids. The AND of two groups' bitsets of a block and its popcount tell how many terms have
these two counts: a joint cell, which is multiplied by f once. Terms that a group lacks
are zeros by complement: of the terms of group A with count c, those that no bitset of B shares
have count 0 there. So that empty bitsets are never met, the sum is arranged as

    V f(0, 0) + sum over A's levels of size * (f(c, 0) - f(0, 0)) + the same of B's levels
    + sum over joint cells of size * (f(c, d) - f(c, 0) - f(0, d) + f(0, 0)).

Terms are numbered by falling total, in ranges sorted side by side, so a block's terms have
like counts and few levels. A task holds one block of at most `TILE` by `TILE` sources; the
bitsets of more sources are repeated once per tile they meet. Words are counted within a
batch before anything is shuffled, so a hot source or word costs a row per batch.

All arithmetic is exact: whole numbers, decimals where 64 bits may not do. Values stay in 64 bits for
up to 9 * 10^9 kept terms.

Defined cases: a null text, language or source counts as ''; every group that occurs has rows in part
`pair`, also one without terms, where V = 0 makes all values 0; a language of one source has no pairs;
repeated rows count each; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import keyed_join
from tallyfold.session import materialise

LEAST_DOCS = 10
TOP_TERMS = 10
# Sources whose bitsets meet in one task.
TILE = 256
# Words that a worker counts up before it hands them on.
COUNTED = 500_000
# Bitsets of one side that are compared at a time with all of the other.
STRIP = 512
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
# The code points of A-Z, each with its lower case.
LOWER = {c: c + 32 for c in range(65, 91)}


def _lowered(term: str) -> str:
    return term.lower() if term.isascii() else term.translate(LOWER)


def _combined(terms: list[str], ends: list[int], groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Rows of `term_counts` for some documents: their terms one after the other, where each ends, its group."""
    numbers: dict[str, int] = {"": 0}
    place = dict.fromkeys(terms)
    for t in place:
        place[t] = numbers.setdefault(_lowered(t), len(numbers))
    term = np.fromiter(map(place.__getitem__, terms), np.int64, len(terms))
    places: dict[tuple[str, str], int] = {}
    group = np.array([places.setdefault(g, len(places)) for g in groups], np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
    # The empty term is in every document once.
    term, doc = np.append(term, np.zeros(len(ends), np.int64)), np.append(doc, np.arange(len(ends)))
    width = len(numbers)
    key, n = np.unique(group[doc] * width + term, return_counts=True)
    once = np.unique(doc * width + term)
    _, docs = np.unique(group[once // width] * width + once % width, return_counts=True)
    names = [pa.array([g[i] for g in places], pa.string()) for i in (0, 1)]
    known = pa.array(list(numbers), pa.string())
    for at in range(0, len(key), 20_000):
        some = key[at:at + 20_000]
        yield pa.RecordBatch.from_arrays(
            [*[x.take(pa.array(some // width)) for x in names], known.take(pa.array(some % width)),
             pa.array(n[at:at + 20_000], pa.int64()), pa.array(docs[at:at + 20_000], pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences, and documents with the term.

    The row of the empty term holds the group's number of documents, so groups without terms are there.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, ends, groups = [], [], []
        for batch in batches:
            for of_lang, of_source, words in zip(*batch.columns):
                terms += TERM.findall(words.as_py())
                ends.append(len(terms))
                groups.append((of_lang.as_py(), of_source.as_py()))
                if len(terms) + len(ends) >= COUNTED:
                    yield from _combined(terms, ends, groups)
                    terms, ends, groups = [], [], []
        yield from _combined(terms, ends, groups)

    counted = plain.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def weight(count: str | Column, total: str, terms: str) -> Column:
    """p of a count in a group with `total` occurrences of kept terms, in a language with `terms` of them."""
    def wide(c):
        return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")

    above = (wide(count) + F.lit(2)) * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.call_function("div", above, wide(total) + wide(terms) * F.lit(2)) + F.lit(1)


def unlikeness(p: str | Column, q: str | Column) -> Column:
    """f of two weights, whose squares fit 64 bits."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_counts(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Rows (lang, source, term, n, whole) of the kept terms, `whole` being the language's occurrences."""
    of_term = Window.partitionBy("lang", "term")
    summed = counts.where("term <> ''").withColumns({
        "whole": F.sum("n").over(of_term), "of_lang": F.sum("docs").over(of_term)})
    return summed.where(F.col("of_lang") >= least_docs).select("lang", "source", "term", "n", "whole")


def group_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, total, lang_total, terms, base, number): N, the language's N, V, the weight of count 0."""
    groups = counts.where("term = ''").select("lang", "source")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("whole").alias("whole")).groupBy("lang").agg(
        F.sum("whole").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    found = groups.join(totals, ["lang", "source"], "left").join(langs, ["lang"], "left")
    zero = F.lit(0).cast("long")
    found = found.withColumns({c: F.coalesce(F.col(c), zero) for c in ("total", "lang_total", "terms")})
    return found.withColumn("base", F.when(F.col("terms") > 0, weight(F.lit(0), "total", "terms")))


def bitsets(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, block, source, n, p, base, bits): which of a block's 64 terms a group holds n times."""
    terms = kept.groupBy("lang", "term").agg(F.first("whole").alias("whole"))
    ranged = terms.repartitionByRange("lang", F.col("whole").desc(), "term").sortWithinPartitions(
        "lang", F.col("whole").desc(), "term")
    numbered = materialise(ranged.select("lang", "term", F.monotonically_increasing_id().alias("id")), "terms")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    placed = keyed_join(kept.select("lang", "source", "term", "n"), numbered, ["lang", "term"])
    levels = placed.groupBy("lang", F.shiftright("id", 6).alias("block"), "source", "n").agg(F.bit_or(bit).alias("bits"))
    info = groups.select("lang", "source", "total", "terms", "base")
    return keyed_join(levels, info, ["lang", "source"]).select(
        "lang", "block", "source", "n", weight("n", "total", "terms").alias("p"), "base", "bits")


def _tiled(bits: DataFrame, tiles: int) -> DataFrame:
    """Each row once for every pair of tiles that its source's tile is part of."""
    own = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    return bits.withColumn("tile", own).withColumn("other", other).withColumns(
        {"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("other")


def joint_cells(bits: DataFrame, tiles: int = 1) -> DataFrame:
    """Rows (lang, a, b, value) of sources a < b: what joint cells add to the sum, for each block."""

    def add_up(table: pa.Table) -> pa.Table:
        sources, of = np.unique(np.array(table["source"].to_pylist(), object), return_inverse=True)
        p, base = table["p"].to_numpy(), table["base"].to_numpy()
        words, tile = table["bits"].to_numpy().astype(np.uint64), table["tile"].to_numpy()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        value = np.zeros((len(sources), len(sources)), np.int64)

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for start in range(0, len(left), STRIP):
            some = left[start:start + STRIP]
            sizes = np.bitwise_count(words[some, None] & words[right]).astype(np.int64)
            i, j = np.nonzero(sizes)
            x, y = some[i], right[j]
            once = of[x] < of[y] if low == high else np.ones(len(x), bool)
            x, y, n = x[once], y[once], sizes[i, j][once]
            change = f(p[x], p[y]) - f(p[x], base[y]) - f(base[x], p[y]) + f(base[x], base[y])
            np.add.at(value, (np.minimum(of[x], of[y]), np.maximum(of[x], of[y])), n * change)
        a, b = np.nonzero(value)
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(a), pa.string()),
                         "a": pa.array(sources[a], pa.string()), "b": pa.array(sources[b], pa.string()),
                         "value": pa.array(value[a, b], pa.int64())})

    cells = _tiled(bits, tiles).groupBy("lang", "block", "low", "high").applyInArrow(
        add_up, "lang string, a string, b string, value bigint")
    return cells.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def pair_values(bits: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) of all ordered pairs of a language's sources.

    As many rows as the result has, for each level of a source: nothing here is larger than the
    result and its cells.
    """
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    joint = joint_cells(bits, max(1, -(-most // TILE)))
    joint = joint.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), "value"),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), "value"))).alias("r")).select("lang", "r.*")
    others = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"), "terms")
    pairs = keyed_join(groups.select("lang", "source", "base"), others, ["lang"]).where("source <> item")
    levels = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("size"))
    levels = keyed_join(levels, groups, ["lang", "source"]).select(
        "lang", "source", "size", weight("n", "total", "terms").alias("p"), "base")
    both_zero = unlikeness("base", "item_base")
    lone = keyed_join(levels, others, ["lang"]).where("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.col("size") * (unlikeness("p", "item_base") - both_zero)).alias("value"))
    turned = lone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    zeros = pairs.select("lang", "source", "item", F.coalesce(F.col("terms") * both_zero, F.lit(0)).alias("value"))
    every = zeros.unionByName(lone).unionByName(turned).unionByName(joint)
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, item, value, rank): the terms of most value that a group has beyond its language."""
    info = groups.select("lang", "source", "total", "lang_total", "terms")
    rated = keyed_join(kept, info, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        weight("n", "total", "terms").alias("p"), weight("whole", "lang_total", "terms").alias("q"))
    rated = rated.where("p > q").withColumn("value", unlikeness("p", "q"))
    return _ranked(rated.select("lang", "source", "item", "value")).where(F.col("rank") <= top)


def _ranked(values: DataFrame) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(best))


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, **names: str) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of the parts `pair` and `term`."""
    counts = materialise(term_counts(docs, **names), "term-counts")
    kept = materialise(kept_counts(counts, least_docs), "kept-terms")
    groups = materialise(group_totals(counts, kept), "groups")
    pairs = _ranked(pair_values(bitsets(kept, groups), kept, groups))
    parts = pairs.withColumn("part", F.lit("pair")).unionByName(
        term_values(kept, groups, top).withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", "value", "rank")
