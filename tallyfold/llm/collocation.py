"""Phrase collocation mining: top-order marginalisation of word windows, and scores of the phrases.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and those into words at blanks
and tabs. Every word begins one window of `ORDER` words, which the lead columns w1 to w4 hold; a
window that its piece ends is padded with nulls. Only these longest windows are counted. Spark's
ROLLUP then sums them over ever shorter prefixes, which gives the occurrences of all phrases of
4, 3, 2 and 1 words, and of all words of a language, in one aggregation: no phrase length is
exploded or counted by itself.

Before that, windows are cut where no frequent phrase can go on. What begins at a word is counted
by hash, words and pairs first, then what these leave of longer phrases, in tables of cells of which
each holds many. A cell that stays below `LEAST` proves that none of its phrases reaches it, hence no phrase
that contains one; windows end there, and a window of a rare word is all padding, which only the language's total counts. Cells are
summed in tasks that hold one range of cells at a time, and come to the workers as one bit each, at most
`MOST_CELLS` bits for each number of words. With more text than that is made for, more cells reach the limit
and fewer windows are cut: the result is the same, as every phrase is counted from its windows.

A candidate is a phrase of 2 to 4 words with a >= `LEAST` occurrences. Cut after its first
k words it scores floor(2,000,000 a / (l + r)), l and r being the occurrences of the two parts,
which are frequent like the phrase and so in the same table. The lowest cut counts, then the smallest k.
A candidate inside a longer one with 100 f(longer) >= 80 a is dropped. Products are decimals, so
nothing overflows.

A worker holds the ids of a buffer of `BUFFER` words at most, and one text. What is counted in the
buffer is combined before the shuffle, so a hot line or word counts once per buffer. Windows cross it as
compressed blocks, one for each range of first pairs that a buffer has.

Defined cases: a null text is empty; a null language is `und`, as is that name itself; a text without
words has no windows; repeated rows count each; an empty table gives no rows; other columns of
the input are ignored. Ties in score go to the higher count, then to the lower phrase by bytes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import keyed_join
from tallyfold.session import materialise

ORDER = 4
LEAST, SHARE, TOP = 30, 80, 2000
UNKNOWN = "und"
# Words that a worker counts up before it hands them on.
BUFFER = 500_000
# Cells of each number of words: one for so many characters, and between these bounds, as powers of two.
CHARACTERS_PER_CELL, FEWEST_CELLS, MOST_CELLS = 24, 2**18, 2**26
# Cells of one row of the exchange.
RANGE = 2**14
# Parts in which the windows of a buffer are exchanged.
RANGES = 2**8
# Blocks that a worker reads at a time.
BLOCKS = 2**8
# A word, or the mark that a piece ends.
TOKEN = re.compile(r"[.,;:!?\n-\r]|[^ \t.,;:!?\n-\r]+")
ENDS = tuple(".,;:!?\n\x0b\x0c\r")
# The code points of A-Z, each with its lower case.
LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = tuple(f"w{i}" for i in range(1, ORDER + 1))
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _lowered(word: str) -> str:
    return word.lower() if word.isascii() else word.translate(LOWER)


def numbered(tokens: list[str]) -> tuple[list, np.ndarray]:
    """The distinct words, lower-cased, by their numbers from 1 on, and the number of each token; a mark has 0."""
    place = dict.fromkeys(tokens)
    numbers = dict.fromkeys(ENDS, 0)
    for token in place:
        place[token] = numbers.setdefault(_lowered(token), len(numbers) - len(ENDS) + 1)
    ids = np.fromiter(map(place.__getitem__, tokens), np.int32, len(tokens))
    return [None, *list(numbers)[len(ENDS):]], ids


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list, np.ndarray]]:
    """Language, words by number and numbers in text order, a piece's end being 0, of so many words at a time."""
    held: dict[str, list[str]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            tokens = held[lang.as_py()]
            size -= len(tokens)
            tokens += TOKEN.findall(text.as_py())
            tokens.append("\n")
            size += len(tokens)
            if size >= BUFFER:
                lang = max(held, key=lambda x: len(held[x]))
                size -= len(held[lang])
                yield lang, *numbered(held.pop(lang))
    for lang in list(held):
        yield lang, *numbered(held.pop(lang))


def prefix_hashes(lang: str, words: list, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 word, 2 words and so on to `ORDER`: the hash of the words that begin at each place, and whether no end breaks them."""
    seed = xxhash.xxh32_intdigest(lang)
    known = np.array([0, *[xxhash.xxh64_intdigest(w, seed) for w in words[1:]]], np.uint64)
    whole, mixed = ids > 0, known[ids]
    for step in range(ORDER):
        if step:
            later = np.zeros_like(ids)
            later[:-step] = ids[step:]
            whole = whole & (later > 0)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * SPREAD + known[later]
        yield mixed, whole


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32))) * SPREAD
    return ((mixed >> np.uint64(20)) % np.uint64(cells)).astype(np.uint32)


class Filter:
    """A bit for each cell, by the number of words a phrase has: whether the cell's phrases reach the limit together."""

    def __init__(self, cells: int, bits: dict[int, bytes]):
        self.cells = cells
        self.bits = {order: np.frombuffer(b, np.uint8) for order, b in bits.items()}

    def may_be_frequent(self, order: int, hashes: np.ndarray) -> np.ndarray:
        if order not in self.bits:
            return np.ones(len(hashes), bool)
        cell = cells_of(hashes, self.cells)
        return ((self.bits[order][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1).astype(bool)

    def prefixes(self, lang: str, words: list, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As `prefix_hashes`, each with whether all that the phrase contains may be frequent."""
        last = None
        for order, (hashes, whole) in enumerate(prefix_hashes(lang, words, ids), 1):
            good = whole
            if last is not None:
                # What begins one place later, of one word less, must go on as well.
                good = good & last & np.append(last[1:], False)
            places = np.flatnonzero(good)
            good = np.zeros(len(ids), bool)
            good[places[self.may_be_frequent(order, hashes[places])]] = True
            last = good
            yield hashes, good


def plain_texts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))


def cells_for(texts: DataFrame) -> int:
    """How many cells suit the texts: a power of two within bounds."""
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    return int(np.clip(2 ** int(size // CHARACTERS_PER_CELL).bit_length(), FEWEST_CELLS, MOST_CELLS))


def frequent_cells(texts: DataFrame, known: Filter, orders: Sequence[int], least: int = LEAST) -> dict[int, bytes]:
    """Bits for phrases of these numbers of words: whether those of a cell occur `least` times together.

    Phrases that the bits known before rule out are not counted. A task counts up to `least` in one byte per
    cell (four where it is over 255). Rows of the exchange hold the cells of a range that are not zero;
    after it, a task reads them range by range, so memory is one range whatever their number.
    """
    cells = known.cells
    width = min(RANGE, cells)
    kind = np.uint8 if least < 2**8 else np.uint32
    bits = texts.sparkSession.sparkContext.broadcast({o: b.tobytes() for o, b in known.bits.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = Filter(cells, bits.value)
        counts = {order: np.zeros(cells, kind) for order in orders}
        for buffer in _buffers(batches):
            for order, (hashes, good) in zip(range(1, max(orders) + 1), rule.prefixes(*buffer)):
                if order in counts:
                    cell, n = np.unique(cells_of(hashes[good], cells), return_counts=True)
                    counts[order][cell] = np.minimum(counts[order][cell] + np.minimum(n, least), least)
        for order, of_order in counts.items():
            for at in np.flatnonzero(of_order.reshape(-1, width).any(axis=1)):
                part = of_order[at * width:(at + 1) * width]
                place = np.flatnonzero(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([order], pa.int32()), pa.array([at], pa.int64()),
                     pa.array([place.astype("<u2").tobytes()], pa.binary()), pa.array([part[place].tobytes()], pa.binary())],
                    names=["words", "range", "places", "sizes"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()),
                 pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["words", "range", "bits"])

        for batch in batches:
            for order, r, p, s in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if (order, r) != at:
                    if at is not None:
                        yield done()
                    at, total = (order, r), np.zeros(width, np.int64)
                place = np.frombuffer(p, "<u2")
                total[place] = np.minimum(total[place] + np.frombuffer(s, kind), least)
        if at is not None:
            yield done()

    counted = texts.mapInArrow(count, "words int, range bigint, places binary, sizes binary")
    dealt = counted.repartition("words", "range").sortWithinPartitions("words", "range")
    # One bit per cell reaches the driver: 8 MB at most for each number of words.
    found = {order: np.zeros((cells // width, width // 8), np.uint8) for order in orders}
    for row in dealt.mapInArrow(add, "words int, range bigint, bits binary").collect():
        found[row["words"]][row["range"]] = np.frombuffer(row["bits"], np.uint8)
    return {order: b.tobytes() for order, b in found.items()}


def phrase_filter(texts: DataFrame, least: int = LEAST) -> Filter:
    """What can be frequent: first by words and pairs, then by the longer phrases that these leave."""
    cells, bits = cells_for(texts), {}
    for orders in ((1, 2), range(3, ORDER + 1)):
        bits |= frequent_cells(texts, Filter(cells, bits), orders, least)
    return Filter(cells, bits)


def windows(texts: DataFrame, known: Filter) -> DataFrame:
    """Rows (lang, phrase, n): the longest windows, up to where they are cut, with how often they occur; '' if nothing is left.

    The exchange has one row for the windows of a buffer in one of `RANGES` ranges, sorted and compressed. A
    window is in the same range in all buffers, so after it Spark sums up all of its rows in one task.
    """
    cells = known.cells
    bits = texts.sparkSession.sparkContext.broadcast({o: b.tobytes() for o, b in known.bits.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = Filter(cells, bits.value)
        codec = pa.Codec("zstd")
        for lang, words, ids in _buffers(batches):
            begins = ids > 0
            columns, dealt = [], np.zeros(len(ids), np.uint16)
            for step, (hashes, good) in enumerate(rule.prefixes(lang, words, ids)):
                later = np.zeros_like(ids)
                later[:len(ids) - step] = ids[step:]
                columns.append(np.where(good, later, 0)[begins])
                if step < 2:
                    dealt[good] = cells_of(hashes[good], RANGES)
            first, last = ((columns[i].astype(np.int64) << 32) | columns[i + 1] for i in (0, 2))
            order = np.lexsort((last, first))
            first, last = first[order], last[order]
            starts = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])))[:len(first)]
            n = np.diff(np.append(starts, len(first)))
            dealt = dealt[begins][order][starts]
            by_range = np.argsort(dealt, kind="stable")
            first, last, n, dealt = first[starts][by_range], last[starts][by_range], n[by_range], dealt[by_range]
            # A window of padding alone is an empty first word, since a join of nulls alone has no row.
            heads, dictionary = (pa.array([pad, *words[1:]], pa.string()) for pad in ("", None))
            low = np.int64(0xFFFFFFFF)
            later = [dictionary.take(pa.array(f)) for f in (first & low, last >> 32, last & low)]
            phrases = pc.binary_join_element_wise(heads.take(pa.array(first >> 32)), *later, " ", null_handling="skip")
            phrases = phrases.cast(pa.large_string())
            ends = np.frombuffer(phrases.buffers()[1], np.int64)[:len(phrases) + 1]
            letters = memoryview(phrases.buffers()[2] or b"")
            edges = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))[:len(dealt)]
            blocks = []
            for a, b in zip(edges, np.append(edges[1:], len(dealt))):
                numbers = np.concatenate([np.diff(ends[a:b + 1]), n[a:b]]).astype("<u4").tobytes()
                blocks.append((b - a, len(numbers) + ends[b] - ends[a], numbers + letters[ends[a]:ends[b]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt[edges], pa.int32()), pa.array([lang] * len(blocks), pa.string()),
                 *[pa.array([block[i] for block in blocks], pa.int64()) for i in (0, 1)],
                 pa.array([codec.compress(block[2], asbytes=True) for block in blocks], pa.binary())],
                names=["range", "lang", "rows", "size", "block"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCKS):
                part = batch.slice(at, BLOCKS)
                rows, sizes, blocks = (part.column(i).to_pylist() for i in (2, 3, 4))
                lengths, counts, letters = [], [], []
                for of, size, block in zip(rows, sizes, blocks):
                    whole = codec.decompress(block, size, asbytes=True)
                    numbers = np.frombuffer(whole, "<u4", 2 * of)
                    lengths.append(numbers[:of])
                    counts.append(numbers[of:])
                    letters.append(whole[8 * of:])
                ends = np.cumsum(np.concatenate([[0], *lengths]), dtype=np.int64)
                phrases = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(b"".join(letters)))
                langs = part.column(1).take(pa.array(np.repeat(np.arange(len(rows)), rows)))
                yield pa.RecordBatch.from_arrays(
                    [langs, phrases.cast(pa.string()), pa.array(np.concatenate(counts), pa.int64())],
                    names=["lang", "phrase", "n"])

    rows = texts.mapInArrow(count, "range int, lang string, rows bigint, size bigint, block binary")
    return rows.repartition("range").mapInArrow(read, "lang string, phrase string, n bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text") -> DataFrame:
    """Rows (lang, words, phrase, f) of all phrases of up to `ORDER` words with f >= `least`; words 0: all of the language."""
    texts = plain_texts(docs, lang, text)
    counted = windows(texts, phrase_filter(texts, least)).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    parts = F.split(F.when(F.col("phrase") != "", F.col("phrase")), " ", -1)
    padded = counted.select("lang", "n", parts.alias("parts")).select(
        "lang", *[F.get("parts", F.lit(i)).alias(w) for i, w in enumerate(WORDS)], "n")
    rolled = padded.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # The lowest bits of the grouping number are ones for the words that are rolled up.
    whole, words = F.lit(False), F.lit(0)
    for size in range(ORDER + 1):
        here = F.col("rolled") == 2 ** (ORDER - size) - 1
        whole = whole | (here & F.col(WORDS[size - 1]).isNotNull() if size else here)
        words = F.when(here, F.lit(size)).otherwise(words)
    # Prefixes that end in padding are dropped by their columns alone, which Spark does before it sums.
    found = rolled.where(whole).select("lang", words.alias("words"), F.concat_ws(" ", *WORDS).alias("phrase"), "f")
    return found.where((F.col("words") == 0) | (F.col("f") >= least))


def _quotient(above: Column, below: Column) -> Column:
    return F.call_function("div", above, below)


def score_of(a: str, l: str, r: str) -> Column:
    """floor(2,000,000 a / (l + r)) in decimals of 38 places."""
    wide = F.col(a).cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    return _quotient(wide, F.col(l).cast("decimal(20,0)") + F.col(r).cast("decimal(20,0)"))


def scored_cuts(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, words, phrase, a, l, r, score), each with its lowest cut."""
    counts = phrases.where("words > 0").select("lang", "phrase", "f")
    candidates = phrases.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    parts = F.split("phrase", " ", -1)
    places = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = candidates.withColumn("k", places).withColumns({
        "first": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ")})
    with_first = keyed_join(cuts, counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    with_both = keyed_join(with_first, counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = with_both.withColumn("score", score_of("a", "l", "r"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "words", "phrase", "a").agg(lowest).select(
        "lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def without_parts(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that lie in no longer candidate with at least `share` hundredths of their occurrences."""
    parts = F.split("phrase", " ", -1)
    inner = candidates.where("words > 2").select("lang", "words", "a", parts.alias("parts")).withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.groupBy("lang", F.array_join(F.slice("parts", F.col("start"), F.col("size")), " ").alias("phrase")).agg(
        F.max("a").alias("longer"))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("longer", "a")]
    covered = F.coalesce(wide[0] * F.lit(100) >= wide[1] * F.lit(share), F.lit(False))
    return keyed_join(candidates, inner, ["lang", "phrase"], "left").where(~covered).drop("longer")


def mine_collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, **names: str) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language."""
    phrases = materialise(phrase_counts(docs, least, **names), "phrases")
    candidates = materialise(scored_cuts(phrases), "candidates")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = without_parts(candidates, share).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    return keyed_join(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
