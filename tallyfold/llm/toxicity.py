"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (3 to 5, with word edges) and
of itself, all hashed into one table. A passage of `PASSAGE` words is the mean of its
words' vectors, each distinct word once, and a linear softmax over two classes scores it. Vectors and softmax are
trained together on passages that carry their document's label, so an unseen misspelling is
scored by the n-grams it shares. A few words among hundreds would vanish in the mean
of a whole text, hence a text's evidence is the mean logit of the highest `TOP` of its
passages, all of which are scored; a text of more than `SECTION` passages has the evidence of its
worst section of that length, so a toxic part is not averaged away however long the text around it.
A logistic curve fitted to the training documents turns evidence into the score.

Only text is an input. The model is fitted on a bounded sample of labelled
rows: of those that `held_out` does not name and of at most `LONGEST` characters, the `MOST_TOXIC` toxic and
`MOST_CLEAN` clean ones with the smallest hash of the id. A task trains on them, so the driver holds
only the model. Scoring reads every row and whole text; the trained model is a table of fixed size.

Defined cases: a null or empty text, or one without words, gets the score of the bias; labels
that are null or have no document are left out; without labels of both kinds every
score is 0; repeated rows are scored each; an empty table gives no rows; the input's columns
are kept, those named as results are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tallyfold.llm.worker import drop_held, give_back
from tallyfold.session import materialise

MOST_TOXIC, MOST_CLEAN, LONGEST = 3_000, 6_000, 40_000
PASSAGE, TOP, SECTION = 16, 1 / 8, 32
BUCKETS, DIMENSIONS = 2**19, 4
EPOCHS, RATE, DECAY, SEED = 100, 0.1, 1e-7, 7
FOLDS = 5
KEPT_WORDS = 300_000
# Parts of the labelled rows that are ranked side by side before the last ranking.
PARTS = 64
# Words longer than this are not kept in the worker's table.
LONG_WORD = 64
# Words, or places of words, that a step of training takes at a time.
BLOCK = 2**16
_WORDS = re.compile(r"[^\W_]+")


def held_out(id: str | Column) -> Column:
    """Rows that take no part in training: a fifth, by checksum of the id."""
    column = F.col(id) if isinstance(id, str) else id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def passages_of(text: str | None) -> list[dict[str, None]]:
    """The distinct words of each passage. Places of repeated or missing words hold a zero vector."""
    words = words_of(text)
    return [dict.fromkeys(words[i:i + PASSAGE]) for i in range(0, len(words), PASSAGE)]


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    edged = f"<{word}>"
    grams = [edged[i:i + n] for n in (3, 4, 5) for i in range(len(edged) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in (*grams, f"={word}")]


def evidence(logits: np.ndarray) -> float:
    """Mean of the highest share of the passage logits, one at least, of the text or of its worst section.

    Sections of a long text begin at every half section, and one ends with the text.
    """
    n = len(logits)
    if n <= SECTION:
        sections = logits[None, :]
    else:
        every = np.lib.stride_tricks.sliding_window_view(logits, SECTION)
        sections = every[np.unique([*range(0, n - SECTION + 1, SECTION // 2), n - SECTION])]
    top = max(1, round(sections.shape[1] * TOP))
    return float(np.sort(sections, axis=1)[:, -top:].mean(axis=1).max())


@dataclass
class Model:
    """`vectors` by bucket, softmax `weights` (dimension by class) and `bias` (by class), score curve."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def scorer(self):
        """A function from text to score; it keeps the scores of words it has met.

        With two classes the softmax depends on the difference of its columns only, so
        the mean of word vectors goes through it word by word.
        """
        table = (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64)
        offset = float(self.bias[1] - self.bias[0])
        known: dict[str, float] = {}

        def word_score(word: str) -> float:
            score = known.get(word)
            if score is None:
                score = float(table[features(word)].mean())
                if len(known) < KEPT_WORDS and len(word) <= LONG_WORD:
                    known[word] = score
            return score

        def score(text: str | None) -> float:
            means = [sum(map(word_score, p)) / PASSAGE for p in passages_of(text)] or [0.0]
            return curve(self.slope * evidence(np.array(means) + offset) + self.shift)

        return score


def curve(logit: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, logit))))


def _adam(parts: dict[str, np.ndarray], steps: int, rate: float, slopes_of) -> None:
    """Descend along `slopes_of(parts)`, in place."""
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    for step in range(1, steps + 1):
        for k, slope in slopes_of(parts).items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            parts[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-10)


@dataclass
class Sample:
    """Training texts as numbers, in text order.

    `words` holds the words of all passages as places in the list of distinct words, `sizes` the number of
    words of each passage, `passages` the number of passages of each text. `grams` holds the
    buckets of the distinct words one after the other and `ends` where each word's begin and end.
    """

    words: np.ndarray
    sizes: np.ndarray
    passages: np.ndarray
    labels: np.ndarray
    grams: np.ndarray
    ends: np.ndarray


def sample_from_texts(texts: Iterable[str], labels: Iterable[int]) -> Sample:
    places: dict[str, int] = {}
    words, sizes, passages = array("i"), array("i"), array("i")
    for text in texts:
        found = passages_of(text)
        passages.append(len(found))
        for passage in found:
            sizes.append(len(passage))
            words.extend(places.setdefault(w, len(places)) for w in passage)
    grams, ends = array("i"), array("q", [0])
    for word in places:
        grams.extend(features(word))
        ends.append(len(grams))
    held = [np.array(a, kind) for a, kind in ((words, np.int32), (sizes, np.int32), (passages, np.int64))]
    return Sample(*held, np.array(list(labels), np.float64), np.array(grams, np.int32), np.array(ends, np.int64))


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    return ((a, min(n, a + BLOCK)) for a in range(0, n, BLOCK))


def train(sample: Sample) -> Model:
    """Full-batch descent on the cross-entropy of the softmax over passages, then of the curve over texts.

    Sums over words and n-grams are made block by block, in their order, so beside the sample only a block is held.
    """
    word, gram, ends, sizes = sample.words, sample.grams, sample.ends, np.diff(sample.ends)
    passage = np.repeat(np.arange(len(sample.sizes), dtype=np.int32), sample.sizes)
    text_of = np.repeat(np.arange(len(sample.passages)), sample.passages)
    y, by_text = sample.labels[text_of], sample.labels

    def logits(parts):
        across = parts["weights"][:, 1] - parts["weights"][:, 0]
        by_bucket, by_word, by_passage = parts["vectors"] @ across, np.empty(len(sizes)), np.zeros(len(y))
        for a, b in _blocks(len(sizes)):
            by_word[a:b] = np.add.reduceat(by_bucket[gram[ends[a]:ends[b]]], ends[a:b] - ends[a]) / sizes[a:b]
        for a, b in _blocks(len(word)):
            np.add.at(by_passage, passage[a:b], by_word[word[a:b]])
        return by_passage / PASSAGE + (parts["bias"][1] - parts["bias"][0])

    def slopes(parts):
        across = parts["weights"][:, 1] - parts["weights"][:, 0]
        error = (1 / (1 + np.exp(-np.clip(logits(parts), -60, 60))) - y) / len(y)
        word_error, bucket_error = np.zeros(len(sizes)), np.zeros(BUCKETS)
        for a, b in _blocks(len(word)):
            np.add.at(word_error, word[a:b], error[passage[a:b]])
        word_error = word_error / PASSAGE / sizes
        for a, b in _blocks(len(sizes)):
            np.add.at(bucket_error, gram[ends[a]:ends[b]], np.repeat(word_error[a:b], sizes[a:b]))
        toward = parts["vectors"].T @ bucket_error
        return {"vectors": np.outer(bucket_error, across).astype(np.float32) + np.float32(DECAY) * parts["vectors"],
                "weights": np.stack([-toward, toward], 1).astype(np.float32),
                "bias": np.array([-error.sum(), error.sum()], np.float32)}

    rng = np.random.default_rng(SEED)
    parts = {"vectors": rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32),
             "weights": rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32),
             "bias": np.zeros(2, np.float32)}
    _adam(parts, EPOCHS, RATE, slopes)

    found = logits(parts)
    edges = np.searchsorted(text_of, np.arange(len(by_text) + 1))
    offset = parts["bias"][1] - parts["bias"][0]
    x = np.array([evidence(found[a:b]) if b > a else offset for a, b in zip(edges, edges[1:])])
    middle, spread = x.mean(), x.std() or 1.0

    def curve_slopes(line):
        error = 1 / (1 + np.exp(-np.clip(line["line"][0] * (x - middle) / spread + line["line"][1], -60, 60))) - by_text
        return {"line": np.array([(error * (x - middle) / spread).mean(), error.mean()])}

    line = {"line": np.array([1.0, 0.0])}
    _adam(line, 500, 0.05, curve_slopes)
    slope = float(line["line"][0] / spread)
    return Model(**parts, slope=slope, shift=float(line["line"][1] - slope * middle))


def training_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                  label: str = "toxic") -> DataFrame:
    """The labelled training rows (id, text, label), at most the bounds of each label, by smallest hash of the id."""
    kind = F.col(label).cast("int")
    usable = labels.where(kind.isin(0, 1) & ~held_out(id)).select(F.col(id).alias("__id"), kind.alias("__label"))
    usable = usable.withColumn("__hash", F.xxhash64("__id"))
    for keys in (["__label", F.pmod("__hash", F.lit(PARTS))], ["__label"]):
        first = Window.partitionBy(*keys).orderBy("__hash", "__id")
        usable = usable.withColumn("__place", F.row_number().over(first)).where(F.col("__place") <= MOST_CLEAN)
    bound = F.when(F.col("__label") == 1, F.lit(MOST_TOXIC)).otherwise(F.lit(MOST_CLEAN))
    # Bounded by the places, whatever the size of the tables.
    chosen = F.broadcast(usable.where(F.col("__place") <= bound).select("__id", "__label"))
    rows = docs.where(F.length(text) <= LONGEST).join(chosen, F.col(id) == F.col("__id"))
    return rows.select("__id", F.col(text).alias("__text"), "__label")


def fit(docs: DataFrame, labels: DataFrame, **names: str) -> Model | None:
    """A model from the training rows, None without rows of both labels.

    One task reads the sample, which is bounded, trains on it and returns the model, so the driver holds
    neither texts nor n-grams, and a task that is lost trains again to the same model. Rows that share an id are
    all of the sample, hence its rows are bounded once more.
    """
    rows = training_rows(docs, labels, **names).orderBy("__id", "__text", "__label").limit(MOST_TOXIC + MOST_CLEAN)
    held = materialise(rows, "toxicity-sample")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        found = [r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns])]
        found.sort(key=lambda r: (str(r[0]), r[1], r[2]))
        if 0 < sum(r[2] for r in found) < len(found):
            sample = sample_from_texts((r[1] for r in found), [r[2] for r in found])
            found.clear()
            give_back()
            model = train(sample)
            del sample
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in (model.vectors, model.weights, model.bias)]
                + [pa.array([x], pa.float64()) for x in (model.slope, model.shift)],
                names=["vectors", "weights", "bias", "slope", "shift"])
            del model
            give_back()

    learnt = held.coalesce(1).mapInArrow(learn, "vectors binary, weights binary, bias binary, slope double, shift double").first()
    if learnt is None:
        return None
    vectors, weights, bias = (np.frombuffer(x, "<f4") for x in learnt[:3])
    return Model(vectors.reshape(BUCKETS, DIMENSIONS), weights.reshape(DIMENSIONS, 2), bias, learnt[3], learnt[4])


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of `docs` with `score` (0 to 1) and `predicted` (1 from 0.5 on)."""
    kept = docs.drop("score", "predicted")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    at, names = kept.columns.index(text), [*kept.columns, "score", "predicted"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        of = model.scorer() if model else (lambda _: 0.0)
        for batch in batches:
            scores = np.array([of(t.as_py()) for t in batch.column(at)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=names)
        del of
        give_back()

    return kept.mapInArrow(score, schema)
