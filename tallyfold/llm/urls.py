"""URL filters: rules by host and path, and a logistic regression for the urls that no rule fits.

A url's host is what stands after the first `://` up to `/`, `?`, `#` or the end, with A-Z
lower-cased; its path is what follows up to `?`, `#` or the end. A rule names a host and the
beginning of a path; it fits its host and all subdomains. Of the rules that fit, the one of most
characters decides, at a tie that of the longer host, then a blocking one.

For other urls a logistic regression decides on hashed character n-grams (3 to 5, with edges) of
host and path. Each part's n-grams have their own seed, and the value of a bucket is its share of
the url's n-grams, so long urls weigh no more than short ones. It is trained by full-batch
descent on a small labelled table: of each label at most `MOST_EACH` distinct urls, those with
the smallest hash, so a run repeats. A host or url that fills the table counts once for each of
its urls, not for each row.

Hosts and paths are columns of the plan. Rules are a short list that the plan holds as
expressions; training sees the bounded table only; the n-grams of a batch are hashed and summed
by numpy, which holds a batch's bytes at a time. Nothing is shuffled to judge the urls.

Defined cases: a null url, or one without `://`, has an empty host and path and is judged by the
bias; without labels of both kinds every url without a rule is allowed, with score 0; labels
that are null or not 0 or 1 are left out; repeated rows are judged each; an empty table gives no
rows; the input's columns are kept, those named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

RESULTS = ("host", "path", "rule", "score", "verdict")
MOST_EACH = 2_000
GRAMS = (3, 4, 5)
BUCKETS = 2**18
PARTS = 64
STEPS, RATE, DECAY = 200, 0.5, 1e-6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Odd multipliers that spread bytes and sums over 64 bits.
SPREAD, FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host, path = F.col("host"), F.col("path")
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def strongest(rules: Sequence[Rule]) -> list[Rule]:
    """Rules in the order in which the first that fits decides."""
    return sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block"))


def _first_fit(rules: Sequence[Rule], value) -> Column:
    found = F.lit(None).cast("string")
    for rule in reversed(strongest(rules)):
        found = F.when(rule.fits(), F.lit(value(rule))).otherwise(found)
    return found


def with_rules(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """The rows with `host`, `path`, and `rule` and `verdict` where a rule fits, else null."""
    plain = urls.drop(*RESULTS)
    parted = plain.withColumns({"host": host_of(url), "path": path_of(url)})
    return parted.withColumns({"rule": _first_fit(rules, lambda r: r.name),
                               "verdict": _first_fit(rules, lambda r: r.verdict)})


def hashed_grams(texts: Sequence[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the number of the text that each is from.

    A text is framed by an opening and a closing byte, so an empty one still has none or few
    n-grams and edges differ from the middle. An n-gram lies within one text.
    """
    framed = [b"\x02" + t.encode("utf-8", "surrogatepass") + b"\x03" for t in texts]
    sizes = np.array([len(f) for f in framed], np.int64)
    data = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint64)
    text = np.repeat(np.arange(len(framed)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    buckets, owners = [], []
    for n in GRAMS:
        inside = np.flatnonzero(left >= n)
        mixed = np.full(len(inside), seed * 31 + n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ data[inside + i]) * SPREAD
            mixed ^= mixed >> np.uint64(29)
        buckets.append(((mixed * FINISH) >> np.uint64(40)) % np.uint64(BUCKETS))
        owners.append(text[inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def grams_of(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, url and share of each n-gram of host and path."""
    parts = [hashed_grams(hosts, 1), hashed_grams(paths, 2)]
    bucket, url = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    share = 1.0 / np.maximum(np.bincount(url, minlength=len(hosts)), 1)
    return bucket, url, share[url]


def curve(logits: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(logits, -60, 60)))


@dataclass
class UrlModel:
    """A weight for each bucket, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        if not len(hosts):
            return np.zeros(0)
        bucket, url, share = grams_of(hosts, paths)
        return curve(np.bincount(url, self.weights[bucket] * share, len(hosts)) + self.bias)


def train(hosts: Sequence[str], paths: Sequence[str], labels: Sequence[int]) -> UrlModel:
    """Descent on the mean cross-entropy, both labels weighing alike, with steps by Adagrad."""
    bucket, url, share = grams_of(hosts, paths)
    y = np.array(labels, np.float64)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    model = UrlModel(np.zeros(BUCKETS), 0.0)
    seen, seen_bias = np.full(BUCKETS, 1e-12), 1e-12
    for _ in range(STEPS):
        error = (curve(np.bincount(url, model.weights[bucket] * share, len(y)) + model.bias) - y) * weight
        slope = np.bincount(bucket, error[url] * share, BUCKETS) + DECAY * model.weights
        seen += slope**2
        seen_bias += error.sum() ** 2
        model.weights -= RATE * slope / np.sqrt(seen)
        model.bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return model


def fit(labelled: DataFrame, url: str = "url", label: str = "label", most_each: int = MOST_EACH) -> UrlModel | None:
    """A model from a table of urls with label 1 (to block) or 0.

    The table is brought to at most `most_each` distinct urls of each label by the smallest hash. A
    url with both labels counts for both.
    """
    known = labelled.where(F.col(label).isin(0, 1)).select(F.col(url).alias("url"), F.col(label).cast("int").alias("label"))
    drawn = known.distinct().withColumn("hash", F.xxhash64("url"))
    # First within parts of the table, so that whatever its size the last step sees few rows.
    for keys in (["label", F.pmod("hash", F.lit(PARTS))], ["label"]):
        first = Window.partitionBy(*keys).orderBy("hash", "url")
        drawn = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most_each)
    # At most 2 * most_each rows reach the driver.
    rows = drawn.select(host_of("url").alias("host"), path_of("url").alias("path"), "label").collect()
    rows = sorted((r["host"], r["path"], r["label"]) for r in rows)
    marks = [r[2] for r in rows]
    if not 0 < sum(marks) < len(marks):
        return None
    return train([r[0] for r in rows], [r[1] for r in rows], marks)


def judge_urls(urls: DataFrame, rules: Sequence[Rule], model: UrlModel | None, url: str = "url") -> DataFrame:
    """The rows with host, path, rule, score (0 to 1, higher: to block likelier) and verdict.

    The verdict is the rule's, else `block` for a score of 0.5 or more and `allow` below.
    """
    ruled = with_rules(urls, rules, url)
    plain = ruled.drop("verdict").columns
    host, path, verdict = (ruled.columns.index(c) for c in ("host", "path", "verdict"))
    schema = StructType([*ruled.drop("verdict").schema.fields,
                         StructField("score", DoubleType()), StructField("verdict", StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(host).to_pylist(), batch.column(path).to_pylist()
            scores = model.scores(hosts, paths) if model else np.zeros(len(hosts))
            given = batch.column(verdict).to_pylist()
            verdicts = [g or ("block" if s >= 0.5 else "allow") for g, s in zip(given, scores)]
            kept = [batch.column(i) for i in range(batch.num_columns) if i != verdict]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores, pa.float64()), pa.array(verdicts, pa.string())],
                names=[*plain, "score", "verdict"])

    return ruled.mapInArrow(judge, schema)


def labels_by_rules(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Urls that a rule decides as a labelled table (url, label): 1 where the rule blocks."""
    ruled = with_rules(urls, rules, url).where("verdict IS NOT NULL")
    return ruled.select(F.col(url).alias("url"), (F.col("verdict") == "block").cast("int").alias("label"))
