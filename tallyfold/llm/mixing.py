"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents are counted by cell: source, language and topic. The token weights of the
cells are raked: in each round, the cells of every source are scaled so that the source gets
its target, then those of every language, then of every topic, for a fixed number of rounds; a
margin that is then off its target is warned of. A document is then kept with the probability of its cell, raked weight over
tokens present, on the one scale at which no cell needs more than it has. The expected
tokens of the sample thus have the target margins.

That scale is set by the neediest cell, however small. With `unmet`, as in the pipeline, it
is not: the sample is the largest of which cells lack at most that share, cells that run
out are kept whole, and what they lack is raked over the other cells. A value with fewer
tokens than its target asks for is kept whole where the other margins allow, and its rest
goes to the other values. A row of its own cell thus leaves the other cells as they are.

Sampling draws a number from a hash of the id, so a run repeats and a larger target keeps
what a smaller one kept.

Texts are read twice, once to count words into cells and once to decide; only cells are
shuffled, after counts are combined on the map side. A hot source is a few cells. The many
steps on the cells need no shuffle while these are few: each exchange costs the driver a thread
for a minute, and a round has three of them.

Defined cases: a null source, language or topic is a value of its own; a text without words
weighs one token, so that every document has a cell with weight; targets of values that do not occur
are left out and the rest scaled to one; rows with the same id are kept or dropped
together, those without id by the hash of the empty text; an empty table gives no rows;
the input's columns are kept, those named as results are replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import is_small, keyed_join
from tallyfold.session import materialise

DIMENSIONS = ("source", "lang", "topic")
# Targets are the shares present, to this power: below 1, what is rare gains.
TEMPER = 0.9
ROUNDS = 10
WORD = r"[^ \t\r\n]+"
# Fixed values of the query's topics: kinds of text by words, and where each ends.
KINDS = (("note", 50), ("page", 400), ("article", 2000))
LONGEST_KIND = "book"
# Two rounds are written at a time, which keeps plans short; of few cells, so many times two, as they need no exchange.
ROUNDS_PER_WRITE = 2
MARKS = 3
# Cells whose files take up to so many bytes are read as one partition; more stay spread.
FEW_BYTES = 2 * 1024 * 1024
# Share of the sample that cells may lack because they run out of tokens.
UNMET = 0.01
# Raking within what cells have ends when all margins are this near their goals, as a share
# of the goal, or come no nearer.
TOLERANCE = 0.001
MOST_ROUNDS = 100
# The largest sample is looked for on so many totals at a time, so many times.
TOTALS, LOOKS = 32, 3


def word_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD))


def kind_of(words: Column) -> Column:
    """The topic of documents that name none: the kind of text by its length."""
    kind = F.lit(LONGEST_KIND)
    for name, below in reversed(KINDS):
        kind = F.when(words < below, name).otherwise(kind)
    return kind


def _attach(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a key of which null is a value like any other."""
    right = right.withColumnRenamed(key, "__key")
    return left.join(right, left[key].eqNullSafe(right["__key"])).drop("__key")


def _few(cells: DataFrame) -> bool:
    return is_small(cells, FEW_BYTES)


def _stored(cells: DataFrame) -> DataFrame:
    """The cells, written; few are read as one partition, on which windows, sums and joins need no exchange."""
    stored = materialise(cells, "mix-cells")
    return stored.coalesce(1) if _few(stored) else stored


def tempered_targets(cells: DataFrame, dimension: str, temper: float = TEMPER, total: int | None = None) -> DataFrame:
    """Target weights of a dimension's values: the shares present, tempered. `total` is the cells' tokens, if known."""
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    total = total or cells.agg(F.sum("tokens")).first()[0] or 1
    share = F.col("tokens") / F.lit(float(total))
    return present.select(dimension, F.pow(share, F.lit(temper)).alias("target"))


def _with_targets(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with the target share of each of their values; shares of values that occur sum to one."""
    for d in DIMENSIONS:
        wanted = targets[d].select(d, F.col("target").alias(f"target_{d}"))
        total = _attach(cells.select(d).distinct(), wanted, d).agg(F.sum(f"target_{d}")).first()[0] or 1.0
        # Written each time: the next values are looked up among the cells that are left, and would join all over again.
        cells = _stored(_attach(cells, wanted, d).withColumn(f"target_{d}", F.col(f"target_{d}") / F.lit(float(total))))
    return cells


def _raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    raked = _with_targets(cells, targets).withColumn("weight", F.col("tokens").cast("double"))
    per_write = ROUNDS_PER_WRITE * MARKS if _few(raked) else ROUNDS_PER_WRITE
    for round in range(rounds):
        for d in DIMENSIONS:
            present = F.sum("weight").over(Window.partitionBy(d))
            raked = raked.withColumn("weight", F.col("weight") * F.col(f"target_{d}") / present)
        if round % per_write == per_write - 1 or round == rounds - 1:
            raked = _stored(raked)
    return raked


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with `weight`, whose margins meet the targets: iterative proportional fitting.

    Cells are as many as combinations of values that occur, however many documents
    there are; they stay in Spark, and a step sorts them by one dimension. If a margin is
    off its target after these rounds, it is warned of.
    """
    raked = _raked(cells, targets, rounds)
    goals = raked.withColumns({f"goal_{d}": F.col(f"target_{d}") for d in DIMENSIONS})
    off = margin_error(goals, F.col("weight"))
    if off > TOLERANCE:
        warnings.warn(f"after {rounds} rounds a margin is {off:.2%} off its target", stacklevel=2)
    return raked.select(*DIMENSIONS, "tokens", "weight")


def calibrated(raked: DataFrame) -> DataFrame:
    """Cells with `probability`: proportional to weight per token, and one for the neediest cell."""
    most = raked.agg(F.max(F.col("weight") / F.col("tokens"))).first()[0] or 1.0
    return raked.select(*DIMENSIONS, (F.col("weight") / F.col("tokens") / F.lit(float(most))).alias("probability"))


def largest_total(raked: DataFrame, unmet: float = UNMET) -> float:
    """Tokens of the largest sample of which the cells lack at most the share `unmet`."""
    need = F.col("weight") / F.col("tokens")
    most, weight, tokens = raked.agg(F.max(need), F.sum("weight"), F.sum("tokens")).first()
    if not most:
        return float(tokens or 0)
    low, high = weight / most, float(tokens)
    for _ in range(LOOKS):
        totals = [low * (high / low) ** (i / TOTALS) for i in range(TOTALS + 1)]
        lacks = raked.agg(*[
            F.sum(F.greatest(F.col("weight") / F.lit(weight) - F.col("tokens") / F.lit(t), F.lit(0.0))).alias(f"t{i}")
            for i, t in enumerate(totals)]).first()
        last = max((i for i, lack in enumerate(lacks) if lack <= unmet), default=0)
        low, high = totals[last], totals[min(last + 1, TOTALS)]
    return low


def _goal_scale(cells: DataFrame, dimension: str, total: float) -> float:
    """What targets are scaled by so that they reach `total` although some values run out."""
    margins = cells.groupBy(dimension).agg(F.sum("tokens").alias("present"), F.first(f"target_{dimension}").alias("target"))
    scale = total
    while True:
        runs_out = F.col("present") <= F.col("target") * F.lit(scale)
        full, free = margins.agg(F.sum(F.when(runs_out, F.col("present"))), F.sum(F.when(~runs_out, F.col("target")))).first()
        higher = (total - (full or 0)) / free if free else scale
        if higher <= scale * (1 + 1e-9):
            return scale
        scale = higher


def _off(held: Column) -> Column:
    """How far the values of a cell are from their goals, as a share of the goal, if cells hold `held`."""
    off = []
    for d in DIMENSIONS:
        present = F.sum(held).over(Window.partitionBy(d))
        off.append(F.coalesce(F.try_divide(F.abs(present - F.col(f"goal_{d}")), F.col(f"goal_{d}")), F.lit(0.0)))
    return F.greatest(*off)


def margin_error(cells: DataFrame, held: Column | None = None) -> float:
    """The largest distance from its goal of what a value holds, as a share of the goal.

    A cell holds its weight, but no more than it has, or `held`.
    """
    held = F.least("weight", "tokens") if held is None else held
    return cells.select(_off(held).alias("off")).agg(F.max("off")).first()[0] or 0.0


def rake_within(cells: DataFrame, targets: dict[str, DataFrame], unmet: float = UNMET, rounds: int = ROUNDS) -> DataFrame:
    """Cells with `probability`, of the largest sample of which cells lack at most `unmet`.

    Each value's goal is its target share of the sample, or all its tokens. Cells are
    scaled as in `rake`, but count with no more than they have, so what a full cell lacks
    goes to the others of its margin. Targets that contradict each other are warned of.
    """
    cells = _raked(cells, targets, rounds)
    total = largest_total(cells, unmet)
    for d in DIMENSIONS:
        present = F.sum("tokens").over(Window.partitionBy(d))
        cells = cells.withColumn(f"goal_{d}", F.least(present.cast("double"), F.col(f"target_{d}") * F.lit(_goal_scale(cells, d, total))))
    sum_of_weights = cells.agg(F.sum("weight")).first()[0] or 1.0
    cells = _stored(cells.withColumn("weight", F.col("weight") * F.lit(total / sum_of_weights)))
    off, done, stuck = margin_error(cells), 0, False
    while off > TOLERANCE and done < MOST_ROUNDS and not stuck:
        kept = cells.columns
        marks = range(MARKS if _few(cells) else 1)
        for i in marks:
            for d in DIMENSIONS * ROUNDS_PER_WRITE:
                held = F.sum(F.least("weight", "tokens")).over(Window.partitionBy(d))
                cells = cells.withColumn("weight", F.col("weight") * F.coalesce(F.try_divide(F.col(f"goal_{d}"), held), F.lit(1.0)))
            cells = cells.withColumns({f"weight_{i}": F.col("weight"), f"off_{i}": _off(F.least("weight", "tokens"))})
        cells = _stored(cells)
        found = cells.agg(*[F.max(f"off_{i}") for i in marks]).first()
        # The weights of the first mark that ends the raking, else of the last.
        for i in marks:
            before, off = off, found[i] or 0.0
            stuck = done >= rounds and off > 0.99 * before
            done += ROUNDS_PER_WRITE
            if off <= TOLERANCE or done >= MOST_ROUNDS or stuck:
                break
        cells = cells.withColumn("weight", F.col(f"weight_{i}")).select(*kept)
    if off > TOLERANCE:
        warnings.warn(f"targets contradict each other: a margin stays {off:.2%} off its goal", stacklevel=2)
    return cells.select(*DIMENSIONS, (F.least("weight", "tokens") / F.col("tokens")).alias("probability"))


def uniform(id: str) -> Column:
    """A number in [0, 1) from the id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix_documents(docs: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None,
                  rounds: int = ROUNDS, temper: float = TEMPER, id: str = "doc_id", text: str = "text",
                  unmet: float | None = None) -> DataFrame:
    """The rows of `docs` with topic, tokens, probability and kept.

    `targets` gives tables (value, target) by dimension; without it, the tempered shares
    of the documents themselves are the targets. With `unmet`, the neediest cells do not set
    the scale, see `rake_within`.
    """
    plain = docs.drop("topic", "tokens", "probability", "kept")
    words = word_count(text)
    counted = plain.withColumns({"topic": topic if topic is not None else kind_of(words),
                                 "tokens": F.greatest(words, F.lit(1)).cast("long")})
    cells = _stored(counted.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    if not targets:
        total = cells.agg(F.sum("tokens")).first()[0] or 1
        targets = {d: tempered_targets(cells, d, temper, total) for d in DIMENSIONS}
    found = calibrated(rake(cells, targets, rounds)) if unmet is None else rake_within(cells, targets, unmet, rounds)
    chances = materialise(found, "mix-chances")
    joined = keyed_join(counted, chances, list(DIMENSIONS), "left", null_safe=True)
    return joined.withColumn("kept", uniform(id) < F.col("probability"))


def raking_sql(documents: str = "documents", rounds: int = ROUNDS, temper: float = TEMPER) -> str:
    """The same in SQL that DuckDB runs: common tables named mixed (all rows of `documents`)."""
    kind = "CASE " + " ".join(f"WHEN n < {below} THEN '{name}'" for name, below in KINDS) + f" ELSE '{LONGEST_KIND}' END"
    steps = [f"""counted AS (SELECT *, {kind} AS topic, greatest(n, 1) AS tokens FROM
      (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM {documents}))""",
             "cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM counted GROUP BY ALL)"]
    for d in DIMENSIONS:
        steps.append(f"""target_{d} AS (SELECT {d}, target / sum(target) OVER () AS target FROM
          (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {temper}) AS target FROM cells GROUP BY {d}))""")
    steps.append("raked_0 AS (SELECT *, tokens AS weight FROM cells)")
    step = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"""raked_{step + 1} AS MATERIALIZED (SELECT r.source, r.lang, r.topic, r.tokens,
              r.weight * t.target / sum(r.weight) OVER (PARTITION BY r.{d}) AS weight
              FROM raked_{step} r JOIN target_{d} t ON r.{d} IS NOT DISTINCT FROM t.{d})""")
            step += 1
    steps.append(f"""chances AS (SELECT source, lang, topic,
      weight / tokens / (SELECT max(weight / tokens) FROM raked_{step}) AS probability FROM raked_{step})""")
    draw = "CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0"
    steps.append(f"""mixed AS (SELECT c.*, h.probability, {draw} < h.probability AS kept
      FROM counted c JOIN chances h ON c.source IS NOT DISTINCT FROM h.source
        AND c.lang IS NOT DISTINCT FROM h.lang AND c.topic IS NOT DISTINCT FROM h.topic)""")
    return "WITH " + ",\n".join(steps)
