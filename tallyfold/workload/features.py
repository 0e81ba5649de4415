"""Queries on feature preparation and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.numeric import bins, round_half_even
from tallyfold.operators import features
from tallyfold.operators.aggregates import modes
from tallyfold.plans import certificates, models, movies, trees
from tallyfold.plans.jobs import train_and_score_movies
from tallyfold.session import scratch_path
from tallyfold.sources.catalog import Catalog, movie_catalog
from tallyfold.workload import raw
from tallyfold.workload.registry import query


@query("recode", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'home'
  WHEN c_mktsegment = 'MACHINERY' THEN 'work' ELSE 'other' END AS segment FROM customer""")
def _(t):
    groups = {"home": ("BUILDING", "HOUSEHOLD"), "work": ("MACHINERY",)}
    return t.customer.select(
        "c_custkey", features.recode(F.col("c_mktsegment"), groups, "other").alias("segment")
    )


@query("keep_most_frequent", """
WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 3)
SELECT p_partkey, CASE WHEN p_brand IN (FROM top) THEN p_brand ELSE 'Other' END AS p_brand FROM part""")
def _(t):
    return features.keep_most_frequent(t.part.select("p_partkey", "p_brand"), {"p_brand": 3})


_GENRES = """
SELECT p_partkey, CASE WHEN p_size = 7 THEN NULL ELSE p_type
  || CASE WHEN p_size % 2 = 0 THEN '|Drama' ELSE '' END
  || CASE WHEN p_size % 5 = 0 THEN '|Western' ELSE '' END END AS genres FROM {part}"""
_LABELS = ("Drama", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Western")


def _sql_has(label: str) -> str:
    return (f"CAST(coalesce(list_contains(string_split(genres, '|'), '{label}'), false) AS INTEGER)"
            f' AS "{label}"')


@query("multi_label", f"""
SELECT p_partkey, {", ".join(map(_sql_has, _LABELS))} FROM ({_GENRES.format(part="part")})""")
def _(t):
    parts = t.derive(_GENRES, "part")
    return features.label_indicators(parts, "genres", key=["p_partkey"]).drop("genres")


@query("multi_label_vector", f"""
WITH g AS ({_GENRES.format(part="part")}), v AS (
  SELECT value, row_number() OVER (ORDER BY value) - 1 AS position FROM (
    SELECT DISTINCT unnest(string_split(genres, '|')) AS value FROM g)),
n AS (SELECT p_partkey, list(position ORDER BY position) AS indices FROM
  (SELECT p_partkey, unnest(string_split(genres, '|')) AS value FROM g) JOIN v USING (value) GROUP BY 1)
SELECT p_partkey, (SELECT count(*) FROM v) AS size, coalesce(array_to_string(indices, ','), '') AS indices
FROM g LEFT JOIN n USING (p_partkey)""")
def _(t):
    parts = t.derive(_GENRES, "part")
    vectors = features.indicator_vector(parts, "genres", features.label_vocabulary(parts, "genres"), ["p_partkey"], "|")
    indices = F.array_join(F.col("genres_vector.indices").cast("array<string>"), ",")
    return vectors.select("p_partkey", F.col("genres_vector.size").alias("size"), indices.alias("indices"))


@query("one_hot", """
SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
       CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE",
       CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
       CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY" FROM customer""")
def _(t):
    customers = t.customer.select("c_custkey", "c_mktsegment")
    return features.one_hot_columns(customers, ["c_mktsegment"], key=["c_custkey"])


@query("bins", """
SELECT p_partkey, CASE WHEN p_size / 4.0 > 0 AND p_size / 4.0 <= 5 THEN '0-5' WHEN p_size / 4.0 <= 6 THEN '5-6'
  WHEN p_size / 4.0 <= 7 THEN '6-7' WHEN p_size / 4.0 <= 10 THEN '7-10' END AS score_bin FROM part""")
def _(t):
    score = F.col("p_size") / 4.0
    return t.part.select(
        "p_partkey", bins(score, movies.SCORE_EDGES, movies.SCORE_BINS).alias("score_bin")
    )


@query("round_half_even", """
SELECT l_orderkey, l_linenumber, l_quantity, round_even(l_quantity / 2, 0) AS half FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        round_half_even(F.col("l_quantity") / 2).alias("half"),
    )


@query("int_to_double", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size FROM part")
def _(t):
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"))


@query("modes", """
SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS count
FROM orders GROUP BY 2 QUALIFY row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) = 1
UNION ALL
SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY o_custkey
QUALIFY row_number() OVER (ORDER BY count(*) DESC, o_custkey) = 1""")
def _(t):
    return modes(t.orders, ["o_orderpriority", "o_custkey"])


_HOLES = """
SELECT o_orderkey, NULLIF(o_orderpriority, '3-MEDIUM') AS priority,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS custkey
FROM {orders}"""
_HOLES_SQL = _HOLES.format(orders="orders")


@query("impute", f"""
WITH h AS ({_HOLES_SQL}), m AS (SELECT median(price) AS price, median(custkey) AS custkey FROM h),
p AS (SELECT priority FROM h WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(priority, (SELECT priority FROM p)) AS priority,
       coalesce(price, (SELECT price FROM m)) AS price,
       coalesce(CAST(custkey AS DOUBLE), (SELECT custkey FROM m)) AS custkey FROM h""")
def _(t):
    holes = t.derive(_HOLES, "orders")
    values = features.learn_fill_values(holes, ["priority"], ["price", "custkey"])
    return features.impute(holes, values)


@query("exact_median", """
SELECT l_returnflag, med FROM (SELECT 'price' AS l_returnflag, median(l_extendedprice) AS med FROM lineitem
UNION ALL SELECT 'quantity', median(l_quantity) FROM lineitem
UNION ALL SELECT 'orderkey', median(l_orderkey) FROM lineitem)""".replace("l_returnflag", "name"))
def _(t):
    lines = t.lineitem.select(
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
        F.col("l_orderkey").alias("orderkey"),
    )
    found = features.exact_medians(lines, lines.columns)
    return t.spark.createDataFrame(list(found.items()), "name string, med double")


@query("standardise", """
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6)
         AS o_totalprice,
       round((o_custkey - avg(o_custkey) OVER ()) / stddev_pop(o_custkey) OVER (), 6) AS o_custkey
FROM orders""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_custkey")
    columns = ["o_totalprice", "o_custkey"]
    scaled = features.standardise(orders, features.learn_scale(orders, columns))
    return scaled.withColumns({c: F.round(c, 6) for c in columns})


_BUCKET = "CAST(('0x' || md5('123|' || o_orderkey)[:8]) AS BIGINT) % 10000"


@query("split_by_key", f"SELECT o_orderkey, {_BUCKET} < 7000 AS is_train FROM orders")
def _(t):
    train, validation = features.split_by_key(t.orders.select("o_orderkey"), ["o_orderkey"], 0.7, 123)
    return train.withColumn("is_train", F.lit(True)).unionByName(
        validation.withColumn("is_train", F.lit(False))
    )


_PREDICTED = """
SELECT o_orderkey, o_orderstatus AS truth,
       CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 350000 THEN 'O' ELSE 'P' END AS prediction,
       o_totalprice AS price, o_totalprice * 0.9 + o_custkey AS guess
FROM {orders}"""
_PREDICTED_SQL = _PREDICTED.format(orders="orders")


@query("label_metrics", f"""
WITH s AS ({_PREDICTED_SQL}), l AS (SELECT DISTINCT truth AS label FROM s)
SELECT label, count(*) FILTER (truth = label) AS support,
       round(count(*) FILTER (truth = label AND prediction = label) / count(*) FILTER (prediction = label), 9) AS precision,
       round(count(*) FILTER (truth = label AND prediction = label) / count(*) FILTER (truth = label), 9) AS recall,
       round(2 * count(*) FILTER (truth = label AND prediction = label)
         / (count(*) FILTER (truth = label) + count(*) FILTER (prediction = label)), 9) AS f1
FROM s, l GROUP BY label""")
def _(t):
    rated = models.label_metrics(t.derive(_PREDICTED, "orders"), "truth")
    return rated.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("confusion", f"""
SELECT truth AS label, prediction AS predicted, count(*) AS rows FROM ({_PREDICTED_SQL}) GROUP BY ALL""")
def _(t):
    return models.confusion(t.derive(_PREDICTED, "orders"), "truth")


@query("accuracy", f"""
SELECT count(*) FILTER (truth = prediction) / count(*) AS accuracy FROM ({_PREDICTED_SQL})""")
def _(t):
    return models.accuracy(t.derive(_PREDICTED, "orders"), "truth")


@query("number_metrics", f"""
SELECT round(sqrt(avg((price - guess) ** 2)), 4) AS rmse, round(avg(abs(price - guess)), 4) AS mae,
       round(1 - avg((price - guess) ** 2) / var_pop(price), 8) AS r2 FROM ({_PREDICTED_SQL})""")
def _(t):
    rated = models.number_metrics(t.derive(_PREDICTED, "orders"), "price", "guess")
    return rated.select(
        F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2")
    )


# ---------------------------------------------------------------- movies

_BEFORE, _AFTER = raw.plain(raw.MOVIES_BEFORE), raw.plain(raw.MOVIES_AFTER)
_EUROPE = ", ".join(f"'{c}'" for c in movies.EUROPE)


def _sql_filled(column: str, median_of: str) -> str:
    return f"coalesce({column}, (SELECT median({column}) FROM {median_of})) AS {column}"


@query("movie_regression_features", f"""
WITH b AS ({_BEFORE}), a AS ({_AFTER}),
m AS (SELECT DISTINCT b.movie_title, content_rating, language, country, genres, TRY_CAST(duration AS DOUBLE) AS duration,
  TRY_CAST(budget AS DOUBLE) AS budget, director_name, actor_1_name, actor_2_name, actor_3_name,
  TRY_CAST(director_facebook_likes AS DOUBLE) AS director_facebook_likes,
  TRY_CAST(actor_1_facebook_likes AS DOUBLE) AS actor_1_facebook_likes,
  TRY_CAST(actor_2_facebook_likes AS DOUBLE) AS actor_2_facebook_likes,
  TRY_CAST(actor_3_facebook_likes AS DOUBLE) AS actor_3_facebook_likes,
  TRY_CAST(cast_total_facebook_likes AS DOUBLE) AS cast_total_facebook_likes,
  TRY_CAST(imdb_score AS DOUBLE) AS imdb_score
  FROM b JOIN a ON b.movie_title = a.movie_title)
SELECT movie_title, imdb_score, {", ".join(_sql_filled(c, "m") for c in movies.NUMBERS)},
       coalesce(actor_1_facebook_likes, 653.813397) AS actor_1_facebook_likes,
       coalesce(actor_2_facebook_likes, 438.39751) AS actor_2_facebook_likes,
       coalesce(actor_3_facebook_likes, 299.271593) AS actor_3_facebook_likes,
       {", ".join(map(_sql_has, _LABELS))},
       CAST(coalesce(language, 'English') <> 'English' AS INTEGER) AS "language_Other",
       CAST(coalesce(country = 'USA', false) AS INTEGER) AS "country_USA",
       CAST(coalesce(country NOT IN ('USA', 'Europe', {_EUROPE}), true) AS INTEGER) AS country_other
FROM m""")
def _(t):
    return movies.regression_features(*raw.movies(t), extra_keys=(movies.TITLE,))


_B_NUMBERS = [*movies.ACTOR_LIKES, *movies.NUMBERS]


def _sql_mode(column: str) -> str:
    return (f"coalesce({column}, (SELECT {column} FROM kept WHERE {column} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, 1 LIMIT 1)) AS {column}")


def _sql_top(column: str, k: int) -> str:
    return (f"CASE WHEN {column} IN (SELECT {column} FROM filled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {k}) "
            f"THEN {column} ELSE 'Other' END AS {column}")


@query("movie_classification_features", f"""
WITH b AS (SELECT movie_title, content_rating, language, country, genres, director_name, actor_1_name,
    actor_2_name, actor_3_name, {", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _B_NUMBERS)} FROM ({_BEFORE})),
kept AS (SELECT * FROM b WHERE {" + ".join(
    f"CAST({c} IS NULL AS INT)" for c in (
        "movie_title", "content_rating", "language", "country", "genres", *movies.PEOPLE, *_B_NUMBERS))} < 5),
filled AS (SELECT movie_title, genres, director_name, actor_1_name, actor_2_name, actor_3_name,
    {", ".join(map(_sql_mode, ("content_rating", "country")))},
    {", ".join(_sql_filled(c, "kept") for c in movies.NUMBERS)} FROM kept),
topped AS (SELECT DISTINCT movie_title, genres, director_name, actor_1_name, actor_2_name, actor_3_name,
    {_sql_top("country", 2)}, {_sql_top("content_rating", 3)}, {", ".join(movies.NUMBERS)} FROM filled),
m AS (SELECT topped.*, CAST(imdb_score AS DOUBLE) AS score FROM topped JOIN ({_AFTER}) USING (movie_title))
SELECT movie_title,
  {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in movies.NUMBERS)},
  {", ".join(_sql_has(label) for label in _LABELS if label != "Western")},
  CAST(content_rating = 'PG' AS INTEGER) AS "content_rating_PG",
  CAST(content_rating = 'PG-13' AS INTEGER) AS "content_rating_PG-13",
  CAST(content_rating = 'R' AS INTEGER) AS "content_rating_R",
  CAST(country = 'UK' AS INTEGER) AS "country_UK", CAST(country = 'USA' AS INTEGER) AS "country_USA",
  CASE WHEN score > 0 AND score <= 5 THEN '0-5' WHEN score <= 6 THEN '5-6' WHEN score <= 7 THEN '6-7'
    WHEN score <= 10 THEN '7-10' END AS imdb_score_bins
FROM m""")
def _(t):
    table = movies.classification_features(*raw.movies(t), extra_keys=(movies.TITLE,))
    return table.withColumns({c: F.round(c, 6) for c in movies.NUMBERS})


def _regression_parts(t):
    table = movies.regression_features(*raw.movies(t), extra_keys=(movies.TITLE,))
    columns = [c for c in table.columns if c not in (movies.TITLE, movies.SCORE)]
    return columns, features.split_by_key(table, [movies.TITLE], 0.7, 123)


def _classification_parts(t):
    table = movies.classification_features(*raw.movies(t), extra_keys=(movies.TITLE,))
    table = table.where("imdb_score_bins is not null")
    columns = [c for c in table.columns if c not in (movies.TITLE, "imdb_score_bins")]
    return columns, features.split_by_key(table, [movies.TITLE], 0.8, 42)


# Predictions depend on random draws, so the checked columns are which rows are scored, their true
# values, and proofs that the model is the one that the training rows give. Each can fail.
_MOVIES_SQL = f"""(SELECT DISTINCT b.movie_title, content_rating, language, country, genres, duration, budget, director_name,
  actor_1_name, actor_2_name, actor_3_name, director_facebook_likes, actor_1_facebook_likes, actor_2_facebook_likes,
  actor_3_facebook_likes, cast_total_facebook_likes, TRY_CAST(imdb_score AS DOUBLE) AS score
  FROM ({_BEFORE}) b JOIN ({_AFTER}) a ON b.movie_title = a.movie_title)"""


def _sql_bucket(seed: int) -> str:
    return f"CAST(('0x' || md5('{seed}|' || movie_title)[:8]) AS BIGINT) % 10000"


@query("forest_regression", f"""
SELECT movie_title, score AS imdb_score, true AS in_range, true AS leaves_hold, true AS beats_mean
FROM {_MOVIES_SQL} WHERE {_sql_bucket(123)} >= 7000""")
def _(t):
    columns, (train, validation) = _regression_parts(t)
    model = models.fit_forest_regressor(train, movies.SCORE, columns)
    low, high = train.agg(F.min(movies.SCORE), F.max(movies.SCORE)).first()
    holds = trees.unsound_leaves(trees.leaf_spans(model, train, movies.SCORE)) == 0
    better = certificates.beats_mean(models.score_numbers(model, train), movies.SCORE, "raw_prediction")
    return models.score_numbers(model, validation).select(
        movies.TITLE, movies.SCORE,
        F.col("raw_prediction").between(low - 1e-6, high + 1e-6).alias("in_range"),
        F.lit(holds).alias("leaves_hold"), F.lit(better).alias("beats_mean"),
    )


_SCORED_LABELS = f"""
WITH b AS (SELECT movie_title, content_rating, language, country, genres, director_name, actor_1_name,
    actor_2_name, actor_3_name, {", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _B_NUMBERS)} FROM ({_BEFORE})),
kept AS (SELECT * FROM b WHERE {" + ".join(
    f"CAST({c} IS NULL AS INT)" for c in (
        "movie_title", "content_rating", "language", "country", "genres", *movies.PEOPLE, *_B_NUMBERS))} < 5),
filled AS (SELECT movie_title, genres, director_name, actor_1_name, actor_2_name, actor_3_name,
    {", ".join(map(_sql_mode, ("content_rating", "country")))},
    {", ".join(_sql_filled(c, "kept") for c in movies.NUMBERS)} FROM kept),
topped AS (SELECT DISTINCT movie_title, genres, director_name, actor_1_name, actor_2_name, actor_3_name,
    {_sql_top("country", 2)}, {_sql_top("content_rating", 3)}, {", ".join(movies.NUMBERS)} FROM filled),
m AS (SELECT topped.movie_title, CAST(imdb_score AS DOUBLE) AS score FROM topped JOIN ({_AFTER}) USING (movie_title)),
s AS (SELECT movie_title, CASE WHEN score > 0 AND score <= 5 THEN '0-5' WHEN score <= 6 THEN '5-6'
    WHEN score <= 7 THEN '6-7' WHEN score <= 10 THEN '7-10' END AS imdb_score_bins FROM m)
SELECT movie_title, imdb_score_bins, true AS is_label, true AS is_fitted, true AS is_better
FROM s WHERE imdb_score_bins IS NOT NULL AND {_sql_bucket(42)} >= 8000"""


LABEL = "imdb_score_bins"


def _checked_labels(scored, fitted: bool, better: bool):
    return scored.select(movies.TITLE, LABEL, F.col("prediction").isin(*movies.SCORE_BINS).alias("is_label"),
                         F.lit(fitted).alias("is_fitted"), F.lit(better).alias("is_better"))


def _pruned_forest(t):
    columns, (train, test) = _classification_parts(t)
    model = models.fit_forest_classifier(train, LABEL, columns, movies.SCORE_BINS)
    full = trees.trees_of(t.spark, model.stages[1])
    return columns, train, test, model, full, [trees.pruned(tree, models.MOST_LEAVES) for tree in full]


@query("forest_classification", _SCORED_LABELS)
def _(t):
    """Fitted: no tree has more than its leaves, and before they were cut back the compiled trees voted as the model does."""
    columns, train, test, model, full, small = _pruned_forest(t)
    few = all(len(trees.leaves(tree)) <= models.MOST_LEAVES for tree in small)
    same = models.votes_differ(model, full, test, columns) <= 1e-9
    better = certificates.beats_majority(trees.score_by_votes(train, small, columns, movies.SCORE_BINS), LABEL)
    return _checked_labels(trees.score_by_votes(test, small, columns, movies.SCORE_BINS), few and same, better)


@query("logistic_regression", _SCORED_LABELS)
def _(t):
    """Fitted: the gradient of the loss is zero at the coefficients, and the loss below that without any."""
    columns, (train, test) = _classification_parts(t)
    model = models.fit_logistic_regression(train, LABEL, columns, movies.SCORE_BINS)
    found = certificates.logistic_optimum(model, train, LABEL, columns, movies.SCORE_BINS, models.PENALTY)
    return _checked_labels(models.score_labels(model, test), found.slope <= 1e-4, found.loss < found.idle_loss)


@query("predicted_labels")
def _(t):
    """The labels that both models give the rows they have not seen."""
    columns, train, test, _, _, small = _pruned_forest(t)
    model = models.fit_logistic_regression(train, LABEL, columns, movies.SCORE_BINS)
    voted = trees.score_by_votes(test, small, columns, movies.SCORE_BINS).withColumnRenamed("prediction", "forest_label")
    return models.score_labels(model, voted).select(
        movies.TITLE, LABEL, "forest_label", F.col("prediction").alias("logistic_label"))


@query("movie_job")
def _(t):
    """The whole job: raw text in files, features, forest, scores as JSON lines, read back."""
    folder = scratch_path(t.spark, "movie-job")
    links = movie_catalog(f"{folder}/raw", f"{folder}/scored")
    catalog = Catalog(t.spark, links)
    for name, frame in zip(("movies_before", "movies_after"), raw.movies(t)):
        catalog.save(frame, name)
    train_and_score_movies(catalog)
    return t.spark.read.schema("movie_title string, imdb_score double, prediction double").json(links["movie_scores"].path)
