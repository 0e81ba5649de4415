"""Feature tables for predicting a movie's score from what is known before and after release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.numeric import bins
from tallyfold.operators.features import (
    impute,
    keep_most_frequent,
    label_indicators,
    learn_fill_values,
    learn_scale,
    one_hot,
    one_hot_columns,
    recode,
    standardise,
)
from tallyfold.operators.joins import keyed_join
from tallyfold.operators.shape import (
    cast_columns,
    drop_columns,
    fill_nulls,
    keep_rows_with_fewer_nulls,
)
from tallyfold.session import materialise

# Column groups, fill values, country groups and score bins.
TITLE, SCORE = "movie_title", "imdb_score"
PEOPLE = ("director_name", "actor_1_name", "actor_2_name", "actor_3_name")
AFTER_ONLY = (
    "num_critic_for_reviews", "gross", "num_voted_users", "num_user_for_reviews",
    "movie_facebook_likes",
)
ACTOR_LIKES = ("actor_1_facebook_likes", "actor_2_facebook_likes", "actor_3_facebook_likes")
NUMBERS = ("duration", "director_facebook_likes", "cast_total_facebook_likes", "budget")
REGRESSION_FILLS = {
    "content_rating": "R",
    "language": "English",
    "actor_1_facebook_likes": 653.813397,
    "actor_2_facebook_likes": 438.397510,
    "actor_3_facebook_likes": 299.271593,
}
EUROPE = (
    "UK", "France", "Germany", "Spain", "Italy", "Norway", "Denmark", "Ireland", "Netherlands",
    "Romania", "Sweden", "Iceland", "West Germany", "Slovenia", "Poland", "Czech Republic",
    "Bulgaria", "Belgium",
)
COUNTRY_GROUPS = {"USA": ("USA",), "Europe": (*EUROPE, "Europe")}
SCORE_EDGES, SCORE_BINS = (0, 5, 6, 7, 10), ("0-5", "5-6", "6-7", "7-10")
FEWEST_NULLS_TO_DROP = 5
KEPT_VALUES = {"content_rating": 3, "country": 2}
UNUSED_GENRE = "Western"


def typed(frame: DataFrame) -> DataFrame:
    """Text columns that hold numbers as doubles."""
    known = (*ACTOR_LIKES, *NUMBERS, *AFTER_ONLY, SCORE)
    return cast_columns(frame, {T.DoubleType(): [c for c in known if c in frame.columns]})


def regression_features(
    before: DataFrame, after: DataFrame, extra_keys: tuple[str, ...] = ()
) -> DataFrame:
    """Numeric features and the score, one row per distinct movie.

    `extra_keys` are columns to carry along untouched, for the split. Missing numbers
    without a fixed fill get their median, as a feature vector has no NULLs.
    """
    movies = keyed_join(typed(before), typed(after), [TITLE])
    movies = drop_columns(movies, (*AFTER_ONLY, *({TITLE} - set(extra_keys)))).distinct()
    movies = materialise(drop_columns(movies, PEOPLE), "movies")
    movies = fill_nulls(movies, REGRESSION_FILLS)
    movies = movies.withColumns({
        "country": recode(F.col("country"), COUNTRY_GROUPS, "other"),
        "language": recode(F.col("language"), {"English": ("English",)}, "Other"),
    })
    movies = drop_columns(movies, ["content_rating"])
    movies = label_indicators(movies, "genres", key=[TITLE])
    movies = drop_columns(movies, ["genres"])
    movies = impute(movies, learn_fill_values(movies, median_columns=NUMBERS))
    # The groups are fixed, so the columns do not depend on which of them the data has.
    movies = one_hot(movies, "language", ("English", "Other"))
    return one_hot(movies, "country", ("Europe", "USA", "other"))


def classification_features(
    before: DataFrame, after: DataFrame, extra_keys: tuple[str, ...] = ()
) -> DataFrame:
    """Standardised features and the score's bin, one row per movie in both tables."""
    # What statistics are learnt from in several passes is typed and written once.
    before = keep_rows_with_fewer_nulls(typed(before), FEWEST_NULLS_TO_DROP)
    before, after = materialise(before, "movies-before"), materialise(typed(after), "movies-after")
    before_numbers = [c for c in (*ACTOR_LIKES, *NUMBERS) if c in before.columns]
    before = impute(before, learn_fill_values(
        before, ["content_rating", "language", "country"], before_numbers
    ))
    after_numbers = [c for c in (*AFTER_ONLY, SCORE) if c in after.columns]
    after = impute(after, learn_fill_values(after, median_columns=after_numbers))
    before = drop_columns(before, (*ACTOR_LIKES, "language"))
    before = keep_most_frequent(before, KEPT_VALUES)
    before = label_indicators(before.distinct(), "genres", key=[TITLE], without=(UNUSED_GENRE,))
    before = drop_columns(before, ["genres"])
    movies = keyed_join(before, after.distinct(), [TITLE])
    movies = drop_columns(movies, (*PEOPLE, *AFTER_ONLY, *({TITLE} - set(extra_keys))))
    movies = materialise(movies, "movies")
    movies = standardise(movies, learn_scale(movies, NUMBERS))
    movies = one_hot_columns(movies, list(KEPT_VALUES), key=[TITLE])
    binned = movies.withColumn("imdb_score_bins", bins(F.col(SCORE), SCORE_EDGES, SCORE_BINS))
    return drop_columns(binned, [SCORE])
