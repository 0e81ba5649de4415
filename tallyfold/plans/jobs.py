"""Whole jobs: raw text in, clean and joined tables out, all named by a catalog."""

from __future__ import annotations

from pyspark.ml import PipelineModel

from tallyfold.operators.features import split_by_key
from tallyfold.plans import models, movies
from tallyfold.plans.dimensions import clean_airports, clean_carriers
from tallyfold.plans.flights import EXPECTED, clean_flights
from tallyfold.plans.reports import master_flights
from tallyfold.sources.catalog import Catalog
from tallyfold.sources.intake import Quality


def clean_flight_tables(catalog: Catalog, compression: str = "snappy") -> None:
    """Read the three raw tables, clean each and save it.

    Missing and unreadable cells of the raw flights are counted while the clean ones are written, and saved as
    `flight_quality` where the catalog has that dataset.
    """
    for name, clean in (("airports", clean_airports), ("carriers", clean_carriers)):
        catalog.save(clean(catalog.load(f"raw_{name}")), f"clean_{name}", compression=compression)
    raw, quality = catalog.load("raw_flights"), None
    if "flight_quality" in catalog:
        quality = Quality(EXPECTED)
        raw = quality.watch(raw)
    catalog.save(clean_flights(raw), "clean_flights", compression=compression)
    if quality:
        catalog.save(quality.table(raw.sparkSession), "flight_quality")


def build_master_flights(catalog: Catalog, compression: str = "snappy", **columns: str) -> None:
    """Join the clean tables, as saved, to the complete view and save it."""
    view = master_flights(*[catalog.load(f"clean_{name}") for name in ("flights", "carriers", "airports")], **columns)
    catalog.save(view, "master_flights", compression=compression)


def train_and_score_movies(catalog: Catalog, train_share: float = 0.7, seed: int = 123) -> PipelineModel:
    """Train the score's forest on one part of the movies, score the other and save title, score and prediction."""
    table = movies.regression_features(
        catalog.load("movies_before"), catalog.load("movies_after"), extra_keys=(movies.TITLE,))
    train, validation = split_by_key(table, [movies.TITLE], train_share, seed)
    features = [c for c in table.columns if c not in (movies.TITLE, movies.SCORE)]
    model = models.fit_forest_regressor(train, movies.SCORE, features)
    scored = models.score_numbers(model, validation).select(movies.TITLE, movies.SCORE, "prediction")
    catalog.save(scored, "movie_scores")
    return model
