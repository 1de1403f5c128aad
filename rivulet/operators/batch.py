"""Batch prediction: decoded report pages to located, scored samples and their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.detect import invalid_report_name
from rivulet.operators.extract import extract_samples
from rivulet.operators.locate import join_geocode_cache
from rivulet.operators.score import clean_samples, scored
from rivulet.operators.shaping import ensure_columns


def rejected_files(pages: DataFrame) -> DataFrame:
    """Files (file_name, year) whose name does not fit their year; their pages are not read."""
    names = pages.select("file_name", "year").distinct()
    return names.filter(invalid_report_name(F.col("file_name"), F.col("year")))


def predict_batch(pages: DataFrame, cache: DataFrame, state: str | None = None) -> DataFrame:
    """Samples of all pages with an accepted file name: cleaned, located and scored by Class-A limits.

    ``cache`` holds positions by location and state. With a state only its samples are kept. The
    only shuffle is the join with the cache.
    """
    accepted = pages.filter(~invalid_report_name(F.col("file_name"), F.col("year")))
    samples = extract_samples(accepted)
    if state is not None:
        samples = samples.filter(F.upper("state") == state.upper())
    located = join_geocode_cache(clean_samples(samples), cache)
    return scored(ensure_columns(located)).withColumn(
        "pollution_score", F.round("pollution_score", 2))
