"""Keyed result tables that grow over runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cache_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new entries with the newest entry per key.

    Keys are unique inside each side, so an anti-join of the old side is enough; no sort per key
    is needed. Write the result to a new path, never to the one being read.
    """
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(
        new, allowMissingColumns=True
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """Newest entry per key where a batch may hold a key more than once."""
    others = [c for c in df.columns if c not in keys and c not in recency]
    newest = F.max(F.struct(*recency, *others)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def source_replace_upsert(old: DataFrame, new: DataFrame, source: str = "source") -> DataFrame:
    """All old chunks of re-ingested sources replaced by the new ones."""
    return old.join(new.select(source).distinct(), source, "left_anti").unionByName(
        new, allowMissingColumns=True
    )


def anti_uncached(requests: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested keys that are not cached yet."""
    return requests.select(*keys).distinct().join(cache.select(*keys), list(keys), "left_anti")


def cached_count(requests: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    hits = requests.join(cache.select(*keys).distinct(), list(keys), "left_semi")
    return hits.agg(F.count("*").alias("cached_count"))
