"""Summaries kept as mergeable states, refreshed for the years whose files have changed.

A state is the last known label and score of a station in a year with the place they were taken from. The latest
state of a station is the largest over its years, so overview and trend come from the states alone. ``files``
remembers a digest of each year's file listing, ``states`` holds the states by year; both are keyed
stores. States are committed first: a refresh cut off in between is done again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import schema as S
from rivulet.functions.digests import digest_per
from rivulet.operators import stats
from rivulet.operators.shaping import not_null
from rivulet.sources import store
from rivulet.sources.files import scan_year_partitions

VALUES = ("pollution_score", "safety_label")
FILES = "year int, digest string"


def year_states(df: DataFrame) -> DataFrame:
    """One row per station and year; each value with the order keys of the row it is known from, null where never known."""
    order = [c for c in S.SAMPLE_ORDER if c in df.columns and c != "year"]
    last = [F.max(F.when(F.col(v).isNotNull(), F.struct(*order, F.col(v).alias("value")))).alias(v) for v in VALUES]
    return not_null(df, "stn_code", "year").groupBy("year", "stn_code").agg(*last)


def create_summaries(spark: SparkSession, path: str, folder: str, buckets: int = 64) -> None:
    """Empty summaries of a folder of Parquet files under ``year=`` folders, which must hold one file at least."""
    states = year_states(spark.read.parquet(folder)).withColumn("year", F.col("year").cast("int"))
    store.create_store(spark, f"{path}/states", states.schema, ["year"], buckets, unique=False)
    store.create_store(spark, f"{path}/files", T.StructType.fromDDL(FILES), ["year"], buckets)


def changed_years(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """(year, digest) of years whose files are new, other or gone (null digest); only the listing is read."""
    listed = scan_year_partitions(spark, folder, "*.parquet", fallback="")
    now = digest_per(listed, ["year"], ["path", "modificationTime", "length"]).select("year", "digest")
    known = store.read_store(spark, f"{path}/files").withColumnRenamed("digest", "_known")
    return now.join(known, "year", "full").filter(~F.col("digest").eqNullSafe(F.col("_known"))).select("year", "digest")


def rows_of_years(spark: SparkSession, folder: str, years: list[int]) -> DataFrame:
    """Rows of some years; the other years' folders are not read."""
    return spark.read.parquet(folder).filter(F.col("year").isin(years))


def refresh(spark: SparkSession, path: str, folder: str) -> list[int]:
    """Brings the states up to the folder and returns the years read or dropped, in order.

    At most one small row a year reaches the driver. Files that arrive during a refresh are seen by the next one.
    """
    found = {r["year"]: r["digest"] for r in changed_years(spark, path, folder).collect()}
    if found:
        there = sorted(y for y, digest in found.items() if digest)
        gone = spark.createDataFrame([(y,) for y in found], "year int")
        store.upsert(spark, f"{path}/states", year_states(rows_of_years(spark, folder, there)), gone)
        store.upsert(spark, f"{path}/files", spark.createDataFrame([(y, found[y]) for y in there], FILES), gone)
    return sorted(found)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return store.read_store(spark, f"{path}/states")


def latest_from(states: DataFrame) -> DataFrame:
    """Latest known values per station over all years."""
    def last(name: str):
        entry = F.struct("year", F.col(name).alias("state"))
        return F.max(F.when(F.col(name).isNotNull(), entry))["state"]["value"].alias(name)

    return states.groupBy("stn_code").agg(*[last(v) for v in VALUES])


def overview_from(states: DataFrame, year: int | None = None) -> DataFrame:
    """``stats.overview_stats`` of the rows the states were made from."""
    return stats.overview_of(latest_from(states if year is None else states.filter(F.col("year") == year)))


def trend_from(states: DataFrame) -> DataFrame:
    """``stats.yearly_trend`` of the rows the states were made from; years without a value are null."""
    return stats.trend_of(states.select("year", "stn_code", *[F.col(v)["value"].alias(v) for v in VALUES]))
