"""Latest state per station and other per-key picks.

All picks are aggregations of max/min over structs: each task reduces its rows to one per key
before the shuffle, so a station holding a large share of the rows is no burden to one task. A maximum
over structs sorts each task's rows; ``gathered`` keeps these tasks small and brings a key's rows together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.operators.shaping import drop_missing_coords, filter_samples, not_null
from rivulet.functions.text import strip


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with known keys, those of a key mostly in one task and tasks of about equal size.

    Large file splits make a pick sort more rows than a task's memory holds, and meet each key in many
    tasks. After this exchange of the plain rows the sorts are small and one row per key is left of most
    tasks. Rows of a hot key are split over several tasks; the hash, unlike the key itself, leaves the
    exchange of the picks in the plan that puts those together. Not needed on bucketed tables.
    """
    return not_null(df, *keys).withColumn("_place", F.hash(*keys)).hint("rebalance", "_place").drop("_place")


def last_known(column: str, order: Sequence[str]) -> Column:
    """Latest non-missing value of a column; equal orders are settled by the value itself."""
    entry = F.struct(*order, F.col(column).alias("value"))
    return F.max(F.when(F.col(column).isNotNull(), entry))["value"].alias(column)


def latest_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = S.SAMPLE_ORDER,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per key the last non-missing value of every column; rows without a key are dropped."""
    order = [c for c in order if c in df.columns and c not in keys]
    wanted = [c for c in (columns or df.columns) if c not in keys]
    return (
        not_null(df, *keys).groupBy(*keys)
        .agg(*[last_known(c, order) for c in wanted])
    )


def latest_per_station(
    df: DataFrame, order: Sequence[str] = S.SAMPLE_ORDER, columns: Sequence[str] | None = None
) -> DataFrame:
    return latest_known(df.filter(F.col("year").isNotNull()), ["stn_code"], order, columns)


def last_per_station_year(
    df: DataFrame, order: Sequence[str] = S.SAMPLE_ORDER, columns: Sequence[str] | None = None
) -> DataFrame:
    return latest_known(df, ["year", "stn_code"], order, columns)


def latest_row(
    df: DataFrame, keys: Sequence[str] = ("stn_code",), order: Sequence[str] = S.SAMPLE_ORDER
) -> DataFrame:
    """Whole latest row per key, missing values included."""
    order = [c for c in order if c in df.columns and c not in keys]
    others = [c for c in df.columns if c not in keys and c not in order]
    row = F.max(F.struct(*order, *others)).alias("row")
    picked = not_null(df, *keys, "year").groupBy(*keys).agg(row)
    return picked.select(*keys, "row.*").select(*df.columns)


def latest_row_or_year(
    df: DataFrame, year: int, order: Sequence[str] = S.SAMPLE_ORDER
) -> DataFrame:
    """Latest row of the given year per station, of all years where that year is absent."""
    preferred = df.withColumn("_wanted", F.col("year") == year)
    return latest_row(preferred, ["stn_code"], ["_wanted", *order]).drop("_wanted")


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Columns of the first row per key."""
    row = F.min(F.struct(*order, *columns)).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"row.{c}") for c in columns])


def available_years(df: DataFrame) -> DataFrame:
    """Sorted distinct years per station."""
    years = F.array_sort(F.collect_set("year")).alias("available_years")
    return not_null(df, "stn_code", "year").groupBy("stn_code").agg(years)


def locations_feed(
    df: DataFrame, year: int | None = None, water_body_type: str | None = None,
    safety_label: str | None = None, order: Sequence[str] = S.SAMPLE_ORDER,
    limit: int | None = None,
) -> DataFrame:
    """Stations for a map: latest state, or the rows of one year, with the years available.

    One aggregation yields the latest state and the years together. All located stations are
    returned unless a page size is given, which then cuts after a fixed sort.
    """
    base = filter_samples(df, None, water_body_type, safety_label)
    shown = ["monitoring_location", "latitude", "longitude", "water_body_type",
             "pollution_score", "safety_label"]
    order = [c for c in order if c in df.columns]
    if year is None:
        years = F.array_sort(F.collect_set("year")).alias("available_years")
        feed = not_null(base, "stn_code", "year").groupBy("stn_code").agg(
            *[last_known(c, order) for c in shown], F.max("year").alias("year"), years
        )
    else:
        feed = filter_samples(base, year).join(available_years(base), "stn_code")
    feed = drop_missing_coords(feed)
    ties = [c for c in order if c in feed.columns and c != "year"]
    if limit is not None:
        feed = feed.orderBy("stn_code", *ties).limit(limit)
    return feed.select(
        F.col("stn_code").alias("id"), F.col("monitoring_location").alias("location"),
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "year",
        "water_body_type", "pollution_score", "safety_label", "available_years",
    )


def chat_history_window(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", last: int = 4, length: int = 500
) -> DataFrame:
    """The last messages per conversation, then those by user or assistant that have text.

    Spark limits each task to the last messages before the shuffle (window group limit).
    """
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (
        turns.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= last).drop("_n")
        .filter(F.col("role").isin("user", "assistant") & (F.coalesce("text", F.lit("")) != ""))
        .withColumn("text", F.substring("text", 1, length))
    )


def manifest_first_seen(df: DataFrame, state: str, order: Sequence[str]) -> DataFrame:
    """Unique locations per state by lower-case name, as first written."""
    place = strip(F.col("monitoring_location").cast("string"))
    named = df.withColumn("monitoring_location", place).filter(
        place.isNotNull() & ~F.lower(place).isin("", "nan", "none")
    ).withColumn("_key", F.lower(place))
    return first_row(named, [state, "_key"], order, ["monitoring_location", "stn_code"]).drop("_key")


def dedupe_locations(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per id: the place in the list of the first, the values of the last."""
    others = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(
        F.min(F.struct(*order)).alias("position"), F.max(F.struct(*order, *others)).alias("row")
    ).select(key, "position", *[F.col(f"row.{c}") for c in others])


def pinned_semi(df: DataFrame, pins: DataFrame, key: str = "stn_code") -> DataFrame:
    """Rows of tracked stations; a station tracked twice counts once."""
    return df.join(pins.select(key).dropDuplicates([key]), key, "left_semi")
