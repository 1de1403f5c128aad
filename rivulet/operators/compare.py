"""Station and year comparisons for many requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.scoring import change_direction, limit_status
from rivulet.operators.latest import latest_row, latest_row_or_year

PARAMETERS = [p for p, *_ in R.COMPARE_PARAMETERS]
# What a side tells about its station besides the parameters.
CONTEXT = ["monitoring_location", "water_body_type", "safety_label", "pollution_score"]


def _rounded(side: str, parameter: str) -> Column:
    return F.round(F.col(f"{side}.{parameter}"), 3)


def _told(side: str, column: str) -> Column:
    if column == "pollution_score":
        return _rounded(side, column)
    return F.nullif(F.trim(f"{side}.{column}"), F.lit(""))


def _entries(with_change: bool) -> Column:
    entries = []
    for parameter, label, unit, limit in R.COMPARE_PARAMETERS:
        a, b = _rounded("a", parameter), _rounded("b", parameter)
        fields = [
            F.lit(parameter).alias("parameter"), F.lit(label).alias("label"),
            F.lit(unit).alias("unit"), a.alias("a_value"), b.alias("b_value"),
            F.lit(limit).cast("double").alias("limit_value"),
            limit_status(parameter, a, limit).alias("a_status"),
            limit_status(parameter, b, limit).alias("b_status"),
        ]
        if with_change:
            fields.append(change_direction(
                a, b, parameter == "do_avg", "Improved", "Worsened", "N/A").alias("change"))
        entries.append(F.struct(*fields))
    return F.inline(F.array(*entries))


def compare_stations(df: DataFrame, pairs: DataFrame, year: int | None = None) -> DataFrame:
    """Latest rows of station pairs side by side, one row per pair and parameter.

    ``pairs`` has station_a and station_b. With a year, its row is taken where the station has
    one. The winner has the lower score; a tie goes to A. A pair with an unknown station keeps its
    rows: that side is NULL (year_a or year_b tells which) and there is no winner.
    """
    narrow = df.select(*[c for c in df.columns if c in (
        "stn_code", "sampled_at", "k1", "k2", "k3", "year", *PARAMETERS, *CONTEXT)])
    rows = latest_row(narrow) if year is None else latest_row_or_year(narrow, year)
    told = [c for c in CONTEXT if c in rows.columns]
    state = rows.select(
        "stn_code", F.struct("year", *PARAMETERS, *[c for c in told if c not in PARAMETERS]).alias("row"))
    sides = pairs.select("station_a", "station_b").distinct()
    for side in ("a", "b"):
        sides = sides.join(
            state.select(F.col("stn_code").alias(f"station_{side}"), F.col("row").alias(side)),
            f"station_{side}", "left",
        )
    a, b = _rounded("a", "pollution_score"), _rounded("b", "pollution_score")
    b_wins = b.isNotNull() & (a.isNull() | (b < a))
    return sides.select(
        "station_a", "station_b", F.col("a.year").alias("year_a"), F.col("b.year").alias("year_b"),
        F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(None))
        .when(b_wins, F.col("station_b")).otherwise(F.col("station_a")).alias("winner"),
        *[_told(side, c).alias(f"{side}_{c}") for side in ("a", "b") for c in told],
        _entries(with_change=False),
    )


def compare_years(df: DataFrame, requests: DataFrame) -> DataFrame:
    """One station in two years, one row per request and parameter.

    ``requests`` has stn_code, year_a and year_b. A year the station lacks is replaced by its
    latest one. Each station's rows, one per year, travel as one map, so a single join does.
    """
    narrow = df.select(*[c for c in df.columns if c in (
        "stn_code", "sampled_at", "k1", "k2", "k3", "year", *PARAMETERS)])
    yearly = latest_row(narrow, ["stn_code", "year"]).select(
        "stn_code", F.struct("year", F.struct(*PARAMETERS).alias("row")).alias("entry")
    )
    by_year = yearly.groupBy("stn_code").agg(
        F.map_from_entries(F.collect_list("entry")).alias("years"),
        F.max("entry.year").alias("last_year"),
    )

    def row_of(year: str) -> Column:
        return F.coalesce(F.try_element_at("years", F.col(year)),
                          F.try_element_at("years", F.col("last_year")))

    joined = requests.select("stn_code", "year_a", "year_b").distinct().join(by_year, "stn_code")
    return joined.withColumns({"a": row_of("year_a"), "b": row_of("year_b")}).select(
        "stn_code", "year_a", "year_b", _entries(with_change=True)
    )
