"""Summaries by station, year, parameter and water body."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.functions.numbers import round_mean
from rivulet.functions.scoring import change_direction, class_a_conditions, risk_bucket
from rivulet.functions.text import split_list, strip
from rivulet.operators.latest import last_per_station_year, latest_per_station
from rivulet.operators.shaping import filter_samples, filter_type_ci, not_null

LABEL_COLUMNS = ["year", "pollution_score", "safety_label"]


def share(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Percentage of a whole, 0 when the whole is empty."""
    rate = F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))
    return rate if digits is None else F.round(rate, digits)


def label_counts() -> list[Column]:
    return [
        F.count_if(F.col("safety_label") == "Safe").alias("safe_count"),
        F.count_if(F.col("safety_label") == "Unsafe").alias("unsafe_count"),
    ]


def overview_stats(df: DataFrame, year: int | None = None) -> DataFrame:
    """Stations, label counts and mean score over the latest state of each station."""
    return overview_of(latest_per_station(filter_samples(df, year), columns=LABEL_COLUMNS))


def overview_of(latest: DataFrame) -> DataFrame:
    """The overview from one row per station with its latest label and score."""
    return latest.agg(
        F.count("*").alias("total_stations"), *label_counts(),
        round_mean(F.avg("pollution_score"), 2).alias("avg_pollution_score"),
    ).withColumns({
        "safe_percentage": share(F.col("safe_count"), F.col("total_stations"), 1),
        "unsafe_percentage": F.round(
            100 - share(F.col("safe_count"), F.col("total_stations"), 1), 1),
    })


def yearly_trend(df: DataFrame) -> DataFrame:
    """Per year the mean score and label counts of each station's last state in that year."""
    return trend_of(last_per_station_year(df, columns=["pollution_score", "safety_label"]))


def trend_of(states: DataFrame) -> DataFrame:
    """The trend from one row per station and year with its last label and score."""
    return states.groupBy("year").agg(
        round_mean(F.avg("pollution_score"), 4).alias("avg_score"), *label_counts()
    )


def extreme_stations(df: DataFrame) -> DataFrame:
    """Most polluted and cleanest station by latest score; ties go to the lower code."""
    latest = not_null(latest_per_station(
        df, columns=["year", "monitoring_location", "pollution_score"]), "pollution_score")
    info = F.struct(strip("monitoring_location").alias("name"),
                    F.round("pollution_score", 4).alias("score"), "year", "stn_code")
    worst = F.min_by(info, F.struct((-F.col("pollution_score")).alias("s"), "stn_code"))
    best = F.min_by(info, F.struct(F.col("pollution_score").alias("s"), "stn_code"))
    both = latest.agg(worst.alias("worst"), best.alias("best"))
    return both.select(F.inline(F.array(
        F.struct(F.lit("most_polluted").alias("kind"), "worst.*"),
        F.struct(F.lit("cleanest").alias("kind"), "best.*"),
    )))


def violation_frequency(df: DataFrame) -> DataFrame:
    return df.select(F.explode(split_list(F.col("violated_params"))).alias("violation")).groupBy(
        "violation").agg(F.count("*").alias("frequency"))


def most_common_violation(df: DataFrame) -> DataFrame:
    """Most frequent violation among the latest states; ties go to the first name."""
    latest = latest_per_station(df, columns=["year", "violated_params"])
    return violation_frequency(latest).orderBy(F.desc("frequency"), "violation").limit(1)


def parameter_stats(
    df: DataFrame, year: int | None = None, water_body_type: str | None = None
) -> DataFrame:
    """Mean, range and share beyond the display limit per parameter, all in one pass."""
    rows = filter_type_ci(filter_samples(df, year), water_body_type)
    aggregates, entries = [], []
    for column, label, unit, limit, source in R.DISPLAY_PARAMETERS:
        value = F.col(column)
        if limit is None:
            beyond = F.lit(False)
        else:
            beyond = value < limit if column == "do_avg" else value > limit
        aggregates += [
            F.avg(value).alias(f"avg_{column}"), F.min(value).alias(f"min_{column}"),
            F.max(value).alias(f"max_{column}"), F.count(value).alias(f"n_{column}"),
            F.count_if(beyond).alias(f"beyond_{column}"),
        ]
        entries.append(F.struct(
            F.lit(column).alias("parameter"), F.lit(label).alias("label"),
            round_mean(F.col(f"avg_{column}"), 4).alias("avg_value"),
            F.round(f"min_{column}", 4).alias("min_value"),
            F.round(f"max_{column}", 4).alias("max_value"),
            F.col(f"beyond_{column}").alias("violation_count"),
            share(F.col(f"beyond_{column}"), F.col(f"n_{column}"), 1).alias("violation_percentage"),
            F.lit(unit).alias("unit"), F.lit(limit).cast("double").alias("limit_value"),
            F.lit(source).alias("limit_source"),
        ))
    return rows.agg(*aggregates).select(F.inline(F.array(*entries)))


def violation_rates(df: DataFrame) -> DataFrame:
    """Class-A violation rate per parameter over its known values, with a risk bucket."""
    columns = {"pH": "ph_avg", "DO": "do_avg", "BOD": "bod_avg", "Nitrate": "nitrate_avg",
               "Fecal Coliform": "fecal_coliform_avg"}
    aggregates, entries = [], []
    for name, condition in class_a_conditions():
        c = columns[name]
        aggregates += [F.count_if(condition).alias(f"v_{c}"), F.count(c).alias(f"n_{c}")]
        rate = share(F.col(f"v_{c}"), F.col(f"n_{c}"))
        entries.append(F.struct(
            F.lit(name).alias("parameter"), rate.alias("rate"), risk_bucket(rate).alias("bucket"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def yearly_avg_score(df: DataFrame) -> DataFrame:
    """Mean score per year."""
    return df.groupBy("year").agg(F.avg("pollution_score").alias("avg_score"))


def param_means(df: DataFrame, parameters: Sequence[str] = S.RIVER_PARAMETERS) -> DataFrame:
    """Mean of every parameter over all rows, one row per parameter."""
    known = [p for p in parameters if p in df.columns]
    means = df.agg(*[F.avg(p).alias(p) for p in known])
    return means.unpivot([], known, "parameter", "mean_value")


def station_year_means(
    df: DataFrame, columns: Sequence[str] = R.TREND_PARAMETERS
) -> DataFrame:
    """Mean of each column per station and year."""
    return not_null(df, "stn_code", "year").groupBy("stn_code", "year").agg(
        *[F.avg(c).alias(c) for c in columns]
    )


def station_trends(
    df: DataFrame, year: int | None = None, columns: Sequence[str] = R.TREND_PARAMETERS
) -> DataFrame:
    """Yearly means of each station at 3 decimals, for display; of one year where it is given.

    The summary beside them (``trend_summary``) always covers all years.
    """
    chosen = df if year is None else df.filter(F.col("year") == year)
    means = station_year_means(chosen, columns)
    return means.withColumns({c: round_mean(F.col(c), 3) for c in columns})


def trend_summary(df: DataFrame, columns: Sequence[str] = R.TREND_PARAMETERS) -> DataFrame:
    """Per station and parameter: range, latest yearly mean and direction since the first year.

    First and latest are the means of the first and last year even where they are missing.
    """
    yearly = station_year_means(df, columns)
    ends = []
    for c in columns:
        entry = F.struct("year", F.col(c).alias("v"))
        ends += [
            round_mean(F.min(c), 3).alias(f"min_{c}"), round_mean(F.max(c), 3).alias(f"max_{c}"),
            round_mean(F.min(entry)["v"], 3).alias(f"first_{c}"),
            round_mean(F.max(entry)["v"], 3).alias(f"last_{c}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("parameter"), F.col(f"min_{c}").alias("min_value"),
            F.col(f"max_{c}").alias("max_value"), F.col(f"last_{c}").alias("latest"),
            change_direction(F.col(f"first_{c}"), F.col(f"last_{c}"), c == "do_avg",
                             "Improving", "Worsening", "Stable").alias("trend"),
        )
        for c in columns
    ]
    return yearly.groupBy("stn_code").agg(*ends).select("stn_code", F.inline(F.array(*entries)))


def safety_by_year_pivot(df: DataFrame) -> DataFrame:
    """Rows labelled Safe and Unsafe per year; both columns always exist."""
    return df.groupBy("year").agg(
        F.count_if(F.col("safety_label") == "Safe").alias("Safe"),
        F.count_if(F.col("safety_label") == "Unsafe").alias("Unsafe"),
    )


def type_safety_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("water_body_type", "safety_label").agg(F.count("*").alias("n"))


def unsafe_combos(df: DataFrame) -> DataFrame:
    """Distinct (violations, water body) of unsafe samples."""
    keys = ["violated_params", "water_body_type"]
    unsafe = df.filter(F.col("safety_label") == "Unsafe")
    return not_null(unsafe, *keys).select(*keys).distinct()


def counts_with_total(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key and, with a NULL key, in total."""
    return not_null(df, key).rollup(key).agg(F.count("*").alias(name))


def extraction_report(df: DataFrame) -> DataFrame:
    return counts_with_total(df, "state")


def manifest_counts(manifest: DataFrame, state: str) -> DataFrame:
    return counts_with_total(manifest, state, "unique_locations")


def geocode_report(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"), F.count_if(F.col("geocoded")).alias("success")
    ).withColumns({
        "failed": F.col("total") - F.col("success"),
        "success_percentage": share(F.col("success"), F.col("total"), 1),
    })


def batch_summary(df: DataFrame) -> DataFrame:
    """Totals of a scored batch: rows, labels and rows with a position."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return df.agg(F.count("*").alias("total_rows"), *label_counts(),
                  F.count_if(located).alias("geocoded_count"))


def location_year_avg(df: DataFrame, keys: Sequence[str] = ("year",), digits: int = 1) -> DataFrame:
    """Mean score of rows with a position."""
    located = not_null(df, "latitude", "longitude")
    return located.groupBy(*keys).agg(round_mean(F.avg("pollution_score"), digits).alias("avg_score"))


def yoy_delta(yearly: DataFrame) -> DataFrame:
    """Change of the yearly mean to the year before, with an alert when it rose.

    The input has one row per year, so the unpartitioned window sees a handful of rows.
    """
    before = F.lag("avg_score").over(Window.orderBy("year"))
    return yearly.withColumn("delta", F.round(F.col("avg_score") - before, 1)).withColumn(
        "alert", F.coalesce(F.col("delta") > 0, F.lit(False))
    )


def since_first_delta(yearly: DataFrame) -> DataFrame:
    """Change of the yearly mean since the first year."""
    entry = F.struct("year", F.col("avg_score").alias("v"))
    ends = yearly.agg(F.min(entry).alias("first"), F.max(entry).alias("last"))
    delta = F.round(F.col("last.v") - F.col("first.v"), 1)
    return ends.select(
        F.col("first.year").alias("first_year"), F.col("last.year").alias("last_year"),
        delta.alias("delta"), F.when(delta <= 0, "improving").otherwise("drifting").alias("trend"),
    )


def map_bounds(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.agg(
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
    )


def forecast_stats(forecast: DataFrame) -> DataFrame:
    """Range and number of forecast points per station."""
    return forecast.groupBy("stn_code").agg(
        F.round(F.min("yhat"), 2).alias("min_value"), F.round(F.max("yhat"), 2).alias("max_value"),
        F.count("*").alias("points"),
    )


def top_polluted(df: DataFrame, k: int = 10, ties: Sequence[str] = ("stn_code",)) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("pollution_score"), *ties).limit(k)


def cleanest(df: DataFrame, k: int = 10, ties: Sequence[str] = ("stn_code",)) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("pollution_score"), *ties).limit(k)


def limit_results(df: DataFrame, order: Sequence[str], limit: int = R.API_ROW_LIMIT) -> DataFrame:
    """First page of a result after an explicit sort."""
    return df.orderBy(*order).limit(limit)
