"""Yearly score series and forecasts for all stations in one job.

Yearly means are held in millionths as whole numbers and every sum over them is a whole number, so
the fitted lines do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.numbers import (
    date_to_text, fixed_point, round_mean, text_to_year, year_to_date,
)
from rivulet.operators.shaping import not_null

# Years are counted from here to keep the sums of squares small.
BASE_YEAR = 2000
UNIT = 1_000_000.0
# Half-width of an 80 % band of a normal distribution, in standard deviations.
BAND_80 = 1.28


def yearly_series(df: DataFrame, value: str = "pollution_score") -> DataFrame:
    """Mean per station and year in millionths (y), over known values."""
    y = F.round(F.sum(fixed_point(F.col(value))) / F.count(value)).cast("bigint")
    return (
        not_null(df, "stn_code", "year", value).groupBy("stn_code", "year")
        .agg(y.alias("y"))
    )


def series_prepare(df: DataFrame, value: str = "pollution_score", min_points: int = 3) -> DataFrame:
    """Series with enough yearly points: station, date and mean."""
    points = F.count("*").over(Window.partitionBy("stn_code"))
    return (
        yearly_series(df, value).withColumn("points", points)
        .filter(F.col("points") >= min_points)
        .select("stn_code", "year", year_to_date(F.col("year")).alias("ds"),
                (F.col("y") / UNIT).alias("y"), "points")
    )


def _line_sums(inside: Column | None = None) -> list[Column]:
    # Sums of squares in millionths outgrow 64 bits for ordinary values (a few thousand and more).
    x, y = F.col("year") - BASE_YEAR, F.col("y").cast("decimal(19,0)")

    def total(term: Column) -> Column:
        kept = term if inside is None else F.when(inside, term)
        return F.coalesce(F.sum(kept.cast("decimal(38,0)")), F.lit(0))

    return [
        total(F.lit(1)).alias("n"), total(x).alias("sx"), total(x * x).alias("sxx"),
        total(y).alias("sy"), total(x * y).alias("sxy"), total(y * y).alias("syy"),
    ]


def _with_line(sums: DataFrame) -> DataFrame:
    """Slope, intercept and residual deviation, all in millionths; NULL without two years."""
    n, sx, sxx, sy, sxy, syy = (F.col(c).cast("double") for c in
                                ("n", "sx", "sxx", "sy", "sxy", "syy"))
    spread = F.nullif(n * sxx - sx * sx, F.lit(0.0))
    cross = n * sxy - sx * sy
    left = ((n * syy - sy * sy) - cross * cross / spread) / n
    return sums.withColumns({
        "slope": cross / spread,
        "intercept": (sxx * sy - sx * sxy) / spread,
        # With two points the line is exact.
        "sigma": F.when(F.col("n") == 2, F.lit(0.0)).otherwise(
            F.sqrt(F.when(left < 0, F.lit(0.0)).otherwise(left) / n)),
    })


def station_lines(df: DataFrame, value: str = "pollution_score") -> DataFrame:
    """Least-squares line and last observation per station."""
    last = F.max(F.struct("year", "y"))
    return _with_line(yearly_series(df, value).groupBy("stn_code").agg(
        *_line_sums(), last["year"].alias("last_year"), last["y"].alias("last_y")
    ))


def _future(lines: DataFrame, horizon: int) -> DataFrame:
    if not 1 <= horizon <= 20:
        raise ValueError("horizon must be between 1 and 20")
    return lines.withColumn(
        "year", F.explode(F.sequence(F.col("last_year") + 1, F.col("last_year") + horizon))
    ).withColumn("ds", date_to_text(year_to_date(F.col("year"))))


def _line_at(year: Column) -> Column:
    return (F.col("intercept") + F.col("slope") * (year - BASE_YEAR)) / UNIT


COLUMNS = ["stn_code", "year", "ds", "yhat", "yhat_lower", "yhat_upper", "trend", "fallback"]


def forecast_fallback_last(lines: DataFrame, horizon: int = 5) -> DataFrame:
    """Last value repeated, with half of it as margin."""
    last = F.col("last_y") / UNIT
    return _future(lines, horizon).withColumns({
        "yhat": last, "yhat_lower": last - F.abs(last) * 0.5, "yhat_upper": last + F.abs(last) * 0.5,
        "trend": F.lit("Fallback (last_value)"), "fallback": F.lit(True),
    }).select(*COLUMNS)


def forecast_fallback_linear(lines: DataFrame, horizon: int = 5) -> DataFrame:
    """Straight line with two residual deviations as margin; last value where no line exists."""
    line = F.coalesce(_line_at(F.col("year")), F.col("last_y") / UNIT)
    margin = F.coalesce(F.col("sigma"), F.lit(0.0)) * 2.0 / UNIT
    return _future(lines, horizon).withColumns({
        "yhat": line, "yhat_lower": line - margin, "yhat_upper": line + margin,
        "trend": F.lit("Fallback (linear)"), "fallback": F.lit(True),
    }).select(*COLUMNS)


def forecast_trend(lines: DataFrame, horizon: int = 5, min_points: int = 3) -> DataFrame:
    """Straight line within 0..100, an 80 % band and a label for its end.

    Stations with fewer yearly points are left to the fallbacks.
    """
    def clipped(value: Column) -> Column:
        return F.when(value < 0, 0.0).when(value > 100, 100.0).otherwise(value)

    line = _line_at(F.col("year"))
    end = clipped(_line_at(F.col("last_year") + horizon))
    last = F.col("last_y") / UNIT
    margin = F.col("sigma") * BAND_80 / UNIT
    label = F.when(end > last, "Worsening").when(end < last, "Improving").otherwise("Stable")
    return _future(lines.filter(F.col("n") >= min_points), horizon).withColumns({
        "yhat": clipped(line), "yhat_lower": line - margin, "yhat_upper": line + margin,
        "trend": label, "fallback": F.lit(False),
    }).select(*COLUMNS)


def forecast_router(df: DataFrame, horizon: int = 5, value: str = "pollution_score") -> DataFrame:
    """Forecast of every station by its number of distinct years: 1, 2, or 3 and more.

    The three forms share one pass: each line is turned into all its candidate values and the
    one that fits its number of years is kept.
    """
    lines = station_lines(df, value)
    future = _future(lines, horizon)
    last = F.col("last_y") / UNIT
    line = _line_at(F.col("year"))
    end = _line_at(F.col("last_year") + horizon)

    def clipped(v: Column) -> Column:
        return F.when(v < 0, 0.0).when(v > 100, 100.0).otherwise(v)

    one, two = F.col("n") == 1, F.col("n") == 2
    margin = F.when(one, F.abs(last) * 0.5).when(two, F.col("sigma") * 2.0 / UNIT).otherwise(
        F.col("sigma") * BAND_80 / UNIT)
    centre = F.when(one, last).otherwise(line)
    return future.withColumns({
        "yhat": F.when(one, last).when(two, line).otherwise(clipped(line)),
        "yhat_lower": centre - margin, "yhat_upper": centre + margin,
        "trend": F.when(one, "Fallback (last_value)").when(two, "Fallback (linear)")
        .when(clipped(end) > last, "Worsening").when(clipped(end) < last, "Improving")
        .otherwise("Stable"),
        "fallback": one | two,
    }).select(*COLUMNS)


def display(forecast: DataFrame, digits: int = 2) -> DataFrame:
    """Forecast values rounded for display."""
    return forecast.withColumns({
        c: F.round(c, digits) for c in ("yhat", "yhat_lower", "yhat_upper")
    })


def forecast_backtest(df: DataFrame, cut: int, value: str = "pollution_score") -> DataFrame:
    """Line fitted up to the cut year against the year after it, for every station that has it.

    A station needs four years in all, three of them up to the cut.
    """
    test_year = cut + 1
    sums = yearly_series(df, value).groupBy("stn_code").agg(
        *_line_sums(F.col("year") <= cut), F.count("*").alias("years"),
        F.max(F.when(F.col("year") == test_year, F.col("y"))).alias("actual_y"),
    ).filter(F.col("actual_y").isNotNull() & (F.col("years") >= 4) & (F.col("n") >= 3))
    actual, predicted = F.col("actual_y") / UNIT, _line_at(F.lit(test_year))
    error = F.abs(F.col("predicted") - F.col("actual"))
    return _with_line(sums).select(
        "stn_code", actual.alias("actual"), predicted.alias("predicted")
    ).withColumns({
        "mae": error, "rmse": F.sqrt(error * error),
        "mape": F.try_divide(error, F.abs("actual")) * 100.0,
    })


def backtest_means(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("stations"), round_mean(F.avg("mae"), 4).alias("mae"),
        round_mean(F.avg("rmse"), 4).alias("rmse"), round_mean(F.avg("mape"), 4).alias("mape"),
    )


def top_forecast_errors(metrics: DataFrame, k: int = 10) -> DataFrame:
    return metrics.orderBy(F.desc("mae"), "stn_code").limit(k)


def with_station_names(result: DataFrame, names: DataFrame) -> DataFrame:
    """Adds station_name to a result per station; ``names`` has one row per stn_code.

    Names join the finished result, so they never travel with the samples.
    """
    return result.join(names.select("stn_code", "station_name"), "stn_code", "left")


def history_forecast_merge(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """Observed and predicted years of each station under each other, sorted by station and year."""
    past = history.select("stn_code", "year", F.col("avg_score").alias("historical"))
    coming = forecast.select(
        "stn_code", text_to_year(F.col("ds")).alias("year"), F.col("yhat").alias("predicted"),
        F.col("yhat_lower").alias("lower"), F.col("yhat_upper").alias("upper"),
    )
    return past.unionByName(coming, allowMissingColumns=True).orderBy("stn_code", "year")
