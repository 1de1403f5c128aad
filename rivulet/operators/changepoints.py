"""Yearly trends that may break: the best division of every station's series into straight lines.

All divisions are searched at once by dynamic programming over prefix sums, inside one row per
station, so a station costs the square of its years whatever its number of samples. Sums are whole numbers
and costs are whole numbers of a millionth of a squared score, so ties are real ties: fewer
segments win, then the earlier break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.forecast import (
    BAND_80, BASE_YEAR, COLUMNS, UNIT, _future, _line_at, _with_line, yearly_series,
)
from rivulet.operators.shaping import bind

# A segment of two years always fits, so it says nothing.
LEAST_POINTS = 3
# A break adds two coefficients and a place; each costs ln(years) residual variances (Bayesian criterion).
PENALTY = 3.0
SUMS = ("n", "sx", "sxx", "sy", "sxy", "syy")


def _kind(name: str) -> str:
    return "bigint" if name in ("n", "sx", "sxx") else "decimal(38,0)"


def _prefix_sums(series: DataFrame, *carried: str) -> DataFrame:
    """One row per station: its points by year and the sums before each of them and after the last."""
    so_far = Window.partitionBy("stn_code").orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    x, y = (F.col("year") - BASE_YEAR).cast("bigint"), F.col("y").cast("decimal(19,0)")
    terms = {"n": F.lit(1).cast("bigint"), "sx": x, "sxx": x * x, "sy": y, "sxy": x * y, "syy": y * y}
    running = series.select("stn_code", "year", "y", *carried, *(
        F.sum(term.cast(_kind(name))).over(so_far).cast(_kind(name)).alias(name) for name, term in terms.items()))
    point = F.struct("year", "y", F.struct(*SUMS).alias("sums"))
    zero = F.struct(*(F.lit(0).cast(_kind(name)).alias(name) for name in SUMS))
    return running.groupBy("stn_code").agg(
        F.array_sort(F.collect_list(point)).alias("points"), *(F.max(c).alias(c) for c in carried),
    ).select(
        "stn_code", *carried, "points", F.size("points").alias("years"),
        F.concat(F.array(zero), F.transform("points", lambda p: p["sums"])).alias("before"))


def _between(before: Column, start: Column, end: Column) -> dict[str, Column]:
    """Sums of the points from ``start`` to before ``end``."""
    return {name: before[end][name] - before[start][name] for name in SUMS}


def _cost(sums: dict[str, Column]) -> Column:
    """Squared residuals of the least-squares line in millionths of a squared score."""
    n, sx, sxx, sy, sxy, syy = (sums[name].cast("double") for name in SUMS)
    spread, cross = n * sxx - sx * sx, n * sxy - sx * sy
    left = ((n * syy - sy * sy) - cross * cross / spread) / n
    return F.round(F.greatest(left, F.lit(0.0)) / UNIT)


def changepoint_segments(df: DataFrame, value: str = "pollution_score", penalty: float = PENALTY,
                         least_points: int = LEAST_POINTS) -> DataFrame:
    """Best division of each station's yearly series, one row per station.

    The sum of squared residuals plus ``penalty * ln(years)`` residual variances of the single line
    for each break is least over all divisions into segments of ``least_points`` years or more. Columns: years, segments (array
    of the sums, first and last year of each), error (squared residuals left),
    whole (the sums of all years). Stations with fewer years than
    a segment needs, and unknown values, are left out.
    """
    return _segments(yearly_series(df, value), penalty, least_points)


def _segments(series: DataFrame, penalty: float, least_points: int, *carried: str) -> DataFrame:
    if least_points < 3:
        raise ValueError("a segment needs three years or more")
    if not penalty >= 0:
        raise ValueError("the penalty must not be negative")
    stations = _prefix_sums(series, *carried).filter(F.col("years") >= least_points)
    before, years = F.col("before"), F.col("years")
    whole = bind(stations, one_line=_cost(_between(before, F.lit(0), years)))
    priced = bind(whole, price=F.round(
        F.lit(float(penalty)) * F.ln(years.cast("double")) * F.col("one_line") / (years - 2)))

    def division(cost: Column, segments: Column, starts: Column) -> Column:
        return F.struct(cost.cast("double").alias("cost"), segments.cast("int").alias("segments"),
                        starts.cast("array<int>").alias("starts"))

    impossible = division(F.lit(float("inf")), F.lit(0), F.array())

    def step(best: Column, end: Column) -> Column:
        def last_from(start: Column) -> Column:
            earlier, fee = best[start], F.when(start > 0, F.col("price")).otherwise(0.0)
            return division(earlier["cost"] + _cost(_between(before, start, end)) + fee,
                            earlier["segments"] + 1, F.concat(earlier["starts"], F.array(start)))

        found = F.array_min(F.transform(F.sequence(F.lit(0), end - least_points), last_from))
        return F.concat(best, F.array(F.when(end >= least_points, found).otherwise(impossible)))

    first = F.array(division(F.lit(0.0), F.lit(0), F.array()))
    best = F.aggregate(F.sequence(F.lit(1), years), first, step, lambda a: F.element_at(a, -1))
    solved = bind(priced, best=best)
    starts, points = F.col("best")["starts"], F.col("points")

    def segment(start: Column, k: Column) -> Column:
        end = F.when(k + 1 < F.size(starts), F.get(starts, k + 1)).otherwise(years)
        sums = _between(before, start, end)
        return F.struct(points[start]["year"].alias("first_year"), points[end - 1]["year"].alias("last_year"),
                        *(sums[name].alias(name) for name in SUMS))

    breaks = F.col("best")["segments"] - 1
    return solved.select("stn_code", *carried, "years", F.transform(starts, segment).alias("segments"),
                         (F.col("best")["cost"] - F.col("price") * breaks).alias("error"),
                         points[years - 1]["y"].alias("last_y"),
                         before[years].alias("whole"))


def segment_lines(segments: DataFrame) -> DataFrame:
    """One row per segment with its line: number from 1, first and last year, points, slope a year and the level at its first year."""
    each = segments.select("stn_code", F.posexplode("segments").alias("k", "s")).select("stn_code", "k", "s.*")
    return _with_line(each).select(
        "stn_code", (F.col("k") + 1).alias("segment"), "first_year", "last_year", F.col("n").alias("points"),
        (F.col("slope") / UNIT).alias("slope"), _line_at(F.col("first_year")).alias("level"))


def _last_lines(segments: DataFrame, *carried: str) -> DataFrame:
    kept = ["stn_code", "years", "error", "last_y", *carried]
    last = segments.select(*kept, F.size("segments").alias("lines"), F.element_at("segments", -1).alias("s"))
    return _with_line(last.select(*kept, "lines", "s.*"))


def _margin(year: Column) -> Column:
    """Half an 80 % band of a new value: past residuals of all segments, wider away from the last one's years."""
    n, sx, sxx = (F.col(c).cast("double") for c in ("n", "sx", "sxx"))
    away = n * (year - BASE_YEAR) - sx
    noise = F.sqrt(F.col("error") / F.greatest(F.col("years") - 2 * F.col("lines"), F.lit(1))) / 1000.0
    return noise * BAND_80 * F.sqrt(1.0 + 1.0 / n + away * away / (n * (n * sxx - sx * sx)))


def forecast_changepoints(segments: DataFrame, horizon: int = 5) -> DataFrame:
    """The last segment's line carried on, within 0..100, with an 80 % band and a label for its end."""
    def clipped(value: Column) -> Column:
        return F.when(value < 0, 0.0).when(value > 100, 100.0).otherwise(value)

    line, margin = _line_at(F.col("year")), _margin(F.col("year"))
    end, last = clipped(_line_at(F.col("last_year") + horizon)), F.col("last_y") / UNIT
    label = F.when(end > last, "Worsening").when(end < last, "Improving").otherwise("Stable")
    return _future(_last_lines(segments), horizon).withColumns({
        "yhat": clipped(line), "yhat_lower": line - margin, "yhat_upper": line + margin,
        "trend": label, "fallback": F.lit(False),
    }).select(*COLUMNS)


def changepoint_backtest(df: DataFrame, cut: int, value: str = "pollution_score", penalty: float = PENALTY,
                         least_points: int = LEAST_POINTS) -> DataFrame:
    """Broken trend and single line, both fitted up to the cut year, against the year after it.

    Every station with that year and enough years up to the cut: actual, both predictions and both errors.
    """
    after = F.max(F.when(F.col("year") == cut + 1, F.col("y"))).over(Window.partitionBy("stn_code"))
    known = yearly_series(df, value).withColumn("after", after).filter((F.col("year") <= cut) & F.col("after").isNotNull())
    at, actual = F.lit(cut + 1), F.col("after") / UNIT
    broken = _last_lines(_segments(known, penalty, least_points, "after"), "after", "whole").select(
        "stn_code", actual.alias("actual"), (F.col("lines") - 1).alias("breaks"), _line_at(at).alias("broken"), "whole.*")
    return _with_line(broken).withColumn("line", _line_at(at)).select(
        "stn_code", "actual", "breaks", "broken", "line", F.abs(F.col("broken") - F.col("actual")).alias("broken_error"),
        F.abs(F.col("line") - F.col("actual")).alias("line_error"))
