"""Queries over yearly series and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import changepoints, evaluate, forecast, score, stats
from rivulet.plans import ctes as Q
from rivulet.plans.q_stats import histogram_sql
from rivulet.plans.registry import query
from rivulet.sources.tables import samples, table


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_10(samples(spark, sf_dir, names=False, states=False))


def customer_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second domain with short series: order values per customer and year."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("stn_code"), F.year("o_orderdate").alias("year"),
        (F.col("o_totalprice") / 50000).alias("pollution_score"))


_CUSTOMER_SERIES = """series AS (SELECT stn_code, year, CAST(round(CAST(sum(CAST(round(s * 1000000) AS BIGINT)) AS DOUBLE) / count(s)) AS BIGINT) AS y
FROM (SELECT CAST(o_custkey AS VARCHAR) AS stn_code, CAST(year(o_orderdate) AS INT) AS year, o_totalprice / 50000 AS s FROM orders) GROUP BY 1, 2)"""

_H = 5
_FUTURE = f"future AS (SELECT *, CAST(last_year + h AS INT) AS year FROM lines, (SELECT unnest(range(1, {_H + 1})) AS h))"
_LINE = "(intercept + slope * (year - 2000)) / 1000000.0::DOUBLE"
_END = f"(intercept + slope * (last_year + {_H} - 2000)) / 1000000.0::DOUBLE"
_LAST = "(last_y / 1000000.0::DOUBLE)"


def _clip(value: str) -> str:
    return f"greatest(least({value}, 100.0::DOUBLE), 0.0::DOUBLE)"


def _label() -> str:
    return f"CASE WHEN {_clip(_END)} > {_LAST} THEN 'Worsening' WHEN {_clip(_END)} < {_LAST} THEN 'Improving' ELSE 'Stable' END"


def _select(yhat: str, lower: str, upper: str, trend: str, fallback: str, where: str = "") -> str:
    return (f"SELECT stn_code, year, CAST(year AS VARCHAR) || '-01-01' AS ds, {yhat} AS yhat, {lower} AS yhat_lower, "
            f"{upper} AS yhat_upper, {trend} AS trend, {fallback} AS fallback FROM future {where}")


@query("series_prepare", Q.on_scored(
    "SELECT stn_code, year, make_date(year, 1, 1) AS ds, y / 1000000.0::DOUBLE AS y, points FROM "
    "(SELECT *, count(*) OVER (PARTITION BY stn_code) AS points FROM series) WHERE points >= 3", Q.SERIES))
def series_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.series_prepare(scored(spark, sf_dir))


@query("forecast_fallback_last", Q.on_scored(_select(
    _LAST, f"{_LAST} - abs({_LAST}) * 0.5::DOUBLE", f"{_LAST} + abs({_LAST}) * 0.5::DOUBLE", "'Fallback (last_value)'", "TRUE"),
    Q.SERIES, Q.lines("series"), _FUTURE))
def forecast_fallback_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_fallback_last(forecast.station_lines(scored(spark, sf_dir)), _H)


_LINE_OR_LAST = f"coalesce({_LINE}, {_LAST})"
_TWO_SIGMA = "coalesce(sigma, 0.0::DOUBLE) * 2.0::DOUBLE / 1000000.0::DOUBLE"


@query("forecast_fallback_linear", Q.on_scored(_select(
    _LINE_OR_LAST, f"{_LINE_OR_LAST} - {_TWO_SIGMA}", f"{_LINE_OR_LAST} + {_TWO_SIGMA}", "'Fallback (linear)'", "TRUE"),
    Q.SERIES, Q.lines("series"), _FUTURE))
def forecast_fallback_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_fallback_linear(forecast.station_lines(scored(spark, sf_dir)), _H)


_BAND = "sigma * 1.28::DOUBLE / 1000000.0::DOUBLE"


@query("forecast_trend", Q.on_scored(_select(
    _clip(_LINE), f"{_LINE} - {_BAND}", f"{_LINE} + {_BAND}", _label(), "FALSE", "WHERE n >= 3"),
    Q.SERIES, Q.lines("series"), _FUTURE))
def forecast_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_trend(forecast.station_lines(scored(spark, sf_dir)), _H)


_MARGIN = f"CASE WHEN n = 1 THEN abs({_LAST}) * 0.5::DOUBLE WHEN n = 2 THEN sigma * 2.0::DOUBLE / 1000000.0::DOUBLE ELSE {_BAND} END"
_CENTRE = f"CASE WHEN n = 1 THEN {_LAST} ELSE {_LINE} END"


def _router_sql(digits: int | None = None) -> str:
    return _select(
        f"CASE WHEN n = 1 THEN {_LAST} WHEN n = 2 THEN {_LINE} ELSE {_clip(_LINE)} END", f"{_CENTRE} - ({_MARGIN})",
        f"{_CENTRE} + ({_MARGIN})", f"CASE WHEN n = 1 THEN 'Fallback (last_value)' WHEN n = 2 THEN 'Fallback (linear)' ELSE {_label()} END",
        "n <= 2")


@query("forecast_router", Q.wrap(_router_sql(), _CUSTOMER_SERIES, Q.lines("series"), _FUTURE))
def forecast_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_router(customer_scores(spark, sf_dir), _H)


@query("forecast_display", Q.wrap(
    f"SELECT * REPLACE ({', '.join(f'{Q.rnd(c, 2)} AS {c}' for c in ('yhat', 'yhat_lower', 'yhat_upper'))}) FROM ({_router_sql()})",
    _CUSTOMER_SERIES, Q.lines("series"), _FUTURE))
def forecast_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.display(forecast.forecast_router(customer_scores(spark, sf_dir), _H))


_BACKTEST = [Q.SERIES, Q.lines("series", "year <= 2000", ", count(*) AS years, max(CASE WHEN year = 2001 THEN y END) AS actual_y"),
             """errors AS (SELECT stn_code, actual, predicted, abs(predicted - actual) AS mae,
  sqrt(abs(predicted - actual) * abs(predicted - actual)) AS rmse, abs(predicted - actual) / nullif(abs(actual), 0) * 100.0::DOUBLE AS mape FROM
  (SELECT stn_code, actual_y / 1000000.0::DOUBLE AS actual, (intercept + slope * (2001 - 2000)) / 1000000.0::DOUBLE AS predicted FROM lines
   WHERE actual_y IS NOT NULL AND years >= 4 AND n >= 3))"""]


def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_backtest(scored(spark, sf_dir), 2000)


_NAMED = """named AS (SELECT e.*, p_name || ' ' || stn_code AS station_name FROM errors e
  LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = stn_code)"""


def station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        code.alias("stn_code"), F.concat("p_name", F.lit(" "), code).alias("station_name"))


@query("forecast_backtest", Q.on_scored("SELECT * FROM named", *_BACKTEST, _NAMED))
def forecast_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.with_station_names(backtest(spark, sf_dir), station_names(spark, sf_dir))


@query("backtest_means", Q.on_scored(
    f"SELECT count(*) AS stations, {Q.rnd_mean('avg(mae)', 4)} AS mae, {Q.rnd_mean('avg(rmse)', 4)} AS rmse, "
    f"{Q.rnd_mean('avg(mape)', 4)} AS mape FROM errors", *_BACKTEST))
def backtest_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.backtest_means(backtest(spark, sf_dir))


@query("top_forecast_errors", Q.on_scored("SELECT * FROM named ORDER BY mae DESC, stn_code LIMIT 10", *_BACKTEST, _NAMED))
def top_forecast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = forecast.top_forecast_errors(backtest(spark, sf_dir))
    return forecast.with_station_names(worst, station_names(spark, sf_dir))


@query("error_histogram", Q.on_scored(" UNION ALL ".join(
    histogram_sql("errors", m, 20, f"'{m}' AS metric, ") for m in ("mae", "rmse", "mape")), *_BACKTEST))
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.error_histogram(backtest(spark, sf_dir), 20)


@query("forecast_stats", Q.on_scored(
    f"SELECT stn_code, {Q.rnd('min(yhat)', 2)} AS min_value, {Q.rnd('max(yhat)', 2)} AS max_value, count(*) AS points FROM ("
    + _router_sql() + ") GROUP BY stn_code", Q.SERIES, Q.lines("series"), _FUTURE))
def forecast_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.forecast_stats(forecast.forecast_router(scored(spark, sf_dir), _H))


@query("history_forecast_merge", Q.on_scored(
    f"SELECT stn_code, year, {Q.rnd_mean('avg(pollution_score)', 2)} AS historical, CAST(NULL AS DOUBLE) AS predicted, "
    "CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL "
    f"GROUP BY stn_code, year UNION ALL SELECT stn_code, year, NULL, {Q.rnd('yhat', 2)}, {Q.rnd('yhat_lower', 2)}, {Q.rnd('yhat_upper', 2)} "
    f"FROM ({_router_sql()})", Q.SERIES, Q.lines("series"), _FUTURE))
def history_forecast_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    history = stats.location_year_avg(rows, ["stn_code", "year"], digits=2)
    return forecast.history_forecast_merge(history, forecast.display(forecast.forecast_router(rows, _H)))


# The given series have seven years at most, where the default penalty admits no break.
_PENALTY = 1.0


def _divisions(source: str) -> tuple[str, ...]:
    """All divisions of each series, one by one, and the best of them."""
    terms = {"n": "1", "sx": "year - 2000", "sxx": "(year - 2000) * (year - 2000)", "sy": "y",
             "sxy": "(year - 2000) * y", "syy": "y * y"}
    running = ", ".join(f"sum(CAST({t} AS BIGINT)) OVER (PARTITION BY stn_code ORDER BY year) AS {c}" for c, t in terms.items())
    sums = ", ".join(f"CAST(b.{c} - coalesce(a.{c}, 0) AS DOUBLE) AS {c}" for c in terms)
    return (
        f"prefix AS (SELECT stn_code, year, y, row_number() OVER (PARTITION BY stn_code ORDER BY year) AS i, {running} FROM {source})",
        "ends AS (SELECT stn_code, max(i) AS years FROM prefix GROUP BY stn_code)",
        f"""parts AS (SELECT b.stn_code, coalesce(a.i, 0) AS s, b.i AS e, f.year AS first_year, b.year AS last_year, b.y AS last_y, {sums}
FROM prefix b JOIN prefix f ON f.stn_code = b.stn_code AND f.i <= b.i - 2
LEFT JOIN prefix a ON a.stn_code = f.stn_code AND a.i = f.i - 1)""",
        """fitted AS (SELECT *, crossed / spread AS slope, (sxx * sy - sx * sxy) / spread AS intercept,
  round(greatest(((n * syy - sy * sy) - crossed * crossed / spread) / n, 0.0::DOUBLE) / 1000000.0::DOUBLE) AS cost
FROM (SELECT *, n * sxx - sx * sx AS spread, n * sxy - sx * sy AS crossed FROM parts))""",
        f"""prices AS (SELECT ends.*, slope AS whole_slope, intercept AS whole_intercept,
  round({_PENALTY}::DOUBLE * ln(years::DOUBLE) * cost / (years::DOUBLE - 2)) AS price
FROM ends JOIN fitted ON fitted.stn_code = ends.stn_code AND s = 0 AND e = years)""",
        """paths(stn_code, e, lines, total, starts) AS (SELECT stn_code, e, 1, cost, [s] FROM fitted WHERE s = 0
UNION ALL SELECT p.stn_code, f.e, p.lines + 1, p.total + f.cost + prices.price, list_append(p.starts, f.s)
FROM paths p JOIN fitted f ON f.stn_code = p.stn_code AND f.s = p.e JOIN prices ON prices.stn_code = p.stn_code)""",
        """best AS (SELECT * FROM (SELECT p.*, years, whole_slope, whole_intercept, total - price * (lines - 1) AS error,
  row_number() OVER (PARTITION BY p.stn_code ORDER BY total, lines, starts) AS place
  FROM paths p JOIN prices ON prices.stn_code = p.stn_code AND e = years) WHERE place = 1)""",
        """ending AS (SELECT f.*, years, lines, error, whole_slope, whole_intercept FROM best
  JOIN fitted f ON f.stn_code = best.stn_code AND f.s = list_last(starts) AND f.e = years)""")


def _with_recursion(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def divided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changepoints.changepoint_segments(scored(spark, sf_dir), penalty=_PENALTY)


@query("changepoint_segments", _with_recursion(Q.on_scored(
    "SELECT f.stn_code, list_position(starts, f.s) AS segment, first_year, last_year, CAST(n AS BIGINT) AS points, "
    "slope / 1000000.0::DOUBLE AS slope, (intercept + slope * (first_year - 2000)) / 1000000.0::DOUBLE AS level "
    "FROM best JOIN fitted f ON f.stn_code = best.stn_code AND list_contains(starts, f.s) "
    "AND f.e = coalesce(starts[list_position(starts, f.s) + 1], years)", Q.SERIES, *_divisions("series"))))
def changepoint_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changepoints.segment_lines(divided(spark, sf_dir))


_AWAY = "(n * (year - 2000) - sx)"
_WIDER = (f"sqrt(error / greatest(years - 2 * lines, 1)) / 1000.0::DOUBLE * 1.28::DOUBLE * "
          f"sqrt(1.0::DOUBLE + 1.0::DOUBLE / n + {_AWAY} * {_AWAY} / (n * (n * sxx - sx * sx)))")


@query("forecast_changepoints", _with_recursion(Q.on_scored(
    _select(_clip(_LINE), f"{_LINE} - {_WIDER}", f"{_LINE} + {_WIDER}", _label(), "FALSE"),
    Q.SERIES, *_divisions("series"), _FUTURE.replace("FROM lines", "FROM ending"))))
def forecast_changepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changepoints.forecast_changepoints(divided(spark, sf_dir), _H)


def _at_cut(slope: str, intercept: str) -> str:
    return f"({intercept} + {slope} * (2001 - 2000)) / 1000000.0::DOUBLE"


@query("changepoint_backtest", _with_recursion(Q.on_scored(
    "SELECT *, abs(broken - actual) AS broken_error, abs(line - actual) AS line_error FROM (SELECT ending.stn_code, "
    f"a.y / 1000000.0::DOUBLE AS actual, CAST(lines - 1 AS INT) AS breaks, {_at_cut('slope', 'intercept')} AS broken, "
    f"{_at_cut('whole_slope', 'whole_intercept')} AS line "
    "FROM ending JOIN series a ON a.stn_code = ending.stn_code AND a.year = 2001)",
    Q.SERIES, "earlier AS (SELECT * FROM series WHERE year <= 2000)", *_divisions("earlier"))))
def changepoint_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changepoints.changepoint_backtest(scored(spark, sf_dir), 2000, penalty=_PENALTY)
