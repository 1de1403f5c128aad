"""Queries over lookups, comparisons and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.operators import compare, explain, locate, score, stats
from rivulet.operators.latest import gathered
from rivulet.plans import ctes as Q
from rivulet.plans.q_scalars import _CANDIDATES, _PLACES, _SIMPLE, places
from rivulet.plans.q_sources import CACHE_SQL, geocode_cache
from rivulet.plans.registry import query
from rivulet.sources import caches
from rivulet.sources.tables import samples, table

KEY = ["stn_code", "k1", "k2", "k3"]
_KEY = ", ".join(KEY)


@query("join_geocode_cache", Q.on_samples(
    f"SELECT {_KEY}, c.lat AS latitude, c.lng AS longitude, c.query AS geocode_query, coalesce(c.success, FALSE) AS geocoded "
    "FROM samples s LEFT JOIN cache c ON s.monitoring_location = c.monitoring_location AND s.state = c.state", CACHE_SQL))
def join_geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate.join_geocode_cache(samples(spark, sf_dir), geocode_cache(spark, sf_dir)).select(
        *KEY, "latitude", "longitude", "geocode_query", "geocoded")


_GAZETTEER = """gazetteer AS (SELECT query, min(lat) AS lat, min(lng) AS lng FROM (
  SELECT p_name || ', NATION_' || CAST(p_size % 25 AS VARCHAR) || ', India' AS query, p_size * 0.5::DOUBLE AS lat, 70.0::DOUBLE AS lng FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR) || ', NATION_' || CAST(p_partkey % 25 AS VARCHAR) || ', India', p_size * 0.25::DOUBLE, 80.0::DOUBLE FROM part
  UNION ALL SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) || ', NATION_' || CAST(p_partkey % 25 AS VARCHAR) || ', India',
    p_size * 0.125::DOUBLE, 90.0::DOUBLE FROM part WHERE p_size < 20) GROUP BY query)"""


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known places over ``part``: names alone, numbers alone, and some full names."""
    part = table(spark, sf_dir, "part")
    number = F.col("p_partkey").cast("string")

    def place(name, state, lat: float, lng: float, rows: DataFrame = part) -> DataFrame:
        text = F.concat(name, F.lit(", NATION_"), state.cast("string"), F.lit(", India"))
        return rows.select(text.alias("query"), (F.col("p_size") * lat).alias("lat"), F.lit(lng).alias("lng"))

    own = F.col("p_partkey") % 25
    every = (
        place(F.col("p_name"), F.col("p_size") % 25, 0.5, 70.0)
        .union(place(number, own, 0.25, 80.0))
        .union(place(F.concat("p_name", F.lit(" "), number), own, 0.125, 90.0, part.filter(F.col("p_size") < 20)))
    )
    return every.groupBy("query").agg(F.min("lat").alias("lat"), F.min("lng").alias("lng"))


@query("join_gazetteer_ranked", Q.wrap(
    "SELECT monitoring_location, state, arg_min(lat, rank) FILTER (WHERE lat IS NOT NULL) AS lat, "
    "arg_min(lng, rank) FILTER (WHERE lat IS NOT NULL) AS lng, coalesce(arg_min(query, rank) FILTER (WHERE lat IS NOT NULL), "
    "arg_min(query, rank)) AS query, count(lat) > 0 AS success FROM candidates LEFT JOIN gazetteer USING (query) GROUP BY 1, 2",
    _PLACES, _SIMPLE, _CANDIDATES, _GAZETTEER))
def join_gazetteer_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = places(spark, sf_dir).withColumnRenamed("name", "monitoring_location")
    return locate.join_gazetteer_ranked(named, gazetteer(spark, sf_dir))


_PART = "'^(.*)(, [^,]*, [^,]*)$'"
_CUT = (f"CASE WHEN regexp_matches(query, {_PART}) THEN regexp_extract(query, {_PART}, 1) ELSE query END AS place, "
        f"regexp_extract(query, {_PART}, 2) AS area")
_TYPOS = f"""typos AS (SELECT *, {_CUT} FROM (SELECT query, min(lat) AS lat, min(lng) AS lng FROM (SELECT lat, lng,
  CASE length(query) % 3 WHEN 0 THEN substr(query, 1, 2) || substr(query, 4) WHEN 1 THEN substr(query, 1, 3) || 'z' || substr(query, 4)
  ELSE query END AS query FROM gazetteer) GROUP BY query)), tried AS (SELECT *, {_CUT} FROM candidates),
hits AS (SELECT t.monitoring_location, t.state, t.query, t.rank, g.query AS matched, g.lat, g.lng,
  CAST(levenshtein(t.place, g.place) AS INT) AS distance FROM tried t JOIN typos g
  ON t.area = g.area AND abs(length(t.place) - length(g.place)) <= least(2, length(t.place) // 6)
  AND levenshtein(t.place, g.place) <= least(2, length(t.place) // 6)),
best AS (SELECT monitoring_location, state, arg_min({{'q': query, 'm': matched, 'lat': lat, 'lng': lng, 'd': distance}},
  row(rank, distance, matched)) AS b FROM hits GROUP BY ALL)"""


@query("join_gazetteer_fuzzy", Q.wrap(
    "SELECT monitoring_location, state, any_value(b.lat) AS lat, any_value(b.lng) AS lng, coalesce(any_value(b.q), arg_min(query, rank)) AS query, "
    "any_value(b.m) AS matched, any_value(b.d) AS distance, any_value(b.m) IS NOT NULL AS success "
    "FROM candidates LEFT JOIN best USING (monitoring_location, state) GROUP BY 1, 2",
    _PLACES, _SIMPLE, _CANDIDATES, _GAZETTEER, _TYPOS))
def join_gazetteer_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known places with a letter lost or added in two thirds of the texts."""
    named = places(spark, sf_dir).withColumnRenamed("name", "monitoring_location")
    text, kind = F.col("query"), F.length("query") % 3
    spelled = F.when(kind == 0, F.concat(F.substring(text, 1, 2), F.substr(text, F.lit(4)))).when(
        kind == 1, F.concat(F.substring(text, 1, 3), F.lit("z"), F.substr(text, F.lit(4)))).otherwise(text)
    typos = gazetteer(spark, sf_dir).withColumn("query", spelled).groupBy("query").agg(
        F.min("lat").alias("lat"), F.min("lng").alias("lng"))
    return locate.join_gazetteer_fuzzy(named, typos)


@query("failed_locations", Q.on_samples(
    "SELECT DISTINCT stn_code, monitoring_location FROM samples LEFT JOIN cache USING (monitoring_location, state) "
    "WHERE NOT coalesce(success, FALSE)", CACHE_SQL))
def failed_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of all samples for which the cache has no position."""
    rows = samples(spark, sf_dir).select("stn_code", "monitoring_location", "state").distinct()
    return locate.failed_locations(locate.join_geocode_cache(rows, geocode_cache(spark, sf_dir)))


@query("anti_uncached", Q.on_samples(
    "SELECT DISTINCT monitoring_location, state FROM samples s WHERE NOT EXISTS (SELECT 1 FROM cache c "
    "WHERE c.monitoring_location = s.monitoring_location AND c.state = s.state)", CACHE_SQL))
def anti_uncached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caches.anti_uncached(samples(spark, sf_dir), geocode_cache(spark, sf_dir), ["monitoring_location", "state"])


@query("cached_count", Q.on_samples(
    "SELECT count(*) AS cached_count FROM samples s WHERE EXISTS (SELECT 1 FROM cache c "
    "WHERE c.monitoring_location = s.monitoring_location AND c.state = s.state)", CACHE_SQL))
def cached_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caches.cached_count(samples(spark, sf_dir), geocode_cache(spark, sf_dir), ["monitoring_location", "state"])


@query("join_insights", Q.on_scored(
    f"SELECT {_KEY}, CASE WHEN safety_label = 'Unsafe' AND water_body_type <> 'Canal' THEN "
    "'Treat ' || violated_params || '|Monitor ' || water_body_type ELSE '' END AS measures FROM scored"))
def join_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insights exist for every violation list but those of canals; one measure comes twice."""
    rows = score.classify_class_a(samples(spark, sf_dir, names=False, states=False))
    combos = stats.unsafe_combos(rows).filter(F.col("water_body_type") != "Canal")
    treat = F.concat(F.lit("Treat "), "violated_params")
    insights = combos.withColumn("recommended_measures", F.array(
        treat, F.concat(F.lit(" Monitor "), "water_body_type"), F.lit(" "), treat))
    return explain.join_insights(rows, insights).select(*KEY, F.array_join("measures", "|").alias("measures"))


@query("join_param_knowledge", Q.on_scored(" UNION ALL ".join(
    f"SELECT {_KEY}, {Q.text(n)} AS parameter, {Q.text(t[0])} AS cause, {Q.text(t[1])} AS impact FROM scored "
    f"WHERE contains(', ' || violated_params || ',', ', ' || {Q.text(n)} || ',')" for n, t in R.PARAMETER_KNOWLEDGE.items())))
def join_param_knowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score.classify_class_a(samples(spark, sf_dir, names=False, states=False))
    return explain.join_param_knowledge(rows, KEY, explain.knowledge_table(spark)).drop("position")


_QUESTION = "CASE " + " ".join(
    f"WHEN contains(lower(p), {Q.text(k.lower())}) THEN {Q.text(q)}" for k, q in R.FOLLOWUP_UNSAFE) + " END"
_FOLLOW = f"""chosen AS (SELECT stn_code, CASE safety_label WHEN 'Safe' THEN {Q.texts(R.FOLLOWUP_SAFE)} ELSE
  (list_filter(list_transform(list_transform(string_split(violated_params, ','), lambda x: trim(x)), lambda p: {_QUESTION}),
    lambda q: q IS NOT NULL)[:2] || {Q.texts(R.FOLLOWUP_DEFAULT)})[:3] END AS qs FROM latest)"""


@query("followup_lookup", Q.on_scored(
    "SELECT stn_code, CAST(generate_subscripts(qs, 1) - 1 AS INT) AS position, unnest(qs) AS question FROM chosen", Q.LATEST, _FOLLOW))
def followup_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.operators.latest import latest_per_station

    rows = latest_per_station(score.classify_class_a(samples(spark, sf_dir, names=False, states=False)),
                              columns=["year", "violated_params", "safety_label"])
    return explain.followups(rows, "stn_code")


# Every station next to the one named by the size of its part.
_PAIRS = ("pairs AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS station_a, CAST(p_size AS VARCHAR) AS station_b FROM part)")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("station_a"), F.col("p_size").cast("string").alias("station_b"))


def _side(side: str, p: str) -> str:
    return Q.rnd(f"{side}.{p}", 3)


def _status(p: str, value: str, limit) -> str:
    if limit is None or p == "ph_avg":
        return "'ok'"
    return f"CASE WHEN {value} {'<' if p == 'do_avg' else '>'} {limit} THEN 'violation' ELSE 'ok' END"


_CONTEXT = ", ".join(
    f"{s}.monitoring_location AS {s}_monitoring_location, {s}.water_body_type AS {s}_water_body_type, "
    f"{s}.safety_label AS {s}_safety_label, {_side(s, 'pollution_score')} AS {s}_pollution_score" for s in ("a", "b"))


def _compare_sql(p: str, label: str, unit: str, limit) -> str:
    return (f"SELECT station_a, station_b, a.year AS year_a, b.year AS year_b, CASE WHEN a.stn_code IS NOT NULL AND {_side('b', 'pollution_score')} IS NOT NULL AND "
            f"({_side('a', 'pollution_score')} IS NULL OR {_side('b', 'pollution_score')} < {_side('a', 'pollution_score')}) THEN station_b "
            f"WHEN a.stn_code IS NOT NULL AND b.stn_code IS NOT NULL THEN station_a END AS winner, {_CONTEXT}, '{p}' AS parameter, '{label}' AS label, '{unit}' AS unit, {_side('a', p)} AS a_value, "
            f"{_side('b', p)} AS b_value, CAST({'NULL' if limit is None else limit} AS DOUBLE) AS limit_value, "
            f"{_status(p, _side('a', p), limit)} AS a_status, {_status(p, _side('b', p), limit)} AS b_status "
            "FROM pairs LEFT JOIN latest_row a ON a.stn_code = station_a LEFT JOIN latest_row b ON b.stn_code = station_b")


@query("compare_stations", Q.on_scored(" UNION ALL ".join(_compare_sql(*p) for p in R.COMPARE_PARAMETERS), Q.LATEST_ROW, _PAIRS))
def compare_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_stations(score.scored(gathered(samples(spark, sf_dir, states=False), "stn_code")), pairs(spark, sf_dir))


def _change(p: str) -> str:
    a, b = _side("a", p), _side("b", p)
    return (f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 'N/A' WHEN abs({b} - {a}) < abs({a}) * 0.05::DOUBLE THEN 'Stable' "
            f"WHEN {b} {'>' if p == 'do_avg' else '<'} {a} THEN 'Improved' ELSE 'Worsened' END")


_REQUESTS = """requests AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS stn_code, 1995 + p_size % 7 AS year_a, 1997 + p_size % 8 AS year_b FROM part),
asked AS (SELECT r.*, coalesce(a.year, l.year) AS ya, coalesce(b.year, l.year) AS yb FROM requests r
  JOIN (SELECT stn_code, max(year) AS year FROM latest_year_row GROUP BY stn_code) l ON l.stn_code = r.stn_code
  LEFT JOIN latest_year_row a ON a.stn_code = r.stn_code AND a.year = year_a
  LEFT JOIN latest_year_row b ON b.stn_code = r.stn_code AND b.year = year_b)"""


def _years_sql(p: str, label: str, unit: str, limit) -> str:
    return (f"SELECT r.stn_code, year_a, year_b, '{p}' AS parameter, '{label}' AS label, '{unit}' AS unit, {_side('a', p)} AS a_value, "
            f"{_side('b', p)} AS b_value, CAST({'NULL' if limit is None else limit} AS DOUBLE) AS limit_value, "
            f"{_status(p, _side('a', p), limit)} AS a_status, {_status(p, _side('b', p), limit)} AS b_status, {_change(p)} AS change "
            "FROM asked r JOIN latest_year_row a ON a.stn_code = r.stn_code AND a.year = ya "
            "JOIN latest_year_row b ON b.stn_code = r.stn_code AND b.year = yb")


@query("compare_years", Q.on_scored(" UNION ALL ".join(_years_sql(*p) for p in R.COMPARE_PARAMETERS), Q.LATEST_YEAR_ROW, _REQUESTS))
def compare_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years are chosen per station; some lie beyond the last one."""
    requests = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("stn_code"), (1995 + F.col("p_size") % 7).alias("year_a"),
        (1997 + F.col("p_size") % 8).alias("year_b"))
    return compare.compare_years(score.score_10(gathered(samples(spark, sf_dir, names=False, states=False), "stn_code")), requests)
