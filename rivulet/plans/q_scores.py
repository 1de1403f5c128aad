"""Queries over cleaning, labels and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions import scoring
from rivulet.operators import batch, explain, score, stats
from rivulet.plans import ctes as Q
from rivulet.plans.q_scalars import EXTRACTED, ROW_STATES
from rivulet.plans.registry import query
from rivulet.sources.tables import page_rows, samples, table

KEY = ["stn_code", "k1", "k2", "k3"]
_KEY = ", ".join(KEY)

# Measures raised so that some exceed every cap.
RAISED = {"bod_avg": 300.0, "fecal_coliform_avg": 800.0, "total_coliform_avg": 800.0,
          "conductivity_avg": 20.0, "nitrate_avg": 12.0}


def raised(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    rows = samples(spark, sf_dir, **kwargs)
    return rows.withColumns({c: F.col(c) * by for c, by in RAISED.items()})


_RAISED = ("raised AS (SELECT * REPLACE (" + ", ".join(
    f"{c} * {by}::DOUBLE AS {c}" for c, by in RAISED.items()) + ") FROM samples)")
_CAPPED = ("capped AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} > {cap} THEN {cap}::DOUBLE ELSE {c} END AS {c}" for c, cap in R.OUTLIER_CAPS.items())
    + ") FROM raised)")


@query("cap_outliers", Q.on_samples(f"SELECT {_KEY}, {', '.join(R.OUTLIER_CAPS)} FROM capped", _RAISED, _CAPPED))
def cap_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raised(spark, sf_dir, names=False, states=False)
    return score.cap_outliers(rows).select(*KEY, *R.OUTLIER_CAPS)


@query("classify_bis", Q.on_samples(f"SELECT {_KEY}, {Q.bis_label()} AS safety_label FROM samples"))
def classify_bis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.classify_bis(rows).select(*KEY, "safety_label")


@query("violations_bis", Q.on_samples(f"SELECT {_KEY}, {Q.bis_violations()} AS violated_params FROM samples"))
def violations_bis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.violations_bis(rows).select(*KEY, "violated_params")


@query("score_100", Q.on_samples(f"SELECT {_KEY}, {Q.bis_score()} AS score_100 FROM samples"))
def score_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.score_100(rows, "score_100").select(*KEY, "score_100")


_TITLE = ("array_to_string(list_transform(regexp_extract_all(lower(trim(monitoring_location)), '[a-z]+|[^a-z]+'), "
          "lambda t: upper(t[1]) || t[2:]), '')")


@query("clean_samples", Q.on_samples(
    f"SELECT stn_code, {_TITLE} AS monitoring_location, water_body_type, state, year, {Q.bis_label()} AS safety_label, "
    f"{Q.bis_score()} AS pollution_score, {Q.bis_violations()} AS violated_params, {', '.join(Q.MEASURES)} FROM capped",
    _RAISED, _CAPPED))
def clean_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.clean_samples(raised(spark, sf_dir))


@query("cleaning_report", Q.on_samples(
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE stn_code IS NULL) AS missing_codes, "
    + ", ".join(f"(SELECT count(*) FROM raised WHERE {c} > {cap}) AS capped_{c}" for c, cap in R.OUTLIER_CAPS.items())
    + ", count(*) FILTER (WHERE label = 'Safe') AS safe_count, count(*) FILTER (WHERE label = 'Unsafe') AS unsafe_count, "
    f"min(s) AS min_score, max(s) AS max_score FROM (SELECT *, {Q.bis_label()} AS label, {Q.bis_score()} AS s FROM capped)",
    _RAISED, _CAPPED))
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.cleaning_report(raised(spark, sf_dir, names=False, states=False))


@query("score_10", Q.on_scored(f"SELECT {_KEY}, pollution_score FROM scored"))
def score_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.score_10(rows).select(*KEY, "pollution_score")


@query("classify_class_a", Q.on_scored(f"SELECT {_KEY}, violated_params, safety_label FROM scored"))
def classify_class_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.classify_class_a(rows).select(*KEY, "violated_params", "safety_label")


_DETAILS = [
    ("pH", "ph_avg", "ph_avg < 6.5 OR ph_avg > 8.5", "6.5-8.5 (BIS/WHO)", "mg/L"),
    ("Dissolved Oxygen", "do_avg", "do_avg < 6", "min 6.0 mg/L (CPCB)", "mg/L"),
    ("BOD", "bod_avg", "bod_avg > 2", "max 2.0 mg/L (CPCB)", "mg/L"),
    ("Nitrate", "nitrate_avg", "nitrate_avg > 10", "max 10.0 mg/L (WHO)", "mg/L"),
    ("Fecal Coliform", "fecal_coliform_avg", "fecal_coliform_avg > 50", "max 50.0 MPN/100ml (WHO)", "MPN/100ml"),
]


@query("violation_details", Q.on_samples(" UNION ALL ".join(
    f"SELECT {_KEY}, '{name}' AS parameter, CAST({c} AS VARCHAR) || ' {unit}' AS value, '{limit}' AS limit_text, "
    f"'critical' AS status FROM samples WHERE {condition}" for name, c, condition, limit, unit in _DETAILS)))
def violation_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return score.violation_details(rows, KEY)


@query("limit_status", Q.on_samples(
    f"SELECT {_KEY}, CASE WHEN do_avg < 5 THEN 'violation' ELSE 'ok' END AS do_status, 'ok' AS ph_status, "
    "CASE WHEN bod_avg > 3 THEN 'violation' ELSE 'ok' END AS bod_status, 'ok' AS conductivity_status FROM samples"))
def limit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {column: limit for column, _, _, limit, _ in R.DISPLAY_PARAMETERS}
    return samples(spark, sf_dir, names=False, states=False).select(*KEY, *[
        scoring.limit_status(c, F.col(c), limits[c]).alias(c.replace("_avg", "_status"))
        for c in ("do_avg", "ph_avg", "bod_avg", "conductivity_avg")])


@query("score_band", Q.on_scored(
    "SELECT CASE WHEN pollution_score < 2 THEN 'Clean' WHEN pollution_score < 4 THEN 'Moderate' "
    "WHEN pollution_score < 7 THEN 'Polluted' WHEN pollution_score IS NOT NULL THEN 'Severely Polluted' END AS band, "
    "count(*) AS n FROM scored GROUP BY 1"))
def score_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score.score_10(samples(spark, sf_dir, names=False, states=False))
    return score.with_band(rows).groupBy("band").agg(F.count("*").alias("n"))


@query("risk_bucket", Q.on_scored(
    "SELECT water_body_type, year, rate, CASE WHEN rate < 20 THEN 'low' WHEN rate < 50 THEN 'medium' ELSE 'high' END AS bucket "
    "FROM (SELECT water_body_type, year, count(*) FILTER (WHERE nitrate_avg > 10) * 100.0::DOUBLE / count(nitrate_avg) AS rate "
    "FROM scored GROUP BY 1, 2)"))
def risk_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nitrate violation rate and its bucket per water body and year."""
    rows = samples(spark, sf_dir, names=False, states=False)
    rates = rows.groupBy("water_body_type", "year").agg(stats.share(
        F.count_if(F.col("nitrate_avg") > R.CLASS_A_NITRATE_MAX), F.count("nitrate_avg")).alias("rate"))
    return rates.withColumn("bucket", scoring.risk_bucket(F.col("rate")))


def _json(position: int) -> str:
    parts = ", ".join(
        f"CASE WHEN contains(', ' || violated_params || ',', ', ' || {Q.text(name)} || ',') THEN {Q.text(texts[position])} END"
        for name, texts in sorted(R.PARAMETER_KNOWLEDGE.items(), key=lambda i: ["pH", "DO", "BOD", "Nitrate", "Fecal Coliform"].index(i[0])))
    return (f"'[' || coalesce(array_to_string(list_transform(list_filter([{parts}], lambda t: t IS NOT NULL), "
            "lambda t: '\"' || t || '\"'), ','), '') || ']'")


_MEASURES = ("CASE WHEN safety_label = 'Unsafe' AND water_body_type <> 'Canal' THEN '[\"Treat ' || violated_params || "
             "'\",\"Monitor ' || water_body_type || '\"]' ELSE '[]' END")


@query("enrich_samples", Q.on_scored(
    f"SELECT {_KEY}, pollution_score, safety_label, violated_params, {_json(0)} AS causes, {_json(1)} AS impacts, "
    f"{_MEASURES} AS measures FROM scored"))
def enrich_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With insights for every violation list but those of canals."""
    rows = samples(spark, sf_dir, names=False, states=False)
    combos = stats.unsafe_combos(score.classify_class_a(rows)).filter(F.col("water_body_type") != "Canal")
    insights = combos.withColumn("recommended_measures", F.array(
        F.concat(F.lit("Treat "), "violated_params"), F.concat(F.lit("Monitor "), "water_body_type")))
    return explain.enrich_samples(rows, insights).select(
        *KEY, "pollution_score", "safety_label", "violated_params", "causes", "impacts", "measures")


# Positions of the sites on report pages, in three states each.
_SITES = """sites AS (SELECT 'Site ' || CAST(p_partkey AS VARCHAR) AS monitoring_location, unnest(['KARNATAKA', 'KERALA', 'TAMIL NADU']) AS state,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 8 + (p_partkey % 290) * 0.1::DOUBLE END AS lat,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 68 + (p_partkey % 290) * 0.1::DOUBLE END AS lng FROM part)"""
_ACCEPTED = """regexp_full_match(lower(file_name), replace('(?:wquality_river-data-Y|water_quality_data_of_med_min_river_Y|\
water_creek_marine_seawater_beach_Y|water_quality_canals_Y|water_quality_drains_stps_wtps_Y|water_pond_tanks_Y|nwmp_data_Y)\\.pdf',
'Y', CAST(year AS VARCHAR)))"""
_PAGE_SAMPLES = "samples AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} > {cap} THEN {cap}::DOUBLE ELSE {c} END AS {c}" for c, cap in R.OUTLIER_CAPS.items()) + ") FROM extracted WHERE accepted AND state IS NOT NULL AND monitoring_location <> '' AND (ph_avg IS NULL OR ph_avg <= 14))"
_BATCH = f"""batch AS (SELECT s.* REPLACE ({Q.rnd('pollution_score', 2)} AS pollution_score), lat AS latitude, lng AS longitude
  FROM scored s LEFT JOIN sites USING (monitoring_location, state))"""


def _on_batch(body: str) -> str:
    """SQL over the extracted samples of accepted files, scored and located."""
    with_names = EXTRACTED.replace("FROM sliced)", f", {_ACCEPTED} AS accepted FROM sliced)")
    return Q.on_pages(body, Q.CELL_STATES, ROW_STATES, with_names, _PAGE_SAMPLES, Q.SCORED, _SITES, _BATCH)


def site_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache of the sites on report pages over ``part``, a quarter of them without a hit."""
    hit = F.col("p_size") % 4 != 0
    step = (F.col("p_partkey") % 290) * 0.1
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("Site "), F.col("p_partkey").cast("string")).alias("monitoring_location"),
        F.explode(F.array(*[F.lit(s) for s in ("KARNATAKA", "KERALA", "TAMIL NADU")])).alias("state"),
        F.when(hit, 8 + step).alias("lat"), F.when(hit, 68 + step).alias("lng"),
        F.col("p_type").alias("query"), hit.alias("success"))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.predict_batch(page_rows(spark, sf_dir), site_positions(spark, sf_dir))


@query("batch_predict", _on_batch(
    "SELECT stn_code, monitoring_location, water_body_type, state, year, safety_label, pollution_score, violated_params, "
    "do_avg, ph_avg, bod_avg, nitrate_avg, fecal_coliform_avg, latitude, longitude FROM batch"))
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rows of all years, from the check of the file names to the scored, located samples."""
    return predicted(spark, sf_dir).select(
        "stn_code", "monitoring_location", "water_body_type", "state", "year", "safety_label", "pollution_score",
        "violated_params", "do_avg", "ph_avg", "bod_avg", "nitrate_avg", "fecal_coliform_avg", "latitude", "longitude")


@query("batch_summary", _on_batch(
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE safety_label = 'Safe') AS safe_count, "
    "count(*) FILTER (WHERE safety_label = 'Unsafe') AS unsafe_count, "
    "count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS geocoded_count FROM batch"))
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.batch_summary(predicted(spark, sf_dir))


@query("batch_rejects", Q.on_pages(f"SELECT DISTINCT file_name, year FROM page_rows WHERE NOT {_ACCEPTED}"))
def batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.rejected_files(page_rows(spark, sf_dir))
