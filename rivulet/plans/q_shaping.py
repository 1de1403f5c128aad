"""Queries over row filters, projections and column shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import schema as S
from rivulet.operators import extract, score, shaping
from rivulet.plans import ctes as Q
from rivulet.plans.registry import query
from rivulet.sources.tables import page_rows, samples, table

ROW = ["k1", "k2", "k3", "k4"]
_ROW = ", ".join(ROW)


@query("skip_header_rows", Q.on_pages(f"SELECT {_ROW}, row_no FROM page_rows WHERE NOT {Q.is_heading()}"))
def skip_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.skip_header_rows(page_rows(spark, sf_dir)).select(*ROW, "row_no")


@query("compact_cells", Q.on_pages(
    f"SELECT {_ROW}, len(c) AS n_cells, array_to_string(c, '|') AS cells FROM (SELECT {_ROW}, "
    "list_filter(cells, lambda x: x IS NOT NULL) AS c FROM page_rows) WHERE len(c) >= 4"))
def compact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.compact_cells(page_rows(spark, sf_dir)).select(
        *ROW, F.size("cells").cast("bigint").alias("n_cells"), F.array_join("cells", "|").alias("cells"))


@query("drop_invalid_rows", Q.on_samples(
    "SELECT stn_code, k1, k2, k3, ph FROM (SELECT *, ph_avg * 1.65 AS ph, "
    "CASE WHEN water_body_type = 'Canal' AND year = 1997 THEN '' ELSE monitoring_location END AS loc, "
    "CASE WHEN year = 1996 AND do_avg IS NULL THEN NULL ELSE state END AS st FROM samples) "
    "WHERE st IS NOT NULL AND loc <> '' AND (ph IS NULL OR ph <= 14)"))
def drop_invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some states, locations and pH values are spoiled first."""
    no_name = (F.col("water_body_type") == "Canal") & (F.col("year") == 1997)
    no_state = (F.col("year") == 1996) & F.col("do_avg").isNull()
    rows = samples(spark, sf_dir).withColumns({
        "ph_avg": F.col("ph_avg") * 1.65,
        "monitoring_location": F.when(no_name, "").otherwise(F.col("monitoring_location")),
        "state": F.when(~no_state, F.col("state")),
    })
    return shaping.drop_invalid_rows(rows).select(
        "stn_code", "k1", "k2", "k3", F.col("ph_avg").alias("ph"))


@query("drop_all_null_params", Q.on_samples(
    "SELECT stn_code, k1, k2, k3 FROM samples WHERE do_avg IS NOT NULL OR ph_avg IS NOT NULL OR nitrate_avg IS NOT NULL"))
def drop_all_null_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False).select(
        "stn_code", "k1", "k2", "k3", "do_avg", "ph_avg", "nitrate_avg")
    return shaping.drop_all_null_params(rows).select("stn_code", "k1", "k2", "k3")


_CLEAN = ["stn_code", "monitoring_location", "water_body_type", "state", "year", "safety_label",
          "pollution_score", "violated_params", *Q.MEASURES]


@query("project_known_columns", Q.on_scored(f"SELECT {', '.join(_CLEAN)} FROM scored"))
def project_known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.project_known_columns(score.scored(samples(spark, sf_dir)), S.CLEAN_COLUMNS)


@query("ensure_columns", Q.on_samples(
    "SELECT stn_code, k1, k2, k3, ph_avg, CAST(NULL AS DOUBLE) AS nitrate_avg FROM samples"))
def ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False).drop("nitrate_avg")
    return shaping.ensure_columns(rows).select("stn_code", "k1", "k2", "k3", "ph_avg", "nitrate_avg")


@query("filter_samples", Q.on_scored(
    "SELECT stn_code, k1, k2, k3, pollution_score FROM scored WHERE year = 1998 AND water_body_type = 'River' "
    "AND safety_label = 'Unsafe'"))
def filter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score.scored(samples(spark, sf_dir, names=False, states=False))
    return shaping.filter_samples(rows, 1998, "River", "Unsafe").select(
        "stn_code", "k1", "k2", "k3", "pollution_score")


@query("filter_type_ci", Q.on_samples(
    "SELECT stn_code, k1, k2, k3 FROM samples WHERE lower(trim(water_body_type)) = 'pond/tank'"))
def filter_type_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return shaping.filter_type_ci(rows, " POND/Tank ").select("stn_code", "k1", "k2", "k3")


@query("filter_station", Q.on_samples("SELECT stn_code, year, k1, k2, k3 FROM samples WHERE stn_code = '42'"))
def filter_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return shaping.filter_station(rows, " 42 ").select("stn_code", "year", "k1", "k2", "k3")


@query("drop_missing_coords", Q.on_samples(
    "SELECT stn_code, k1, k2, k3, latitude, longitude FROM samples WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))
def drop_missing_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return shaping.drop_missing_coords(rows).select("stn_code", "k1", "k2", "k3", "latitude", "longitude")


@query("valid_coordinates", Q.on_samples(
    "SELECT stn_code, k1, k2, k3, lat, lon FROM (SELECT *, latitude * 3 AS lat, longitude * 2 AS lon FROM samples) "
    "WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND stn_code IS NOT NULL"))
def valid_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False).select(
        "stn_code", "k1", "k2", "k3", (F.col("latitude") * 3).alias("lat"),
        (F.col("longitude") * 2).cast("string").alias("lon"))
    return shaping.valid_coordinates(rows, "stn_code", "lat", "lon")


@query("drop_excluded_years", Q.on_samples(
    "SELECT stn_code, year, k1, k2, k3 FROM samples WHERE year NOT IN (2000, 2001)"))
def drop_excluded_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False)
    return shaping.drop_excluded_years(rows, [2000, 2001]).select("stn_code", "year", "k1", "k2", "k3")


@query("train_test_split_year", Q.on_samples(
    "SELECT stn_code, year, k1, k2, k3, CASE WHEN year <= 2000 THEN 'train' ELSE 'test' END AS part "
    "FROM samples WHERE year <= 2001"))
def train_test_split_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, names=False, states=False).select("stn_code", "year", "k1", "k2", "k3")
    train, test = shaping.train_test_split_year(rows, 2000)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@query("type_coerce", f"""SELECT event_id, {Q.number("CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(value AS VARCHAR) END")} AS value,
  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
  nullif(trim(CASE WHEN event_type = 'error' THEN '  ' ELSE ' ' || event_type END), '') AS event_type FROM events""")
def type_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and labels as untidy text."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "view", "NaN").otherwise(
            F.concat(F.col("user_id").cast("string"), F.lit(".0"))).alias("user_id"),
        F.when(kind == "error", "  ").otherwise(F.concat(F.lit(" "), kind)).alias("event_type"),
    )
    return shaping.type_coerce(rows, doubles=["value"], ints=["user_id"], texts=["event_type"])
