"""Queries over scans, sinks and caches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import schema as S
from rivulet.functions.detect import invalid_report_name
from rivulet.functions.text import state_slug
from rivulet.operators import latest, score, stats
from rivulet.plans import ctes as Q
from rivulet.plans.registry import query
from rivulet.session import new_path
from rivulet.sources import caches, files, managed, store
from rivulet.sources.tables import page_rows, samples, table

SCAN_COLUMNS = ["stn_code", "monitoring_location", "water_body_type", "state", "year", *Q.MEASURES]
_SCAN = ", ".join(SCAN_COLUMNS)


@query("scan_samples_csv", Q.on_samples(
    f"SELECT {_SCAN.replace('nitrate_avg', '''CASE WHEN water_body_type <> 'Coastal' THEN nitrate_avg END AS nitrate_avg''')} FROM samples"))
def scan_samples_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file layouts: all columns, and a reordered one without nitrate."""
    rows = samples(spark, sf_dir).select(*SCAN_COLUMNS)
    path = new_path(spark, "samples-csv")
    coastal = F.col("water_body_type") == "Coastal"
    files.sink_csv_flat(rows.filter(~coastal), f"{path}/a")
    reordered = [c for c in reversed(SCAN_COLUMNS) if c != "nitrate_avg"]
    files.sink_csv_flat(rows.filter(coastal).select(*reordered), f"{path}/b")
    return files.scan_samples_csv(spark, [f"{path}/a", f"{path}/b"], SCAN_COLUMNS).drop("path")


_PLACE = "monitoring_location || ', \"' || stn_code || '\"' || chr(10) || 'bank'"


def awkward_places(rows: DataFrame) -> DataFrame:
    """Location texts that a CSV file has to quote."""
    return rows.withColumn("monitoring_location", F.concat(
        "monitoring_location", F.lit(', "'), "stn_code", F.lit('"\nbank')))


@query("scan_samples_multi", Q.on_samples(
    "SELECT 'Nation ' || replace(state, 'NATION_', '') AS file_state, year AS file_year, stn_code, "
    f"{_PLACE} AS monitoring_location, do_avg, ph_avg, bod_avg FROM samples WHERE year <> 2001"))
def scan_samples_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations with commas, quotes and line breaks in them."""
    rows = awkward_places(samples(spark, sf_dir, dealt=True))
    path = new_path(spark, "samples-by-file")
    files.sink_state_year_csv(rows.select(*SCAN_COLUMNS), path, dealt=True)
    found = files.scan_samples_multi(spark, path, SCAN_COLUMNS, exclude_years=[2001])
    return found.select(
        "file_state", "file_year", "stn_code", "monitoring_location", "do_avg", "ph_avg", "bod_avg")


_LAST_WRITTEN = "arg_max({0}, row(-k1, -k2, -k3)) FILTER (WHERE {0} IS NOT NULL) AS {0}"


@query("last_per_station_year_files", Q.on_samples(
    f"SELECT year, stn_code, {_LAST_WRITTEN.format('do_avg')}, {_LAST_WRITTEN.format('ph_avg')} FROM samples GROUP BY year, stn_code"))
def last_per_station_year_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files by year, later orders first; the last row in the files counts.

    Not partitioned by folder: Spark sorts rows by a text folder column again and loses their order.
    """
    order = ["year", F.desc("k1"), F.desc("k2"), F.desc("k3")]
    path = new_path(spark, "samples-in-order")
    rows = awkward_places(samples(spark, sf_dir, states=False)).repartitionByRange(*order).sortWithinPartitions(*order)
    files.sink_csv_flat(rows.select("stn_code", "monitoring_location", "year", "do_avg", "ph_avg"), path)
    found = files.scan_samples_csv(spark, path, ["stn_code", "year", "do_avg", "ph_avg"], origin=True)
    return latest.last_per_station_year(found, order=["origin"], columns=["do_avg", "ph_avg"])


@query("dedupe_locations_files", """SELECT user_id AS id, arg_min(event_type, event_id) AS event_type,
  arg_min(value, event_id) AS value FROM events GROUP BY user_id""")
def dedupe_locations_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files with the newest events first; the values of the last row in the files stay."""
    path = new_path(spark, "events-in-order")
    order = F.desc("event_id")
    table(spark, sf_dir, "events").repartitionByRange(order).sortWithinPartitions(order).select(
        F.col("user_id").alias("id"), "event_type", "value").write.parquet(path)
    return latest.dedupe_locations(files.scan_parquet_origin(spark, path), "id", ["origin"]).select("id", "event_type", "value")


@query("scan_year_partitions", Q.on_samples(
    "SELECT DISTINCT year, TRUE AS has_files FROM samples WHERE year <> 2000"))
def scan_year_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "reports")
    rows = samples(spark, sf_dir, names=False, states=False).select("year", "stn_code")
    rows.hint("rebalance", "year").write.partitionBy("year").text(path)
    return (
        files.scan_year_partitions(spark, path, "*.txt", exclude_years=[2000])
        .groupBy("year").agg((F.sum("length") > 0).alias("has_files"))
    )


@query("scan_page_rows", Q.on_pages(
    f"SELECT path, file_name, year, page_no, page_text, table_no, row_no, {Q.CELLS_TEXT} AS cells FROM page_rows"))
def scan_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "page-rows")
    page_rows(spark, sf_dir).select(*S.PAGE_ROW.fieldNames()).write.parquet(path)
    return files.scan_page_rows(spark, path).withColumn(
        "cells", F.array_join("cells", "|", "<null>"))


@query("scan_text_whole", "SELECT item_id, text FROM benchmark")
def scan_text_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text as a file of its own."""
    path = new_path(spark, "texts")
    table(spark, sf_dir, "benchmark").hint("rebalance", "item_id").write.partitionBy(
        "item_id").text(path)
    return files.scan_text_whole(spark, path).select(
        F.regexp_extract("source", r"item_id=(\d+)", 1).cast("bigint").alias("item_id"),
        F.regexp_replace("text", r"\n\z", "").alias("text"),
    )


CACHE_SQL = """cache AS (
SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS monitoring_location,
  'NATION_' || CAST(p_partkey % 25 AS VARCHAR) AS state,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 8 + (p_partkey % 290) * 0.1::DOUBLE END AS lat,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 68 + (p_partkey % 290) * 0.1::DOUBLE END AS lng,
  p_type AS query, p_size % 4 <> 0 AS success FROM part)"""


def geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache entries over ``part``: one per station name, a quarter of them without a hit."""
    part = table(spark, sf_dir, "part")
    hit = F.col("p_size") % 4 != 0
    step = (F.col("p_partkey") % 290) * 0.1
    return part.select(
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("monitoring_location"),
        F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("state"),
        F.when(hit, 8 + step).alias("lat"), F.when(hit, 68 + step).alias("lng"),
        F.col("p_type").alias("query"), hit.alias("success"),
    )


@query("scan_json_map", Q.wrap(
    "SELECT monitoring_location, state, lat, lng, query, success FROM cache", CACHE_SQL))
def scan_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache files with one JSON map each, at most a hundred entries per file."""
    entry = F.struct(
        F.concat("monitoring_location", F.lit("|"), "state").alias("key"),
        F.struct("lat", "lng", "query", "success").alias("value"),
    )
    number = F.regexp_extract("monitoring_location", r"(\d+)$", 1).cast("bigint")
    maps = geocode_cache(spark, sf_dir).groupBy(F.floor(number / 100).alias("bucket")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    path = new_path(spark, "geocode-cache")
    maps.hint("rebalance", "bucket").write.partitionBy("bucket").text(path)
    return files.scan_json_map(
        spark, path, S.GEOCODE_CACHE, ["monitoring_location", "state"], r"\|")


@query("validate_filenames", Q.on_pages(
    "SELECT DISTINCT file_name, year FROM page_rows WHERE NOT regexp_full_match(lower(file_name), "
    "replace('(?:wquality_river-data-Y|water_quality_data_of_med_min_river_Y|water_creek_marine_seawater_beach_Y|"
    "water_quality_canals_Y|water_quality_drains_stps_wtps_Y|water_pond_tanks_Y|nwmp_data_Y)\\.pdf', "
    "'Y', CAST(year AS VARCHAR)))"))
def validate_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = page_rows(spark, sf_dir).select("file_name", "year").distinct()
    return names.filter(invalid_report_name(F.col("file_name"), F.col("year")))


@query("sink_per_state_year", Q.on_samples(
    "SELECT replace(lower(state), ' ', '_') AS state_slug, year, count(*) AS n, "
    f"{Q.rnd('sum(k3)', 2)} AS total FROM samples GROUP BY 1, 2"))
def sink_per_state_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "by-state-year")
    files.sink_per_state_year(samples(spark, sf_dir, names=False), path)
    return spark.read.parquet(path).groupBy("state_slug", "year").agg(
        F.count("*").alias("n"), F.round(F.sum("k3"), 2).alias("total"))


@query("sink_csv_flat", "SELECT doc_id, lang, source, text FROM documents")
def sink_csv_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks survive the export."""
    path = new_path(spark, "documents-csv")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    files.sink_csv_flat(docs, path)
    return files.scan_csv_flat(spark, path, "doc_id bigint, lang string, source string, text string")


@query("sink_json_summary", Q.on_samples(
    "SELECT state, count(*) AS unique_locations FROM (SELECT DISTINCT state, monitoring_location FROM samples) "
    "GROUP BY state UNION ALL SELECT NULL, count(*) FROM (SELECT DISTINCT state, monitoring_location FROM samples)"))
def sink_json_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = samples(spark, sf_dir).select("state", "monitoring_location").distinct()
    path = new_path(spark, "summary")
    files.sink_json_summary(stats.manifest_counts(places, "state"), path)
    return spark.read.schema("state string, unique_locations bigint").json(path)


_NEW = "SELECT monitoring_location, state, 0.5::DOUBLE AS lat, lng, 'again' AS query, TRUE AS success FROM cache WHERE NOT success"


@query("cache_upsert", Q.wrap(f"SELECT * FROM cache WHERE success UNION ALL ({_NEW})", CACHE_SQL))
def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = geocode_cache(spark, sf_dir)
    new = old.filter(~F.col("success")).withColumns(
        {"lat": F.lit(0.5), "query": F.lit("again"), "success": F.lit(True)})
    return caches.cache_upsert(old, new, ["monitoring_location", "state"])


@query("cache_store", Q.wrap(f"SELECT * FROM cache WHERE success UNION ALL ({_NEW})", CACHE_SQL))
def cache_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cache kept in hash buckets: all entries, then the failed ones again."""
    old, path = geocode_cache(spark, sf_dir), new_path(spark, "cache-store")
    store.create_store(spark, path, old.schema, ["monitoring_location", "state"])
    store.upsert(spark, path, old)
    failed = store.read_store(spark, path).filter(~F.col("success"))
    store.upsert(spark, path, failed.withColumns({"lat": F.lit(0.5), "query": F.lit("again"), "success": F.lit(True)}))
    return store.read_store(spark, path)


@query("newest_cache_entry", """SELECT event_type, user_id, max(ts) AS ts, arg_max(event_id, row(ts, event_id)) AS event_id,
  arg_max(value, row(ts, event_id)) AS value FROM events GROUP BY event_type, user_id""")
def newest_cache_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id", "value")
    return caches.newest_per_key(events, ["event_type", "user_id"], ["ts"])


@query("source_replace_upsert", """SELECT source, doc_id, text, n FROM (
  SELECT source, doc_id, text, 'old' AS n FROM documents WHERE source NOT IN
    (SELECT source FROM documents WHERE lang = 'de')
  UNION ALL SELECT source, doc_id, upper(lang) AS text, 'new' AS n FROM documents WHERE lang = 'de')""")
def source_replace_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a German text are ingested again."""
    docs = table(spark, sf_dir, "documents")
    old = docs.select("source", "doc_id", "text", F.lit("old").alias("n"))
    new = docs.filter(F.col("lang") == "de").select(
        "source", "doc_id", F.upper("lang").alias("text"), F.lit("new").alias("n"))
    return caches.source_replace_upsert(old, new)


def sample_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A fresh bucketed table of the rows, read back; its buckets grow in number, not in size."""
    name = f"samples_{uuid.uuid4().hex[:12]}"
    managed.create_table(df, name, buckets=managed.buckets_for(df), path=new_path(spark, "managed-samples"))
    return managed.read_table(spark, name)


@query("dataset_cache", Q.on_samples(
    "SELECT water_body_type, year, count(*) AS n FROM samples GROUP BY 1, 2"))
def dataset_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sample_table(spark, samples(spark, sf_dir, names=False, states=False))
    return kept.groupBy("water_body_type", "year").agg(F.count("*").alias("n"))


@query("dataset_cache_latest", Q.on_samples(
    "SELECT stn_code, max(year) AS year, min(year) AS first_year, arg_max(k1, row(year, sampled_at, k1, k2, k3)) AS k1, "
    "list_aggregate(list_sort(list(DISTINCT year)), 'string_agg', ',') AS years FROM samples GROUP BY stn_code"))
def dataset_cache_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row and years of each station, joined on the bucketed table without an exchange."""
    kept = sample_table(spark, samples(spark, sf_dir, names=False, states=False))
    newest = latest.latest_row(kept).select("stn_code", "year", "k1")
    years = latest.available_years(kept).select(
        "stn_code", F.get("available_years", F.lit(0)).alias("first_year"),
        F.array_join(F.col("available_years").cast("array<string>"), ",").alias("years"))
    return newest.join(years, "stn_code")


@query("rescore_files", Q.on_scored(
    f"SELECT stn_code, {_PLACE} AS monitoring_location, state, year, {', '.join(Q.MEASURES)}, pollution_score FROM scored"))
def rescore_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with 0-100 scores become files with 0-10 scores."""
    rows = awkward_places(score.score_100(samples(spark, sf_dir, dealt=True)))
    columns = [*SCAN_COLUMNS, "pollution_score"]
    before, after = new_path(spark, "scores-100"), new_path(spark, "scores-10")
    files.sink_state_year_csv(rows.select(*columns), before, dealt=True)
    files.rescore_files(spark, before, after, columns)
    return files.scan_samples_multi(spark, after, columns).select(
        "stn_code", "monitoring_location", "state", "year", *Q.MEASURES, "pollution_score")


@query("merge_years", Q.on_samples(
    "SELECT stn_code, year, do_avg, CASE WHEN year <> 1996 THEN ph_avg END AS ph_avg, nitrate_avg FROM samples "
    "WHERE year NOT IN (2000, 2001)"))
def merge_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly tables merged; the 1996 table has no pH column, two years are left out."""
    from rivulet.operators.shaping import merge_years as merge

    rows = samples(spark, sf_dir, names=False, states=False).select(
        "stn_code", "year", "do_avg", "ph_avg", "nitrate_avg")
    odd = rows.filter(F.col("year") == 1996).drop("ph_avg")
    rest = rows.filter(F.coalesce(F.col("year") != 1996, F.lit(True)))
    return merge([rest, odd], exclude_years=[2000, 2001])


@query("concat_states", Q.on_samples("SELECT state, count(*) AS n FROM samples GROUP BY state"))
def concat_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several documents (one per water body) under each other, then per state."""
    from rivulet.operators.shaping import concat_states as concat

    rows = samples(spark, sf_dir, names=False)
    kinds = ["River", "Groundwater", "Pond/Tank", "Canal", "Coastal"]
    parts = [rows.filter(F.col("water_body_type") == kind) for kind in kinds]
    return concat(parts).groupBy("state").agg(F.count("*").alias("n"))


@query("state_slug", "SELECT n_name AS state, replace(replace(lower(n_name), ' ', '_'), '&', 'and') AS slug FROM nation")
def state_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("state"), state_slug(F.col("n_name")).alias("slug"))
