"""Column lists and Spark schemas of the sample tables."""

from __future__ import annotations

from pyspark.sql import types as T

KEY_COLUMNS = ["stn_code", "monitoring_location", "water_body_type", "state", "year"]

RIVER_PARAMETERS = [
    "temperature_avg", "do_avg", "ph_avg", "conductivity_avg", "bod_avg", "nitrate_avg",
    "fecal_coliform_avg", "total_coliform_avg", "fecal_streptococci_avg",
]
GROUNDWATER_PARAMETERS = [
    "temperature_avg", "ph_avg", "conductivity_avg", "bod_avg", "nitrate_avg",
    "fecal_coliform_avg", "total_coliform_avg", "total_dissolved_solids_avg", "fluoride_avg",
    "arsenic_avg",
]
ALL_PARAMETERS = RIVER_PARAMETERS + [
    "total_dissolved_solids_avg", "fluoride_avg", "arsenic_avg",
]

EXTRACTED_COLUMNS = KEY_COLUMNS + ALL_PARAMETERS
CLEAN_COLUMNS = KEY_COLUMNS + [
    "safety_label", "pollution_score", "violated_params",
] + RIVER_PARAMETERS
GEOCODED_COLUMNS = CLEAN_COLUMNS + ["latitude", "longitude", "geocode_query", "geocoded"]

SCORED_PARAMETERS = ["ph_avg", "do_avg", "bod_avg", "nitrate_avg", "fecal_coliform_avg"]

# Order inside a station: year first, then a total tie-break.
SAMPLE_ORDER = ["year", "sampled_at", "k1", "k2", "k3"]

_TYPES = {
    "year": T.IntegerType(),
    "geocoded": T.BooleanType(),
    "pollution_score": T.DoubleType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
}


def column_type(name: str) -> T.DataType:
    """Type of a sample column: measures are doubles, the rest is text unless listed."""
    if name.endswith("_avg"):
        return T.DoubleType()
    return _TYPES.get(name, T.StringType())


def sample_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c), True) for c in columns])


EXTRACTED = sample_schema(EXTRACTED_COLUMNS)
CLEAN = sample_schema(CLEAN_COLUMNS)
GEOCODED = sample_schema(GEOCODED_COLUMNS)

PAGE_ROW = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("page_text", T.StringType()),
    T.StructField("table_no", T.IntegerType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

GEOCODE_CACHE = "map<string, struct<lat: double, lng: double, query: string, success: boolean>>"
INSIGHT_CACHE = (
    "map<string, struct<station_name: string, water_body_type: string, "
    "violated_params: array<string>, causes_of_pollution: array<string>, "
    "recommended_measures: array<string>, retrieved_context_count: int>>"
)
