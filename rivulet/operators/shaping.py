"""Row filters, projections and column shaping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet import schema as S
from rivulet.functions.geo import valid_coordinate
from rivulet.functions.numbers import (
    finite, mean_of_pair, to_double, to_doubles, to_int, to_text,
)
from rivulet.functions.text import strip


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row.

    Later filters and projections would otherwise repeat a costly expression each time they name
    it. The optimizer does not move them below a generator, so the values pass through one.
    """
    kept = [c for c in df.columns if c not in columns]
    computed = df.select(*kept, *[value.alias(name) for name, value in columns.items()])
    return computed.select(*kept, F.inline(F.array(F.struct(*columns))))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all given columns are known; plain tests that reach the file scan."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def bind_pairs(
    df: DataFrame, values: Column, count: int, complete_pairs: Column | bool = False
) -> DataFrame:
    """Adds _avg0, _avg1, ...: averages of the min/max pairs of a flat array of cells.

    The cells are parsed as one array: a column for each cell grows into a method too large for the
    JVM to compile. With ``complete_pairs`` a trailing single value is ignored.
    """
    parsed = bind(df, _numbers=to_doubles(values))
    ignore = F.lit(complete_pairs) if isinstance(complete_pairs, bool) else complete_pairs
    means = {}
    for i in range(count):
        low, high = F.get("_numbers", F.lit(2 * i)), F.get("_numbers", F.lit(2 * i + 1))
        mean = mean_of_pair(low, high)
        means[f"_avg{i}"] = F.when(~ignore | (F.size("_numbers") > 2 * i + 1), mean)
    return bind(parsed, **means).drop("_numbers")


def pairwise_param_avgs(
    df: DataFrame, values: str, names: Sequence[str], complete_pairs: bool = False
) -> DataFrame:
    """Adds the named averages of a flat min/max array column."""
    bound = bind_pairs(df, F.col(values), len(names), complete_pairs)
    named = {name: F.col(f"_avg{i}") for i, name in enumerate(names)}
    return bound.withColumns(named).drop(*[f"_avg{i}" for i in range(len(names))])


def drop_invalid_rows(df: DataFrame) -> DataFrame:
    """Rows with a state, a location and a possible pH; an unknown pH is kept."""
    return df.filter(
        F.col("state").isNotNull() & (F.coalesce("monitoring_location", F.lit("")) != "")
    ).filter(F.col("ph_avg").isNull() | (F.col("ph_avg") <= 14))


def drop_all_null_params(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=[c for c in df.columns if c.endswith("_avg")])


def project_known_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in order if c in df.columns])


def ensure_columns(df: DataFrame, required: Sequence[str] = S.SCORED_PARAMETERS) -> DataFrame:
    """Adds missing measures as NULL."""
    missing = {c: F.lit(None).cast("double") for c in required if c not in df.columns}
    return df.withColumns(missing) if missing else df


def require_columns(df: DataFrame, required: Sequence[str] = S.SCORED_PARAMETERS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))
    return df


def filter_samples(
    df: DataFrame, year: int | None = None, water_body_type: str | None = None,
    safety_label: str | None = None,
) -> DataFrame:
    """Exact filters; an argument left out does not filter."""
    for column, wanted in (("water_body_type", water_body_type), ("safety_label", safety_label)):
        if wanted:
            df = df.filter(F.col(column) == wanted)
    return df if year is None else df.filter(F.col("year") == year)


def filter_type_ci(df: DataFrame, water_body_type: str | None) -> DataFrame:
    if not water_body_type:
        return df
    wanted = water_body_type.strip().lower()
    return df.filter(F.lower(strip("water_body_type")) == wanted)


def filter_station(df: DataFrame, station: str | int) -> DataFrame:
    return df.filter(strip(F.col("stn_code").cast("string")) == str(station).strip())


def drop_missing_coords(df: DataFrame) -> DataFrame:
    return not_null(df, "latitude", "longitude")


def valid_coordinates(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """Rows that can be placed on a map, their coordinates as numbers."""
    return df.filter(
        F.col(key).isNotNull() & valid_coordinate(F.col(lat), F.col(lon))
    ).withColumns({lat: to_double(F.col(lat)), lon: to_double(F.col(lon))})


def drop_excluded_years(df: DataFrame, years: Iterable[int]) -> DataFrame:
    excluded = list(years)
    return df.filter(~F.col("year").isin(excluded)) if excluded else df


def train_test_split_year(df: DataFrame, cut: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut year, and rows of the year after it."""
    return df.filter(F.col("year") <= cut), df.filter(F.col("year") == cut + 1)


def type_coerce(
    df: DataFrame, doubles: Sequence[str] = (), ints: Sequence[str] = (), texts: Sequence[str] = ()
) -> DataFrame:
    """Columns brought to their types; text that is no number becomes NULL."""
    numeric = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}
    casts = {c: finite(F.col(c)) if c in numeric else to_double(F.col(c)) for c in doubles}
    casts |= {c: to_int(F.col(c)) for c in ints}
    casts |= {c: to_text(F.col(c)) for c in texts}
    return df.withColumns(casts)


def merge_years(frames: Sequence[DataFrame], exclude_years: Iterable[int] = ()) -> DataFrame:
    """Yearly tables under each other; columns a table lacks are NULL."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return drop_excluded_years(merged, exclude_years)


def concat_states(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several documents under each other, grouped by their state column."""
    return reduce(DataFrame.unionByName, frames)
