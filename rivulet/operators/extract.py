"""Decoded page rows to samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet import schema as S
from rivulet.functions import detect as D
from rivulet.functions.text import collapse_ws, normalize_alpha, strip
from rivulet.operators.shaping import bind, bind_pairs, drop_all_null_params, drop_invalid_rows


def skip_header_rows(rows: DataFrame) -> DataFrame:
    """Table rows without headings."""
    named = bind(rows, _text=D.row_text(F.col("cells")))
    return named.filter(~D.is_heading(F.col("_text"))).drop("_text")


def compact_cells(rows: DataFrame) -> DataFrame:
    """Missing cells removed; rows with fewer than four cells left out."""
    return rows.withColumn("cells", D.compact_cells(F.col("cells"))).filter(F.size("cells") >= 4)


def with_layout(rows: DataFrame) -> DataFrame:
    """Adds the page's table layout and water body type."""
    texts = bind(rows, _page=F.upper(F.coalesce("page_text", F.lit(""))))
    layout = D.detect_schema(F.col("_page"), D.has_type_column(F.col("file_name")))
    lowered = bind(texts, layout=layout, _page=F.lower("page_text"), _path=F.lower("path"))
    body = D.detect_water_body(F.col("_path"), F.col("_page"), F.col("layout"))
    return bind(lowered, water_body_type=body).drop("_page", "_path")


def with_state(rows: DataFrame) -> DataFrame:
    """Adds the state of the first cell that names one."""
    upper = bind(rows, _upper=D.row_upper(F.col("cells")))
    joined = bind(upper, _letters=D.row_letters(F.col("_upper"))).drop("_upper")
    found = bind(joined, _before=D.before_state(F.col("_letters")))
    cell = bind(found, _cell=F.get("cells", D.cell_position(F.col("_before"))))
    text = bind(cell, _upper=F.upper(strip("_cell")), _letters=normalize_alpha(F.col("_cell")))
    state = F.when(F.col("_cell").isNotNull(),
                   D.state_of_text(F.col("_upper"), F.col("_letters")))
    return bind(text, state=state).drop("_letters", "_before", "_cell", "_upper")


def parse_rows_by_schema(rows: DataFrame) -> DataFrame:
    """Cells placed into named averages by the layout of their page.

    River and groundwater rows hold code, location, an optional state, then min/max pairs; coastal
    rows hold the water body type before the optional state. River rows ignore a lone last value.
    Input: compact cells with layout and water_body_type.
    """
    coastal = F.col("layout") == "coastal"
    cells, first = F.col("cells"), F.when(coastal, 3).otherwise(2)
    has_state = D.names_state(F.get(cells, first))
    values = F.slice(cells, first + F.when(has_state, 2).otherwise(1), F.size(cells))
    count = len(S.GROUNDWATER_PARAMETERS)
    bound = bind_pairs(rows, values, count, F.col("layout") == "river")

    def position(names: list[str], name: str) -> Column:
        if name not in names:
            return F.lit(None).cast("double")
        return F.col(f"_avg{names.index(name)}")

    own_type = F.nullif(strip(F.get(cells, F.lit(2))), F.lit(""))
    return bound.withColumns({
        "stn_code": strip(F.get(cells, F.lit(0))),
        "monitoring_location": collapse_ws(F.get(cells, F.lit(1))),
        "water_body_type": F.when(coastal, F.coalesce(own_type, F.col("water_body_type")))
        .otherwise(F.col("water_body_type")),
        **{
            name: F.when(F.col("layout") == "groundwater", position(S.GROUNDWATER_PARAMETERS, name))
            .otherwise(position(S.RIVER_PARAMETERS, name))
            for name in S.ALL_PARAMETERS
        },
    }).drop(*[f"_avg{i}" for i in range(count)])


def extract_samples(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Page rows to extracted samples, without any shuffle."""
    parsed = parse_rows_by_schema(with_state(compact_cells(with_layout(skip_header_rows(rows)))))
    samples = drop_invalid_rows(parsed).select(*S.EXTRACTED_COLUMNS, *(keep or []))
    return drop_all_null_params(samples)
