"""Detection of layout, water body and state in page rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.text import contains_any, first_type, normalize_alpha


def row_text(cells: Column) -> Column:
    """Lower-case text of a row's non-empty cells."""
    return F.lower(F.array_join(F.array_remove(cells, ""), " "))


def is_heading(text: Column) -> Column:
    """True for the row text of a heading: it holds a heading text or pattern."""
    found = contains_any(text, R.HEADING_TEXTS)
    for pattern in R.HEADING_PATTERNS:
        found = found | text.rlike(pattern)
    return found


def compact_cells(cells: Column) -> Column:
    """Missing cells removed; empty texts stay."""
    return F.filter(cells, lambda c: c.isNotNull())


def detect_schema(page_text: Column, has_type_column: Column) -> Column:
    """'coastal', 'groundwater' or 'river' table layout of a page."""
    text = F.upper(F.coalesce(page_text, F.lit("")))
    by_type = F.when(has_type_column, "coastal").otherwise("river")
    return (
        F.when(F.contains(text, F.lit(R.COASTAL_HEADING)), "coastal")
        .when(contains_any(text, R.GROUNDWATER_MARKERS), "groundwater")
        .when(contains_any(text, R.COASTAL_MARKERS), "coastal")
        .when(contains_any(text, R.CANAL_MARKERS), "river")
        .when(contains_any(text, R.DRAIN_MARKERS), by_type)
        .when(contains_any(text, R.RIVER_MARKERS), "river")
        .otherwise(by_type)
    )


def detect_water_body(path: Column, page_text: Column, layout: Column) -> Column:
    """Water body type: by layout, then page text, then file name."""
    text = F.coalesce(page_text, F.lit(""))
    return F.when(layout == "groundwater", "Groundwater").when(
        layout == "coastal", "Coastal"
    ).otherwise(F.coalesce(
        first_type(text, R.PAGE_TEXT_TYPES),
        first_type(path, R.FILE_NAME_TYPES),
        F.when(layout == "river", F.lit("River")),
        first_type(path, R.FALLBACK_FILE_TYPES),
        F.lit("Other"),
    ))


def has_type_column(file_name: Column) -> Column:
    return F.contains(F.lower(file_name), F.lit(R.TYPE_COLUMN_FILE_HINT))


def _letters(state: str) -> str:
    return "".join(ch for ch in state.upper() if ch.isascii() and ch.isalnum())


def _ranked(states: Sequence[str]) -> dict[str, str]:
    """Letters -> state, longest first, then by name: independent of the order of the list."""
    ranked: dict[str, str] = {}
    for state in sorted(states, key=lambda s: (-len(_letters(s)), -len(s), s)):
        ranked.setdefault(_letters(state), state)
    return ranked


def _state_pattern(states: Sequence[str], between: str = "") -> str:
    """Letters of any state, with ``between`` allowed after each; the look-ahead skips digits and other letters cheaply."""
    letters = list(_ranked(states))
    initials = "".join(sorted({text[0] for text in letters}))
    return f"(?=[{initials}])(?:{'|'.join(between.join(text) for text in letters)})"


def names_state(cell: Column, states: Sequence[str] = R.STATES) -> Column:
    """True when a cell names a state in any of the accepted ways."""
    return F.coalesce(normalize_alpha(cell).rlike(_state_pattern(states)), F.lit(False))


def state_of_text(upper: Column, letters: Column, states: Sequence[str] = R.STATES) -> Column:
    """State named by a cell, given its stripped upper-case text and its letters.

    Tried in turn: exact text, text with single spaces, and a state whose letters and digits are
    contained in those of the cell; the longest such state wins. NULL when there is none.
    """
    ranked = _ranked(states)
    single = F.regexp_replace(upper, r"(?U)\s+", " ")
    contained = F.lit(None).cast("string")
    for text, state in reversed(ranked.items()):
        contained = F.when(F.contains(letters, F.lit(text)), F.lit(state)).otherwise(contained)
    return F.coalesce(F.when(upper.isin(*states), upper), F.when(single.isin(*states), single), contained)


# Separates the cells of a row that is searched as one text.
CELL_MARK = "\x01"


def row_upper(cells: Column) -> Column:
    """Upper-case text of all cells, with a mark between cells."""
    return F.upper(F.array_join(cells, CELL_MARK, ""))


def row_letters(upper: Column) -> Column:
    """A row's upper-case text without the characters beyond ASCII that would shift positions.

    Texts of ASCII characters alone stay as they are: the search skips what is no letter or digit, which
    costs far less than taking it out of every row.
    """
    plain = F.octet_length(upper) == F.length(upper)
    return F.when(plain, upper).otherwise(F.regexp_replace(upper, f"[^A-Z0-9{CELL_MARK}]+", ""))


def before_state(letters: Column, states: Sequence[str] = R.STATES) -> Column:
    """Row text in front of the first state, NULL when no state is named.

    All accepted ways imply that a cell contains the letters of a state, so one search over the
    row finds the first cell that names one.
    """
    skipped = f"[^A-Z0-9{CELL_MARK}]*+"
    at = F.nullif(F.regexp_instr(letters, F.lit(_state_pattern(states, skipped))), F.lit(0))
    return F.substring(letters, F.lit(1), at - 1)


def cell_position(before: Column) -> Column:
    """Number of cells ended in a part of the row letters."""
    return F.length(before) - F.length(F.replace(before, F.lit(CELL_MARK), F.lit("")))


def invalid_report_name(file_name: Column, year: Column) -> Column:
    """True when a report file name does not fit one of the accepted patterns for its year."""
    pattern = F.concat(
        F.lit("(?i)^(?:" + "|".join(
            p.replace("{year}", "@YEAR@") for p in R.REPORT_FILE_PATTERNS) + ")$"),
    )
    with_year = F.replace(pattern, F.lit("@YEAR@"), year.cast("string"))
    return ~F.coalesce(F.regexp_like(file_name, with_year), F.lit(False))
