"""SQL building blocks of the oracle queries."""

from __future__ import annotations

from rivulet import rules as R
from rivulet.functions.numbers import PLAIN_NUMBER
from rivulet.sources.tables import PAGE_FILES, PAGE_STATES, PAGE_TEXTS


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding of the written decimal digits, the rule Spark applies to doubles."""
    return (f"CAST(ROUND(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def rnd_mean(expression: str, digits: int) -> str:
    """Rounding in two steps, so that a mean on a tie does not depend on the order of its sum."""
    return rnd(rnd(expression, digits + 4), digits)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def contains_any(expression: str, words) -> str:
    return "(" + " OR ".join(f"contains({expression}, {text(w)})" for w in words) + ")"


def number(expression: str) -> str:
    """Number of a cell text, NULL when it is none."""
    stripped = f"trim({expression}, ' ' || chr(9) || chr(10) || chr(13))"
    return (f"CASE WHEN regexp_full_match({stripped}, {text(PLAIN_NUMBER)}) "
            f"THEN TRY_CAST({stripped} AS DOUBLE) END")


SAMPLES = """samples AS (
SELECT CAST(l.l_partkey AS VARCHAR(20)) AS stn_code,
  p.p_name || ' ' || CAST(l.l_partkey AS VARCHAR(20)) AS monitoring_location,
  CASE l.l_partkey % 5 WHEN 0 THEN 'River' WHEN 1 THEN 'Groundwater' WHEN 2 THEN 'Pond/Tank'
       WHEN 3 THEN 'Canal' ELSE 'Coastal' END AS water_body_type,
  n.n_name AS state, CAST(YEAR(l.l_shipdate) AS INT) AS year, l.l_shipdate AS sampled_at,
  l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_extendedprice AS k3,
  15 + l.l_quantity * 0.4 AS temperature_avg,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE 3 + l.l_quantity * 0.14 END AS do_avg,
  CASE WHEN l.l_orderkey % 11 = 0 THEN NULL ELSE 6.3 + l.l_tax * 30 END AS ph_avg,
  l.l_extendedprice / 20 AS conductivity_avg,
  CASE WHEN l.l_linenumber = 3 THEN NULL ELSE l.l_discount * 30 END AS bod_avg,
  CASE WHEN l.l_orderkey % 7 = 0 THEN NULL ELSE l.l_quantity * 0.25 END AS nitrate_avg,
  CASE WHEN l.l_linenumber = 5 THEN NULL WHEN l.l_linenumber <= 2 THEN l.l_extendedprice / 2000
       ELSE l.l_extendedprice / 50 END AS fecal_coliform_avg,
  CASE WHEN l.l_orderkey % 5 = 0 THEN NULL ELSE l.l_extendedprice / 10 END AS total_coliform_avg,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE 8 + (l.l_partkey % 290) * 0.1::DOUBLE END AS latitude,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE 68 + (l.l_partkey % 290) * 0.1::DOUBLE END AS longitude
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

MEASURES = [
    "temperature_avg", "do_avg", "ph_avg", "conductivity_avg", "bod_avg", "nitrate_avg",
    "fecal_coliform_avg", "total_coliform_avg",
]

PARTS_10 = """parts_10 AS (
SELECT *,
  CASE WHEN ph_avg < 6.5 THEN (6.5 - ph_avg) / 6.5
       WHEN ph_avg > 8.5 THEN least((ph_avg - 8.5) / 8.5, 1.0) WHEN ph_avg IS NOT NULL THEN 0.0 END AS c_ph,
  CASE WHEN do_avg >= 6 THEN 0.0 WHEN do_avg IS NOT NULL THEN least((6.0 - do_avg) / 6.0, 1.0) END AS c_do,
  CASE WHEN bod_avg <= 2 THEN 0.0 WHEN bod_avg IS NOT NULL THEN least((bod_avg - 2.0) / 2.0, 1.0) END AS c_bod,
  CASE WHEN nitrate_avg <= 10 THEN 0.0 WHEN nitrate_avg IS NOT NULL
       THEN least((nitrate_avg - 10.0) / 10.0, 1.0) END AS c_nit,
  CASE WHEN fecal_coliform_avg <= 50 THEN 0.0 WHEN fecal_coliform_avg IS NOT NULL
       THEN sqrt(least(log2(fecal_coliform_avg / 50.0) / log2(100.0), 1.0)) END AS c_fc
FROM samples)"""

SCORED = PARTS_10 + """, weighed AS (
SELECT *, CAST(0 AS DOUBLE) + CASE WHEN c_ph IS NULL THEN 0 ELSE 0.1::DOUBLE END
  + CASE WHEN c_do IS NULL THEN 0 ELSE 0.2::DOUBLE END
  + CASE WHEN c_bod IS NULL THEN 0 ELSE 0.25::DOUBLE END
  + CASE WHEN c_nit IS NULL THEN 0 ELSE 0.15::DOUBLE END
  + CASE WHEN c_fc IS NULL THEN 0 ELSE 0.3::DOUBLE END AS w FROM parts_10),
scored AS (
SELECT * EXCLUDE (c_ph, c_do, c_bod, c_nit, c_fc, w),
  round((greatest(c_ph, c_do, c_bod, c_nit, c_fc) * 0.6
   + (coalesce(c_ph * (0.1::DOUBLE / w), 0) + coalesce(c_do * (0.2::DOUBLE / w), 0)
    + coalesce(c_bod * (0.25::DOUBLE / w), 0) + coalesce(c_nit * (0.15::DOUBLE / w), 0)
    + coalesce(c_fc * (0.3::DOUBLE / w), 0)) * 0.4) * 10, 3) AS pollution_score,
  concat_ws(', ', CASE WHEN ph_avg < 6.5 OR ph_avg > 8.5 THEN 'pH' END, CASE WHEN do_avg < 6 THEN 'DO' END,
    CASE WHEN bod_avg > 2 THEN 'BOD' END, CASE WHEN nitrate_avg > 10 THEN 'Nitrate' END,
    CASE WHEN fecal_coliform_avg > 50 THEN 'Fecal Coliform' END) AS violated_params,
  CASE WHEN coalesce(ph_avg < 6.5 OR ph_avg > 8.5, FALSE) OR coalesce(do_avg < 6, FALSE)
    OR coalesce(bod_avg > 2, FALSE) OR coalesce(nitrate_avg > 10, FALSE)
    OR coalesce(fecal_coliform_avg > 50, FALSE) THEN 'Unsafe' ELSE 'Safe' END AS safety_label
FROM weighed)"""


def bis_label() -> str:
    return ("CASE WHEN coalesce(do_avg < 5, FALSE) OR coalesce(ph_avg < 6.5 OR ph_avg > 8.5, FALSE) "
            "OR coalesce(bod_avg > 3, FALSE) OR coalesce(fecal_coliform_avg > 500, FALSE) "
            "OR coalesce(total_coliform_avg > 2500, FALSE) THEN 'Unsafe' ELSE 'Safe' END")


def bis_violations() -> str:
    return ("coalesce(nullif(concat_ws(', ', CASE WHEN do_avg < 5 THEN 'Low DO' END, "
            "CASE WHEN ph_avg < 6.5 OR ph_avg > 8.5 THEN 'pH Out of Range' END, "
            "CASE WHEN bod_avg > 3 THEN 'High BOD' END, "
            "CASE WHEN fecal_coliform_avg > 500 THEN 'High Fecal Coliform' END, "
            "CASE WHEN total_coliform_avg > 2500 THEN 'High Total Coliform' END), ''), 'None')")


def bis_score() -> str:
    parts = [
        "CASE WHEN do_avg IS NOT NULL THEN greatest((5.0 - do_avg) / 5.0, 0.0) * 100 END",
        "CASE WHEN bod_avg IS NOT NULL THEN least(bod_avg / 3.0 * 33.3, 100.0) END",
        "CASE WHEN ph_avg < 6.5 THEN (6.5 - ph_avg) / 6.5 * 100 WHEN ph_avg > 8.5 "
        "THEN (ph_avg - 8.5) / 8.5 * 100 WHEN ph_avg IS NOT NULL THEN 0.0 END",
        "CASE WHEN fecal_coliform_avg IS NOT NULL THEN least(fecal_coliform_avg / 500.0 * 10, 100.0) END",
        "CASE WHEN total_coliform_avg IS NOT NULL THEN least(total_coliform_avg / 2500.0 * 10, 100.0) END",
    ]
    total = "CAST(0 AS DOUBLE) + " + " + ".join(f"coalesce({p}, 0.0::DOUBLE)" for p in parts)
    count = " + ".join(f"CASE WHEN ({p}) IS NULL THEN 0 ELSE 1 END" for p in parts)
    return f"coalesce({rnd(f'least(({total}) / nullif({count}, 0), 100.0)', 2)}, 0.0)"


ORDER = "row(year, sampled_at, k1, k2, k3)"


def last_known(columns) -> str:
    return ", ".join(
        f"arg_max({c}, {ORDER}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in columns)


LATEST_COLUMNS = ["year", "monitoring_location", "water_body_type", "pollution_score",
                  "safety_label", "violated_params", "latitude", "longitude", *MEASURES]
LATEST = f"latest AS (SELECT stn_code, {last_known(LATEST_COLUMNS)} FROM scored GROUP BY stn_code)"
STATION_YEAR = ("station_year AS (SELECT year, stn_code, "
                f"{last_known(['pollution_score', 'safety_label'])} FROM scored GROUP BY year, stn_code)")
LATEST_ROW = ("latest_row AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY stn_code "
              "ORDER BY year DESC, sampled_at DESC, k1 DESC, k2 DESC, k3 DESC) = 1)")
LATEST_YEAR_ROW = ("latest_year_row AS (SELECT * FROM scored QUALIFY row_number() OVER "
                   "(PARTITION BY stn_code, year ORDER BY sampled_at DESC, k1 DESC, k2 DESC, k3 DESC) = 1)")

# Yearly series in millionths and lines, as whole-number sums.
SERIES = """series AS (
SELECT stn_code, year, CAST(round(CAST(sum(CAST(round(pollution_score * 1000000) AS BIGINT)) AS DOUBLE)
  / count(pollution_score)) AS BIGINT) AS y
FROM scored WHERE pollution_score IS NOT NULL GROUP BY stn_code, year)"""


def lines(source: str, inside: str | None = None, more: str = "") -> str:
    """Line sums and fitted line per station over a series table."""
    keep = f" FILTER (WHERE {inside})" if inside else ""

    def total(term: str, name: str) -> str:
        return f"CAST(coalesce(sum(CAST({term} AS BIGINT)){keep}, 0) AS DOUBLE) AS {name}"

    sums = ", ".join([
        total("1", "n"), total("year - 2000", "sx"), total("(year - 2000) * (year - 2000)", "sxx"),
        total("y", "sy"), total("(year - 2000) * y", "sxy"), total("y * y", "syy")])
    return f"""sums AS (SELECT stn_code, {sums}, max(year) AS last_year, arg_max(y, year) AS last_y{more}
FROM {source} GROUP BY stn_code),
spreads AS (SELECT *, nullif(n * sxx - sx * sx, 0) AS spread, n * sxy - sx * sy AS crossed FROM sums),
lines AS (SELECT *, crossed / spread AS slope, (sxx * sy - sx * sxy) / spread AS intercept,
  CASE WHEN n = 2 THEN 0.0::DOUBLE ELSE sqrt(greatest(((n * syy - sy * sy) - crossed * crossed / spread) / n,
    0.0::DOUBLE) / n) END AS sigma FROM spreads)"""


def _pick(values, expression: str) -> str:
    return f"({texts(values)})[CAST({expression} % {len(values)} AS INT) + 1]"


def _whole(expression: str) -> str:
    return f"CAST(CAST(trunc({expression}) AS INTEGER) AS VARCHAR)"


_CELLS = [
    _whole("l_partkey"), "' Site' || chr(10) || ' ' || CAST(l_partkey AS VARCHAR)",
    "CASE WHEN l_orderkey % 3 = 0 THEN 'Beach' END", _pick(PAGE_STATES, "l_suppkey"),
    _whole("l_quantity + 10"), _whole("l_quantity + 13"),
    f"CASE WHEN l_linenumber = 2 THEN '-' ELSE {_whole('l_quantity / 10')} END", _whole("l_quantity / 8"),
    "CASE WHEN l_linenumber = 3 THEN 'N/A' ELSE '7.1' END",
    "CASE WHEN l_orderkey % 40 = 0 THEN '29' ELSE '7.9' END",
    _whole("l_extendedprice / 20"),
    f"CASE WHEN l_linenumber = 4 THEN NULL ELSE {_whole('l_extendedprice / 18')} END",
    "'2.25'", _whole("l_quantity / 5"), "' 1 '", _whole("l_quantity / 7"),
    _whole("l_extendedprice / 50"),
    f"CASE WHEN l_linenumber = 5 THEN 'abc' ELSE {_whole('l_extendedprice / 40')} END",
    _whole("l_extendedprice"), "'1e3'", "'2'", "CASE WHEN l_linenumber <> 6 THEN '4' END",
]

PAGE_ROWS = f"""page_rows AS (
SELECT '/reports/' || CAST(year AS VARCHAR) || '/' || file_name AS path, * FROM (
SELECT replace({_pick(PAGE_FILES, 'l_partkey')}, '{{}}', CAST(YEAR(l_shipdate) AS VARCHAR)) AS file_name,
  CAST(YEAR(l_shipdate) AS INT) AS year, CAST(l_orderkey % 100 AS INT) AS page_no,
  {_pick(PAGE_TEXTS, 'l_orderkey')} AS page_text, 1 AS table_no, CAST(l_linenumber AS INT) AS row_no,
  CASE WHEN l_orderkey % 20 = 0 THEN ['Stn Code', 'Monitoring Location', 'State Name', 'Min', 'Max']
       ELSE [{', '.join(_CELLS)}] END AS cells,
  l_orderkey AS k1, l_linenumber AS k2, l_extendedprice AS k3, l_partkey AS k4 FROM lineitem))"""

CELLS_TEXT = "array_to_string(list_transform(cells, lambda c: coalesce(c, '<null>')), '|')"

_HEADING = "|".join(f"(?:{p})" for p in R.HEADING_TEXTS + R.HEADING_PATTERNS)


def is_heading(cells: str = "cells") -> str:
    joined = f"lower(array_to_string(list_filter({cells}, lambda c: c IS NOT NULL AND c <> ''), ' '))"
    return f"regexp_matches({joined}, {text(_HEADING)})"


def layout(page_text: str = "page_text", typed: str = "contains(lower(file_name), 'creek_marine')") -> str:
    t = f"upper(coalesce({page_text}, ''))"
    by_type = f"CASE WHEN {typed} THEN 'coastal' ELSE 'river' END"
    return (f"CASE WHEN contains({t}, {text(R.COASTAL_HEADING)}) THEN 'coastal' "
            f"WHEN {contains_any(t, R.GROUNDWATER_MARKERS)} THEN 'groundwater' "
            f"WHEN {contains_any(t, R.COASTAL_MARKERS)} THEN 'coastal' "
            f"WHEN {contains_any(t, R.CANAL_MARKERS)} THEN 'river' "
            f"WHEN {contains_any(t, R.DRAIN_MARKERS)} THEN {by_type} "
            f"WHEN {contains_any(t, R.RIVER_MARKERS)} THEN 'river' ELSE {by_type} END")


def body_type(path: str, page_text: str, layout_column: str) -> str:
    def first(expression: str, rules) -> str:
        cases = " ".join(f"WHEN {contains_any(f'lower({expression})', words)} THEN {text(label)}"
                         for label, words in rules)
        return f"CASE {cases} END"

    return (f"CASE {layout_column} WHEN 'groundwater' THEN 'Groundwater' WHEN 'coastal' THEN 'Coastal' ELSE "
            f"coalesce({first(page_text, R.PAGE_TEXT_TYPES)}, {first(path, R.FILE_NAME_TYPES)}, "
            f"CASE WHEN {layout_column} = 'river' THEN 'River' END, "
            f"{first(path, R.FALLBACK_FILE_TYPES)}, 'Other') END")


_ALPHA = "regexp_replace(upper({}), '[^A-Z0-9]', '', 'g')"

# State of every distinct cell text: exact, single-spaced, letters equal, letters contained.
CELL_STATES = f"""state_list AS (
SELECT state, {_ALPHA.format('state')} AS letters FROM (SELECT unnest({texts(R.STATES)}) AS state)),
cell_texts AS (SELECT cell, upper(trim(cell, ' ' || chr(10))) AS u, {_ALPHA.format('cell')} AS letters
  FROM (SELECT DISTINCT unnest(cells) AS cell FROM page_rows) WHERE cell IS NOT NULL),
cell_matches AS (
SELECT c.cell, s.state, s.letters, CASE WHEN c.u = s.state THEN 1
  WHEN trim(regexp_replace(c.u, '\\s+', ' ', 'g')) = s.state THEN 2
  WHEN c.letters = s.letters THEN 3 WHEN contains(c.letters, s.letters) THEN 4 END AS class
FROM cell_texts c, state_list s),
cell_states AS (
SELECT cell, state FROM cell_matches WHERE class IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cell ORDER BY class, length(letters) DESC, length(state) DESC, state) = 1)"""


def wrap(body: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def on_samples(body: str, *ctes: str) -> str:
    return wrap(body, SAMPLES, *ctes)


def on_scored(body: str, *ctes: str) -> str:
    return wrap(body, SAMPLES, SCORED, *ctes)


def on_pages(body: str, *ctes: str) -> str:
    return wrap(body, PAGE_ROWS, *ctes)
