"""Queries over scalar functions and the page-row parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.functions import detect as D
from rivulet.functions import geo, numbers, replies, scoring, text
from rivulet.functions import violations as V
from rivulet.operators import explain, extract, knowledge, latest, score
from rivulet.operators.shaping import pairwise_param_avgs as pairwise
from rivulet.plans import ctes as Q
from rivulet.plans.registry import query
from rivulet.sources.tables import page_rows, samples, station_names, table

ROW = ["k1", "k2", "k3", "k4"]
_ROW = ", ".join(ROW)
KEY = ["stn_code", "k1", "k2", "k3"]
_KEY = ", ".join(KEY)


@query("safe_float", Q.on_pages(
    f"SELECT cell, {Q.number('cell')} AS value, count(*) AS n FROM (SELECT unnest(cells) AS cell FROM page_rows) "
    "GROUP BY cell"))
def safe_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = page_rows(spark, sf_dir).select(F.explode("cells").alias("cell"))
    return cells.groupBy("cell").agg(F.count("*").alias("n")).withColumn(
        "value", numbers.safe_float(F.col("cell")))


def minmax_sql(low: str, high: str) -> str:
    a, b = Q.number(low), Q.number(high)
    mean = Q.rnd(f"(({a}) + ({b})) / 2", 4)
    return f"CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN {mean} ELSE coalesce({a}, {b}) END"


@query("minmax_avg", Q.on_pages(
    f"SELECT {_ROW}, {minmax_sql('cells[7]', 'cells[8]')} AS do_avg, {minmax_sql('cells[11]', 'cells[12]')} AS con_avg, "
    f"{minmax_sql('cells[17]', 'cells[18]')} AS fec_avg FROM page_rows"))
def minmax_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pair(i: int):
        return numbers.minmax_avg(F.get("cells", F.lit(i)), F.get("cells", F.lit(i + 1)))

    return page_rows(spark, sf_dir).select(
        *ROW, pair(6).alias("do_avg"), pair(10).alias("con_avg"), pair(16).alias("fec_avg"))


@query("pairwise_param_avgs", Q.on_pages("SELECT " + _ROW + ", " + ", ".join(
    f"{minmax_sql(f'v[{2 * i + 1}]', f'v[{2 * i + 2}]')} AS {name}"
    for i, name in enumerate(S.GROUNDWATER_PARAMETERS)) + f" FROM (SELECT {_ROW}, cells[5:] AS v FROM page_rows)"))
def pairwise_param_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_rows(spark, sf_dir).withColumn("v", F.slice("cells", F.lit(5), F.size("cells")))
    return pairwise(rows, "v", S.GROUNDWATER_PARAMETERS).select(*ROW, *S.GROUNDWATER_PARAMETERS)


@query("collapse_ws", "SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\\s\\p{Z}]+', ' ', 'g')) AS text FROM documents")
def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.collapse_ws(F.col("text")).alias("text"))


@query("title_case", """SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(
  lower(p_name || ' o''b' || p_brand || '.' || p_type), '[a-z]+|[^a-z]+'), lambda t: upper(t[1]) || t[2:]), '') AS title FROM part""")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" o'b"), "p_brand", F.lit("."), "p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.title_case(F.concat(F.lit("  "), name)).alias("title"))


@query("normalize_alpha", "SELECT doc_id, regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9]', '', 'g') AS letters FROM documents")
def normalize_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.normalize_alpha(F.col("text")).alias("letters"))


@query("stn_code_fill", Q.on_samples(
    f"SELECT {_KEY}, CASE WHEN do_avg IS NULL THEN 'GEN-' || upper(substr(md5(trim(monitoring_location)), 1, 6)) "
    "ELSE stn_code END AS code FROM samples"))
def stn_code_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some codes are missing, others carry a trailing '.0'."""
    rows = samples(spark, sf_dir, states=False).withColumn("own", F.col("stn_code")).withColumn(
        "stn_code", F.when(F.col("do_avg").isNotNull(), F.concat("stn_code", F.lit(".0"))))
    return score.stn_code_fill(rows).select(
        F.col("own").alias("stn_code"), "k1", "k2", "k3", F.col("stn_code").alias("code"))


@query("state_from_stem", """SELECT source, lang, lower(lang) || '_' || source || '_' || CAST(y AS VARCHAR) || c AS stem,
  lower(lang) || '_' || source AS slug, y AS year FROM (SELECT DISTINCT lang, source, CAST(2010 + doc_id % 10 AS INT) AS y,
  CASE WHEN doc_id % 2 = 0 THEN '_clean' ELSE '' END AS c FROM documents)""")
def state_from_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = (2010 + F.col("doc_id") % 10).cast("string")
    stem = F.concat(F.lower("lang"), F.lit("_"), "source", F.lit("_"), year,
                    F.when(F.col("doc_id") % 2 == 0, "_clean").otherwise(""))
    return table(spark, sf_dir, "documents").select("source", "lang", stem.alias("stem")).distinct(
    ).withColumns({"slug": text.slug_from_stem(F.col("stem")), "year": text.year_from_stem(F.col("stem"))})


def _cut(words, whole_word: bool = True) -> str:
    joined = "|".join(words)
    return rf"\b({joined})\b"


_SIMPLE = f"""simple AS (SELECT name, state, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  lower(name), {Q.text('^(' + '|'.join(R.GEO_LEADING_WORDS) + ')' + chr(92) + 's+')}, ''),
  {Q.text(_cut(R.GEO_POSITION_WORDS))}, '', 'g'), {Q.text(_cut(R.GEO_DESCRIPTOR_WORDS))}, '', 'g'),
  '[,\\-\\(\\)]+', ' ', 'g'), '\\s+', ' ', 'g')) AS simple FROM places)"""
_PLACES = """places AS (SELECT ['River ', 'Lake ', 'R. ', ''][CAST(p_partkey % 4 AS INT) + 1] || p_name ||
  [' u/s road bridge, Ward-', ' (near College) NH-4 ', ' Water Works-', ' '][CAST(p_size % 4 AS INT) + 1] || CAST(p_partkey AS VARCHAR) AS name,
  'NATION_' || CAST(p_partkey % 25 AS VARCHAR) AS state, p_partkey FROM part)"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station names with water-body words, qualifiers and punctuation over ``part``."""
    lead = F.array(*[F.lit(t) for t in ("River ", "Lake ", "R. ", "")])
    tail = F.array(*[F.lit(t) for t in (
        " u/s road bridge, Ward-", " (near College) NH-4 ", " Water Works-", " ")])
    return table(spark, sf_dir, "part").select(
        F.concat(F.get(lead, (F.col("p_partkey") % 4).cast("int")), "p_name",
                 F.get(tail, (F.col("p_size") % 4).cast("int")),
                 F.col("p_partkey").cast("string")).alias("name"),
        F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("state"),
        "p_partkey", "p_size",
    )


@query("geocode_simplify", Q.wrap("SELECT name, state, simple FROM simple", _PLACES, _SIMPLE))
def geocode_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        "name", "state", geo.geocode_simplify(F.col("name")).alias("simple"))


_CANDIDATES = """words AS (SELECT *, list_filter(string_split(simple, ' '), lambda w: length(w) > 3) AS w FROM simple),
tries AS (SELECT name, state, unnest([simple, trim(name),
  CASE WHEN len(w) >= 3 THEN w[-3] || ' ' || w[-2] || ' ' || w[-1] END,
  CASE WHEN len(w) >= 2 THEN w[-2] || ' ' || w[-1] END, CASE WHEN len(w) >= 1 THEN w[-1] END]) AS t,
  unnest([1, 2, 3, 4, 5]) AS i FROM words),
firsts AS (SELECT name, state, t || ', ' || state || ', India' AS query, min(i) AS i FROM tries
  WHERE t IS NOT NULL AND t <> '' GROUP BY name, state, t),
candidates AS (SELECT name AS monitoring_location, state, query,
  CAST(row_number() OVER (PARTITION BY name, state ORDER BY i) - 1 AS INT) AS rank FROM firsts)"""


@query("geocode_candidates", Q.wrap("SELECT * FROM candidates", _PLACES, _SIMPLE, _CANDIDATES))
def geocode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.operators.locate import candidate_queries

    return candidate_queries(places(spark, sf_dir).withColumnRenamed("name", "monitoring_location"))


def normalize_sql(t: str) -> str:
    return (f"CASE WHEN {t} IN ('', 'none', 'na', 'n/a') THEN NULL WHEN contains({t}, 'bod') THEN 'BOD' "
            f"WHEN contains({t}, 'dissolved oxygen') OR {t} = 'do' OR contains({t}, 'low do') THEN 'DO' "
            f"WHEN contains({t}, 'nitrate') THEN 'Nitrate' "
            f"WHEN contains({t}, 'fecal') AND contains({t}, 'coliform') THEN 'Fecal Coliform' "
            f"WHEN {t} = 'p h' OR contains({t}, 'ph') THEN 'pH' END")


_PARAM_TEXT = "['Low DO', 'High BOD', ' pH Out of Range', 'do', 'Dissolved Oxygen', 'FECAL coliform', 'None', 'phosphate', 'TDS']"


@query("normalize_param", f"""SELECT event_id, {normalize_sql('lower(trim(t))')} AS param FROM (SELECT event_id,
  {_PARAM_TEXT}[CAST(event_id % 9 AS INT) + 1] || CASE WHEN user_id % 5 = 0 THEN ' nitrate' ELSE '' END AS t FROM events)""")
def normalize_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array(*[F.lit(t) for t in (
        "Low DO", "High BOD", " pH Out of Range", "do", "Dissolved Oxygen", "FECAL coliform", "None",
        "phosphate", "TDS")])
    mixed = F.concat(F.get(raw, (F.col("event_id") % 9).cast("int")),
                     F.when(F.col("user_id") % 5 == 0, " nitrate").otherwise(""))
    return table(spark, sf_dir, "events").select(
        "event_id", V.normalize_param(mixed).alias("param"))


# Violation texts of both rule sets behind each other, so that names repeat.
_BOTH = ("both_rules AS (SELECT stn_code, k1, k2, k3, water_body_type, monitoring_location, "
         f"violated_params || ', ' || {Q.bis_violations()} AS v FROM scored)")
_PARSED = f"""items AS (SELECT stn_code, k1, k2, k3, unnest(string_split(v, ',')) AS item,
  generate_subscripts(string_split(v, ','), 1) AS i FROM both_rules),
named AS (SELECT stn_code, k1, k2, k3, {normalize_sql('lower(trim(item))')} AS p, min(i) AS i FROM items GROUP BY ALL),
parsed AS (SELECT b.stn_code, b.k1, b.k2, b.k3, b.water_body_type, coalesce(n.params, []) AS params FROM both_rules b LEFT JOIN
  (SELECT stn_code, k1, k2, k3, list(p ORDER BY i) FILTER (WHERE p IS NOT NULL) AS params FROM
   (SELECT stn_code, k1, k2, k3, p, min(i) AS i FROM named GROUP BY ALL) GROUP BY ALL) n
  ON b.stn_code = n.stn_code AND b.k1 = n.k1 AND b.k2 = n.k2 AND b.k3 = n.k3)"""
_PARSED = _PARSED.replace(", min(i) AS i FROM items GROUP BY ALL)", ", i FROM items)")


def both_rules(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    rows = score.scored(samples(spark, sf_dir, **kwargs))
    bis = scoring.violation_text(scoring.bis_conditions(), "None")
    return rows.withColumn("violated_params", F.concat("violated_params", F.lit(", "), bis))


@query("parse_violations", Q.on_scored(f"SELECT {_KEY}, array_to_string(params, '|') AS params FROM parsed", _BOTH, _PARSED))
def parse_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = both_rules(spark, sf_dir, names=False, states=False)
    return rows.select(*KEY, F.array_join(V.parse_violations(F.col("violated_params")), "|").alias("params"))


def knowledge_sql(position: int) -> str:
    return "CASE p " + " ".join(
        f"WHEN {Q.text(n)} THEN {Q.text(t[position])}" for n, t in R.PARAMETER_KNOWLEDGE.items()) + " END"


@query("rule_causes_impacts", Q.on_scored(
    f"SELECT {_KEY}, array_to_string(list_transform(params, lambda p: {knowledge_sql(0)}), '|') AS causes, "
    f"array_to_string(list_transform(params, lambda p: {knowledge_sql(1)}), '|') AS impacts FROM parsed", _BOTH, _PARSED))
def rule_causes_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explain.explain(both_rules(spark, sf_dir, names=False, states=False))
    return rows.select(*KEY, F.array_join("causes", "|").alias("causes"),
                       F.array_join("impacts", "|").alias("impacts"))


@query("json_list_serialize", """SELECT doc_id, CASE WHEN lang = 'en' THEN '[]' ELSE
  '["' || lang || '","' || source || '"]' END AS items FROM documents""")
def json_list_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.when(F.col("lang") != "en", F.array("lang", "source"))
    return table(spark, sf_dir, "documents").select("doc_id", text.json_list(items).alias("items"))


@query("year_to_date", "SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS ds, "
       "CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS ds_text, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def year_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = numbers.year_to_date(F.year("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", ds.alias("ds"), numbers.date_to_text(ds).alias("ds_text"),
        numbers.text_to_year(numbers.date_to_text(ds)).alias("year"))


@query("date_to_year", "SELECT event_id, CAST(year(ts) AS INT) AS year FROM events")
def date_to_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", numbers.text_to_year(numbers.date_to_text(F.col("ts"))).alias("year"))


@query("truncate_text", "SELECT doc_id, substr(text, 1, 30) AS t30, substr(text, 1, 80) AS t80, substr(text, 1, 500) AS t500 FROM documents")
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *[
        text.truncate_text(F.col("text"), n).alias(f"t{n}") for n in (30, 80, 500)])


# ---- page rows ---------------------------------------------------------------

@query("detect_schema", Q.on_pages(f"SELECT {_ROW}, {Q.layout()} AS layout FROM page_rows"))
def detect_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.with_layout(page_rows(spark, sf_dir)).select(*ROW, "layout")


@query("detect_water_body", f"""SELECT doc_id, layout, {Q.body_type('source', 'text', 'layout')} AS water_body_type
FROM (SELECT *, {Q.layout('text', 'FALSE')} AS layout FROM documents)""")
def detect_water_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout and water body of whole texts."""
    layout = D.detect_schema(F.col("text"), F.lit(False))
    return table(spark, sf_dir, "documents").withColumn("layout", layout).select(
        "doc_id", "layout",
        D.detect_water_body(F.col("source"), F.col("text"), F.col("layout")).alias("water_body_type"))


ROW_STATES = f"""row_cells AS (SELECT {_ROW}, unnest(cells) AS cell, generate_subscripts(cells, 1) AS i FROM page_rows),
row_states AS (SELECT {_ROW}, arg_min(s.state, i) AS state FROM row_cells r JOIN cell_states s USING (cell) GROUP BY ALL)"""


@query("detect_state", Q.on_pages(f"SELECT p.k1, p.k2, p.k3, p.k4, s.state FROM page_rows p "
       f"LEFT JOIN row_states s USING ({_ROW})", Q.CELL_STATES, ROW_STATES))
def detect_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.with_state(page_rows(spark, sf_dir)).select(*ROW, "state")


def _parameter_sql(name: str) -> str:
    def pair(names: list[str], complete: bool) -> str:
        if name not in names:
            return "NULL"
        i = names.index(name)
        value = minmax_sql(f"v[{2 * i + 1}]", f"v[{2 * i + 2}]")
        return f"CASE WHEN len(v) > {2 * i + 1} THEN {value} END" if complete else value

    return (f"CAST(CASE layout WHEN 'groundwater' THEN {pair(S.GROUNDWATER_PARAMETERS, False)} "
            f"WHEN 'coastal' THEN {pair(S.RIVER_PARAMETERS, False)} "
            f"ELSE {pair(S.RIVER_PARAMETERS, True)} END AS DOUBLE) AS {name}")


EXTRACTED = f"""data_rows AS (SELECT p.*, s.state, {Q.layout()} AS layout,
  list_filter(p.cells, lambda x: x IS NOT NULL) AS c FROM page_rows p LEFT JOIN row_states s USING ({_ROW})
  WHERE NOT {Q.is_heading('p.cells')}),
typed AS (SELECT *, {Q.body_type('path', 'page_text', 'layout')} AS body,
  c[CASE WHEN layout = 'coastal' THEN 4 ELSE 3 END] AS slot FROM data_rows WHERE len(c) >= 4),
sliced AS (SELECT t.*, t.c[CASE WHEN layout = 'coastal' THEN 4 ELSE 3 END
  + CASE WHEN cs.state IS NULL THEN 0 ELSE 1 END:] AS v FROM typed t LEFT JOIN cell_states cs ON t.slot = cs.cell),
extracted AS (SELECT {_ROW}, trim(c[1]) AS stn_code, trim(regexp_replace(c[2], '\\s+', ' ', 'g')) AS monitoring_location,
  CASE WHEN layout = 'coastal' THEN coalesce(nullif(trim(c[3]), ''), body) ELSE body END AS water_body_type, state, year,
  {', '.join(_parameter_sql(n) for n in S.ALL_PARAMETERS)} FROM sliced)"""


@query("parse_rows_by_schema", Q.on_pages(
    f"SELECT {_ROW}, stn_code, monitoring_location, water_body_type, {', '.join(S.ALL_PARAMETERS)} FROM extracted",
    Q.CELL_STATES, ROW_STATES, EXTRACTED))
def parse_rows_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.with_layout(extract.skip_header_rows(page_rows(spark, sf_dir)))
    return extract.parse_rows_by_schema(extract.compact_cells(rows)).select(
        *ROW, "stn_code", "monitoring_location", "water_body_type", *S.ALL_PARAMETERS)


@query("extract_samples", Q.on_pages(
    f"SELECT {', '.join(S.EXTRACTED_COLUMNS)}, {_ROW} FROM extracted WHERE state IS NOT NULL AND monitoring_location <> '' "
    "AND (ph_avg IS NULL OR ph_avg <= 14)", Q.CELL_STATES, ROW_STATES, EXTRACTED))
def extract_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_samples(page_rows(spark, sf_dir), keep=ROW)


# ---- replies -------------------------------------------------------------------

_REPLY = ("CASE event_id % 3 WHEN 0 THEN '```json' || chr(10) || props || chr(10) || '```' "
          "WHEN 1 THEN 'Result: ' || props || ' end' ELSE 'nothing to report' END")


@query("extract_json_object", f"""SELECT event_id, nullif(regexp_extract({_REPLY}, '\\{{.*\\}}'), '') AS json,
  CASE WHEN event_id % 3 = 2 THEN 'no valid JSON in reply' END AS error FROM events""")
def extract_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("event_id") % 3
    reply = F.when(part == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(
        part == 1, F.concat(F.lit("Result: "), "props", F.lit(" end"))).otherwise("nothing to report")
    rows = table(spark, sf_dir, "events").select("event_id", reply.alias("reply"))
    return explain.extract_json_object(rows).select("event_id", "json", "error")


@query("normalize_insight", """SELECT event_id, event_type AS station_name, CASE WHEN event_id % 2 = 0 THEN 'Lake' ELSE 'River' END AS water_body_type,
  CASE WHEN event_id % 2 = 0 THEN 'pH' ELSE 'BOD|DO' END AS violated_params, 'cause ' || event_type AS causes,
  CASE WHEN event_id % 2 = 0 THEN 'act' ELSE '' END AS measures, 3 AS retrieved_context_count FROM events""")
def normalize_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with missing fields, blank items and texts in place of lists."""
    even = F.col("event_id") % 2 == 0
    full = F.concat(F.lit('{"water_body_type": "Lake", "violated_params": ["pH", " "], "causes_of_pollution": ["'),
                    F.lit("cause "), "event_type", F.lit(' ", ""], "recommended_measures": [" act "]}'))
    thin = F.concat(F.lit('{"causes_of_pollution": ["cause '), "event_type",
                    F.lit('"], "recommended_measures": "none", "violated_params": "x"}'))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(even, full).otherwise(thin).alias("json"),
        F.col("event_type").alias("station_name"), F.lit("River").alias("water_body_type"),
        F.array(F.lit("BOD"), F.lit(" DO")).alias("violated_params"), F.lit(3).alias("context_count"))
    return explain.normalize_insight(rows).select(
        "event_id", "station_name", "water_body_type",
        F.array_join("violated_params", "|").alias("violated_params"),
        F.array_join("causes_of_pollution", "|").alias("causes"),
        F.array_join("recommended_measures", "|").alias("measures"), "retrieved_context_count")


@query("render_response_items", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'Do ' || event_type
  WHEN 2 THEN 'First Step: ' || event_type || '; Level: 2' ELSE CAST(event_id AS VARCHAR) END || '|' || event_type AS items FROM events""")
def render_response_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as text, object with a known key, object without one, and number."""
    part, kind = F.col("event_id") % 4, F.col("event_type")
    item = (
        F.when(part == 0, F.concat(F.lit('" '), kind, F.lit(' "')))
        .when(part == 1, F.concat(F.lit('{"level": 1, "action": "Do '), kind, F.lit('"}')))
        .when(part == 2, F.concat(F.lit('{"first_step": "'), kind, F.lit('", "level": 2, "x": null}')))
        .otherwise(F.col("event_id").cast("string"))
    )
    reply = F.concat(F.lit('{"causes": ['), item, F.lit(', "", "'), kind, F.lit('"]}'))
    return table(spark, sf_dir, "events").select(
        "event_id", F.array_join(replies.response_list(reply, "causes"), "|").alias("items"))


def _flag(words) -> str:
    return Q.contains_any("lower(text)", words)


@query("question_flags", f"""SELECT conv_id, turn, {_flag(R.STATION_QUESTION_KEYWORDS)} AS station, {_flag(R.RISK_QUESTION_KEYWORDS)} AS risk,
  {_flag(R.NEEDS_STATION_KEYWORDS)} AS needs_station FROM (SELECT conv_id, turn, text ||
  CASE conv_id % 3 WHEN 0 THEN ' Why is THIS station unsafe?' WHEN 1 THEN ' Is it safe?' ELSE '' END AS text
  FROM conversations WHERE role = 'user')""")
def question_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("conv_id") % 3
    message = F.concat("text", F.when(part == 0, " Why is THIS station unsafe?").when(
        part == 1, " Is it safe?").otherwise(""))
    return table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(
        "conv_id", "turn", replies.is_station_question(message).alias("station"),
        replies.is_risk_question(message).alias("risk"),
        replies.needs_station(message).alias("needs_station"))


def _or_na(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'N/A')"


@query("station_context_line", Q.on_scored(
    "SELECT stn_code, 'Station: ' || monitoring_location || ', Type: ' || water_body_type || ', Year: ' || CAST(year AS VARCHAR) "
    f"|| ', Safety: ' || safety_label || ', DO: ' || {_or_na('do_avg')} || ', BOD: ' || {_or_na('bod_avg')} || ', pH: ' || "
    f"{_or_na('ph_avg')} || ', Nitrate: ' || {_or_na('nitrate_avg')} || ', Fecal Coliform: ' || {_or_na('fecal_coliform_avg')} "
    f"|| ', Pollution Score: ' || {_or_na('pollution_score')} || '/10, Violations: ' || coalesce(nullif(violated_params, ''), 'None') "
    "AS station_context FROM latest_row", Q.LATEST_ROW))
def station_context_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest.gathered(samples(spark, sf_dir, names=False, states=False), "stn_code")
    named = latest.latest_row(score.scored(rows)).join(station_names(spark, sf_dir), "stn_code", "left")
    return knowledge.station_context_line(named).select("stn_code", "station_context")


@query("ordered_distinct", "SELECT conv_id, array_to_string(list(role ORDER BY t), ',') AS roles FROM "
       "(SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY conv_id, role) GROUP BY conv_id")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles per conversation in order of appearance."""
    firsts = table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("t"))
    roles = F.transform(F.array_sort(F.collect_list(F.struct("t", "role"))), lambda r: r["role"])
    return firsts.groupBy("conv_id").agg(roles.alias("r")).select(
        "conv_id", F.array_join(text.ordered_distinct(F.col("r")), ",").alias("roles"))
