"""Queries over texts, nearest chunks, prompts and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.text import split_list
from rivulet.functions.violations import violation_structs
from rivulet.operators import evaluate, ingest, knowledge, latest, score, stats, vector_index
from rivulet.plans import ctes as Q
from rivulet.plans.registry import query
from rivulet.session import new_path
from rivulet.sources.tables import samples, station_names, table


def tokens_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\\s\\p{{Z}}]+'), lambda w: w <> '')"


def chunks_sql(source: str, keys: str, size: int, overlap: int) -> str:
    stride = size - overlap
    return (f"SELECT {keys}, CAST(s // {stride} AS INT) AS chunk_index, array_to_string(w[s + 1 : s + {size}], ' ') AS document FROM "
            f"(SELECT {keys}, w, len(w) AS n, unnest(range(0, len(w), {stride})) AS s FROM (SELECT {keys}, {tokens_sql('text')} AS w FROM {source})) "
            f"WHERE s = 0 OR s + {overlap} < n")


_JOINED = ("joined AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations "
           "WHERE trim(regexp_replace(text, '[\\s\\p{Z}]+', ' ', 'g')) <> '' GROUP BY conv_id)")


@query("join_pages_text", Q.wrap("SELECT conv_id, text FROM joined", _JOINED))
def join_pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of a conversation as the pages of a document."""
    return knowledge.join_pages_text(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query("chunk_tokens", chunks_sql("documents", "doc_id", 500, 50))
def chunk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knowledge.chunk_tokens(table(spark, sf_dir, "documents"), ["doc_id"])


@query("chunk_pages", Q.wrap(chunks_sql("joined", "conv_id", 40, 10), _JOINED))
def chunk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks over page borders without building the joined text."""
    return knowledge.chunk_pages(
        table(spark, sf_dir, "conversations"), "conv_id", "turn", size=40, overlap=10, block=3)


@query("chunk_ids", "SELECT source, doc_id, chunk_index, substr(sha1(source), 1, 12) || '_' || CAST(chunk_index AS VARCHAR) AS id FROM ("
       + chunks_sql("documents", "source, doc_id", 500, 50) + ")")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = knowledge.chunk_tokens(table(spark, sf_dir, "documents"), ["source", "doc_id"])
    return knowledge.chunk_ids(chunks).select("source", "doc_id", "chunk_index", "id")


_SPOKEN = ("spoken AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations WHERE role = 'assistant' "
           "GROUP BY conv_id)")


def _stored(source: str, size: int, overlap: int) -> str:
    return ("SELECT CAST(conv_id AS VARCHAR) AS source, chunk_index, document, substr(sha1(CAST(conv_id AS VARCHAR)), 1, 12) || '_' "
            f"|| CAST(chunk_index AS VARCHAR) AS id FROM ({chunks_sql(source, 'conv_id', size, overlap)})")


@query("ingest_pages", Q.wrap(
    "SELECT * FROM old WHERE source NOT IN (SELECT source FROM fresh) UNION ALL SELECT * FROM fresh",
    _JOINED, _SPOKEN, f"old AS ({_stored('joined', 60, 10)})", f"fresh AS ({_stored('spoken', 40, 5)})"))
def ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations are stored; those with an assistant are read again from its turns alone."""
    turns = table(spark, sf_dir, "conversations").withColumn("source", F.col("conv_id").cast("string"))
    old = knowledge.chunk_ids(knowledge.chunk_pages(turns, "source", "turn", size=60, overlap=10))
    return knowledge.ingest_pages(old, turns.filter(F.col("role") == "assistant"), "turn", size=40, overlap=5)


_EDITED = _JOINED.replace("FROM conversations", "FROM (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN text || ' (edited)' ELSE text END AS text FROM conversations)")


@query("ingest_changed", Q.wrap(
    f"SELECT *, CASE WHEN CAST(source AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS batch FROM ({_stored('joined', 60, 10)})", _EDITED))
def ingest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations are stored, a third is edited, and all are given again: only that third is written."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    edited = turns.withColumn("text", F.when(F.col("conv_id") % 3 == 0, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    path = new_path(spark, "chunk-store")
    ingest.create_chunk_store(spark, path, buckets=16)
    for pages in (turns, edited):
        ingest.ingest_changed(spark, path, pages, "turn", source="conv_id", size=60, overlap=10)
    return ingest.read_chunks(spark, path)


_HITS = """queries AS (SELECT label AS query_id, arg_min(embedding, vec_id) AS q FROM embeddings GROUP BY label),
hits AS (SELECT query_id, vec_id AS chunk_id, distance, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM (
    SELECT query_id, vec_id, list_sum(list_transform(range(1, len(q) + 1), lambda i: (CAST(embedding[i] AS DOUBLE) - CAST(q[i] AS DOUBLE))
      * (CAST(embedding[i] AS DOUBLE) - CAST(q[i] AS DOUBLE)))) AS distance FROM queries, embeddings)) WHERE rank <= 5),
found AS (SELECT h.*, d.text AS document FROM hits h JOIN documents d ON d.doc_id = h.chunk_id)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of one query vector per label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    first = F.min(F.struct("vec_id", "embedding"))["embedding"].alias("embedding")
    queries = vectors.groupBy(F.col("label").alias("query_id")).agg(first)
    return knowledge.knn_topk(vectors, queries, 5)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("document"))
    return hits(spark, sf_dir).join(docs, "chunk_id")


@query("knn_topk", Q.wrap(f"SELECT query_id, chunk_id, rank, {Q.rnd('distance', 6)} AS distance FROM hits", _HITS))
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(spark, sf_dir).withColumn("distance", F.round("distance", 6))


@query("knn_index", f"""SELECT query_id, chunk_id, CAST(rank AS INT) AS rank, {Q.rnd('distance', 6)} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS chunk_id, list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i:
      (CAST(b.embedding[i] AS DOUBLE) - CAST(a.embedding[i] AS DOUBLE)) * (CAST(b.embedding[i] AS DOUBLE) - CAST(a.embedding[i] AS DOUBLE)))) AS distance
    FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0)) WHERE rank <= 5""")
def knn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 100, from a kept index of all."""
    vectors = table(spark, sf_dir, "embeddings")
    path = vector_index.build_index(vectors)
    queries = vectors.filter(F.col("vec_id") % 100 == 0).withColumnRenamed("vec_id", "query_id")
    return vector_index.search_index(spark, path, queries, 5).withColumn("distance", F.round("distance", 6))


@query("context_assembly", Q.wrap(
    "SELECT query_id, string_agg('Context ' || CAST(rank AS VARCHAR) || ': ' || document, chr(10) || chr(10) ORDER BY rank) AS context_text, "
    "count(*) AS context_count FROM found GROUP BY query_id", _HITS))
def context_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knowledge.context_assembly(found(spark, sf_dir))


@query("retrieval_summary", Q.wrap(
    "SELECT query_id, count(*) AS chunks, arg_min(substr(document, 1, 80), rank) AS preview FROM found GROUP BY query_id", _HITS))
def retrieval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.retrieval_summary(found(spark, sf_dir))


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored latest row per station; names join the finished rows."""
    rows = latest.gathered(samples(spark, sf_dir, names=False, states=False), "stn_code")
    return latest.latest_row(score.scored(rows)).join(station_names(spark, sf_dir), "stn_code", "left")


@query("retrieval_query_text", Q.on_scored(
    "SELECT stn_code, 'Pollution causes and mitigation for ' || water_body_type || ' water body at ' || monitoring_location "
    "|| '. Violated parameters: ' || coalesce(nullif(violated_params, ''), 'water quality violations') || '.' AS query_text FROM latest_row", Q.LATEST_ROW))
def retrieval_query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(spark, sf_dir).select("stn_code", knowledge.retrieval_query_text(
        split_list(F.col("violated_params")), F.col("water_body_type"), F.col("monitoring_location")).alias("query_text"))


_MESSAGES = """messages AS (SELECT conv_id, text || CASE conv_id % 2 WHEN 0 THEN ' Why is this station unsafe?' ELSE '' END AS message,
  CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'Station: S' || CAST(conv_id AS VARCHAR) END AS station_context FROM conversations
  WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user message of each conversation, two thirds of them with a station."""
    turns = table(spark, sf_dir, "conversations")
    last = turns.filter(F.col("role") == "user").groupBy("conv_id").agg(
        F.max(F.struct("turn", "text"))["text"].alias("text"))
    recent = latest.chat_history_window(turns).groupBy("conv_id").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))),
        lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))).alias("history"))
    part = F.col("conv_id")
    return last.join(recent, "conv_id", "left").select(
        part.alias("request_id"),
        F.concat("text", F.when(part % 2 == 0, " Why is this station unsafe?").otherwise("")).alias("message"),
        F.when(part % 3 == 0, "").otherwise(F.concat(F.lit("Station: S"), part.cast("string"))).alias("station_context"),
        F.lit("Unsafe").alias("safety_label"), F.when(part % 4 == 0, "[]").alias("violations"),
        F.when(part % 5 == 0, "").otherwise("Some guideline").alias("context_text"),
        F.coalesce("history", F.lit("[]")).alias("history"),
    )


def _any(words) -> str:
    return Q.contains_any("lower(message)", words)


_GUIDELINE = "CASE WHEN conv_id % 5 = 0 THEN 'No context retrieved' ELSE 'Some guideline' END"
_STRICT_PROMPT = f"""'Question: ' || message || '\n\nStation: ' || station_context || '\nStored safety label: Unsafe
Computed violations, complete and final: ' || CASE WHEN conv_id % 4 = 0 THEN '[]' ELSE 'none, all limits are met' END
|| '\n\nGuidelines:\n' || {_GUIDELINE} || '\n\nReport exactly these violations. Without violations the status is Safe. \
Answer in 3-5 sentences in the field ''answer''.'"""
_OPEN_PROMPT = f"""'Question: ' || message || '\n\nStation (for reference): ' || coalesce(nullif(station_context, ''), 'none')
|| '\n\nGuidelines:\n' || {_GUIDELINE} || '\n\nAnswer in 3-5 sentences in the field ''answer''. \
Set safety_status to null and violations to [].'"""


@query("prompt_table", Q.wrap(
    f"SELECT request_id, strict, CASE WHEN strict THEN {_STRICT_PROMPT} ELSE {_OPEN_PROMPT} END AS user_prompt, history_items FROM ("
    f"SELECT *, conv_id AS request_id, station_context <> '' AND {_any(R.STATION_QUESTION_KEYWORDS)} AND {_any(R.RISK_QUESTION_KEYWORDS)} AS strict, "
    "coalesce(h, 0) AS history_items FROM messages LEFT JOIN (SELECT conv_id, count(*) AS h FROM (SELECT * FROM conversations QUALIFY "
    "row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4) WHERE role IN ('user', 'assistant') AND coalesce(text, '') <> '' "
    "GROUP BY conv_id) USING (conv_id))", _MESSAGES))
def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = knowledge.prompt_table(requests(spark, sf_dir))
    return rows.select(
        "request_id", "strict", "user_prompt",
        F.coalesce(F.json_array_length("history"), F.lit(0)).cast("bigint").alias("history_items"))


@query("chat_query_text", Q.wrap(
    "SELECT conv_id AS request_id, CASE WHEN station_context <> '' THEN message || '. Context: ' || station_context ELSE message END AS query_text "
    "FROM messages", _MESSAGES))
def chat_query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir).select("request_id", knowledge.chat_query_text(
        F.col("message"), F.col("station_context")).alias("query_text"))


@query("insight_prompt_table", Q.on_scored(
    """SELECT violated_params, water_body_type, 'Analyse the water pollution of a station.\nStation name: ' || water_body_type
|| '\nWater body type: ' || water_body_type || '\nViolated parameters: ' || violated_params || '\n\nContext:
No relevant context retrieved.\n\nReturn station_name, water_body_type, violated_params, causes_of_pollution (3-7 items), \
recommended_measures (3-7 items) and retrieved_context_count.' AS user_prompt
FROM (SELECT DISTINCT violated_params, water_body_type FROM scored WHERE safety_label = 'Unsafe')"""))
def insight_prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    combos = stats.unsafe_combos(score.classify_class_a(samples(spark, sf_dir, names=False, states=False)))
    asked = combos.withColumns({"params": split_list(F.col("violated_params")), "context_text": F.lit("")})
    return knowledge.insight_prompt_table(asked).select("violated_params", "water_body_type", "user_prompt")


_VALUES = [("pH", "ph_avg", "mg/L"), ("BOD", "bod_avg", "mg/L"), ("Nitrate", "nitrate_avg", "mg/L"), ("Fecal Coliform", "fecal_coliform_avg", "MPN/100ml")]
_HIT = "contains(', ' || violated_params || ',', ', ' || p || ',') AND p <> 'DO'"
_WHY = (f"CASE CASE WHEN {_HIT} THEN p END " + " ".join(
    f"WHEN '{n}' THEN 'Why is {n} high at ' || monitoring_location || ' (current: ' || CAST({c} AS VARCHAR) || ' {u})?'" for n, c, u in _VALUES)
    + " ELSE 'Why is ' || p || ' elevated at ' || monitoring_location || '?' END")
_WHY_REASON = f"CASE WHEN {_HIT} THEN 'Detected violation: ' ELSE 'Detected potential issue: ' END || p"
_GENERAL = "[" + ", ".join(f"{{'text': {Q.text(t)}, 'reason': {Q.text(r)}}}" for t, r in R.SUGGESTIONS_WITHOUT_VIOLATIONS) + "]"
_SUGGEST = f"""asked AS (SELECT *, CASE CAST(stn_code AS INT) % 5 WHEN 0 THEN ['Nitrate', 'DO', 'pH'] WHEN 1 THEN []
  ELSE list_filter(string_split(violated_params, ', '), lambda x: x <> '') END[:2] AS ps FROM latest_row),
chosen AS (SELECT stn_code, CASE WHEN len(ps) = 0 THEN {_GENERAL} ELSE (list_transform(ps, lambda p: {{'text': {_WHY}, 'reason': {_WHY_REASON}}})
  || list_transform(ps, lambda p: {{'text': 'What actions can reduce ' || p || ' contamination at ' || monitoring_location || '?',
     'reason': 'Mitigation for ' || p}}))[:3] END AS qs FROM asked)"""


@query("suggest_questions", Q.on_scored(
    "SELECT stn_code, CAST(i - 1 AS INT) AS position, qs[i].text AS text, qs[i].reason AS reason FROM (SELECT stn_code, qs, "
    "unnest(range(1, len(qs) + 1)) AS i FROM chosen)", Q.LATEST_ROW, _SUGGEST))
def suggest_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some requests bring their own violations, some an empty list of them."""
    fifth, none = F.col("stn_code").cast("int") % 5, F.array().cast("array<string>")
    given = F.when(fifth == 0, F.array(F.lit("Nitrate"), F.lit("DO"), F.lit("pH"))).when(fifth == 1, none)
    return knowledge.suggest_questions(latest_rows(spark, sf_dir).withColumn("given", given), given="given")


def _computed(shape: str, separator: str) -> str:
    """Texts of the violations of a row; ``shape`` has places for name, value, unit and limit."""
    parts = [
        ("pH", "ph_avg", "ph_avg < 6.5 OR ph_avg > 8.5", "6.5-8.5 (BIS/WHO)", "mg/L"),
        ("Dissolved Oxygen", "do_avg", "do_avg < 6", "min 6.0 mg/L (CPCB)", "mg/L"),
        ("BOD", "bod_avg", "bod_avg > 2", "max 2.0 mg/L (CPCB)", "mg/L"),
        ("Nitrate", "nitrate_avg", "nitrate_avg > 10", "max 10.0 mg/L (WHO)", "mg/L"),
        ("Fecal Coliform", "fecal_coliform_avg", "fecal_coliform_avg > 50", "max 50.0 MPN/100ml (WHO)", "MPN/100ml"),
    ]
    texts = (f"CASE WHEN {w} THEN {shape.format(name=n, value=f'CAST({c} AS VARCHAR)', unit=u, limit=limit)} END"
             for n, c, w, limit, u in parts)
    return f"concat_ws('{separator}', {', '.join(texts)})"


_REASON = _computed("'{name} = ' || {value} || ' {unit} (limit: {limit})'", "; ")
_FACTS = _computed("'{name}|' || {value} || ' {unit}|{limit}|critical'", "; ")
_BASE = "CASE k1 % 3 WHEN 0 THEN 'Fine' WHEN 1 THEN 'first cause' ELSE 'Sorry, could not process request' END"


@query("merge_chat_answer", Q.on_scored(
    f"SELECT stn_code AS request_id, CASE WHEN k1 % 3 <> 2 AND k1 % 2 = 0 AND violated_params <> '' THEN 'Station label: ' || safety_label || '. Reason: ' "
    f"|| {_REASON} || '. ' || {_BASE} ELSE {_BASE} END AS answer, CASE WHEN k1 % 3 = 2 THEN NULL WHEN k1 % 2 = 0 THEN safety_label "
    "WHEN k1 % 3 = 0 THEN 'Safe' END AS safety_status, CASE WHEN k1 % 3 = 2 THEN '' WHEN k1 % 2 = 0 THEN "
    f"{_FACTS} WHEN k1 % 3 = 0 THEN 'pH|9|8.5|critical' ELSE '' END AS violations, "
    "CASE WHEN k1 % 3 = 1 THEN 'first cause|second' ELSE '' END AS causes, "
    "CASE WHEN k1 % 3 = 0 THEN 'Act now' ELSE '' END AS actions, k2 AS sources_used, monitoring_location AS station_name, "
    "replace(violated_params, ', ', '|') AS violated_params, k1 % 2 = 0 AS has_station_context FROM latest_row", Q.LATEST_ROW))
def merge_chat_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with an answer, with causes only, and without JSON; half of them for a station."""
    full = ('{"answer": " Fine ", "safety_status": "Safe", "violations": [{"parameter": "pH", "value": "9", "limit": "8.5", "status": "critical"}, '
            '{"parameter": "DO"}], "recommended_actions": [{"action": "Act now"}]}')
    thin = '```json\n{"answer": "", "causes": ["first cause", "", "second"]}\n```'
    part = F.col("k1") % 3
    rows = latest_rows(spark, sf_dir).select(
        F.col("stn_code").alias("request_id"), (F.col("k1") % 2 == 0).alias("has_station"), "safety_label",
        violation_structs().alias("violations"), F.col("k2").alias("context_count"),
        F.col("monitoring_location").alias("station_name"), "violated_params",
        F.when(part == 0, full).when(part == 1, thin).otherwise("no answer").alias("reply"))
    return knowledge.merge_chat_answer(rows).select(
        "request_id", "answer", "safety_status", F.array_join(F.transform("violations", lambda v: F.concat_ws(
            "|", v["parameter"], v["value"], v["limit_text"], v["status"])), "; ").alias("violations"),
        F.array_join("causes", "|").alias("causes"), F.array_join("recommended_actions", "|").alias("actions"),
        "sources_used", "station_name", F.array_join("violated_params", "|").alias("violated_params"), "has_station_context")
