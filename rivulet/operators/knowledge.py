"""Guideline texts: chunks, nearest chunks, prompts and replies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions import replies as M
from rivulet.functions.violations import violation_structs
from rivulet.functions.text import split_list, strip
from rivulet.sources.caches import source_replace_upsert

WHITE = r"[\s\p{Z}]+"
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50


def _tokens(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), WHITE)
    return F.filter(words, lambda w: w != "")


def _check(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("size must be > 0")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be >= 0 and smaller than size")


def join_pages_text(pages: DataFrame, key: str, page: str, text: str = "text") -> DataFrame:
    """Texts of a document's pages joined by a blank line, empty pages skipped.

    For documents that fit a row. ``chunk_pages`` gives the same chunks without building the
    whole text.
    """
    parts = F.array_sort(F.collect_list(F.struct(page, text)))
    kept = pages.filter(strip(F.regexp_replace(text, WHITE, " ")) != "")
    return kept.groupBy(key).agg(
        F.array_join(F.transform(parts, lambda p: p[text]), "\n\n").alias("text")
    )


def chunk_tokens(
    docs: DataFrame, keys: Sequence[str], text: str = "text",
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Overlapping windows of ``size`` tokens; the last window reaches the end of the text."""
    _check(size, overlap)
    stride = size - overlap
    tokens = docs.select(*keys, _tokens(F.col(text)).alias("_tokens")).withColumn(
        "_n", F.size("_tokens")).filter(F.col("_n") > 0)
    starts = F.filter(
        F.sequence(F.lit(0), F.col("_n") - 1, F.lit(stride)),
        lambda s: (s == 0) | (s + overlap < F.col("_n")),
    )
    chunks = F.transform(starts, lambda s: F.struct(
        (s / stride).cast("int").alias("chunk_index"),
        F.array_join(F.slice(F.col("_tokens"), s + 1, F.lit(size)), " ").alias("document"),
    ))
    return tokens.select(*keys, F.inline(chunks))


def chunk_pages(
    pages: DataFrame, key: str, page: str, text: str = "text",
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, block: int = 1000,
) -> DataFrame:
    """The chunks of ``chunk_tokens`` over the joined pages, for documents of any length.

    Every page finds its place in the document by a running token count, taken in two steps
    (inside blocks of pages, then over the blocks), and hands its words to the chunks they fall
    into. No task ever holds more than one block of pages or one chunk.
    """
    _check(size, overlap)
    stride = size - overlap
    words = pages.select(
        key, F.col(page).alias("_page"), F.floor(F.col(page) / block).alias("_block"),
        _tokens(F.col(text)).alias("_tokens"),
    ).withColumn("_n", F.size("_tokens").cast("bigint")).filter(F.col("_n") > 0)

    before = Window.orderBy("_block").partitionBy(key).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    blocks = words.groupBy(key, "_block").agg(F.sum("_n").alias("_sum")).select(
        key, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
        F.sum("_sum").over(whole).alias("_total"),
    )
    inside = Window.partitionBy(key, "_block").orderBy("_page").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = words.withColumn(
        "_run", F.coalesce(F.sum("_n").over(inside), F.lit(0))
    ).join(blocks, [key, "_block"]).withColumn("_from", F.col("_base") + F.col("_run"))

    end = F.col("_from") + F.col("_n")
    lowest = F.greatest(F.lit(0), F.ceil((F.col("_from") - size + 1) / stride))
    highest = F.floor((end - 1) / stride)
    pieces = placed.withColumn("chunk_index", F.explode(F.sequence(lowest, highest)))
    start = F.col("chunk_index") * stride
    pieces = pieces.filter((start == 0) | (start + overlap < F.col("_total")))
    first = F.greatest(start, F.col("_from"))
    last = F.least(start + size, end)
    piece = F.array_join(F.slice(
        "_tokens", (first - F.col("_from") + 1).cast("int"), (last - first).cast("int")), " ")
    parts = F.array_sort(F.collect_list(F.struct("_page", "_piece")))
    return pieces.filter(last > first).withColumn("_piece", piece).groupBy(
        key, F.col("chunk_index").cast("int").alias("chunk_index")
    ).agg(F.array_join(F.transform(parts, lambda p: p["_piece"]), " ").alias("document"))


def chunk_ids(chunks: DataFrame, source: str = "source") -> DataFrame:
    """Adds the chunk id: start of the source's hash and the chunk's position."""
    return chunks.withColumn("id", F.concat(
        F.substring(F.sha1(F.col(source)), 1, 12), F.lit("_"), F.col("chunk_index").cast("string")
    ))


# ---- nearest chunks --------------------------------------------------------

# Vectors of one block of chunks and of one block of queries.
CHUNK_BLOCK, QUERY_BLOCK = 4096, 1024
# Queries whose nearest chunks a task holds before it hands them on.
HELD_QUERIES = 1 << 16


def _blocks(df: DataFrame, id_column: str, vector: str, size: int, name: str) -> DataFrame:
    """Vectors packed where they are into blocks: ids, and all components in a row."""
    kind = df.schema[id_column].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                flat = part.column(1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                     for v in (part.column(0), flat)], [f"{name}_ids", f"{name}_flat"])

    known = F.forall("v", lambda x: x.isNotNull()) & (F.size("v") > 0)
    return df.select(
        F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).dropna().filter(known).mapInArrow(pack, f"{name}_ids array<{kind}>, {name}_flat array<double>")


def _nearest(k: int):
    """Keeps the k nearest chunks of each query over the pairs of blocks that a task sees."""
    def matrix(batch: pa.RecordBatch, name: str, i: int) -> tuple[np.ndarray, np.ndarray]:
        ids = batch.column(f"{name}_ids")[i].values.to_numpy(zero_copy_only=False)
        flat = batch.column(f"{name}_flat")[i].values.to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), -1)

    def near(chunks: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """True for chunks that may be among the k nearest: up to the k-th distance of a matrix product."""
        sizes = np.einsum("ij,ij->i", chunks, chunks), np.einsum("ij,ij->i", queries, queries)
        rough = sizes[1][:, None] + sizes[0] - 2 * queries @ chunks.T
        # Far above the rounding error of the product, so no chunk is lost to it.
        slack = 1e-9 * (sizes[0].max() + sizes[1])
        if len(chunks) <= k:
            return np.ones_like(rough, dtype=bool)
        return rough <= (np.partition(rough, k - 1, axis=1)[:, k - 1] + slack)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}

        def drain() -> pa.RecordBatch:
            sizes = [len(d) for d, _ in best.values()]
            out = pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array(list(best), dtype=object), sizes).tolist(), query_type),
                pa.array(np.concatenate([c for _, c in best.values()]).tolist(), chunk_type),
                pa.array(np.concatenate([d for d, _ in best.values()]))],
                ["query_id", "chunk_id", "distance"])
            best.clear()
            return out

        query_type = chunk_type = None
        for batch in batches:
            query_type = batch.schema.field("q_ids").type.value_type
            chunk_type = batch.schema.field("c_ids").type.value_type
            for i in range(batch.num_rows):
                (numbers, chunks), (asked, queries) = matrix(batch, "c", i), matrix(batch, "q", i)
                for query_id, query, some in zip(asked.tolist(), queries, near(chunks, queries)):
                    gap = chunks[some] - query
                    distance, found = np.einsum("ij,ij->i", gap, gap), numbers[some]
                    if query_id in best:
                        distance = np.concatenate([best[query_id][0], distance])
                        found = np.concatenate([best[query_id][1], found])
                    order = np.lexsort((found, distance))[:k]
                    best[query_id] = distance[order], found[order]
                if len(best) >= HELD_QUERIES:
                    yield drain()
        if best:
            yield drain()

    return run


def knn_topk(
    chunks: DataFrame, queries: DataFrame, k: int, chunk_id: str = "vec_id",
    query_id: str = "query_id", vector: str = "embedding", block_size: int = QUERY_BLOCK,
) -> DataFrame:
    """The k nearest chunks of every query by squared distance, exact; ties go to the lower id.

    Chunks and queries are packed into blocks by the tasks that read them. Every block of queries
    goes to each of as many buckets as there are shuffle partitions, every block of chunks to one,
    and blocks meet by bucket. Spark may broadcast the query side while it is under its size
    threshold; then the chunks are scanned in place. A task holds one pair of blocks and the k
    best of its queries. Rows without id and vectors that are null, empty or hold nulls take no part.
    """
    spark = chunks.sparkSession
    types = (f"query_id {queries.schema[query_id].dataType.simpleString()}, "
             f"chunk_id {chunks.schema[chunk_id].dataType.simpleString()}, distance double")
    if k <= 0:
        return spark.createDataFrame([], types + ", rank int")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = _blocks(chunks, chunk_id, vector, CHUNK_BLOCK, "c").withColumn(
        "bucket", F.pmod(F.xxhash64("c_ids"), F.lit(buckets)))
    asked = _blocks(queries, query_id, vector, block_size, "q").withColumn(
        "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))))
    found = held.join(asked, "bucket").drop("bucket").mapInArrow(_nearest(k), types)
    nearest = Window.partitionBy("query_id").orderBy("distance", "chunk_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def ingest_pages(
    store: DataFrame, pages: DataFrame, page: str, text: str = "text", source: str = "source",
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """The chunk store after the pages of some sources were read again.

    Pages become chunks with ids, and all stored chunks of these sources give way to them. A source
    whose pages hold no words keeps what is stored. Returns source, chunk_index, document, id.
    """
    new = chunk_ids(chunk_pages(pages, source, page, text, size, overlap), source)
    columns = [source, "chunk_index", "document", "id"]
    return source_replace_upsert(store.select(*columns), new.select(*columns), source)


# ---- prompts ---------------------------------------------------------------

def retrieval_query_text(params: Column, water_body_type: Column, station: Column) -> Column:
    """Search sentence for a station's violated parameters (array)."""
    named = F.coalesce(
        F.nullif(F.array_join(params, ", "), F.lit("")), F.lit("water quality violations"))
    return F.concat(
        F.lit("Pollution causes and mitigation for "), water_body_type,
        F.lit(" water body at "), station, F.lit(". Violated parameters: "), named, F.lit("."),
    )


def chat_query_text(message: Column, context: Column) -> Column:
    return F.when(
        F.coalesce(context, F.lit("")) != "", F.concat(message, F.lit(". Context: "), context)
    ).otherwise(message)


def context_assembly(hits: DataFrame, key: str = "query_id", numbered: bool = True) -> DataFrame:
    """Found chunks of a query as one text, best first; at most k chunks per query come in."""
    parts = F.array_sort(F.collect_list(F.struct("rank", "document")))

    def line(p: Column) -> Column:
        if not numbered:
            return p["document"]
        return F.concat(F.lit("Context "), p["rank"].cast("string"), F.lit(": "), p["document"])

    return hits.groupBy(key).agg(
        F.array_join(F.transform(parts, line), "\n\n").alias("context_text"),
        F.count("*").alias("context_count"),
    )


def station_context_line(df: DataFrame) -> DataFrame:
    """Adds one line describing a station's latest sample."""
    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))

    def text(c: str, default: str) -> Column:
        return F.coalesce(F.nullif(strip(F.col(c)), F.lit("")), F.lit(default))

    line = F.concat(
        F.lit("Station: "), text("monitoring_location", "Unknown"),
        F.lit(", Type: "), text("water_body_type", "Unknown"),
        F.lit(", Year: "), F.coalesce(F.col("year").cast("string"), F.lit("Unknown")),
        F.lit(", Safety: "), text("safety_label", "Unknown"),
        F.lit(", DO: "), number("do_avg"), F.lit(", BOD: "), number("bod_avg"),
        F.lit(", pH: "), number("ph_avg"), F.lit(", Nitrate: "), number("nitrate_avg"),
        F.lit(", Fecal Coliform: "), number("fecal_coliform_avg"),
        F.lit(", Pollution Score: "), number("pollution_score"), F.lit("/10, Violations: "),
        text("violated_params", "None"),
    )
    return df.withColumn("station_context", line)


SYSTEM_PROMPT = (
    "You are a water quality expert. Reply with one JSON object and nothing else. Use the given "
    "station data and guideline texts and name values and standards. Scores run from 0 to 10: "
    "0-2 Clean, 2-4 Moderate, 4-7 Polluted, 7-10 Severely Polluted."
)


def prompt_table(requests: DataFrame) -> DataFrame:
    """One prompt per request, for a model that runs elsewhere.

    Input: request_id, message, station_context ('' without station), safety_label, violations
    (JSON text or NULL), context_text and history (array of role/content). The strict form asks
    the model to keep to the computed violations; it is used when a station is chosen and the
    message is about this station and its risk.
    """
    station = F.coalesce("station_context", F.lit(""))
    strict = (station != "") & M.is_station_question(F.col("message")) & M.is_risk_question(
        F.col("message"))
    guideline = F.coalesce(F.nullif("context_text", F.lit("")), F.lit("No context retrieved"))
    strict_text = F.concat(
        F.lit("Question: "), F.col("message"), F.lit("\n\nStation: "), station,
        F.lit("\nStored safety label: "), F.col("safety_label"),
        F.lit("\nComputed violations, complete and final: "),
        F.coalesce("violations", F.lit("none, all limits are met")),
        F.lit("\n\nGuidelines:\n"), guideline,
        F.lit("\n\nReport exactly these violations. Without violations the status is Safe. "
              "Answer in 3-5 sentences in the field 'answer'."),
    )
    open_text = F.concat(
        F.lit("Question: "), F.col("message"), F.lit("\n\nStation (for reference): "),
        F.coalesce(F.nullif(station, F.lit("")), F.lit("none")),
        F.lit("\n\nGuidelines:\n"), guideline,
        F.lit("\n\nAnswer in 3-5 sentences in the field 'answer'. Set safety_status to null and "
              "violations to []."),
    )
    return requests.select(
        "request_id", strict.alias("strict"), F.lit(SYSTEM_PROMPT).alias("system_prompt"),
        F.when(strict, strict_text).otherwise(open_text).alias("user_prompt"), "history",
    )


INSIGHT_SYSTEM_PROMPT = (
    "You are a water quality expert. Use the given texts and sound reasoning. Reply with one "
    "strict JSON object."
)


def insight_prompt_table(requests: DataFrame) -> DataFrame:
    """Prompts for missing insights, one per (violations, water body).

    Input: violated_params (text), water_body_type, params (array) and context_text.
    """
    user = F.concat(
        F.lit("Analyse the water pollution of a station.\nStation name: "), F.col("water_body_type"),
        F.lit("\nWater body type: "), F.col("water_body_type"), F.lit("\nViolated parameters: "),
        F.coalesce(F.nullif(F.array_join("params", ", "), F.lit("")), F.lit("None provided")),
        F.lit("\n\nContext:\n"),
        F.coalesce(F.nullif("context_text", F.lit("")), F.lit("No relevant context retrieved.")),
        F.lit("\n\nReturn station_name, water_body_type, violated_params, causes_of_pollution "
              "(3-7 items), recommended_measures (3-7 items) and retrieved_context_count."),
    )
    return requests.select(
        "violated_params", "water_body_type",
        F.lit(INSIGHT_SYSTEM_PROMPT).alias("system_prompt"), user.alias("user_prompt"),
    )


def suggest_questions(
    df: DataFrame, key: str = "stn_code", given: str | None = None
) -> DataFrame:
    """Up to three suggested questions per station, in order.

    ``given`` names a column with the violations of the request (array); where it is not NULL it
    replaces those of the row, also when it is empty.
    Two 'why' and two 'what to do' questions for the first two violations, else three general
    ones. A violation's value is quoted where its label is part of a computed violation's name.
    """
    station = F.coalesce(
        F.nullif(strip("monitoring_location"), F.lit("")), F.lit("this station"))
    computed = violation_structs()

    def why(param: Column) -> Column:
        match = F.get(F.filter(F.col("_computed"), lambda v: F.contains(
            F.lower(v["parameter"]), F.lower(param))), F.lit(0))
        value = match["value"]
        return F.struct(
            F.when(value.isNotNull(), F.concat(
                F.lit("Why is "), param, F.lit(" high at "), station, F.lit(" (current: "), value,
                F.lit(")?")))
            .otherwise(F.concat(
                F.lit("Why is "), param, F.lit(" elevated at "), station, F.lit("?"))).alias("text"),
            F.when(value.isNotNull(), F.concat(F.lit("Detected violation: "), param))
            .otherwise(F.concat(F.lit("Detected potential issue: "), param)).alias("reason"),
        )

    def what(param: Column) -> Column:
        return F.struct(
            F.concat(F.lit("What actions can reduce "), param, F.lit(" contamination at "), station,
                     F.lit("?")).alias("text"),
            F.concat(F.lit("Mitigation for "), param).alias("reason"),
        )

    general = F.array(*[
        F.struct(F.lit(text).alias("text"), F.lit(reason).alias("reason"))
        for text, reason in R.SUGGESTIONS_WITHOUT_VIOLATIONS
    ])
    items = F.filter(
        F.transform(F.split(F.coalesce("violated_params", F.lit("")), ","), lambda p: strip(p)),
        lambda p: p != "")
    if given is not None:
        items = F.coalesce(F.col(given), items)
    named = df.withColumn("_params", F.slice(items, 1, 2)).withColumn("_computed", computed)
    chosen = F.when(F.size("_params") == 0, general).otherwise(
        F.slice(F.array_distinct(F.concat(
            F.transform("_params", why), F.transform("_params", what))), 1, 3))
    return named.select(key, F.posexplode(chosen).alias("position", "q")).select(
        key, "position", "q.text", "q.reason")


def merge_chat_answer(replies: DataFrame) -> DataFrame:
    """Final answer per request from the model's reply and the computed facts.

    Input: request_id, reply, has_station, safety_label and violations (array of parameter, value,
    limit_text, status). With a station the computed label and violations replace the model's
    and the reason opens the answer. Otherwise well-formed violations of the reply are kept.
    A reply without JSON gives the fallback answer. What the request knew stays beside the answer:
    station_name, violated_params (text, returned as array), context_count as sources_used and
    has_station as has_station_context; where a column is absent the field is NULL, empty or 0.
    """
    def known(column: str, default: Column) -> Column:
        return F.coalesce(F.col(column), default) if column in replies.columns else default

    parsed = replies.withColumn("_json", M.json_object(F.col("reply")))
    cause_field = F.get_json_object("_json", "$.causes")
    causes = F.when(F.startswith(cause_field, F.lit("[")), F.from_json(cause_field, "array<string>")
                    ).otherwise(F.array(cause_field))
    first_cause = F.get(F.filter(causes, lambda c: strip(c) != ""), F.lit(0))
    answer = F.coalesce(
        F.nullif(strip(F.get_json_object("_json", "$.answer")), F.lit("")),
        F.nullif(strip(first_cause), F.lit("")), F.lit(R.FALLBACK_ANSWER),
    )
    reason = F.array_join(F.transform("violations", lambda v: F.concat(
        v["parameter"], F.lit(" = "), v["value"], F.lit(" (limit: "), v["limit_text"], F.lit(")"))), "; ")
    has_reason = F.col("has_station") & (F.size("violations") > 0)
    own = F.from_json(
        F.get_json_object("_json", "$.violations"),
        "array<struct<parameter: string, value: string, limit: string, status: string>>")
    own = F.transform(
        F.filter(own, lambda v: v["parameter"].isNotNull() & v["value"].isNotNull()
                 & v["limit"].isNotNull() & v["status"].isNotNull()),
        lambda v: F.struct(v["parameter"].alias("parameter"), v["value"].alias("value"),
                           v["limit"].alias("limit_text"), v["status"].alias("status")))
    failed = F.col("_json").isNull()
    nothing = F.filter("violations", lambda v: F.lit(False))
    empty = F.array().cast("array<string>")
    return parsed.select(
        "request_id",
        F.when(failed, R.FALLBACK_ANSWER).when(has_reason, F.concat(
            F.lit("Station label: "), F.col("safety_label"), F.lit(". Reason: "), reason,
            F.lit(". "), answer)).otherwise(answer).alias("answer"),
        F.when(failed, F.lit(None)).when(F.col("has_station"), F.col("safety_label"))
        .otherwise(F.get_json_object("_json", "$.safety_status")).alias("safety_status"),
        F.when(failed, nothing).when(F.col("has_station"), F.col("violations"))
        .otherwise(F.coalesce(own, nothing)).alias("violations"),
        *[F.when(failed, empty).otherwise(M.response_list(F.col("_json"), c)).alias(c)
          for c in ("causes", "health_risks", "recommended_actions")],
        known("context_count", F.lit(0)).cast("bigint").alias("sources_used"),
        F.nullif(strip(known("station_name", F.lit(None).cast("string"))), F.lit("")).alias("station_name"),
        split_list(known("violated_params", F.lit(""))).alias("violated_params"),
        F.coalesce("has_station", F.lit(False)).alias("has_station_context"),
    )
