"""Rule-based explanations and cached insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions import violations as V
from rivulet.functions.replies import json_object, text_list, value_text
from rivulet.functions.text import clean_items, json_list, split_list
from rivulet.operators.score import scored


def explain(df: DataFrame) -> DataFrame:
    """Adds canonical parameters, causes and impacts as arrays."""
    return df.withColumn("params", V.parse_violations(F.col("violated_params"))).withColumns({
        "causes": V.causes(F.col("params")), "impacts": V.impacts(F.col("params")),
    })


def knowledge_table(spark) -> DataFrame:
    rows = [(name, *texts) for name, texts in R.PARAMETER_KNOWLEDGE.items()]
    return spark.createDataFrame(rows, "parameter string, cause string, impact string")


def join_param_knowledge(df: DataFrame, keys: list[str], knowledge: DataFrame) -> DataFrame:
    """One row per sample and violated parameter with its cause and impact."""
    exploded = df.select(
        *keys, F.posexplode(V.parse_violations(F.col("violated_params"))).alias("position", "parameter")
    )
    return exploded.join(knowledge, "parameter")


def join_insights(df: DataFrame, insights: DataFrame) -> DataFrame:
    """Adds the recommended measures cached for a sample's violations and water body.

    A handful of violation texts carry most rows. The insight side is small and is broadcast by
    Spark while it is under the threshold; beyond it skewed keys are split.
    """
    measures = insights.select(
        "violated_params", "water_body_type",
        F.array_distinct(clean_items(F.col("recommended_measures"))).alias("measures"),
    )
    return df.join(measures, ["violated_params", "water_body_type"], "left").withColumn(
        "measures", F.coalesce("measures", F.array().cast("array<string>"))
    )


def enrich_samples(df: DataFrame, insights: DataFrame | None = None) -> DataFrame:
    """Score, labels and explanations of samples; the lists become JSON text."""
    explained = explain(scored(df))
    if insights is None:
        explained = explained.withColumn("measures", F.array().cast("array<string>"))
    else:
        explained = join_insights(explained, insights)
    return explained.withColumns({
        c: json_list(F.col(c)) for c in ("causes", "impacts", "measures")
    }).drop("params")


def followups(df: DataFrame, key: str) -> DataFrame:
    """Follow-up questions per key, in order."""
    questions = V.followup_questions(split_list(F.col("violated_params")), F.col("safety_label"))
    return df.select(key, F.posexplode(questions).alias("position", "question"))


def extract_json_object(df: DataFrame, text: str = "reply") -> DataFrame:
    """Adds the JSON text found in a reply, or an error."""
    return df.withColumn("json", json_object(F.col(text))).withColumn(
        "error", F.when(F.col("json").isNull(), F.lit("no valid JSON in reply"))
    )


def normalize_insight(df: DataFrame) -> DataFrame:
    """Typed insight fields of parsed replies, whatever else the reply holds.

    Input: json, station_name, water_body_type, violated_params (array) and context_count of the
    request. A missing field takes the request's value; a list that is a text, number or object is
    taken as missing or, for causes and measures, as empty. Items of any type are given as texts.
    """
    parsed = df.withColumn("_r", F.try_parse_json("json"))

    def field(name: str):
        return F.try_variant_get("_r", f"$.{name}", "variant")

    def items(name: str, default):
        return clean_items(F.coalesce(text_list(field(name)), default))

    none = F.array().cast("array<string>")
    return parsed.withColumns({
        "station_name": F.coalesce(value_text(field("station_name")), "station_name"),
        "water_body_type": F.coalesce(value_text(field("water_body_type")), "water_body_type"),
        "violated_params": items("violated_params", F.col("violated_params")),
        "causes_of_pollution": items("causes_of_pollution", none),
        "recommended_measures": items("recommended_measures", none),
        "retrieved_context_count": F.col("context_count").cast("int"),
    }).drop("_r", "context_count")
