"""Cleaning, labels and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.functions import scoring as C
from rivulet.functions.text import stn_code, title_case
from rivulet.functions.violations import violation_structs
from rivulet.operators.shaping import bind, project_known_columns, require_columns


def stn_code_fill(df: DataFrame) -> DataFrame:
    return df.withColumn("stn_code", stn_code(F.col("stn_code"), F.col("monitoring_location")))


def cap_outliers(df: DataFrame) -> DataFrame:
    """Values above a hard cap are set to the cap; missing values stay missing."""
    caps = {
        c: F.when(F.col(c) > cap, F.lit(cap)).otherwise(F.col(c))
        for c, cap in R.OUTLIER_CAPS.items() if c in df.columns
    }
    return df.withColumns(caps)


def classify_bis(df: DataFrame) -> DataFrame:
    return df.withColumn("safety_label", C.safety_label(C.bis_conditions()))


def violations_bis(df: DataFrame) -> DataFrame:
    return df.withColumn("violated_params", C.violation_text(C.bis_conditions(), "None"))


def score_100(df: DataFrame, name: str = "pollution_score") -> DataFrame:
    parts = {f"_part_{k}": v for k, v in C.sub_scores_100().items()}
    score = C.mean_of_known([F.col(p) for p in parts], cap=100.0, digits=2)
    return bind(df, **parts).withColumn(name, score).drop(*parts)


def clean_samples(df: DataFrame) -> DataFrame:
    """Extracted samples to clean samples: code, title, caps, label, score, violations.

    The code is filled before the location changes, and caps come before scores.
    """
    coded = stn_code_fill(df).withColumn(
        "monitoring_location", title_case(F.col("monitoring_location"))
    )
    scored = violations_bis(score_100(classify_bis(cap_outliers(coded))))
    return project_known_columns(scored, S.CLEAN_COLUMNS)


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Counts of the cleaning steps over extracted samples, in one pass."""
    scored = score_100(classify_bis(cap_outliers(
        raw.withColumns({f"_raw_{c}": F.col(c) for c in R.OUTLIER_CAPS if c in raw.columns})
    )))
    over = [
        F.count_if(F.col(f"_raw_{c}") > cap).alias(f"capped_{c}")
        for c, cap in R.OUTLIER_CAPS.items() if c in raw.columns
    ]
    return scored.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("stn_code").isNull()).alias("missing_codes"),
        *over,
        F.count_if(F.col("safety_label") == "Safe").alias("safe_count"),
        F.count_if(F.col("safety_label") == "Unsafe").alias("unsafe_count"),
        F.min("pollution_score").alias("min_score"),
        F.max("pollution_score").alias("max_score"),
    )


def score_10(df: DataFrame, name: str = "pollution_score") -> DataFrame:
    """Adds the 0-10 score; NULL when no scored parameter is known."""
    require_columns(df)
    parts = {f"_part_{k}": v for k, v in C.contributions().items()}
    by_name = {k: F.col(f"_part_{k}") for k in R.CLASS_A_WEIGHTS}
    weighed = bind(bind(df, **parts), _weight=C.known_weight(by_name))
    return weighed.withColumn(name, C.blended_score(by_name, F.col("_weight"))).drop(
        "_weight", *parts)


def classify_class_a(df: DataFrame) -> DataFrame:
    """Adds violated_params ('' when none) and safety_label by the Class-A limits."""
    require_columns(df)
    conditions = C.class_a_conditions()
    return df.withColumns({
        "violated_params": C.violation_text(conditions, ""),
        "safety_label": C.safety_label(conditions),
    })


def scored(df: DataFrame) -> DataFrame:
    """0-10 score and Class-A labels: the table most reports read."""
    return classify_class_a(score_10(df))


def violation_details(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per violated limit: parameter, value with unit, limit text, status."""
    return df.select(*keys, F.inline(violation_structs()))


def with_band(df: DataFrame) -> DataFrame:
    return df.withColumn("band", C.score_band(F.col("pollution_score")))
