"""Violation texts: parsing, canonical names, causes and impacts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.text import split_list, strip

NO_STRINGS = "array<string>"


def normalize_param(text: Column) -> Column:
    """Canonical parameter of a free text, NULL when unknown. The order of the tests matters."""
    t = F.lower(strip(F.coalesce(text, F.lit(""))))
    return (
        F.when(t.isin("", "none", "na", "n/a"), F.lit(None).cast("string"))
        .when(F.contains(t, F.lit("bod")), "BOD")
        .when(F.contains(t, F.lit("dissolved oxygen")) | (t == "do")
              | F.contains(t, F.lit("low do")), "DO")
        .when(F.contains(t, F.lit("nitrate")), "Nitrate")
        .when(F.contains(t, F.lit("fecal")) & F.contains(t, F.lit("coliform")), "Fecal Coliform")
        .when((t == "p h") | F.contains(t, F.lit("ph")), "pH")
    )


def parse_violations(text: Column) -> Column:
    """Ordered distinct canonical parameters of a comma-separated violation text."""
    named = F.transform(split_list(text), normalize_param)
    return F.array_distinct(F.filter(named, lambda name: name.isNotNull()))


def _knowledge(position: int) -> Column:
    pairs = []
    for name, texts in R.PARAMETER_KNOWLEDGE.items():
        pairs += [F.lit(name), F.lit(texts[position])]
    return F.create_map(*pairs)


def _mapped(params: Column, position: int) -> Column:
    texts = F.transform(params, lambda name: F.try_element_at(_knowledge(position), name))
    return F.array_distinct(F.filter(texts, lambda text: text.isNotNull()))


def causes(params: Column) -> Column:
    return _mapped(params, 0)


def impacts(params: Column) -> Column:
    return _mapped(params, 1)


def followup_questions(params: Column, label: Column) -> Column:
    """Up to three follow-up questions: by violated parameter, then by label."""
    def question(name: Column) -> Column:
        found = F.lit(None).cast("string")
        for key, text in reversed(R.FOLLOWUP_UNSAFE):
            found = F.when(F.contains(F.lower(name), F.lit(key.lower())), F.lit(text)).otherwise(found)
        return found

    def fixed(texts: list[str]) -> Column:
        return F.array(*[F.lit(t) for t in texts])

    specific = F.filter(F.transform(params, question), lambda q: q.isNotNull())
    unsafe = F.slice(F.array_distinct(F.concat(
        F.slice(F.array_distinct(specific), 1, 2), fixed(R.FOLLOWUP_DEFAULT))), 1, 3)
    return (
        F.when(label == "Safe", fixed(R.FOLLOWUP_SAFE))
        .when(label == "Unsafe", unsafe)
        .otherwise(fixed(R.FOLLOWUP_GENERAL))
    )


def violation_structs() -> Column:
    """Array of (parameter, value, limit, status) for every violated Class-A limit of a row."""
    def entry(column: str, name: str, condition: Column, limit: str, unit: str) -> Column:
        value = F.col(column).cast("double")
        return F.when(condition, F.struct(
            F.lit(name).alias("parameter"),
            F.concat(value.cast("string"), F.lit(f" {unit}")).alias("value"),
            F.lit(limit).alias("limit_text"),
            F.lit("critical").alias("status"),
        ))

    ph, do = F.col("ph_avg"), F.col("do_avg")
    entries = [
        entry("ph_avg", "pH", (ph < R.CLASS_A_PH_MIN) | (ph > R.CLASS_A_PH_MAX),
              f"{R.CLASS_A_PH_MIN}-{R.CLASS_A_PH_MAX} (BIS/WHO)", "mg/L"),
        entry("do_avg", "Dissolved Oxygen", do < R.CLASS_A_DO_MIN,
              f"min {R.CLASS_A_DO_MIN} mg/L (CPCB)", "mg/L"),
        entry("bod_avg", "BOD", F.col("bod_avg") > R.CLASS_A_BOD_MAX,
              f"max {R.CLASS_A_BOD_MAX} mg/L (CPCB)", "mg/L"),
        entry("nitrate_avg", "Nitrate", F.col("nitrate_avg") > R.CLASS_A_NITRATE_MAX,
              f"max {R.CLASS_A_NITRATE_MAX} mg/L (WHO)", "mg/L"),
        entry("fecal_coliform_avg", "Fecal Coliform",
              F.col("fecal_coliform_avg") > R.CLASS_A_FECAL_MAX,
              f"max {R.CLASS_A_FECAL_MAX} MPN/100ml (WHO)", "MPN/100ml"),
    ]
    return F.filter(F.array(*entries), lambda e: e.isNotNull())
