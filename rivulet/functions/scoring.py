"""Scores, labels and violation lists as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.numbers import any_of, known


def _value(name: str) -> Column:
    return known(F.col(name))


# ---- 0-100 score and BIS label of cleaned samples -------------------------

def bis_conditions() -> list[tuple[str, Column]]:
    """(violation text, condition) in reporting order."""
    ph = _value("ph_avg")
    return [
        ("Low DO", _value("do_avg") < R.BIS_DO_MIN),
        ("pH Out of Range", (ph < R.BIS_PH_MIN) | (ph > R.BIS_PH_MAX)),
        ("High BOD", _value("bod_avg") > R.BIS_BOD_MAX),
        ("High Fecal Coliform", _value("fecal_coliform_avg") > R.BIS_FECAL_MAX),
        ("High Total Coliform", _value("total_coliform_avg") > R.BIS_TOTAL_MAX),
    ]


def class_a_conditions() -> list[tuple[str, Column]]:
    ph = _value("ph_avg")
    return [
        ("pH", (ph < R.CLASS_A_PH_MIN) | (ph > R.CLASS_A_PH_MAX)),
        ("DO", _value("do_avg") < R.CLASS_A_DO_MIN),
        ("BOD", _value("bod_avg") > R.CLASS_A_BOD_MAX),
        ("Nitrate", _value("nitrate_avg") > R.CLASS_A_NITRATE_MAX),
        ("Fecal Coliform", _value("fecal_coliform_avg") > R.CLASS_A_FECAL_MAX),
    ]


def safety_label(conditions: list[tuple[str, Column]]) -> Column:
    violated = any_of([condition for _, condition in conditions])
    return F.when(violated, F.lit("Unsafe")).otherwise(F.lit("Safe"))


def violation_text(conditions: list[tuple[str, Column]], empty: str) -> Column:
    texts = [F.when(condition, F.lit(text)) for text, condition in conditions]
    return F.coalesce(F.nullif(F.concat_ws(", ", *texts), F.lit("")), F.lit(empty))


def sub_scores_100() -> dict[str, Column]:
    """Per-parameter parts of the 0-100 score; NULL where the value is missing."""
    do, bod, ph = _value("do_avg"), _value("bod_avg"), _value("ph_avg")
    fecal, total = _value("fecal_coliform_avg"), _value("total_coliform_avg")

    def capped(part: Column) -> Column:
        return F.when(part > 100, F.lit(100.0)).otherwise(part)

    do_gap = (F.lit(R.BIS_DO_MIN) - do) / R.BIS_DO_MIN
    return {
        "do": F.when(do_gap < 0, F.lit(0.0)).otherwise(do_gap) * 100,
        "bod": capped(bod / R.BIS_BOD_MAX * R.BIS_BOD_FACTOR),
        "ph": F.when(ph < R.BIS_PH_MIN, (F.lit(R.BIS_PH_MIN) - ph) / R.BIS_PH_MIN * 100)
        .when(ph > R.BIS_PH_MAX, (ph - R.BIS_PH_MAX) / R.BIS_PH_MAX * 100)
        .when(ph.isNotNull(), F.lit(0.0)),
        "fecal": capped(fecal / R.BIS_FECAL_MAX * R.BIS_COLIFORM_FACTOR),
        "total": capped(total / R.BIS_TOTAL_MAX * R.BIS_COLIFORM_FACTOR),
    }


def mean_of_known(parts: list[Column], cap: float, digits: int) -> Column:
    """Rounded mean of the known parts, 0.0 when none is known."""
    total, count = F.lit(0.0), F.lit(0)
    for part in parts:
        total = total + F.coalesce(part, F.lit(0.0))
        count = count + F.when(part.isNotNull(), 1).otherwise(0)
    mean = total / F.nullif(count, F.lit(0))
    limited = F.when(mean > cap, F.lit(cap)).otherwise(mean)
    return F.coalesce(F.round(limited, digits), F.lit(0.0))


# ---- 0-10 score ------------------------------------------------------------

def contributions() -> dict[str, Column]:
    """Normalised 0..1 share of each Class-A parameter; NULL where the value is missing."""
    ph, do = _value("ph_avg"), _value("do_avg")
    fecal = _value("fecal_coliform_avg")

    def at_most_one(share: Column) -> Column:
        return F.when(share > 1, F.lit(1.0)).otherwise(share)

    def above(value: Column, limit: float) -> Column:
        return F.when(value <= limit, F.lit(0.0)).when(
            value.isNotNull(), at_most_one((value - limit) / limit)
        )

    # Fecal coliform spans orders of magnitude: a hundredfold excess counts as 1.
    excess = F.log2(fecal / R.CLASS_A_FECAL_MAX) / F.log2(F.lit(100.0))
    return {
        "ph": F.when(ph < R.CLASS_A_PH_MIN, (F.lit(R.CLASS_A_PH_MIN) - ph) / R.CLASS_A_PH_MIN)
        .when(ph > R.CLASS_A_PH_MAX, at_most_one((ph - R.CLASS_A_PH_MAX) / R.CLASS_A_PH_MAX))
        .when(ph.isNotNull(), F.lit(0.0)),
        "do": F.when(do >= R.CLASS_A_DO_MIN, F.lit(0.0)).when(
            do.isNotNull(), at_most_one((F.lit(R.CLASS_A_DO_MIN) - do) / R.CLASS_A_DO_MIN)
        ),
        "bod": above(_value("bod_avg"), R.CLASS_A_BOD_MAX),
        "nitrate": above(_value("nitrate_avg"), R.CLASS_A_NITRATE_MAX),
        "fecal": F.when(fecal <= R.CLASS_A_FECAL_MAX, F.lit(0.0)).when(
            fecal.isNotNull(), F.sqrt(at_most_one(excess))
        ),
    }


def known_weight(parts: dict[str, Column]) -> Column:
    """Sum of the weights of the known shares; NULL if none is known."""
    total = F.lit(0.0)
    for name, part in parts.items():
        total = total + F.when(part.isNotNull(), R.CLASS_A_WEIGHTS[name]).otherwise(0.0)
    return F.nullif(total, F.lit(0.0))


def blended_score(parts: dict[str, Column], weight: Column) -> Column:
    """0-10 score: largest share and weighted mean of the known shares; NULL if none is known."""
    weighted = F.lit(0.0)
    for name, part in parts.items():
        weighted = weighted + F.coalesce(part * (F.lit(R.CLASS_A_WEIGHTS[name]) / weight), F.lit(0.0))
    dominant = F.greatest(*parts.values())
    return F.round((dominant * R.DOMINANT_SHARE + weighted * R.WEIGHTED_SHARE) * 10, 3)


# ---- derived flags ---------------------------------------------------------

def score_band(score: Column) -> Column:
    """Band of a 0-10 score, lower bound inclusive."""
    return (
        F.when(score < 2, "Clean").when(score < 4, "Moderate").when(score < 7, "Polluted")
        .when(score.isNotNull(), "Severely Polluted")
    )


def risk_bucket(rate: Column) -> Column:
    return F.when(rate < 20, "low").when(rate < 50, "medium").when(rate.isNotNull(), "high")


def limit_status(parameter: str, value: Column, limit: float | None) -> Column:
    """'violation' or 'ok' by display limit; DO has a minimum, pH is never judged."""
    if limit is None or parameter == "ph_avg":
        return F.lit("ok")
    beyond = value < limit if parameter == "do_avg" else value > limit
    return F.when(beyond, "violation").otherwise("ok")


def change_direction(
    first: Column, latest: Column, higher_is_better: bool,
    better: str, worse: str, missing: str,
) -> Column:
    """Direction of change; below 5 % of the first value it is 'Stable'.

    A first value of 0 leaves no tolerance, so 0 -> 0 counts as worse.
    """
    improved = latest > first if higher_is_better else latest < first
    return (
        F.when(first.isNull() | latest.isNull(), missing)
        .when(F.abs(latest - first) < F.abs(first) * R.STABLE_SHARE, "Stable")
        .when(improved, better)
        .otherwise(worse)
    )
