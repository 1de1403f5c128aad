"""Label evaluation and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.numbers import fixed_point
from rivulet.operators.shaping import not_null

LABELS = ["Safe", "Unsafe"]


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts and percentages of the four label pairs, all four always present."""
    cells = [(a, p) for a in LABELS for p in LABELS]
    counts = df.agg(*[
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"{a}_{p}")
        for a, p in cells
    ])
    total = sum((F.col(f"{a}_{p}") for a, p in cells), F.lit(0))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                 F.col(f"{a}_{p}").alias("n"),
                 F.try_divide(F.col(f"{a}_{p}") * 100.0, total).alias("percentage"))
        for a, p in cells
    ])))


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 per label and accuracy; an empty denominator gives 0."""
    aggregates = [
        F.count("*").alias("rows"), F.count_if(F.col(actual) == F.col(predicted)).alias("right")
    ]
    for label in LABELS:
        is_a, is_p = F.col(actual) == label, F.col(predicted) == label
        aggregates += [F.count_if(is_a & is_p).alias(f"hit_{label}"),
                       F.count_if(is_a).alias(f"actual_{label}"),
                       F.count_if(is_p).alias(f"predicted_{label}")]

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    entries = []
    for label in LABELS:
        hit, a, p = (F.col(f"{k}_{label}") for k in ("hit", "actual", "predicted"))
        for name, value in (("Precision", ratio(hit, p)), ("Recall", ratio(hit, a)),
                            ("F1", ratio(hit * 2, a + p))):
            entries.append((f"{name} ({label})", value))
    entries.append(("Accuracy", ratio(F.col("right"), F.col("rows"))))
    return df.agg(*aggregates).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in entries
    ])))


def value_counts(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Rows per distinct value.

    Scores have three decimals, so there are at most some ten thousand of them whatever the size
    of the table: the exact quantiles below work on these counts.
    """
    return not_null(df, value).groupBy(*(keys or []), value).agg(F.count("*").alias("n"))


def histogram(
    counts: DataFrame, value: str, bins: int, lo: Column, hi: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Equal bins between two ends, per key; the last bin includes the upper end.

    ``counts`` holds values and their frequency n. Equal ends are moved apart by one half.
    """
    flat = F.col("lo") == F.col("hi")
    placed = counts.withColumns({"lo": lo, "hi": hi}).withColumns({
        "lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")),
    }).withColumn("bin", F.least(
        F.floor((F.col(value) - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
        F.lit(bins - 1)) + 1)
    row = placed.groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        *[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)).alias(f"n{i}")
          for i in range(1, bins + 1)],
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return row.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(i).alias("bin"), (F.col("lo") + width * (i - 1)).alias("lower"),
                 F.col(f"n{i}").alias("n"))
        for i in range(1, bins + 1)
    ])))


def score_histogram(df: DataFrame, value: str = "pollution_score", bins: int = 30) -> DataFrame:
    """Distribution of the scores: their counts are placed between both ends, read by a scalar subquery."""
    counts = value_counts(df, value)
    ends = counts.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("ends"))
    placed = counts.withColumn("ends", ends.scalar())
    return histogram(placed, value, bins, F.col("ends.lo"), F.col("ends.hi"))


def score_centre(df: DataFrame, value: str = "pollution_score") -> DataFrame:
    """Mean and exact median of the scores."""
    counts = value_counts(df, value)
    total = F.sum(fixed_point(F.col(value)) * F.col("n"))
    return counts.agg(
        (total / F.sum("n") / 1_000_000.0).alias("mean_score"),
        F.percentile(value, 0.5, F.col("n")).alias("median_score"),
    )


def error_histogram(metrics: DataFrame, bins: int = 20) -> DataFrame:
    """Distribution of each forecast error over stations.

    Errors are as many as stations, so the ends are read first, by scalar subqueries.
    """
    names = ("mae", "rmse", "mape")
    ends = metrics.agg(F.struct(*[
        f(n).alias(f"{a}_{n}") for n in names for a, f in (("lo", F.min), ("hi", F.max))
    ]).alias("ends"))
    long = metrics.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("error"), F.lit(1).alias("n"))
        for n in names
    ])))
    placed = not_null(long, "error").withColumn("ends", ends.scalar())

    def end(which: str) -> Column:
        chosen = F.when(F.col("metric") == names[0], F.col(f"ends.{which}_{names[0]}"))
        for name in names[1:]:
            chosen = chosen.when(F.col("metric") == name, F.col(f"ends.{which}_{name}"))
        return chosen

    return histogram(placed, "error", bins, end("lo"), end("hi"), ["metric"])


def box_stats(
    df: DataFrame, key: str = "water_body_type", value: str = "pollution_score"
) -> DataFrame:
    """Quartiles, whiskers (within 1.5 quartile ranges) and outlier count per group.

    The quartiles come from the counts of distinct values, merged by weight, and are joined back to
    these counts. A group without a key is one of its own.
    """
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    counts = value_counts(df, value, [key])
    quartiles = counts.groupBy(F.col(key).alias("_key")).agg(
        F.percentile(value, shares, F.col("n")).alias("q"))
    counts = counts.join(quartiles, F.col(key).eqNullSafe(F.col("_key"))).withColumns({
        "q1": F.col("q")[0], "median": F.col("q")[1], "q3": F.col("q")[2],
    })
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return counts.groupBy(key).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def retrieval_summary(hits: DataFrame, key: str = "query_id") -> DataFrame:
    """Per query the number of chunks found and the start of the best one."""
    best = F.min(F.struct("rank", F.substring("document", 1, 80).alias("text")))["text"]
    return hits.groupBy(key).agg(F.count("*").alias("chunks"), best.alias("preview"))
