"""Column profiles: missing values, quantiles, distributions, prevalence, weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.operators import ranks


def wide_to_long(rows: DataFrame, names: list[str], keys: list[str] | None = None,
                 kind: str = "double") -> DataFrame:
    """One row per key and column, as `variable` and `value`."""
    keys = keys or []
    cast = rows.select(*keys, *[F.col(name).cast(kind).alias(name) for name in names])
    return cast.unpivot(keys, names, "variable", "value")


def bounds(rows: DataFrame, names: list[str], low: float, high: float) -> DataFrame:
    """Exact lower and upper quantile per column, as a row per variable."""
    long = wide_to_long(rows, names)
    return ranks.quantiles(long, ["variable"], "value", {"low": low, "high": high})


def quantile_outliers_to_null(
    rows: DataFrame, names: list[str], low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Values outside the columns' quantiles set to null."""
    found = bounds(rows, names, low, high)
    # One row, one struct per column: used as a constant, not joined.
    one = found.agg(
        *[
            F.max(F.when(F.col("variable") == name, F.struct("low", "high"))).alias(name)
            for name in names
        ]
    ).select(F.struct(*names).alias("limits"))
    limits = one.scalar()
    return rows.withColumns({
        name: F.when(
            F.col(name).between(limits[name]["low"], limits[name]["high"]), F.col(name)
        )
        for name in names
    })


def missingness(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per column: missing values and the share of rows that have one."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(name)).alias(name) for name in names],
    )
    return counts.unpivot(["_rows"], names, "variable", "present").select(
        "variable",
        (F.col("_rows") - F.col("present")).alias("n_missing"),
        F.try_divide("present", "_rows").alias("complete_rate"),
    )


def numeric_profile(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per column: mean, standard deviation and the five quartiles."""
    spread = rows.agg(F.array(*[
        F.struct(
            F.lit(name).alias("variable"), F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("sd"),
        )
        for name in names
    ]).alias("parts")).select(F.inline("parts"))
    quartiles = ranks.quantiles(
        wide_to_long(rows, names), ["variable"], "value",
        {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0},
    )
    return spread.join(quartiles, "variable")


def long_ecdf(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per column and value, the share of rows at or below it."""
    long = wide_to_long(rows, names)
    table = ranks.cumulate(
        ranks.value_counts(long, ["variable"], "value"), ["variable"], "value", ["n"]
    )
    return table.select(
        "variable", "value", "n", ((F.col("n_before") + F.col("n")) / F.col("n_total")).alias("ecdf")
    )


def prevalence(rows: DataFrame, outcomes: list[str]) -> DataFrame:
    """Per outcome column and value: rows and percent, unlabelled rows left out."""
    counts = (
        wide_to_long(rows, outcomes, kind="string").filter("value is not null")
        .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return with_percent(counts, ["variable"], "n")


def with_percent(counts: DataFrame, groups: list[str], count: str) -> DataFrame:
    """`counts` with each row's percent of its group."""
    if not groups:
        total = counts.agg(F.sum(count)).scalar()
        return counts.withColumn("percentage", F.col(count) * 100 / total)
    totals = counts.groupBy(*groups).agg(F.sum(count).alias("_total"))
    return counts.join(totals, groups).withColumn(
        "percentage", F.col(count) * 100 / F.col("_total")
    ).drop("_total")


def distinct_person_share(rows: DataFrame, categories: list[str]) -> DataFrame:
    """Per category column and value: distinct persons and their percent."""
    long = wide_to_long(rows, categories, ["person_id"], kind="string")
    # Distinct pairs first, so that no category value gathers its persons in one task.
    counts = long.distinct().groupBy("variable", "value").agg(F.count(F.lit(1)).alias("persons"))
    return with_percent(counts, ["variable"], "persons")


def class_weights(rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    """`rows` with a weight column per label column that offsets the class imbalance.

    The share of active rows counts unlabelled rows in its denominator; an
    unlabelled row has no weight.
    """
    shares = rows.agg(F.struct(*[
        F.try_divide(
            F.count(F.when(F.col(label) == fixed.ACTIVE, 1)), F.count(F.lit(1))
        ).alias(label)
        for label in labels
    ])).scalar()

    def weight(label: str) -> Column:
        share = shares[label]
        return F.when(F.col(label) == fixed.DISENGAGED, share).when(
            F.col(label).isNotNull(), 1 - share
        )

    return rows.withColumns({name: weight(label) for label, name in labels.items()})


def score_density(rows: DataFrame, score: str, actual: str, bins: int) -> DataFrame:
    """Rows per score bin of equal width over [0, 1] and actual class."""
    spot = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(spot.alias("bin"), F.col(actual).alias("actual")).agg(
        F.count(F.lit(1)).alias("n")
    )


def top_outcomes(rows: DataFrame, score: str, actual: str, shares: dict[str, float]) -> DataFrame:
    """Actual classes among the scores above each quantile."""
    cuts = ranks.quantiles(rows, [], score, shares).select(F.struct(*shares).alias("cuts")).scalar()
    counts = rows.groupBy(F.col(actual).alias("actual")).agg(
        *[F.count(F.when(F.col(score) > cuts[name], 1)).alias(name) for name in shares]
    )
    return counts.unpivot("actual", list(shares), "cut", "n").filter("n > 0")


def confusion_matrix(rows: DataFrame, score: str, actual: str, at: float = 0.5) -> DataFrame:
    """Rows per actual and predicted class."""
    predicted = F.when(F.col(score) >= at, fixed.DISENGAGED).otherwise(fixed.ACTIVE)
    return rows.groupBy(F.col(actual).alias("actual"), predicted.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
