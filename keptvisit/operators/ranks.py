"""Ranks, cumulative counts and quantiles over a whole table or large groups.

Rows are first counted per value, before any shuffle. The counts are laid out
by value range, written out so that the layout cannot move, and summed in two
steps: inside each part, plus the totals of the parts before it. No window
holds more than one part of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keptvisit.operators.timeline import HOT_ROWS, MANY_KEYS, same_keys
from keptvisit.session import shuffle_partitions, write_out


def cumulate(counts: DataFrame, groups: list[str], value: str, sums: list[str]) -> DataFrame:
    """Per row, `<sum>_before` over lower values of the group and the group's `<sum>_total`.

    `counts` has one row per group and value.
    """
    if not groups:
        whole = cumulate(counts.withColumn("_all", F.lit(1)), ["_all"], value, sums)
        return whole.drop("_all")
    ranged = write_out(
        counts.repartitionByRange(shuffle_partitions(counts.sparkSession), *groups, value)
        .withColumn("_part", F.spark_partition_id()),
        "counts",
    )
    part = [*groups, "_part"]
    # One row per group and part: at most the number of parts for any group.
    sizes = ranged.groupBy(*part).agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    parts_before = (
        Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *part,
        *[F.coalesce(F.sum(f"_{s}").over(parts_before), F.lit(0)).alias(f"_{s}_off") for s in sums],
        *[F.sum(f"_{s}").over(Window.partitionBy(*groups)).alias(f"{s}_total") for s in sums],
    )
    rows_before = (
        Window.partitionBy(*part).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        same_keys(ranged, offsets, part)
        .withColumns({
            f"{s}_before": F.col(f"_{s}_off") + F.coalesce(F.sum(s).over(rows_before), F.lit(0))
            for s in sums
        })
        .drop("_part", *[f"_{s}_off" for s in sums])
    )


def value_counts(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Rows per group and value, nulls left out."""
    return (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def percent_ranks(rows: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """One row per group and value with its percent rank, and `n` rows that share it."""
    share = F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1)).otherwise(0.0)
    return cumulate(value_counts(rows, groups, value), groups, value, ["n"]).select(
        *groups, value, "n", share.alias(name)
    )


def with_percent_rank(
    rows: DataFrame, groups: list[str], value: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """`rows` with the percent rank of `value` in its group; null where the value is null."""
    ranks = percent_ranks(rows, groups, value, name)
    return attach(rows, ranks, [*groups, value], "n", hot_rows)


def attach(
    rows: DataFrame, lookup: DataFrame, keys: list[str], count: str, hot_rows: int = HOT_ROWS,
    many: int = MANY_KEYS,
) -> DataFrame:
    """Left join with a lookup that has one row per key and knows how many rows share it.

    Keys shared by more than `hot_rows` rows would fill one task. Their lookup
    rows, at most total / hot_rows, are joined without a shuffle of the rows. All
    other keys take the ordinary join. Of more than `many` such keys the most
    crowded ones are taken: a key left over holds at most 1 / many of all rows.
    """
    lookup = write_out(lookup, "lookup")
    heavy = write_out(
        lookup.filter(F.col(count) > hot_rows).orderBy(F.col(count).desc(), *keys).limit(many),
        "heavy").drop(count)
    if heavy.isEmpty():
        return same_keys(rows, lookup.drop(count), keys, "left")
    spread = same_keys(rows, F.broadcast(heavy), keys)
    rest = same_keys(rows, F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return spread.unionByName(same_keys(rest, lookup.drop(count), keys, "left"))


def quantiles(
    rows: DataFrame, groups: list[str], value: str, shares: dict[str, float]
) -> DataFrame:
    """Exact quantiles per group with linear interpolation, one column per share."""
    table = cumulate(value_counts(rows, groups, value), groups, value, ["n"])
    return table.groupBy(*groups).agg(
        *[_interpolated(value, share).alias(name) for name, share in shares.items()]
    )


def _interpolated(value: str, share: float) -> Column:
    spot = (F.col("n_total") - 1) * F.lit(share)
    at = lambda k: F.max(
        F.when((F.col("n_before") <= k) & (k < F.col("n_before") + F.col("n")), F.col(value))
    )
    low, high = at(F.floor(spot)), at(F.ceil(spot))
    weight = F.max(spot - F.floor(spot))
    return (low + weight * (high - low)).cast("double")


def row_numbers(keys: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct keys numbered from 1 in key order."""
    counted = cumulate(keys.withColumn("_one", F.lit(1).cast("bigint")), [], key, ["_one"])
    return counted.withColumn(name, F.col("_one_before") + 1).drop(
        "_one", "_one_before", "_one_total"
    )
