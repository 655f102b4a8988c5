"""Window work along one person's visits, also when one person has very many.

A window puts all rows of a key into one task. That is right while a key holds
at most `HOT_ROWS` rows, so the keys above that are measured first. If there
are any, their rows are numbered by a range partitioning of (key, order), cut
into blocks of bounded size, and each block gets the few neighbour rows that
its frames reach. The same window expressions then run per (key, block).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from keptvisit.session import by_key, shuffle_partitions, write_out

# Rows of one key that one task may hold, and keys that every executor may hold.
HOT_ROWS = 1_000_000
MANY_KEYS = 1_000_000
# Rows of all its keys together that a task is dealt; the windows that follow each other there sort them several times.
LAID_ROWS = 50_000

VISIT_ORDER = ["encounter_datetime", "encounter_id"]


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than `limit` rows, null among them; `keys` is None when there are none.

    `rows` is the number of rows that they hold together, `others` that of all other rows.
    """

    key: str
    limit: int
    keys: DataFrame | None
    rows: int = 0
    others: int = 0


def find_hot_keys(
    rows: DataFrame, key: str, limit: int = HOT_ROWS, many: int = MANY_KEYS
) -> HotKeys:
    """Count rows per key (combined before the shuffle) and keep the keys above the limit.

    There are at most rows / limit such keys, and they are broadcast. Of more than
    `many` the most crowded ones are taken: a key left over holds at most 1 / many
    of all rows.
    """
    crowded = rows.groupBy(key).count().filter(F.col("count") > limit)
    hot = write_out(crowded.orderBy(F.col("count").desc(), key).limit(many), "hot-keys")
    found = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("count").alias("rows")).first()
    total = rows.count()
    if found["keys"] == 0:
        return HotKeys(key, limit, None, others=total)
    return HotKeys(key, limit, F.broadcast(hot.select(key)), found["rows"], total - found["rows"])


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys in which null equals null; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    test = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, test, how).drop(*[f"_right_{k}" for k in keys])


def split_hot(rows: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """The rows of crowded keys and all others."""
    return tuple(same_keys(rows, hot.keys, [hot.key], how) for how in ("left_semi", "left_anti"))


def along(
    rows: DataFrame,
    hot: HotKeys,
    order: list[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    back: int = 0,
    ahead: int = 0,
    number: str | None = None,
) -> DataFrame:
    """`rows` with the window columns of `build`, per `hot.key` in `order`.

    The frames of `build` must reach at most `back` rows back and `ahead` rows
    ahead. `order` must be unique within a key. `number` names an optional
    column with the row's position, from 1.
    """
    key = hot.key
    window = Window.partitionBy(key).orderBy(*order)

    def plain(part: DataFrame) -> DataFrame:
        part = by_key(part, hot.others, key, per_task=LAID_ROWS)
        columns = build(window)
        if number:
            columns[number] = F.row_number().over(window).cast("bigint")
        return part.withColumns(columns) if columns else part

    if hot.keys is None:
        return plain(rows)
    crowded, others = split_hot(rows, hot)
    return plain(others).unionByName(_in_blocks(crowded, hot, order, build, back, ahead, number))


def numbered(rows: DataFrame, hot: HotKeys, order: list[str]) -> DataFrame:
    """`rows` of hot keys with `_pos`, the position within the key from 1.

    There are as many ranges as keep each at about the limit, whatever the number of rows.
    """
    key = hot.key
    parts = max(shuffle_partitions(rows.sparkSession), -(-hot.rows // hot.limit))
    ranged = write_out(
        rows.repartitionByRange(parts, key, *order).withColumn("_part", F.spark_partition_id()),
        "timeline",
    )
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(key, "_part").count()
        .select(key, "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    )
    local = Window.partitionBy(key, "_part").orderBy(*order)
    return (
        same_keys(ranged, offsets, [key, "_part"])
        .withColumn("_pos", F.col("_before") + F.row_number().over(local))
        .drop("_part", "_before")
    )


def _in_blocks(rows, hot, order, build, back, ahead, number) -> DataFrame:
    size = hot.limit
    block = lambda shift: F.floor((F.col("_pos") - 1 + shift) / size)
    copies = (
        numbered(rows, hot, order)
        .withColumn("_home", block(0))
        .withColumn("_block", F.explode(F.sequence(F.greatest(block(-ahead), F.lit(0)), block(back))))
    )
    window = Window.partitionBy(hot.key, "_block").orderBy("_pos")
    columns = build(window)
    if number:
        columns[number] = F.col("_pos")
    done = copies.withColumns(columns) if columns else copies
    return done.filter("_block = _home").drop("_pos", "_home", "_block")


def with_neighbours(encounters: DataFrame, hot: HotKeys) -> DataFrame:
    """Encounters with the columns of the previous and the next visit."""

    def build(window: WindowSpec) -> dict[str, Column]:
        return {
            "prev_rtc_date": F.lag("rtc_date").over(window),
            "prev_encounter_type": F.lag("encounter_type").over(window),
            "prev_encounter_datetime": F.lag("encounter_datetime").over(window),
            "next_datetime": F.lead("encounter_datetime").over(window),
            "next_encounter_type": F.lead("encounter_type").over(window),
            "next_rtc_date": F.lead("rtc_date").over(window),
        }

    near = along(encounters, hot, VISIT_ORDER, build, back=1, ahead=1)
    if hot.keys is None:
        return _clinical(near, Window.partitionBy(hot.key).orderBy(*VISIT_ORDER))
    crowded, others = split_hot(near, hot)
    plain = _clinical(others, Window.partitionBy(hot.key).orderBy(*VISIT_ORDER))
    return plain.unionByName(_clinical_in_blocks(crowded, hot))


def _clinical_values() -> tuple[Column, Column]:
    """The appointment (in a struct, as it may be null) and the time of a clinical visit, else null."""
    clinical = F.col("is_clinical_encounter") == 1
    return F.when(clinical, F.struct("rtc_date")), F.when(clinical, F.col("encounter_datetime"))


def _clinical(rows: DataFrame, window: WindowSpec) -> DataFrame:
    """`rows` with the clinical visit before and after, other visits passed over."""
    made, seen = _clinical_values()
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    after = window.rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumns({
        "prev_clinical_rtc_date": F.last(made, ignorenulls=True).over(before)["rtc_date"],
        "next_clinical_datetime": F.first(seen, ignorenulls=True).over(after),
    })


def _clinical_in_blocks(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """`_clinical` for crowded persons: within blocks, and what the nearest other block carries over."""
    key = hot.key
    made, seen = _clinical_values()
    placed = write_out(
        numbered(rows, hot, VISIT_ORDER)
        .withColumn("_block", F.floor((F.col("_pos") - 1) / hot.limit)), "blocks")
    # One row per block of a person: rows / limit of them.
    ends = placed.groupBy(key, "_block").agg(
        F.max_by(made, F.when(made.isNotNull(), F.col("_pos"))).alias("_last"),
        F.min_by(seen, F.when(seen.isNotNull(), F.col("_pos"))).alias("_first"))
    blocks = Window.partitionBy(key).orderBy("_block")
    carried = ends.select(
        key, "_block",
        F.last("_last", ignorenulls=True)
        .over(blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True)
        .over(blocks.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    window = Window.partitionBy(key, "_block").orderBy("_pos")
    before = F.last(made, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(seen, ignorenulls=True).over(window.rowsBetween(1, Window.unboundedFollowing))
    near = placed.withColumns({"_own_before": before, "_own_after": after})
    return same_keys(near, carried, [key, "_block"]).withColumns({
        "prev_clinical_rtc_date": F.coalesce("_own_before", "_before")["rtc_date"],
        "next_clinical_datetime": F.coalesce("_own_after", "_after"),
    }).drop("_pos", "_block", "_before", "_after", "_own_before", "_own_after")


def first_of_day(encounters: DataFrame, hot: HotKeys, laid_out: bool = False) -> DataFrame:
    """One visit per person and day, the one with the lowest encounter id, then the earliest.

    After this a person has at most one row per calendar day, which bounds every
    later window per person. Visits without a date are one day of their own.
    The window is per person and day, which no long history can crowd; the rule
    is the same with and without hot persons. Without them the rows are laid out
    by person once and stay there; input that comes from a window per person is
    `laid_out` already.
    """
    rows = encounters.withColumn("visit_date", F.to_date("encounter_datetime"))
    if hot.keys is None and not laid_out:
        rows = rows.repartition(hot.key)
    day = Window.partitionBy(hot.key, "visit_date").orderBy("encounter_id", "encounter_datetime")
    return rows.withColumn("_row", F.row_number().over(day)).filter("_row = 1").drop("_row")
