"""The prediction ledger and the derived tables: append, rebuild, back-fill, evolve."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keptvisit import fixed_values as fixed
from keptvisit.operators.timeline import same_keys
from keptvisit.session import work_tables, write_out


# The run that appended a row: a partition below the week, no column of the ledger itself.
RUN = "append_run"
RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
# A run's mark goes through these states, each by one rename.
STARTED, APPENDED, REFRESHED = "started", "appended", "refreshed"


def append_predictions(
    scored: DataFrame, path: str, test_run: bool = False, run: str | None = None,
) -> None:
    """Append scored rows to the ledger once, partitioned by week and run, unless this is a test run.

    Rows count from the moment the run's mark says that all are there. A run that
    stopped half way is never read; under the same name it starts again and replaces its
    own files only. A run that was appended before adds nothing. Without a name the run
    gets a new one. One writer at a time.
    """
    if test_run:
        return
    spark, run = scored.sparkSession, run or uuid.uuid4().hex
    if not RUN_NAME.fullmatch(run):
        raise ValueError(f"a run's name has letters, digits, dots, dashes and underscores: {run!r}")
    state = _marks(spark, path).get(run)
    if state in (APPENDED, REFRESHED):
        return
    if state is None:
        _touch(spark, f"{path}/_runs/{run}.{STARTED}")
    files, where = _files(spark, f"{path}/week=*/{RUN}={run}")
    for left_over in files.globStatus(where) or []:
        files.delete(left_over.getPath(), True)
    # Even-sized files per week: small weeks share a task, a large one is split.
    (scored.withColumn(RUN, F.lit(run)).hint("rebalance", "week")
     .write.mode("append").partitionBy("week", RUN).parquet(path))
    _move_mark(spark, path, run, STARTED, APPENDED)


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of finished appends, columns in the schema's order; week stays text."""
    return _with_runs(spark, path, schema).select(*schema.fieldNames())


def refresh_ledger(
    spark: SparkSession, path: str, schema, fill: Callable[[DataFrame, DataFrame], DataFrame],
    visits: DataFrame, changed: str = "date_created",
) -> DataFrame:
    """Fill the gaps of the ledger in its folder, driven by what is new since the last refresh.

    A row is open while its appointment or its observed return is missing. Looked at are
    the open rows of runs appended since then, and those of persons with a visit whose
    `changed` time is not before the last one seen (or is unknown); all other rows
    would come out as they are. `fill` gets ledger rows and all visits of these
    persons. Only weeks and runs in which it changes a row are written again: a
    refresh without new visits and appends writes none.

    The new files are complete beside the ledger before they take the place of the old
    ones; a replacement that stopped half way is finished by the next refresh. One
    writer at a time.
    """
    _finish_replacement(spark, path)
    appended = [run for run, state in _marks(spark, path).items() if state == APPENDED]
    seen = _watermark(spark, path)
    rows = _with_runs(spark, path, schema)
    open_rows = rows.filter(F.col("rtc_date").isNull() | F.col("observed_rtc_date").isNull())
    # A time in the future, by error, must not hide the visits until then.
    stamp = F.col(changed).cast("timestamp")
    last = visits.agg(F.unix_micros(F.least(F.max(stamp), F.current_timestamp()))).first()[0]
    with work_tables(spark):
        touched = open_rows
        if seen is not None:
            moved = visits.filter(stamp.isNull() | (F.unix_micros(stamp) >= seen)).select("person_id").distinct()
            is_new = F.col(RUN).isin(appended)
            touched = open_rows.filter(is_new).unionByName(
                open_rows.filter(~is_new).join(moved, "person_id", "left_semi"))
        touched = write_out(touched, "touched")
        if not touched.isEmpty():
            persons = touched.select("person_id").distinct()
            known = write_out(visits.join(persons, "person_id", "left_semi"), "known")
            dates = ["rtc_date", "observed_rtc_date"]
            filled = fill(touched.withColumns({f"_old_{name}": F.col(name) for name in dates}), known)
            differs = reduce(or_, [~F.col(name).eqNullSafe(F.col(f"_old_{name}")) for name in dates])
            parts = write_out(filled.filter(differs).select("week", RUN).distinct(), "parts")
            if not parts.isEmpty():
                draft = f"{path}/_filling-{uuid.uuid4().hex}"
                fill(same_keys(rows, parts, ["week", RUN], "left_semi"), known).write.parquet(draft)
                _rename(spark, draft, f"{path}/_filled")
                _finish_replacement(spark, path)
    if last is not None:
        _set_watermark(spark, path, last)
    for run in appended:
        _move_mark(spark, path, run, APPENDED, REFRESHED)
    return read_ledger(spark, path, schema)


def _with_runs(spark: SparkSession, path: str, schema) -> DataFrame:
    """Ledger rows with their run, without those of unfinished appends."""
    rows = spark.read.schema(StructType([*schema.fields, StructField(RUN, StringType())])).parquet(path)
    unfinished = [run for run, state in _marks(spark, path).items() if state == STARTED]
    return rows.filter(~F.col(RUN).isin(unfinished)) if unfinished else rows


def _finish_replacement(spark: SparkSession, path: str) -> None:
    """Put filled weeks in place of the old ones, if a refresh has left some."""
    files, done = _files(spark, f"{path}/_filled")
    if files.exists(done):
        (spark.read.parquet(f"{path}/_filled").hint("rebalance", "week", RUN)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("week", RUN).parquet(path))
        files.delete(done, True)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, where = _files(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def _touch(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.create(where, True).close()


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, where = _files(spark, old)
    if not files.rename(where, _files(spark, new)[1]):
        raise RuntimeError(f"{old} could not be renamed to {new}")


def _marks(spark: SparkSession, path: str) -> dict[str, str]:
    """The state of every run."""
    return dict(name.rsplit(".", 1) for name in _names(spark, f"{path}/_runs"))


def _move_mark(spark: SparkSession, path: str, run: str, old: str, new: str) -> None:
    _rename(spark, f"{path}/_runs/{run}.{old}", f"{path}/_runs/{run}.{new}")


def _watermark(spark: SparkSession, path: str) -> int | None:
    """The latest change among the visits that refreshes have seen, in microseconds."""
    return max((int(name) for name in _names(spark, f"{path}/_seen")), default=None)


def _set_watermark(spark: SparkSession, path: str, last: int) -> None:
    """The new mark comes before the old ones go, so that there is always one."""
    old = [name for name in _names(spark, f"{path}/_seen") if int(name) < last]
    _touch(spark, f"{path}/_seen/{last}")
    for name in old:
        files, where = _files(spark, f"{path}/_seen/{name}")
        files.delete(where, False)


def rebuild_table(frame: DataFrame, path: str) -> DataFrame:
    """Replace a derived table by a query's result and read it back.

    The result is complete in a work table before the old table is touched, so
    the query may read that table, and a failed query leaves it as it was.
    """
    with work_tables(frame.sparkSession):
        write_out(frame, "rebuilt").write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


def backfill_observed_return(ledger: DataFrame, visits: DataFrame) -> DataFrame:
    """Fill the missing observed return dates with the first qualifying visit.

    A visit qualifies when it follows the appointment, is clinical and no drug
    pick-up, and moves the appointment. Visits are reduced to one per person and
    appointment first, so no ledger row is doubled.
    """
    visit_day = F.to_date("encounter_datetime")
    returns = (
        visits.filter(
            ~F.col("encounter_type").isin(fixed.NON_VISIT_TYPES)
            & (F.col("is_clinical_encounter") == 1)
            & ((F.col("rtc_date") <= visit_day) | (F.col("rtc_date") > F.col("prev_rtc_date")))
        )
        .groupBy("person_id", F.col("prev_rtc_date").alias("rtc_date"))
        .agg(F.min(visit_day).alias("_returned"))
    )
    return (
        ledger.join(returns, ["person_id", "rtc_date"], "left")
        .withColumn("observed_rtc_date", F.coalesce("observed_rtc_date", "_returned"))
        .select(*ledger.columns)
    )


def backfill_rtc_date(ledger: DataFrame, encounters: DataFrame) -> DataFrame:
    """Fill missing appointment dates from the encounter."""
    dates = encounters.select("encounter_id", F.col("rtc_date").alias("_rtc"))
    return (
        ledger.join(dates, "encounter_id", "left")
        .withColumn("rtc_date", F.coalesce("rtc_date", "_rtc"))
        .select(*ledger.columns)
    )


def add_seven_day_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows without the 7-day columns and new rows with them, as one ledger."""
    return new.unionByName(old, allowMissingColumns=True)
