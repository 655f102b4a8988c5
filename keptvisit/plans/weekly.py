"""The weekly risk run: appointments of a week, scored, banded and stamped."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.models import score
from keptvisit.operators import filters, history, joins, reports, risk
from keptvisit.operators.timeline import HotKeys
from keptvisit.plans import training
from keptvisit.session import scratch_path, work_tables, write_out
from keptvisit.sources import ledger as ledgers

col = F.col

COUNTS = {"num_1day_defaults_last_3visits": 1, "num_7days_defaults_last_3visits": 7}


@dataclass
class Inputs:
    """Tables of the weekly run. `past` is the derived table of missed days."""

    visits: DataFrame
    person: DataFrame
    past: DataFrame
    facility: DataFrame
    programs: DataFrame
    ledger: DataFrame
    hot: HotKeys


def week_of(start: date, weeks: int = 1) -> tuple[date, date]:
    """Monday of the start's week and the Sunday that ends the last week."""
    monday = start - timedelta(days=start.weekday())
    return monday, monday + timedelta(days=7 * max(weeks, 1) - 1)


def predictors(appointments: DataFrame, inputs: Inputs) -> DataFrame:
    """Appointments with every predictor of the deployed models, filled as in training."""
    counts = history.strict_three_visit_defaults(inputs.past, inputs.hot, COUNTS)
    star = (
        joins.feature_star(appointments, inputs.person, inputs.past, inputs.facility)
        .join(counts.drop("visit_number"), ["person_id", "encounter_id"], "left")
        .join(inputs.programs, "visit_type", "left")
    )
    age = dates.years_between(col("birthdate"), col("encounter_datetime"))
    visit_day = F.to_date("encounter_datetime")
    rows = star.select(
        "person_id", "encounter_id",
        clinical.effective_location(col("transfer_out_location_id"), col("location_id"))
        .alias("location_id"),
        "rtc_date", "gender", "visit_number", "clinic_county", "size_enrollments_log10",
        "volume_visits_log10", "care_programme", "facility_type", "program_name", "disclosure",
        "tb_test_result",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS],
        age.alias("age"),
        clinical.age_band(age).alias("band"),
        clinical.bmi(col("weight"), col("height")).alias("bmi"),
        clinical.viral_load_log10(col("vl_resulted")).alias("viral_load_log10"),
        col("cd4_resulted").alias("cd4"),
        dates.days_between(F.to_date("vl_resulted_date"), visit_day).alias("days_since_vl"),
        dates.days_between(F.to_date("cd4_resulted_date"), visit_day).alias("days_since_cd4"),
        dates.appointment_month(col("rtc_date")).alias("month"),
        col("days_defaulted_last_encounter").alias("days_defaulted_prev"),
    )
    return training.filled(training.plausible(rows)).fillna({"visit_number": 1})


def weekly_risk_run(
    inputs: Inputs, models: score.Models | Callable[[DataFrame], DataFrame], start: date,
    weeks: int = 1, retrospective: bool = False, test_run: bool | None = None,
    sites: list[int] | None = None, generated: date | datetime | None = None, *, version: str,
) -> DataFrame:
    """Scored and banded appointments of the weeks, ready for the ledger.

    A test run scores all appointments again; otherwise those in the ledger are
    left out. `models` may be a function that adds `prob_1day` and `prob_7day` to the
    predictors. Nothing but work tables is written here.
    """
    test_run = retrospective if test_run is None else test_run
    monday, sunday = week_of(start, weeks)
    due = filters.active_appointments(inputs.visits, F.lit(monday), F.lit(sunday), retrospective)
    due = filters.site_list(due, sites)
    if not test_run:
        due = filters.unscored(due, inputs.ledger)
    rows = predictors(due, inputs).filter("band is not null")
    scored = (models(rows) if callable(models) else score.score(rows, models)).select(
        "person_id", "encounter_id", "location_id", "rtc_date", "band", "prob_1day", "prob_7day"
    )
    # Banding reads the scores several times: score once.
    scored = write_out(scored, "scored")
    label = dates.cohort_week_label(F.lit(monday))
    cutoffs = reports.risk_cutoffs(
        inputs.ledger.filter(col("week") == label), inputs.person, []
    )
    banded = risk.banded_by_batch_size(scored, cutoffs, ["band"])
    stamp = F.lit(generated) if generated else F.current_timestamp()
    return banded.withColumns({
        "prediction_generated_date": F.to_date(stamp),
        "model_version": F.lit(version),
        "start_date": F.lit(monday),
        "end_date": F.lit(sunday),
        "week": dates.cohort_week_label(col("rtc_date")),
    })


def run_and_append(
    inputs: Inputs, models: score.Models | Callable[[DataFrame], DataFrame], start: date,
    ledger_path: str, ledger_schema, run: str | None = None, **options,
) -> DataFrame:
    """A live run whose rows are appended to the ledger; returns what it appended.

    Encounters in the ledger are left out, so that a repeated run appends nothing. The
    rows go to a work table first: the append does not read the ledger it writes to.
    Rows of a run that stopped while it appended do not count as in the ledger; with the
    same `run` name the repeated one replaces them.
    """
    spark = inputs.visits.sparkSession
    inputs = replace(inputs, ledger=ledgers.read_ledger(spark, ledger_path, ledger_schema))
    path = scratch_path(spark, "fresh")
    with work_tables(spark):
        rows = weekly_risk_run(inputs, models, start, test_run=False, **options)
        gaps = [field for field in ledger_schema if field.name not in rows.columns]
        if gaps:
            rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in gaps})
        rows.select(*ledger_schema.fieldNames()).write.parquet(path)
    fresh = spark.read.schema(ledger_schema).parquet(path)
    ledgers.append_predictions(fresh, ledger_path, run=run)
    return fresh
